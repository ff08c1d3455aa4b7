"""Names, signals, roll-ups and review order (T-08, P-01, P-03, D-10, D-11, O-05) against literal answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.text import clean_name
from tidemark.operators import aggregate as G
from tidemark.operators import audit as A
from tidemark.operators import dedup as D
from tidemark.operators import trends as P


def test_clean_name(spark):
    names = {
        "\U0001f534 AXYON (EDF, Eiffage) [maj]": "AXYON", "• Mairie de​Lyon –": "Mairie de Lyon", "www.acme.fr (site)": "acme.fr", "WWW.Acme.fr": "Acme.fr", "(Acme)": "", "A (b) c": "A (b) c",
        "Acme ★ Group": "Acme Group", "  ": "", None: "", "Acme (a) (b)": "Acme", "- Acme -": "Acme", "2️⃣ Acme": "2 ⃣ Acme",
    }
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    assert [r.c for r in df.select("i", clean_name(F.col("n")).alias("c")).orderBy("i").collect()] == list(names.values())


def signals(spark, rows, **more):
    df = spark.createDataFrame([(dt.date(2026, 1, 31) - dt.timedelta(age), label) for age, label, n in rows for _ in range(n)], "day date, label string")
    got = P.dimension_signals(df, "day", F.lit("2026-01-31").cast("date"), [7], "label", **more).orderBy("label").collect()
    return [(r.label, r.kind, r.now, r.before, r.delta, r.change, r.share, r.base_rate, r.excess) for r in got]


def test_signals_without_base_rate(spark):
    rows = [(0, "new", 3), (6, "up", 4), (7, "up", 2), (0, "flat", 4), (8, "flat", 3), (3, "Inconnu", 6), (3, None, 1), (2, "two", 2), (14, "up", 50)]
    assert signals(spark, rows) == [("new", "emerging", 3, 0, 3, 100.0, 15.0, None, None), ("up", "acceleration", 4, 2, 2, 100.0, 20.0, None, None)]


def test_signals_above_the_base_rate(spark):
    """30 rows now, 20 before: 50 percent up. A label must be up by 75 at least and have 60 percent of the rows at most."""
    rows = [(0, "big", 19), (7, "big", 6), (1, "quick", 7), (9, "quick", 4), (2, "slow", 3), (8, "slow", 2), (0, None, 1), (8, "Inconnu", 8)]
    assert signals(spark, rows) == [("quick", "acceleration", 7, 4, 3, 75.0, 23.3, 50.0, 25.0)]


def test_new_labels_grow_by_100_percent(spark):
    """From 10 to 20 rows all grow by 100 percent, so a new label is no signal."""
    assert signals(spark, [(0, "new", 5), (0, "a", 9), (7, "a", 5), (0, "b", 6), (8, "b", 5)]) == []


def test_confidence(spark):
    df = spark.createDataFrame([(3, 1, 0.5), (12, 12, 1.0), (24, 0, 0.0)], "n int, m int, k double")
    assert [r.s for r in df.select(P.confidence(F.col("n"), F.col("m"), F.col("k")).alias("s")).collect()] == [32, 100, 55]


MEMBERS = [
    # component, id, source, event, published, url, name, sector, place, threat, collected
    ("c1", "1", "A", "", "2026-01-02", "u1", "Acme", "S", "P", "leak", "2026-01-03"),
    ("c1", "2", "B", "2026-01-01", "2026-01-04", "u2", "ACME", "S", "Inconnu", "ransom", ""),
    ("c1", "3", "B", "", "2026-01-05", "u2", "Acme SA", "T", "Q", "", "2026-01-09"),
    ("c1", "4", "N", "", "2026-01-06", "u9", "Acme SA", "T", "Q", None, None),
    ("c2", "5", "N", "", "2026-01-06", "u9", "Solo", "", None, "odd", "2026-02-01"),
    ("c3", "6", "A", "", "", "", "X", "S", "P", "leak", ""),
    ("c3", "7", "A", "", "", "", "X", "S", "P", "leak", ""),
    ("c3", "8", "GOOD", "", "", "", "X", "T", "Q", "leak", ""),
]


def test_rollup(spark):
    df = spark.createDataFrame(MEMBERS, "component string, id string, source string, event string, published string, url string, name string, sector string, place string, threat string, collected string")
    df = df.withColumn("key", F.lower("name"))
    rows = {r.component: r for r in D.incidents(df, preferred="GOOD", silent=("N",), threats=("ransom", "leak")).collect()}
    a, b, c = rows["c1"], rows["c2"], rows["c3"]
    assert (a.date, a.basis, a.name, a.sector, a.threat, a.place) == ("2026-01-01", "EVENT", "Acme SA", "Inconnu", "ransom", "Q")
    assert (a.sources, a.urls, a["items"], a.n_sources, a.first_seen, a.last_seen) == ("A | B", "u1 | u2", 4, 3, "2026-01-03", "2026-01-09")
    assert (b.basis, b.name, b.sector, b.threat, b.place, b.sources, b.urls) == ("PUBLICATION", "Solo", "Inconnu", "Inconnu", "Inconnu", "N", "u9")
    assert (c.date, c.sector, c.place, c.first_seen) == ("", "T", "Q", "")


def test_review_order(spark):
    rows = [(A.FALSE, "CLAIM_REPORTED", 2), (A.FALSE, "MERGE_REVIEW_RANSOMWARE_CORROBORATION", 0), (A.FALSE, "CANONICAL_NAME", 3), (A.FALSE, "ALIAS", 14), (A.MISSED, A.COMPANY, 9), (A.MISSED, A.PERMUTATION, 0), (A.MISSED, A.CONTAINMENT, 12)]
    df = spark.createDataFrame([(i, *r, f"l{i}", f"r{i}") for i, r in enumerate(rows)], "i int, risk string, reason string, days_apart int, left_id string, right_id string")
    assert [(r.i, r.priority) for r in A.review_queue(df).collect()] == [(0, 100), (1, 100), (3, 99), (2, 93), (4, 70), (6, 59), (5, 50)]


def test_places(spark):
    rows = [("a", v) for v in (5, 1, 9, 9, 9, None)] + [("b", 2), ("c", None), (None, 7)] + [("d", v) for v in range(20)]
    got = G.ordered_places(spark.createDataFrame(rows, "k string, v int"), "k", "v", median=0.5, p90=0.9, first=0.0, last=1.0)
    assert {r.k: (r.n, r["first"], r.median, r.p90, r["last"], r.largest) for r in got.collect()} == {"a": (5, 1, 9, 9, 9, 9), "b": (1, 2, 2, 2, 2, 2), None: (1, 7, 7, 7, 7, 7), "d": (20, 0, 10, 18, 19, 19)}


def test_first_ids(spark):
    rows = [("a", i % 30) for i in range(90)] + [("b", 3), ("b", None), (None, 1)]
    got = G.first_ids(spark.createDataFrame(rows, "k string, v int"), "k", "v")
    assert {r.k: r.ids for r in got.collect()} == {"a": list(range(12)), "b": [3], None: [1]}
