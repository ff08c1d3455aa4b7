"""Counts, summaries, claims, the scorecard and stable references (N-06, N-08, N-12, A-12, J-09): literal cases, and a fold in plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import facts as X
from tidemark.operators import relate as R
from tidemark.operators.scorecard import contributions, scorecard

RANKS = {"RANSOM": 0, "PRESS": 1, "LEAKS": 2}
SCHEMA = (
    "incident string, source string, item string, records array<struct<value: string, raw: string, unit: string, kind: string, scope: string, status: string>>, "
    "affected_count string, affected_raw string, affected_unit string, claim_status string"
)


def fact(incident, source, *records, count=None, unit=None, status=None, raw=None, item=None):
    return (incident, source, item or f"I-{source}", [(v, None, u, k, s, st) for v, u, k, s, st in records], count, raw, unit, status)


def told(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    rank = F.coalesce(*[F.when(F.col("source") == s, r) for s, r in RANKS.items()], F.lit(100))
    return X.counted(df, "incident", rank=rank)


CASES = {
    "total and unique stay apart": (
        [fact("a", "RANSOM", ("10279819", "records", None, "total", "claimed"), ("5169727", "Records", None, "unique après déduplication", "claimed")),
         fact("a", "PRESS", ("5160000", "clients", None, "clients concernés", "reported"))],
        {("records", "total", "10279819", "claimed", "RANSOM", "RANSOM"), ("records", "unique", "5169727", "claimed", "RANSOM", "RANSOM"),
         ("clients", "clients concernes", "5160000", "reported", "PRESS", "PRESS")}),
    "an old count of another unit": (
        [fact("a", "RANSOM", ("10", "records", None, "total", "claimed")), fact("a", "PRESS", count="525000", unit="people", status="reported")],
        {("records", "total", "10", "claimed", "RANSOM", "RANSOM"), ("people", "unspecified", "525000", "reported", "PRESS", "PRESS")}),
    "an equal old count": (
        [fact("a", "PRESS", ("10", "records", None, "total", "claimed"), count="10", unit="records"), fact("a", "LEAKS", count="10", unit="Records")],
        {("records", "total", "10", "claimed", "PRESS", "PRESS,LEAKS")}),
    "an old count takes the one semantic of later records": (
        [fact("a", "RANSOM", count="10000", unit="records", status="claimed"), fact("a", "PRESS", ("9000", "records", None, "total", "reported"))],
        {("records", "total", "10000", "claimed", "RANSOM", "RANSOM")}),
    "the first source's value": (
        [fact("a", "PRESS", ("900", "records", None, "total", "reported")), fact("a", "RANSOM", ("1000", "records", None, "all of it", "odd"))],
        {("records", "total", "1000", "unknown", "RANSOM", "RANSOM")}),
    "two semantics: unspecified": (
        [fact("a", "RANSOM", ("7", "records", None, "total", None), ("5", "records", None, "unique", None)), fact("a", "PRESS", count="6", unit="records"), fact("a", "LEAKS", count="5", unit="records")],
        {("records", "total", "7", "unknown", "RANSOM", "RANSOM"), ("records", "unique", "5", "unknown", "RANSOM", "RANSOM,LEAKS"), ("records", "unspecified", "6", "unknown", "PRESS", "PRESS")}),
    "nothing": ([fact("a", "RANSOM", (None, "records", None, "total", None), count="6", unit="unknown"), fact("a", "PRESS", count=None, unit="people"), fact("a", "LEAKS", count="6")], set()),
}


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(name, *r[1:]) for name, (facts, _) in CASES.items() for r in facts]
    out = {name: set() for name in CASES}
    for r in told(spark, rows).collect():
        out[r.incident].add((r.unit, r.semantic, r.value, r.status, r.source, ",".join(r.sources)))
    return out


@pytest.mark.parametrize("name", CASES)
def test_counts(cases, name):
    assert cases[name] == CASES[name][1]


def test_counts_of_no_facts(spark):
    assert told(spark, []).collect() == []


def fold(facts):
    """One incident's counts, read one after the other."""
    facts = sorted(facts, key=lambda f: (RANKS[f[1]], f[1], f[2]))
    seen = {}
    for f in facts:
        for v, _, u, k, *_ in f[3]:
            seen.setdefault(u, set()).add(k)
    standing = {}
    for f in facts:
        for v, _, u, k, *_ in f[3]:
            entry = standing.setdefault((u, k), (v, [f[1]]))
            if entry[0] == v and f[1] not in entry[1]:
                entry[1].append(f[1])
        if f[4] is None:
            continue
        meets = [e for (u, _), e in standing.items() if u == f[6] and e[0] == f[4]]
        if meets:
            if f[1] not in meets[0][1]:
                meets[0][1].append(f[1])
        else:
            kinds = seen.get(f[6], set())
            standing.setdefault((f[6], next(iter(kinds)) if len(kinds) == 1 else "unspecified"), (f[4], [f[1]]))
    return {(u, k, v, ",".join(s)) for (u, k), (v, s) in standing.items()}


def test_counts_as_read_one_by_one(spark):
    rng = random.Random(5)
    rows = []
    for n in range(300):
        for i in range(rng.randint(1, 7)):
            records = [(str(rng.randint(1, 3)), rng.choice(["people", "files"]), rng.choice(["unspecified", "x", "y"]), None, None) for _ in range(rng.randint(0, 2))]
            old = {"count": str(rng.randint(1, 4)), "unit": rng.choice(["people", "files"])} if rng.random() < 0.6 else {}
            rows.append(fact(str(n), rng.choice(list(RANKS)), *records, item=f"{i:02}", **old))
    got = {}
    for r in told(spark, rows).collect():
        got.setdefault(r.incident, set()).add((r.unit, r.semantic, r.value, ",".join(r.sources)))
    for n in {r[0] for r in rows}:
        assert got.get(n, set()) == fold([r for r in rows if r[0] == n]), n


def test_summary(spark):
    rows = [
        ("Service fermé", "records", "unique", "5169727", "", "claimed", ["Noms"], "f" * 50, "Service fermé. 5 169 727 enregistrements uniques (revendiqué). Données exposées : Noms."),
        (None, "clients", "x", "5160000", None, "reported", list("abcdef"), "court", "5 160 000 clients (rapporté). Données exposées : a, b, c, d, e…."),
        ("", "people", "total", "3", "environ 3 personnes", "odd", [], None, "Environ 3 personnes (documenté)."),
        ("", "people", "total", "3", "", "denied", [], " " + "f" * 41 + " ", "f" * 41),
        ("Fini !", None, None, None, None, None, None, "x", "Fini !"),
        (None, None, None, None, None, None, None, " rien ", "rien"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, impact string, unit string, semantic string, value string, raw string, status string, kinds array<string>, fallback string, want string")
    count = F.struct("unit", "semantic", "value", "raw", "status")
    got = df.select("i", "want", X.display_summary(F.col("impact"), F.when(F.col("unit").isNotNull(), count), F.col("kinds"), F.col("fallback")).alias("got")).orderBy("i")
    assert [r.got for r in got.collect()] == [r[-1] for r in rows]


def test_claims(spark):
    rows = [("a", "t", "Denied", "1", "2025-01-01", "x"), ("a", "t", "confirmed", "2", "2025-03-01", "y"), ("a", "t", "confirmed", "3", "2025-02-01", "z"), ("a", "t", " CONFIRMED ", "3", "2025-02-01", " z"),
            ("a", "u", "sure", None, None, None), ("b", "u", "claimed", "1", "", "")]
    df = spark.createDataFrame(rows, "k string, type string, status string, value string, date string, evidence string")
    assert [(r.k, r.status, r.value) for r in X.primary_claim(df, "k", "t").collect()] == [("a", "confirmed", "3")]
    history = X.claim_history(df, "k").orderBy("k", "place").collect()
    assert [(r.k, r.place, r.status, r.value) for r in history] == [("a", 1, "denied", "1"), ("a", 2, "confirmed", "3"), ("a", 3, "confirmed", "2"), ("a", 4, "unknown", ""), ("b", 1, "claimed", "1")]


def test_scorecard(spark):
    active = spark.createDataFrame([("A",), ("B",), ("C",)], "source string")
    items = spark.createDataFrame(
        [("A", "x", "2026-01-10", "", "t", "s", "Inconnu"), ("A", "x", "", "2026-01-12T08:00:00Z", "t", "Inconnu", "Inconnu"), ("A", "", None, "bad", "t", "s", "l"), ("B", "y", "2025-11-01", None, "Inconnu", "s", "l"),
         ("Z", "y", "2026-01-01", None, "t", "s", "l")],
        "source string, key string, event string, published string, threat string, sector string, location string")
    incidents = spark.createDataFrame([("A",), ("A | B",), ("B |A| A",), ("",), (None,), ("A",)], "sources string")
    runs = spark.createDataFrame(
        [("A", f"2026-01-{d:02}", "r", "OK" if d % 4 else "FAIL", 1.5, 2, 3) for d in range(1, 13)] + [("B", "2026-01-01", "r", "PARTIAL", 2.0, 0, 5)],
        "source string, as_of string, run_id string, status string, duration_s double, calls int, collected int")
    got = {r.source: r for r in scorecard(active, items, incidents, runs, F.lit(dt.date(2026, 1, 13)), recent=10).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert (a.touched, a.exclusive, a.corroborated, a.exclusive_share_pct, a.items, a.organisations) == (4, 2, 2, 50.0, 3, 1)
    assert (a.latest_day, a.freshness_days, a.recent_runs, a.ok_runs, a.fail_runs, a.reliability_pct) == ("2026-01-12", 1, 10, 7, 3, 70.0)
    assert (a.avg_duration_s, a.items_per_call, a.location_unknown_pct, a.completeness_pct) == (1.5, 1.5, 66.7, 66.7)
    assert (a.value_index, a.grade, a.warnings) == (71.8, "B", ["reliability_below_80pct", "location_unknown_over_50pct"])
    assert (b.freshness_days, b.touched, b.exclusive, b.items_per_call, b.reliability_pct, b.completeness_pct) == (73, 2, 0, 0.0, 0.0, 66.7)
    assert b.warnings == ["stale_over_30d", "reliability_below_80pct", "threat_unknown_over_25pct", "no_exclusive_incident"]
    assert (c.items, c.latest_day, c.freshness_days, c.reliability_pct, c.value_index, c.grade, c.warnings) == (0, "", None, None, 0.0, "D", ["no_items"])
    assert {r.source: (r.touched, r.exclusive, r.corroborated) for r in contributions(incidents, "sources").collect()} == {"A": (4, 2, 2), "B": (2, 0, 2)}


ITEMS = [
    ("S", "n1", "u1", "d1", "Acme", "i1"), ("S", "n2", "u2", "d1", "Acme", "i2"), ("S", "n2", "u3", "d2", "Acme", "i3"), ("S", "n2", "u3", "d3", "Beta", "i4"),
    ("T", "", "u1", "d1", "Acme", "i5"), ("T", None, "u1", "d1", "Beta", "i6"), ("T", "", "u1", "d2", "Beta", "i7"), ("U", "", "", None, None, "i8"), ("U", "", "", None, None, "i9"), ("V", "", "", None, None, "i9"),
]
SIDES = [
    (("S", "n1", "", "", "", ""), "RESOLVED", "i1", 1, []),
    (("S", "n2", "u2", "d3", "", ""), "RESOLVED", "i2", 1, []),
    (("S", "n2", "u3", "", "", ""), "AMBIGUOUS", None, 2, ["i3", "i4"]),
    (("S", "n2", "u3", "d9", "Beta", ""), "RESOLVED", "i4", 1, []),
    (("S", "n2", "u9", "d9", "x", ""), "AMBIGUOUS", None, 3, ["i2", "i3", "i4"]),
    (("S", "n9", "u1", "", "", "i1"), "MISSING", None, 0, []),
    ((" T ", "", "u1", "d1", "", ""), "AMBIGUOUS", None, 2, ["i5", "i6"]),
    (("T", None, "u1", "d1", "Beta", ""), "RESOLVED", "i6", 1, []),
    (("T", "", "u9", "d1", "Beta", "i5"), "MISSING", None, 0, []),
    (("", "n1", "u1", "", "", "i8"), "LEGACY", "i8", 1, []),
    ((None, None, None, None, None, "i9"), "MISSING", None, 0, []),
    ((None, None, None, None, None, None), "MISSING", None, 0, []),
]


def test_sides(spark):
    fields = "source string, native string, url string, date string, organisation string, item string"
    items = spark.createDataFrame(ITEMS, fields)
    refs = spark.createDataFrame([(i, *s[0]) for i, s in enumerate(SIDES)], "ref int, " + fields)
    got = [(r.status, r.item, r.candidates) for r in R.resolved_sides(refs, items).orderBy("ref").collect()]
    assert got == [s[1:4] for s in SIDES]
    unsure = {}
    for r in R.ambiguous_items(refs, items).collect():
        unsure.setdefault(r.ref, []).append(r.item)
    assert {k: sorted(v) for k, v in unsure.items()} == {i: s[4] for i, s in enumerate(SIDES) if s[4]}
