"""What the findings of round 3 told of: each test failed before its finding was mended."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from tidemark.functions import values as V
from tidemark.operators import entities as E
from tidemark.operators import policies as C
from tidemark.operators import trends as P
from tidemark.sources import feeds as S


def test_halves_round_as_in_sql(spark):
    """the weight is applied before the division, and a half is told from the product with the power of ten."""
    rows = [(20, 14, 18), (40, 24, 37), (50, 19, 20), (80, 12, 63), (4800, 3162, 3162)]
    df = spark.createDataFrame(rows, "n int, m int, k int")
    n, m, k = F.col("n"), F.col("m"), F.col("k")
    assert [r.s for r in df.select(P.confidence(n, m, k, n).alias("s")).collect()] == [90, 88, 72, 75, 85]
    share = duckdb.execute("SELECT round_even(3162 * 1.0::DOUBLE / 4800, 4)").fetchone()[0]
    assert df.filter("n = 4800").select(V.ratio(m, n).alias("s")).first().s == share == 0.6587


def test_registry_faults_meet_each_anchor_and_target_once(spark):
    """the right sides of both joins are distinct, so repeated items and targets reach no task's sort."""
    registry = spark.createDataFrame([(1, 10, None), (1, 11, None), (2, 12, 2), (3, 13, 9)], "id int, anchor int, redirect int")
    items = spark.createDataFrame([(10,)] * 50 + [(12,)] * 50, "anchor int")
    found = E.registry_faults(registry, items, "id", "anchor", "redirect")
    want = [(1, "DUPLICATE_ID"), (1, "ORPHAN_ANCHOR"), (2, "SELF_REDIRECT"), (3, "LOST_REDIRECT")]
    assert sorted(map(tuple, found.collect())) == want
    joins = found._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")[1:]
    assert len(joins) == 2 and all("Aggregate" in j for j in joins)


def test_territories_are_read_from_a_key_made_once(spark):
    """a name's key is no longer made again for each pattern, and rows do not move to meet the few identities."""
    names = [("Département de la Réunion pirate",), ("CD2A",), ("CR 11",), ("region",), (None,), ("Conseil régional d'Île-de-France SAS",), ("Departement 33 bis",)]
    df = spark.createDataFrame(names, "name string")
    got = [r.t and tuple(r.t) for r in df.select(C.territory(F.col("name")).alias("t")).collect()]
    assert got == [("departement", "reunion"), ("departement", "2a"), ("region", "11"), None, None, ("region", "ile de france"), None]
    identities = spark.createDataFrame([("departement", "2a", "x")], "kind string, value string, key string")
    keys = C.effective_keys(df, ["name", "name"], identities, F.lit("-"), "k")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert plan.count("eurl") <= 2 * 3 and "SortMergeJoin" not in plan
    assert sorted(r.k for r in keys.collect()) == ["-"] * 6 + ["x"]


def test_a_date_is_folded_once(spark):
    """the folded text is no longer made again for each part of each way to write a day."""
    df = spark.createDataFrame([("Le 2024-02-30, soit 01/03/2024",), ("2024-02-30T1 2024-01-01",), ("3  AOÛT\n2024.",), ("32/01/2024 05.06.2024",), (" 2024-05-06 x",)], "t string")
    got = df.select(V.parse_date(F.col("t")).cast("string").alias("d"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("translate(") <= 2
    assert [r.d for r in got.collect()] == ["2024-03-01", "2024-01-01", "2024-08-03", "2024-06-05", "2024-05-06"]


def test_written_days_are_tried_only_where_one_can_begin(spark, sf_dir):
    """the look at the first two signs takes nothing from what the pattern finds."""
    texts = ["Le 3 MAI 2024, 1er août 2023; Février 3, 2022 FÉVRIER. 4 2021", "ſept 5 2024 auguſt 6, 2024 ٣/٤/٢٠٢٤", "x2024-01-02 -2024-01-02 12.3.2024/ déc 1 2020 dec 2 2020", "may", ""]
    df = spark.createDataFrame([(t,) for t in texts], "html string").union(spark.read.parquet(f"{sf_dir}/pages.parquet").select("html"))
    every = S.WRITTEN_DAY.replace(S._DAY_OPENS, "")
    assert every != S.WRITTEN_DAY
    found = df.select(*[F.regexp_extract_all("html", F.lit(p), F.lit(0)).alias(n) for n, p in (("a", S.WRITTEN_DAY), ("b", every))]).collect()
    assert all(r.a == r.b for r in found) and sum(len(r.a or ()) for r in found[:5]) >= 8
