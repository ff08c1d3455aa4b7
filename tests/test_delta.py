"""Clusters kept up to date (I-05) against a full run, by random edits, in batches and as a stream."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import dedup as D
from tidemark.operators import delta as X

SCHEMA = "id string, key string, published string, source string, version long, gone boolean"


def edits(rng, n, version, ids):
    day = dt.date(2026, 1, 1)
    return [
        (f"{rng.randrange(ids):04}", rng.choice(["a", "b", "c", "d", "", None]), (day + dt.timedelta(rng.randrange(60))).isoformat(), rng.choice("xyz"), version + rng.choice([0, 0, -9]), rng.random() < 0.2)
        for _ in range(n)
    ]


def clusters(rows):
    seen = D.observations(rows, key=F.col("key"), id=F.col("id"), source=F.col("source"), published=F.col("published"))
    return D.components(seen).select("id", "component")


def full(spark, rows):
    """What all rows give: the greatest version of an id counts, the first to come of equal ones, but of one batch the greatest row."""
    last = {}
    for batch in rows:
        best = {}
        for r in batch:
            r = (r[0], r[1] or "", *r[2:])
            order = (r[4], r[1], r[2], r[3], r[5])
            if r[0] not in best or order > best[r[0]][0]:
                best[r[0]] = (order, r)
        for i, (_, r) in best.items():
            if i not in last or r[4] > last[i][4]:
                last[i] = r
    df = spark.createDataFrame([r for r in last.values() if not r[5]], SCHEMA)
    found = {r.id: r.component for r in clusters(df).collect()}
    return {i: (r[1], found.get(i)) for i, r in last.items() if not r[5]}


def held(state):
    return {r.id: (r.key, r.component) for r in state.collect() if not r.gone}


def test_batches(spark):
    rng = random.Random(3)
    batches = [edits(rng, n, v, 150) for v, n in enumerate((200, 30, 1, 40), 10)]
    seen = []

    def derive(rows):
        seen.append({r.key for r in rows.select("key").distinct().collect()})
        return clusters(rows)

    state = X.started(spark.createDataFrame(batches[0], SCHEMA), derive)
    for n, batch in enumerate(batches[1:], 2):
        state = X.refreshed(state, spark.createDataFrame(batch, SCHEMA), derive)
        assert held(state) == full(spark, batches[:n])
    assert len(seen[2]) <= 2  # one edit touches a key, or two


def test_nothing_changes(spark):
    state = X.started(spark.createDataFrame([("1", "a", "2026-01-01", "x", 5, False)], SCHEMA), clusters)
    none = spark.createDataFrame([], SCHEMA)
    late = spark.createDataFrame([("1", "b", "2026-01-01", "x", 5, True), (None, "b", "2026-01-01", "x", 9, False)], SCHEMA)
    assert held(X.refreshed(state, none, clusters)) == held(X.refreshed(state, late, clusters)) == {"1": ("a", "1")}
    assert held(X.started(none, clusters)) == {}


def test_stream(spark, tmp_path):
    rng = random.Random(4)
    batches = [edits(rng, n, v, 60) for v, n in enumerate((80, 20, 20), 10)]
    source, path = str(tmp_path / "in"), str(tmp_path / "state")
    assert X.current_state(spark, path) is None
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        X.keep_refreshed(spark.readStream.schema(SCHEMA).parquet(source), path, clusters, str(tmp_path / "marks")).awaitTermination()
        assert held(X.current_state(spark, path)) == full(spark, batches[: n + 1])
