"""Clusters kept up to date (I-05): only keys that a change touches are derived anew; the rest is taken as it was."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.facts import set_hash
from tidemark.session import cut

Derive = Callable[[DataFrame], DataFrame]


def snapshot_reuse(now: DataFrame, before: DataFrame, work: DataFrame, parts: list[str]) -> DataFrame:
    """I-05: one row: reusable, reason: whether a snapshot holds what the last one held and nothing waits to be worked on.

    Reasons: work_items_present, item_count_changed, items_hash_changed, exact_snapshot_match, the first that holds. `parts`
    are the columns that count; the order of rows does not.
    """
    new, old = (set_hash(df, *[F.col(p) for p in parts]) for df in (now, before))
    waiting = work.agg(F.count(F.lit(1)).alias("waiting"))
    # one row each
    all_ = waiting.crossJoin(new.select(F.col("rows").alias("n"), F.col("digest").alias("h"))).crossJoin(old)
    reason = F.when(F.col("waiting") > 0, "work_items_present").when(F.col("n") != F.col("rows"), "item_count_changed")
    reason = reason.when(F.col("h") != F.col("digest"), "items_hash_changed").otherwise("exact_snapshot_match")
    return all_.select((reason == "exact_snapshot_match").alias("reusable"), reason.alias("reason"))


def started(rows: DataFrame, derive: Derive, key: str = "key", id: str = "id") -> DataFrame:
    """I-05: the first state: rows (of id, key, version, gone and others) with their component."""
    empty = rows.limit(0).withColumn("component", F.lit(None).cast("string"))
    return refreshed(empty, rows, derive, key, id)


def refreshed(state: DataFrame, changes: DataFrame, derive: Derive, key: str = "key", id: str = "id") -> DataFrame:
    """I-05: the state after `changes`: what `derive` would give for all rows, though it sees touched keys only.

    `derive` takes rows and gives id, component, of each key by that key's rows alone. `changes` has the columns of the state
    but for component: a row replaces the one of its id if its `version` is greater (of equal ones the stored stays, among
    changes the greatest row), `gone` removes it. So late rows change nothing, in whatever order they come; rows that are
    gone stay in the state to tell so, without a component, like rows that `derive` leaves out. A row that changes its key
    touches both keys. Null ids are left out, null keys are blank.

    Of the state's untouched keys nothing is shuffled if the list of touched keys can be broadcast, which Spark measures.
    """
    fields = [c for c in state.columns if c not in (id, "component")]
    rest = [f for f in fields if f != "version"]
    whole = changes.filter(F.col(id).isNotNull()).withColumn(key, F.coalesce(F.col(key).cast("string"), F.lit("")))
    last = whole.groupBy(id).agg(F.max(F.struct("version", *rest)).alias("r")).select(id, "r.*")
    stored = state.select(id, F.col(key).alias("_key"), F.col("version").alias("_version")).join(last.select(id), id, "left_semi")
    news = cut(last.join(stored, id, "left").filter(F.col("_version").isNull() | (F.col("version") > F.col("_version"))))
    touched = cut(news.select(F.explode(F.array(F.col(key), F.coalesce("_key", F.col(key)))).alias(key)).distinct())

    kept = state.join(touched, key, "left_anti")
    others = state.join(touched, key, "left_semi").join(news.select(id), id, "left_anti").drop("component")
    again = cut(others.select(id, *fields).unionByName(news.select(id, *fields)))
    derived = derive(again.filter("NOT gone")).select(id, F.col("component").cast("string").alias("component"))
    return kept.select(id, *fields, "component").unionByName(again.join(derived, id, "left").select(id, *fields, "component"))


def keep_refreshed(changes: DataFrame, path: str, derive: Derive, checkpoint: str, key: str = "key", id: str = "id") -> StreamingQuery:
    """I-05 as a stream: each micro-batch of `changes` makes the next state, written under `path`/state-<batch>.

    A batch that runs again writes the same state, for it starts from that of an earlier batch. `current_state` reads the
    last one. A batch derives touched keys only, but writes the state as a whole; older states are left to be removed.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = current_state(spark, path, below=number)
        state = started(batch, derive, key, id) if before is None else refreshed(before, batch, derive, key, id)
        state.write.mode("overwrite").parquet(f"{path}/state-{number}")

    return changes.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_state(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The last state that was written to its end, of a batch `below` the given one; None before the first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state-*/_SUCCESS"))
    numbers = [int(f.getPath().getParent().getName().removeprefix("state-")) for f in found or ()]
    past = [n for n in numbers if below is None or n < below]
    return spark.read.parquet(f"{path}/state-{max(past)}") if past else None


def spells(rows: DataFrame, day: Column, gap: int) -> DataFrame:
    """id, component of rows with id and key: rows of a key at most `gap` days after the one before; named by the first id.

    A simple rule to derive by; D-02 is the other one.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy("_day", "id")
    marked = rows.filter("key <> ''").select("id", "key", day.alias("_day")).withColumn("_opens", F.coalesce(F.datediff("_day", F.lag("_day").over(w)) > gap, F.lit(True)))
    return marked.select("id", F.last(F.when(F.col("_opens"), F.col("id")), ignorenulls=True).over(w).alias("component"))
