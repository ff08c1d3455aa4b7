"""Queries of clusters kept up to date (I-05): events as rows of their users, then edits of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import delta as X
from tidemark.plans.registry import query

_GAP = 3


def _rows(e: DataFrame, key: Column, version: Column, gone: Column) -> DataFrame:
    return e.select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"), key.cast("string").alias("key"), F.to_date("ts").alias("day"), version.cast("long").alias("version"), gone.alias("gone"))


def _spells(rows: DataFrame) -> DataFrame:
    return X.spells(rows, F.col("day"), _GAP)


@query(
    "I05_refreshed_clusters",
    f"""WITH r AS (SELECT lpad(event_id::VARCHAR, 12, '0') AS id, CASE WHEN event_id % 101 = 1 THEN user_id + 1 ELSE user_id END::VARCHAR AS key, ts::DATE AS day FROM events WHERE event_id % 101 <> 2),
    o AS (SELECT *, coalesce(date_diff('day', lag(day) OVER w, day) > {_GAP}, true) AS opens FROM r WINDOW w AS (PARTITION BY key ORDER BY day, id))
    SELECT id, key, last_value(CASE WHEN opens THEN id END IGNORE NULLS) OVER (PARTITION BY key ORDER BY day, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS component FROM o""",
    "events",
)
def _i05(e: DataFrame) -> DataFrame:
    """All but every hundred-and-first event, then these, of which some move to another user, some go, and some come too late."""
    k, no = F.col("event_id"), F.lit(False)
    first = e.filter(k % 101 != 0)
    state = X.started(_rows(first, F.col("user_id"), F.lit(2), no), _spells)
    new = _rows(e.filter(k % 101 == 0), F.col("user_id"), F.lit(1), no)
    moved = _rows(e.filter(k % 101 == 1), F.col("user_id") + 1, F.lit(3), no)
    gone = _rows(e.filter(k % 101 == 2), F.col("user_id"), F.lit(4), F.lit(True))
    late = _rows(e.filter(k % 101 == 3), F.col("user_id") + 5, F.lit(1), no)
    changes = new.unionByName(moved).unionByName(gone).unionByName(late)
    return X.refreshed(state, changes, _spells).filter("NOT gone").select("id", "key", "component")


@query(
    "I05_snapshot_reuse",
    "SELECT * FROM (VALUES ('same', true, 'exact_snapshot_match'), ('work', false, 'work_items_present'), ('fewer', false, 'item_count_changed'), ('other', false, 'items_hash_changed')) t(name, reusable, reason)",
    "orders",
)
def _i05_reuse(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    base, none = o.select("o_orderkey", "o_orderstatus"), o.select("o_orderkey").filter("o_orderkey IS NULL")
    first = o.agg(F.min("o_orderkey").alias("m"))
    cases = {
        "same": (base.orderBy(F.desc("o_orderkey")), none), "work": (base, first), "fewer": (base.filter(k % 2 == 0), none),
        "other": (base.join(F.broadcast(first), k == F.col("m"), "left").select("o_orderkey", F.when(F.col("m").isNotNull(), "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")), none),
    }
    out = [X.snapshot_reuse(now, base, work, base.columns).select(F.lit(name).alias("name"), "reusable", "reason") for name, (now, work) in cases.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
