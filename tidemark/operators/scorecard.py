"""What each source is worth (A-12), from its items, the incidents it tells of and its latest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import best_date, efficiency_score, freshness_score, grade, half_even, ratio, weighted_score
from tidemark.operators.aggregate import last_n

# Weights of reliability, freshness, completeness, exclusive share and items a call.
WEIGHTS = (30.0, 20.0, 20.0, 20.0, 10.0)


def _pct(part: Column, total: Column) -> Column:
    return ratio(part, total, 1, 100.0)


def contributions(incidents: DataFrame, sources: str) -> DataFrame:
    """source, touched, exclusive, corroborated: incidents whose list ("a | b") names a source, alone or with others."""
    named = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(F.col(sources), F.lit("")), r"\|"), lambda s: F.trim(s)), lambda s: s != ""))
    each = incidents.select(F.explode(named).alias("source"), F.size(named).alias("n"))
    alone, n = F.count_if(F.col("n") == 1), F.count(F.lit(1))
    return each.groupBy("source").agg(n.alias("touched"), alone.alias("exclusive"), (n - alone).alias("corroborated"))


def scorecard(active: DataFrame, items: DataFrame, incidents: DataFrame, runs: DataFrame, as_of: Column, *, recent: int = 10, unknown: str = "Inconnu") -> DataFrame:
    """A-12: one row per source of `active`, with its measures, value index, grade and warnings.

    `items` has source, key, event, published (ISO text), threat, sector, location; `incidents` has sources; `runs` has
    source, as_of, run_id, status, duration_s, calls, collected, of which the `recent` latest ones of a source count. Parts
    of the index that are not known (reliability without runs) leave their weight to the others. A source without items,
    incidents or runs keeps its row. Everything but the latest runs is one aggregation with partial sums.
    """
    day = F.substring(best_date(F.col("event"), F.col("published")), 1, 10).try_cast("date")
    lacking = {f: F.count_if(F.col(f) == unknown).alias(f"{f}_unknown") for f in ("threat", "sector", "location")}
    known_key = F.nullif(F.col("key").cast("string"), F.lit(""))
    told = items.groupBy("source").agg(F.count(F.lit(1)).alias("items"), F.countDistinct(known_key).alias("organisations"), F.max(day).alias("latest"), *lacking.values())
    state = {s: F.count_if(F.col("status") == s.upper()).alias(f"{s}_runs") for s in ("ok", "partial", "fail")}
    history = last_n(runs, "source", ["as_of", "run_id"], recent).groupBy("source").agg(
        F.count(F.lit(1)).alias("recent_runs"), *state.values(), (F.rint(F.avg(F.coalesce("duration_s", F.lit(0.0))) * 100) / 100).alias("avg_duration_s"),
        F.sum("calls").alias("calls"), F.sum("collected").alias("collected"),
    )
    rows = active.select("source").distinct()
    for part in (told, contributions(incidents, "sources"), history):
        rows = rows.join(part, "source", "left")
    rows = rows.na.fill(0).withColumn("avg_duration_s", F.coalesce("avg_duration_s", F.lit(0.0)))

    c = F.col
    rows = rows.withColumns({
        "freshness_days": F.datediff(as_of, c("latest")).cast("long"), "exclusive_share_pct": _pct(c("exclusive"), c("touched")),
        "reliability_pct": F.when(c("recent_runs") > 0, _pct(c("ok_runs"), c("recent_runs"))), "items_per_call": ratio(c("collected"), c("calls"), 3),
        **{f"{f}_unknown_pct": _pct(c(f"{f}_unknown"), c("items")) for f in lacking},
        "completeness_pct": F.when(c("items") > 0, half_even(100.0 * (1.0 - sum((ratio(c(f"{f}_unknown"), c("items")) for f in lacking), F.lit(0.0)) / 3), 1)).otherwise(0.0),
    })
    parts = (c("reliability_pct"), freshness_score(c("freshness_days")), c("completeness_pct"), c("exclusive_share_pct"), efficiency_score(c("items_per_call")))
    rows = rows.withColumn("value_index", weighted_score(list(zip(parts, WEIGHTS, strict=True))))
    warned = {
        "no_items": c("items") == 0, "stale_over_30d": c("freshness_days") > 30, "reliability_below_80pct": c("reliability_pct") < 80,
        "threat_unknown_over_25pct": c("threat_unknown_pct") > 25, "sector_unknown_over_50pct": c("sector_unknown_pct") > 50,
        "location_unknown_over_50pct": c("location_unknown_pct") > 50, "no_exclusive_incident": (c("touched") > 0) & (c("exclusive") == 0),
    }
    warnings = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in warned.items()]))
    return rows.select(
        "source", "value_index", grade(c("value_index")).alias("grade"), "items", "touched", "exclusive", "corroborated", "exclusive_share_pct", "organisations",
        F.coalesce(c("latest").cast("string"), F.lit("")).alias("latest_day"), "freshness_days", "recent_runs", "ok_runs", "partial_runs", "fail_runs",
        "reliability_pct", "avg_duration_s", "items_per_call", *[f"{f}_unknown_pct" for f in lacking], "completeness_pct", warnings.alias("warnings"),
    )
