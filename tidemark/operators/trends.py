"""Trend signals over two neighbouring periods (P-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import half_even, pct_change, ratio
from tidemark.operators.aggregate import period_counts


def confidence(n: Column, multi: Column, known: Column, fields: Column | float = 1.0) -> Column:
    """P-01: 0 to 100 from volume, the share with several sources and the share of fields that are known.

    That share is `known` of `fields`. Its weight is applied before the division: the other way round, scores that lie half
    way between two numbers miss it by the last binary place.
    """
    shared = ratio(multi, n)
    return half_even(100 * (0.55 * F.least(F.lit(1.0), n / 12.0) + 0.25 * shared + 0.20 * known / fields)).cast("long")


def base_rate(current: Column, previous: Column) -> Column:
    """P-02: change of everything in percent, null below 10 before or 20 now."""
    return F.when((previous >= 10) & (current >= 20), half_even((current - previous) * 100.0 / previous, 1))


def dimension_signals(
    df: DataFrame, day: str, as_of: Column, days: list[int], label: str, *, multi: Column | None = None, known_fields: Column | None = None, fields: int = 1,
    unknown: str = "Inconnu", least: int = 3, delta: int = 2, change: float = 50.0, max_share: float = 60.0, excess: float = 25.0,
) -> DataFrame:
    """P-03: labels that grow: days, label, kind, now, before, delta, change, share, base_rate, excess, score.

    At least `least` rows now, `delta` more than before, and `change` percent up if there were any before. Where the change
    of all rows is known (P-02), labels with more than `max_share` percent of them are no signal, nor are those that grow
    less than `excess` points faster. A label that was not there before has grown by 100 percent. Rows without a label, or
    of an `unknown` one, count in the totals only. `multi` tells rows of several sources and `known_fields` how many of
    `fields` are known, for the score (P-01). One pass over the rows gives labels and totals.
    """
    told = F.coalesce(F.trim(F.col(label)), F.lit(""))
    named = F.when(~told.isin("", unknown), F.col(label))
    age = F.datediff(as_of, F.col(day))
    rows = df.select(
        age.alias("_age"), named.alias("label"), F.coalesce(multi if multi is not None else F.lit(False), F.lit(False)).alias("_multi"),
        F.coalesce(known_fields if known_fields is not None else F.lit(0), F.lit(0)).alias("_known"),
    ).filter((F.col("_age") >= 0) & (F.col("_age") < 2 * max(days)))
    rows = rows.withColumn("days", F.explode(F.array(*[F.lit(d).cast("long") for d in days]))).filter(F.col("_age") < 2 * F.col("days"))
    in_now = F.col("_age") < F.col("days")
    counts = rows.groupBy("days", "label").agg(
        F.count_if(in_now).alias("now"), F.count_if(~in_now).alias("before"), F.count_if(in_now & F.col("_multi")).alias("_multi"),
        F.sum(F.when(in_now, F.col("_known")).otherwise(0)).alias("_known"),
    )
    totals = counts.groupBy("days").agg(F.sum("now").alias("total"), F.sum("before").alias("_past"))
    # one row for each of the given window lengths
    c = counts.filter("label IS NOT NULL").join(F.broadcast(totals), "days")
    now, before, base = F.col("now"), F.col("before"), F.col("base_rate")
    c = c.withColumns({
        "delta": now - before, "change": pct_change(now, before), "base_rate": base_rate(F.col("total"), F.col("_past")), "share": ratio(now, F.col("total"), 1, 100.0),
        "kind": F.when(before == 0, "emerging").otherwise("acceleration"), "score": confidence(now, F.col("_multi"), F.col("_known"), now * fields),
    })
    c = c.withColumn("excess", half_even(F.col("change") - base, 1))
    grown = (now >= least) & (F.col("delta") >= delta) & ((before == 0) | (F.col("change") >= change))
    apart = base.isNull() | ((F.col("share") <= max_share) & (F.col("excess") >= excess))
    return c.filter(grown & apart).select("days", "label", "kind", "now", "before", "delta", "change", "share", "base_rate", "excess", "score")


def new_pairs(df: DataFrame, day: str, as_of: Column, days: list[int], first: str, second: str, *, least: int = 3) -> DataFrame:
    """P-04: pairs of labels with at least `least` rows now and none in the period before."""
    c = period_counts(df, day, as_of, days, first, second)
    return c.filter((F.col("current") >= least) & (F.col("previous") == 0)).select("days", first, second, F.col("current").alias("now"))
