"""Aggregations (A-*), window and rank operators (W-*, O-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import half_even, known
from tidemark.session import cut

UNKNOWN = "Unknown"


def count_by(df: DataFrame, label: Column, unknown: str = UNKNOWN) -> DataFrame:
    """A-01: label, n; missing labels count as `unknown`."""
    name = F.coalesce(F.nullif(label, F.lit("")), F.lit(unknown))
    return df.groupBy(name.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def top_labels(counts: DataFrame, k: int, *by: str) -> DataFrame:
    """O-03: the k largest counts (per `by`), ties by label, with their rank."""
    w = Window.partitionBy(*by).orderBy(F.desc("n"), "label")
    return counts.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def entropy(df: DataFrame, label: str, *by: str) -> DataFrame:
    """A-03: Shannon entropy of known labels over its largest value, 3 places; 0 with one label or none."""
    counts = df.filter(known(F.col(label))).groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))
    h = counts.groupBy(*by).agg((-F.sum(F.col("p") * F.log2("p"))).alias("h"), F.count(F.lit(1)).alias("k"))
    return h.select(*by, F.when(F.col("k") > 1, half_even(F.col("h") / F.log2("k"), 3)).otherwise(0.0).alias("entropy"))


def ordered_places(df: DataFrame, by: str, value: str, **shares: float) -> DataFrame:
    """A-19: by, n, largest, and for each of `shares` the value at place min(n - 1, floor(share * n)) in ascending order.

    Null values do not count, and groups of nulls alone are left out. Equal values are one row with their number before
    they are sorted, and no group is gathered: a sort of distinct values finds the place.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(by)
    upto = counts.withColumns({"_upto": F.sum("_n").over(group.orderBy(value)), "n": F.sum("_n").over(group)})

    def at(share: float) -> Column:
        place = F.least(F.col("n") - 1, F.floor(F.col("n") * share))
        return F.min(F.when(F.col("_upto") > place, F.col(value)))

    return upto.groupBy(by).agg(F.max("n").alias("n"), F.max(value).alias("largest"), *[at(share).alias(name) for name, share in shares.items()])


def unpivot_coverage(df: DataFrame, source: str, fields: list[str], everything: str = "ALL") -> DataFrame:
    """A-09: source (ALL too), field, items, known, unknown, coverage_pct; one pass over grouping sets."""
    spans = [F.count_if(known(F.col(f))).alias(f) for f in fields]
    sets = df.groupingSets([[], [F.col(source)]], F.col(source)).agg(
        F.grouping(source).alias("_all"), F.count(F.lit(1)).alias("items"), *spans
    )
    sets = sets.withColumn(source, F.when(F.col("_all") == 1, everything).otherwise(F.col(source)))
    rows = sets.unpivot([source, "items"], fields, "field", "known")
    share = half_even(100.0 * F.col("known") / F.col("items"), 1)
    return rows.select(source, "field", "items", "known", (F.col("items") - F.col("known")).alias("unknown"), share.alias("coverage_pct"))


def strict_mode(df: DataFrame, by: str, label: str, fallback: str) -> DataFrame:
    """D-07: the commonest known label of a group, `fallback` on a tie or where none is known."""
    counts = df.filter(known(F.col(label))).groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("top", F.max("n").over(Window.partitionBy(by))).filter("n = top")
    best = ranked.groupBy(by).agg(F.when(F.count(F.lit(1)) == 1, F.min(label)).alias("best"))
    return df.select(by).distinct().join(best, by, "left").select(by, F.coalesce("best", F.lit(fallback)).alias(label))


def majority(df: DataFrame, by: str, label: str, fallback: str) -> DataFrame:
    """D-06: the commonest known label of a group, the smallest on a tie, `fallback` where none is known."""
    counts = df.filter(known(F.col(label))).groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(by).agg(F.min(F.struct((-F.col("n")).alias("n"), label)).alias("b"))
    groups = df.select(by).distinct()
    return groups.join(best, by, "left").select(by, F.coalesce(F.col(f"b.{label}"), F.lit(fallback)).alias(label))


def last_n(df: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """W-03: the n latest rows of each group."""
    w = Window.partitionBy(by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= n).drop("_at")


def latest(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """W-07, W-09, W-10: the latest row of each group; aggregation of one struct, no sort of the group."""
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*by, *[F.col(f"_r.{c}").alias(c) for c in rest])


def period_counts(df: DataFrame, day: str, as_of: Column, days: list[int], *by: str) -> DataFrame:
    """W-01, W-02: per window length, rows of the period that ends on `as_of` and of the one before it, in one pass."""
    age = F.datediff(as_of, F.col(day))
    rows = df.withColumn("_age", age).filter((F.col("_age") >= 0) & (F.col("_age") < 2 * max(days)))
    rows = rows.withColumn("days", F.explode(F.array(*[F.lit(d) for d in days]))).filter(F.col("_age") < 2 * F.col("days"))
    return rows.groupBy(*by, F.col("days").cast("long").alias("days")).agg(
        F.count_if(F.col("_age") < F.col("days")).alias("current"), F.count_if(F.col("_age") >= F.col("days")).alias("previous")
    )


def gaps(df: DataFrame, by: str, day: str) -> DataFrame:
    """W-04: per group, the upper median and the largest gap between neighbouring distinct days."""
    w = Window.partitionBy(by).orderBy(day)
    rows = df.select(by, day).distinct().withColumn("gap", F.datediff(F.col(day), F.lag(day).over(w)).cast("long"))
    return ordered_places(rows, by, "gap", median_gap=0.5).select(by, "median_gap", F.col("largest").alias("max_gap"))


def drift(history: DataFrame, by: str, order: str, value: str, lookback: int = 5, drop: float = 2.0) -> DataFrame:
    """W-06: mean of up to `lookback` earlier values, and whether the value fell at least `drop` below it."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-lookback, -1)
    rows = history.withColumn("baseline", half_even(F.avg(value).over(w), 4))
    return rows.withColumn("drifted", F.coalesce(F.col("baseline") - F.col(value) >= drop, F.lit(False)))


def month_spine(df: DataFrame, day: str, cap: int = 36) -> DataFrame:
    """W-08: all months from the first to the last, at most the last `cap`."""
    ends = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    first = F.greatest(F.trunc("lo", "month"), F.add_months(F.trunc("hi", "month"), 1 - cap))
    months = F.sequence(first, F.trunc("hi", "month"), F.expr("interval 1 month"))
    return ends.select(F.explode(months).alias("month"))


def round_robin(df: DataFrame, stratum: str, key: str, n: int) -> DataFrame:
    """W-11: n rows, one of each stratum in turn, within a stratum by hash of the key."""
    w = Window.partitionBy(stratum).orderBy(F.sha2(F.col(key).cast("string"), 256))
    # no stratum gives more than n, so no more of one is sorted
    rows = df.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= n)
    return rows.withColumn("turn", F.col("turn").cast("long")).orderBy("turn", stratum).limit(n)


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """O-09: rows of a page, the first being 1."""
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """O-07: numbers all rows along `order` from 1, as `name`: within ranges of it, each after the rows of the ranges before."""
    placed = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = sizes.select(F.col("_part").alias("_p"), F.col("_n").alias("_m"))
    before = sizes.join(F.broadcast(earlier), F.col("_p") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.join(F.broadcast(before), "_part").withColumn(name, (place + F.col("_before")).cast("long")).drop("_part", "_before")


def first_ids(df: DataFrame, by: str, id: str, most: int = 12) -> DataFrame:
    """O-10: by, ids: the `most` smallest distinct ids of a group, in order; only these are ever gathered."""
    w = Window.partitionBy(by).orderBy(id)
    few = df.filter(F.col(id).isNotNull()).select(by, id).distinct().withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= most)
    return few.groupBy(by).agg(F.array_sort(F.collect_list(id)).alias("ids"))
