"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key with its quality as the rate, so ascending keys within a source are a weighted
order without replacement. A source that is to give more than it holds gives complete epochs first; only the rest is
selected, as the head of that order whose prefix sum of sizes reaches the budget.

Prefix sums are made in two levels. Quantiles of a source's keys bound its ranges, of about `range_rows` documents in
the largest source (more where `max_ranges` of them do not suffice); the sums of the ranges are added up per source, and
only the one range in which a source's budget ends is ordered, with spilling. No task ever holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_quality(text: Column, size: Column) -> Column:
    """A weight in (0, 1]: 1 where words have 5 characters on average, less the further from it."""
    mean = F.coalesce(F.length(text), F.lit(0)) / F.greatest(size, F.lit(1))
    return 1.0 / (1.0 + F.abs(mean - 5.0) / 5.0)


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 of the key: any engine can repeat it."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_targets(totals: DataFrame, max_epochs: int = 3, weight: Column | None = None) -> DataFrame:
    """`totals` (source, n_docs, source_size) with `target`: shares of all sizes by weight, none above max_epochs sizes.

    Sources by code point, null last, weigh 1, 2, 3, repeating, unless `weight` says otherwise. Capped sources are those
    with the smallest size for their weight; taking them in that order, the level that the others share only rises.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("_w", weight if weight is not None else 1 + (F.row_number().over(by_name) - 1) % 3)
    ranked = ranked.withColumn("_cap", (max_epochs * F.col("source_size")).cast("double"))
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_w").over(onward)
    ranked = ranked.withColumn("_level", level).withColumn("_at", F.row_number().over(order))
    first = F.min(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.struct("_at", "_level"))).over(everything)
    ranked = ranked.withColumn("_first", first)
    ranked = ranked.withColumn("_open", F.coalesce(F.col("_at") >= F.col("_first._at"), F.lit(False)))
    shared = F.col("_first._level")
    return ranked.withColumn(
        "target", F.when(F.col("_open"), F.least(F.col("_cap"), shared * F.col("_w"))).otherwise(F.col("_cap"))
    ).drop("_w", "_cap", "_level", "_at", "_first", "_open")


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    quality: Column | None = None,
    max_epochs: int = 3,
    seed: str = "mix",
    range_rows: int = 50_000,
    max_ranges: int = 1000,
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, key, epochs, taken.

    `taken` counts the words that the mix takes of the document, repeats included. A source's total comes within half
    a document of its target. Null sources are one source; null or empty texts have size 0 and take nothing; rows with
    equal keys go by id and size, so repeated rows and reruns agree. An empty table gives an empty result.
    """
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_text"),
    ).withColumn("size", word_count(F.col("_text")))
    rate = quality if quality is not None else length_quality(F.col("_text"), F.col("size"))
    keyed = slim.withColumn("key", -F.log(uniform(F.col("doc_id"), seed)) / rate).drop("_text")
    keyed = cut(keyed)

    totals = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    targets = source_targets(totals, max_epochs)
    targets = targets.withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("long"),
    ).withColumn("_rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    targets = cut(targets.withColumnRenamed("source", "_source"))
    largest = targets.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0]
    steps = max(1, min(max_ranges, -(-largest // range_rows)))
    keyed = keyed.join(
        measured_broadcast(targets), F.col("source").eqNullSafe(F.col("_source")), "inner"
    ).drop("_source")

    # Range bounds are quantiles of a source's keys, so ranges are even whatever the qualities are.
    if steps == 1:
        ranged = keyed.withColumn("_range", F.lit(0).cast("long"))
    else:
        shares = [i / steps for i in range(1, steps)]
        bounds = keyed.groupBy("source").agg(F.percentile_approx("key", shares, 10 * steps).alias("_bounds"))
        # In groups of 32, so that a key is compared with the last bound of each group, then with the bounds of one.
        starts = F.array(*[F.lit(i) for i in range(1, steps, 32)])
        groups = F.transform(starts, lambda i: F.slice("_bounds", i, F.lit(32)))
        bounds = cut(bounds.select(F.col("source").alias("_source"), groups.alias("_bounds")))
        ranged = keyed.join(measured_broadcast(bounds), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        ranged = ranged.withColumn("_group", F.size(F.filter("_bounds", lambda g: F.element_at(g, -1) < F.col("key"))))
        inside = F.size(F.filter(F.coalesce(F.get("_bounds", F.col("_group")), F.array()), lambda q: q < F.col("key")))
        ranged = ranged.withColumn("_range", (F.col("_group") * 32 + inside).cast("long")).drop("_bounds", "_group")
    sums = ranged.groupBy("source", "_range").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"))
    along = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
    sums = sums.withColumn(
        "_state",
        F.when(F.col("_before") + F.col("_sum") <= F.col("_rest"), "in")
        .when(F.col("_before") > F.col("_rest"), "out")
        .otherwise("cut"),
    )
    sums = cut(sums.select(F.col("source").alias("_source"), F.col("_range").alias("_r"), "_before", "_state"))
    ranged = ranged.join(
        measured_broadcast(sums), F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r"))
    ).drop("_source", "_r")

    whole = ranged.filter(F.col("_state") != "cut").withColumn("_picked", F.col("_state") == "in")
    inside = Window.partitionBy("source", "_range").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = ranged.filter(F.col("_state") == "cut").withColumn(
        "_picked", F.col("_before") + F.sum("size").over(inside) - F.col("size") / 2 <= F.col("_rest")
    )
    taken = F.col("epochs") * F.col("size") + F.when(F.col("_picked"), F.col("size")).otherwise(0)
    return whole.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target", "key", "epochs", taken.alias("taken")
    )
