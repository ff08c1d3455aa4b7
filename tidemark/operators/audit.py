"""Audit of merges (J-13): pairs that were perhaps missed, and merges that rest on little.

Observations that decide alike, with everything, are one class; pairs are made between classes and say for how many pairs
of observations they stand, so a key of many rows makes as many pairs as it has days and sources nearby, not the square of
its rows. Every pair comes from an equi-join with a band of days: by key, by company, or by a pair of keys that a join of
distinct keys alone has found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import MergeRules, decide
from tidemark.operators.relate import within_days
from tidemark.session import cut

MISSED, FALSE = "POSSIBLE_MISSED_DUPLICATE", "POSSIBLE_FALSE_MERGE"
# Reasons of missed pairs, the first that holds, and what merges are weak.
CONTAINMENT, CONCATENATION, PERMUTATION, COMPANY = "NAME_CONTAINMENT", "CONCATENATION", "PERMUTATION", "SHARED_COMPANY_ID"
WEAK = ("CANONICAL_NAME", "ALIAS", "CLAIM_REPORTED")
_ALIKE = ("key", "source", "named", "event", "best", "day", "threat", "recurs", "renamed")


def _named(rows: DataFrame) -> DataFrame:
    """Dated rows with `named`, whether the source gave them an id of its own."""
    return rows.filter("day is not null").withColumn("named", F.col("native") != "")


def audit_members(rows: DataFrame) -> DataFrame:
    """id, audit_class: the class of each dated observation, which is its smallest id."""
    dated = _named(rows)
    first = dated.groupBy(*_ALIKE).agg(F.min("id").alias("audit_class"))
    same = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in _ALIKE])
    return dated.alias("d").join(first.alias("f"), same).select("d.id", "audit_class")


def similar_keys(keys: DataFrame) -> DataFrame:
    """one, other (one < other), reason: keys of which one holds the other's words in a row, which differ by spaces alone,
    or by the order of words. `keys` has distinct non-empty keys in `key`; each meets only keys of a common form."""
    words = F.split("key", " ")
    rows = keys.select("key", F.size(words).alias("size"), words.alias("words"))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")),
        )
    )
    inner = rows.filter("size > 1").select(F.col("key").alias("long"), F.explode(F.array_distinct(spans)).alias("key"))
    held = inner.join(keys, "key").select(F.col("key").alias("a"), F.col("long").alias("b"), F.lit(1).alias("rank"))

    def meeting(form: Column, rank: int, apart: Column) -> DataFrame:
        formed = rows.select(form.alias("form"), "key", "size")
        left, right = formed.toDF("form", "a", "m"), formed.toDF("form", "b", "n")
        return left.join(right, "form").filter((F.col("a") < F.col("b")) & apart).select("a", "b", F.lit(rank).alias("rank"))

    glued = meeting(F.array_join("words", ""), 2, F.col("m") != F.col("n"))
    mixed = meeting(F.array_join(F.array_sort("words"), " "), 3, F.lit(True))
    found = held.unionByName(glued).unionByName(mixed).groupBy(F.least("a", "b").alias("one"), F.greatest("a", "b").alias("other"))
    reason = F.element_at(F.array(*[F.lit(r) for r in (CONTAINMENT, CONCATENATION, PERMUTATION)]), F.min("rank"))
    return found.agg(reason.alias("reason"))


def audit_pairs(rows: DataFrame, rules: MergeRules, companies: DataFrame | None = None, days: int = 14) -> DataFrame:
    """J-13: risk, reason, left_id, right_id (classes, named by their smallest ids), days_apart, company, pairs.

    Missed: at most `days` apart, no decision, and keys that are alike (of two sources) or belong to one company, which
    is the reason where both hold. False: merged by a weak reason, other than two rows of one source and URL. `pairs` counts
    the pairs of observations; a class whose own rows pair with each other stands on both sides. `rows` come from
    `observations`; undated rows are in no pair. `companies` has key, company. Repeated ids are rows of their own.
    """
    dated = _named(rows)
    classes = cut(dated.groupBy(*_ALIKE).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    empty = [F.lit("").alias(c) for c in ("native", "url")]
    told = classes.select("key", "day", F.struct(*classes.columns, *empty).alias("row"))

    def sides(extra: str = "key") -> tuple[DataFrame, DataFrame]:
        return told.select(extra, F.col("row").alias("a"), F.col("day").alias("a_day")), told.select(extra, F.col("row").alias("b"), F.col("day").alias("b_day"))

    a, b = F.col("a"), F.col("b")
    before = F.struct(a["best"], a["source"], a["id"]) < F.struct(b["best"], b["source"], b["id"])
    decidable = ~((a["source"] == b["source"]) & a["named"] & b["named"])
    verdict = decide(a, b, rules)

    left, right = sides()
    near = within_days(left.filter("key <> ''"), right, ["key"], "a_day", "b_day", days).filter(before & decidable)
    own = told.filter("row.n > 1 and not row.named and key <> ''").select("key", F.col("row").alias("a"), F.col("row").alias("b"))
    merged = near.select("key", "a", "b").unionByName(own).withColumn("verdict", verdict)
    weak = cut(merged.filter((F.col("verdict.action") == "MERGE") & F.col("verdict.reason").isin(*WEAK)).select("a", "b", "verdict.reason"))
    total = F.when(a["id"] == b["id"], F.col("a.n") * (F.col("a.n") - 1) / 2).otherwise(F.col("a.n") * F.col("b.n")).cast("long")
    weak = weak.withColumn("total", total)
    # rows of one source and URL are no finding: they are counted by class and URL, and taken off
    same = reduce(lambda x, y: x & y, [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in _ALIKE])
    urls = dated.filter("url <> ''").alias("d").join(classes.alias("c"), same).groupBy(F.col("c.id").alias("id"), "d.url").agg(F.count(F.lit(1)).alias("m"))
    urls = cut(urls)
    one = weak.filter(a["source"] == b["source"]).select(a["id"].alias("left_id"), b["id"].alias("right_id"))
    met = one.join(urls.select(F.col("id").alias("left_id"), "url", "m"), "left_id").join(urls.select(F.col("id").alias("right_id"), "url", F.col("m").alias("k")), ["right_id", "url"])
    each = F.when(F.col("left_id") == F.col("right_id"), F.col("m") * (F.col("m") - 1) / 2).otherwise(F.col("m") * F.col("k"))
    off = met.groupBy("left_id", "right_id").agg(F.sum(each).cast("long").alias("off"))
    apart = F.abs(F.datediff(b["day"], a["day"])).alias("days_apart")
    false = weak.select("reason", a["id"].alias("left_id"), b["id"].alias("right_id"), apart, "total").join(off, ["left_id", "right_id"], "left")
    false = false.select(
        F.lit(FALSE).alias("risk"), "reason", "left_id", "right_id", "days_apart", F.lit("").alias("company"), (F.col("total") - F.coalesce("off", F.lit(0))).alias("pairs")
    )

    alike = similar_keys(classes.select("key").filter("key <> ''").distinct())
    both = alike.select(F.col("one").alias("key"), "other", "reason").unionByName(alike.select(F.col("other").alias("key"), F.col("one").alias("other"), "reason"))
    led = left.join(both, "key").drop("key").withColumnRenamed("other", "key")
    lexical = within_days(led, right, ["key"], "a_day", "b_day", days).filter(before & (a["source"] != b["source"]))
    found = lexical.select("a", "b", "reason", F.lit("").alias("company"))
    if companies is not None:
        owned = companies.select("key", "company").filter("company <> ''").distinct()
        told = told.join(owned, "key")
        left, right = sides("company")
        shared = within_days(left, right, ["company"], "a_day", "b_day", days).filter(before & decidable & (a["key"] != b["key"]))
        found = found.unionByName(shared.select("a", "b", F.lit(COMPANY).alias("reason"), "company"))
    open_ = found.filter(verdict["action"] == "NO_DECISION").select(
        a["id"].alias("left_id"), b["id"].alias("right_id"), apart, "reason", "company", (F.col("a.n") * F.col("b.n")).alias("pairs")
    )
    best = F.max_by(F.struct("reason", "company"), F.struct(F.col("reason") == COMPANY, F.col("company")))
    missed = open_.groupBy("left_id", "right_id", "days_apart", "pairs").agg(best.alias("best"))
    missed = missed.select(F.lit(MISSED).alias("risk"), "best.reason", "left_id", "right_id", "days_apart", "best.company", "pairs")
    return missed.unionByName(false.filter("pairs > 0"))


def review_priority(risk: Column, reason: Column, days_apart: Column) -> Column:
    """O-05: 100 for a merge of a claim with its report, 90 to 99 for other false merges by how far apart they are, 70 for one
    company's pairs, 50 to 59 for other missed ones."""
    far = F.least(days_apart, F.lit(9))
    claimed = (reason == "CLAIM_REPORTED") | F.contains(reason, F.lit("RANSOMWARE"))
    missed = F.when(F.contains(reason, F.lit(COMPANY)), F.lit(70)).otherwise(50 + far)
    return F.when(risk == FALSE, F.when(claimed, F.lit(100)).otherwise(90 + far)).otherwise(missed).cast("long")


def review_queue(pairs: DataFrame) -> DataFrame:
    """O-05: the pairs of J-13 with their priority, in the order in which they are to be looked at."""
    rows = pairs.withColumn("priority", review_priority(F.col("risk"), F.col("reason"), F.col("days_apart")))
    return rows.orderBy(F.desc("priority"), "risk", "left_id", "right_id")
