"""Classification by ordered phrase tables (K-*), and arbitration of what several rules say (Q-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import any_of, contains_words, searchable

Rules = tuple[tuple[str, tuple[str, ...]], ...]

# How far an origin's decision stands back behind others, and where an origin stands that is not among them.
ORIGINS = {
    "SOURCE_NATIVE": 0, "MANUAL_REFERENCE": 10, "OFFICIAL_SUBJECT_ACTIVITY": 15, "STRUCTURED_SOURCE": 20, "ORG_CONTEXT_SECTOR": 30,
    "ORG_SECTOR_REGISTRY": 40, "SAFE_NAME_RULE": 50, "OFFLINE_BACKFILL": 60, "THREAT_STABILIZATION": 70, "LLM_SOURCE_FALLBACK": 90,
}
LAST = 999


def first_class(text: Column, rules: Rules, *, default: Column | None = None, masked: str | None = None, unknown: str = "Unknown") -> Column:
    """K-01, K-03: the first label, in the order of `rules`, of which a phrase stands in the text, by whole words.

    `masked` is a regex of negations that are taken out before; without any match `default` counts, else `unknown`.
    """
    blob = searchable(text)
    if masked:
        blob = F.trim(F.regexp_replace(F.regexp_replace(blob, masked, " "), r"\s+", " "))
    out = F.lit(None).cast("string")
    for label, phrases in reversed(rules):
        out = F.when(any_of([contains_words(blob, p) for p in phrases]), label).otherwise(out)
    return F.coalesce(out, default if default is not None else F.lit(None), F.lit(unknown))


def first_of(texts: list[Column], rules: Rules, unknown: str = "Unknown") -> Column:
    """K-03: texts one by one, in order; the first that has a class decides."""
    return F.coalesce(*[F.nullif(first_class(t, rules, unknown=unknown), F.lit(unknown)) for t in texts], F.lit(unknown))


def arbitrate(decisions: DataFrame, by: list[str], origins: dict[str, int] = ORIGINS, ties: tuple[str, ...] = ()) -> DataFrame:
    """Q-03, Q-04: of applied decisions on a field the most trusted origin's wins, ties by origin, value, then `ties`; the others are rejected.

    `decisions` has `by`, origin, value, decision.
    """
    ranks = F.create_map(*[F.lit(x) for pair in origins.items() for x in pair])
    rows = decisions.withColumn("precedence", F.coalesce(F.element_at(ranks, F.col("origin")), F.lit(LAST)))
    w = Window.partitionBy(*by, "decision").orderBy("precedence", "origin", "value", *ties)
    rows = rows.withColumn("_at", F.row_number().over(w))
    lost = (F.col("decision") == "APPLIED") & (F.col("_at") > 1)
    return rows.withColumn("decision", F.when(lost, "REJECTED_LOWER_PRIORITY").otherwise(F.col("decision"))).drop("_at")


def consensus(evidence: DataFrame, key: str, label: str) -> DataFrame:
    """Q-05, Q-06, Q-10: per key AUTO with one label from several sources, REVIEW with one from one, CONFLICT with more."""
    c = evidence.groupBy(key).agg(
        F.countDistinct(label).alias("labels"), F.countDistinct("source").alias("sources"), F.min(label).alias("lo"), F.count(F.lit(1)).alias("n")
    )
    status = F.when(F.col("labels") > 1, "CONFLICT").when(F.col("sources") > 1, "AUTO").otherwise("REVIEW")
    return c.select(key, F.when(F.col("labels") == 1, F.col("lo")).alias(label), status.alias("status"), "n", "sources")


def dirty_set(now: DataFrame, before: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """I-02: key, state (NEW, DIRTY, UNCHANGED) of the rows of now."""
    old = before.select(key, F.col(fingerprint).alias("_old"), F.lit(True).alias("_was"))
    state = F.when(F.col("_was").isNull(), "NEW").when(F.col(fingerprint).eqNullSafe(F.col("_old")), "UNCHANGED").otherwise("DIRTY")
    return now.select(key, fingerprint).join(old, key, "left").select(key, state.alias("state"))
