"""What sentences and titles tell: victims, counts, data types (X-03, X-05, X-10...X-12), and queues, audits and the cascade around them (A-*, J-13, O-06, Q-01, R-*, W-13)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.functions.text import searchable, strip_accents
from tidemark.functions.values import half_even
from tidemark.operators.classify import arbitrate
from tidemark.operators.entities import mutations
from tidemark.operators.rules import modality
from tidemark.session import cut, measured_broadcast


def known_entities(texts: DataFrame, entities: DataFrame, id: str, blob: str) -> DataFrame:
    """X-05: id, label: the longest known key that stands in a searchable text between word boundaries, ties by key.

    `entities` has key (searchable) and label. Texts and keys meet by the key's words: a text's runs of as many words as
    any key has are joined with the keys, so that no text is compared with all keys. The keys are a bounded table of entities,
    of which the driver reads the first words.
    """
    keys = cut(entities.withColumn("words", F.size(F.split("key", " "))).filter("key <> ''"))
    widths = [r.words for r in keys.select("words").distinct().collect()]
    words = texts.select(id, F.split(blob, " ").alias("w"))
    # Only runs that start with a key's first word can be a key.
    first = F.array_sort(F.lit([r.w for r in keys.select(F.split_part("key", F.lit(" "), F.lit(1)).alias("w")).distinct().collect()])) if widths else None

    def runs_of(n: int) -> DataFrame:
        starts = F.filter(F.transform("w", lambda w, i: F.when(F.array_contains(first, w), i + 1)), lambda i: i.isNotNull())
        return words.select(id, F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("key")).distinct()

    runs = [runs_of(n) for n in sorted(widths)]
    if not runs:
        return texts.select(id, F.lit(None).cast("string").alias("label"))
    met = reduce(DataFrame.unionByName, runs).join(measured_broadcast(keys), "key")
    best = met.groupBy(id).agg(F.min_by("label", F.struct(-F.length("key"), F.col("key"))).alias("label"))
    return texts.select(id).join(best, id, "left")


def count_phrase(text: Column) -> Column:
    """X-10: struct of value, unit and phrase of the first count whose unit is known; null without one."""
    pattern = r"(?i)(?:\d[\d\s .,]*\d|\d)\s*(?:millions?|milliers?|mille)?\s*(?:de\s+|d['’])?\s*[a-zàâäéèêëïîôöùûüç]+"
    units = F.create_map(*[F.lit(x) for pair in P.COUNT_UNITS.items() for x in pair])

    def parsed(m: Column) -> Column:
        number = F.regexp_replace(F.regexp_extract(m, r"^(\d[\d\s .,]*\d|\d)", 1), r"\s", "")
        scale = F.lower(F.regexp_extract(m, r"(?i)^[\d\s .,]+(million|millier|mille)", 1))
        unit = F.element_at(units, F.lower(strip_accents(F.regexp_extract(m, r"([^\s'’]+)$", 1))))
        scaled = F.round(F.replace(number, F.lit(","), F.lit(".")).try_cast("double") * F.when(scale == "million", 1_000_000).otherwise(1_000)).cast("long")
        value = F.when(scale != "", scaled).otherwise(F.regexp_replace(number, "[.,]", "").try_cast("long"))
        return F.struct(value.alias("value"), unit.alias("unit"), F.trim(m).alias("phrase"))

    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)), parsed)
    return F.get(F.filter(found, lambda x: x["unit"].isNotNull() & x["value"].isNotNull()), 0)


def sentences(texts: DataFrame, id: str, text: str) -> DataFrame:
    """id, at, sentence of every sentence, in order."""
    parts = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s) != "")
    return texts.select(id, F.posexplode(parts).alias("at", "sentence"))


def data_types(texts: DataFrame, id: str, text: str) -> DataFrame:
    """X-12: id, value, status, evidence: data types of sentences that tell of an incident, each value and status once, the first."""
    rows = sentences(texts, id, text).filter(F.col("sentence").rlike("(?i)" + P.TYPE_TRIGGER))
    named = F.array_compact(F.array(*[F.when(F.col("sentence").rlike("(?i)" + pattern), F.lit(label)) for label, pattern in P.DATA_TYPES]))
    rows = rows.withColumn("status", modality(F.col("sentence"))).select(id, "at", "sentence", "status", F.explode(named).alias("value"))
    return rows.groupBy(id, "value", "status").agg(F.substring(F.min_by("sentence", "at"), 1, 420).alias("evidence"))


Step = Callable[[DataFrame], DataFrame]


def cascade(items: DataFrame, key: str, fields: list[str], steps: list[tuple[str, Step]]) -> tuple[DataFrame, DataFrame]:
    """Q-01: items after all steps, in order, and the decisions: what each step changed, of each field only the most trusted applied.

    A step is an origin and a function from items to items; every layer sees what the ones before it have set.
    """
    made = []
    for origin, step in steps:
        after = cut(step(items))
        made.append(mutations(items, after, key, fields, origin))
        items = after
    decisions = reduce(DataFrame.unionByName, made)
    return items, arbitrate(decisions, [key, "field"])


def outcome_counts(rows: DataFrame, by: list[str], applied: Column, right: Column, was_right: Column) -> DataFrame:
    """A-11, A-28: per group the applied decisions, their precision, gains (wrong before, right now) and regressions."""
    n = F.count_if(applied)
    return rows.groupBy(*by).agg(
        n.alias("applied"), half_even(100.0 * F.count_if(applied & right) / F.nullif(n, F.lit(0)), 1).alias("precision"),
        F.count_if(applied & right & ~was_right).alias("gains"), F.count_if(applied & ~right & was_right).alias("regressions"),
    )


def coverage_groups(sources: DataFrame, outcomes: DataFrame, group: str, source: str, status: str) -> DataFrame:
    """A-16, G-12: per group the expected, collected and blind sources (PARTIAL, FAIL or without an outcome)."""
    joined = sources.join(outcomes.select(source, status), source, "left")
    ok = F.col(status) == "OK"
    return joined.groupBy(group).agg(F.count(F.lit(1)).alias("expected"), F.count_if(ok).alias("collected"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("blind"))


def usage(calls: DataFrame, task: str, ok: Column, tokens: Column, price: float) -> DataFrame:
    """A-33, C-22: per task the calls, successes in percent, tokens and their cost at `price` for a million."""
    n = F.count(F.lit(1))
    return calls.groupBy(task).agg(
        n.alias("calls"), half_even(100.0 * F.count_if(ok) / n, 1).alias("ok_pct"), F.sum(tokens).alias("tokens"), half_even(F.sum(tokens) * price / 1_000_000, 6).alias("cost")
    )


def queue_rows(queue: DataFrame, cache: DataFrame, key: str, checked: str, today: str, ttl_days: int, full: bool = False) -> DataFrame:
    """R-19: rows of the queue that are due: all in a full run, else those without a cache row or with one older than the TTL."""
    last = cache.groupBy(key).agg(F.max(checked).alias("_checked"))
    joined = queue.join(last, key, "left")
    due = F.lit(full) | F.col("_checked").isNull() | (F.datediff(F.lit(today).cast("date"), F.col("_checked")) > ttl_days)
    return joined.filter(due).drop("_checked")


def augmented(queue: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """R-21: the queue and the target keys that it lacks."""
    return queue.unionByName(targets.join(queue.select(key), key, "left_anti"), allowMissingColumns=True)


def purged(items: DataFrame, expected: DataFrame, key: str, field: str, unknown: str) -> DataFrame:
    """R-20: items; where any value of a key is not the expected one, its field is unknown again."""
    wrong = items.join(expected.select(key, F.col(field).alias("_want")), key).filter(~F.col(field).eqNullSafe(F.col("_want"))).select(key).distinct()
    marked = items.join(wrong.withColumn("_wrong", F.lit(True)), key, "left")
    return marked.withColumn(field, F.when(F.col("_wrong"), unknown).otherwise(F.col(field))).drop("_wrong")


def without_runs(rows: DataFrame, run: str, ids: list[str]) -> DataFrame:
    """R-26: rows of all other runs; an id that no row has is an error."""
    found = {str(r[0]) for r in rows.filter(F.col(run).cast("string").isin(ids)).select(run).distinct().collect()}
    if lost := sorted(set(ids) - found):
        raise ValueError(f"unknown runs: {', '.join(lost)}")
    return rows.filter(~F.coalesce(F.col(run).cast("string").isin(ids), F.lit(False)))


def candidate_pool(items: DataFrame, ledger: DataFrame, id: str, day: str, empty: Column, most: int) -> DataFrame:
    """R-36: the latest `most` items that lack a value and are not in the ledger."""
    return items.filter(empty).join(ledger.select(id), id, "left_anti").orderBy(F.desc(day), F.desc(id)).limit(most)


def near_in_time(rows: DataFrame, key: str, day: str, id: str, days: int = 3) -> DataFrame:
    """W-13: id, next: rows of one key whose next row is at most `days` later."""
    w = Window.partitionBy(key).orderBy(day, id)
    following = rows.select(id, day, F.lead(id).over(w).alias("next"), F.lead(day).over(w).alias("_day"))
    return following.filter(F.datediff("_day", F.col(day)) <= days).select(id, "next")


def evidence_or_all(rows: DataFrame, group: str, is_evidence: Column) -> DataFrame:
    """D-11: rows of evidence sources; all rows of a group that has none."""
    marked = rows.withColumn("_e", F.coalesce(is_evidence, F.lit(False)))
    some = marked.groupBy(group).agg(F.max("_e").alias("_some"))
    return marked.join(some, group).filter(F.col("_e") | ~F.col("_some")).drop("_e", "_some")


def blob_of(*texts: Column) -> Column:
    """Searchable text of several fields."""
    return searchable(F.concat_ws(" ", *texts))
