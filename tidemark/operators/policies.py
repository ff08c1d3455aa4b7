"""Decisions over runs, sources, audits and territories (C-04, G-05, G-09, G-13, G-14, I-10, J-02, J-03, K-13, K-18, O-06, A-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.match import bind
from tidemark.functions.text import base_key
from tidemark.session import cut, measured_broadcast

# How departments and regions are written in an organisation's key, and the articles before their names.
TERRITORIES = {
    "departement": (r"^(?:conseil departemental|departement)(?:\s+(.+)|(2a|2b|\d{1,3}))$", r"^cd(2a|2b|\d{1,3})$"),
    "region": (r"^(?:conseil regional|region)(?:\s+(.+)|(\d{1,2}))$", r"^cr(\d{1,2})$"),
}
ARTICLES = r"^(?:de la |de l |du |des |de |d |la |le |les |l )"


def best_date(event: Column, published: Column) -> Column:
    """C-04: the event's day where there is one, else that of publication; empty for neither."""
    return F.coalesce(F.nullif(event, F.lit("")), published, F.lit(""))


def snapshot_blocked(status: Column, contract: Column) -> Column:
    """G-13: whether a source's outcome forbids publishing; live watches may be partial."""
    live = F.coalesce(contract == "live_watch", F.lit(False))
    return F.coalesce(status != "OK", F.lit(True)) & ~(F.coalesce(status == "PARTIAL", F.lit(False)) & live)


def run_breaks(runs: DataFrame, run: str, mode: Column, new: Column, dirty: Column, calls: Column, mismatches: Column) -> DataFrame:
    """G-14: run, fault for each promise of incremental runs that a run breaks; missing counts are 0."""
    new, dirty, calls, mismatches = (F.coalesce(c.cast("long"), F.lit(0)) for c in (new, dirty, calls, mismatches))
    delta = F.coalesce(mode == "delta", F.lit(False))
    work = F.format_string("delta_with_work:new=%d,dirty=%d", new, dirty)
    faults = F.array_compact(F.array(
        F.when(delta & ((new != 0) | (dirty != 0)), work), F.when(delta & (calls > 0), "delta_with_sourcefacts_llm"), F.when(mismatches > 0, "shadow_mismatch"),
    ))
    return runs.select(F.coalesce(F.nullif(F.col(run).cast("string"), F.lit("")), F.lit("unknown")).alias("run"), F.explode(faults).alias("fault"))


def semantic_decision(articles: Column, rich: Column, candidates: Column, empty: Column, claims: Column, unproven: Column, least: int = 8) -> Column:
    """G-09: struct of `use` and `reason`: whether a source's rich articles are often ambiguous and thinly covered.

    `claims` is the mean number per rich article, `empty` counts rich articles without one. The first reason that holds
    is told: sample, evidence, rare, empty, thin, covered.
    """
    articles, rich, candidates, empty, claims, unproven = (F.coalesce(c, F.lit(0)) for c in (articles, rich, candidates, empty, claims, unproven))
    share = F.when(rich > 0, candidates / rich).otherwise(0.0)
    none = F.when(rich > 0, empty / rich).otherwise(0.0)
    reason = (
        F.when(articles < least, "sample").when(unproven != 0, "evidence").when(share < 0.20, "rare")
        .when(none >= 0.15, "empty").when(claims < 1.5, "thin").otherwise("covered")
    )
    return F.struct(reason.isin("empty", "thin").alias("use"), reason.alias("reason"))


def metric_failures(before: DataFrame, after: DataFrame, field: str, higher: list[str], lower: list[str], tolerance: float = 0.0) -> DataFrame:
    """G-05: field, measure, before, after of a golden set's measures that got worse; `absent` for a field on one side only.

    Percentages (`higher`) may fall by `tolerance` points, counts (`lower`) may not rise. Missing measures are 0.
    """
    old = before.select(field, F.struct(*[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in [*higher, *lower]]).alias("_old"))
    new = after.select(field, F.struct(*[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in [*higher, *lower]]).alias("_new"))
    both = old.join(new, field, "full")
    o, n = F.col("_old"), F.col("_new")

    def bad(m: str, fails: Column) -> Column:
        return F.when(fails, F.struct(F.lit(m).alias("measure"), o[m].alias("before"), n[m].alias("after")))

    none = F.lit(None).cast("double")
    absent = F.when(o.isNull() | n.isNull(), F.struct(F.lit("absent").alias("measure"), none.alias("before"), none.alias("after")))
    worse = [bad(m, n[m] + tolerance < o[m]) for m in higher] + [bad(m, n[m] > o[m]) for m in lower]
    return both.select(field, F.inline(F.array_compact(F.array(absent, *worse))))


def stratum(statuses: Column, steps: Column, relations: Column, counts: Column, volumes: Column, claims: Column) -> Column:
    """K-18: the audit stratum of a fact: modality before chronology, relations, several figures, many claims."""
    return (
        F.when(F.arrays_overlap(statuses, F.array(*map(F.lit, ("hypothesis", "negated", "denied")))), "modalite")
        .when(steps >= 2, "chronologie").when(relations > 0, "relations")
        .when((counts >= 2) | (volumes >= 2), "multi_chiffres").when(claims >= 3, "riche").otherwise("simple")
    )


def audit_bucket(missed: Column, same_source: Column, recurring: Column, days: Column) -> Column:
    """O-06: 0 for a missed duplicate, then merges by how fragile they are; order by it, days downwards, day, ids."""
    return F.when(missed, 0).when(same_source, 1).when(recurring, 2).when(days > 0, 3).otherwise(4)


def stable_threat(source: Column, threat: Column, native: Column, known: list[str], native_sources: list[str], fixed: dict[str, str], scoped: dict[str, str], strong: list[str]) -> Column:
    """K-13: a source's own label where it is authoritative and known, a fixed one, or its scope unless a strong one stands."""
    label = F.trim(F.coalesce(native, F.lit("")))
    out = F.when(source.isin(native_sources), F.when(label.isin(known), label).otherwise(threat))
    for name, value in fixed.items():
        out = out.when(source == name, F.lit(value))
    for name, value in scoped.items():
        out = out.when(source == name, F.when(threat.isin(strong), threat).otherwise(F.lit(value)))
    return out.otherwise(threat)


def missing_values(tracked: DataFrame, rows: DataFrame, value: str) -> DataFrame:
    """A-13: tracked values that no row has."""
    return tracked.join(rows.select(value).distinct(), value, "left_anti")


def next_run_ids(wanted: DataFrame, log: DataFrame, base: str, run: str) -> DataFrame:
    """I-10: base, run_id: the base itself if the log lacks it, else with the smallest free suffix from -2 on."""
    suffix = F.regexp_extract(run, r"-([2-9]|[1-9][0-9]+)$", 1)
    stem = F.when(suffix != "", F.expr(f"left(`{run}`, length(`{run}`) - length(regexp_extract(`{run}`, '-([2-9]|[1-9][0-9]+)$', 0)))"))
    whole = log.select(F.col(run).alias(base), F.lit(1).cast("long").alias("n"))
    numbered = log.filter(suffix != "").select(stem.alias(base), suffix.cast("long").alias("n"))
    used = whole.union(numbered).join(wanted.select(base).distinct(), base, "left_semi").distinct()
    # Below the first gap only, a number has a follower that is free; 0 stands for a base not yet used.
    every = used.union(wanted.select(base, F.lit(0).cast("long").alias("n")).distinct())
    free = every.select(base, (F.col("n") + 1).alias("n")).join(used, [base, "n"], "left_anti").groupBy(base).agg(F.min("n").alias("n"))
    return free.select(base, F.when(F.col("n") == 1, F.col(base)).otherwise(F.concat_ws("-", base, F.col("n").cast("string"))).alias("run_id"))


def territory(name: Column) -> Column:
    """J-02: struct of the kind and value of a name that is wholly a department's or a region's, else null.

    A code alone is none: the kind of authority has to be named. The name's key is made once, and what follows the kind of
    authority is looked at only where there is one.
    """

    def of(kind: str, pattern: str, key: Column) -> Column:
        def told(value: Column) -> Column:
            return F.when(value != "", F.struct(F.lit(kind).alias("kind"), value.alias("value")))

        # one of the groups holds the value, the others are empty
        value = bind(F.regexp_replace(key, pattern, "$1$2$3"), lambda v: F.trim(F.regexp_replace(base_key(v), ARTICLES, "")))
        return F.when(key.rlike(pattern), bind(value, told))

    return bind(base_key(name), lambda key: F.coalesce(*[of(kind, "|".join(patterns), key) for kind, patterns in TERRITORIES.items()]))


def _known_territories(identities: DataFrame) -> DataFrame:
    """_kind, _value, _key of `identities`, each kind and value once; two keys for one are an error."""
    known = identities.groupBy("kind", "value").agg(F.min("key").alias("_key"), F.max("key").alias("_last"))
    clash = F.raise_error(F.concat(F.lit("two keys for "), F.col("kind"), F.lit(" "), F.col("value")))
    return measured_broadcast(cut(known.select(F.col("kind").alias("_kind"), F.col("value").alias("_value"), F.when(F.col("_key") == F.col("_last"), F.col("_key")).otherwise(clash).alias("_key"))))


def _with_key(rows: DataFrame, at: str, known: DataFrame, out: str) -> DataFrame:
    on = (F.col(f"{at}.kind") == F.col("_kind")) & (F.col(f"{at}.value") == F.col("_value"))
    return rows.join(known.withColumnRenamed("_key", out), on, "left").drop(at, "_kind", "_value")


def territorial_keys(rows: DataFrame, name: str, identities: DataFrame, out: str = "territorial_key") -> DataFrame:
    """J-02: `rows` with the key that `identities` (kind, value, key) gives the territory in `name`, else null.

    Two keys for one kind and value are an error, as they would merge different authorities. `identities` is computed at
    once, to be broadcast where it is small.
    """
    return _with_key(rows.withColumn("_at", territory(F.col(name))), "_at", _known_territories(identities), out)


def effective_keys(rows: DataFrame, names: list[str], identities: DataFrame, fallback: Column, out: str = "effective_key") -> DataFrame:
    """J-03: `rows` with the territorial key of the first of `names` that has one, else `fallback`.

    Pass the canonical key of the raw name, the raw name, the canonical stored key, the stored key, in this order.
    """
    columns, known = rows.columns, _known_territories(identities)
    rows = rows.withColumns({f"_at{i}": territory(F.col(name)) for i, name in enumerate(names)})
    keys = [f"_key{i}" for i in range(len(names))]
    for i, key in enumerate(keys):
        rows = _with_key(rows, f"_at{i}", known, key)
    return rows.select(*columns, F.coalesce(*keys, fallback).alias(out))
