"""Keys and joins of entities: aliases, caches, best candidates, set operations (T-06, J-*, U-*), and repairs (D-*, Q-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast


def organisation_key(items: DataFrame, aliases: DataFrame, base: str, out: str = "key") -> DataFrame:
    """T-06, J-01: `items` with `out`, the canonical key of their base key, itself where no alias is known.

    `aliases` has alias and canonical. An alias of two canonical keys is an error.
    """
    known = aliases.groupBy("alias").agg(F.min("canonical").alias("canonical"), F.max("canonical").alias("_other"))
    known = cut(known)
    clash = known.filter("canonical <> _other").limit(3).collect()
    if clash:
        raise ValueError(f"aliases with several canonical keys: {', '.join(r.alias for r in clash)}")
    joined = items.join(measured_broadcast(known.drop("_other")), F.col(base) == F.col("alias"), "left")
    return joined.withColumn(out, F.coalesce("canonical", base)).drop("alias", "canonical")


def latest_match(items: DataFrame, cache: DataFrame, key: str, order: list[str], status: str = "status", matched: str = "MATCHED") -> DataFrame:
    """J-05: items with the value of the last cache row of their key, if that row is a match."""
    last = cache.groupBy(key).agg(F.max_by(F.struct(status, "value"), F.struct(*order)).alias("_c"))
    joined = items.join(last, key, "left")
    return joined.withColumn("value", F.when(F.col(f"_c.{status}") == matched, F.col("_c.value"))).drop("_c")


def rolled_up(items: DataFrame, facts: DataFrame, item: str, group: str, fact: Column) -> DataFrame:
    """J-06: group, facts: the facts of all items of a group, in order."""
    return items.select(item, group).join(facts, item).groupBy(group).agg(F.array_sort(F.collect_list(fact)).alias("facts"))


def last_of_entity(entities: DataFrame, happened: DataFrame, name: str, day: str, id: str) -> DataFrame:
    """J-15: every entity with its latest row of `happened`; of the rows of one day the first id."""
    best = happened.groupBy(name).agg(F.min_by(F.struct(day, id), F.struct(-F.unix_date(F.col(day)), F.col(id))).alias("_b"))
    return entities.join(best, name, "left").select(*entities.columns, F.col(f"_b.{day}").alias(day), F.col(f"_b.{id}").alias(id))


def only_latest_run(rows: DataFrame, runs: DataFrame, run: str, order: str) -> DataFrame:
    """J-16: rows of the run that is last in order."""
    last = runs.agg(F.max_by(run, F.struct(order, run)).alias(run))
    return rows.join(F.broadcast(last), run, "left_semi")


def missing_keys(expected: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """J-17: expected keys without a row in `seen`."""
    return expected.select(key).distinct().join(seen.select(key), key, "left_anti")


def best_scored(rows: DataFrame, key: str, position: str, tests: list[tuple[Column, int]]) -> DataFrame:
    """J-20, J-23: per key the row with the most points, ties to the first position; adds `score`."""
    points = sum((F.when(condition, worth).otherwise(0) for condition, worth in tests), F.lit(0))
    scored = rows.withColumn("score", points)
    top = scored.groupBy(key).agg(F.max_by(F.struct(*[c for c in scored.columns if c != key]), F.struct("score", -F.col(position))).alias("_r"))
    return top.select(key, "_r.*")


def anchored(reference: DataFrame, registry: DataFrame, anchor: str, redirect: str) -> DataFrame:
    """J-21: reference rows whose anchor is active, that is, redirects nowhere."""
    active = registry.filter(F.coalesce(F.col(redirect).cast("string"), F.lit("")) == "")
    return reference.join(active.drop(redirect), anchor)


def lone_collisions(rows: DataFrame, id: str, key: str, words: Column, weak: Column) -> DataFrame:
    """J-24: rows with `rejected`: weak ones that share an id with others but no word with any of them."""
    each = rows.select(id, key, F.explode(F.array_distinct(words)).alias("_w"))
    shared = each.groupBy(id, "_w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    common = each.join(shared.select(id, "_w"), [id, "_w"], "left_semi").select(key).distinct().withColumn("_common", F.lit(True))
    sizes = rows.groupBy(id).agg(F.count(F.lit(1)).alias("_n"))
    joined = rows.join(sizes, id).join(common, key, "left")
    return joined.withColumn("rejected", (F.col("_n") > 1) & weak & F.col("_common").isNull()).drop("_n", "_common")


def exact_union(*channels: DataFrame) -> DataFrame:
    """U-01, U-02: rows of all channels by column name, exact repeats once."""
    out = channels[0]
    for c in channels[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out.distinct()


def label_union(before: DataFrame, after: DataFrame, label: str, count: str = "n") -> DataFrame:
    """U-04: label, before, after: counts of either period, 0 where a label is missing."""
    a, b = before.select(label, F.col(count).alias("before")), after.select(label, F.col(count).alias("after"))
    return a.join(b, label, "full_outer").select(label, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def id_overlap(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """U-06: one row: how many ids are in both, only before, only after."""
    both = before.select(key, F.lit(1).alias("_b")).distinct().join(after.select(key, F.lit(1).alias("_a")).distinct(), key, "full_outer")
    b, a = F.col("_b").isNotNull(), F.col("_a").isNotNull()
    return both.agg(F.count_if(a & b).alias("common"), F.count_if(b & ~a).alias("removed"), F.count_if(a & ~b).alias("added"))


def array_algebra(a: Column, b: Column) -> Column:
    """U-07: struct of common, only_a, only_b: sorted, each value once."""
    return F.struct(
        F.array_sort(F.array_intersect(a, b)).alias("common"), F.array_sort(F.array_except(a, b)).alias("only_a"),
        F.array_sort(F.array_except(b, a)).alias("only_b"),
    )


def merged_claims(claims: DataFrame, by: list[str], source: str, rank: Column) -> DataFrame:
    """U-08, D-19: one claim per key, the best ranked one, with all its sources sorted."""
    rest = [c for c in claims.columns if c not in (*by, source)]
    return claims.withColumn("_rank", rank).groupBy(*by).agg(
        F.min_by(F.struct(*rest), F.struct("_rank", source, *rest)).alias("_r"), F.array_sort(F.collect_set(source)).alias("sources")
    ).select(*by, "_r.*", "sources")


def preferred_majority(rows: DataFrame, key: str, label: str, preferred: Column) -> DataFrame:
    """D-08: per key the commonest label among the preferred sources, else among all; ties to the first label."""
    counts = rows.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"), F.count_if(preferred).alias("p"))
    chosen = F.min_by(label, F.struct(-F.col("p"), -F.when(F.col("p") > 0, 0).otherwise(F.col("n")), F.col(label)))
    return counts.groupBy(key).agg(chosen.alias(label))


def stable_ids(groups: DataFrame, registry: DataFrame, group: str, item: str, id: str) -> DataFrame:
    """D-13: group, id: the id that most of a group's items had, ties to the smallest; a new group is named by its first item.

    `registry` has item and id. An id goes to one group, the one with more of its items; the others are new.
    """
    had = groups.join(registry, item, "left").filter(F.col(id).isNotNull()).groupBy(group, id).agg(F.count(F.lit(1)).alias("n"))
    best = had.withColumn("_at", F.row_number().over(Window.partitionBy(id).orderBy(F.desc("n"), group))).filter("_at = 1")
    kept = best.groupBy(group).agg(F.min_by(id, F.struct(-F.col("n"), F.col(id))).alias("_kept"))
    first = groups.groupBy(group).agg(F.min(item).alias("_first"))
    return first.join(kept, group, "left").select(group, F.coalesce("_kept", F.concat(F.lit("new:"), F.col("_first").cast("string"))).alias(id))


def registry_faults(registry: DataFrame, items: DataFrame, id: str, anchor: str, redirect: str) -> DataFrame:
    """D-16, D-17: id, fault of registry rows: repeated id, anchor that no item has, redirect to itself or to nowhere.

    Anchors of items and targets are made distinct before they meet the registry, so a task sorts each once and not with all
    its rows.
    """
    repeated = registry.groupBy(id).count().filter("count > 1").select(id, F.lit("DUPLICATE_ID").alias("fault"))
    orphan = registry.filter(F.col(redirect).isNull()).join(items.select(F.col(anchor)).distinct(), anchor, "left_anti").select(id, F.lit("ORPHAN_ANCHOR").alias("fault"))
    loop = registry.filter(F.col(redirect) == F.col(id)).select(id, F.lit("SELF_REDIRECT").alias("fault"))
    targets = registry.select(F.col(id).alias(redirect)).distinct()
    lost = registry.filter(F.col(redirect).isNotNull()).join(targets, redirect, "left_anti").select(id, F.lit("LOST_REDIRECT").alias("fault"))
    return repeated.unionByName(orphan).unionByName(loop).unionByName(lost)


def mutations(before: DataFrame, after: DataFrame, key: str, fields: list[str], origin: str) -> DataFrame:
    """Q-02: one applied decision for each field of each row that a step has changed."""
    old = before.select(key, *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"_{f}") for f in fields])
    new = after.select(key, *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{f}").alias("previous"), F.col(f).alias("value")) for f in fields])
    rows = new.join(old, key).select(key, F.inline(F.filter(each, lambda x: x["previous"] != x["value"])))
    return rows.withColumns({"origin": F.lit(origin), "decision": F.lit("APPLIED")})


def guarded_registry(rows: DataFrame, candidates: Column, strong: Column) -> DataFrame:
    """Q-07: a registry row with several candidate labels is a CONFLICT, unless a strong official label decides."""
    several = F.size(F.array_distinct(F.filter(candidates, lambda x: x.isNotNull()))) > 1
    status = F.when(several & strong.isNull(), "CONFLICT").when(several, "AUTO").otherwise(F.col("status"))
    label = F.when(several & strong.isNull(), F.lit(None)).when(several, strong).otherwise(F.col("label"))
    return rows.withColumns({"status": status, "label": label})


def applied_registry(items: DataFrame, registry: DataFrame, key: str, field: str, unknown: str) -> DataFrame:
    """Q-08: unknown fields filled from AUTO rows of the registry; `applied` tells which."""
    auto = registry.filter("status = 'AUTO' AND label IS NOT NULL").select(key, F.col("label").alias("_label"))
    joined = items.join(auto, key, "left")
    fill = (F.coalesce(F.col(field), F.lit("")).isin("", unknown)) & F.col("_label").isNotNull()
    return joined.withColumn("applied", fill).withColumn(field, F.when(fill, F.col("_label")).otherwise(F.col(field))).drop("_label")


def restored(items: DataFrame, decisions: DataFrame, key: str, field: str, origin: str) -> DataFrame:
    """Q-08, Q-15, Q-16: fields that `origin` had set, as they were before, so that no output is its own evidence."""
    mine = decisions.filter((F.col("origin") == origin) & (F.col("field") == field) & (F.col("decision") == "APPLIED"))
    undo = mine.select(key, F.col("previous").alias("_old"), F.col("value").alias("_set")).dropDuplicates([key])
    joined = items.join(undo, key, "left")
    return joined.withColumn(field, F.when(F.col(field) == F.col("_set"), F.col("_old")).otherwise(F.col(field))).drop("_old", "_set")


def single_valued(evidence: DataFrame, key: str, value: str) -> DataFrame:
    """Q-11: keys whose evidence gives exactly one known value."""
    known = evidence.filter(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_hi"))
    return known.filter(F.col(value) == F.col("_hi")).drop("_hi")
