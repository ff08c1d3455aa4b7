"""Facts of many sources brought together (N-*), incremental state (I-*), and what runs are held against (G-*, A-*, R-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import norm_key
from tidemark.functions.values import half_even


def known(value: Column, sentinels: tuple[str, ...]) -> Column:
    """Whether a value says something: not null, not blank, no sentinel."""
    return (F.trim(F.coalesce(value, F.lit(""))) != "") & ~F.lower(F.trim(F.coalesce(value, F.lit("")))).isin(*sentinels)


def resolved(facts: DataFrame, key: str, value: str, source: str, rank: Column, sentinels: tuple[str, ...] = ()) -> DataFrame:
    """N-04: per key the first known value by source rank, then source, then value; and all sources that say the same.

    Spellings are the same if they agree in lower case without outer white space.
    """
    rows = facts.filter(known(F.col(value), sentinels)).withColumns({"_rank": rank, "_norm": F.lower(F.trim(value))})
    said = rows.groupBy(key, "_norm").agg(F.min(F.struct("_rank", source, value)).alias("_first"), F.array_sort(F.collect_set(source)).alias("sources"))
    best = said.groupBy(key).agg(F.min_by(F.struct(F.col(f"_first.{value}").alias(value), "sources"), "_first").alias("_r"))
    return best.select(key, "_r.*")


def resolved_list(facts: DataFrame, key: str, value: str, source: str, order: str) -> DataFrame:
    """N-05, N-07: per key and spelling class the first spelling, and the sources in order."""
    rows = facts.filter(F.trim(F.coalesce(F.col(value), F.lit(""))) != "").withColumn("_norm", F.lower(F.trim(value)))
    return rows.groupBy(key, "_norm").agg(F.min_by(value, F.struct(order, value)).alias(value), F.array_sort(F.collect_set(source)).alias("sources")).drop("_norm")


def merged_facts(existing: DataFrame, incoming: DataFrame, key: str, keep: list[str], refresh: list[str]) -> DataFrame:
    """N-10: incoming rows over existing ones, field by field: `keep` fields stay once they are set, `refresh` ones change."""
    old = existing.select(key, *[F.col(f).alias(f"_{f}") for f in keep + refresh])
    both = incoming.select(key, *keep, *refresh).join(old, key, "full_outer")
    set_ = {f: F.coalesce(F.nullif(F.col(f"_{f}"), F.lit("")), F.col(f)) for f in keep} | {f: F.coalesce(F.nullif(F.col(f), F.lit("")), F.col(f"_{f}")) for f in refresh}
    return both.select(key, *[c.alias(f) for f, c in set_.items()])


def richest(facts: DataFrame, key: str, summary: str, fields: list[str], ties: list[str]) -> DataFrame:
    """N-11: per key the summary of the fact with the most fields set, ties to the greatest of `ties`."""
    richness = sum((known(F.col(f).cast("string"), ()).cast("int") for f in fields), F.lit(0))
    rows = facts.filter(known(F.col(summary), ())).withColumn("richness", richness)
    return rows.groupBy(key).agg(F.max_by(F.struct(F.col(summary), "richness"), F.struct("richness", *ties)).alias("_r")).select(key, "_r.*")


def stamped(claims: Column, **values: Column) -> Column:
    """N-13: an array of structs whose missing fields are set: origin of each claim."""
    return F.transform(claims, lambda x: _with(x, values))


def _with(x: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        x = x.withField(name, F.coalesce(x[name], value))
    return x


def first_alias(record: Column, aliases: tuple[str, ...]) -> Column:
    """N-01, N-14: the first of the aliases that a JSON object has, as text; null for none and for invalid JSON."""
    return F.coalesce(*[F.get_json_object(record, f"$.{a}") for a in aliases])


def records_of(payload: Column, containers: tuple[str, ...] = ("victims", "data", "results", "items")) -> Column:
    """N-15, S-04: the elements of a JSON list, or of the first container that holds one, as JSON texts."""
    kind = "array<string>"
    direct = F.when(F.trim(payload).startswith("["), F.from_json(payload, kind))
    return F.coalesce(direct, *[F.from_json(F.get_json_object(payload, f"$.{c}"), kind) for c in containers], F.array().cast(kind))


def search_text(*parts: Column) -> Column:
    """N-16: what a search looks through: all parts, lower case, blank ones left out."""
    return F.lower(F.array_join(F.filter(F.array(*parts), lambda p: F.trim(F.coalesce(p, F.lit(""))) != ""), " "))


def fingerprint(*parts: Column) -> Column:
    """I-01: SHA-256 over all parts, each with its length before it, so that no two lists of parts read alike."""
    each = [F.concat(F.octet_length(F.coalesce(p.cast("string"), F.lit(""))).cast("string"), F.lit(":"), F.coalesce(p.cast("string"), F.lit(""))) for p in parts]
    return F.sha2(F.concat(*each), 256)


def state_metrics(states: DataFrame, state: str = "state") -> DataFrame:
    """I-03: one row: new, dirty and unchanged rows, and the share that can be reused in percent."""
    n = F.count(F.lit(1))
    kept = F.count_if(F.col(state) == "UNCHANGED")
    return states.agg(
        F.count_if(F.col(state) == "NEW").alias("new"), F.count_if(F.col(state) == "DIRTY").alias("dirty"), kept.alias("unchanged"),
        F.coalesce(half_even(100.0 * kept / F.nullif(n, F.lit(0)), 2), F.lit(0.0)).alias("reuse_pct"),
    )


def parity_breaks(before: DataFrame, after: DataFrame, unchanged: DataFrame, key: str, hashes: list[str]) -> DataFrame:
    """I-04: key, broken: the hashes that differ though the row's input has not changed."""
    old = before.select(key, *[F.col(h).alias(f"_{h}") for h in hashes])
    both = after.join(unchanged.select(key), key, "left_semi").join(old, key)
    broken = F.array_compact(F.array(*[F.when(~F.col(h).eqNullSafe(F.col(f"_{h}")), F.lit(h)) for h in hashes]))
    return both.select(key, F.array_join(broken, ",").alias("broken")).filter("broken <> ''")


def reusable(facts: DataFrame, current: DataFrame, key: str, content_hash: str, version: str) -> DataFrame:
    """I-07: facts whose content hash and version are still those of their item."""
    return facts.join(current.select(key, content_hash, version), [key, content_hash, version], "left_semi")


def set_hash(rows: DataFrame, *parts: Column, buckets: int = 1024) -> DataFrame:
    """I-06, I-09: one row: rows, digest: a hash that does not depend on the order of rows.

    Row hashes are sorted and hashed within buckets of their leading digits, then the buckets' hashes: no list holds all rows.
    """
    hashed = rows.select(fingerprint(*parts).alias("h")).withColumn("b", F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % buckets)
    by = hashed.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("h"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"])
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.sha2(F.array_join(listed, "\n"), 256).alias("digest"))


def violations(**checks: DataFrame) -> DataFrame:
    """G-01: fault, subject of every row that breaks a check; each check gives a one-column frame of subjects."""
    out = None
    for name, rows in checks.items():
        one = rows.select(F.lit(name).alias("fault"), F.col(rows.columns[0]).cast("string").alias("subject"))
        out = one if out is None else out.unionByName(one)
    return out


def worsened(before: DataFrame, after: DataFrame, keys: list[str], higher_is_better: dict[str, bool], tolerance: float = 0.0) -> DataFrame:
    """G-02, G-03, G-05, R-23: keys, measure, before, after where a measure of comparable rows got worse than tolerated."""
    old = before.select(*keys, *[F.col(m).cast("double").alias(f"_{m}") for m in higher_is_better])
    both = after.join(old, keys)
    each = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"_{m}").alias("before"), F.col(m).cast("double").alias("after"), F.lit(1.0 if up else -1.0).alias("way"))
        for m, up in higher_is_better.items()
    ])
    bad = F.filter(each, lambda x: (x["before"] - x["after"]) * x["way"] > tolerance + 1e-9)
    return both.select(*keys, F.inline(bad)).drop("way")


def gate(rows: DataFrame, key: str, cases: Column, precision: Column, regressions: Column, least_cases: int, least_pct: float, most_regressions: int) -> DataFrame:
    """G-04, G-06, R-35: key, failures of a quality gate; rows that pass have none and are left out."""
    told = F.array_compact(F.array(
        F.when(cases < least_cases, "cases"), F.when(F.coalesce(precision, F.lit(0.0)) < least_pct, "precision"), F.when(regressions > most_regressions, "regressions"),
    ))
    return rows.select(key, F.array_join(told, ",").alias("failures")).filter("failures <> ''")


def history_status(wanted_from: Column, reached: Column, complete: Column) -> Column:
    """G-10: COMPLETE if the source said so or was read back to the wanted day, TRUNCATED if it ended later, else UNKNOWN."""
    return F.when(complete | (reached <= wanted_from), "COMPLETE").when(reached > wanted_from, "TRUNCATED").otherwise("UNKNOWN")


def resolved_status(done: Column, expected: Column, reason: Column) -> DataFrame:
    """G-11: struct of status and pct: SKIPPED with nothing expected, FAIL with nothing done, PARTIAL at most 99 percent, OK."""
    pct = F.least(F.lit(100), F.floor(100 * done / F.nullif(expected, F.lit(0)))).cast("int")
    status = F.when(F.coalesce(expected, F.lit(0)) <= 0, "SKIPPED").when(F.coalesce(done, F.lit(0)) <= 0, "FAIL").when((done < expected) | (reason != ""), "PARTIAL").otherwise("OK")
    return F.struct(status.alias("status"), F.when(status == "OK", 100).when(status == "PARTIAL", F.least(pct, F.lit(99))).otherwise(0).alias("pct"))


def portfolio_action(score: Column, runs: Column, reliability: Column, exclusive: Column) -> Column:
    """G-08: KEEP from 65 points on, DEACTIVATION_CANDIDATE for weak, tried, unreliable sources of nothing exclusive, REVIEW, WATCH."""
    weak = (score < 35) & (runs >= 5) & (reliability < 50) & (exclusive == 0)
    return F.when(score >= 65, "KEEP").when(weak, "DEACTIVATION_CANDIDATE").when(score < 50, "REVIEW").otherwise("WATCH")


def evaluation(joined: DataFrame, truth: str, told: str, unknown: str, *by: str) -> DataFrame:
    """A-26: cases, accuracy, coverage, precision when qualified, unknown that could be known, wrong; percent, 1 place."""
    t, p = F.col(truth), F.coalesce(F.col(told), F.lit(unknown))
    n, qualified, right = F.count(F.lit(1)), F.count_if(p != unknown), F.count_if(t == p)

    def pct(a: Column, b: Column) -> Column:
        return half_even(100.0 * a / F.nullif(b, F.lit(0)), 1)

    return joined.groupBy(*by).agg(
        n.alias("cases"), pct(right, n).alias("accuracy"), pct(qualified, n).alias("coverage"),
        pct(F.count_if((t == p) & (p != unknown)), qualified).alias("precision"),
        F.count_if((p == unknown) & (t != unknown)).alias("resolvable"), F.count_if((p != unknown) & (t != p)).alias("wrong"),
    )


def value_audit(rows: DataFrame, raw: str, label: str, unknown: str) -> DataFrame:
    """A-08: raw, items, unknown of each raw value, those with the most unknown items first (`place`)."""
    each = rows.groupBy(raw).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.coalesce(F.col(label), F.lit(unknown)) == unknown).alias("unknown"))
    return each.withColumn("bucket", F.when(F.col("unknown") == 0, "KNOWN").when(F.col("unknown") == F.col("items"), "UNKNOWN").otherwise("MIXED"))


def transformation_rates(rows: DataFrame, source: str, order: list[str], before: Column, after: Column, last: int) -> DataFrame:
    """R-31: per source and in TOTAL over the latest `last` rows of each: unknown before, after, and the share resolved."""
    w = Window.partitionBy(source).orderBy(*[F.desc(o) for o in order])
    latest = rows.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= last)
    sums = latest.rollup(source).agg(F.count_if(before).alias("before"), F.count_if(after).alias("after"))
    rate = half_even(100.0 * (F.col("before") - F.col("after")) / F.nullif(F.col("before"), F.lit(0)), 1)
    return sums.withColumns({source: F.coalesce(source, F.lit("TOTAL")), "rate": F.coalesce(rate, F.lit(0.0))})


def collapsed(rows: DataFrame, key: str, content: list[str], first: str) -> DataFrame:
    """R-25: rows of one key as one, with the earliest `first`; rows that differ in content are an error."""
    mark = fingerprint(*[F.col(c) for c in content])
    one = rows.withColumn("_m", mark).groupBy(key).agg(*[F.first(c).alias(c) for c in content], F.min(first).alias(first), F.min("_m").alias("_lo"), F.max("_m").alias("_hi"))
    same = F.when(F.col("_lo") == F.col("_hi"), F.col(first)).otherwise(F.raise_error(F.lit("rows of one key differ")).cast(rows.schema[first].dataType))
    return one.withColumn(first, same).drop("_lo", "_hi")


def reviewed(rows: DataFrame, journal: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """R-04: CORRECTED entries set their field to the value, the last entry wins; DUPLICATE and REVIEW entries drop the row.

    `journal` has `key`, seq, verdict, field, value.
    """
    fixes = journal.filter("verdict = 'CORRECTED'").groupBy(key).agg(
        *[F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("seq"))).alias(f"_{f}") for f in fields]
    )
    kept = rows.join(journal.filter("verdict IN ('DUPLICATE', 'REVIEW')").select(key), key, "left_anti").join(fixes, key, "left")
    return kept.withColumns({f: F.coalesce(F.col(f"_{f}"), F.col(f)) for f in fields}).drop(*[f"_{f}" for f in fields])


def changed_counts(before: DataFrame, after: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """R-39: one row: added, removed, modified and unchanged rows by their signature."""
    mark = fingerprint(*[F.col(c) for c in parts])
    both = before.select(key, mark.alias("_b")).join(after.select(key, mark.alias("_a")), key, "full_outer")
    b, a = F.col("_b"), F.col("_a")
    return both.agg(
        F.count_if(b.isNull()).alias("added"), F.count_if(a.isNull()).alias("removed"), F.count_if(a != b).alias("modified"), F.count_if(a == b).alias("unchanged")
    )


def counted(facts: DataFrame, key: str, records: str = "records", rank: Column | None = None) -> DataFrame:
    """N-06: the counts that the facts of a key give: one row per (key, unit, semantic), that of its first record.

    `facts` has key, source, item, `records` (array<struct<value, raw, unit, kind, scope, status>>, values as text) and a
    legacy count: affected_count, affected_raw, affected_unit, claim_status. `rank` orders sources (none: all alike), then
    their names, items and places in the array. Facts read in that order, records before the legacy count:

    * A record belongs to its unit (blank: unknown) and semantic (`unique` or `total` where kind or scope tell so, else the
      kind, the scope, or unspecified). The first one stands; later ones of the same value add their source to it.
    * A legacy count adds its source to the earliest standing count of its unit with its value. Without one it takes
      the unit's semantic if records of the key, later ones too, know just one; else it is unspecified.

    Records without a value and legacy counts without a value or unit give nothing. Returns key, unit, semantic, value, raw,
    status, source, sources (array, in order of sources), place (struct to order a key's counts by).

    Nothing is gathered by key: equal records are one before any shuffle, and lists hold sources.
    """
    place = F.struct((F.lit(0) if rank is None else rank).alias("r"), F.coalesce("source", F.lit("")).alias("s"), F.coalesce(F.col("item").cast("string"), F.lit("")).alias("i"))
    base = facts.select(F.col(key), place.alias("_p"), F.trim(F.coalesce("source", F.lit(""))).alias("source"), records, "affected_count", "affected_raw", "affected_unit", "claim_status")
    own = base.select(key, "_p", "source", F.posexplode(records).alias("n", "x")).filter("x.value IS NOT NULL")
    stated = own.select(
        key, F.struct("_p", "n").alias("place"), "source", F.lit(False).alias("legacy"), F.col("x.value").cast("string").alias("value"),
        F.trim(F.coalesce("x.raw", F.lit(""))).alias("raw"), _or(norm_key(F.col("x.unit")), "unknown").alias("unit"),
        _semantic(F.col("x.kind"), F.col("x.scope")).alias("semantic"), _status(F.col("x.status")).alias("status"),
    )
    unit = norm_key(F.col("affected_unit"))
    legacy = base.filter(F.col("affected_count").isNotNull() & ~unit.isin("", "unknown")).select(
        key, F.struct("_p", F.lit(2**31 - 1).alias("n")).alias("place"), "source", F.lit(True).alias("legacy"), F.col("affected_count").cast("string").alias("value"),
        F.trim(F.coalesce("affected_raw", F.lit(""))).alias("raw"), unit.alias("unit"), F.lit(None).cast("string").alias("semantic"), _status(F.col("claim_status")).alias("status"),
    )
    # Equal records of a source: the first one can stand, the last one can meet a count that stands by then.
    same = [key, "unit", "semantic", "legacy", "value", "source"]
    rows = stated.unionByName(legacy).groupBy(*same).agg(F.min(F.struct("place", "raw", "status")).alias("first"), F.max("place").alias("last"))

    known_ = rows.filter("NOT legacy").groupBy(key, "unit").agg(F.min("semantic").alias("lo"), F.max("semantic").alias("hi"))
    rows = rows.join(known_, [key, "unit"], "left")
    only = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    rows = rows.withColumn("home", F.when(F.col("legacy"), F.coalesce(only, F.lit("unspecified"))).otherwise(F.col("semantic")))

    # What records alone make stand, and where a value first stands among it: earlier legacy counts cannot meet that.
    first = F.struct(F.col("first.place").alias("place"), "value", "source", F.col("first.raw").alias("raw"), F.col("first.status").alias("status"))
    stands = rows.filter("NOT legacy").groupBy(key, "unit", "semantic").agg(F.min(first).alias("e"))
    earliest = stands.groupBy(key, "unit", F.col("e.value").alias("value")).agg(F.min("e.place").alias("met"))
    rows = rows.join(earliest, [key, "unit", "value"], "left")
    # A legacy count that meets nothing when it is first read opens its own count, unless one stands there.
    opens = rows.filter("NOT legacy OR met IS NULL OR met > first.place")
    entries = opens.groupBy(key, "unit", F.col("home").alias("semantic")).agg(F.min(first).alias("e")).select(key, "unit", "semantic", "e.*")

    target = entries.groupBy(key, "unit", "value").agg(F.min("place").alias("met"))
    adds = rows.drop("met").join(target, [key, "unit", "value"], "left")
    mark = [key, "unit", "value", "place"]
    # A record agrees with the count of its own semantic, a legacy one with the earliest that stands by then.
    by_record = adds.filter("NOT legacy").select(key, "unit", F.col("home").alias("semantic"), "value", "source", F.col("first.place").alias("p"))
    by_legacy = adds.filter("legacy AND met <= last").select(key, "unit", "value", F.col("met").alias("place"), "source", F.col("last").alias("p"))
    told = by_record.join(entries.select(key, "unit", "semantic", "value", "place"), [key, "unit", "semantic", "value"]).select(*mark, "source", "p")
    every = told.unionByName(by_legacy.select(*mark, "source", "p")).filter("source <> ''")
    ranked = F.struct(F.col("p._p.r").alias("r"), "source")
    sources = every.groupBy(*mark).agg(F.array_sort(F.collect_set(ranked)).alias("l"))
    named = entries.join(sources, mark, "left").withColumn("sources", F.coalesce(F.transform("l", lambda x: x["source"]), F.array().cast("array<string>")))
    return named.select(key, "unit", "semantic", "value", "raw", "status", "source", "sources", "place")


# States of a claim as they are shown, units, and the order in which units and semantics tell of an incident.
STATUSES = {
    "confirmed": "confirmé", "reported": "rapporté", "claimed": "revendiqué", "unknown": "documenté", "unconfirmed": "non confirmé", "denied": "démenti",
}
UNITS = {
    "people": "personnes", "accounts": "comptes", "users": "utilisateurs", "clients": "clients", "records": "enregistrements", "files": "fichiers",
}
UNIT_ORDER = ("people", "clients", "users", "accounts", "records", "files")
CLAIM_ORDER = {"confirmed": 6, "reported": 5, "claimed": 4, "hypothesis": 3, "denied": 2, "negated": 2, "unknown": 1}
SUBSTANTIAL = 40


def _or(text: Column, otherwise: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(otherwise))


def _semantic(kind: Column, scope: Column) -> Column:
    k, s = norm_key(kind), norm_key(scope)
    both = F.concat_ws(" ", k, s)
    named = F.when(both.rlike("unique|dedupli"), "unique").when(both.rlike("total|ensemble|all"), "total")
    return F.coalesce(named, F.nullif(k, F.lit("")), _or(s, "unspecified"))


def _status(status: Column) -> Column:
    return F.when(norm_key(status).isin(*STATUSES), norm_key(status)).otherwise("unknown")


def _labelled(value: Column, labels: dict[str, str], otherwise: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, label in labels.items():
        out = out.when(value == k, label)
    return out.otherwise(otherwise)


def shown_count(count: Column) -> Column:
    """N-08: a count as text: its raw wording, else the number with spaces and its unit."""
    number = F.coalesce(F.translate(F.format_number(count["value"].try_cast("bigint"), 0), ",", " "), F.trim(count["value"]))
    unit = _labelled(F.lower(count["unit"]), UNITS, count["unit"])
    unit = F.when((count["semantic"] == "unique") & (unit == UNITS["records"]), F.concat(unit, F.lit(" uniques"))).otherwise(unit)
    plain = F.trim(F.concat_ws(" ", F.nullif(number, F.lit("")), F.nullif(unit, F.lit(""))))
    return F.coalesce(F.nullif(F.trim(count["raw"]), F.lit("")), plain)


def foremost_count(counts: DataFrame, key: str) -> DataFrame:
    """N-08: per key the count that tells most, as struct `count`: by unit, then unique, total, others, source and place."""
    unit = F.coalesce(*[F.when(F.lower("unit") == u, i) for i, u in enumerate(UNIT_ORDER)], F.lit(9))
    semantic = F.when(F.col("semantic") == "unique", 0).when(F.col("semantic") == "total", 1).otherwise(2)
    told = F.struct("unit", "semantic", "value", "raw", "status", "source", "sources")
    return counts.groupBy(key).agg(F.min_by(told, F.struct(unit, semantic, F.col("place._p.r"), "place")).alias("count"))


def display_summary(impact: Column, count: Column, kinds: Column, fallback: Column) -> Column:
    """N-08: impact, the foremost count and up to five kinds of data as sentences.

    The fallback where there is none of them, and where it has over 40 characters and no impact is known.
    """
    said = F.trim(F.coalesce(impact, F.lit("")))
    first = F.when(said != "", F.when(said.rlike(r"[.!?]$"), said).otherwise(F.concat(said, F.lit("."))))
    value = shown_count(count)
    state = _labelled(count["status"], STATUSES, F.lit(STATUSES["unknown"]))
    second = F.when(value != "", F.concat(F.upper(F.substring(value, 1, 1)), F.substr(value, F.lit(2)), F.lit(" ("), state, F.lit(").")))
    listed = F.filter(kinds, lambda k: k.isNotNull() & (k != ""))
    more = F.when(F.size(listed) > 5, "…").otherwise("")
    third = F.when(F.size(listed) > 0, F.concat(F.lit("Données exposées : "), F.array_join(F.slice(listed, 1, 5), ", "), more, F.lit(".")))
    whole = F.concat_ws(" ", first, second, third)
    kept = F.trim(F.coalesce(fallback, F.lit("")))
    return F.when((whole == "") | ((said == "") & (F.length(kept) > SUBSTANTIAL)), kept).otherwise(whole)


def primary_claim(claims: DataFrame, key: str, kind: str) -> DataFrame:
    """N-12: per key the claim of a type that stands: by status, then date, then evidence (missing first).

    `claims` has key, type, status, value, date, evidence.
    """
    rows = claims.filter(F.col("type") == kind).withColumn("status", _claim_status(F.col("status")))
    order = F.struct(-_weight(F.col("status")), F.coalesce("date", F.lit("")), F.coalesce("evidence", F.lit("")), F.coalesce("value", F.lit("")))
    return rows.groupBy(key).agg(F.min_by(F.struct("status", "value", "date", "evidence"), order).alias("c")).select(key, "c.*")


def claim_history(claims: DataFrame, key: str) -> DataFrame:
    """N-12: a key's claims, equal ones once, with their place in time: by date (none: last), status and evidence."""
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("value", "date")}
    evidence = F.trim(F.regexp_replace(F.coalesce("evidence", F.lit("")), r"\s+", " "))
    rows = claims.select(key, "type", _claim_status(F.col("status")).alias("status"), *[v.alias(c) for c, v in text.items()], evidence.alias("evidence")).distinct()
    order = [_or(F.col("date"), "9999-99-99"), -_weight(F.col("status")), F.col("evidence"), F.col("type"), F.col("value")]
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))


def _claim_status(status: Column) -> Column:
    plain = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    return F.when(plain.isin(*CLAIM_ORDER), plain).otherwise("unknown")


def _weight(status: Column) -> Column:
    return F.coalesce(*[F.when(status == s, w) for s, w in CLAIM_ORDER.items()])
