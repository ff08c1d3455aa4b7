"""Joins (J-*), set operations (U-*) and snapshot differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import half_even


def within_days(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, days: int) -> DataFrame:
    """J-07, J-10, J-12: pairs of equal keys at most `days` apart.

    Either side's days fall into buckets of `days` + 1; the right side goes to its bucket and both neighbours, so pairs
    meet through an equi-join and a key with many rows meets only itself nearby.
    """
    step = days + 1
    lhs = left.withColumn("_b", F.floor(F.unix_date(F.col(left_day)) / step))
    near = F.explode(F.array(*[F.floor(F.unix_date(F.col(right_day)) / step) + d for d in (-1, 0, 1)]))
    rhs = right.withColumn("_b", near)
    gap = F.abs(F.datediff(F.col(left_day), F.col(right_day)))
    return lhs.join(rhs, [*keys, "_b"]).filter(gap <= days).drop("_b")


def unique_or_reject(pairs: DataFrame, key: str, candidate: str) -> DataFrame:
    """J-10, J-11: key, candidate (null unless there is exactly one), status MATCHED or AMBIGUOUS."""
    found = pairs.groupBy(key).agg(F.min(candidate).alias("lo"), F.max(candidate).alias("hi"))
    one = F.col("lo") == F.col("hi")
    return found.select(key, F.when(one, F.col("lo")).alias(candidate), F.when(one, "MATCHED").otherwise("AMBIGUOUS").alias("status"))


def best_match(pairs: DataFrame, key: str, candidate: str, score: str) -> DataFrame:
    """J-07: the candidate with the best score; a tie of the best is ambiguous and gives none."""
    w = Window.partitionBy(key)
    top = pairs.withColumn("_top", F.max(score).over(w)).filter(F.col(score) == F.col("_top"))
    return top.groupBy(key, F.col("_top").alias(score)).agg(
        F.when(F.countDistinct(candidate) == 1, F.min(candidate)).alias(candidate),
        F.when(F.countDistinct(candidate) == 1, "MATCHED").otherwise("AMBIGUOUS").alias("status"),
    )


def fill_unknown(items: DataFrame, reference: DataFrame, key: str, fields: list[str], unknown: str) -> DataFrame:
    """J-04: items with unknown fields taken from the reference's known ones."""
    ref = reference.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = items.join(ref, key, "left")
    for f in fields:
        missing = F.coalesce(F.col(f), F.lit("")).isin("", unknown)
        joined = joined.withColumn(f, F.when(missing & F.col(f"_{f}").isNotNull(), F.col(f"_{f}")).otherwise(F.col(f)))
    return joined.drop(*[f"_{f}" for f in fields])


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """J-18: key, change (ADDED, REMOVED, CHANGED), the changed fields sorted; unchanged rows are left out."""
    b = before.select(key, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("in_b"))
    a = after.select(key, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("in_a"))
    both = b.join(a, key, "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"b_{f}").eqNullSafe(F.col(f"a_{f}")), F.lit(f)) for f in sorted(fields)]))
    kind = F.when(F.col("in_b").isNull(), "ADDED").when(F.col("in_a").isNull(), "REMOVED").when(F.size(changed) > 0, "CHANGED")
    names = F.when(kind == "CHANGED", F.array_join(changed, ",")).otherwise("")
    return both.select(key, kind.alias("change"), names.alias("fields")).filter("change IS NOT NULL")


def confusion(joined: DataFrame, truth: Column, told: Column, *by: str) -> DataFrame:
    """A-27, J-19: tp, fp, fn, tn, precision, recall and accuracy in percent, 2 places."""
    tp, fp = F.count_if(truth & told), F.count_if(~truth & told)
    fn, tn = F.count_if(truth & ~told), F.count_if(~truth & ~told)
    c = joined.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))

    def pct(a: Column, b: Column) -> Column:
        return half_even(100.0 * a / F.nullif(b, F.lit(0)), 2)

    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return c.withColumns(
        {
            "precision": pct(F.col("tp"), F.col("tp") + F.col("fp")), "recall": pct(F.col("tp"), F.col("tp") + F.col("fn")),
            "accuracy": pct(F.col("tp") + F.col("tn"), total),
        }
    )


def upsert(existing: DataFrame, incoming: DataFrame, key: str, first_seen: str) -> DataFrame:
    """D-12: incoming rows win by key but keep the earliest `first_seen`."""
    columns = [c for c in existing.columns if c != key]
    rows = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    best = rows.groupBy(key).agg(F.max_by(F.struct(*columns), "_new").alias("r"), F.min(first_seen).alias("seen"))
    return best.select(key, *[(F.col("seen") if c == first_seen else F.col(f"r.{c}")).alias(c) for c in columns])


def replace_sources(existing: DataFrame, incoming: DataFrame, source: str) -> DataFrame:
    """J-22: rows of sources that are read anew go, then the new ones come."""
    return existing.join(incoming.select(source).distinct(), source, "left_anti").unionByName(incoming)


def _looked_up(source: Column, native: Column, url: Column, item: Column) -> Column:
    """By what a row is found: native id of a source, else url of a source, else its own id; null for none of them."""

    def by(stage: str, within: Column, value: Column) -> Column:
        return F.struct(F.lit(stage).alias("stage"), within.alias("within"), value.alias("value"))

    found = F.when((source != "") & (native != ""), by("native", source, native)).when((source != "") & (url != ""), by("url", source, url))
    return found.when(item != "", by("id", F.lit(""), item))


def _placed(items: DataFrame) -> DataFrame:
    """Items as they can be found: look, url, date, organisation, item; one row for each way."""
    blank = F.lit("")
    fields = {c: F.coalesce(F.col(c).cast("string"), blank) for c in ("source", "native", "url", "date", "organisation", "item")}
    s, n, u, i = (F.col(c) for c in ("source", "native", "url", "item"))
    ways = F.array_compact(F.array(F.when(n != "", _looked_up(s, n, blank, blank)), _looked_up(s, blank, u, blank), _looked_up(blank, blank, blank, i)))
    return items.select(*[v.alias(c) for c, v in fields.items()]).select(F.explode(ways).alias("look"), "url", "date", "organisation", "item")


def _asked(refs: DataFrame) -> DataFrame:
    fields = ("source", "native", "url", "date", "organisation", "item")
    clean = refs.select("ref", *[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in fields])
    look = _looked_up(F.col("source"), F.col("native"), F.col("url"), F.col("item"))
    return clean.select("ref", look.alias("look"), F.col("url").alias("_url"), F.col("date").alias("_date"), F.col("organisation").alias("_organisation"))


#: What can agree, of what weight: url before day before name.
_NARROWING = (("url", 4), ("date", 2), ("organisation", 1))


def _by_agreement(rows: DataFrame, prefix: str, given: bool) -> DataFrame:
    """Rows once for each set of fields in which they may agree (its weights' sum is `level`), other fields blank.

    A native id is narrowed by all fields, an url by day and name, an id by nothing. `given`: blank fields agree with nothing.
    """
    stage = F.col("look.stage")
    most = F.when(stage == "native", 7).when(stage == "url", 3).otherwise(0)
    each = rows.withColumn("level", F.explode(F.sequence(F.lit(0), most)))
    for name, weight in _NARROWING:
        counts = F.col("level").bitwiseAND(F.lit(weight)) > 0
        if given:
            each = each.filter(~counts | (F.col(prefix + name) != ""))
        each = each.withColumn(prefix + name, F.when(counts, F.col(prefix + name)).otherwise(""))
    return each.select(*[c for c in each.columns if c not in {prefix + n for n, _ in _NARROWING}], *[F.col(prefix + n).alias(f"by_{n}") for n, _ in _NARROWING])


_LOOK = ["look", "level", "by_url", "by_date", "by_organisation"]


def _found(refs: DataFrame, items: DataFrame) -> DataFrame:
    """ref, and its greatest level at which items agree with it: n, item (the smallest), and what it looked by."""
    held = _by_agreement(_placed(items), "", False).groupBy(*_LOOK).agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("item"))
    met = _by_agreement(_asked(refs), "_", True).join(held, _LOOK)
    return met.groupBy("ref").agg(F.max_by(F.struct("n", "item", *_LOOK), "level").alias("b")).select("ref", "b.*")


def resolved_sides(refs: DataFrame, items: DataFrame) -> DataFrame:
    """J-09: ref, status, item, candidates: the one item that a stable reference means.

    Both have source, native, url, date, organisation, item; `refs` also ref, which is unique. A reference is looked up by
    source and native id if it has them, else by source and url, else by item id, with no way back from a failed look. Of
    several items found, those that agree in url stay if there are any, then those of the day, then those of the name: which
    are the items of greatest agreement in this order. RESOLVED with one left, AMBIGUOUS with more (`candidates` of
    them, see `ambiguous_items`), LEGACY for a single item by its id, else MISSING. Nulls are blank; blank fields do not narrow.

    Items are counted for each set of fields (eight at most) and a reference meets one count for each, so references and
    items of one common id or url make no pairs.
    """
    best = _found(refs, items).select("ref", "n", "item")
    rows = _asked(refs).select("ref", "look").join(best, "ref", "left")
    by_id, n = F.coalesce(F.col("look.stage") == "id", F.lit(False)), F.coalesce("n", F.lit(0)).cast("long")
    status = F.when(n == 1, F.when(by_id, "LEGACY").otherwise("RESOLVED")).when((n > 1) & ~by_id, "AMBIGUOUS").otherwise("MISSING")
    return rows.select("ref", status.alias("status"), F.when(n == 1, F.col("item")).alias("item"), F.when(by_id & (n != 1), 0).otherwise(n).alias("candidates"))


def ambiguous_items(refs: DataFrame, items: DataFrame) -> DataFrame:
    """J-09: ref, item: the items between which an ambiguous reference cannot choose; as many rows as `candidates` say."""
    unsure = _found(refs, items).filter((F.col("n") > 1) & (F.col("look.stage") != "id")).drop("n", "item")
    return unsure.join(_by_agreement(_placed(items), "", False), _LOOK).select("ref", "item")
