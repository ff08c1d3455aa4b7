"""Date, number, hash and score scalars as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.match import bind
from tidemark.functions.text import searchable, strip_accents

# Month names, French and English, without accents, and English abbreviations.
MONTHS = {
    "janvier": 1, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "aout": 8, "septembre": 9,
    "octobre": 10, "novembre": 11, "decembre": 12, "january": 1, "february": 2, "march": 3, "april": 4, "may": 5,
    "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}


def strict_date(c: Column) -> Column:
    """C-02: an ISO day, else null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def parse_date(c: Column) -> Column:
    """C-01: ISO, RFC 822, year-month-day, day/month/year, day.month.year, then day month-name year; null on failure.

    The text and its folded form are made once, each way to write a day is looked for once, and only if those before failed.
    """
    ymd, dmy, dots = r"\b\d{4}-\d{2}-\d{2}\b", r"\b\d{2}/\d{2}/\d{4}\b", r"\b\d{2}\.\d{2}\.\d{4}\b"
    iso, named = r"^(\d{4}-\d{2}-\d{2})([t ].*)?$", r"\b\d{1,2}\s+[a-z]+\s+\d{4}\b"

    def turned(found: Column) -> Column:
        return F.concat_ws("-", F.substring(found, 7, 4), F.substring(found, 4, 2), F.substring(found, 1, 2))

    def spelled(words: Column) -> Column:
        day, word, year = (F.get(words, n) for n in range(3))
        month = F.when(F.lit(False), F.lit(None).cast("string"))
        for number in sorted(set(MONTHS.values())):
            month = month.when(word.isin(*[name for name, n in MONTHS.items() if n == number]), f"{number:02}")
        return F.concat_ws("-", year, month, F.lpad(day, 2, "0"))

    def read(text: Column) -> Column:
        def numeric(plain: Column) -> Column:
            return F.coalesce(
                bind(F.regexp_extract(plain, iso, 1), strict_date), bind(F.regexp_extract(plain, ymd, 0), strict_date),
                *[bind(bind(F.regexp_extract(plain, p, 0), turned), strict_date) for p in (dmy, dots)],
            )

        # words of a searchable text stand one space apart
        words = F.split(F.regexp_extract(searchable(text), named, 0), " ")
        return F.coalesce(bind(F.lower(strip_accents(F.trim(text))), numeric), bind(bind(words, spelled), strict_date))

    return bind(F.coalesce(c, F.lit("")), read)


def days_between(earlier: Column, later: Column) -> Column:
    """C-03: signed gap in days."""
    return F.datediff(later, earlier).cast("long")


def best_date(event: Column, published: Column) -> Column:
    """C-04: the event's day, else the publication's; empty strings count as missing."""
    return F.coalesce(F.nullif(event, F.lit("")), F.nullif(published, F.lit("")))


def window_days(start: Column, end: Column) -> Column:
    """C-06: days of a closed interval, 1 at least."""
    return F.greatest(F.lit(1), F.datediff(end, start) + 1).cast("long")


def date_ordinal(c: Column) -> Column:
    """C-07: the digits of a date as a number, 0 if there are none."""
    return F.coalesce(F.regexp_replace(c, r"[^0-9]", "").try_cast("bigint"), F.lit(0))


def month_of(c: Column) -> Column:
    """C-08."""
    return F.date_format(c, "yyyy-MM")


def half_even(c: Column, places: int = 0) -> Column:
    """A double at so many decimals, half-even on its product with their power of ten, as SQL's round_even has it.

    bround goes by the shortest decimal text instead, and differs where a half is no whole binary number (3162 / 4800).
    """
    power = 10.0**places
    return F.rint(c * power) / power if places else F.rint(c)


def pct_change(current: Column, previous: Column) -> Column:
    """C-09: to one decimal, half-even; from 0: 100 if there is something now, else null."""
    change = half_even((current - previous) * 100.0 / F.nullif(previous, F.lit(0)), 1)
    return F.when(previous == 0, F.when(current > 0, 100.0)).otherwise(change)


def ratio(part: Column, total: Column, places: int = 4, scale: float = 1.0) -> Column:
    """C-10: safe division, half-even, 0 where the total is."""
    return F.coalesce(half_even(part * scale / F.nullif(total, F.lit(0)), places), F.lit(0.0))


def scaled_number(number: Column, scale: Column) -> Column:
    """C-12: digits with separators, times the scale word."""
    digits = F.regexp_replace(number, r"[\s.,  ]", "").try_cast("bigint")
    factor = F.when(scale.rlike("^(?i)million"), 1_000_000).when(scale.rlike("^(?i)(millier|mille)"), 1_000).otherwise(1)
    return digits * factor


def digits_only(c: Column) -> Column:
    """C-13: the digits if nothing else but separators is there."""
    bare = F.regexp_replace(c, r"[\s.,  ]", "")
    return F.when(bare.rlike(r"^\d+$"), bare)


def item_id(source: Column, native: Column, date: Column, key: Column, url: Column) -> Column:
    """C-14: ITM- and 16 hex digits of the native id's hash, else of the natural key's."""
    has = F.coalesce(native, F.lit("")) != ""
    payload = F.when(has, F.concat_ws("|", F.coalesce(source, F.lit("")), F.lit("SOURCE_ITEM"), native)).otherwise(
        F.concat_ws("|", *[F.coalesce(x, F.lit("")) for x in (source, date, key, url)])
    )
    return F.concat(F.lit("ITM-"), F.substring(F.sha2(payload, 256), 1, 16))


def incident_id(key: Column, anchor: Column) -> Column:
    """C-14: INC- and 12 upper-case hex digits."""
    return F.concat(F.lit("INC-"), F.upper(F.substring(F.sha2(F.concat_ws("|", F.coalesce(key, F.lit("")), F.coalesce(anchor, F.lit(""))), 256), 1, 12)))


def content_hash(source: Column, version: Column, text: Column) -> Column:
    """C-15: SHA-256 of the parts with NUL between them."""
    nul = F.lit("\0")
    return F.sha2(F.concat(source, nul, version, nul, text), 256)


def canonical_hash(**fields: Column) -> Column:
    """C-16: SHA-256 of compact JSON with sorted keys; null is an empty string."""
    parts = [F.coalesce(c.cast("string"), F.lit("")).alias(k) for k, c in sorted(fields.items())]
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def coverage(done: Column, expected: Column) -> Column:
    """C-17: whole percent between 0 and 100; 100 where nothing was expected."""
    share = F.least(F.lit(100), F.greatest(F.lit(0), half_even(100.0 * done / F.nullif(expected, F.lit(0))))).cast("long")
    return F.when(expected <= 0, F.lit(100).cast("long")).otherwise(share)


def freshness_score(days: Column) -> Column:
    """C-18; 0 where no day is known."""
    return F.when(days.isNull(), 0.0).when(days <= 2, 100.0).when(days <= 7, 80.0).when(days <= 30, 50.0).otherwise(20.0)


def efficiency_score(per_call: Column) -> Column:
    """C-18."""
    return F.when(per_call >= 2, 100.0).when(per_call >= 1, 75.0).when(per_call >= 0.5, 50.0).when(per_call > 0, 25.0).otherwise(0.0)


def weighted_score(parts: list[tuple[Column, float]]) -> Column:
    """C-19: mean of the parts that are there, by weight, to one decimal; 0 if none is."""
    value = sum((F.coalesce(c * w, F.lit(0.0)) for c, w in parts), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in parts), F.lit(0.0))
    return F.coalesce(half_even(value / F.nullif(weight, F.lit(0.0)), 1), F.lit(0.0))


def grade(score: Column) -> Column:
    """C-20."""
    return F.when(score >= 80, "A").when(score >= 65, "B").when(score >= 50, "C").otherwise("D")


def cache_fresh(fetched: Column, status: Column, now: Column, days: dict[str, int], default: int) -> Column:
    """C-21: whether an answer is younger than its status allows."""
    ttl = F.lit(default)
    for k, v in days.items():
        ttl = F.when(status == k, v).otherwise(ttl)
    return F.datediff(now, fetched) < ttl


def known(c: Column, unknown: tuple[str, ...] = ("Inconnu", "Unknown")) -> Column:
    """F-09: neither missing nor evaluated without proof."""
    return F.coalesce((c != "") & ~c.isin(*unknown), F.lit(False))
