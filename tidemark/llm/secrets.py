r"""Secret scanning with DataFrame functions only.

Three base patterns give spans by the split trick: `split(text, p, -1)` is what lies between the matches that
`regexp_extract_all(text, p, 0)` gives, so running sums of both lengths are the matches' offsets in code points. Matches
become rows; windows over a document's rows make the sums and find what overlaps, in one shuffle of the matches alone.

Beyond them, candidate strings (runs of token characters) are scanned with a sliding window: per character class (hex
digits, alphanumeric, base64) the Shannon entropy of a window is kept by incremental counts. One character enters and
one leaves, and the sum of c*log2(c) changes by two differences. A candidate whose largest window entropy reaches its
class's threshold is a span, unless an allow-list rule or a base span suppresses it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed patterns. ASSIGN is matched as it stands and short values are dropped afterwards, since a short match still
#: uses up its characters; the length bounds of the other two can be part of the pattern, as no shorter match can hide
#: a longer one.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: What an ASSIGN match must end with: a value of at least six characters.
ASSIGN_LONG = r"""(?i)^(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}$"""


@dataclass(frozen=True)
class EntropyRule:
    """Windows of `window` characters of candidates that match `shape` are secret from `threshold` bits on."""

    kind: str
    shape: str
    threshold: float
    window: int = 20


#: A class is the first whose shape matches. A random window of 20 has about 3.3 bits in hex and 4.1 in base64.
RULES = (
    EntropyRule("entropy_hex", r"^[0-9A-Fa-f]+$", 3.0),
    EntropyRule("entropy_alnum", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+$", 3.7),
    EntropyRule("entropy_base64", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+$", 3.7),
)
#: Runs that look random but are none: dates and versions, identifiers with dashes in UUID form, paths, words in
#: snake or kebab case, and documentation samples (a long run may hold such a word by chance).
ALLOW = (
    r"^[0-9_=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?=/?[A-Za-z]+[/_-][A-Za-z])(?!.*[/_-]{2})(?!.*[_-]$)[A-Za-z/_-]+$",
    r"(?i)^(?=.{20,80}$).*(example|sample|placeholder|xxxx|lorem)",
)
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"


#: Characters of a candidate whose window counts are kept in one pass; longer candidates are cut into such pieces, each
#: with the window before it.
PIECE = 4096
#: The signs a candidate can hold; the state keeps a count for each, and one for all others.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_ZERO = 32


def _matches(text: Column, pattern: str, rank: int, keep: str | None = None) -> Column:
    """array<struct<rank, at, gap, m, keep>> of the matches in order; `gap` is what lies between a match and the one before.

    `keep` is a pattern that a match must hold to count as a span.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    both = F.arrays_zip(hits.alias("m"), gaps.alias("gap"))
    made = F.transform(
        F.slice(both, 1, F.greatest(F.size(hits), F.lit(1))),
        lambda x, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("at"), x["gap"].alias("gap"), x["m"].alias("m"),
            (x["m"].rlike(keep) if keep else F.lit(True)).alias("keep"),
        ),
    )
    empty = F.array().cast("array<struct<rank:int,at:int,gap:int,m:string,keep:boolean>>")
    return F.when(text.rlike(pattern), made).otherwise(empty)


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with `value` computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def window_entropy(candidate: Column, window: int) -> Column:
    """Largest Shannon entropy, in bits, of `window` neighbouring characters; 0.0 for shorter strings.

    State: the counts of the window's characters, one sign of a string for each character of ALPHABET, and the sum of
    c*log2(c). A step takes one character out of the window or lets one in, and changes one count and the sum by one
    difference. Long candidates are cut into pieces that overlap by a window less one.
    """
    cut_at = rf"(?s).{{1,{PIECE}}}"
    pieces = F.regexp_extract_all(candidate, F.lit(cut_at), F.lit(0))
    with_tail = _bound(
        pieces,
        lambda ps: F.transform(
            ps, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.right(F.get(ps, i - 1), F.lit(window - 1)), p))
        ),
    )
    return F.coalesce(F.array_max(F.transform(with_tail, lambda p: _piece_entropy(p, window))), F.lit(0.0))


def _piece_entropy(piece: Column, window: int) -> Column:
    other = F.lit(len(ALPHABET) + 1)
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    codes = F.transform(F.regexp_extract_all(piece, F.lit("(?s)."), F.lit(0)), lambda c: F.coalesce(F.nullif(F.instr(F.lit(ALPHABET), c), F.lit(0)), other))
    # (place of the sign, +1 or -1, whether the window is full after it): a sign leaves before the next comes in
    events = _bound(
        codes,
        lambda cs: F.flatten(
            F.transform(
                cs,
                lambda c, i: F.when(
                    i >= window,
                    F.array(
                        F.struct(F.get(cs, i - window).alias("sign"), F.lit(-1).alias("by"), F.lit(False).alias("full")),
                        F.struct(c.alias("sign"), F.lit(1).alias("by"), F.lit(True).alias("full")),
                    ),
                ).otherwise(F.array(F.struct(c.alias("sign"), F.lit(1).alias("by"), (i == window - 1).alias("full")))),
            )
        ),
    )
    start = F.struct(F.lit(chr(_ZERO) * (len(ALPHABET) + 1)).alias("n"), F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("low"))

    def step(acc: Column, e: Column) -> Column:
        count = F.ascii(F.substring(acc["n"], e["sign"], 1)) - _ZERO
        total = acc["sum"] + F.get(table, count + e["by"]) - F.get(table, count)
        return F.struct(
            F.overlay(acc["n"], F.char(count + e["by"] + _ZERO), e["sign"], 1).alias("n"),
            total.alias("sum"),
            F.when(e["full"], F.least(acc["low"], total)).otherwise(acc["low"]).alias("low"),
        )

    # the smallest sum of c*log2(c) is the largest entropy
    most = F.aggregate(events, start, step, lambda acc: F.lit(math.log2(window)) - acc["low"] / window)
    return F.coalesce(most, F.lit(0.0))


def scan_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[EntropyRule, ...] = RULES,
    allow: tuple[str, ...] = ALLOW,
) -> DataFrame:
    """One row per row of `docs`: doc_id, found array<struct<s, rank, e, kind, m>> sorted by start, then kind.

    Offsets count code points, the end is exclusive, `m` is the matched text. Base spans always stay; an entropy span
    that overlaps one is left out. Null and empty texts have no spans; repeated rows repeat; an empty table stays empty.
    Work grows in proportion to a text's length and matches; long runs are judged whole.
    """
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    keyed = keyed.withColumn("_key", F.xxhash64("doc_id", "_t"))
    t = F.col("_t")
    base = F.concat(
        _matches(t, ASSIGN, 0, keep=ASSIGN_LONG), _matches(t, ACCESS, 1), _matches(t, HEX, 2), _matches(t, CANDIDATE, 3)
    )
    # A row's own number tells repeated rows apart until one of them stands for all.
    rows = keyed.select("_key", F.monotonically_increasing_id().alias("_row"), base.alias("_all"))
    rows = rows.filter(F.size("_all") > 0).select("_key", "_row", F.inline("_all")).repartition("_key")
    by_kind = Window.partitionBy("_key", "_row", "rank").orderBy("at")
    end = F.sum(F.col("gap").cast("long") + F.length("m")).over(by_kind)
    spans = rows.withColumn("e", end).withColumn("s", F.col("e") - F.length("m")).filter("keep")
    # An entropy span must be clear of the base spans before it and after it.
    document, earlier = Window.partitionBy("_key", "_row"), (Window.unboundedPreceding, -1)
    is_base = F.col("rank") < 3
    before = F.max(F.when(is_base, F.col("e"))).over(document.orderBy("s", "rank").rowsBetween(*earlier))
    # Backwards, as Spark adds up a frame that runs to the end anew for each row.
    backwards = document.orderBy(F.desc("s"), F.desc("rank")).rowsBetween(*earlier)
    after = F.min(F.when(is_base, F.col("s"))).over(backwards)
    free = (F.coalesce(before, F.lit(0)) <= F.col("s")) & (F.coalesce(after, F.col("e")) >= F.col("e"))
    spans = spans.withColumn("_free", is_base | free).filter("_free")
    if allow:
        spans = spans.filter(is_base | ~_any_match(F.col("m"), allow))
    kind = F.when(F.col("rank") == 0, "assign").when(F.col("rank") == 1, "access").when(F.col("rank") == 2, "hex")
    order = F.when(is_base, F.col("rank"))
    for i, rule in enumerate(rules):
        hit = F.col("m").rlike(rule.shape)
        kind = kind.when(hit, F.when(window_entropy(F.col("m"), rule.window) >= rule.threshold, F.lit(rule.kind)))
        order = order.when(hit, F.lit(3 + i))
    judged = spans.select("_key", "_row", "s", order.alias("rank"), "e", kind.alias("kind"), "m").filter("kind IS NOT NULL")
    lists = judged.groupBy("_key", "_row").agg(F.array_sort(F.collect_list(F.struct("s", "rank", "e", "kind", "m"))).alias("found"))
    lists = lists.groupBy("_key").agg(F.first("found").alias("found"))
    none = F.array().cast(lists.schema["found"].dataType)
    return keyed.select("doc_id", "_key").join(lists, "_key", "left").select("doc_id", F.coalesce("found", none).alias("found"))


def _any_match(x: Column, patterns: tuple[str, ...]) -> Column:
    out = x.rlike(patterns[0])
    for p in patterns[1:]:
        out = out | x.rlike(p)
    return out


def joined_spans(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def secret_report(found: DataFrame) -> DataFrame:
    """Counts and digests of `scan_secrets` output: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    base = F.filter("found", lambda x: x["rank"] < 3)

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("found")).alias("spans"),
    )
