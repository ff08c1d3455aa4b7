"""String scalars as Column expressions; every one stays in the JVM."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.match import bind

# Suffixes, legal forms and trailing words that an organisation key drops.
TLDS = ("fr", "com", "net", "org", "eu", "io", "app")
LEGAL_FORMS = ("sas", "sarl", "sa", "eurl")
INCIDENT_SUFFIXES = ("pirate", "piratee", "pirates", "piratees", "revendique", "revendiquee")
STOPWORDS = ("de", "du", "des", "la", "le", "les", "d", "l", "a", "au", "aux", "pour", "en", "et")


def _folding() -> tuple[str, str]:
    """Characters that stand for one other, marks aside, in compatibility form, and those; then marks, which go."""
    pairs, marks = [], []
    for code in range(0xA0, 0x10000):
        c = chr(code)
        if unicodedata.combining(c):
            marks.append(c)
        elif not 0xD800 <= code < 0xE000:
            base = [x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)]
            if len(base) == 1 and base[0] != c and ord(base[0]) < 0x10000:
                pairs.append((c, base[0]))
    return "".join([a for a, _ in pairs] + marks), "".join(b for _, b in pairs)


_FOLDED, _PLAIN = _folding()
#: Signs of several letters, a fixed table: the ligatures of U+FB00 on, and others that stand in names.
_SEVERAL = (("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"), ("\ufb05", "st"), ("\ufb06", "st"), ("\u2122", "TM"), ("\u2116", "No"))


def strip_accents(c: Column) -> Column:
    """T-01: letters without their marks, composed or not, and compatibility forms as what they stand for.

    Signs of several letters outside the fixed table stay, as do those beyond U+FFFF.
    """
    several = c
    for sign, letters in _SEVERAL:
        several = F.replace(several, F.lit(sign), F.lit(letters))
    plain = F.translate(F.when(c.rlike(f"[{''.join(s for s, _ in _SEVERAL)}]"), several).otherwise(c), _FOLDED, _PLAIN)
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain).otherwise(c)


def collapse(c: Column) -> Column:
    """White space runs as one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def searchable(c: Column) -> Column:
    """T-02: no accents, lower case, other signs than word characters as spaces, collapsed."""

    def spaced(folded: Column) -> Column:
        # white space is no word character either, so one pass makes a single space of every run of both
        foreign = folded.rlike(r"[^\x00-\x7F]")
        return F.trim(F.when(foreign, F.regexp_replace(folded, r"(?U)\W+", " ")).otherwise(F.regexp_replace(folded, r"\W+", " ")))

    return bind(F.lower(strip_accents(F.coalesce(c, F.lit("")))), spaced)


def contains_words(haystack: Column, needle: str | Column) -> Column:
    """T-03: whether a searchable text holds a searchable phrase between word boundaries."""
    n = F.lit(needle) if isinstance(needle, str) else needle
    return F.contains(F.concat(F.lit(" "), haystack, F.lit(" ")), F.concat(F.lit(" "), n, F.lit(" ")))


def contains_prefix(haystack: Column, prefix: str | Column) -> Column:
    """T-04: whether a word of a searchable text starts with a prefix."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.contains(F.concat(F.lit(" "), haystack), F.concat(F.lit(" "), p))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def base_key(c: Column, trailing: tuple[str, ...] = INCIDENT_SUFFIXES) -> Column:
    """T-05: an organisation's key: no accents, site suffix, punctuation, legal form or trailing incident words; a number
    joins the word before it. Letters of any script stay, as does the underscore."""
    plain = F.regexp_replace(F.lower(F.trim(strip_accents(F.coalesce(c, F.lit(""))))), r"\.(" + "|".join(TLDS) + ")$", "")
    words = F.split(F.trim(F.regexp_replace(plain, r"(?U)\W+", " ")), " ")
    key = F.array_join(F.filter(words, lambda w: ~w.isin(*LEGAL_FORMS)), " ")
    if trailing:
        key = F.regexp_replace(key, "(?:(?:^| )(?:" + "|".join(trailing) + "))+$", "")
    return F.regexp_replace(key, r"(?<=[a-z]) (?=[0-9])", "")


def acronym(c: Column) -> Column:
    """T-07: initials of the words of an organisation's key that are no stop words, in upper case."""
    words = F.filter(F.split(base_key(c), " "), lambda w: (w != "") & ~w.isin(*STOPWORDS))
    return F.upper(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))


#: Signs that decorate a name wherever they stand, and those that go at its ends.
DECORATION = r"[\xA0\u200B\u2022\u25A0-\u27BF\uFE0F\x{1F000}-\x{1FAFF}]"
NAME_ENDS = " -\u2013\u2014\u2022\t"


def clean_name(c: Column) -> Column:
    """T-08: a name without decoration, brackets at its end or www.; white space collapsed. Null is empty."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), DECORATION, " ")
    out = F.btrim(F.regexp_replace(plain, r"(?U)\s+", " "), F.lit(NAME_ENDS))
    out = F.trim(F.regexp_replace(out, r"(\s*[\(\[][^\)\]]*[\)\]]\s*)+$", ""))
    return F.btrim(F.regexp_replace(out, r"^(?i)www\.", ""), F.lit(NAME_ENDS))


def leading_marker(c: Column) -> Column:
    """T-09: the decoration before a name."""
    return F.trim(F.regexp_extract(F.coalesce(c, F.lit("")), r"^([^\p{L}\p{N}(\[]+)", 1))


def cut_at(c: Column, markers: list[str]) -> Column:
    """T-10: text before the earliest marker that does not open it, without separators at either end.

    Markers are looked for in the searchable form (T-02), whose places are taken for those of the text.
    """

    def found(blob: Column) -> Column:
        at = F.filter(F.array(*[F.locate(m, blob) for m in markers]), lambda p: p > 1)
        return F.when(F.size(at) > 0, F.btrim(F.substring(c, F.lit(1), F.array_min(at) - 1), F.lit(" -\u2013\u2014\u2022,;\t"))).otherwise(c)

    return bind(searchable(c), found)


def split_list(c: Column) -> Column:
    """T-11: parts between commas and the word "et", trimmed of spaces and dots, without empties."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r",|\s+et\s+"), lambda x: F.btrim(x, F.lit(" .")))
    return F.filter(parts, lambda x: x != "")


def sentences(c: Column, least: int = 15, most: int = 900) -> Column:
    """T-12: sentences of `least` to `most` characters."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: F.length(s).between(least, most))


def norm_key(c: Column) -> Column:
    """T-13: lower case, everything but a-z and 0-9 as one space."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(c, F.lit("")))), r"[^a-z0-9]+", " "))


def url_host(c: Column) -> Column:
    """T-14: lower-case host without www.; a dotted string without a scheme is taken for https."""
    whole = F.when(c.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), c).when(F.contains(c, F.lit(".")), F.concat(F.lit("https://"), c))
    return F.regexp_replace(F.lower(F.try_parse_url(whole, F.lit("HOST"))), r"^www\.", "")


def public_link(urls: Column) -> Column:
    """T-15: the first http(s) link that is no onion service."""
    ok = F.filter(urls, lambda u: u.rlike("^https?://") & ~url_host(u).endswith(".onion"))
    return F.get(ok, 0)


def grouped_number(c: Column) -> Column:
    """T-16: an integer with spaces between groups of three digits."""
    return F.translate(F.format_number(c, 0), ",", " ")


def joined_list(parts: Column, word: str = "et") -> Column:
    """T-16: a, b et c."""
    head = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ", ")
    return F.when(F.size(parts) <= 1, F.array_join(parts, "")).otherwise(
        F.concat(head, F.lit(f" {word} "), F.element_at(parts, -1))
    )


def truncated(c: Column, most: int) -> Column:
    """T-17: at most `most` characters, cut at a word, with an ellipsis where something went."""
    cutoff = F.regexp_replace(F.substring(c, 1, most), r"\s+\S*\z", "")
    return F.when(F.length(c) <= most, c).otherwise(F.concat(cutoff, F.lit("…")))


def browse_normal(c: Column) -> Column:
    """T-18: accents off, lower case, white space collapsed; punctuation stays."""
    return collapse(F.lower(strip_accents(F.coalesce(c, F.lit("")))))


def word_sequence_in(longer: Column, shorter: Column) -> Column:
    """T-19: the shorter key's words stand in a row in the longer key, and the keys differ in length."""
    return (F.size(F.split(longer, " ")) > F.size(F.split(shorter, " "))) & contains_words(longer, shorter)


def same_letters(a: Column, b: Column) -> Column:
    """T-20: equal without spaces, with another number of words."""
    return (F.replace(a, F.lit(" "), F.lit("")) == F.replace(b, F.lit(" "), F.lit(""))) & (
        F.size(F.split(a, " ")) != F.size(F.split(b, " "))
    )


def same_words(a: Column, b: Column) -> Column:
    """T-21: the same two or more words in another order."""
    return (a != b) & (F.size(F.split(a, " ")) > 1) & (sorted_words(a) == sorted_words(b))


def sorted_words(a: Column) -> Column:
    return F.array_join(F.array_sort(F.split(a, " ")), " ")


def name_tokens(c: Column, ignored: tuple[str, ...] = STOPWORDS + LEGAL_FORMS) -> Column:
    """T-22: distinct words of three letters or more that say something."""
    return F.array_distinct(F.filter(F.split(norm_key(c), " "), lambda w: (F.length(w) >= 3) & ~w.isin(*ignored)))


def grounded(evidence: Column, text: Column) -> Column:
    """T-23: evidence, not blank, stands verbatim in the text up to white space."""
    return (collapse(evidence) != "") & F.contains(collapse(text), collapse(evidence))


def numbers_supported(value: Column, evidence: Column) -> Column:
    """T-24: every number of the value is a number of the evidence."""
    pattern = F.lit(r"[0-9]+")
    return F.size(F.array_except(F.regexp_extract_all(value, pattern, F.lit(0)), F.regexp_extract_all(evidence, pattern, F.lit(0)))) == 0


def strip_html(c: Column) -> Column:
    """S-23: tags as spaces, the common references decoded, collapsed."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return collapse(out)
