"""Rules over searchable text: markers, negations, threats (F-01...F-05, K-01, K-16), and what patterns extract (X-08, X-09, X-13)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.functions.match import bind, every_phrase, first_label, holds, phrases_in
from tidemark.functions.text import any_of, base_key, searchable

SURE_PREFIXES = tuple(p for p in P.CYBER_PREFIXES if p not in P.AMBIGUOUS_PREFIXES)


def any_phrase(blob: Column, phrases: tuple[str, ...]) -> Column:
    """Whether a searchable text holds one of the phrases between word boundaries: one pass, whatever their number."""
    return F.size(phrases_in(blob, phrases)) > 0


def any_prefix(blob: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether a word of a searchable text starts with one of the prefixes: words are first told by how they begin."""
    head = min(map(len, prefixes))
    heads = sorted({p[:head] for p in prefixes})
    whole = "^(?:" + "|".join(map(re.escape, prefixes)) + ")"
    return F.exists(F.split(blob, " "), lambda w: F.substring(w, 1, head).isin(*heads) & w.rlike(whole))


def is_physical(blob: Column) -> Column:
    """F-03: burglary rather than intrusion into systems."""
    return any_phrase(blob, P.PHYSICAL_MARKERS)


def has_marker(blob: Column) -> Column:
    """F-02: a telling cyber marker; ambiguous ones do not count in a physical context."""
    prefixed = any_prefix(blob, SURE_PREFIXES) | (any_prefix(blob, P.AMBIGUOUS_PREFIXES) & ~is_physical(blob))
    return prefixed | any_phrase(blob, P.CYBER_PHRASES)


def has_negation(blob: Column) -> Column:
    """F-04: whether a claim is denied in so many words."""
    told = any_of([F.contains(blob, F.lit(claim)) for claim in P.NEGATED_CLAIMS])
    return told & blob.rlike("|".join(P.NEGATIONS))


def without_negations(blob: Column) -> Column:
    """F-04: the text without denied claims."""
    for pattern in P.NEGATIONS:
        blob = F.regexp_replace(blob, pattern, " ")
    return F.trim(F.regexp_replace(blob, r"\s+", " "))


def looks_cyber(blob: Column) -> Column:
    """F-01: a phrase of the threat table, ambiguous ones outside a physical context only, or a marker."""
    every = every_phrase(P.THREAT_RULES)
    doubtful = tuple(p for p in every if p.startswith(P.AMBIGUOUS_PREFIXES))
    sure = tuple(p for p in every if p not in doubtful)

    def judged(hits: Column) -> Column:
        physical = holds(hits, P.PHYSICAL_MARKERS)
        marked = any_prefix(blob, SURE_PREFIXES) | (any_prefix(blob, P.AMBIGUOUS_PREFIXES) & ~physical)
        return holds(hits, (*sure, *P.CYBER_PHRASES)) | (holds(hits, doubtful) & ~physical) | marked

    return bind(phrases_in(blob, (*every, *P.CYBER_PHRASES, *P.PHYSICAL_MARKERS)), judged)


def threat_signals(blob: Column) -> Column:
    """K-01: struct of what a text says of threats: empty, negated, hits (phrases of the table outside denials), marker.

    The marker is looked for only where no phrase was found.
    """

    def told(evidence: Column) -> Column:
        return bind(phrases_in(evidence, every_phrase(P.THREAT_RULES)), lambda hits: F.struct(
            (blob == "").alias("empty"), has_negation(blob).alias("negated"), hits.alias("hits"),
            F.when(F.size(hits) == 0, has_marker(evidence)).otherwise(F.lit(False)).alias("marker"),
        ))

    return bind(F.when(has_negation(blob), without_negations(blob)).otherwise(blob), told)


def threat_of(signals: Column, default: Column | None = None) -> Column:
    """K-01: specific threats first, then the source's default, then intrusion; a denial alone is unknown.

    A default of ransomware always wins.
    """
    given = F.coalesce(default, F.lit("")) if default is not None else F.lit("")
    rules = dict(P.THREAT_RULES)
    specific = first_label(signals["hits"], tuple((label, rules[label]) for label in P.SPECIFIC))
    out = F.when(signals["empty"], F.when(given != "", given).otherwise(P.UNKNOWN)).when(given == P.RANSOMWARE, P.RANSOMWARE)
    # without a specific threat, all that can have been found is intrusion
    rest = F.when(given != "", given).when(F.size(signals["hits"]) > 0, P.INTRUSION).when(signals["negated"], P.UNKNOWN)
    return out.otherwise(F.coalesce(specific, rest.when(signals["marker"], P.OTHER).otherwise(P.UNKNOWN)))


def threat(blob: Column, default: Column | None = None) -> Column:
    """K-01 of a searchable text at once."""
    return bind(threat_signals(blob), lambda signals: threat_of(signals, default))


def claim_status(text: Column) -> Column:
    """K-16: unconfirmed, denied, confirmed or claimed, in this order; empty where nothing says so."""
    out = F.when(F.lit(False), "")
    for pattern, status in P.CLAIM_STATUS:
        out = out.when(F.coalesce(text, F.lit("")).rlike(rf"(?i)\b{pattern}\b"), status)
    return out.otherwise("")


def cves(text: Column) -> Column:
    """X-08: CVE names in upper case, sorted, each once."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?i)\b{P.CVE}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, F.upper)))


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """X-09: the first match, trimmed; empty where there is none."""
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?i)\b{pattern}\b", group))


def legal_ids(text: Column) -> Column:
    """X-13: struct of a 14-digit SIRET named as such, and the 9-digit SIREN it starts with or that is named itself."""
    digits = [F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?i)\b{name}\b\D{{0,12}}((?:\d[ .]?){{{n}}})(?!\d)", 1), r"\D", "") for name, n in (("siret", 14), ("siren", 9))]
    siret = F.when(F.length(digits[0]) == 14, digits[0]).otherwise("")
    siren = F.when(siret != "", F.substring(siret, 1, 9)).when(F.length(digits[1]) == 9, digits[1]).otherwise("")
    return F.struct(siret.alias("siret"), siren.alias("siren"))


def valid_actor(candidate: Column, organisation: Column) -> Column:
    """F-10: the candidate, unless it names nobody or the victim itself."""
    name = searchable(candidate)
    opens = F.lit(False)
    for words in P.ACTOR_OPENINGS:
        opens = opens | name.startswith(words)
    bad = name.isin(*P.ACTOR_SENTINELS) | opens | ((organisation != "") & (base_key(candidate) == base_key(organisation)))
    return F.when(bad, "").otherwise(F.trim(candidate))


def valid_third_party(candidate: Column, organisation: Column) -> Column:
    """F-11: the candidate, unless it is an article, unknown or the victim itself."""
    bad = searchable(candidate).isin(*P.THIRD_PARTY_SENTINELS) | ((organisation != "") & (base_key(candidate) == base_key(organisation)))
    return F.when(bad, "").otherwise(F.trim(candidate))


def weak_identity(name: Column) -> Column:
    """F-13: a single word that is an upper-case acronym of 2 to 12 letters or at most four signs long."""
    raw = F.trim(F.coalesce(name, F.lit("")))
    plain = searchable(raw)
    letters = F.regexp_replace(raw, r"[^\p{L}]", "")
    acronym = F.length(letters).between(2, 12) & (F.upper(letters) == letters)
    return (plain != "") & ~plain.contains(" ") & (acronym | (F.length(plain) <= 4))


def naf_sector(section: Column) -> Column:
    """K-11: the sector of a NAF section letter."""
    known = F.create_map(*[F.lit(x) for pair in P.NAF_SECTORS.items() for x in pair])
    return F.coalesce(F.element_at(known, F.upper(F.trim(section))), F.lit(P.UNKNOWN))


def department_location(department: Column) -> Column:
    """K-12: where a department lies, without guessing: the two covered overseas ones, 2A, 2B and 01 to 95."""
    value = F.upper(F.trim(F.coalesce(department, F.lit(""))))
    number = F.when(value.rlike("^[0-9]+$"), value.cast("int"))
    return F.when(value == "974", "La Réunion").when(value == "976", "Mayotte").when(value.isin("2A", "2B") | number.between(1, 95), "France").otherwise(P.UNKNOWN)


def sensitivity(value: Column) -> Column:
    """K-15: tier of a data type, the first of which a marker stands in it, anywhere; empty for none."""
    text = searchable(value)
    out = F.when(F.lit(False), "")
    for tier, markers in P.SENSITIVITY:
        out = out.when(text.rlike("|".join(map(re.escape, markers))), tier)
    return out.otherwise("")


def modality(sentence: Column) -> Column:
    """K-17: what a sentence does with its claim: denied before hypothesis, negated, confirmed, claimed, reported."""
    out = F.when(F.lit(False), "")
    for name, pattern in P.MODALITY:
        out = out.when(sentence.rlike(rf"(?i)\b{pattern}\b"), name)
    return out.otherwise("unknown")


def reason_bucket(reason: Column, days: Column, weak: tuple[str, ...]) -> Column:
    """A-18: the reason, with its days where it is a weak one."""
    return F.when(reason.isin(*weak) & days.isNotNull(), F.concat(reason, F.lit("_J"), days.cast("string"))).otherwise(reason)


def in_window(day: Column, start: Column, end: Column) -> Column:
    """C-05: whether a day is in a window, both ends included; false without a day."""
    return F.coalesce(day.between(start, end), F.lit(False))


def day_of(value: Column) -> Column:
    """R-49: the day of an ISO time or of the first ten signs; null where neither is one."""
    return F.coalesce(F.try_to_timestamp(value).cast("date"), F.try_to_timestamp(F.substring(value, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))
