"""Sectors proved by what a text says that an organisation does (K-10).

A sentence counts only if the organisation is its subject. Patterns are dear, so a sentence meets those of a sector only if
one of the words by which they begin stands in it; these are looked up in one hash set, word by word.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.functions.match import bind
from tidemark.functions.text import collapse, searchable, strip_html

# What a sector's activity is called, with its weight; alternatives of one pattern, whole words, any case.
ACTIVITIES: tuple[tuple[str, int, tuple[str, ...]], ...] = (
    (P.ADMIN, 8, (
        "mairie", "municipalit[ée]", "commune", "préfecture", "minist[eè]re", "administration publique", "collectivit[ée]", "chambre de commerce", "cci",
        "city council", "local authority", "government agency",
    )),
    (P.HEALTH, 8, (
        "h[oô]pital", "hospital", "clinique", "clinic", "pharmaci", "laboratoire m[ée]dical", "medical laboratory", "healthcare", "sant[ée] humaine", "ehpad",
        "veterinary", "v[ée]t[ée]rinaire",
    )),
    (P.EDUCATION, 8, (
        "universit[ée]", "university", "school", "[ée]cole", "coll[eè]ge", "lyc[ée]e", "enseignement", "formation professionnelle", "training provider",
        "academy", "acad[ée]mie",
    )),
    (P.FINANCE, 9, (
        "banque", "bank", "assurance", "insurance", "mutuelle", "cr[ée]dit", "credit union", "financial services", "fintech", "asset management",
        "courtier en assurance",
    )),
    (P.TRANSPORT, 8, (
        "compagnie a[ée]rienne", "airline", "a[ée]roport", "airport", "transporteur", "transport company", "logistique", "logistics", "freight", "fret",
        "shipping", "entreposage", "travel agency", "agence de voyages", "tour operator",
    )),
    (P.SPORT, 9, (
        "f[ée]d[ée]ration sportive", "sports? federation", "club de (?:football|rugby|basket|tennis)", "football club", "rugby club", "sports? club",
        "salle de sport", "fitness club", "activit[ée]s sportives",
    )),
    (P.RETAIL, 8, (
        "commerce de gros", "commerce de d[ée]tail", "grossiste", "wholesaler", "retailer", "retail chain", "magasin", "supermarch[ée]", "supermarket",
        "e-commerce", "boutique en ligne", "concessionnaire", "dealership", "distributeur", "distribution de produits", "vente de mat[ée]riel",
    )),
    (P.TECH, 9, (
        "[ée]diteur de logiciels", "software (?:company|publisher|vendor)", "saas", "cloud provider", "h[ée]bergeur", "hosting provider",
        "services informatiques", "it services", "cybers[ée]curit[ée]", "cybersecurity", "t[ée]l[ée]communications?", "telecommunications?", "datacenter",
        "data center", "d[ée]veloppement logiciel", "software development",
    )),
    (P.ENERGY, 9, (
        "[ée]nergie", "energy company", "electric utility", "[ée]lectricit[ée]", "water utility", "service des eaux", "gaz", "gas utility", "oil and gas",
        "assainissement", "waste management", "gestion des d[ée]chets",
    )),
    (P.INDUSTRY, 8, (
        "industriel", "industrie manufacturi[eè]re", "manufacturer", "manufacturing", "fabricant", "fabrication de", "usine", "industrial company",
        "production industrielle", "sous-traitance industrielle",
    )),
    (P.CONSTRUCTION, 8, (
        "btp", "construction", "travaux publics", "g[ée]nie civil", "civil engineering", "promoteur immobilier", "promotion immobili[eè]re",
        "real estate developer", "entreprise du b[âa]timent", "activit[ée]s immobili[eè]res",
    )),
    (P.SERVICES, 8, (
        "cabinet de conseil", "consulting firm", "consultancy", "cabinet d.avocats?", "law firm", "expertise comptable", "accounting firm", "recrutement",
        "recruitment", "staffing", "professional services", "services aux entreprises", "business services", "agence marketing", "marketing agency",
        "nettoyage industriel", "propret[ée]", "facility management", "prestations? d.accueil", "s[ée]curit[ée] priv[ée]e", "private security",
        "bureau d.[ée]tudes", "engineering consultancy",
    )),
)
#: Of sentences only: wordings that are rarer or stronger.
WORDINGS: tuple[tuple[str, int, tuple[str, ...]], ...] = (
    (P.RETAIL, 9, (
        "supermarch[ée]s", "fournisseur de mat[ée]riel agricole", "vente(?: et r[ée]paration)? de mat[ée]riel agricole", "distribution de mat[ée]riel agricole",
        "large gamme de mat[ée]riel agricole", "vente et location de (?:solutions|mat[ée]riel) de manutention",
    )),
    (P.CONSTRUCTION, 11, (
        "leader(?: européen| europeen| mondial)? (?:du |de la )?(?:btp|construction)",
        "acteur(?: majeur| de référence| de reference)? (?:du |de la )?(?:btp|construction)", "construction et (?:concessions?|travaux publics)",
        "r[ée]novation (?:sur[- ]mesure )?de l['’]habitat", "pose de fen[êe]tres", "pose de volets", "pose de portes",
    )),
    (P.SPORT, 9, (
        r"salle de r[ée]alit[ée] virtuelle[^.;]{0,80}\besport", r"esport[^.;]{0,80}\bsalle de r[ée]alit[ée] virtuelle", r"free roaming[^.;]{0,80}\besport",
    )),
)
#: Words that do not tell one organisation from another.
COMMON_WORDS = (
    "groupe", "group", "sas", "sasu", "sa", "sarl", "eurl", "ltd", "limited", "inc", "corp", "corporation", "company", "co", "france", "holding",
    "international", "the", "les", "le", "la", "de", "du", "des", "and", "et",
)
FIRST_PERSON = (
    r"\b(?:nous|notre (?:entreprise|societe|société|groupe|mission|metier|métier)|we|our (?:company|business|group|mission))\b"
)
COPULA = (
    r"\b(?:est|sommes|est un|est une|est le|est la|est l[’']|is|are|specialise|spécialis[ée]e?|specialized|specialised|"
    r"propose|fournit|concoit|conçoit|developpe|développe|fabrique|exploite)\b"
)
THIRD_PARTY = (
    r"\b(?:son|sa|ses|leur|leurs|notre|nos)?\s*"
    r"(?:fournisseur|partenaire|prestataire|sous[- ]traitant|client|hebergeur|hébergeur|provider|partner|supplier|vendor|contractor)\b"
    r"|\bavec\s+[A-ZÀ-Ý0-9]"
)
HEADED = r"[|:\-–]\s*[^|:\-–]{0,70}$"
SENTENCE_END = r"(?<=[.!?;])\s+|[\r\n]+"
LEAST_SCORE, STRONG_SCORE, LEAD = 8, 10, 2
_ANY_CASE = "(?iU)"


def openings(alternatives: tuple[str, ...]) -> tuple[str, ...]:
    """The searchable words by which the alternatives of a pattern begin, an optional last letter with and without."""
    words = set()
    for one in alternatives:
        run = re.match(r"(?:\w|\[\w\w\])+", one).group()  # type: ignore[union-attr]
        optional = one[len(run) :].startswith("?")
        plain = re.sub(r"\[(\w)(\w)\]", lambda m: m[1] if m[1].isascii() else m[2], run).replace("é", "e").replace("è", "e")
        words |= {plain, plain[:-1]} if optional else {plain}
    return tuple(sorted(words))


def pattern(alternatives: tuple[str, ...]) -> str:
    return rf"{_ANY_CASE}\b(?:{'|'.join(alternatives)})\b"


def _openings_in(text: Column, rules: tuple[tuple[str, int, tuple[str, ...]], ...]) -> Column:
    every = sorted({w for _, _, a in rules for w in openings(a)})
    return F.array_distinct(F.filter(F.split(searchable(text), " "), lambda w: w.isin(*every)))


def _found(text: Column, rules: tuple[tuple[str, int, tuple[str, ...]], ...]) -> Column:
    """array<struct<lost, sector, at, until>> of the rules that a text meets, best first; `lost` is the negative weight."""

    def met(begun: Column) -> Column:
        each = []
        for sector, weight, alternatives in rules:
            could = F.arrays_overlap(begun, F.array(*[F.lit(w) for w in openings(alternatives)]))
            at = F.regexp_instr(text, F.lit(pattern(alternatives)))
            length = F.length(F.regexp_extract(text, pattern(alternatives), 0))
            one = F.struct(F.lit(-weight).alias("lost"), F.lit(sector).alias("sector"), (at - 1).alias("at"), (at - 1 + length).alias("until"))
            each.append(F.when(could, one))
        return F.array_sort(F.filter(F.array(*each), lambda m: m.isNotNull() & (m["at"] >= 0)))

    return bind(_openings_in(text, rules), met)


def _span(text: Column, start: Column, end: Column) -> Column:
    """Characters from `start` (0 or what is left of it) up to `end`."""
    first = F.greatest(start, F.lit(0))
    return F.substring(text, first + 1, F.greatest(end - first, F.lit(0)))


def is_subject(organisation: Column, sentence: Column, at: Column) -> Column:
    """Whether what stands at a place of a sentence is said of the organisation.

    No third party is named in the 120 characters before it, and one of these holds: the first person speaks; the name opens
    the sentence; a title's sign follows the name; a verb of being or making follows it.
    """

    def judged(v: Column) -> Column:
        before, blob, tokens = v["before"], v["blob"], v["tokens"]
        told = F.size(F.filter(tokens, lambda t: F.contains(blob, t)))
        named = (F.size(tokens) > 0) & (told >= F.least(F.lit(2), F.size(tokens)))
        opening = searchable(_span(sentence, F.lit(0), F.least(at, F.lit(120))))
        opens = (v["name"] != "") & F.startswith(opening, v["name"])
        headed = (at <= 140) & (opens | F.right(before, F.lit(100)).rlike(HEADED))
        said = named & (headed | F.right(before, F.lit(140)).rlike(_ANY_CASE + COPULA))
        return ~_span(sentence, at - 120, at).rlike(_ANY_CASE + THIRD_PARTY) & (before.rlike(_ANY_CASE + FIRST_PERSON) | said)

    def parts(before: Column) -> Column:
        words = F.filter(F.split(searchable(organisation), " "), lambda w: (F.length(w) > 2) & ~w.isin(*COMMON_WORDS))
        return F.struct(before.alias("before"), searchable(before).alias("blob"), words.alias("tokens"), searchable(organisation).alias("name"))

    return bind(bind(_span(sentence, at - 220, at), parts), judged)


def subject_activity(organisation: Column, text: Column, least: int = LEAST_SCORE) -> Column:
    """K-10: struct<sector, sentence, score> of the first sentence that proves a sector of the organisation; null for none.

    Its best rule must be ahead of those of other sectors by 2. `least` is asked of that first proof alone (10 for a strong
    one): a weaker first proof is not passed over for a later one. Null and empty texts and names prove nothing, but for
    the first person. Sentences have 15 to 900 characters.
    """
    rules = WORDINGS + ACTIVITIES
    split = F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_END), lambda s: F.when(F.contains(s, F.lit("&")), _decoded(s)).otherwise(collapse(s)))
    whole = F.filter(split, lambda s: F.length(s).between(15, 900))
    name = F.coalesce(organisation, F.lit(""))

    def proof(sentence: Column) -> Column:
        def best(found: Column) -> Column:
            top = F.get(found, 0)
            rival = F.get(F.filter(found, lambda m: m["sector"] != F.get(found, 0)["sector"]), 0)
            ahead = rival.isNull() | (-top["lost"] >= -rival["lost"] + LEAD)
            one = F.struct(top["sector"].alias("sector"), F.substring(sentence, 1, 500).alias("sentence"), (-top["lost"]).alias("score"))
            return F.when((-top["lost"] >= LEAST_SCORE) & ahead & is_subject(name, sentence, top["at"]), one)

        return bind(_found(sentence, rules), best)

    first = F.get(F.filter(F.transform(whole, proof), lambda p: p.isNotNull()), 0)
    return bind(first, lambda p: F.when(p["score"] >= least, p)) if least > LEAST_SCORE else first


def _decoded(sentence: Column) -> Column:
    """A sentence with its references decoded; signs of tags in it are no tags here."""
    kept = F.replace(sentence, F.lit("<"), F.lit("&lt;"))
    return strip_html(kept)


def official_activity(text: Column) -> Column:
    """K-10, of a page whose subject is known: struct<sector, excerpt>, null where the best sector is not ahead by 2.

    The excerpt runs from 90 characters before the words to 140 after them, 320 at most.
    """
    page = F.coalesce(text, F.lit(""))

    def best(found: Column) -> Column:
        top, rival = F.get(found, 0), F.get(found, 1)
        ahead = rival.isNull() | (-top["lost"] >= -rival["lost"] + LEAD)
        excerpt = F.substring(collapse(_span(page, top["at"] - 90, top["until"] + 140)), 1, 320)
        return F.when(top.isNotNull() & ahead, F.struct(top["sector"].alias("sector"), excerpt.alias("excerpt")))

    return bind(_found(page, ACTIVITIES), best)
