"""Whom an entry tells of: victims by titles and relations, denials, campaigns, activities (F-05...F-07, X-01...X-04, X-06, X-07).

An entry has a title, a summary and a content. Names are read where the wording ties them to an incident; an ordered list of
places is asked, and the first that gives a name wins. All of it is expressions over one row, so nothing is shuffled but for
the table of known names, which is joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.match import bind
from tidemark.functions.text import any_of, clean_name, cut_at, searchable
from tidemark.operators.rules import has_marker
from tidemark.session import measured_broadcast

# Words by which an incident is denied, in searchable form; those of a content are fewer.
DENIALS = (
    "fausse alerte", "ne correspond pas aux donnees", "ne provient pas de", "aucune compromission", "aucune intrusion", "revendication dementie",
    "incident dementi", "aucune preuve technique ne permet de confirmer", "aucune preuve ne permet de confirmer",
    "il ne s agit pas d une fuite confirmee",
)
CONTENT_DENIALS = (
    "fausse alerte", "revendication dementie", "incident dementi", "aucune preuve technique ne permet de confirmer",
    "aucune preuve ne permet de confirmer", "il ne s agit pas d une fuite confirmee",
)
# Titles of campaigns, and words of a text that must stand in it together.
CAMPAIGN_TITLES = (
    r"^\s*\d+\s+SDIS\b", r"^\s*Fuite\s+de\s+donn[eé]es\s+scolaires\b", r"^\s*Polices\s+municipales\s*:", r"^\s*G7\s+d[’'][EÉ]vian\b",
    r"^\s*Son-Video\.com\s*&\s*EasyLounge\b",
)
CAMPAIGN_PAIR = ("ville de rennes", "rennes metropole")
AGENCY_TITLE, AGENCY_PAIR = "ars ", ("130 hopitaux", "ap hp")
SEVERAL_AGENCIES = r"\b(?:plusieurs|different(?:es|s))\s+ars\b"

# Relations of a name with an incident, in the order in which they are asked. `{name}` is the name.
NAME = r"([A-Za-zÀ-ÖØ-öø-ÿ0-9][A-Za-zÀ-ÖØ-öø-ÿ0-9&.'’/ -]{1,78}?)"
OPENING = r"(?:^|[:.!?]\s+)(?:(?:la|le)\s+|l['’]\s*)?"
FACES = (
    r"\s+fait\s+face\s+[àa]\s+(?:une?\s+importante\s+)?"
    r"(?:cyberattaque|attaque\s+(?:informatique|par\s+(?:ransomware|rançongiciel))|(?:un\s+)?(?:ransomware|rançongiciel))\b"
)
RELATIONS = (
    rf"\b(?:cyberattaque|attaque(?:\s+informatique)?)\s+(?:contre|visant|chez)\s+{NAME}(?:[,.;:!]|$)",
    rf"\b(?:intrusion\s+chez|compromission\s+de|piratage\s+de)\s+{NAME}(?:[,.;:!]|$)",
    rf"{OPENING}{NAME}\s+(?:a\s+(?:ete|été)\s+)?victime\s+d(?:['’]une?\s+|e\s+\w+\s+)",
    rf"{OPENING}{NAME}\s+confirme\s+avoir\s+subi\b",
    rf"{OPENING}{NAME}\s+confirme\s+(?:avoir\s+[ée]t[ée]|[êe]tre)\s+victime\b",
    rf"{OPENING}{NAME}\s+(?:touch(?:é|ée|e)?|frapp(?:é|ée|e)?|pirat(?:é|ée)|cibl(?:é|ée|e)?|paralys(?:é|ée|e)?)\s+(?:par|après|apres)\b",
    rf"{OPENING}{NAME}\s+pirat(?:é|ée)(?:\s*[:,.!]|$)",
    rf"{OPENING}{NAME}{FACES}",
    r"\b\d[\d\s.,]*\s+membres\s+de\s+la\s+(F[eé]d[eé]ration\s+Fran[cç]aise\s+de\s+[A-Za-zÀ-ÖØ-öø-ÿ'’ -]{2,50}?)\s+(?:diffus(?:é|e)s?|expos(?:é|e)s?)\b",
    rf"\b(?:la\s+)?((?:mairie|ville)\s+de\s+[A-Za-zÀ-ÖØ-öø-ÿ'’ -]{{2,60}}?){FACES}",
)
#: For each relation, searchable phrases of which one stands in every text that it meets: dear patterns are tried only there.
RELATION_SIGNS = (
    ("attaque contre ", "attaque visant ", "attaque chez ", "attaque informatique "), ("intrusion chez ", "compromission de ", "piratage de "), (" victime d ", " victime de "),
    ("confirme avoir subi",), ("confirme ",), ("touch", "frapp", "pirat", "cibl", "paralys"), ("pirat",), ("fait face",), ("membres de la ",), ("fait face",),
)
TITLE_TAIL = (
    r"^(.+?)\s+(?:annonce\s+(?:avoir\s+)?(?:être|été|etre)\s+victime\b|informe(?:\s+ses\s+clients)?\s+d['’]une\s+fuite\b|"
    r"ouvre\s+la\s+s[ée]rie\s+de\s+fuites\b|touch(?:é|ée|e)?|victime|cibl(?:é|ée|e)?|frapp(?:é|ée|e)?|pirat(?:é|ée)|menac(?:é|ée|e)?|"
    r"conteste|alerte|au cœur|sous la menace)\b"
)
AFTER_COLON = r":\s*(?:l['’]\s*)?(.+?)\s+confirme\s+(?:une?\s+)?cyberattaque\b"
#: Titles that name a victim otherwise than by its name, which summary or content must hold.
RENAMED = (("amis de la police", "Amicale Police et Patrimoine"),)
# What makes a name no name, in searchable form.
NAMELESS = (
    "un prestataire", "une entreprise", "un site", "la ville", "la mairie", "une plateforme", "un service", "un logiciel", "une bibliotheque",
    "un paquet npm", "un compte", "une api", "un outil", "un systeme", "un hebergeur", "chat control",
)
EDITORIAL = (
    r"^(?:cyberattaque|attaque|une?\s+attaque(?:\s+informatique)?|fuite\s+de\s+donnees|une\s+cyberattaque|nouvelle\s+cyberattaque|"
    r"des\s+millions\s+de|les\s+(?:donnees|adresses)\s+de)\b"
)
COUNTED = r"^\d[\d\s.,]*\s+(?:membres?|lignes?|enregistrements?|comptes?|donnees?|dossiers?|sdis)\b"
TOLD = (
    r"\s(?:annonce|informe|ouvre)\s|"
    r"\s(?:confirme|revele|de\s+nouveau|a\s+ete|a\s+confirme|constitue|et\s+l|des\s+donnees)\b|\sest$"
)
PUBLIC_BODIES = ("mairie ", "ville ", "federation ")
KNOWN_BODIES = ("mairie de ", "ville de ", "federation ")
ARTICLES = (r"^(?:la|le)\s+(?=(?:mairie|ville|federation)\b)", r"^l[’'](?=(?:mairie|ville|federation)\b)", r"^le\s+(?=domaine\s+des\s+tournels\b)")
# Words that open a title without being a name, and those after which a title tells the incident.
TITLE_NOISE = (
    "alerte", "cyberattaque", "attaque", "info", "breaking", "exclusif", "urgent", "securite", "cybersecurite", "fuite de donnees", "ransomware",
    "communique", "edito", "analyse", "enquete", "video", "photos", "direct",
)
INCIDENT_CUTS = (
    " frappe", " frappee", " victime", " touche", " touchee", " pirate", " piratee", " vise", " visee", " cible", " ciblee", " paralyse",
    " paralysee", " revendique", " attaque par", " subit", " confirme", " annonce", " hit by", " targeted", " claimed by",
)
# Town halls as victims of an attack.
TOWN_HALLS = (
    r"\b(mairie\s+de\s+[a-zà-öø-ÿ'’ -]{2,60}?)\s+(?:a\s+(?:ete|été)|est)\s+(?:la\s+)?victime\s+d(?:'une\s+|e\s+une\s+)(?:cyberattaque|attaque\s+informatique)\b",
    r"\b(?:une\s+)?cyberattaque\s+contre\s+(mairie\s+de\s+[a-zà-öø-ÿ'’ -]{2,60}?)(?:[,. ;:]|$)",
)
# How a text says what an organisation does, and what may stand between its name and that.
ACTIVITY_LEAD = (
    r"\b(?:sp[ée]cialis[ée]e?\s+dans|[ée]diteur\s+de|acteur\s+de|fournisseur\s+de|fabricant\s+de|distributeur\s+de|enseigne\s+de)\s+[^,.;:\n]{3,80}"
)
ACTIVITY_NOUN = (
    r"\b(?:club\s+de\s+football(?:\s+professionnel)?|club\s+sportif|[ée]tablissement\s+de\s+sant[ée]|centre\s+de\s+formation|"
    r"organisme\s+public|association\s+sportive)\b"
)
BRIDGES = (
    "", "est", "est un", "est une", "est un acteur", "est une entreprise", "est une societe", "est un groupe", "est une association", "est un organisme",
    "est une plateforme",
)
SEGMENT_END = r"(?U)(?<=[.!?;])\s+|\n+"
#: Any case, letters of all scripts, and only a line feed ends a line.
FLAGS = "(?iUd)"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _group(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, FLAGS + pattern, group)


def _words(c: Column) -> Column:
    return F.size(F.split(_stripped(c), r"(?U)\s+"))


def _first_name(candidates: Column) -> Column:
    """The first that is not empty, else null."""
    return F.get(F.filter(candidates, lambda n: n != ""), 0)


def _holds(blob: Column, phrases: tuple[str, ...]) -> Column:
    return any_of([F.contains(blob, F.lit(p)) for p in phrases])


def denied(title: Column, summary: Column, content: Column) -> Column:
    """F-05: whether title or summary deny the incident, or the content in so many words. Nulls are empty."""
    return bind(_blobs(title, summary, content), lambda b: _denied(b["head"], b["body"]))


def campaign(title: Column, summary: Column, content: Column) -> Column:
    """F-06: whether an entry tells of several victims at once. Nulls are empty."""
    return bind(_blobs(title, summary, content), lambda b: _campaign(title, b["head"], b["body"]))


def _blobs(title: Column, summary: Column, content: Column) -> Column:
    """Title and summary, and the content, in searchable form."""
    return F.struct(searchable(F.concat(_text(title), F.lit(" "), _text(summary))).alias("head"), searchable(content).alias("body"))


def _denied(head: Column, body: Column) -> Column:
    return _holds(head, DENIALS) | _holds(body, CONTENT_DENIALS)


def _campaign(title: Column, head: Column, body: Column) -> Column:
    def together(blob: Column) -> Column:
        agencies = F.startswith(searchable(title), F.lit(AGENCY_TITLE)) & F.contains(blob, F.lit(AGENCY_PAIR[0])) & F.contains(blob, F.lit(AGENCY_PAIR[1]))
        pair = F.contains(blob, F.lit(CAMPAIGN_PAIR[0])) & F.contains(blob, F.lit(CAMPAIGN_PAIR[1]))
        return agencies | pair | (F.contains(blob, F.lit("s ars")) & blob.rlike("(?U)" + SEVERAL_AGENCIES))

    return any_of([_text(title).rlike(FLAGS + p) for p in CAMPAIGN_TITLES]) | bind(F.concat(head, F.lit(" "), body), together)


def victim_name(raw: Column) -> Column:
    """A name as a relation gives it, cleaned (T-08), without articles before public bodies; empty where it is none.

    None are more than ten words, what opens in lower case (public bodies aside), counts, headlines, and verbs of telling.
    """

    def judged(name: Column) -> Column:
        def told(blob: Column) -> Column:
            body = any_of([F.startswith(blob, F.lit(b)) for b in PUBLIC_BODIES])
            no_name = (
                (name == "") | (_words(name) > 10) | (name.rlike(r"^\p{IsLowercase}") & ~body) | blob.isin(*NAMELESS)
                | blob.rlike("|".join([EDITORIAL, COUNTED, TOLD]))
            )
            shown = F.when(body, F.concat(F.upper(F.substring(name, 1, 1)), F.substr(name, F.lit(2)))).otherwise(name)
            return F.when(no_name, "").otherwise(shown)

        return bind(searchable(name), told)

    plain = clean_name(raw)
    for article in ARTICLES:
        plain = F.regexp_replace(plain, FLAGS + article, "")
    return bind(plain, judged)


def related_name(text: Column, blob: Column | None = None) -> Column:
    """The name that the first relation with a usable one ties to an incident in a text; null without one.

    Of each relation its first place counts, as the order of relations does. `blob` is the text's searchable form, if it is
    at hand.
    """

    def read(v: Column) -> Column:
        # a dotless i is an i in any case, but not in searchable form
        names = [F.when(_holds(v["signs"], signs), _group(v["t"], p)).otherwise("") for p, signs in zip(RELATIONS, RELATION_SIGNS, strict=True)]
        return _first_name(F.transform(F.filter(F.array(*names), lambda n: n != ""), victim_name))

    signs = F.concat(F.lit(" "), F.replace(searchable(text) if blob is None else blob, F.lit("\u0131"), F.lit("i")), F.lit(" "))
    return bind(F.struct(_text(text).alias("t"), signs.alias("signs")), read)


def title_victim(title: Column, rest: Column) -> Column:
    """The victim that a title names, whatever its texts tell: a renamed one, after the colon, before a verb, or before the colon."""

    def read(t: Column) -> Column:
        head = _stripped(F.regexp_extract(t, r"^[^:]*", 0))
        renamed = [F.when((searchable(head) == key) & F.contains(searchable(rest), searchable(F.lit(name))), F.lit(name)).otherwise("") for key, name in RENAMED]
        prefix = F.when(F.contains(t, F.lit(":")), head).otherwise("")
        found = F.array(_group(t, AFTER_COLON), _group(head, TITLE_TAIL), prefix)
        return _first_name(F.concat(F.array(*renamed), F.transform(found, victim_name)))

    return bind(_text(title), read)


def victims(entries: DataFrame, known: DataFrame, id: str, title: str, summary: str, content: str) -> DataFrame:
    """X-04: id, victim, found_in: the organisation that an entry tells of and where it was read; null for denials, campaigns and none.

    The order is: the title itself; then relations of the title, the summary, the content. One that only the content has must
    be a town, a federation, or in `known` (key, searchable), a table that is broadcast if it is small and joined if not.
    Nulls are empty; rows of equal ids stay apart.
    """

    def told(e: Column) -> Column:
        # one expression with named steps: as columns of several selects, filters of the result would be copied into each of them
        def named(head: Column) -> Column:
            # relations are asked only of what has no better name
            near = F.when(head.isNull(), F.coalesce(related_name(e["t"]), related_name(e["s"])))
            return bind(near, lambda n: farther(head, n))

        def farther(head: Column, near: Column) -> Column:
            by = F.when(head.isNotNull(), "title").when(near.isNotNull(), "relation")
            far = F.when(head.isNull() & near.isNull(), related_name(e["c"], e["b"]["body"]))
            key = lambda f: F.when(f.isNotNull(), searchable(f))
            return bind(far, lambda f: F.struct(F.coalesce(head, near).alias("name"), by.alias("by"), f.alias("far"), key(f).alias("key")))

        out = _denied(e["b"]["head"], e["b"]["body"]) | _campaign(e["t"], e["b"]["head"], e["b"]["body"])
        rest = F.concat(_text(e["s"]), F.lit(" "), _text(e["c"]))
        return F.when(~out, bind(title_victim(e["t"], rest), named))

    t, s, c = (F.col(x) for x in (title, summary, content))
    read = entries.select(id, bind(F.struct(t.alias("t"), s.alias("s"), c.alias("c"), _blobs(t, s, c).alias("b")), told).alias("x"))
    keys = known.select(F.col("key").alias("_key"), F.lit(True).alias("_known")).distinct()
    read = read.join(measured_broadcast(keys), F.col("x.key") == F.col("_key"), "left")
    proved = F.col("_known") | any_of([F.startswith("x.key", F.lit(b)) for b in KNOWN_BODIES])
    content_name = F.when(F.coalesce(proved, F.lit(False)), F.col("x.far"))
    by = F.coalesce("x.by", F.when(content_name.isNotNull(), "content"))
    return read.select(id, F.coalesce("x.name", content_name).alias("victim"), by.alias("found_in"))


def name_before_colon(title: Column) -> Column:
    """X-01: the organisation before a title's colon, of at most six words and none of an incident; empty without one."""
    head = F.regexp_extract(_text(title), r"(?U)^\s*([^:]{3,80}?)\s*:", 1)

    def judged(name: Column) -> Column:
        return bind(searchable(name), lambda b: F.when((name == "") | b.isin(*TITLE_NOISE) | (_words(name) > 6) | has_marker(b), "").otherwise(name))

    return bind(clean_name(cut_at(head, list(INCIDENT_CUTS))), judged)


def name_as_title(title: Column, most: int = 12) -> Column:
    """X-02: a title that is an organisation's name, up to where the incident is told; empty where it is none."""

    def judged(name: Column) -> Column:
        return F.when((name == "") | (_words(name) > most) | searchable(name).isin(*TITLE_NOISE), "").otherwise(name)

    return bind(clean_name(cut_at(_text(title), list(INCIDENT_CUTS))), judged)


def town_hall(text: Column) -> Column:
    """X-03: the town hall that a text calls the victim of an attack; empty without one."""

    def read(t: Column) -> Column:
        names = F.transform(F.array(*[_group(t, p) for p in TOWN_HALLS]), clean_name)
        return _text(F.get(F.filter(names, lambda n: F.startswith(searchable(n), F.lit("mairie de "))), 0))

    return bind(_text(text), read)


def activity_phrase(text: Column) -> Column:
    """X-06: what a text says that an organisation does, in its words, the opening with it; empty without one."""

    def read(t: Column) -> Column:
        lead = _group(t, ACTIVITY_LEAD, 0)
        return _stripped(F.when(lead != "", lead).otherwise(_group(t, ACTIVITY_NOUN, 0)))

    return bind(_text(text), read)


def victim_activity(organisation: Column, *texts: Column) -> Column:
    """X-07: the activity that a sentence tells of the organisation, which stands before it with a bridge or nothing between.

    The first sentence of the first text wins; empty without one. Names are looked for in searchable form, inside words too.
    """

    def of(text: Column, name: Column) -> Column:
        # the dear searchable form is made only of sentences that tell an activity
        told = F.filter(F.split(text, SEGMENT_END), lambda s: s.rlike(FLAGS + ACTIVITY_LEAD + "|" + ACTIVITY_NOUN))
        said = F.transform(told, lambda s: F.struct(searchable(s).alias("blob"), activity_phrase(s).alias("said")))

        def bridged(x: Column) -> Column:
            at, after = F.position(name, x["blob"]), F.position(name, x["blob"]) + F.length(name)
            there = F.position(searchable(x["said"]), x["blob"])
            between = F.btrim(F.substr(x["blob"], after, F.greatest(there - after, F.lit(0))), F.lit(" ,-:()"))
            return (at > 0) & (there >= after) & between.isin(*BRIDGES)

        return F.get(F.filter(said, bridged), 0)["said"]

    def first(name: Column) -> Column:
        return F.when(name == "", "").otherwise(F.coalesce(*[of(_text(t), name) for t in texts], F.lit("")))

    return bind(searchable(organisation), first)


# Words of a body that make a name in it a victim, of a title that warn, and of one that tells an incident.
VICTIM_WORDS = ("victime d une cyberattaque", "victime d une attaque informatique", "a subi une cyberattaque", "a ete cyberattaque")
WARNINGS = ("alerte", "met en garde", "faux profil", "faux numero", "escroc", "escroquer")
INCIDENTS = ("cyberattaque", "incident de cybersecurite", "attaque informatique", "piratage", "rancongiciel", "ransomware", "victime")


def names_victim(title: Column, body: Column, organisation: Column) -> Column:
    """F-07: whether an entry tells of an incident of the organisation and does not warn of fraud in its name.

    The body does if it holds the name and calls somebody a victim; else the title must tell an incident, and one that
    warns, a victim too. Without a title or a name: false.
    """

    def told(v: Column) -> Column:
        def any_in(blob: Column, words: tuple[str, ...]) -> Column:
            return any_of([F.contains(blob, F.lit(w)) for w in words])

        by_body = F.contains(v["body"], v["org"]) & any_in(v["body"], VICTIM_WORDS)
        by_title = any_in(v["title"], INCIDENTS) & ~(any_in(v["title"], WARNINGS) & ~F.contains(v["title"], F.lit("victime")))
        return (v["title"] != "") & (v["org"] != "") & (by_body | by_title)

    return bind(F.struct(searchable(title).alias("title"), searchable(body).alias("body"), searchable(organisation).alias("org")), told)
