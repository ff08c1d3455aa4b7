"""Queries of victims and activities (F-05...F-07, X-01...X-04, X-06, X-07): entries made of samples by id, before the documents' own text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import victims as V
from tidemark.plans.registry import query
from tidemark.plans.rules import _marker

#: (title, summary, opening of the content), one for each document by its id.
ENTRIES = (
    ("DGFiP : une 2ème cyberattaque", "", ""),
    ("Son-Video.com frappé une nouvelle fois", "", ""),
    ("Cyberattaque à Gagny : un accès", "La Ville de Gagny confirme avoir subi une cyberattaque.", ""),
    ("Drancy débranchée", "", "La mairie de Drancy fait face à une importante attaque par rançongiciel."),
    ("Services perturbés", "", "Le port a été victime d'une cyberattaque. ALGERIA confirme avoir subi une attaque."),
    ("Services perturbés", "", "Algeria a été victime d'une cyberattaque."),
    ("284 461 membres de la Fédération Française de Bridge diffusés", "", ""),
    ("4 SDIS frappés : 5 000 pompiers", "", ""),
    ("Amis de la police : la base exposée", "L'Amicale Police et Patrimoine prévient.", ""),
    ("Le fusil volé : l'Armurerie Dupont confirme une cyberattaque", "", ""),
    ("Une fuite", "Fausse alerte.", ""),
    ("Alerte", "Une attaque visant Acme SAS, hier.", "Plusieurs ARS et le reste."),
    ("Rien de neuf", "Intrusion chez Beta (Lyon).", "Une cyberattaque contre Mairie de Sainte-Rose, hier."),
    ("Le Domaine des Tournels ciblé", "", ""),
    ("La mairie alerte", "La mairie de X victime d'une cyberattaque.", "aucune preuve ne permet de confirmer"),
    ("Chat Control : un vote", "", "Piratage de Gamma et de Delta. Ville de Rennes, Rennes Métropole."),
)
#: (organisation, what is said of it)
SAID = (
    ("Acme", "Acme est une entreprise spécialisée dans la vente de pneus, à Lyon."), ("Acme", "Acme travaille avec Beta, éditeur de logiciels."),
    ("Beta", "L'usine Beta (club sportif) ferme"), ("Acme", "Rien.\nACME est un acteur de la santé; fin."), ("", "Acme, fabricant de roues."),
    ("Gamma", "Gamma et Beta, éditeur de x. Gamma est un organisme public."), ("Eta", "Eta - établissement de santé"),
)


def _pick(rows: tuple[tuple[str, ...], ...], i: int) -> str:
    return "[" + ", ".join("'" + r[i].replace("'", "''") + "'" for r in rows) + f"][(doc_id % {len(rows)}) + 1]"


def _picked(rows: tuple[tuple[str, ...], ...], i: int):
    return F.get(F.array(*[F.lit(r[i]) for r in rows]), (F.col("doc_id") % len(rows)).cast("int"))


_SPACE, _W = r"[\s\x0B\x{85}\p{Z}]", r"[^\p{L}\p{N}_]"


def _sql_pattern(p: str) -> str:
    """A pattern as DuckDB's expressions have it: word boundaries read one sign, and classes of all scripts are spelt out."""
    p = p.replace(r"\b|", "|")
    p = (rf"(?:^|{_W})" + p[2:]) if p.startswith(r"\b") else p
    p = p.replace(r"[\d\s.,]", r"[\p{Nd}\s.,]").replace(r"\b", rf"(?:$|{_W})").replace(r"\w", r"[\p{L}\p{N}_]").replace(r"\d", r"\p{Nd}")
    return p.replace(r"\s.,]", r"@.,]").replace(r"\s", _SPACE).replace(r"@.,]", r"\s.,]").replace("'", "''")


def _extract(text: str, p: str, group: int = 1) -> str:
    return f"regexp_extract({text}, '(?i){_sql_pattern(p)}', {group})"


def _matches(text: str, *patterns: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, '(?i){_sql_pattern(p)}')" for p in patterns) + ")"


def _blob(t: str) -> str:
    return rf"trim(regexp_replace(lower(strip_accents({t})), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def _clean(t: str) -> str:
    signs = r"[\x{A0}\x{200B}\x{2022}\x{25A0}-\x{27BF}\x{FE0F}\x{1F000}-\x{1FAFF}]"
    ends = "' -–—•' || chr(9)"
    whole = rf"trim(regexp_replace(regexp_replace({t}, '{signs}', ' ', 'g'), '{_SPACE}+', ' ', 'g'), {ends})"
    return rf"trim(regexp_replace(trim(regexp_replace({whole}, '(\s*[\(\[][^\)\]]*[\)\]]\s*)+$', '')), '^(?i)www\.', ''), {ends})"


def _any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _begins(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"starts_with({text}, '{w}')" for w in words) + ")"


def _in(text: str, words: tuple[str, ...]) -> str:
    return f"{text} IN (" + ", ".join(f"'{w}'" for w in words) + ")"


_ROWS = f"""e AS (SELECT doc_id, {_pick(ENTRIES, 0)} AS t, {_pick(ENTRIES, 1)} AS s, {_pick(ENTRIES, 2)} || ' ' || coalesce(text, '') AS c FROM documents),
    b AS (SELECT *, {_blob("t || ' ' || s")} AS ts, {_blob('c')} AS cs, {_blob('t')} AS ks FROM e),
    m AS (SELECT *, {_any('ts', V.DENIALS)} OR {_any('cs', V.CONTENT_DENIALS)} AS denied,
      {_matches('t', *V.CAMPAIGN_TITLES)} OR (starts_with(ks, '{V.AGENCY_TITLE}') AND contains(ts || ' ' || cs, '{V.AGENCY_PAIR[0]}') AND contains(ts || ' ' || cs, '{V.AGENCY_PAIR[1]}'))
      OR (contains(ts || ' ' || cs, '{V.CAMPAIGN_PAIR[0]}') AND contains(ts || ' ' || cs, '{V.CAMPAIGN_PAIR[1]}')) OR {_matches("ts || ' ' || cs", V.SEVERAL_AGENCIES)} AS campaign FROM b)"""


def _entries(d: DataFrame) -> DataFrame:
    content = F.concat(_picked(ENTRIES, 2), F.lit(" "), F.coalesce("text", F.lit("")))
    return d.select("doc_id", _picked(ENTRIES, 0).alias("t"), _picked(ENTRIES, 1).alias("s"), content.alias("c"))


@query("F05_F06_denied", f"WITH {_ROWS} SELECT doc_id, denied, campaign FROM m", "documents")
def _f05(d: DataFrame) -> DataFrame:
    cols = [F.col(x) for x in "tsc"]
    return _entries(d).select("doc_id", V.denied(*cols).alias("denied"), V.campaign(*cols).alias("campaign"))


_HEAD = rf"regexp_replace(split_part(t, ':', 1), '^{_SPACE}+|{_SPACE}+$', '', 'g')"
_ASKED = (
    [(1, _extract("t", V.AFTER_COLON)), (2, _extract("h", V.TITLE_TAIL)), (3, "CASE WHEN contains(t, ':') THEN h ELSE '' END")]
    + [(10 + i, _extract("t", p)) for i, p in enumerate(V.RELATIONS)]
    + [(30 + i, _extract("s", p)) for i, p in enumerate(V.RELATIONS)]
    + [(50 + i, _extract("c", p)) for i, p in enumerate(V.RELATIONS)]
)
_ARTICLES = (
    r"^(?i)(?:la|le)\s+((?:mairie|ville|federation)(?:$|[^\p{L}\p{N}_]))", r"^(?i)l[’''']((?:mairie|ville|federation)(?:$|[^\p{L}\p{N}_]))",
    r"^(?i)le\s+(domaine\s+des\s+tournels(?:$|[^\p{L}\p{N}_]))",
)


def _without_articles(t: str) -> str:
    for p in _ARTICLES:
        t = rf"regexp_replace({t}, '{p.replace("'''", "''")}', '\1')"
    return t


_NO_NAME = f"""(name = '' OR len(string_split(name, ' ')) > 10 OR (regexp_matches(name, '^[\\p{{Ll}}ªº]') AND NOT {_begins('k', V.PUBLIC_BODIES)})
    OR {_in('k', V.NAMELESS)} OR {_matches('k', V.EDITORIAL, V.COUNTED, V.TOLD)})"""


@query(
    "X04_victims",
    f"""WITH {_ROWS}, a AS (SELECT *, {_HEAD} AS h FROM m WHERE NOT denied AND NOT campaign),
    r AS (SELECT doc_id, unnest([{', '.join(f"{{'rank': {n}, 'raw': {x}}}" for n, x in _ASKED)}], recursive := true) FROM a),
    n AS (SELECT doc_id, rank, {_without_articles(_clean('raw'))} AS name FROM r WHERE raw <> ''),
    j AS (SELECT doc_id, rank, name, {_blob('name')} AS k FROM n),
    v AS (SELECT doc_id, rank, k, CASE WHEN {_begins('k', V.PUBLIC_BODIES)} THEN upper(name[1]) || name[2:] ELSE name END AS name FROM j WHERE NOT {_NO_NAME}),
    f AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank) = 1),
    p AS (SELECT doc_id, rank, name FROM f WHERE rank < 50 OR {_begins('k', V.KNOWN_BODIES)} OR k IN (SELECT lower(n_name) FROM nation)),
    o AS (SELECT doc_id, '{V.RENAMED[0][1]}' AS name FROM a WHERE {_blob('h')} = '{V.RENAMED[0][0]}' AND contains({_blob("s || ' ' || c")}, {_blob(f"'{V.RENAMED[0][1]}'")}))
    SELECT doc_id, coalesce(o.name, p.name) AS victim, CASE WHEN o.name IS NOT NULL OR rank < 10 THEN 'title' WHEN rank < 50 THEN 'relation' WHEN rank >= 50 THEN 'content' END AS found_in
    FROM documents LEFT JOIN o USING (doc_id) LEFT JOIN p USING (doc_id)""",
    "documents", "nation",
)
def _x04(d: DataFrame, n: DataFrame) -> DataFrame:
    return V.victims(_entries(d), n.select(F.lower("n_name").alias("key")), "doc_id", "t", "s", "c")


_TITLED = "CASE WHEN doc_id % 3 = 0 THEN coalesce(text, '') ELSE " + _pick(ENTRIES, 0) + " || ' ' || coalesce(text, '') END"
_CUT = f"list_min(list_filter([{', '.join(f"strpos(k, '{m}')" for m in V.INCIDENT_CUTS)}], lambda x: x > 1))"
_KEPT = "CASE WHEN pos IS NULL THEN {0} ELSE trim(substr({0}, 1, pos - 1), ' -–—•,;' || chr(9)) END"


@query(
    "X01_X02_title_names",
    rf"""WITH e AS (SELECT doc_id, {_TITLED} AS t FROM documents), h AS (SELECT doc_id, t, regexp_extract(t, '^{_SPACE}*([^:]{{3,80}}?){_SPACE}*:', 1) AS h FROM e),
    c AS (SELECT doc_id, h AS x, 1 AS kind, {_blob('h')} AS k FROM h UNION ALL SELECT doc_id, t, 2, {_blob('t')} FROM h),
    n AS (SELECT doc_id, kind, {_clean('x')} AS name FROM (SELECT doc_id, kind, {_KEPT.format('x')} AS x FROM (SELECT *, {_CUT} AS pos FROM c))),
    s AS (SELECT *, {_blob('name')} AS s, len(string_split(name, ' ')) AS words FROM n),
    g AS (SELECT doc_id, kind, CASE WHEN {_in('s', V.TITLE_NOISE)} OR (kind = 1 AND (words > 6 OR {_marker('s')})) OR (kind = 2 AND words > 12) THEN '' ELSE name END AS name FROM s)
    SELECT doc_id, max(CASE WHEN kind = 1 THEN name END) AS before_colon, max(CASE WHEN kind = 2 THEN name END) AS as_title FROM g GROUP BY 1""",
    "documents",
)
def _x01(d: DataFrame) -> DataFrame:
    said = F.concat(_picked(ENTRIES, 0), F.lit(" "), F.coalesce("text", F.lit("")))
    title = F.when(F.col("doc_id") % 3 == 0, F.coalesce("text", F.lit(""))).otherwise(said)
    return d.select("doc_id", V.name_before_colon(title).alias("before_colon"), V.name_as_title(title).alias("as_title"))


@query(
    "X03_town_halls",
    f"""WITH e AS (SELECT doc_id, {_pick(ENTRIES, 2)} || ' ' || {_pick(ENTRIES, 1)} || ' ' || coalesce(text, '') AS t FROM documents),
    n AS (SELECT doc_id, [{', '.join(_clean(_extract('t', p)) for p in V.TOWN_HALLS)}] AS names FROM e)
    SELECT doc_id, coalesce(list_filter(names, lambda n: starts_with({_blob('n')}, 'mairie de '))[1], '') AS name FROM n""",
    "documents",
)
def _x03(d: DataFrame) -> DataFrame:
    text = F.concat_ws(" ", _picked(ENTRIES, 2), _picked(ENTRIES, 1), F.coalesce("text", F.lit("")))
    return d.select("doc_id", V.town_hall(text).alias("name"))


def _activity(t: str) -> str:
    lead, noun = (rf"regexp_extract(' ' || {t}, '(?i){_W}({_sql_pattern(p[2:]).replace(_END, '')}){end}', 1)" for p, end in ((V.ACTIVITY_LEAD, ""), (V.ACTIVITY_NOUN, _END)))
    return rf"regexp_replace(CASE WHEN {lead} <> '' THEN {lead} ELSE {noun} END, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_END = rf"(?:$|{_W})"


@query(
    "X06_X07_activities",
    rf"""WITH e AS (SELECT doc_id, {_blob(_pick(SAID, 0))} AS org, {_pick(SAID, 1)} || ' ' || coalesce(text, '') AS t FROM documents),
    l AS (SELECT doc_id, org, string_split(regexp_replace(t, '([.!?;]){_SPACE}+|\n+', E'\\1\n', 'g'), E'\n') AS parts FROM e),
    p AS (SELECT doc_id, org, unnest(parts) AS s, generate_subscripts(parts, 1) AS place FROM l),
    a AS (SELECT doc_id, org, place, {_blob('s')} AS k, {_activity('s')} AS said FROM p),
    w AS (SELECT *, strpos(k, org) AS pos, strpos(k, {_blob('said')}) AS there FROM a WHERE said <> '' AND org <> ''),
    f AS (SELECT doc_id, said FROM w WHERE pos > 0 AND there >= pos + length(org) AND {_in("trim(substr(k, pos + length(org), there - pos - length(org)), ' ,-:()')", V.BRIDGES)}
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY place) = 1)
    SELECT e.doc_id, {_activity('t')} AS phrase, coalesce(f.said, '') AS activity FROM e LEFT JOIN f USING (doc_id)""",
    "documents",
)
def _x07(d: DataFrame) -> DataFrame:
    text = F.concat(_picked(SAID, 1), F.lit(" "), F.coalesce("text", F.lit("")))
    return d.select("doc_id", V.activity_phrase(text).alias("phrase"), V.victim_activity(_picked(SAID, 0), text).alias("activity"))


@query(
    "F07_local_titles",
    f"""WITH {_ROWS}, o AS (SELECT doc_id, ks AS title, {_blob("s || ' ' || c")} AS body, {_blob("CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'Mairie de X' END")} AS org FROM m)
    SELECT doc_id, title <> '' AND org <> '' AND ((contains(body, org) AND {_any('body', V.VICTIM_WORDS)})
      OR ({_any('title', V.INCIDENTS)} AND NOT ({_any('title', V.WARNINGS)} AND NOT contains(title, 'victime')))) AS named FROM o""",
    "documents",
)
def _f07(d: DataFrame) -> DataFrame:
    org = F.when(F.col("doc_id") % 5 == 0, "").otherwise("Mairie de X")
    return _entries(d).select("doc_id", V.names_victim(F.col("t"), F.concat("s", F.lit(" "), "c"), org).alias("named"))
