"""Queries of rules over text (F-01...F-04, K-01, K-02, K-16, X-08, X-09, X-13) and of key joins (T-06, J-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.functions.text import searchable
from tidemark.operators import rules as R
from tidemark.plans.registry import query

#: Sentences that stand behind each text in turn, so that every rule meets texts it holds for.
SAMPLES = (
    "Attaque par LockBit", "aucune fuite de données", "intrusion nocturne dans un domicile", "hacking", "campagne de phishing",
    "piratage informatique", "cyberattaque non démontrée", "incident de sécurité", "rien à signaler", "Déni de service",
    "CVE-2024-12345 et cve-2023-9999, CVSS: 9,8/10", "12 500 fichiers, 45,5 Go, SIRET 123 456 789 00012", "non confirmée", "démentie",
    "revendiquée par le groupe X", "incident confirmé, SIREN : 987654321",
)


def _sampled(d: DataFrame) -> DataFrame:
    added = F.get(F.array(*[F.lit(s) for s in SAMPLES]), (F.col("doc_id") % len(SAMPLES)).cast("int"))
    rows = d.select("doc_id", F.concat_ws(" . ", F.coalesce("text", F.lit("")), added).alias("text"))
    return rows.withColumn("blob", searchable(F.col("text")))


_TEXT = f"coalesce(text, '') || ' . ' || [{', '.join(f"'{s}'" for s in SAMPLES)}][(doc_id % {len(SAMPLES)}) + 1]"
_BLOB = r"trim(regexp_replace(regexp_replace(lower(strip_accents(t)), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_ROWS = f"t0 AS (SELECT doc_id, {_TEXT} AS t FROM documents), t1 AS (SELECT doc_id, t, {_BLOB} AS s FROM t0)"


def _masked(s: str) -> str:
    for pattern in P.NEGATIONS:
        s = f"regexp_replace({s}, '{pattern}', ' ', 'g')"
    return rf"trim(regexp_replace({s}, '\s+', ' ', 'g'))"


def _has(s: str, phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(' ' || {s} || ' ', ' {p} ')" for p in phrases) + ")"


def _starts(s: str, prefixes: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(' ' || {s}, ' {p}')" for p in prefixes) + ")"


def _marker(s: str) -> str:
    sure = tuple(p for p in P.CYBER_PREFIXES if p not in P.AMBIGUOUS_PREFIXES)
    ambiguous = f"({_starts(s, P.AMBIGUOUS_PREFIXES)} AND NOT {_has(s, P.PHYSICAL_MARKERS)})"
    return f"({_starts(s, sure)} OR {ambiguous} OR {_has(s, P.CYBER_PHRASES)})"


_NEGATED = f"regexp_matches(s, '{'|'.join(P.NEGATIONS)}')"


def _cyber_sql(s: str) -> str:
    each = [f"({_has(s, (p,))}{f' AND NOT {_has(s, P.PHYSICAL_MARKERS)}' if p.startswith(P.AMBIGUOUS_PREFIXES) else ''})" for _, phrases in P.THREAT_RULES for p in phrases]
    return f"({' OR '.join(each)} OR {_marker(s)})"


@query(
    "F01_F04_cyber_markers",
    f"WITH {_ROWS} SELECT doc_id, {_cyber_sql('s')} AS cyber, {_marker('s')} AS marker, {_has('s', P.PHYSICAL_MARKERS)} AS physical, {_NEGATED} AS negated FROM t1",
    "documents",
)
def _f01(d: DataFrame) -> DataFrame:
    b = F.col("blob")
    return _sampled(d).select(
        "doc_id", R.looks_cyber(b).alias("cyber"), R.has_marker(b).alias("marker"), R.is_physical(b).alias("physical"), R.has_negation(b).alias("negated")
    )


def _threat_sql(default: str) -> str:
    rules = dict(P.THREAT_RULES)
    specific = " ".join(f"WHEN {_has('e', rules[k])} THEN '{k}'" for k in P.SPECIFIC)
    return f"""CASE WHEN {default} = '{P.RANSOMWARE}' THEN '{P.RANSOMWARE}' {specific} WHEN {default} <> '' THEN {default}
        WHEN {_has('e', rules[P.INTRUSION])} THEN '{P.INTRUSION}' WHEN {_NEGATED} THEN '{P.UNKNOWN}' WHEN {_marker('e')} THEN '{P.OTHER}' ELSE '{P.UNKNOWN}' END"""


@query(
    "K01_K02_threat",
    f"""WITH {_ROWS}, t2 AS (SELECT doc_id, s, {_masked('s')} AS e, CASE doc_id % 5 WHEN 0 THEN '{P.LEAK}' WHEN 1 THEN '{P.RANSOMWARE}' ELSE '' END AS d FROM t1)
        SELECT doc_id, {_threat_sql("''")} AS threat, {_threat_sql('d')} AS with_default FROM t2""",
    "documents",
)
def _k01(d: DataFrame) -> DataFrame:
    five = F.col("doc_id") % 5
    default: Column = F.when(five == 0, P.LEAK).when(five == 1, P.RANSOMWARE).otherwise("")
    rows = _sampled(d).select("doc_id", R.threat_signals(F.col("blob")).alias("told"))
    told = F.col("told")
    return rows.select("doc_id", R.threat_of(told).alias("threat"), R.threat_of(told, default).alias("with_default"))


_STATUS_SQL = " ".join(rf"WHEN regexp_matches(t, '(?i)(^|[^\p{{L}}\p{{N}}_]){p}($|[^\p{{L}}\p{{N}}_])') THEN '{s}'" for p, s in P.CLAIM_STATUS)


@query("K16_claim_status", f"WITH {_ROWS} SELECT doc_id, CASE {_STATUS_SQL} ELSE '' END AS status FROM t1", "documents")
def _k16(d: DataFrame) -> DataFrame:
    return _sampled(d).select("doc_id", R.claim_status(F.col("text")).alias("status"))


@query(
    "X08_X09_vulnerabilities",
    rf"""WITH {_ROWS} SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i)\b{P.CVE}\b'), lambda c: upper(c)))), ',') AS cves,
        trim(regexp_extract(t, '(?i)\b{P.CVSS}\b')) AS cvss, trim(regexp_extract(t, '(?i)\b{P.VOLUME}\b')) AS volume,
        regexp_replace(regexp_extract(t, '(?i)\b{P.FILE_COUNT}\b', 1), '[ .,]', '', 'g') AS files FROM t1""",
    "documents",
)
def _x08(d: DataFrame) -> DataFrame:
    t = F.col("text")
    files = F.regexp_replace(R.first_match(t, P.FILE_COUNT, 1), "[ .,]", "")
    return _sampled(d).select(
        "doc_id", F.array_join(R.cves(t), ",").alias("cves"), R.first_match(t, P.CVSS).alias("cvss"), R.first_match(t, P.VOLUME).alias("volume"), files.alias("files")
    )


@query(
    "X13_legal_ids",
    rf"""WITH {_ROWS}, t2 AS (SELECT doc_id, regexp_replace(regexp_extract(t, '(?i)\bsiret\b\D{{0,12}}((?:\d[ .]?){{14}})(?:\D|$)', 1), '\D', '', 'g') AS a,
        regexp_replace(regexp_extract(t, '(?i)\bsiren\b\D{{0,12}}((?:\d[ .]?){{9}})(?:\D|$)', 1), '\D', '', 'g') AS b FROM t1)
        SELECT doc_id, a AS siret, CASE WHEN a <> '' THEN a[1:9] ELSE b END AS siren FROM t2""",
    "documents",
)
def _x13(d: DataFrame) -> DataFrame:
    return _sampled(d).select("doc_id", R.legal_ids(F.col("text")).alias("i")).select("doc_id", "i.siret", "i.siren")


_NAMES = ("le hacker", "Un attaquant isolé", "LockBit", "INCONNU", "", "Nation", "N/A", "ENSAM", "La", "EDF", "abcd", "Ville de Lyon", "mots de passe hachés", "IBAN", "adresse mail", "logo")
_NAME_SQL = f"[{', '.join(f"'{n}'" for n in _NAMES)}][(doc_id % {len(_NAMES)}) + 1]"
_PLAIN = r"trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _named(d: DataFrame) -> DataFrame:
    return d.select("doc_id", "source", F.get(F.array(*[F.lit(n) for n in _NAMES]), (F.col("doc_id") % len(_NAMES)).cast("int")).alias("name"))


def _in(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query(
    "F10_F11_valid_names",
    f"""WITH t AS (SELECT doc_id, {_NAME_SQL} AS name FROM documents), n AS (SELECT *, {_PLAIN.format('name')} AS s FROM t)
        SELECT doc_id, CASE WHEN s IN ({_in(P.ACTOR_SENTINELS)}) OR {' OR '.join(f"starts_with(s, '{o}')" for o in P.ACTOR_OPENINGS)} OR s = 'lockbit' THEN '' ELSE trim(name) END AS actor,
        CASE WHEN s IN ({_in(P.THIRD_PARTY_SENTINELS)}) OR s = 'lockbit' THEN '' ELSE trim(name) END AS third_party FROM n""",
    "documents",
)
def _f10(d: DataFrame) -> DataFrame:
    victim = F.lit("Lockbit SAS")
    return _named(d).select("doc_id", R.valid_actor(F.col("name"), victim).alias("actor"), R.valid_third_party(F.col("name"), victim).alias("third_party"))


@query(
    "F13_weak_identity",
    f"""WITH t AS (SELECT doc_id, {_NAME_SQL} AS name FROM documents), n AS (SELECT *, {_PLAIN.format('name')} AS s, regexp_replace(name, '[^\\p{{L}}]', '', 'g') AS l FROM t)
        SELECT doc_id, s <> '' AND NOT contains(s, ' ') AND ((length(l) BETWEEN 2 AND 12 AND upper(l) = l) OR length(s) <= 4) AS weak FROM n""",
    "documents",
)
def _f13(d: DataFrame) -> DataFrame:
    return _named(d).select("doc_id", R.weak_identity(F.col("name")).alias("weak"))


_CODES = "['974', '976', '2a', '2B', '75', '96', '00', 'x', '', '01'][(c_custkey % 10) + 1]"


@query(
    "K11_K12_codes",
    f"""SELECT c_custkey, CASE chr(CAST(65 + c_custkey % 26 AS INTEGER)) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in P.NAF_SECTORS.items())} ELSE 'Inconnu' END AS sector,
        CASE c_custkey % 10 WHEN 0 THEN 'La Réunion' WHEN 1 THEN 'Mayotte' WHEN 2 THEN 'France' WHEN 3 THEN 'France' WHEN 4 THEN 'France' WHEN 9 THEN 'France' ELSE 'Inconnu' END AS location FROM customer""",
    "customer",
)
def _k11(c: DataFrame) -> DataFrame:
    code = F.get(F.array(*[F.lit(x) for x in ("974", "976", "2a", "2B", "75", "96", "00", "x", "", "01")]), (F.col("c_custkey") % 10).cast("int"))
    return c.select("c_custkey", R.naf_sector(F.char(65 + F.col("c_custkey") % 26)).alias("sector"), R.department_location(code).alias("location"))


@query(
    "K15_sensitivity",
    f"""WITH t AS (SELECT doc_id, {_PLAIN.format(_NAME_SQL)} AS s FROM documents) SELECT doc_id, CASE
        {' '.join(f"WHEN {' OR '.join(f"contains(s, '{m}')" for m in markers)} THEN '{tier}'" for tier, markers in P.SENSITIVITY)} ELSE '' END AS tier FROM t""",
    "documents",
)
def _k15(d: DataFrame) -> DataFrame:
    return _named(d).select("doc_id", R.sensitivity(F.col("name")).alias("tier"))


_SENTENCES = (
    "Le groupe affirme avoir vole des comptes", "La direction conteste", "Il pourrait manquer des dossiers", "aucun compte", "La ville confirme le vol",
    "Le journal indique une panne", "Rien de plus", "Les agents ne sont pas atteints",
)


@query(
    "K17_modality",
    f"""WITH t AS (SELECT doc_id, [{', '.join(f"'{s}'" for s in _SENTENCES)}][(doc_id % {len(_SENTENCES)}) + 1] AS t FROM documents)
        SELECT doc_id, CASE {' '.join(f"WHEN regexp_matches(t, '(?i)\\b{p.replace("'", "''")}\\b') THEN '{m}'" for m, p in P.MODALITY)} ELSE 'unknown' END AS modality FROM t""",
    "documents",
)
def _k17(d: DataFrame) -> DataFrame:
    said = F.get(F.array(*[F.lit(s) for s in _SENTENCES]), (F.col("doc_id") % len(_SENTENCES)).cast("int"))
    return d.select("doc_id", R.modality(said).alias("modality"))


@query(
    "A18_reason_bucket",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN event_type || '_J' || (event_id % 5) ELSE event_type END AS bucket FROM events""", "events",
)
def _a18(e: DataFrame) -> DataFrame:
    return e.select("event_id", R.reason_bucket(F.col("event_type"), F.col("event_id") % 5, ("view",)).alias("bucket"))


@query(
    "C05_R49_days",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30' AS inside,
        CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
    "orders",
)
def _c05(o: DataFrame) -> DataFrame:
    four, at = F.col("o_orderkey") % 4, F.col("o_orderdate")
    said = F.when(four == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(four == 1, F.date_format(at, "yyyy-MM-dd")).when(four == 2, F.date_format(at, "yyyy-MM-dd 'um' HH")).otherwise("soon")
    inside = R.in_window(F.to_date("o_orderdate"), F.lit("1996-01-01").cast("date"), F.lit("1997-06-30").cast("date"))
    return o.select("o_orderkey", inside.alias("inside"), R.day_of(said).alias("day"))
