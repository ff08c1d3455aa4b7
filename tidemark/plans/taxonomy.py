"""Queries of sectors and places (K-03...K-08): the documents, each with a phrase that the rules know before its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.operators import taxonomy as X
from tidemark.plans.registry import query

#: Names and descriptions that the rules tell apart; a document's text follows the one of its id.
SAMPLES = (
    "Mairie de Saint-Denis de La Réunion", "ville de lyon", "Clinique du Parc", "Agence nationale de sécurité du médicament", "Banque de l'Habitat",
    "Fédération française de rugby", "Fédération nationale des artisans", "Rennes Métropole", "Skema Business School", "Mutuelle des Îles",
    "Éditeur de logiciels à Mamoudzou", "entreprise du 97400", "société du département de 976", "cabinet d'avocats à Port-Louis", "la réunion de travail",
    "Usine agroalimentaire, Antananarivo", "Lycée Victor Hugo", "oil & gas", "Retail & e-commerce", "Santé", "professional services", "rien de connu",
    "Stade français Paris", "Santé publique France", "974 dossiers",
)
_SAMPLE_SQL = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in SAMPLES) + f"][(doc_id % {len(SAMPLES)}) + 1]"


def _blob_sql(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(strip_accents({t})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _has(phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(' ' || s || ' ', ' {p} ')" for p in phrases) + ")"


def _opens(openings: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"starts_with(s, '{p}')" for p in openings) + ")"


def _rules(rules, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {_has(phrases)} THEN '{label}'" for label, phrases in rules) + f" ELSE {otherwise} END"


def _names(table, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN s IN ({', '.join(repr(n) for n in names)}) THEN '{label}'" for label, names in table) + f" ELSE {otherwise} END"


_SECTORS = ", ".join(f"'{s}'" for s in P.SECTORS)
_HEALTH = f"(starts_with(s, 'sante publique ') OR ({_has(P.HEALTH_BODIES)} AND {_has(P.HEALTH_MISSIONS)}))"
_ROWS = f"""t0 AS (SELECT doc_id, {_SAMPLE_SQL} AS g, g || ' ' || coalesce(text, '') AS t, coalesce(source, '') AS source FROM documents),
    t1 AS (SELECT *, {_blob_sql('t')} AS s, {_blob_sql('g')} AS gs FROM t0)"""
_NAME = f"""CASE WHEN {_HEALTH} OR {_opens(P.HEALTH_OPENINGS)} THEN '{P.HEALTH}'
    WHEN s = 'service public' OR {_opens(P.ADMIN_OPENINGS)} OR ends_with(s, ' metropole') THEN '{P.ADMIN}'
    WHEN {_opens(P.EDUCATION_OPENINGS)} OR ends_with(s, ' school of business') OR ends_with(s, ' business school') THEN '{P.EDUCATION}'
    WHEN starts_with(s, 'mutuelle ') THEN '{P.FINANCE}'
    WHEN contains(s, 'stade francais') OR starts_with(s, 'federation sportive ') OR ({_opens(P.SPORT_FEDERATIONS)} AND {_has(P.SPORT_TERMS)}) THEN '{P.SPORT}'
    ELSE {_rules(P.NAME_RULES, f"'{P.UNKNOWN}'")} END"""


def _sampled(d: DataFrame) -> DataFrame:
    sample = F.get(F.array(*[F.lit(s) for s in SAMPLES]), (F.col("doc_id") % len(SAMPLES)).cast("int"))
    rows = d.select("doc_id", sample.alias("given"), F.coalesce("text", F.lit("")).alias("body"), F.coalesce("source", F.lit("")).alias("source"))
    return rows.withColumn("text", F.concat_ws(" ", "given", "body"))


@query(
    "K03_K04_K06_sectors",
    f"""WITH {_ROWS}, n AS (SELECT doc_id, g, t, s, {_rules(P.ACTIVITY_RULES, 'NULL')} AS by_rule, {_HEALTH} AS health FROM t1),
    k AS (SELECT doc_id, CASE WHEN trim(g) IN ({_SECTORS}) THEN trim(g) ELSE {_names(P.ACTIVITY_NAMES + P.STRUCTURED_NAMES, f"'{P.UNKNOWN}'")} END AS by_source,
      CASE WHEN trim(g) IN ({_SECTORS}) THEN trim(g) ELSE coalesce({_names(P.ACTIVITY_NAMES, 'NULL')}, {_rules(P.ACTIVITY_RULES, 'NULL')}) END AS by_given
      FROM (SELECT doc_id, g, gs AS s FROM t1))
    SELECT doc_id, by_source AS source_sector, CASE WHEN health THEN '{P.HEALTH}' ELSE coalesce(by_rule, '{P.UNKNOWN}') END AS activity_sector,
      coalesce(by_given, by_rule, '{P.UNKNOWN}') AS sector FROM n JOIN k USING (doc_id)""",
    "documents",
)
def _k03(d: DataFrame) -> DataFrame:
    given, text = F.col("given"), F.col("text")
    return _sampled(d).select(
        "doc_id", X.source_sector(given).alias("source_sector"), X.activity_sector(text).alias("activity_sector"), X.sector([text], given).alias("sector")
    )


@query(
    "K05_name_sector",
    f"""WITH {_ROWS}, w AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '{P.ENERGY}' WHEN doc_id % 11 = 1 THEN '{P.UNKNOWN}' ELSE '' END AS watched FROM documents),
    a AS (SELECT doc_id, {_NAME} AS whole FROM t1), b AS (SELECT doc_id, {_NAME} AS name FROM (SELECT doc_id, gs AS s FROM t1))
    SELECT doc_id, whole AS text_sector, CASE WHEN watched NOT IN ('', '{P.UNKNOWN}') THEN watched ELSE name END AS name_sector
    FROM a JOIN b USING (doc_id) JOIN w USING (doc_id)""",
    "documents",
)
def _k05(d: DataFrame) -> DataFrame:
    eleven = F.col("doc_id") % 11
    watched: Column = F.when(eleven == 0, P.ENERGY).when(eleven == 1, P.UNKNOWN).otherwise("")
    return _sampled(d).select(
        "doc_id", X.name_sector(F.col("text")).alias("text_sector"), X.name_sector(F.col("given"), watched).alias("name_sector")
    )


_DEPARTMENTS = " ".join(rf"WHEN regexp_matches(s, '\b{n}\d{{2}}\b|\bdepartement\s+(de\s+)?{n}\b') THEN '{p}'" for p, n in P.DEPARTMENTS)
_PLACE = rf"""CASE WHEN regexp_matches(t, '(^|[^\p{{L}}\p{{N}}_])(La R[ée]union|LA R[ÉE]UNION)($|[^\p{{L}}\p{{N}}_])') THEN '{P.REUNION}' {_DEPARTMENTS}
    ELSE {_rules(P.PLACE_HINTS, 'NULL')} END"""


@query(
    "K07_K08_location",
    f"""WITH {_ROWS}, a AS (SELECT doc_id, {_PLACE} AS told FROM t1), b AS (SELECT doc_id, {_PLACE} AS given FROM (SELECT doc_id, g AS t, gs AS s FROM t1)),
    e AS (SELECT doc_id, CASE doc_id % 13 WHEN 0 THEN '{P.SEYCHELLES}' WHEN 1 THEN 'Paris' ELSE '' END AS entity,
      CASE doc_id % 3 WHEN 0 THEN '{P.FRANCE}' WHEN 1 THEN 'nowhere' ELSE '' END AS fallback FROM documents)
    SELECT doc_id, coalesce(told, '{P.UNKNOWN}') AS place,
      coalesce(given, CASE WHEN entity = '{P.SEYCHELLES}' THEN entity END, told, CASE WHEN fallback = '{P.FRANCE}' THEN fallback END, '{P.UNKNOWN}') AS location
    FROM a JOIN b USING (doc_id) JOIN e USING (doc_id)""",
    "documents",
)
def _k07(d: DataFrame) -> DataFrame:
    thirteen, three = F.col("doc_id") % 13, F.col("doc_id") % 3
    entity: Column = F.when(thirteen == 0, P.SEYCHELLES).when(thirteen == 1, "Paris").otherwise("")
    default: Column = F.when(three == 0, P.FRANCE).when(three == 1, "nowhere").otherwise("")
    texts = [F.col("given"), F.col("body")]
    cascade = X.location(texts, given=F.col("given"), entity=entity, default=default)
    return _sampled(d).select("doc_id", X.location(texts).alias("place"), cascade.alias("location"))
