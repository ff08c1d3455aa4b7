"""Queries of proved activities (K-10): the documents, each after a sentence of the organisation that it is about."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import activity as X
from tidemark.plans.registry import query

#: (organisation, what is said), one for each document by its id.
SAMPLES = (
    ("Acme Cloud", "Nous sommes un éditeur de logiciels SaaS pour les entreprises."),
    ("Intermarché", "Intermarché est une enseigne de supermarchés en France."),
    ("STOR Solutions", "STOR Solutions travaille avec Iagona, son fournisseur, fabricant de bornes."),
    ("KparK", "KparK - N°1 de la rénovation de l'habitat, fenêtres et volets."),
    ("Acme Groupe", "Acme Groupe, leader européen du BTP et des concessions, bâtit."),
    ("Beta", "Le marché de la construction progresse; Gamma est une banque."),
    ("Banque Delta", "Banque Delta est une banque et une assurance."),
    ("Epsilon", "Epsilon exploite une usine; elle est aussi un magasin."),
    ("", "We are a law firm."),
    ("Zeta SA", "Court."),
)
_W = r"[^\p{L}\p{N}_]"


def _text_sql(i: int) -> str:
    return "[" + ", ".join("'" + s[i].replace("'", "''") + "'" for s in SAMPLES) + f"][(doc_id % {len(SAMPLES)}) + 1]"


def _java_free(p: str) -> str:
    return p.replace("'", "''").replace(r"\b", rf"(?:^|$|{_W})")


def _rules_sql(text: str, rules) -> str:
    """list of structs (lost, sector, k): `k` is how much stands before the words."""
    each = []
    for sector, weight, alternatives in rules:
        core = "|".join(alternatives).replace("'", "''")
        whole = rf"(?is)^(.*?(?:^|{_W}))(?:{core})(?:$|{_W})"
        each.append(
            f"CASE WHEN regexp_matches({text}, '(?i)(?:^|{_W})(?:{core})(?:$|{_W})') THEN "
            f"{{'lost': {-weight}, 'sector': '{sector}', 'k': length(regexp_extract({text}, '{whole}', 1))}} END"
        )
    return f"list_sort(list_filter([{', '.join(each)}], lambda m: m IS NOT NULL))"


def _blob(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(strip_accents({t})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _before(chars: int) -> str:
    return f"substring(s, greatest(k - {chars}, 0) + 1, k - greatest(k - {chars}, 0))"


_FIRST, _COPULA, _THIRD = (f"(?i){_java_free(p)}" for p in (X.FIRST_PERSON, X.COPULA, X.THIRD_PARTY))
_COMMON = ", ".join(f"'{w}'" for w in X.COMMON_WORDS)


@query(
    "K10_subject_activity",
    rf"""WITH d AS (SELECT doc_id, {_text_sql(0)} AS org, {_text_sql(1)} || ' ' || coalesce(text, '') AS t FROM documents),
    n AS (SELECT doc_id, {_blob('org')} AS name, string_split(regexp_replace(t, '([.!?;])\s+|[\r\n]+', E'\\1\n', 'g'), E'\n') AS parts FROM d),
    p AS (SELECT doc_id, name, unnest(parts) AS raw, generate_subscripts(parts, 1) AS place FROM n),
    c AS (SELECT doc_id, name, place, trim(regexp_replace(replace(replace(replace(replace(replace(replace(raw,
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS s FROM p),
    f AS (SELECT *, {_rules_sql('s', X.WORDINGS + X.ACTIVITIES)} AS found FROM c WHERE length(s) BETWEEN 15 AND 900),
    b AS (SELECT *, found[1].sector AS sector, -found[1].lost AS score, found[1].k AS k, list_filter(found, lambda m: m.sector <> found[1].sector)[1].lost AS rival
      FROM f WHERE len(found) > 0),
    e AS (SELECT *, {_before(220)} AS before, list_filter(string_split(name, ' '), lambda w: length(w) > 2 AND w NOT IN ({_COMMON})) AS tokens FROM b
      WHERE rival IS NULL OR score >= -rival + {X.LEAD}),
    g AS (SELECT *, len(list_filter(tokens, lambda w: contains({_blob('before')}, w))) AS told FROM e),
    h AS (SELECT * FROM g WHERE NOT regexp_matches({_before(120)}, '{_THIRD}') AND (regexp_matches(before, '{_FIRST}') OR (
        len(tokens) > 0 AND told >= least(2, len(tokens)) AND ((k <= 140 AND ((name <> '' AND starts_with({_blob('substring(s, 1, least(k, 120))')}, name))
          OR regexp_matches(right(before, 100), '{X.HEADED}'))) OR regexp_matches(right(before, 140), '{_COPULA}'))))),
    o AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY place) = 1)
    SELECT d.doc_id, o.sector, o.s[1:500] AS sentence, CAST(o.score AS BIGINT) AS score, CASE WHEN o.score >= {X.STRONG_SCORE} THEN o.sector END AS strong
    FROM d LEFT JOIN o USING (doc_id)""",
    "documents",
)
def _k10(d: DataFrame) -> DataFrame:
    rows = _sampled(d).withColumn("proof", X.subject_activity(F.col("org"), F.col("t")))
    strong = F.when(F.col("proof.score") >= X.STRONG_SCORE, F.col("proof.sector"))
    return rows.select("doc_id", "proof.sector", "proof.sentence", F.col("proof.score").cast("long").alias("score"), strong.alias("strong"))


@query(
    "K10_official_activity",
    rf"""WITH d AS (SELECT doc_id, {_text_sql(1)} || ' ' || coalesce(text, '') AS t FROM documents),
    f AS (SELECT doc_id, {_rules_sql('t', X.ACTIVITIES)} AS found FROM d)
    SELECT doc_id, CASE WHEN found[2] IS NULL OR -found[1].lost >= -found[2].lost + {X.LEAD} THEN found[1].sector END AS sector FROM f""",
    "documents",
)
def _k10_official(d: DataFrame) -> DataFrame:
    return _sampled(d).select("doc_id", X.official_activity(F.col("t"))["sector"].alias("sector"))


def _sampled(d: DataFrame) -> DataFrame:
    place = (F.col("doc_id") % len(SAMPLES)).cast("int")
    org, said = (F.get(F.array(*[F.lit(s[i]) for s in SAMPLES]), place) for i in (0, 1))
    return d.select("doc_id", org.alias("org"), F.concat(said, F.lit(" "), F.coalesce("text", F.lit(""))).alias("t"))
