"""Queries of extraction, the cascade, queues and audits (X-*, Q-01, A-*, R-*, W-13, D-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import searchable
from tidemark.operators import extract as X
from tidemark.plans.registry import query

_PLAIN = r"trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(
    "X05_known_entities",
    f"""WITH e AS (SELECT DISTINCT lower(p_name) AS key FROM part UNION SELECT DISTINCT split_part(lower(p_name), ' ', 1) FROM part), t AS (SELECT doc_id, {_PLAIN.format("coalesce(text, '') || ' ' || p_name")} AS s
        FROM documents JOIN part ON p_partkey = doc_id % 200), m AS (SELECT doc_id, key FROM t JOIN e ON contains(' ' || s || ' ', ' ' || key || ' '))
        SELECT doc_id, arg_min(upper(key), (-length(key), key)) AS label FROM m GROUP BY 1""",
    "documents", "part",
)
def _x05(d: DataFrame, p: DataFrame) -> DataFrame:
    whole = p.select(F.lower("p_name").alias("key"))
    keys = whole.unionByName(whole.select(F.split_part("key", F.lit(" "), F.lit(1)).alias("key"))).distinct()
    texts = d.join(p, F.col("p_partkey") == F.col("doc_id") % 200).select("doc_id", F.concat_ws(" ", F.coalesce("text", F.lit("")), "p_name").alias("t"))
    return X.known_entities(texts.select("doc_id", searchable(F.col("t")).alias("s")), keys.withColumn("label", F.upper("key")), "doc_id", "s")


_COUNTS = ("12 500 comptes", "2,5 millions de personnes", "plus de 3 mille clients", "45 chaises puis 7 dossiers", "rien", "1.200 élèves", "10 milliers d''abonnés")


@query(
    "X10_count_phrase",
    """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 12500 WHEN 1 THEN 2500000 WHEN 2 THEN 3000 WHEN 3 THEN 7 WHEN 5 THEN 1200 WHEN 6 THEN 10000 END AS value,
        CASE event_id % 7 WHEN 0 THEN 'accounts' WHEN 2 THEN 'clients' WHEN 3 THEN 'files' WHEN 4 THEN NULL ELSE 'people' END AS unit FROM events""",
    "events",
)
def _x10(e: DataFrame) -> DataFrame:
    said = F.get(F.array(*[F.lit(c.replace("''", "'")) for c in _COUNTS]), (F.col("event_id") % 7).cast("int"))
    return e.select("event_id", X.count_phrase(said).alias("c")).select("event_id", "c.value", "c.unit")


_TOLD = "Une fuite expose des e-mails. Le vol concerne aussi des mots de passe et un IBAN. Rien sur les passeports."


@query(
    "X12_data_types",
    f"""WITH v AS (SELECT doc_id, unnest(['adresses e-mail', 'mots de passe', 'données bancaires']) AS value FROM documents WHERE doc_id % 2 = 0)
        SELECT doc_id, value, 'unknown' AS status FROM v""",
    "documents",
)
def _x12(d: DataFrame) -> DataFrame:
    told = F.when(F.col("doc_id") % 2 == 0, _TOLD).otherwise("Des adresses postales ici.")
    return X.data_types(d.select("doc_id", told.alias("t")), "doc_id", "t").drop("evidence")


@query(
    "Q01_cascade",
    """WITH s AS (SELECT c_custkey, c_mktsegment AS a, CASE WHEN c_custkey % 2 = 0 THEN 'REF' ELSE c_mktsegment END AS b FROM customer), t AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'RULE' ELSE b END AS c FROM s)
        SELECT c_custkey, c AS value, CASE WHEN a <> b THEN 'APPLIED' END AS reference, CASE WHEN b <> c AND a <> b THEN 'REJECTED_LOWER_PRIORITY' WHEN b <> c THEN 'APPLIED' END AS rule FROM t""",
    "customer",
)
def _q01(c: DataFrame) -> DataFrame:
    def setting(value: str, every: int):  # noqa: ANN202
        return lambda rows: rows.withColumn("c_mktsegment", F.when(F.col("c_custkey") % every == 0, value).otherwise(F.col("c_mktsegment")))

    items, decisions = X.cascade(c, "c_custkey", ["c_mktsegment"], [("MANUAL_REFERENCE", setting("REF", 2)), ("SAFE_NAME_RULE", setting("RULE", 3))])
    told = decisions.groupBy("c_custkey").agg(
        F.max(F.when(F.col("origin") == "MANUAL_REFERENCE", F.col("decision"))).alias("reference"), F.max(F.when(F.col("origin") == "SAFE_NAME_RULE", F.col("decision"))).alias("rule")
    )
    return items.select("c_custkey", F.col("c_mktsegment").alias("value")).join(told, "c_custkey", "left")


@query(
    "A11_A28_outcomes",
    """SELECT event_type, count(*) FILTER (value > 30) AS applied, round_even(100.0::DOUBLE * count(*) FILTER (value > 30 AND event_id % 3 <> 0) / nullif(count(*) FILTER (value > 30), 0), 1) AS precision,
        count(*) FILTER (value > 30 AND event_id % 3 <> 0 AND event_id % 2 <> 0) AS gains, count(*) FILTER (value > 30 AND event_id % 3 = 0 AND event_id % 2 = 0) AS regressions FROM events GROUP BY 1""",
    "events",
)
def _a11(e: DataFrame) -> DataFrame:
    return X.outcome_counts(e, ["event_type"], F.col("value") > 30, F.col("event_id") % 3 != 0, F.col("event_id") % 2 == 0)


@query(
    "A16_G12_coverage_groups",
    """SELECT c_mktsegment, count(*) AS expected, count(*) FILTER (s = 'OK') AS collected, count(*) FILTER (coalesce(s, '') <> 'OK') AS blind FROM customer
        LEFT JOIN (SELECT o_custkey, CASE WHEN max(o_totalprice) > 300000 THEN 'OK' ELSE 'PARTIAL' END AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""",
    "customer", "orders",
)
def _a16(c: DataFrame, o: DataFrame) -> DataFrame:
    status = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.max("o_totalprice") > 300000, "OK").otherwise("PARTIAL").alias("s"))
    return X.coverage_groups(c, status, "c_mktsegment", "c_custkey", "s")


@query(
    "A33_C22_usage",
    """SELECT role, count(*) AS calls, round_even(100.0::DOUBLE * count(*) FILTER (length(text) > 100) / count(*), 1) AS ok_pct, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS tokens,
        round_even(sum(coalesce(length(text), 0)) * 0.4::DOUBLE / 1000000, 6) AS cost FROM conversations GROUP BY 1""",
    "conversations",
)
def _a33(c: DataFrame) -> DataFrame:
    return X.usage(c, "role", F.length("text") > 100, F.coalesce(F.length("text"), F.lit(0)).cast("long"), 0.4)


@query(
    "R19_queue_rows",
    """SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey
        WHERE m IS NULL OR date_diff('day', m, DATE '2001-01-01') > 200""",
    "customer", "orders",
)
def _r19(c: DataFrame, o: DataFrame) -> DataFrame:
    cache = o.select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("checked"))
    return X.queue_rows(c.select("c_custkey"), cache, "c_custkey", "checked", "2001-01-01", 200)


@query("R21_augmented", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0", "customer")
def _r21(c: DataFrame) -> DataFrame:
    return X.augmented(c.filter("c_custkey % 2 = 0").select("c_custkey", "c_name"), c.filter("c_custkey % 3 = 0").select("c_custkey"), "c_custkey")


@query(
    "R20_purged",
    """WITH w AS (SELECT o_custkey FROM orders WHERE o_custkey % 5 = 0 GROUP BY 1 HAVING count(*) FILTER (o_orderstatus <> 'O') > 0)
        SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM w) THEN 'Unknown' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
    "orders",
)
def _r20(o: DataFrame) -> DataFrame:
    expected = o.filter("o_custkey % 5 = 0").select("o_custkey").distinct().withColumn("o_orderstatus", F.lit("O"))
    return X.purged(o, expected, "o_custkey", "o_orderstatus", "Unknown").select("o_orderkey", "o_orderstatus")


@query("R26_without_runs", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'click')", "events")
def _r26(e: DataFrame) -> DataFrame:
    return X.without_runs(e, "event_type", ["error", "click"]).select("event_id")


@query(
    "R36_candidate_pool",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC LIMIT 25""",
    "orders", "lineitem",
)
def _r36(o: DataFrame, li: DataFrame) -> DataFrame:
    ledger = li.filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return X.candidate_pool(o.withColumn("day", F.to_date("o_orderdate")), ledger, "o_orderkey", "day", F.col("o_orderstatus") == "O", 25).select("o_orderkey")


@query(
    "W13_near_in_time",
    """SELECT o_orderkey, next FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, lead(o_orderkey) OVER w AS next, CAST(lead(o_orderdate) OVER w AS DATE) AS n FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)) WHERE date_diff('day', d, n) <= 3""",
    "orders",
)
def _w13(o: DataFrame) -> DataFrame:
    return X.near_in_time(o.withColumn("day", F.to_date("o_orderdate")), "o_custkey", "day", "o_orderkey")


@query(
    "D11_evidence_or_all",
    """SELECT o_orderkey FROM orders QUALIFY o_orderstatus = 'F' OR NOT bool_or(o_orderstatus = 'F') OVER (PARTITION BY o_custkey)""", "orders",
)
def _d11(o: DataFrame) -> DataFrame:
    return X.evidence_or_all(o, "o_custkey", F.col("o_orderstatus") == "F").select("o_orderkey")
