"""Queries of facts, incremental state, gates and audits (N-*, I-*, G-*, A-*, R-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import facts as X
from tidemark.plans.registry import query

_FACTS = "SELECT user_id, event_type AS source, event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' Alpha' WHEN 2 THEN 'alpha' ELSE 'inconnu' END AS v FROM events"


def _facts(e: DataFrame) -> DataFrame:
    four = F.col("event_id") % 4
    value = F.when(four == 0, "").when(four == 1, " Alpha").when(four == 2, "alpha").otherwise("inconnu")
    return e.select("user_id", F.col("event_type").alias("source"), "event_id", value.alias("v"))


def _rank(source: Column) -> Column:
    return F.when(source == "purchase", 0).when(source == "signup", 1).otherwise(9)


@query(
    "N04_resolved",
    f"""WITH f AS (SELECT *, lower(trim(v)) AS norm, CASE source WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 9 END AS r FROM ({_FACTS}) WHERE lower(trim(v)) NOT IN ('', 'inconnu')),
        b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY r, source, v) = 1),
        s AS (SELECT user_id, norm, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM f GROUP BY ALL)
        SELECT user_id, v, sources FROM b JOIN s USING (user_id, norm)""",
    "events",
)
def _n04(e: DataFrame) -> DataFrame:
    got = X.resolved(_facts(e), "user_id", "v", "source", _rank(F.col("source")), ("inconnu",))
    return got.select("user_id", "v", F.array_join("sources", ",").alias("sources"))


@query(
    "N05_N07_resolved_list",
    f"""SELECT user_id, arg_min(v, (event_id, v)) AS v, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM ({_FACTS}) WHERE trim(v) <> '' GROUP BY user_id, lower(trim(v))""",
    "events",
)
def _n05(e: DataFrame) -> DataFrame:
    got = X.resolved_list(_facts(e), "user_id", "v", "source", "event_id")
    return got.select("user_id", "v", F.array_join("sources", ",").alias("sources"))


@query(
    "N10_merged_facts",
    """WITH b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 7 <> 0),
        a AS (SELECT o_orderkey AS k, 'N' AS s, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'new' END AS p FROM orders WHERE o_orderkey % 5 <> 0)
        SELECT coalesce(a.k, b.k) AS k, coalesce(nullif(b.s, ''), a.s) AS s, coalesce(nullif(a.p, ''), b.p) AS p FROM a FULL JOIN b ON a.k = b.k""",
    "orders",
)
def _n10(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    old = o.filter(k % 7 != 0).select(k.alias("k"), F.when(k % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("s"), F.col("o_orderpriority").alias("p"))
    new = o.filter(k % 5 != 0).select(k.alias("k"), F.lit("N").alias("s"), F.when(k % 2 == 0, "").otherwise("new").alias("p"))
    return X.merged_facts(old, new, "k", ["s"], ["p"])


@query(
    "N11_richest",
    """WITH f AS (SELECT source, doc_id, lang, CAST(lang IS NOT NULL AND trim(lang) <> '' AS INTEGER) + CAST(n_chars IS NOT NULL AS INTEGER) AS richness, md5(text) AS summary FROM documents WHERE text IS NOT NULL)
        SELECT source, summary, richness FROM f QUALIFY row_number() OVER (PARTITION BY source ORDER BY richness DESC, doc_id DESC) = 1""",
    "documents",
)
def _n11(d: DataFrame) -> DataFrame:
    return X.richest(d.withColumn("summary", F.md5("text")), "source", "summary", ["lang", "n_chars"], ["doc_id"])


_JSON = """CASE event_id % 5 WHEN 0 THEN '[{"name":"n' || event_id || '"},{"title":"t"}]' WHEN 1 THEN '{"victims":[{"title":"v' || event_id || '"}]}' WHEN 2 THEN '{"items":[]}'
    WHEN 3 THEN 'broken' ELSE '{"name":"only"}' END"""


@query(
    "N01_N14_N15_records",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n, CASE event_id % 5 WHEN 0 THEN 'n' || event_id || ',t' WHEN 1 THEN 'v' || event_id ELSE '' END AS names FROM events""",
    "events",
)
def _n15(e: DataFrame) -> DataFrame:
    rows = e.select("event_id", F.expr(_JSON).alias("payload")).select("event_id", X.records_of(F.col("payload")).alias("r"))
    names = F.transform("r", lambda x: X.first_alias(x, ("name", "title")))
    return rows.select("event_id", F.size("r").alias("n"), F.array_join(names, ",").alias("names"))


@query(
    "N13_stamped",
    "SELECT o_orderkey, o_orderstatus || ':' || o_orderkey || ',own:' || o_orderkey AS origins FROM orders", "orders",
)
def _n13(o: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    claims = F.array(F.struct(none.alias("source"), none.alias("item")), F.struct(F.lit("own").alias("source"), none.alias("item")))
    rows = o.select("o_orderkey", X.stamped(claims, source=F.col("o_orderstatus"), item=F.col("o_orderkey").cast("string")).alias("c"))
    return rows.select("o_orderkey", F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["source"], x["item"])), ",").alias("origins"))


@query("N16_search_text", "SELECT p_partkey, lower(concat_ws(' ', nullif(trim(p_name), ''), p_brand, nullif(p_type, ''))) AS text FROM part", "part")
def _n16(p: DataFrame) -> DataFrame:
    return p.select("p_partkey", X.search_text(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("text"))




def _print_sql(*parts: str) -> str:
    return "sha256(" + " || ".join(f"octet_length(encode(coalesce(CAST({p} AS VARCHAR), ''))) || ':' || coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"


@query("I01_fingerprint", f"SELECT doc_id, {_print_sql('text', 'lang', 'source')} AS mark FROM documents", "documents")
def _i01(d: DataFrame) -> DataFrame:
    return d.select("doc_id", X.fingerprint(F.col("text"), F.col("lang"), F.col("source")).alias("mark"))


@query(
    "I03_state_metrics",
    """SELECT count(*) FILTER (k % 3 = 0) AS new, count(*) FILTER (k % 3 = 1) AS dirty, count(*) FILTER (k % 3 = 2) AS unchanged,
        round_even(100.0::DOUBLE * count(*) FILTER (k % 3 = 2) / count(*), 2) AS reuse_pct FROM (SELECT o_orderkey AS k FROM orders)""",
    "orders",
)
def _i03(o: DataFrame) -> DataFrame:
    third = F.col("o_orderkey") % 3
    return X.state_metrics(o.select(F.when(third == 0, "NEW").when(third == 1, "DIRTY").otherwise("UNCHANGED").alias("state")))


@query(
    "I04_parity_breaks",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'output,origin' WHEN o_orderkey % 5 = 0 THEN 'output' ELSE 'origin' END AS broken FROM orders
        WHERE o_orderkey % 3 <> 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 2 = 0)""",
    "orders",
)
def _i04(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    before = o.select("o_orderkey", F.lit("a").alias("output"), F.lit("b").alias("origin"))
    after = o.select("o_orderkey", F.when(k % 5 == 0, "x").otherwise("a").alias("output"), F.when(k % 2 == 0, "y").otherwise("b").alias("origin"))
    return X.parity_breaks(before, after, o.filter(k % 3 != 0), "o_orderkey", ["output", "origin"])


@query("I07_reusable", "SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 3 <> 0 AND text IS NOT NULL", "documents")
def _i07(d: DataFrame) -> DataFrame:
    now = d.select("doc_id", F.md5("text").alias("hash"), F.lit("v2").alias("version"))
    facts = now.withColumns({"hash": F.when(F.col("doc_id") % 4 == 0, "old").otherwise(F.col("hash")), "version": F.when(F.col("doc_id") % 3 == 0, "v1").otherwise("v2")})
    return X.reusable(facts, now, "doc_id", "hash", "version").select("doc_id")


@query(
    "I06_I09_set_hash",
    f"""WITH h AS (SELECT {_print_sql('o_orderkey', 'o_orderstatus')} AS h FROM orders), b AS (SELECT CAST('0x' || h[1:8] AS BIGINT) % 1024 AS b, count(*) AS n, sha256(string_agg(h, chr(10) ORDER BY h)) AS h FROM h GROUP BY 1)
        SELECT CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(h, chr(10) ORDER BY b)) AS digest FROM b""",
    "orders",
)
def _i09(o: DataFrame) -> DataFrame:
    return X.set_hash(o, F.col("o_orderkey"), F.col("o_orderstatus"))


@query(
    "G01_violations",
    """SELECT 'duplicate_id' AS fault, CAST(l_orderkey AS VARCHAR) AS subject FROM lineitem GROUP BY l_orderkey HAVING count(*) > 4
        UNION ALL SELECT 'without_source', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT 'missing_source', o_orderpriority FROM orders GROUP BY o_orderpriority HAVING max(o_totalprice) < 100""",
    "lineitem", "orders",
)
def _g01(li: DataFrame, o: DataFrame) -> DataFrame:
    return X.violations(
        duplicate_id=li.groupBy("l_orderkey").count().filter("count > 4"),
        without_source=o.select("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"),
        missing_source=o.groupBy("o_orderpriority").agg(F.max("o_totalprice").alias("m")).filter("m < 100"),
    )


@query(
    "G02_G03_worsened",
    """WITH b AS (SELECT o_orderpriority AS p, count(*) AS items, sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS unknown FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
        a AS (SELECT o_orderpriority AS p, count(*) AS items, sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS unknown FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
        SELECT p, 'items' AS measure, CAST(b.items AS DOUBLE) AS before, CAST(a.items AS DOUBLE) AS after FROM a JOIN b USING (p) WHERE b.items - a.items > 1
        UNION ALL SELECT p, 'unknown', CAST(b.unknown AS DOUBLE), CAST(a.unknown AS DOUBLE) FROM a JOIN b USING (p) WHERE a.unknown - b.unknown > 1""",
    "orders",
)
def _g02(o: DataFrame) -> DataFrame:
    def report(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("o_orderstatus") == "F").alias("unknown"))

    return X.worsened(report(o.filter("o_orderkey % 2 = 0")), report(o.filter("o_orderkey % 2 = 1")), ["p"], {"items": True, "unknown": False}, 1.0)


@query(
    "G04_gate",
    """WITH r AS (SELECT user_id, count(*) AS n, 100.0::DOUBLE * count(*) FILTER (value > 20) / count(*) AS pct, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY 1)
        SELECT user_id, concat_ws(',', CASE WHEN n < 60 THEN 'cases' END, CASE WHEN pct < 80 THEN 'precision' END, CASE WHEN bad > 12 THEN 'regressions' END) AS failures
        FROM r WHERE n < 60 OR pct < 80 OR bad > 12""",
    "events",
)
def _g04(e: DataFrame) -> DataFrame:
    rows = e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), (100.0 * F.count_if(F.col("value") > 20) / F.count(F.lit(1))).alias("pct"), F.count_if(F.col("event_type") == "error").alias("bad")
    )
    return X.gate(rows, "user_id", F.col("n"), F.col("pct"), F.col("bad"), 60, 80.0, 12)


@query(
    "G08_G10_G11_statuses",
    """SELECT p_partkey, CASE WHEN p_size >= 65 THEN 'KEEP' WHEN p_size < 35 AND p_partkey % 10 >= 5 AND p_partkey % 100 < 50 AND p_partkey % 3 = 0 THEN 'DEACTIVATION_CANDIDATE'
        WHEN p_size < 50 THEN 'REVIEW' ELSE 'WATCH' END AS action, CASE WHEN p_partkey % 2 = 0 OR p_size <= 20 THEN 'COMPLETE' WHEN p_size > 20 THEN 'TRUNCATED' ELSE 'UNKNOWN' END AS history,
        CASE WHEN p_partkey % 9 = 0 THEN 'SKIPPED' WHEN p_size % 7 = 0 THEN 'FAIL' WHEN p_size % 7 < p_partkey % 9 OR p_partkey % 5 = 0 THEN 'PARTIAL' ELSE 'OK' END AS status,
        CASE WHEN p_partkey % 9 = 0 OR p_size % 7 = 0 THEN 0 WHEN p_size % 7 < p_partkey % 9 OR p_partkey % 5 = 0 THEN least(99, 100 * (p_size % 7) // (p_partkey % 9)) ELSE 100 END AS pct FROM part""",
    "part",
)
def _g08(p: DataFrame) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    status = X.resolved_status(size % 7, k % 9, F.when(k % 5 == 0, "LIMIT").otherwise(""))
    return p.select(
        "p_partkey", X.portfolio_action(size, k % 10, k % 100, k % 3).alias("action"), X.history_status(F.lit(20), size, k % 2 == 0).alias("history"), status.alias("s")
    ).select("p_partkey", "action", "history", "s.status", "s.pct")


@query(
    "A26_evaluation",
    """WITH j AS (SELECT lang, CASE WHEN quality = 1 THEN 'good' ELSE 'Unknown' END AS t, CASE WHEN length(text) > 800 THEN 'good' WHEN length(text) > 300 THEN 'bad' ELSE 'Unknown' END AS p
        FROM labels JOIN documents USING (doc_id))
        SELECT lang, count(*) AS cases, round_even(100.0::DOUBLE * count(*) FILTER (t = p) / count(*), 1) AS accuracy, round_even(100.0::DOUBLE * count(*) FILTER (p <> 'Unknown') / count(*), 1) AS coverage,
        round_even(100.0::DOUBLE * count(*) FILTER (t = p AND p <> 'Unknown') / nullif(count(*) FILTER (p <> 'Unknown'), 0), 1) AS precision,
        count(*) FILTER (p = 'Unknown' AND t <> 'Unknown') AS resolvable, count(*) FILTER (p <> 'Unknown' AND t <> p) AS wrong FROM j GROUP BY 1""",
    "labels", "documents",
)
def _a26(labels: DataFrame, d: DataFrame) -> DataFrame:
    n = F.length("text")
    told = F.when(n > 800, "good").when(n > 300, "bad").otherwise("Unknown")
    joined = labels.join(d.select("doc_id", "lang", told.alias("p")), "doc_id").withColumn("t", F.when(F.col("quality") == 1, "good").otherwise("Unknown"))
    return X.evaluation(joined, "t", "p", "Unknown", "lang")


@query(
    "A08_value_audit",
    """SELECT p_name, count(*) AS items, count(*) FILTER (p_size < 25) AS unknown, CASE WHEN count(*) FILTER (p_size < 25) = 0 THEN 'KNOWN' WHEN count(*) FILTER (p_size < 25) = count(*)
        THEN 'UNKNOWN' ELSE 'MIXED' END AS bucket FROM part GROUP BY 1""",
    "part",
)
def _a08(p: DataFrame) -> DataFrame:
    return X.value_audit(p.withColumn("label", F.when(F.col("p_size") >= 25, F.col("p_type"))), "p_name", "label", "Inconnu")


@query(
    "R31_transformation_rates",
    """WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 200)
        SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) FILTER (value < 60) AS before, count(*) FILTER (value < 20) AS after,
        coalesce(round_even(100.0::DOUBLE * (count(*) FILTER (value < 60) - count(*) FILTER (value < 20)) / nullif(count(*) FILTER (value < 60), 0), 1), 0) AS rate FROM l GROUP BY ROLLUP (event_type)""",
    "events",
)
def _r31(e: DataFrame) -> DataFrame:
    return X.transformation_rates(e, "event_type", ["ts", "event_id"], F.col("value") < 60, F.col("value") < 20, 200)


@query(
    "R25_collapsed",
    "SELECT o_custkey, 'x' AS content, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first FROM orders GROUP BY 1", "orders",
)
def _r25(o: DataFrame) -> DataFrame:
    return X.collapsed(o.select("o_custkey", F.lit("x").alias("content"), F.to_date("o_orderdate").alias("first")), "o_custkey", ["content"], "first")


@query(
    "R04_reviewed",
    """WITH j AS (SELECT event_id % 1500 AS c_custkey, event_id AS seq, CASE event_type WHEN 'error' THEN 'DUPLICATE' ELSE 'CORRECTED' END AS verdict,
        CASE WHEN event_id % 2 = 0 THEN 'c_name' ELSE 'c_mktsegment' END AS field, 'v' || event_id AS value FROM events WHERE event_type IN ('error', 'signup')),
        f AS (SELECT c_custkey, arg_max(value, seq) FILTER (field = 'c_name') AS a, arg_max(value, seq) FILTER (field = 'c_mktsegment') AS b FROM j WHERE verdict = 'CORRECTED' GROUP BY 1)
        SELECT c_custkey, coalesce(a, c_name) AS c_name, coalesce(b, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN f USING (c_custkey)
        WHERE c_custkey NOT IN (SELECT c_custkey FROM j WHERE verdict = 'DUPLICATE')""",
    "customer", "events",
)
def _r04(c: DataFrame, e: DataFrame) -> DataFrame:
    k = F.col("event_id")
    journal = e.filter(F.col("event_type").isin("error", "signup")).select(
        (k % 1500).alias("c_custkey"), k.alias("seq"), F.when(F.col("event_type") == "error", "DUPLICATE").otherwise("CORRECTED").alias("verdict"),
        F.when(k % 2 == 0, "c_name").otherwise("c_mktsegment").alias("field"), F.concat(F.lit("v"), k.cast("string")).alias("value"),
    )
    return X.reviewed(c, journal, "c_custkey", ["c_name", "c_mktsegment"]).select("c_custkey", "c_name", "c_mktsegment")


@query(
    "R39_changed_counts",
    """SELECT count(*) FILTER (k % 7 = 0 AND k % 5 <> 0) AS added, count(*) FILTER (k % 5 = 0 AND k % 7 <> 0) AS removed,
        count(*) FILTER (k % 5 <> 0 AND k % 7 <> 0 AND k % 11 = 0 AND s <> 'X') AS modified, count(*) FILTER (k % 5 <> 0 AND k % 7 <> 0 AND NOT (k % 11 = 0 AND s <> 'X')) AS unchanged
        FROM (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders)""",
    "orders",
)
def _r39(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    after = o.filter(k % 5 != 0).withColumn("o_orderstatus", F.when(k % 11 == 0, "X").otherwise(F.col("o_orderstatus")))
    return X.changed_counts(o.filter(k % 7 != 0), after, "o_orderkey", ["o_orderstatus"])
