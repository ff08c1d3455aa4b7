"""Queries of decisions over runs, sources, audits and territories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import policies as X
from tidemark.plans.registry import query


def _mod(c: str, n: int) -> Column:
    return F.col(c) % n


@query(
    "C04_best_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 0 THEN '' ELSE '2024-01-01' END AS day FROM orders""",
    "orders",
)
def _c04(o: DataFrame) -> DataFrame:
    event = F.when(_mod("o_orderkey", 3) == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(_mod("o_orderkey", 3) == 1, "")
    published = F.when(_mod("o_orderkey", 4) != 0, "2024-01-01")
    return o.select("o_orderkey", X.best_date(event, published).alias("day"))


_STATUS = ("OK", "PARTIAL", "FAIL", "SKIPPED")


@query(
    "G13_snapshot_blocked",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN false WHEN event_id % 4 = 1 THEN event_type <> 'view' ELSE true END AS blocked FROM events""",
    "events",
)
def _g13(e: DataFrame) -> DataFrame:
    status = F.get(F.array(*map(F.lit, _STATUS)), _mod("event_id", 4).cast("int"))
    return e.select("event_id", X.snapshot_blocked(status, F.when(F.col("event_type") == "view", "live_watch")).alias("blocked"))


@query(
    "G14_run_breaks",
    """WITH r AS (SELECT CAST(event_id AS VARCHAR) AS run, event_type = 'view' AS delta, event_id % 3 AS n, event_id % 2 AS d, event_id % 5 - 3 AS c, event_id % 7 - 5 AS m FROM events)
        SELECT run, 'delta_with_work:new=' || n || ',dirty=' || d AS fault FROM r WHERE delta AND (n <> 0 OR d <> 0)
        UNION ALL SELECT run, 'delta_with_sourcefacts_llm' FROM r WHERE delta AND c > 0 UNION ALL SELECT run, 'shadow_mismatch' FROM r WHERE m > 0""",
    "events",
)
def _g14(e: DataFrame) -> DataFrame:
    mode = F.when(F.col("event_type") == "view", "delta").otherwise("full")
    return X.run_breaks(e, "event_id", mode, _mod("event_id", 3), _mod("event_id", 2), _mod("event_id", 5) - 3, _mod("event_id", 7) - 5)


@query(
    "G09_semantic_decision",
    """WITH q AS (SELECT user_id, count(*) AS a, count(*) FILTER (event_type <> 'view') AS r, count(*) FILTER (event_type = 'purchase') AS c,
            count(*) FILTER (event_type <> 'view' AND event_id % 6 = 0) AS z, count(*) FILTER (event_id % 41 = 0) AS u FROM events GROUP BY user_id),
        t AS (SELECT user_id, CASE WHEN a < 8 THEN 'sample' WHEN u > 0 THEN 'evidence' WHEN r = 0 OR c / r < 0.2 THEN 'rare' WHEN z / r >= 0.15 THEN 'empty'
            WHEN user_id % 4 * 0.5 + 0.5 < 1.5 THEN 'thin' ELSE 'covered' END AS reason FROM q) SELECT user_id, reason, reason IN ('empty', 'thin') AS use FROM t""",
    "events",
)
def _g09(e: DataFrame) -> DataFrame:
    rich = F.col("event_type") != "view"
    q = e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("a"), F.count_if(rich).alias("r"), F.count_if(F.col("event_type") == "purchase").alias("c"),
        F.count_if(rich & (_mod("event_id", 6) == 0)).alias("z"), F.count_if(_mod("event_id", 41) == 0).alias("u"),
    )
    claims = _mod("user_id", 4) * 0.5 + 0.5
    return q.select("user_id", X.semantic_decision(*map(F.col, "arcz"), claims, F.col("u")).alias("d")).select("user_id", "d.use", "d.reason")


@query(
    "G05_metric_failures",
    """WITH o AS (SELECT o_custkey AS field, CAST(o_orderkey % 100 AS DOUBLE) AS acc, CAST(o_orderkey % 7 AS DOUBLE) AS wrong FROM orders WHERE o_orderkey % 8 <> 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
        n AS (SELECT o_custkey AS field, CAST(o_orderkey % 100 AS DOUBLE) AS acc, CAST(o_orderkey % 7 AS DOUBLE) AS wrong FROM orders WHERE o_orderkey % 8 <> 1 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
        b AS (SELECT field, o.acc AS oa, n.acc AS na, o.wrong AS ow, n.wrong AS nw FROM o FULL JOIN n USING (field))
        SELECT field, 'absent' AS measure, CAST(NULL AS DOUBLE) AS before, CAST(NULL AS DOUBLE) AS after FROM b WHERE oa IS NULL OR na IS NULL
        UNION ALL SELECT field, 'acc', oa, na FROM b WHERE na + 2 < oa UNION ALL SELECT field, 'wrong', ow, nw FROM b WHERE nw > ow""",
    "orders",
)
def _g05(o: DataFrame) -> DataFrame:
    measured = [(_mod("o_orderkey", 100)).alias("acc"), (_mod("o_orderkey", 7)).alias("wrong")]

    def side(left_out: int, pick: Column) -> DataFrame:
        rows = o.filter(_mod("o_orderkey", 8) != left_out).groupBy(F.col("o_custkey").alias("field")).agg(pick.alias("o_orderkey"))
        return rows.select("field", *measured)

    return X.metric_failures(side(0, F.min("o_orderkey")), side(1, F.max("o_orderkey")), "field", ["acc"], ["wrong"], 2.0)


@query(
    "K18_stratum",
    """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'modalite' WHEN event_id % 3 >= 2 THEN 'chronologie' WHEN event_id % 5 = 0 THEN 'relations'
        WHEN event_id % 4 >= 2 OR event_id % 7 >= 5 THEN 'multi_chiffres' WHEN event_id % 6 >= 3 THEN 'riche' ELSE 'simple' END AS stratum FROM events""",
    "events",
)
def _k18(e: DataFrame) -> DataFrame:
    statuses = F.when(_mod("event_id", 11) == 0, F.array(F.lit("claimed"), F.lit("denied"))).otherwise(F.array(F.lit("claimed")))
    relations = F.when(_mod("event_id", 5) == 0, 1).otherwise(0)
    return e.select("event_id", X.stratum(statuses, _mod("event_id", 3), relations, _mod("event_id", 4), _mod("event_id", 7) - 3, _mod("event_id", 6)).alias("stratum"))


@query(
    "O06_audit_bucket",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 0 WHEN event_id % 2 = 0 THEN 1 WHEN event_id % 3 = 0 THEN 2 WHEN event_id % 5 > 0 THEN 3 ELSE 4 END AS bucket FROM events""",
    "events",
)
def _o06(e: DataFrame) -> DataFrame:
    bucket = X.audit_bucket(F.col("event_type") == "view", _mod("event_id", 2) == 0, _mod("event_id", 3) == 0, _mod("event_id", 5))
    return e.select("event_id", bucket.alias("bucket"))


@query(
    "K13_stable_threat",
    """WITH t AS (SELECT event_id, event_id % 4 AS s, ['Fuite', 'Intrusion', 'DDoS'][event_id % 3 + 1] AS threat, ['DDoS', ' Fuite ', 'autre'][event_id % 5 % 3 + 1] AS native FROM events)
        SELECT event_id, CASE s WHEN 0 THEN CASE WHEN trim(native) <> 'autre' THEN trim(native) ELSE threat END WHEN 1 THEN 'Ransomware'
            WHEN 2 THEN CASE WHEN threat IN ('DDoS', 'Fuite') THEN threat ELSE 'Fuite' END ELSE threat END AS threat FROM t""",
    "events",
)
def _k13(e: DataFrame) -> DataFrame:
    def of(n: Column, *values: str) -> Column:
        return F.get(F.array(*map(F.lit, values)), n.cast("int"))

    threat = of(_mod("event_id", 3), "Fuite", "Intrusion", "DDoS")
    native = of(_mod("event_id", 5) % 3, "DDoS", " Fuite ", "autre")
    source = of(_mod("event_id", 4), "A", "B", "C", "D")
    known = ["Fuite", "Intrusion", "DDoS", "Ransomware"]
    return e.select("event_id", X.stable_threat(source, threat, native, known, ["A"], {"B": "Ransomware"}, {"C": "Fuite"}, ["DDoS", "Fuite"]).alias("threat"))


@query(
    "A13_missing_values",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""",
    "customer", "orders",
)
def _a13(c: DataFrame, o: DataFrame) -> DataFrame:
    return X.missing_values(c.select("c_custkey"), o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query(
    "I10_next_run_ids",
    """WITH l AS (SELECT user_id, event_id % 5 AS n FROM events WHERE event_id % 5 > 0 GROUP BY ALL),
        w AS (SELECT user_id, min(k) AS k FROM (SELECT DISTINCT user_id FROM events) AS u, range(1, 6) AS r(k) WHERE NOT EXISTS (FROM l WHERE l.user_id = u.user_id AND l.n = k) GROUP BY user_id)
        SELECT 'RUN' || user_id AS base, 'RUN' || user_id || CASE WHEN k > 1 THEN '-' || k ELSE '' END AS run_id FROM w""",
    "events",
)
def _i10(e: DataFrame) -> DataFrame:
    base, n = F.concat(F.lit("RUN"), F.col("user_id").cast("string")), _mod("event_id", 5)
    log = e.filter(n > 0).select(F.when(n > 1, F.concat_ws("-", base, n.cast("string"))).otherwise(base).alias("run"))
    return X.next_run_ids(e.select(base.alias("base")).distinct(), log, "base", "run")


_NAMES = (
    "Conseil départemental de la Gironde", "CD33", "Département 974", "Région Île-de-France", "CR 11", "Region 11 Consulting", "33", "Conseil régional de Bretagne", "Mairie de Lyon",
    "département",
)
_IDENTITIES = (
    ("departement", "gironde", "departement gironde"), ("departement", "33", "departement gironde"), ("departement", "974", "departement reunion"),
    ("region", "ile de france", "region ile de france"), ("region", "11", "region ile de france"), ("region", "bretagne", "region bretagne"),
)
_KEYS = (
    "departement gironde", "departement gironde", "departement reunion", "region ile de france", "region ile de france", None, None, "region bretagne", None, None,
)


def _identities(c: DataFrame) -> DataFrame:
    return c.sparkSession.createDataFrame(list(_IDENTITIES), "kind string, value string, key string")


def _name(c: Column) -> Column:
    return F.get(F.array(*map(F.lit, _NAMES)), (c % len(_NAMES)).cast("int"))


_KEY_SQL = "[" + ", ".join(f"'{k}'" if k else "NULL" for k in _KEYS) + "][{} % 10 + 1]"


@query("J02_territorial_keys", f"SELECT c_custkey, {_KEY_SQL.format('c_custkey')} AS key FROM customer", "customer")
def _j02(c: DataFrame) -> DataFrame:
    return X.territorial_keys(c.select("c_custkey", _name(F.col("c_custkey")).alias("name")), "name", _identities(c), "key").select("c_custkey", "key")


@query(
    "J03_effective_keys",
    f"SELECT c_custkey, coalesce({_KEY_SQL.format('c_custkey')}, {_KEY_SQL.format('c_nationkey')}, 'customer') AS key FROM customer",
    "customer",
)
def _j03(c: DataFrame) -> DataFrame:
    rows = c.select("c_custkey", _name(F.col("c_custkey")).alias("raw"), _name(F.col("c_nationkey")).alias("stored"))
    return X.effective_keys(rows, ["raw", "stored"], _identities(c), F.lit("customer"), "key").select("c_custkey", "key")
