"""The audit of merges (J-13): orders as observations of their customers under five spellings of the name, from three sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import audit as A
from tidemark.operators import dedup as D
from tidemark.plans.registry import query

_RULES = D.MergeRules()
_SPELLINGS = 5


def _spelled(k: Column, n: Column) -> Column:
    """Words, no space, other order, one word more, and the words alone under another number."""
    name = F.concat(F.lit("user "), k.cast("string"))
    turned, glued = F.concat(k.cast("string"), F.lit(" user")), F.concat(F.lit("user"), k.cast("string"))
    return F.when(n == 1, glued).when(n == 2, turned).when(n == 3, F.concat(name, F.lit(" north"))).otherwise(name)


def _observed(o: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.floor(F.col("o_custkey") / 20).cast("long")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return D.observations(
        o, key=_spelled(c, k % _SPELLINGS), id=F.lpad(k.cast("string"), 12, "0"), source=F.concat(F.lit("s"), (k % 3).cast("string")),
        native=F.when(k % 7 == 0, F.concat(F.lit("n"), k.cast("string"))), published=day,
        url=F.when(k % 4 == 0, F.concat(F.lit("u"), c.cast("string"))), recurs=k % 17 == 0,
    )


_CLASS = "key, source, named, day, recurs"


_PAIRS = f"""i AS (
      SELECT lpad(o_orderkey::VARCHAR, 12, '0') AS id, (o_custkey // 20)::VARCHAR AS c, 's' || (o_orderkey % 3) AS source, o_orderkey % 7 = 0 AS named,
        o_orderdate::DATE AS day, CASE WHEN o_orderkey % 4 = 0 THEN 'u' || (o_custkey // 20) ELSE '' END AS url, o_orderkey % 17 = 0 AS recurs,
        CASE o_orderkey % {_SPELLINGS} WHEN 1 THEN 'user' || (o_custkey // 20) WHEN 2 THEN (o_custkey // 20) || ' user'
          WHEN 3 THEN 'user ' || (o_custkey // 20) || ' north' ELSE 'user ' || (o_custkey // 20) END AS key FROM orders),
    m AS (SELECT *, min(id) OVER (PARTITION BY {_CLASS}) AS cls, string_split(key, ' ') AS w FROM i),
    p AS (
      SELECT a.cls AS l, b.cls AS r, a.source = b.source AS one_source, a.named AND b.named AS natives, (b.day - a.day)::INT AS gap, b.recurs AS later,
        a.key AS k, b.key AS j, a.w AS v, b.w AS w, a.source = b.source AND a.url <> '' AND a.url = b.url AS one_url,
        CASE WHEN a.c::INT % 3 = 0 AND a.c = b.c THEN a.c ELSE '' END AS company
      FROM m AS a JOIN m AS b ON b.day >= a.day AND b.day <= a.day + 14 AND a.id <> b.id
        AND (a.day < b.day OR (a.day = b.day AND (a.source < b.source OR (a.source = b.source AND (a.cls < b.cls OR (a.cls = b.cls AND a.id < b.id))))))),
    q AS (SELECT *, CASE WHEN len(v) <= len(w) THEN v ELSE w END AS few, CASE WHEN len(v) <= len(w) THEN w ELSE v END AS many FROM p
      WHERE NOT (one_source AND natives) AND NOT (gap > 0 AND later)),
    s AS (SELECT *, CASE WHEN company <> '' THEN '{A.COMPANY}' WHEN one_source THEN NULL
        WHEN len(few) < len(many) AND len(list_filter(range(1, len(many) - len(few) + 2), lambda i: many[i:i + len(few) - 1] = few)) > 0 THEN '{A.CONTAINMENT}'
        WHEN len(few) < len(many) AND array_to_string(few, '') = array_to_string(many, '') THEN '{A.CONCATENATION}'
        WHEN len(few) = len(many) AND len(few) > 1 AND list_sort(few) = list_sort(many) THEN '{A.PERMUTATION}' END AS reason FROM q WHERE k <> j),
    o AS (SELECT '{A.MISSED}' AS risk, reason, l, r, gap, company FROM s WHERE reason IS NOT NULL
      UNION ALL SELECT '{A.FALSE}', 'CANONICAL_NAME', l, r, gap, '' FROM q WHERE k = j AND gap <= 3 AND NOT one_url),
    g AS (SELECT risk, reason, l AS left_id, r AS right_id, gap AS days_apart, company, count(*) AS pairs FROM o GROUP BY ALL)"""


@query("J13_audit_pairs", f"WITH {_PAIRS} SELECT * FROM g", "orders")
def _j13(o: DataFrame) -> DataFrame:
    return _j13_pairs(o)


def _j13_pairs(o: DataFrame) -> DataFrame:
    c = F.floor(F.col("o_custkey") / 20).cast("long")
    owned = o.filter(c % 3 == 0).select(c.alias("c")).distinct()
    spelled = F.explode(F.array(*[_spelled(F.col("c"), F.lit(n)) for n in range(_SPELLINGS)]))
    companies = owned.select(spelled.alias("key"), F.col("c").cast("string").alias("company")).distinct()
    return A.audit_pairs(_observed(o), _RULES, companies)


@query(
    "O05_review_queue",
    f"""WITH {_PAIRS} SELECT risk, reason, left_id, right_id, pairs, CASE WHEN risk = '{A.FALSE}' THEN 90 + least(days_apart, 9) WHEN reason = '{A.COMPANY}' THEN 70
        ELSE 50 + least(days_apart, 9) END AS priority FROM g""",
    "orders",
)
def _o05(o: DataFrame) -> DataFrame:
    return A.review_queue(_j13_pairs(o)).drop("days_apart", "company")


@query(
    "O05_review_priority",
    f"""WITH p AS (SELECT event_id, user_id % 15 AS days, CASE event_type WHEN 'error' THEN 'CANONICAL_NAME' WHEN 'signup' THEN 'SHARED_COMPANY_ID' WHEN 'view' THEN 'CLAIM_REPORTED' ELSE 'PERMUTATION' END AS reason,
          event_type IN ('error', 'view') AS merged FROM events)
        SELECT event_id, CASE WHEN merged AND reason = 'CLAIM_REPORTED' THEN 100 WHEN merged THEN 90 + least(days, 9) WHEN reason = '{A.COMPANY}' THEN 70 ELSE 50 + least(days, 9) END AS priority FROM p""",
    "events",
)
def _o05_priority(e: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    reason = F.when(kind == "error", "CANONICAL_NAME").when(kind == "signup", A.COMPANY).when(kind == "view", "CLAIM_REPORTED").otherwise(A.PERMUTATION)
    risk = F.when(kind.isin("error", "view"), A.FALSE).otherwise(A.MISSED)
    return e.select("event_id", A.review_priority(risk, reason, F.col("user_id") % 15).alias("priority"))
