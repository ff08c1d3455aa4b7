"""Queries of entity keys, joins, set operations and repairs (T-06, J-*, U-*, D-*, Q-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import entities as E
from tidemark.plans.registry import query


@query(
    "T06_J01_organisation_key",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'group ' || (c_custkey % 10) ELSE lower(c_name) END AS key FROM customer""", "customer",
)
def _t06(c: DataFrame) -> DataFrame:
    rows = c.select("c_custkey", F.lower("c_name").alias("base"))
    canonical = F.concat(F.lit("group "), (F.col("c_custkey") % 10).cast("string"))
    aliases = rows.filter("c_custkey % 3 = 0").select(F.col("base").alias("alias"), canonical.alias("canonical"))
    return E.organisation_key(rows, aliases, "base").select("c_custkey", "key")


@query(
    "J05_latest_match",
    """WITH r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events)
        SELECT c_custkey, CASE WHEN event_type = 'purchase' THEN value END AS value FROM customer LEFT JOIN r ON user_id = c_custkey AND k = 1""",
    "customer", "events",
)
def _j05(c: DataFrame, e: DataFrame) -> DataFrame:
    cache = e.select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("status"), "value", "ts", "event_id")
    return E.latest_match(c.select("c_custkey"), cache, "c_custkey", ["ts", "event_id"], matched="purchase")


@query(
    "J06_rolled_up",
    """SELECT o_custkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey, l_linenumber) AS parts FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "orders", "lineitem",
)
def _j06(o: DataFrame, li: DataFrame) -> DataFrame:
    facts = li.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber")
    rows = E.rolled_up(o, facts, "o_orderkey", "o_custkey", F.struct("l_partkey", "l_linenumber"))
    return rows.select("o_custkey", F.array_join(F.transform("facts", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"))


@query(
    "J15_last_of_entity",
    """WITH r AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) AS k FROM orders)
        SELECT c_custkey, CAST(day AS VARCHAR) AS day, o_orderkey FROM customer LEFT JOIN r ON o_custkey = c_custkey AND k = 1""",
    "customer", "orders",
)
def _j15(c: DataFrame, o: DataFrame) -> DataFrame:
    rows = o.select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return E.last_of_entity(c.select("c_custkey"), rows, "c_custkey", "day", "o_orderkey")


@query("J16_latest_run", "SELECT event_id FROM events WHERE event_type = (SELECT event_type FROM events ORDER BY ts DESC, event_type DESC LIMIT 1)", "events")
def _j16(e: DataFrame) -> DataFrame:
    return E.only_latest_run(e, e, "event_type", "ts").select("event_id")


@query("J17_missing_keys", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')", "customer", "orders")
def _j17(c: DataFrame, o: DataFrame) -> DataFrame:
    return E.missing_keys(c, o.filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query(
    "J20_J23_best_scored",
    """WITH s AS (SELECT l_orderkey, l_linenumber, 10 * CAST(l_returnflag = 'R' AS INTEGER) + 3 * CAST(l_linestatus = 'F' AS INTEGER) + 3 * CAST(l_quantity > 25 AS INTEGER)
        + 4 * CAST(l_discount > 0.05 AS INTEGER) AS score FROM lineitem)
        SELECT l_orderkey, l_linenumber, score FROM s QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber) = 1""",
    "lineitem",
)
def _j23(li: DataFrame) -> DataFrame:
    tests = [(F.col("l_returnflag") == "R", 10), (F.col("l_linestatus") == "F", 3), (F.col("l_quantity") > 25, 3), (F.col("l_discount") > 0.05, 4)]
    return E.best_scored(li, "l_orderkey", "l_linenumber", tests).select("l_orderkey", "l_linenumber", "score")


@query(
    "J21_anchored",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 4 <> 0", "orders", "customer",
)
def _j21(o: DataFrame, c: DataFrame) -> DataFrame:
    registry = c.select(F.col("c_custkey").alias("anchor"), "c_name", F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey") + 1).alias("redirect"))
    return E.anchored(o.select("o_orderkey", F.col("o_custkey").alias("anchor")), registry, "anchor", "redirect").select("o_orderkey", "c_name")


@query(
    "J24_lone_collisions",
    """WITH r AS (SELECT p_partkey, p_size * 100 + p_partkey % 37 AS id, p_name FROM part), w AS (SELECT DISTINCT id, p_partkey, unnest(string_split(p_name, ' ')) AS w FROM r),
        s AS (SELECT id, w FROM w GROUP BY ALL HAVING count(*) > 1), k AS (SELECT DISTINCT p_partkey FROM w JOIN s USING (id, w)), n AS (SELECT id, count(*) AS n FROM r GROUP BY 1)
        SELECT p_partkey, n > 1 AND p_partkey % 2 = 0 AND p_partkey NOT IN (SELECT p_partkey FROM k) AS rejected FROM r JOIN n USING (id)""",
    "part",
)
def _j24(p: DataFrame) -> DataFrame:
    rows = p.select("p_partkey", (F.col("p_size") * 100 + F.col("p_partkey") % 37).alias("id"), "p_name")
    return E.lone_collisions(rows, "id", "p_partkey", F.split("p_name", " "), F.col("p_partkey") % 2 == 0).select("p_partkey", "rejected")


@query("U01_U02_exact_union", "SELECT source, lang FROM documents UNION SELECT source, NULL FROM documents", "documents")
def _u02(d: DataFrame) -> DataFrame:
    return E.exact_union(d.select("source", "lang"), d.select("source"))


@query(
    "U04_label_union",
    """WITH b AS (SELECT event_type, count(*) AS n FROM events WHERE value < 30 AND event_type <> 'view' GROUP BY 1), a AS (SELECT event_type, count(*) AS n FROM events WHERE value >= 30
        AND event_type <> 'click' GROUP BY 1) SELECT event_type, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS after FROM b FULL JOIN a USING (event_type)""",
    "events",
)
def _u04(e: DataFrame) -> DataFrame:
    before = e.filter("value < 30 AND event_type <> 'view'").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    after = e.filter("value >= 30 AND event_type <> 'click'").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return E.label_union(before, after, "event_type")


@query(
    "U06_id_overlap",
    """SELECT count(*) FILTER (a AND b) AS common, count(*) FILTER (b AND NOT a) AS removed, count(*) FILTER (a AND NOT b) AS added
        FROM (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS b, bool_or(o_orderstatus = 'O') AS a FROM orders GROUP BY 1)""",
    "orders",
)
def _u06(o: DataFrame) -> DataFrame:
    return E.id_overlap(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"), "o_custkey")


@query(
    "U07_array_algebra",
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS a, [lower(p_type), string_split(p_name, ' ')[1]] AS b FROM part)
        SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(a, lambda x: list_contains(b, x)))), ',') AS common,
        array_to_string(list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x)))), ',') AS only_a,
        array_to_string(list_sort(list_distinct(list_filter(b, lambda x: NOT list_contains(a, x)))), ',') AS only_b FROM w""",
    "part",
)
def _u07(p: DataFrame) -> DataFrame:
    words = F.split("p_name", " ")
    rows = p.select("p_partkey", E.array_algebra(words, F.array(F.lower("p_type"), F.get(words, 0))).alias("s"))
    return rows.select("p_partkey", *[F.array_join(f"s.{c}", ",").alias(c) for c in ("common", "only_a", "only_b")])


@query(
    "U08_D19_merged_claims",
    """SELECT user_id, arg_min(event_id, (CASE event_type WHEN 'purchase' THEN 0 WHEN 'error' THEN 1 ELSE 2 END, event_type, event_id)) AS event_id,
        string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS sources FROM events GROUP BY 1""",
    "events",
)
def _u08(e: DataFrame) -> DataFrame:
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "error", 1).otherwise(2)
    merged = E.merged_claims(e.select("user_id", "event_type", "event_id"), ["user_id"], "event_type", rank)
    return merged.select("user_id", "event_id", F.array_join("sources", ",").alias("sources"))


@query(
    "D08_preferred_majority",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n, count(*) FILTER (value > 60) AS p FROM events GROUP BY ALL)
        SELECT user_id, event_type FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY p DESC, CASE WHEN p > 0 THEN 0 ELSE n END DESC, event_type) = 1""",
    "events",
)
def _d08(e: DataFrame) -> DataFrame:
    return E.preferred_majority(e, "user_id", "event_type", F.col("value") > 60)


@query(
    "D13_stable_ids",
    """WITH g AS (SELECT l_orderkey AS grp, l_partkey AS item FROM lineitem GROUP BY ALL), r AS (SELECT p_partkey AS item, 'old' || (p_partkey % 50) AS id FROM part WHERE p_partkey % 3 <> 0),
        h AS (SELECT grp, id, count(*) AS n FROM g JOIN r USING (item) GROUP BY ALL), b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, grp) = 1),
        k AS (SELECT grp, arg_min(id, (-n, id)) AS id FROM b GROUP BY 1), f AS (SELECT grp, min(item) AS first FROM g GROUP BY 1)
        SELECT grp, coalesce(id, 'new:' || first) AS id FROM f LEFT JOIN k USING (grp)""",
    "lineitem", "part",
)
def _d13(li: DataFrame, p: DataFrame) -> DataFrame:
    groups = li.select(F.col("l_orderkey").alias("grp"), F.col("l_partkey").alias("item")).distinct()
    registry = p.filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("item"), F.concat(F.lit("old"), (F.col("p_partkey") % 50).cast("string")).alias("id"))
    return E.stable_ids(groups, registry, "grp", "item", "id")


@query(
    "D16_D17_registry_faults",
    """WITH r AS (SELECT o_custkey % 400 AS id, o_orderkey AS anchor, CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 700 END AS redirect FROM orders),
        i AS (SELECT l_orderkey AS anchor FROM lineitem WHERE l_orderkey % 10 <> 0)
        SELECT id, 'DUPLICATE_ID' AS fault FROM r GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT id, 'ORPHAN_ANCHOR' FROM r WHERE redirect IS NULL AND anchor NOT IN (SELECT anchor FROM i)
        UNION ALL SELECT id, 'SELF_REDIRECT' FROM r WHERE redirect = id UNION ALL SELECT id, 'LOST_REDIRECT' FROM r WHERE redirect IS NOT NULL AND redirect NOT IN (SELECT id FROM r)""",
    "orders", "lineitem",
)
def _d16(o: DataFrame, li: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    registry = o.select((F.col("o_custkey") % 400).alias("id"), key.alias("anchor"), F.when(key % 9 == 0, key % 700).alias("redirect"))
    return E.registry_faults(registry, li.filter("l_orderkey % 10 <> 0").select(F.col("l_orderkey").alias("anchor")), "id", "anchor", "redirect")


_STEP = "SELECT c_custkey, c_mktsegment, c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN 'OTHER' ELSE c_mktsegment END AS s2, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS n2 FROM customer"


@query(
    "Q02_mutations",
    f"""WITH s AS ({_STEP}) SELECT c_custkey, 'c_mktsegment' AS field, coalesce(c_mktsegment, '') AS previous, coalesce(s2, '') AS value, 'RULE' AS origin, 'APPLIED' AS decision
        FROM s WHERE coalesce(c_mktsegment, '') <> coalesce(s2, '') UNION ALL SELECT c_custkey, 'c_nationkey', coalesce(CAST(c_nationkey AS VARCHAR), ''),
        coalesce(CAST(n2 AS VARCHAR), ''), 'RULE', 'APPLIED' FROM s WHERE coalesce(CAST(c_nationkey AS VARCHAR), '') <> coalesce(CAST(n2 AS VARCHAR), '')""",
    "customer",
)
def _q02(c: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    changed = {"c_mktsegment": F.when(key % 5 == 0, "OTHER").otherwise(F.col("c_mktsegment")), "c_nationkey": F.when(key % 7 != 0, F.col("c_nationkey"))}
    return E.mutations(c, c.withColumns(changed), "c_custkey", ["c_mktsegment", "c_nationkey"], "RULE")


@query(
    "Q07_guarded_registry",
    """WITH r AS (SELECT c_custkey, 'AUTO' AS status, c_mktsegment AS label, c_custkey % 2 = 0 AND c_mktsegment <> 'OTHER' AS several, CASE WHEN c_custkey % 6 = 0 THEN 'OFFICIAL' END AS strong FROM customer)
        SELECT c_custkey, CASE WHEN several AND strong IS NULL THEN 'CONFLICT' WHEN several THEN 'AUTO' ELSE status END AS status,
        CASE WHEN several AND strong IS NULL THEN NULL WHEN several THEN strong ELSE label END AS label FROM r""",
    "customer",
)
def _q07(c: DataFrame) -> DataFrame:
    rows = c.select("c_custkey", F.lit("AUTO").alias("status"), F.col("c_mktsegment").alias("label"))
    candidates = F.array("label", F.when(F.col("c_custkey") % 2 == 0, "OTHER"))
    return E.guarded_registry(rows, candidates, F.when(F.col("c_custkey") % 6 == 0, "OFFICIAL"))


_ITEMS = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Unknown' ELSE o_orderstatus END AS label FROM orders"


@query(
    "Q08_applied_registry",
    f"""SELECT o_orderkey, CASE WHEN i.label = 'Unknown' AND c_custkey IS NOT NULL THEN c_mktsegment ELSE i.label END AS label, i.label = 'Unknown' AND c_custkey IS NOT NULL AS applied
        FROM ({_ITEMS}) AS i LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0""",
    "orders", "customer",
)
def _q08(o: DataFrame, c: DataFrame) -> DataFrame:
    items = o.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, "Unknown").otherwise(F.col("o_orderstatus")).alias("label"))
    registry = c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"), F.when(F.col("c_custkey") % 2 == 0, "AUTO").otherwise("REVIEW").alias("status"))
    return E.applied_registry(items, registry, "o_custkey", "label", "Unknown").select("o_orderkey", "label", "applied")


@query("Q15_Q16_restored", "SELECT c_custkey, c_mktsegment FROM customer", "customer")
def _q16(c: DataFrame) -> DataFrame:
    after = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "OTHER").otherwise(F.col("c_mktsegment")))
    decisions = E.mutations(c, after, "c_custkey", ["c_mktsegment"], "FALLBACK")
    return E.restored(after, decisions, "c_custkey", "c_mktsegment", "FALLBACK").select("c_custkey", "c_mktsegment")


@query(
    "Q11_single_valued",
    "SELECT o_custkey, min(o_orderpriority) AS o_orderpriority FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '' GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 1",
    "orders",
)
def _q11(o: DataFrame) -> DataFrame:
    return E.single_valued(o.filter("o_orderstatus = 'O'"), "o_custkey", "o_orderpriority")
