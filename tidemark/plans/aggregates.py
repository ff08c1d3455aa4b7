"""Queries of aggregations, windows, ranks and pages (A-*, W-*, O-*, P-*, B-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import half_even, pct_change
from tidemark.operators import aggregate as A
from tidemark.plans.registry import query

_AS_OF = "2001-08-01"
_DAY = "CAST(o_orderdate AS DATE)"


def _day(o: DataFrame) -> DataFrame:
    return o.withColumn("day", F.to_date("o_orderdate"))


@query("A01_count_by_label", "SELECT coalesce(nullif(event_type, ''), 'Unknown') AS label, count(*) AS n FROM events GROUP BY 1", "events")
def _a01(e: DataFrame) -> DataFrame:
    return A.count_by(e, F.col("event_type"))


@query("A02_count_known", "SELECT lang AS label, count(*) AS n FROM documents WHERE lang IS NOT NULL AND lang <> '' GROUP BY 1", "documents")
def _a02(d: DataFrame) -> DataFrame:
    return A.count_by(d.filter("lang <> ''"), F.col("lang"))


@query(
    "A03_entropy",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
        p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c)
        SELECT user_id, CASE WHEN count(*) > 1 THEN round_even(-sum(p * log2(p)) / log2(count(*)), 3) ELSE 0.0 END AS entropy FROM p GROUP BY 1""",
    "events",
)
def _a03(e: DataFrame) -> DataFrame:
    return A.entropy(e, "event_type", "user_id")


@query("A04_distinct_sources", "SELECT user_id, count(DISTINCT event_type) AS sources FROM events GROUP BY 1", "events")
def _a04(e: DataFrame) -> DataFrame:
    return e.groupBy("user_id").agg(F.countDistinct("event_type").alias("sources"))


@query(
    "A05_coverage",
    """SELECT source, count(*) FILTER (lang <> 'es') AS known, count(*) FILTER (lang = 'es') AS unknown,
        round_even(100.0::DOUBLE * count(*) FILTER (lang <> 'es') / count(*), 1) AS pct FROM documents GROUP BY 1""",
    "documents",
)
def _a05(d: DataFrame) -> DataFrame:
    k = F.count_if(F.col("lang") != "es")
    return d.groupBy("source").agg(k.alias("known"), F.count_if(F.col("lang") == "es").alias("unknown"), half_even(100.0 * k / F.count(F.lit(1)), 1).alias("pct"))


@query(
    "A06_scope_metrics",
    """WITH o AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY 1)
        SELECT sum(n)::BIGINT AS items, count(*) AS organisations, count(*) FILTER (n > 1) AS repeated, count(*) FILTER (bad > 1) AS repeated_unknown,
        round_even(CAST(sum(bad) AS DOUBLE) / sum(n), 4) AS unknown_ratio FROM o""",
    "events",
)
def _a06(e: DataFrame) -> DataFrame:
    o = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("bad"))
    return o.agg(
        F.sum("n").alias("items"), F.count(F.lit(1)).alias("organisations"), F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(F.col("bad") > 1).alias("repeated_unknown"), half_even(F.sum("bad") / F.sum("n"), 4).alias("unknown_ratio"),
    )


@query(
    "A07_A09_coverage_rows",
    """WITH x AS (SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source, count(*) AS items,
        count(*) FILTER (lang IS NOT NULL AND lang <> '') AS lang, count(*) FILTER (f <> 'Unknown') AS size FROM
        (SELECT source, lang, CASE WHEN n_chars > 1000 THEN 'long' ELSE 'Unknown' END AS f FROM documents) GROUP BY GROUPING SETS ((), (source)))
        SELECT source, field, items, known, items - known AS unknown, round_even(100.0::DOUBLE * known / items, 1) AS coverage_pct
        FROM (UNPIVOT x ON lang, size INTO NAME field VALUE known)""",
    "documents",
)
def _a09(d: DataFrame) -> DataFrame:
    rows = d.select("source", "lang", F.when(F.col("n_chars") > 1000, "long").otherwise("Unknown").alias("size"))
    return A.unpivot_coverage(rows, "source", ["lang", "size"])


@query(
    "A10_decisions_by_origin",
    """SELECT o_orderpriority AS origin, count(*) FILTER (o_orderstatus = 'F') AS applied, count(*) FILTER (o_orderstatus = 'O') AS rejected,
        count(*) FILTER (o_orderstatus = 'P') AS pending FROM orders GROUP BY 1""",
    "orders",
)
def _a10(o: DataFrame) -> DataFrame:
    kinds = {"F": "applied", "O": "rejected", "P": "pending"}
    return o.groupBy(F.col("o_orderpriority").alias("origin")).agg(*[F.count_if(F.col("o_orderstatus") == k).alias(v) for k, v in kinds.items()])


@query(
    "A14_status_counts",
    """SELECT s.status, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) s(status) LEFT JOIN orders ON o_orderstatus = s.status GROUP BY 1""",
    "orders",
)
def _a14(o: DataFrame) -> DataFrame:
    every = o.sparkSession.createDataFrame([("F",), ("O",), ("P",), ("X",)], "status string")
    counts = o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(every).join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


@query("A15_overall_status", "SELECT bool_and(o_orderstatus = 'F') AND count(*) > 0 AS ok FROM orders", "orders")
def _a15(o: DataFrame) -> DataFrame:
    return o.agg((F.every(F.col("o_orderstatus") == "F") & (F.count(F.lit(1)) > 0)).alias("ok"))


@query(
    "A17_pair_count",
    """SELECT count(*) AS organisations, sum(n)::BIGINT AS items, sum(n * (n - 1) // 2)::BIGINT AS pairs FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""",
    "events",
)
def _a17(e: DataFrame) -> DataFrame:
    n = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.sum((F.col("n") * (F.col("n") - 1) / 2).cast("long"))
    return n.agg(F.count(F.lit(1)).alias("organisations"), F.sum("n").alias("items"), pairs.alias("pairs"))


@query(
    "A19_exposure",
    """WITH o AS (SELECT l_suppkey, l_orderkey, max(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
        l AS (SELECT l_suppkey, list_sort(list(v)) AS v FROM o GROUP BY 1)
        SELECT l_suppkey, CAST(len(v) AS BIGINT) AS documented, v[len(v) // 2 + 1] AS median, v[least(len(v) - 1, CAST(floor(len(v) * 0.9::DOUBLE) AS BIGINT)) + 1] AS p90,
        v[len(v)] AS largest FROM l""",
    "lineitem",
)
def _a19(li: DataFrame) -> DataFrame:
    o = li.groupBy("l_suppkey", "l_orderkey").agg(F.max("l_quantity").alias("v"))
    found = A.ordered_places(o, "l_suppkey", "v", median=0.5, p90=0.9)
    return found.select("l_suppkey", F.col("n").alias("documented"), "median", "p90", "largest")


@query(
    "A20_base_quality",
    f"""SELECT count(*) AS items, count(DISTINCT o_custkey) AS organisations, CAST(min({_DAY}) AS VARCHAR) AS first_day, CAST(max({_DAY}) AS VARCHAR) AS last_day,
        round_even(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'P') / count(*), 1) AS unknown_pct FROM orders""",
    "orders",
)
def _a20(o: DataFrame) -> DataFrame:
    return _day(o).agg(
        F.count(F.lit(1)).alias("items"), F.countDistinct("o_custkey").alias("organisations"), F.min("day").alias("first_day"),
        F.max("day").alias("last_day"), half_even(100.0 * F.count_if(F.col("o_orderstatus") == "P") / F.count(F.lit(1)), 1).alias("unknown_pct"),
    )


@query(
    "A21_focus_profile",
    """WITH f AS (SELECT n_regionkey IN (2, 3) AS focus, o_orderpriority AS label, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
        r AS (SELECT *, sum(n) OVER (PARTITION BY focus) AS total, row_number() OVER (PARTITION BY focus ORDER BY n DESC, label) AS rank FROM f)
        SELECT focus, label, n, rank, round_even(100.0::DOUBLE * n / total, 1) AS share, total >= 30 AND 100.0 * max(n) OVER (PARTITION BY focus) <= 60 * total AS reliable
        FROM r QUALIFY rank <= 4""",
    "orders", "customer", "nation",
)
def _a21(o: DataFrame, c: DataFrame, n: DataFrame) -> DataFrame:
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    counts = joined.groupBy(F.col("n_regionkey").isin(2, 3).alias("focus"), F.col("o_orderpriority").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("focus")
    counts = counts.withColumn("total", F.sum("n").over(w)).withColumn("top", F.max("n").over(w))
    ranked = A.top_labels(counts, 4, "focus")
    reliable = (F.col("total") >= 30) & (100.0 * F.col("top") <= 60 * F.col("total"))
    return ranked.select("focus", "label", "n", "rank", half_even(100.0 * F.col("n") / F.col("total"), 1).alias("share"), reliable.alias("reliable"))


@query(
    "A22_W08_monthly_series",
    f"""WITH e AS (SELECT max({_DAY}) AS hi, min({_DAY}) AS lo FROM orders),
        m AS (SELECT CAST(unnest(generate_series(greatest(date_trunc('month', lo), date_trunc('month', hi) - INTERVAL 35 MONTH), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS month FROM e)
        SELECT strftime(m.month, '%Y-%m') AS month, count(o_orderkey) AS total, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(DISTINCT o_custkey) AS sources
        FROM m LEFT JOIN orders ON date_trunc('month', o_orderdate) = m.month GROUP BY 1""",
    "orders",
)
def _a22(o: DataFrame) -> DataFrame:
    o = _day(o)
    spine = A.month_spine(o, "day")
    rows = F.broadcast(spine).join(o.withColumn("month", F.trunc("day", "month")), "month", "left")
    return rows.groupBy(F.date_format("month", "yyyy-MM").alias("month")).agg(
        F.count("o_orderkey").alias("total"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.countDistinct("o_custkey").alias("sources")
    )


@query(
    "A23_recurring",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, o_custkey LIMIT 10", "orders",
)
def _a23(o: DataFrame) -> DataFrame:
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").orderBy(F.desc("n"), "o_custkey").limit(10)


@query(
    "A30_divergence",
    """SELECT l_orderkey, count(DISTINCT l_shipdate) AS values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_shipdate) > 1""", "lineitem",
)
def _a30(li: DataFrame) -> DataFrame:
    return li.groupBy("l_orderkey").agg(F.countDistinct("l_shipdate").alias("values")).filter("values > 1")


@query("A31_duplicates", "SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT text, count(*) AS n FROM documents GROUP BY 1)", "documents")
def _a31(d: DataFrame) -> DataFrame:
    return d.groupBy(F.sha2("text", 256)).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("duplicates"))


@query(
    "A34_D06_majority",
    """WITH c AS (SELECT o_custkey, o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1, 2)
        SELECT o_custkey, label FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, label) = 1""",
    "orders",
)
def _d06(o: DataFrame) -> DataFrame:
    return A.majority(o.withColumnRenamed("o_orderpriority", "label"), "o_custkey", "label", "Unknown")


@query(
    "D07_strict_majority",
    """WITH c AS (SELECT o_custkey, o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1, 2),
        r AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY n DESC) AS r FROM c)
        SELECT o_custkey, CASE WHEN count(*) = 1 THEN min(label) ELSE 'Unknown' END AS label FROM r WHERE r = 1 GROUP BY 1""",
    "orders",
)
def _d07(o: DataFrame) -> DataFrame:
    return A.strict_mode(o.withColumnRenamed("o_orderpriority", "label"), "o_custkey", "label", "Unknown")


_WINDOWS = f"""WITH a AS (SELECT date_diff('day', {_DAY}, DATE '{_AS_OF}') AS age, o_orderpriority AS threat, o_orderstatus AS sector FROM orders),
    w AS (SELECT threat, sector, age, unnest([7, 30, 90, 365]) AS days FROM a WHERE age >= 0),
    v AS (SELECT * FROM w WHERE age < 2 * days)"""


@query(
    "W02_periods",
    _WINDOWS + """ SELECT CAST(days AS BIGINT) AS days, count(*) FILTER (age < days) AS current, count(*) FILTER (age >= days) AS previous,
        CASE WHEN count(*) FILTER (age >= days) = 0 THEN 100.0::DOUBLE ELSE round_even((count(*) FILTER (age < days) - count(*) FILTER (age >= days)) * 100.0::DOUBLE
        / count(*) FILTER (age >= days), 1) END AS change FROM v GROUP BY 1""",
    "orders",
)
def _w02(o: DataFrame) -> DataFrame:
    rows = A.period_counts(_day(o), "day", F.lit(_AS_OF).cast("date"), [7, 30, 90, 365])
    return rows.withColumn("change", pct_change(F.col("current"), F.col("previous")))


_SIGNALS = """a AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '{as_of}') AS age, {label} AS label, o_orderkey % 4 = 0 AS multi,
      CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS known FROM orders),
    w AS (SELECT label, multi, known, age, unnest([7, 30, 90, 365]) AS days FROM a WHERE age >= 0),
    g AS (SELECT days, label, count(*) FILTER (age < days) AS now, count(*) FILTER (age >= days) AS before, count(*) FILTER (age < days AND multi) AS multi,
      coalesce(sum(known) FILTER (age < days), 0) AS known FROM w WHERE age < 2 * days GROUP BY 1, 2),
    t AS (SELECT days, sum(now) AS total, sum(before) AS past FROM g GROUP BY 1),
    s AS (SELECT *, now - before AS delta, CASE WHEN before = 0 THEN 100.0::DOUBLE ELSE round_even((now - before) * 100.0::DOUBLE / before, 1) END AS change,
      round_even(now * 100.0::DOUBLE / nullif(total, 0), 1) AS share, CASE WHEN past >= 10 AND total >= 20 THEN round_even((total - past) * 100.0::DOUBLE / past, 1) END AS base_rate,
      CASE WHEN before = 0 THEN 'emerging' ELSE 'acceleration' END AS kind,
      CAST(round_even(100 * (0.55::DOUBLE * least(1.0::DOUBLE, now / 12.0::DOUBLE) + 0.25::DOUBLE * coalesce(round_even(multi * 1.0::DOUBLE / nullif(now, 0), 4), 0) + 0.20::DOUBLE * known / nullif(now * 2, 0)), 0) AS BIGINT) AS score
      FROM g JOIN t USING (days) WHERE label NOT IN ('', '{unknown}'))
    SELECT CAST(days AS BIGINT) AS days, label, kind, now, before, delta, change, share, base_rate, round_even(change - base_rate, 1) AS excess, score FROM s
    WHERE now >= 3 AND delta >= 2 AND (before = 0 OR change >= 50) AND (base_rate IS NULL OR (share <= 60 AND round_even(change - base_rate, 1) >= 25))"""


def _signals(o: DataFrame, label: Column, unknown: str, as_of: str = _AS_OF) -> DataFrame:
    from tidemark.operators.trends import dimension_signals

    known_fields = F.when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return dimension_signals(
        _day(o).withColumn("label", label), "day", F.lit(as_of).cast("date"), [7, 30, 90, 365], "label", multi=F.col("o_orderkey") % 4 == 0, known_fields=known_fields, fields=2, unknown=unknown,
    )


@query("P03_signals", "WITH " + _SIGNALS.format(label="o_orderpriority", as_of=_AS_OF, unknown="4-NOT SPECIFIED"), "orders")
def _p03(o: DataFrame) -> DataFrame:
    return _signals(o, F.col("o_orderpriority"), "4-NOT SPECIFIED")


@query("P03_customer_signals", "WITH " + _SIGNALS.format(label="(o_custkey % 97)::VARCHAR", as_of="1996-08-01", unknown="5"), "orders")
def _p03_customers(o: DataFrame) -> DataFrame:
    """Many small labels, in the midst of the orders' days."""
    return _signals(o, (F.col("o_custkey") % 97).cast("string"), "5", "1996-08-01")


@query(
    "P04_U05_new_pairs",
    _WINDOWS + """ SELECT CAST(days AS BIGINT) AS days, threat, sector, count(*) AS now FROM v GROUP BY 1, 2, 3
        HAVING count(*) FILTER (age < days) >= 3 AND count(*) FILTER (age >= days) = 0""",
    "orders",
)
def _p04(o: DataFrame) -> DataFrame:
    from tidemark.operators.trends import new_pairs

    rows = _day(o).withColumnRenamed("o_orderpriority", "threat").withColumnRenamed("o_orderstatus", "sector")
    return new_pairs(rows, "day", F.lit(_AS_OF).cast("date"), [7, 30, 90, 365], "threat", "sector")


@query(
    "P01_confidence",
    """WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type IN ('view', 'click')) AS multi, count(*) FILTER (event_type <> 'error') AS known FROM events GROUP BY 1),
        s AS (SELECT user_id, CAST(round_even(100 * (0.55::DOUBLE * least(1.0::DOUBLE, n / 12.0::DOUBLE) + 0.25::DOUBLE * round_even(multi * 1.0::DOUBLE / n, 4) + 0.20::DOUBLE * known / n), 0) AS BIGINT) AS score FROM u)
        SELECT user_id, score, CASE WHEN score >= 75 THEN 'high' WHEN score >= 50 THEN 'medium' ELSE 'low' END AS band FROM s""",
    "events",
)
def _p01(e: DataFrame) -> DataFrame:
    from tidemark.operators.trends import confidence

    u = e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type").isin("view", "click")).alias("multi"), F.count_if(F.col("event_type") != "error").alias("known")
    )
    score = confidence(F.col("n"), F.col("multi"), F.col("known"), F.col("n"))
    return u.select("user_id", score.alias("score"), F.when(score >= 75, "high").when(score >= 50, "medium").otherwise("low").alias("band"))


@query(
    "P02_base_rate",
    _WINDOWS + """, g AS (SELECT days, count(*) FILTER (age < days) AS now, count(*) FILTER (age >= days) AS before FROM v GROUP BY 1)
        SELECT CAST(days AS BIGINT) AS days, CASE WHEN before >= 10 AND now >= 20 THEN round_even((now - before) * 100.0::DOUBLE / before, 1) END AS base_rate FROM g""",
    "orders",
)
def _p02(o: DataFrame) -> DataFrame:
    from tidemark.operators.trends import base_rate

    rows = A.period_counts(_day(o), "day", F.lit(_AS_OF).cast("date"), [7, 30, 90, 365])
    return rows.select("days", base_rate(F.col("current"), F.col("previous")).alias("base_rate"))


@query(
    "W03_last_runs",
    f"SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_DAY} DESC, o_orderkey DESC) <= 3", "orders",
)
def _w03(o: DataFrame) -> DataFrame:
    return A.last_n(_day(o), "o_custkey", ["day", "o_orderkey"], 3).select("o_custkey", "o_orderkey")


@query(
    "W04_W05_gaps",
    f"""WITH d AS (SELECT DISTINCT o_custkey, {_DAY} AS day FROM orders),
        g AS (SELECT o_custkey, day, date_diff('day', lag(day) OVER (PARTITION BY o_custkey ORDER BY day), day) AS gap FROM d),
        l AS (SELECT o_custkey, list_sort(list(gap) FILTER (gap IS NOT NULL)) AS g, max(day) AS last FROM g GROUP BY 1)
        SELECT o_custkey, g[len(g) // 2 + 1] AS median_gap, g[len(g)] AS max_gap, date_diff('day', last, DATE '{_AS_OF}') > g[len(g)] AS unusual FROM l WHERE len(g) > 0""",
    "orders",
)
def _w04(o: DataFrame) -> DataFrame:
    o = _day(o)
    last = o.groupBy("o_custkey").agg(F.max("day").alias("last"))
    since = F.datediff(F.lit(_AS_OF).cast("date"), F.col("last"))
    return A.gaps(o, "o_custkey", "day").join(last, "o_custkey").select("o_custkey", "median_gap", "max_gap", (since > F.col("max_gap")).alias("unusual"))


@query(
    "W06_drift",
    """WITH h AS (SELECT event_type, CAST(ts AS DATE) AS day, 100.0::DOUBLE * count(*) FILTER (value > 50) / count(*) AS coverage FROM events GROUP BY 1, 2),
        w AS (SELECT *, round_even(avg(coverage) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 4) AS baseline FROM h)
        SELECT event_type, CAST(day AS VARCHAR) AS day, coverage, baseline, coalesce(baseline - coverage >= 2.0, false) AS drifted FROM w""",
    "events",
)
def _w06(e: DataFrame) -> DataFrame:
    h = e.groupBy("event_type", F.to_date("ts").alias("day")).agg((100.0 * F.count_if(F.col("value") > 50) / F.count(F.lit(1))).alias("coverage"))
    return A.drift(h, "event_type", "day", "coverage")


@query(
    "W07_W10_latest",
    "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1", "events",
)
def _w07(e: DataFrame) -> DataFrame:
    return A.latest(e.select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "W11_W12_round_robin",
    """SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS turn FROM documents
        ORDER BY turn, source LIMIT 60""",
    "documents",
)
def _w11(d: DataFrame) -> DataFrame:
    return A.round_robin(d.select("doc_id", "source"), "source", "doc_id", 60)


@query(
    "O01_O02_canonical_order",
    """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC, user_id, event_id) AS place FROM events""", "events",
)
def _o01(e: DataFrame) -> DataFrame:
    w = Window.partitionBy("event_type").orderBy(F.to_date("ts").desc_nulls_last(), "user_id", "event_id")
    return e.select("event_id", F.row_number().over(w).cast("long").alias("place"))


@query(
    "O04_ranked_signals",
    """WITH c AS (SELECT o_orderpriority AS label, o_orderstatus AS kind, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2, 3),
        k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY kind, label ORDER BY n DESC, y) = 1)
        SELECT label, kind, y AS year, n FROM k ORDER BY n DESC, kind, label LIMIT 10""",
    "orders",
)
def _o04(o: DataFrame) -> DataFrame:
    c = o.groupBy(F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("kind"), F.year("o_orderdate").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    first = Window.partitionBy("kind", "label").orderBy(F.desc("n"), "year")
    return c.withColumn("r", F.row_number().over(first)).filter("r = 1").drop("r").orderBy(F.desc("n"), "kind", "label").limit(10)


@query(
    "O07_queue_order",
    """WITH q AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS unknown FROM events GROUP BY 1)
        SELECT user_id, unknown, row_number() OVER (ORDER BY unknown DESC, user_id) AS priority FROM q""",
    "events",
)
def _o07(e: DataFrame) -> DataFrame:
    q = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("unknown"))
    return A.numbered(q, [F.desc("unknown"), F.col("user_id")], "priority")


@query("O08_O09_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50", "orders")
def _o09(o: DataFrame) -> DataFrame:
    return A.page(o.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 3, 25)


@query(
    "O10_evidence_ids",
    """WITH x AS (SELECT user_id, list_sort(list(DISTINCT event_id)) AS ids FROM events GROUP BY 1)
        SELECT user_id, array_to_string(ids[1:12], ',') AS ids FROM x""",
    "events",
)
def _o10(e: DataFrame) -> DataFrame:
    ids = A.first_ids(e, "user_id", "event_id")
    return ids.select("user_id", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query(
    "O12_severity",
    """SELECT event_type, rank, count(*) AS n FROM events JOIN (VALUES ('error', 4), ('purchase', 3), ('signup', 2), ('click', 1), ('view', 0)) d(kind, rank)
        ON kind = event_type GROUP BY 1, 2""",
    "events",
)
def _o12(e: DataFrame) -> DataFrame:
    ranks = e.sparkSession.createDataFrame([("error", 4), ("purchase", 3), ("signup", 2), ("click", 1), ("view", 0)], "event_type string, rank int")
    return e.join(F.broadcast(ranks), "event_type").groupBy("event_type", "rank").agg(F.count(F.lit(1)).alias("n"))


@query("O13_bounded_history", f"SELECT o_orderkey FROM orders ORDER BY {_DAY} DESC, o_orderkey DESC LIMIT 60", "orders")
def _o13(o: DataFrame) -> DataFrame:
    return _day(o).orderBy(F.desc("day"), F.desc("o_orderkey")).limit(60).select("o_orderkey")


@query(
    "B01_faceted_search",
    """SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'tion') AND lang IN ('en', 'fr') AND source = 'src3' AND n_chars BETWEEN 200 AND 5000""",
    "documents",
)
def _b01(d: DataFrame) -> DataFrame:
    from tidemark.operators.search import faceted

    return faceted(d, text=("text", "tion"), one_of={"lang": ["en", "fr"], "source": ["src3"]}, between={"n_chars": (200, 5000)}).select("doc_id")


@query("B02_facet_values", "SELECT DISTINCT o_orderpriority AS value FROM orders", "orders")
def _b02(o: DataFrame) -> DataFrame:
    return o.select(F.col("o_orderpriority").alias("value")).distinct()


@query(
    "B03_period_cutoff",
    f"SELECT count(*) AS n FROM orders WHERE {_DAY} >= DATE '{_AS_OF}' - INTERVAL 90 DAY", "orders",
)
def _b03(o: DataFrame) -> DataFrame:
    return _day(o).filter(F.col("day") >= F.date_sub(F.lit(_AS_OF).cast("date"), 90)).agg(F.count(F.lit(1)).alias("n"))


@query(
    "B04_bar_scaling",
    """WITH c AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1)
        SELECT label, n, greatest(2, CAST(round_even(100.0::DOUBLE * n / max(n) OVER (), 0) AS BIGINT)) AS width FROM c""",
    "events",
)
def _b04(e: DataFrame) -> DataFrame:
    c = A.count_by(e, F.col("event_type"))
    top = c.agg(F.max("n").alias("top"))
    width = F.greatest(F.lit(2), half_even(100.0 * F.col("n") / F.col("top"), 0).cast("long"))
    return c.join(F.broadcast(top)).select("label", "n", width.alias("width"))


@query(
    "B06_organisation_card",
    f"""SELECT o_custkey, count(*) AS n, CAST(min({_DAY}) AS VARCHAR) AS first_day, CAST(max({_DAY}) AS VARCHAR) AS last_day, count(DISTINCT o_orderpriority) AS sources
        FROM orders GROUP BY 1""",
    "orders",
)
def _b06(o: DataFrame) -> DataFrame:
    return _day(o).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.countDistinct("o_orderpriority").alias("sources")
    )
