"""Queries of counts, claims, summaries, the source scorecard and stable references (N-06, N-08, N-12, A-12, J-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import facts as X
from tidemark.operators import relate as R
from tidemark.operators import scorecard as S
from tidemark.plans.registry import query

_RANKED = "CASE source WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 9 END"


def _rank(source: Column) -> Column:
    return F.when(source == "purchase", 0).when(source == "signup", 1).otherwise(9)


def _counts(e: DataFrame) -> DataFrame:
    """Events as facts of their users: every third tells a count of records, every fourth one of people, every fifth an old count."""
    k = F.col("event_id")
    scope = F.when(k % 7 < 3, "Total").when(k % 7 < 5, "après déduplication").when(k % 7 == 5, "x")

    def record(value: Column, unit: str, kind: Column, scope: Column, status: str) -> Column:
        raw = F.lit(None).cast("string")
        return F.struct(value.cast("string").alias("value"), raw.alias("raw"), F.lit(unit).alias("unit"), kind.alias("kind"), scope.alias("scope"), F.lit(status).alias("status"))

    none = F.lit(None).cast("string")
    told = F.array_compact(F.array(F.when(k % 3 == 0, record(k % 11, "Records", none, scope, "claimed")), F.when(k % 4 == 0, record(k % 13, "people", scope, none, "Reported"))))
    old = F.when(k % 5 < 2, k % 11)
    unit = F.when(k % 2 == 0, "records").otherwise("people")
    return e.select(
        "user_id", F.col("event_type").alias("source"), F.lpad(k.cast("string"), 12, "0").alias("item"), told.alias("records"), old.cast("string").alias("affected_count"),
        F.lit("").alias("affected_raw"), unit.alias("affected_unit"), F.lit("odd").alias("claim_status"),
    )


_SEMANTIC = "CASE WHEN k % 7 < 3 THEN 'total' WHEN k % 7 < 5 THEN 'unique' WHEN k % 7 = 5 THEN 'x' ELSE 'unspecified' END"
_COUNTED = f"""b AS (SELECT user_id, event_type AS source, event_id AS k, lpad(event_id::VARCHAR, 12, '0') AS item FROM events),
    a AS (SELECT user_id, source, item, 0 AS n, false AS legacy, (k % 11)::VARCHAR AS value, 'records' AS unit, {_SEMANTIC} AS semantic, 'claimed' AS status FROM b WHERE k % 3 = 0
      UNION ALL SELECT user_id, source, item, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END, false, (k % 13)::VARCHAR, 'people', {_SEMANTIC}, 'reported' FROM b WHERE k % 4 = 0
      UNION ALL SELECT user_id, source, item, 9, true, (k % 11)::VARCHAR, CASE WHEN k % 2 = 0 THEN 'records' ELSE 'people' END, NULL, 'unknown' FROM b WHERE k % 5 < 2),
    o AS (SELECT *, row_number() OVER (PARTITION BY user_id, unit ORDER BY {_RANKED}, source, item, n) AS pos,
      CASE WHEN NOT legacy THEN semantic WHEN min(semantic) OVER u = max(semantic) OVER u THEN min(semantic) OVER u ELSE 'unspecified' END AS home
      FROM a WINDOW u AS (PARTITION BY user_id, unit)),
    r AS (SELECT user_id, unit, value, pos FROM o WHERE NOT legacy QUALIFY row_number() OVER (PARTITION BY user_id, unit, semantic ORDER BY pos) = 1),
    e AS (SELECT * FROM o WHERE NOT legacy OR NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = o.user_id AND r.unit = o.unit AND r.value = o.value AND r.pos < o.pos)
      QUALIFY row_number() OVER (PARTITION BY user_id, unit, home ORDER BY pos) = 1),
    m AS (SELECT o.*, coalesce(CASE WHEN NOT o.legacy THEN own.pos END, met.pos) AS met FROM o
      LEFT JOIN e AS own ON NOT o.legacy AND own.user_id = o.user_id AND own.unit = o.unit AND own.home = o.home AND own.value = o.value
      LEFT JOIN (SELECT user_id, unit, value, min(pos) AS pos FROM e GROUP BY ALL) AS met
        ON o.legacy AND met.user_id = o.user_id AND met.unit = o.unit AND met.value = o.value AND met.pos <= o.pos),
    s AS (SELECT user_id, unit, met AS pos, string_agg(source, ',' ORDER BY {_RANKED}, source) AS sources
      FROM (SELECT DISTINCT user_id, unit, met, source FROM m WHERE met IS NOT NULL) GROUP BY ALL),
    c AS (SELECT user_id, unit, home AS semantic, value, status, source, sources, pos, {_RANKED} AS r FROM e JOIN s USING (user_id, unit, pos))"""


@query("N06_affected_counts", f"WITH {_COUNTED} SELECT user_id, unit, semantic, value, status, source, sources FROM c", "events")
def _n06(e: DataFrame) -> DataFrame:
    got = X.counted(_counts(e), "user_id", rank=_rank(F.col("source")))
    return got.select("user_id", "unit", "semantic", "value", "status", "source", F.array_join("sources", ",").alias("sources"))


_STATUS_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.STATUSES.items())


@query(
    "N08_display_summary",
    f"""WITH {_COUNTED}, f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY unit, CASE semantic WHEN 'unique' THEN 0 WHEN 'total' THEN 1 ELSE 2 END, r, pos) = 1),
    u AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'Service down' WHEN user_id % 3 = 1 THEN 'Closed!' END AS impact,
      string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds, CASE WHEN user_id % 5 = 0 THEN repeat('long ', 9) ELSE 'short' END AS fallback FROM events GROUP BY user_id),
    t AS (SELECT u.*, CASE WHEN impact LIKE '%!' THEN impact ELSE impact || '.' END AS one,
      f.value || ' ' || CASE f.unit WHEN 'people' THEN 'personnes' ELSE CASE f.semantic WHEN 'unique' THEN 'enregistrements uniques' ELSE 'enregistrements' END END
        || ' (' || CASE f.status {_STATUS_SQL} END || ').' AS two FROM u LEFT JOIN f USING (user_id))
    SELECT user_id, CASE WHEN impact IS NULL AND length(trim(fallback)) > {X.SUBSTANTIAL} THEN trim(fallback)
      ELSE concat_ws(' ', one, two, 'Données exposées : ' || kinds || '.') END AS summary FROM t""",
    "events",
)
def _n08(e: DataFrame) -> DataFrame:
    first = X.foremost_count(X.counted(_counts(e), "user_id", rank=_rank(F.col("source"))), "user_id")
    users = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    three = F.col("user_id") % 3
    impact = F.when(three == 0, "Service down").when(three == 1, "Closed!")
    fallback = F.when(F.col("user_id") % 5 == 0, F.repeat(F.lit("long "), F.lit(9))).otherwise("short")
    return users.join(first, "user_id", "left").select("user_id", X.display_summary(impact, F.col("count"), F.col("kinds"), fallback).alias("summary"))


_CLAIMS = """q AS (SELECT user_id, event_type AS type, CASE event_id % 6 WHEN 0 THEN ' Confirmed' WHEN 1 THEN 'denied' WHEN 2 THEN 'odd' WHEN 3 THEN NULL WHEN 4 THEN 'claimed' ELSE 'negated' END AS raw,
      (event_id % 3)::VARCHAR AS value, CASE WHEN event_id % 4 > 0 THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS date, 'said  ' || (event_id % 2) AS evidence FROM events),
    p AS (SELECT user_id, type, CASE lower(trim(raw)) WHEN 'confirmed' THEN 'confirmed' WHEN 'denied' THEN 'denied' WHEN 'claimed' THEN 'claimed' WHEN 'negated' THEN 'negated' ELSE 'unknown' END AS status,
      value, date, evidence FROM q),
    w AS (SELECT *, CASE status WHEN 'confirmed' THEN 6 WHEN 'claimed' THEN 4 WHEN 'unknown' THEN 1 ELSE 2 END AS weight FROM p)"""


def _claims(e: DataFrame) -> DataFrame:
    k = F.col("event_id")
    status = F.when(k % 6 == 0, " Confirmed").when(k % 6 == 1, "denied").when(k % 6 == 2, "odd").when(k % 6 == 4, "claimed").when(k % 6 == 5, "negated")
    return e.select(
        "user_id", F.col("event_type").alias("type"), status.alias("status"), (k % 3).cast("string").alias("value"),
        F.when(k % 4 > 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("").alias("date"), F.concat(F.lit("said  "), (k % 2).cast("string")).alias("evidence"),
    )


@query(
    "N12_primary_claim",
    f"""WITH {_CLAIMS} SELECT user_id, status, value, date, evidence FROM w WHERE type = 'purchase'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, date, evidence, value) = 1""",
    "events",
)
def _n12(e: DataFrame) -> DataFrame:
    return X.primary_claim(_claims(e), "user_id", "purchase")


@query(
    "N12_claim_history",
    f"""WITH {_CLAIMS}, d AS (SELECT DISTINCT user_id, type, status, value, date, 'said ' || evidence[-1:] AS evidence, weight FROM w)
        SELECT user_id, type, status, value, date, evidence,
          row_number() OVER (PARTITION BY user_id ORDER BY CASE date WHEN '' THEN '9999-99-99' ELSE date END, weight DESC, evidence, type, value) AS place FROM d""",
    "events",
)
def _n12_history(e: DataFrame) -> DataFrame:
    return X.claim_history(_claims(e), "user_id")


_PCT = "coalesce(round_even(100.0::DOUBLE * {0} / nullif({1}, 0), 1), 0.0)".format
_RATIO = "coalesce(round_even({0} * 1.0::DOUBLE / nullif({1}, 0), 4), 0.0)".format


@query(
    "A12_scorecard",
    f"""WITH active AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'silent']) AS source),
    items AS (SELECT event_type AS source, count(*) AS items, count(DISTINCT user_id) AS organisations, max(ts::DATE) FILTER (event_type <> 'signup' OR event_id % 2 = 0) AS latest,
      count(*) FILTER (event_id % 3 = 0) AS tu, count(*) FILTER (event_id % 5 < 3) AS su, count(*) FILTER (event_id % 7 = 0) AS lu FROM events GROUP BY 1),
    incidents AS (SELECT user_id, ts::DATE AS day, list(DISTINCT event_type) AS names FROM events GROUP BY ALL),
    told AS (SELECT source, count(*) AS touched, count(*) FILTER (n = 1) AS exclusive FROM (SELECT unnest(names) AS source, len(names) AS n FROM incidents) GROUP BY 1),
    runs AS (SELECT event_type AS source, ts::DATE AS as_of, CASE count(*) % 4 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'PARTIAL' ELSE 'OK' END AS status, count(*) * 0.25::DOUBLE AS duration,
      count(*) % 7 AS calls, count(*) AS collected FROM events GROUP BY ALL),
    last AS (SELECT source, count(*) AS n, count(*) FILTER (status = 'OK') AS ok, count(*) FILTER (status = 'PARTIAL') AS partial, count(*) FILTER (status = 'FAIL') AS fail,
      round_even(avg(duration), 2) AS duration, sum(calls) AS calls, sum(collected) AS collected
      FROM (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY source ORDER BY as_of DESC) <= 10) GROUP BY 1),
    j AS (SELECT source, coalesce(items, 0) AS items, coalesce(touched, 0) AS touched, coalesce(exclusive, 0) AS exclusive, coalesce(organisations, 0) AS organisations, latest,
      coalesce(n, 0) AS n, coalesce(ok, 0) AS ok, coalesce(partial, 0) AS partial, coalesce(fail, 0) AS fail, coalesce(duration, 0.0) AS duration, calls, collected,
      coalesce(tu, 0) AS tu, coalesce(su, 0) AS su, coalesce(lu, 0) AS lu
      FROM active LEFT JOIN items USING (source) LEFT JOIN told USING (source) LEFT JOIN last USING (source)),
    k AS (SELECT *, date_diff('day', latest, DATE '2024-03-01') AS days, {_PCT('exclusive', 'touched')} AS share, CASE WHEN n > 0 THEN {_PCT('ok', 'n')} END AS reliability,
      coalesce(round_even(collected * 1.0::DOUBLE / nullif(calls, 0), 3), 0.0) AS per_call,
      CASE WHEN items > 0 THEN round_even(100.0::DOUBLE * (1.0::DOUBLE - ({_RATIO('tu', 'items')} + {_RATIO('su', 'items')} + {_RATIO('lu', 'items')}) / 3), 1) ELSE 0.0 END AS complete,
      {_PCT('tu', 'items')} AS tp, {_PCT('su', 'items')} AS sp, {_PCT('lu', 'items')} AS lp FROM j),
    v AS (SELECT *, round_even((coalesce(reliability, 0) * 30::DOUBLE + CASE WHEN days IS NULL THEN 0 WHEN days <= 2 THEN 100 WHEN days <= 7 THEN 80 WHEN days <= 30 THEN 50 ELSE 20 END * 20::DOUBLE
        + complete * 20 + share * 20 + CASE WHEN per_call >= 2 THEN 100 WHEN per_call >= 1 THEN 75 WHEN per_call >= 0.5 THEN 50 WHEN per_call > 0 THEN 25 ELSE 0 END * 10::DOUBLE)
        / CASE WHEN reliability IS NULL THEN 70 ELSE 100 END, 1) AS value_index FROM k)
    SELECT source, value_index, CASE WHEN value_index >= 80 THEN 'A' WHEN value_index >= 65 THEN 'B' WHEN value_index >= 50 THEN 'C' ELSE 'D' END AS grade, items, touched, exclusive,
      touched - exclusive AS corroborated, share AS exclusive_share_pct, organisations, coalesce(latest::VARCHAR, '') AS latest_day, days AS freshness_days, n AS recent_runs, ok AS ok_runs,
      partial AS partial_runs, fail AS fail_runs, reliability AS reliability_pct, duration AS avg_duration_s, per_call AS items_per_call, tp AS threat_unknown_pct, sp AS sector_unknown_pct,
      lp AS location_unknown_pct, complete AS completeness_pct, array_to_string(list_filter([CASE WHEN items = 0 THEN 'no_items' END, CASE WHEN days > 30 THEN 'stale_over_30d' END,
        CASE WHEN reliability < 80 THEN 'reliability_below_80pct' END, CASE WHEN tp > 25 THEN 'threat_unknown_over_25pct' END, CASE WHEN sp > 50 THEN 'sector_unknown_over_50pct' END,
        CASE WHEN lp > 50 THEN 'location_unknown_over_50pct' END, CASE WHEN touched > 0 AND exclusive = 0 THEN 'no_exclusive_incident' END], lambda x: x IS NOT NULL), ',') AS warnings FROM v""",
    "events",
)
def _a12(e: DataFrame) -> DataFrame:
    k, day = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd")
    e = e.withColumns({"source": F.col("event_type"), "day": day})
    active = e.select("source").distinct().unionByName(e.sparkSession.createDataFrame([("silent",)], "source string"))
    items = e.select(
        "source", F.col("user_id").alias("key"), F.when(k % 2 == 0, day).otherwise("").alias("event"), F.when(F.col("source") != "signup", day).alias("published"),
        F.when(k % 3 == 0, "Inconnu").otherwise("t").alias("threat"), F.when(k % 5 < 3, "Inconnu").otherwise("s").alias("sector"), F.when(k % 7 == 0, "Inconnu").otherwise("l").alias("location"),
    )
    incidents = e.groupBy("user_id", "day").agg(F.array_join(F.collect_set("source"), " | ").alias("sources"))
    n = F.count(F.lit(1))
    status = F.when(n % 4 == 0, "FAIL").when(n % 4 == 1, "PARTIAL").otherwise("OK")
    runs = e.groupBy("source", F.col("day").alias("as_of")).agg(status.alias("status"), (n * 0.25).alias("duration_s"), (n % 7).alias("calls"), n.alias("collected")).withColumn("run_id", F.col("as_of"))
    got = S.scorecard(active, items, incidents, runs, F.lit("2024-03-01").cast("date"))
    return got.withColumn("warnings", F.array_join("warnings", ","))


@query(
    "J09_resolved_sides",
    """WITH i AS (SELECT o_orderkey::VARCHAR AS item, 's' || (o_orderkey % 3) AS source, CASE WHEN o_orderkey % 2 = 0 THEN 'n' || (o_custkey % 40) ELSE '' END AS native,
        'u' || (o_custkey % 50) AS url, o_orderdate::DATE::VARCHAR AS date, o_orderpriority AS organisation FROM orders),
    r AS (SELECT *, item AS ref, CASE item::BIGINT % 11 WHEN 0 THEN '' ELSE source END AS src, CASE WHEN item::BIGINT % 5 = 0 THEN '' ELSE url END AS link,
        CASE WHEN item::BIGINT % 7 < 3 THEN '' ELSE date END AS day, CASE WHEN item::BIGINT % 13 = 0 THEN item || '0' ELSE item END AS id FROM i),
    k AS (SELECT *, CASE WHEN src <> '' AND native <> '' THEN 'native' WHEN src <> '' AND link <> '' THEN 'url' WHEN id <> '' THEN 'id' END AS stage FROM r),
    p AS (SELECT k.ref, k.stage, i.item, k.stage = 'native' AND k.link <> '' AND k.link = i.url AS a, k.stage <> 'id' AND k.day <> '' AND k.day = i.date AS b,
        k.stage <> 'id' AND k.organisation = i.organisation AS c
      FROM k JOIN i ON CASE k.stage WHEN 'native' THEN i.source = k.src AND i.native = k.native WHEN 'url' THEN i.source = k.src AND i.url = k.link ELSE i.item = k.id END),
    q AS (SELECT * FROM p QUALIFY rank() OVER (PARTITION BY ref ORDER BY a DESC, b DESC, c DESC) = 1),
    g AS (SELECT ref, count(*) AS n, min(item) AS item FROM q GROUP BY 1)
    SELECT ref, CASE WHEN n = 1 THEN CASE stage WHEN 'id' THEN 'LEGACY' ELSE 'RESOLVED' END WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'MISSING' END AS status,
      CASE WHEN n = 1 THEN g.item END AS item, coalesce(n, 0) AS candidates FROM k LEFT JOIN g USING (ref)""",
    "orders",
)
def _j09(o: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def numbered(letter: str, n: Column) -> Column:
        return F.concat(F.lit(letter), n.cast("string"))

    items = o.select(
        k.cast("string").alias("item"), numbered("s", k % 3).alias("source"), F.when(k % 2 == 0, numbered("n", c % 40)).otherwise("").alias("native"),
        numbered("u", c % 50).alias("url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderpriority").alias("organisation"),
    )
    key = F.col("item").cast("long")
    refs = items.select(
        F.col("item").alias("ref"), F.when(key % 11 == 0, "").otherwise(F.col("source")).alias("source"), "native", F.when(key % 5 == 0, "").otherwise(F.col("url")).alias("url"),
        F.when(key % 7 < 3, "").otherwise(F.col("date")).alias("date"), "organisation", F.when(key % 13 == 0, F.concat("item", F.lit("0"))).otherwise(F.col("item")).alias("item"),
    )
    return R.resolved_sides(refs, items)
