"""Queries of joins, set operations, clustering, classification and state (J-*, U-*, D-*, K-*, Q-*, I-*, A-27)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import classify as K
from tidemark.operators import dedup as D
from tidemark.operators import relate as R
from tidemark.plans.registry import query

_SEARCHABLE = r"trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"

_TOPICS: K.Rules = (
    ("quality", ("kept", "good", "best")),
    ("rights", ("license", "licence", "copyright", "all rights reserved")),
    ("contact", ("mail", "phone", "call", "contact")),
    ("common", ("the", "und", "les", "los")),
)


def _topic_sql(text: str) -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f"contains(' ' || {text} || ' ', ' {p} ')" for p in phrases)} THEN '{label}'" for label, phrases in _TOPICS
    )
    return f"CASE {cases} ELSE 'Unknown' END"


@query("K01_K03_first_class", f"SELECT doc_id, {_topic_sql('s')} AS topic FROM (SELECT doc_id, {_SEARCHABLE} AS s FROM documents)", "documents")
def _k01(d: DataFrame) -> DataFrame:
    return d.select("doc_id", K.first_class(F.col("text"), _TOPICS).alias("topic"))


@query(
    "A01_K01_topics_by_source",
    f"""SELECT source, {_topic_sql('s')} AS topic, count(*) AS n FROM (SELECT source, {_SEARCHABLE} AS s FROM documents) GROUP BY 1, 2""",
    "documents",
)
def _a01(d: DataFrame) -> DataFrame:
    return d.groupBy("source", K.first_class(F.col("text"), _TOPICS).alias("topic")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "J12_J14_near_pairs",
    """SELECT a.event_id AS left_id, b.event_id AS right_id FROM events AS a JOIN events AS b ON a.user_id = b.user_id AND a.event_type = 'error'
        AND b.event_type = 'purchase' AND abs(date_diff('day', CAST(a.ts AS DATE), CAST(b.ts AS DATE))) <= 3""",
    "events",
)
def _j12(e: DataFrame) -> DataFrame:
    rows = e.select("user_id", "event_id", "event_type", F.to_date("ts").alias("day"))
    left = rows.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("left_id"), F.col("day").alias("left_day"))
    right = rows.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("right_id"), F.col("day").alias("right_day"))
    return R.within_days(left, right, ["user_id"], "left_day", "right_day", 3).select("left_id", "right_id")


@query(
    "J10_J11_unique_or_reject",
    """WITH p AS (SELECT o_orderkey, event_id FROM orders JOIN events ON o_custkey = user_id AND event_type = 'signup' AND o_orderstatus = 'F')
        SELECT o_orderkey, CASE WHEN min(event_id) = max(event_id) THEN min(event_id) END AS event_id,
        CASE WHEN min(event_id) = max(event_id) THEN 'MATCHED' ELSE 'AMBIGUOUS' END AS status FROM p GROUP BY 1""",
    "orders", "events",
)
def _j10(o: DataFrame, e: DataFrame) -> DataFrame:
    signups = e.filter("event_type = 'signup'").select(F.col("user_id").alias("o_custkey"), "event_id")
    return R.unique_or_reject(o.filter("o_orderstatus = 'F'").join(signups, "o_custkey"), "o_orderkey", "event_id")


@query(
    "J07_best_match",
    """WITH p AS (SELECT o_custkey, o_orderkey, 3 * CAST(o_orderstatus = 'F' AS BIGINT) + CAST(o_orderpriority LIKE '1%' AS BIGINT) AS score FROM orders),
        t AS (SELECT * FROM p QUALIFY score = max(score) OVER (PARTITION BY o_custkey))
        SELECT o_custkey, score, CASE WHEN count(DISTINCT o_orderkey) = 1 THEN min(o_orderkey) END AS o_orderkey,
        CASE WHEN count(DISTINCT o_orderkey) = 1 THEN 'MATCHED' ELSE 'AMBIGUOUS' END AS status FROM t GROUP BY 1, 2""",
    "orders",
)
def _j07(o: DataFrame) -> DataFrame:
    score = 3 * (F.col("o_orderstatus") == "F").cast("long") + F.col("o_orderpriority").startswith("1").cast("long")
    return R.best_match(o.select("o_custkey", "o_orderkey", score.alias("score")), "o_custkey", "o_orderkey", "score")


@query(
    "J04_fill_unknown",
    """SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 AND n_name IS NOT NULL THEN n_name WHEN s_nationkey % 2 = 0 THEN 'Unknown' ELSE s_name END AS label
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "supplier", "nation",
)
def _j04(s: DataFrame, n: DataFrame) -> DataFrame:
    label = F.when(F.col("s_nationkey") % 2 == 0, "Unknown").otherwise(F.col("s_name"))
    items = s.select("s_suppkey", F.col("s_nationkey").alias("key"), label.alias("label"))
    reference = n.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("label"))
    return R.fill_unknown(items, reference, "key", ["label"], "Unknown").drop("key")


_BEFORE = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0"
_AFTER = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 5 <> 0"


def _versions(o: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of orders: rows and values of the second differ."""
    k = F.col("o_orderkey")
    slim = o.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status = F.when(k % 11 == 0, "X").otherwise(F.col("o_orderstatus"))
    after = slim.filter(k % 5 != 0).withColumns({"o_orderstatus": status, "o_orderpriority": F.when(k % 13 != 0, F.col("o_orderpriority"))})
    return slim.filter(k % 7 != 0), after


@query(
    "J18_U03_snapshot_diff",
    f"""WITH b AS ({_BEFORE}), a AS ({_AFTER}), j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderkey IS NULL AS gone, b.o_orderkey IS NULL AS fresh,
        a.o_orderstatus IS DISTINCT FROM b.o_orderstatus AS s, a.o_orderpriority IS DISTINCT FROM b.o_orderpriority AS p FROM b FULL JOIN a ON a.o_orderkey = b.o_orderkey)
        SELECT o_orderkey, CASE WHEN fresh THEN 'ADDED' WHEN gone THEN 'REMOVED' ELSE 'CHANGED' END AS change,
        CASE WHEN fresh OR gone THEN '' WHEN s AND p THEN 'o_orderpriority,o_orderstatus' WHEN s THEN 'o_orderstatus' ELSE 'o_orderpriority' END AS fields
        FROM j WHERE fresh OR gone OR s OR p""",
    "orders",
)
def _j18(o: DataFrame) -> DataFrame:
    return R.snapshot_diff(*_versions(o), "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(
    "I02_dirty_set",
    f"""WITH b AS ({_BEFORE}), a AS ({_AFTER}) SELECT a.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'NEW'
        WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'DIRTY' ELSE 'UNCHANGED' END AS state
        FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey""",
    "orders",
)
def _i02(o: DataFrame) -> DataFrame:
    before, after = _versions(o)
    print_of = F.sha2(F.to_json(F.struct("o_orderpriority", "o_orderstatus")), 256)
    return K.dirty_set(after.withColumn("mark", print_of), before.withColumn("mark", print_of), "o_orderkey", "mark")


@query(
    "D12_upsert",
    f"""WITH b AS ({_BEFORE}), a AS ({_AFTER}) SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
        CASE WHEN a.o_orderkey IS NULL THEN b.o_orderpriority ELSE a.o_orderpriority END AS o_orderpriority,
        least(coalesce(a.o_orderstatus, b.o_orderstatus), coalesce(b.o_orderstatus, a.o_orderstatus)) AS o_orderstatus
        FROM b FULL JOIN a ON a.o_orderkey = b.o_orderkey""",
    "orders",
)
def _d12(o: DataFrame) -> DataFrame:
    return R.upsert(*_versions(o), "o_orderkey", "o_orderstatus").select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query(
    "J22_replace_sources",
    f"""WITH b AS ({_BEFORE}), a AS (SELECT * FROM ({_AFTER}) WHERE o_orderpriority LIKE '1%') SELECT * FROM b WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM a)
        UNION ALL SELECT * FROM a""",
    "orders",
)
def _j22(o: DataFrame) -> DataFrame:
    before, after = _versions(o)
    return R.replace_sources(before, after.filter(F.col("o_orderpriority").startswith("1")), "o_orderstatus").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "A27_J19_confusion",
    """WITH j AS (SELECT lang, toxic = 1 AS t, length(text) > 1000 AS p FROM labels JOIN documents USING (doc_id)),
        c AS (SELECT lang, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn,
        count(*) FILTER (NOT t AND NOT p) AS tn FROM j GROUP BY 1)
        SELECT *, round_even(100.0::DOUBLE * tp / nullif(tp + fp, 0), 2) AS precision, round_even(100.0::DOUBLE * tp / nullif(tp + fn, 0), 2) AS recall,
        round_even(100.0::DOUBLE * (tp + tn) / nullif(tp + fp + fn + tn, 0), 2) AS accuracy FROM c""",
    "labels", "documents",
)
def _a27(labels: DataFrame, d: DataFrame) -> DataFrame:
    joined = labels.join(d.select("doc_id", "lang", (F.length("text") > 1000).alias("p")), "doc_id")
    return R.confusion(joined, F.col("toxic") == 1, F.col("p"), "lang")


@query(
    "Q03_Q04_arbitration",
    """WITH d AS (SELECT event_id // 4 AS item, CASE event_type WHEN 'signup' THEN 'MANUAL_REFERENCE' WHEN 'click' THEN 'OFFICIAL_SUBJECT_ACTIVITY' WHEN 'view' THEN 'OFFLINE_BACKFILL' ELSE event_type END AS origin,
        CAST(user_id AS VARCHAR) AS value, CASE WHEN event_id % 3 = 0 THEN 'PROPOSED' ELSE 'APPLIED' END AS decision, event_id FROM events),
        r AS (SELECT *, CASE origin WHEN 'MANUAL_REFERENCE' THEN 10 WHEN 'OFFICIAL_SUBJECT_ACTIVITY' THEN 15 WHEN 'OFFLINE_BACKFILL' THEN 60 ELSE 999 END AS precedence FROM d)
        SELECT event_id, CASE WHEN decision = 'APPLIED' AND row_number() OVER (PARTITION BY item, decision ORDER BY precedence, origin, value, event_id) > 1
        THEN 'REJECTED_LOWER_PRIORITY' ELSE decision END AS decision FROM r""",
    "events",
)
def _q03(e: DataFrame) -> DataFrame:
    names = F.when(F.col("event_type") == "signup", "MANUAL_REFERENCE").when(F.col("event_type") == "click", "OFFICIAL_SUBJECT_ACTIVITY")
    rows = e.select(
        F.floor(F.col("event_id") / 4).alias("item"), names.when(F.col("event_type") == "view", "OFFLINE_BACKFILL").otherwise(F.col("event_type")).alias("origin"),
        F.col("user_id").cast("string").alias("value"), F.when(F.col("event_id") % 3 == 0, "PROPOSED").otherwise("APPLIED").alias("decision"), "event_id",
    )
    return K.arbitrate(rows, ["item"], ties=("event_id",)).select("event_id", "decision")


@query(
    "Q05_Q10_consensus",
    """SELECT user_id, CASE WHEN count(DISTINCT p) = 1 THEN min(p) END AS label, CASE WHEN count(DISTINCT p) > 1 THEN 'CONFLICT'
        WHEN count(DISTINCT event_type) > 1 THEN 'AUTO' ELSE 'REVIEW' END AS status, count(*) AS n, count(DISTINCT event_type) AS sources
        FROM (SELECT user_id, event_type, CASE WHEN value > 98 THEN 'high' ELSE 'low' END AS p FROM events WHERE event_type IN ('error', 'signup')) GROUP BY 1""",
    "events",
)
def _q05(e: DataFrame) -> DataFrame:
    rows = e.filter(F.col("event_type").isin("error", "signup"))
    return K.consensus(rows.select("user_id", F.col("event_type").alias("source"), F.when(F.col("value") > 98, "high").otherwise("low").alias("label")), "user_id", "label")


def _observed(e: DataFrame) -> DataFrame:
    """Signups and errors of events as observations: the user is the key, the type the source, errors name their day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    event = F.when(F.col("event_type") == "error", day)
    return D.observations(
        e.filter(F.col("event_type").isin("error", "signup", "purchase")), key=F.col("user_id"), id=F.lpad(F.col("event_id").cast("string"), 12, "0"),
        source=F.col("event_type"), event=event, published=day, url=F.concat(F.lit("u"), (F.col("event_id") % 3).cast("string")), recurs=F.col("event_id") % 17 == 0,
    )


_RULES = D.MergeRules(url_sources=("purchase",), claim_source="signup", report_source="purchase", claimed="")


@query("D02_components", None, "events")
def _d02(e: DataFrame) -> DataFrame:
    return D.components(_observed(e), _RULES)


@query("D05_D10_incidents", None, "events")
def _d10(e: DataFrame) -> DataFrame:
    rows = _observed(e)
    return D.incidents(rows.join(D.components(rows, _RULES).select("id", "component"), "id"))


_TOLD = ("error", "signup")


@query(
    "D10_D11_rollup",
    """WITH m AS (SELECT user_id::VARCHAR AS component, lpad(event_id::VARCHAR, 12, '0') AS id, event_type AS source, CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS event,
        strftime(ts, '%Y-%m-%d') AS published, 'u' || (event_id % 3) AS url, 'name ' || (event_id % 4) AS name, CASE event_id % 5 WHEN 0 THEN 'Inconnu' WHEN 1 THEN '' ELSE 's' || (event_id % 5) END AS sector,
        'p' || (event_id % 3) AS place, event_type AS threat, CASE WHEN event_id % 6 > 0 THEN strftime(ts, '%Y-%m') ELSE '' END AS collected FROM events),
    w AS (SELECT component, min(nullif(event, '')) AS e, min(published) AS p, count(*) AS items, count(DISTINCT source) AS n_sources, min(nullif(collected, '')) AS first_seen, max(nullif(collected, '')) AS last_seen,
        min(CASE threat WHEN 'error' THEN 0 WHEN 'signup' THEN 1 END) AS r, count(*) FILTER (source <> 'view') AS speaking,
        string_agg(DISTINCT source, ' | ' ORDER BY source) FILTER (source <> 'view') AS ss, string_agg(DISTINCT url, ' | ' ORDER BY url) FILTER (source <> 'view') AS su,
        string_agg(DISTINCT source, ' | ' ORDER BY source) AS ws, string_agg(DISTINCT url, ' | ' ORDER BY url) AS wu, arg_min(name, (source, published, url, id)) AS head FROM m GROUP BY 1),
    n AS (SELECT component, name FROM (SELECT m.component, m.name, count(*) AS n FROM m JOIN w USING (component) WHERE m.name <> w.head GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY component ORDER BY n DESC, name) = 1),
    sc AS (SELECT component, sector, count(*) AS n, count(*) FILTER (source = 'purchase') AS l FROM m WHERE sector NOT IN ('', 'Inconnu') GROUP BY ALL),
    s AS (SELECT component, CASE WHEN max(l) > 0 THEN arg_min(sector, (-l, sector)) WHEN arg_min(sector, (-n, sector)) = arg_max(sector, (n, sector)) THEN arg_min(sector, (-n, sector)) END AS sector FROM sc GROUP BY 1),
    pc AS (SELECT component, place, count(*) AS n, count(*) FILTER (source = 'purchase') AS l FROM m GROUP BY ALL),
    p AS (SELECT component, CASE WHEN max(l) > 0 THEN arg_min(place, (-l, place)) ELSE arg_min(place, (-n, place)) END AS place FROM pc GROUP BY 1)
    SELECT component, component AS key, coalesce(e, w.p) AS date, CASE WHEN e IS NULL THEN 'PUBLICATION' ELSE 'EVENT' END AS basis, coalesce(name, head) AS name, coalesce(sector, 'Inconnu') AS sector,
      CASE r WHEN 0 THEN 'error' WHEN 1 THEN 'signup' ELSE 'Inconnu' END AS threat, place, CASE WHEN speaking > 0 THEN ss ELSE ws END AS sources, CASE WHEN speaking > 0 THEN su ELSE wu END AS urls,
      items, n_sources, coalesce(first_seen, '') AS first_seen, coalesce(last_seen, '') AS last_seen
    FROM w LEFT JOIN n USING (component) LEFT JOIN s USING (component) LEFT JOIN p USING (component)""",
    "events",
)
def _d10_rollup(e: DataFrame) -> DataFrame:
    """Each user's events as one component."""
    k, day = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd")
    rows = e.select(
        F.col("user_id").cast("string").alias("component"), F.col("user_id").cast("string").alias("key"), F.lpad(k.cast("string"), 12, "0").alias("id"), F.col("event_type").alias("source"),
        F.when(F.col("event_type") == "error", day).otherwise("").alias("event"), day.alias("published"), F.concat(F.lit("u"), (k % 3).cast("string")).alias("url"),
        F.concat(F.lit("name "), (k % 4).cast("string")).alias("name"), F.when(k % 5 == 0, "Inconnu").when(k % 5 == 1, "").otherwise(F.concat(F.lit("s"), (k % 5).cast("string"))).alias("sector"),
        F.concat(F.lit("p"), (k % 3).cast("string")).alias("place"), F.col("event_type").alias("threat"), F.when(k % 6 > 0, F.date_format("ts", "yyyy-MM")).otherwise("").alias("collected"),
    )
    return D.incidents(rows, preferred="purchase", silent=("view",), threats=_TOLD)


@query(
    "D09_priority_label",
    """SELECT user_id, coalesce(min_by(event_type, array_position(['purchase', 'error', 'signup'], event_type)) FILTER (event_type IN ('purchase', 'error', 'signup')), 'Unknown')
        AS event_type FROM events GROUP BY 1""",
    "events",
)
def _d09(e: DataFrame) -> DataFrame:
    return D.priority_label(e, "user_id", "event_type", ("purchase", "error", "signup"), "Unknown")


@query("F12_recurrence", f"SELECT doc_id, contains({_SEARCHABLE}, 'de nouveau') OR contains({_SEARCHABLE}, 'new attack') AS again FROM documents", "documents")
def _f12(d: DataFrame) -> DataFrame:
    return d.select("doc_id", D.recurs(F.col("text"), markers=("de nouveau", "new attack")).alias("again"))


@query("F12_recurrence_markers", f"SELECT doc_id, {' OR '.join(f"contains(s, '{m}')" for m in D.RECURRENCE_MARKERS)} AS again FROM (SELECT doc_id, {_SEARCHABLE} AS s FROM documents)", "documents")
def _f12_markers(d: DataFrame) -> DataFrame:
    """All markers; F12_recurrence asks for two of them."""
    return d.select("doc_id", D.recurs(F.col("text")).alias("again"))
