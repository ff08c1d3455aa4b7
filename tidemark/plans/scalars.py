"""Queries of the string, date, number and hash scalars (T-*, C-*, S-23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import values as V
from tidemark.plans.registry import query

_SEARCH = r"trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _sql_search(column: str) -> str:
    return _SEARCH.format(column)


@query("T01_strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents", "documents")
def _t01(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.md5(T.strip_accents(F.col("text"))).alias("digest"))


@query("T02_searchable", f"SELECT doc_id, md5({_sql_search('text')}) AS digest FROM documents", "documents")
def _t02(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.md5(T.searchable(F.col("text"))).alias("digest"))


@query(
    "T03_contains_words",
    f"SELECT doc_id, contains(' ' || {_sql_search('text')} || ' ', ' of the ') AS hit FROM documents", "documents",
)
def _t03(d: DataFrame) -> DataFrame:
    return d.select("doc_id", T.contains_words(T.searchable(F.col("text")), "of the").alias("hit"))


@query("T04_contains_prefix", f"SELECT doc_id, contains(' ' || {_sql_search('text')}, ' idio') AS hit FROM documents", "documents")
def _t04(d: DataFrame) -> DataFrame:
    return d.select("doc_id", T.contains_prefix(T.searchable(F.col("text")), "idio").alias("hit"))


@query(
    "T05_base_key",
    r"""SELECT c_custkey, regexp_replace(array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(
        lower(strip_accents(c_name)), '\.(fr|com|net|org|eu|io|app)$', ''), '[^\p{L}\p{N}_]+', ' ', 'g')), ' '),
        lambda w: w NOT IN ('sas', 'sarl', 'sa', 'eurl')), ' '), '([a-z]) ([0-9])', '\1\2', 'g') AS key FROM customer""",
    "customer",
)
def _t05(c: DataFrame) -> DataFrame:
    return c.select("c_custkey", T.base_key(F.col("c_name")).alias("key"))


@query(
    "T07_acronym",
    r"""SELECT p_partkey, upper(array_to_string(list_transform(list_filter(string_split(trim(regexp_replace(
        lower(p_name), '[^a-z0-9_]+', ' ', 'g')), ' '), lambda w: w <> '' AND w NOT IN
        ('de','du','des','la','le','les','d','l','a','au','aux','pour','en','et','sas','sarl','sa','eurl')), lambda w: w[1]), '')) AS acronym FROM part""",
    "part",
)
def _t07(p: DataFrame) -> DataFrame:
    return p.select("p_partkey", T.acronym(F.col("p_name")).alias("acronym"))


@query(
    "T08_clean_name",
    r"""WITH h AS (SELECT page_id, '🔴 ● ' || CASE page_id % 3 WHEN 0 THEN 'WWW.' WHEN 1 THEN chr(160) ELSE '- ' END || regexp_extract(url, '://([^/]+)', 1) || ' ★ x (site) [x]' AS h FROM pages),
        a AS (SELECT page_id, trim(regexp_replace(regexp_replace(h, '[\x{A0}\x{200B}\x{2022}\x{25A0}-\x{27BF}\x{FE0F}\x{1F000}-\x{1FAFF}]', ' ', 'g'), '\s+', ' ', 'g'), E' -\u2013\u2014\u2022\t') AS a FROM h)
        SELECT page_id, trim(regexp_replace(trim(regexp_replace(a, '(\s*[\(\[][^\)\]]*[\)\]]\s*)+$', '')), '^(?i)www\.', ''), E' -\u2013\u2014\u2022\t') AS name FROM a""",
    "pages",
)
def _t08(p: DataFrame) -> DataFrame:
    host, three = F.regexp_extract("url", "://([^/]+)", 1), F.col("page_id") % 3
    lead = F.when(three == 0, "WWW.").when(three == 1, "\xa0").otherwise("- ")
    h = F.concat(F.lit("\U0001F534 \u25CF "), lead, host, F.lit(" \u2605 x (site) [x]"))
    return p.select("page_id", T.clean_name(h).alias("name"))


@query(
    "T09_leading_marker",
    r"SELECT doc_id, trim(regexp_extract(text, '^([^\p{L}\p{N}(\[]+)', 1)) AS marker FROM documents", "documents",
)
def _t09(d: DataFrame) -> DataFrame:
    return d.select("doc_id", T.leading_marker(F.col("text")).alias("marker"))


@query(
    "T10_cut_at",
    r"""WITH s AS (SELECT doc_id, text, trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^\p{L}\p{N}_]+', ' ', 'g')) AS s FROM documents),
        p AS (SELECT doc_id, text, list_min(list_filter([strpos(s, ' of '), strpos(s, ' the '), strpos(s, ' der '), strpos(s, ' de ')],
          lambda x: x > 1)) AS pos FROM s)
        SELECT doc_id, md5(CASE WHEN pos IS NULL THEN text ELSE trim(substr(text, 1, pos - 1), ' -–—•,;' || chr(9)) END) AS digest FROM p""",
    "documents",
)
def _t10(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.md5(T.cut_at(F.col("text"), [" of ", " the ", " der ", " de "])).alias("digest"))


@query(
    "T11_split_list",
    r"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, ',|\s+et\s+'), lambda x: trim(x, ' .')),
        lambda x: x <> '') AS parts FROM documents)
        SELECT doc_id, CAST(len(parts) AS BIGINT) AS n, md5(array_to_string(parts, '|')) AS digest FROM p""",
    "documents",
)
def _t11(d: DataFrame) -> DataFrame:
    parts = T.split_list(F.col("text"))
    return d.select("doc_id", F.size(parts).cast("long").alias("n"), F.md5(F.array_join(parts, "|")).alias("digest"))


@query(
    "T12_sentences",
    r"""SELECT doc_id, CAST(len(list_filter(list_transform(string_split_regex(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'),
        '\n+'), lambda s: trim(s, ' ')), lambda s: length(s) BETWEEN 15 AND 900)) AS BIGINT) AS n FROM documents""",
    "documents",
)
def _t12(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.size(T.sentences(F.col("text"))).cast("long").alias("n"))


@query(
    "T13_norm_key",
    "SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g'))) AS digest FROM documents", "documents",
)
def _t13(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.md5(T.norm_key(F.col("text"))).alias("digest"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '^www\.', '')"


@query("T14_url_host", f"SELECT page_id, {_HOST} AS host FROM pages", "pages")
def _t14(p: DataFrame) -> DataFrame:
    return p.select("page_id", T.url_host(F.col("url")).alias("host"))


@query(
    "T15_public_link",
    f"""WITH h AS (SELECT {_HOST} AS host, url FROM pages)
        SELECT host, min(url) FILTER (WHERE regexp_matches(url, '^https?://') AND host NOT LIKE '%.onion') AS link FROM h GROUP BY host""",
    "pages",
)
def _t15(p: DataFrame) -> DataFrame:
    return p.groupBy(T.url_host(F.col("url")).alias("host")).agg(F.min(T.public_link(F.array("url"))).alias("link"))


@query(
    "T16_grouped_number",
    r"""SELECT o_orderkey, replace(format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)), ',', ' ') AS amount FROM orders""", "orders",
)
def _t16(o: DataFrame) -> DataFrame:
    return o.select("o_orderkey", T.grouped_number(V.half_even(F.col("o_totalprice")).cast("long")).alias("amount"))


@query(
    "T16_joined_list",
    """WITH n AS (SELECT n_regionkey, list_sort(list(n_name)) AS l FROM nation GROUP BY 1)
        SELECT n_regionkey, CASE WHEN len(l) <= 1 THEN array_to_string(l, '')
        ELSE array_to_string(l[1:len(l)-1], ', ') || ' et ' || l[len(l)] END AS names FROM n""",
    "nation",
)
def _t16b(n: DataFrame) -> DataFrame:
    names = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("l"))
    return names.select("n_regionkey", T.joined_list(F.col("l")).alias("names"))


@query(
    "T17_truncated",
    r"""SELECT doc_id, CASE WHEN length(text) <= 240 THEN text
        ELSE regexp_replace(substr(text, 1, 240), '\s+\S*$', '') || '…' END AS summary FROM documents""",
    "documents",
)
def _t17(d: DataFrame) -> DataFrame:
    return d.select("doc_id", T.truncated(F.col("text"), 240).alias("summary"))


@query(
    "T18_browse_normal",
    r"SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '\s+', ' ', 'g'))) AS digest FROM documents", "documents",
)
def _t18(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.md5(T.browse_normal(F.col("text"))).alias("digest"))


_PAIRS = """WITH w AS (SELECT DISTINCT p_name AS name, string_split(p_name, ' ') AS w FROM part),
    k AS (SELECT name, w, array_to_string(list_sort(w), ' ') AS bag, replace(name, ' ', '') AS letters FROM w)"""


@query(
    "T21_same_words",
    _PAIRS + " SELECT a.name AS left_name, b.name AS right_name FROM k a JOIN k b ON a.bag = b.bag AND a.name < b.name AND len(a.w) > 1", "part",
)
def _t21(p: DataFrame) -> DataFrame:
    k = p.select(F.col("p_name").alias("name")).distinct().withColumn("bag", T.sorted_words(F.col("name")))
    a, b = k.toDF("left_name", "bag"), k.toDF("right_name", "bag")
    pairs = a.join(b, "bag").filter("left_name < right_name")
    return pairs.filter(T.same_words(F.col("left_name"), F.col("right_name"))).select("left_name", "right_name")


@query(
    "T20_same_letters",
    _PAIRS + """ SELECT a.name AS left_name, b.name AS right_name FROM k a JOIN k b ON a.letters = b.letters AND a.name < b.name
        AND len(a.w) <> len(b.w)""",
    "part",
)
def _t20(p: DataFrame) -> DataFrame:
    k = p.select(F.col("p_name").alias("name")).distinct().withColumn("letters", F.replace(F.col("name"), F.lit(" "), F.lit("")))
    a, b = k.toDF("left_name", "letters"), k.toDF("right_name", "letters")
    pairs = a.join(b, "letters").filter("left_name < right_name")
    return pairs.filter(T.same_letters(F.col("left_name"), F.col("right_name"))).select("left_name", "right_name")


@query(
    "T19_word_sequence",
    """SELECT p_partkey, len(string_split(p_type, ' ')) > 1 AND contains(' ' || p_type || ' ', ' ' || split_part(p_type, ' ', 1) || ' ')
        AS sequence FROM part""",
    "part",
)
def _t19(p: DataFrame) -> DataFrame:
    first = F.get(F.split("p_type", " "), F.lit(0))
    return p.select("p_partkey", T.word_sequence_in(F.col("p_type"), first).alias("sequence"))


@query(
    "T22_name_tokens",
    r"""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name),
        '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND w NOT IN ('des','les','the','and','sas','sarl','eurl')))), ' ')
        AS tokens FROM part""",
    "part",
)
def _t22(p: DataFrame) -> DataFrame:
    return p.select("p_partkey", F.array_join(F.array_sort(T.name_tokens(F.col("p_name"))), " ").alias("tokens"))


@query(
    "T23_grounded",
    r"""WITH x AS (SELECT turn, conv_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t,
        trim(regexp_replace(split_part(text, '.', 1), '\s+', ' ', 'g')) AS e FROM conversations)
        SELECT conv_id, turn, e <> '' AND contains(t, e) AS grounded FROM x""",
    "conversations",
)
def _t23(c: DataFrame) -> DataFrame:
    first = F.split_part(F.col("text"), F.lit("."), F.lit(1))
    return c.select("conv_id", "turn", T.grounded(first, F.col("text")).alias("grounded"))


@query(
    "T24_numbers_supported",
    """SELECT event_id, len(list_filter(regexp_extract_all(CAST(user_id AS VARCHAR), '[0-9]+'),
        lambda x: NOT list_contains(regexp_extract_all(props, '[0-9]+'), x))) = 0 AS supported FROM events""",
    "events",
)
def _t24(e: DataFrame) -> DataFrame:
    return e.select("event_id", T.numbers_supported(F.col("user_id").cast("string"), F.col("props")).alias("supported"))


@query(
    "S23_html_to_text",
    r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'),
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))) AS digest FROM pages""",
    "pages",
)
def _s23(p: DataFrame) -> DataFrame:
    return p.select("page_id", F.md5(T.strip_html(F.col("html"))).alias("digest"))


@query(
    "C01_parse_date",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS iso, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS slashed, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS named
        FROM orders""",
    "orders",
)
def _c01(o: DataFrame) -> DataFrame:
    shapes = {"iso": "yyyy-MM-dd'T'HH:mm:ss", "slashed": "dd/MM/yyyy", "named": "d MMMM yyyy"}
    return o.select("o_orderkey", *[V.parse_date(F.date_format("o_orderdate", s)).alias(k) for k, s in shapes.items()])


@query(
    "C02_strict_date",
    r"""SELECT page_id, CASE WHEN regexp_matches(d, '^\d{4}-\d{2}-\d{2}$') THEN CAST(try_cast(d AS DATE) AS VARCHAR) END AS day
        FROM (SELECT page_id, '2024-0' || (page_id % 10) || '-' || (20 + page_id % 15) AS d FROM pages)""",
    "pages",
)
def _c02(p: DataFrame) -> DataFrame:
    d = F.concat(F.lit("2024-0"), (F.col("page_id") % 10).cast("string"), F.lit("-"), (20 + F.col("page_id") % 15).cast("string"))
    return p.select("page_id", V.strict_date(d).alias("day"))


@query(
    "C03_days_between",
    """SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "lineitem", "orders",
)
def _c03(li: DataFrame, o: DataFrame) -> DataFrame:
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    return joined.select("l_orderkey", "l_linenumber", V.days_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))


@query(
    "C06_window_days",
    """SELECT o_custkey, greatest(1, date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1) AS days
        FROM orders GROUP BY 1""",
    "orders",
)
def _c06(o: DataFrame) -> DataFrame:
    return o.groupBy("o_custkey").agg(V.window_days(F.min("o_orderdate"), F.max("o_orderdate")).alias("days"))


@query(
    "C07_date_ordinal",
    "SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS ordinal FROM events", "events",
)
def _c07(e: DataFrame) -> DataFrame:
    return e.select("event_id", V.date_ordinal(F.date_format("ts", "yyyy-MM-dd")).alias("ordinal"))


@query("C08_month", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1", "orders")
def _c08(o: DataFrame) -> DataFrame:
    return o.groupBy(V.month_of(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "C09_pct_change",
    """WITH m AS (SELECT o_orderstatus AS s, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2),
        p AS (SELECT s, y, n, coalesce(lag(n) OVER (PARTITION BY s ORDER BY y), 0) AS before FROM m)
        SELECT s AS status, y AS year, CASE WHEN before = 0 THEN (CASE WHEN n > 0 THEN 100.0::DOUBLE END)
        ELSE round_even((n - before) * 100.0::DOUBLE / before, 1) END AS change FROM p""",
    "orders",
)
def _c09(o: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    m = o.groupBy(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.lag("n").over(Window.partitionBy("status").orderBy("year")), F.lit(0))
    return m.select("status", "year", V.pct_change(F.col("n"), before).alias("change"))


@query(
    "C10_ratio",
    """SELECT user_id, coalesce(round_even(CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / nullif(count(*) FILTER (event_type = 'view'), 0), 4), 0)
        AS share FROM events GROUP BY 1""",
    "events",
)
def _c10(e: DataFrame) -> DataFrame:
    bought, seen = F.count_if(F.col("event_type") == "purchase"), F.count_if(F.col("event_type") == "view")
    return e.groupBy("user_id").agg(V.ratio(bought, seen).alias("share"))


@query("C11_percentile", "SELECT o_orderpriority, quantile_disc(o_totalprice, 0.95) AS p95 FROM orders GROUP BY 1", "orders")
def _c11(o: DataFrame) -> DataFrame:
    return o.groupBy("o_orderpriority").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY o_totalprice)").alias("p95"))


@query(
    "C12_scaled_number",
    """SELECT p_partkey, CAST(p_size AS BIGINT) * 1000 * (CASE p_size % 3 WHEN 0 THEN 1000000 WHEN 1 THEN 1000 ELSE 1 END) AS value FROM part""",
    "part",
)
def _c12(p: DataFrame) -> DataFrame:
    scale = F.element_at(F.array(F.lit("millions"), F.lit("mille"), F.lit("")), F.col("p_size") % 3 + 1)
    return p.select("p_partkey", V.scaled_number(F.concat(F.col("p_size"), F.lit(" 000")), scale).alias("value"))


@query(
    "C13_digits_only",
    r"SELECT s_suppkey, regexp_extract(s_name, '(\d+)$', 1) AS digits, CAST(NULL AS VARCHAR) AS none FROM supplier", "supplier",
)
def _c13(s: DataFrame) -> DataFrame:
    tail = F.regexp_extract("s_name", r"(\d+)$", 1)
    return s.select("s_suppkey", V.digits_only(tail).alias("digits"), V.digits_only(F.col("s_name")).alias("none"))


@query(
    "C14_item_id",
    """SELECT event_id, 'ITM-' || substr(sha256(event_type || '|SOURCE_ITEM|' || event_id), 1, 16) AS item_id,
        'INC-' || upper(substr(sha256(user_id || '|' || event_id), 1, 12)) AS incident_id FROM events""",
    "events",
)
def _c14(e: DataFrame) -> DataFrame:
    none = F.lit("")
    item = V.item_id(F.col("event_type"), F.col("event_id").cast("string"), none, none, none)
    return e.select("event_id", item.alias("item_id"), V.incident_id(F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("incident_id"))


@query("C15_content_hash", "SELECT doc_id, sha256(source || chr(0) || 'v1' || chr(0) || text) AS digest FROM documents", "documents")
def _c15(d: DataFrame) -> DataFrame:
    return d.select("doc_id", V.content_hash(F.col("source"), F.lit("v1"), F.col("text")).alias("digest"))


@query(
    "C16_canonical_hash",
    """SELECT event_id, sha256('{"key":"' || user_id || '","kind":"' || event_type || '","source":""}') AS digest FROM events""", "events",
)
def _c16(e: DataFrame) -> DataFrame:
    return e.select("event_id", V.canonical_hash(source=F.lit(None), kind=F.col("event_type"), key=F.col("user_id")).alias("digest"))


@query(
    "C17_coverage",
    """SELECT o_custkey, CAST(least(100, greatest(0, round_even(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*), 0))) AS BIGINT)
        AS coverage FROM orders GROUP BY 1""",
    "orders",
)
def _c17(o: DataFrame) -> DataFrame:
    return o.groupBy("o_custkey").agg(V.coverage(F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1))).alias("coverage"))


@query(
    "C18_C19_C20_scores",
    """WITH u AS (SELECT user_id, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-30') AS age, count(*) / 30.0::DOUBLE AS per_day FROM events GROUP BY 1),
        s AS (SELECT user_id, CASE WHEN age <= 2 THEN 100.0 WHEN age <= 7 THEN 80.0 WHEN age <= 30 THEN 50.0 ELSE 20.0 END::DOUBLE AS fresh,
        CASE WHEN per_day >= 2 THEN 100.0 WHEN per_day >= 1 THEN 75.0 WHEN per_day >= 0.5 THEN 50.0 WHEN per_day > 0 THEN 25.0 ELSE 0.0 END::DOUBLE AS eff FROM u),
        w AS (SELECT user_id, fresh, eff, round_even((fresh * 0.6::DOUBLE + eff * 0.4::DOUBLE) / (0.6::DOUBLE + 0.4::DOUBLE), 1) AS score FROM s)
        SELECT user_id, fresh, eff, score, CASE WHEN score >= 80 THEN 'A' WHEN score >= 65 THEN 'B' WHEN score >= 50 THEN 'C' ELSE 'D' END AS grade FROM w""",
    "events",
)
def _c18(e: DataFrame) -> DataFrame:
    u = e.groupBy("user_id").agg(
        F.datediff(F.lit("2024-01-30").cast("date"), F.max("ts")).alias("age"), (F.count(F.lit(1)) / 30.0).alias("per_day")
    )
    s = u.select("user_id", V.freshness_score(F.col("age")).alias("fresh"), V.efficiency_score(F.col("per_day")).alias("eff"))
    s = s.withColumn("score", V.weighted_score([(F.col("fresh"), 0.6), (F.col("eff"), 0.4)]))
    return s.withColumn("grade", V.grade(F.col("score")))


@query(
    "C21_cache_fresh",
    """SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') < (CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 7 ELSE 21 END) AS fresh
        FROM events""",
    "events",
)
def _c21(e: DataFrame) -> DataFrame:
    now = F.lit("2024-01-31").cast("date")
    return e.select("event_id", V.cache_fresh(F.col("ts"), F.col("event_type"), now, {"error": 2, "view": 7}, 21).alias("fresh"))
