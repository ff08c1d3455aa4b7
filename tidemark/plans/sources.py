"""Queries of feeds, JSON records and structured data in pages (S-09, S-10, S-12, S-13, S-25, S-26, R-01, R-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources import feeds as S


@query(
    "S09_R03_posts",
    """WITH p AS (SELECT event_id % 3000 AS id, event_id AS page, CASE WHEN event_id % 2 = 0 THEN 'T' || event_id ELSE 'plain' || event_id END AS title FROM events)
        SELECT id, title FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY page) = 1""",
    "events",
)
def _s09(e: DataFrame) -> DataFrame:
    k = F.col("event_id")
    nested = F.concat(F.lit('{"title":{"rendered":"T'), k.cast("string"), F.lit('"}}'))
    plain = F.concat(F.lit('{"title":"plain'), k.cast("string"), F.lit('"}'))
    rows = e.select((k % 3000).alias("id"), k.alias("page"), F.when(k % 2 == 0, nested).otherwise(plain).alias("post"))
    return S.union_posts(rows, "id", "page").select("id", S.rendered(F.col("post"), "title").alias("title"))


@query(
    "S10_alias_records",
    """SELECT min(CASE WHEN c_custkey % 2 = 0 THEN upper(c_mktsegment) ELSE c_mktsegment END) AS org, CAST(c_nationkey AS VARCHAR) AS day FROM customer GROUP BY lower(c_mktsegment), c_nationkey""",
    "customer",
)
def _s10(c: DataFrame) -> DataFrame:
    name = F.when(F.col("c_custkey") % 2 == 0, F.upper("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    flat = F.to_json(F.struct(name.alias("victim"), F.col("c_nationkey").cast("string").alias("date")))
    other = F.to_json(F.struct(name.alias("post_title"), F.col("c_nationkey").cast("string").alias("discovered")))
    payload = F.concat(F.lit('{"data":['), F.when(F.col("c_custkey") % 3 == 0, flat).otherwise(other), F.lit("]}"))
    got = S.alias_records(c.select(payload.alias("p")), "p", {"org": ("victim", "post_title"), "day": ("date", "discovered")}, [F.lower("org"), F.col("day")])
    return got.select("org", "day")


@query(
    "S12_S13_structured",
    """SELECT page_id, 'https://x.example/' || page_id AS url, 'Article' AS type, 'H' || page_id AS headline, '2024-01-02' AS date FROM pages WHERE page_id % 3 <> 2
        UNION ALL SELECT page_id, 'https://y.example/' || page_id, 'NewsArticle', 'N', '2024-02-03' FROM pages WHERE page_id % 3 = 1""",
    "pages",
)
def _s12(p: DataFrame) -> DataFrame:
    k = F.col("page_id").cast("string")
    one = F.concat(F.lit('{"@type":"Article","url":"https://x.example/'), k, F.lit('","headline":"H'), k, F.lit('","datePublished":"2024-01-02"}'))
    two = F.concat(F.lit('{"@type":"NewsArticle","url":"https://y.example/'), k, F.lit('","headline":"N","datePublished":"2024-02-03"}'))
    kind = F.col("page_id") % 3
    block = F.when(kind == 0, one).when(kind == 1, F.concat(F.lit('{"@graph":['), one, F.lit(","), two, F.lit("]}"))).otherwise('{"@type":"Person","url":"z"}')
    html = F.concat(F.lit('<script type="application/ld+json">'), block, F.lit("</script>"), F.coalesce("html", F.lit("")))
    return S.json_ld(p.select("page_id", html.alias("html")), "page_id", "html").filter(F.col("url").rlike(r"^https://[xy]\.example/"))


@query(
    "S13_time_elements",
    """SELECT page_id, array_to_string(regexp_extract_all(html, '(?i)<time[^>]*\\sdatetime="([^"]*)"', 1), ',') AS times FROM pages WHERE html IS NOT NULL""", "pages",
)
def _s13(p: DataFrame) -> DataFrame:
    return p.filter("html IS NOT NULL").select("page_id", F.array_join(S.time_elements(F.col("html")), ",").alias("times"))


@query(
    "S25_atom_entries",
    """WITH l AS (SELECT * FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 4 = 0 THEN 'http://a.onion/' ELSE 'https://a.example/?a=1&b=2' END AS link, o_orderstatus || ' <' || o_orderpriority || '>' AS title
        FROM orders) WHERE link NOT LIKE '%.onion/%' ORDER BY day DESC, o_orderkey DESC LIMIT 50)
        SELECT o_orderkey, '<entry><id>' || o_orderkey || '</id><title>' || replace(replace(title, '<', '&lt;'), '>', '&gt;') || '</title><link href="' || replace(link, '&', '&amp;') || '"/><updated>' || CAST(day AS VARCHAR)
        || 'T00:00:00Z</updated></entry>' AS entry FROM l""",
    "orders",
)
def _s25(o: DataFrame) -> DataFrame:
    link = F.when(F.col("o_orderkey") % 4 == 0, "http://a.onion/").otherwise("https://a.example/?a=1&b=2")
    title = F.concat("o_orderstatus", F.lit(" <"), "o_orderpriority", F.lit(">"))
    rows = o.select("o_orderkey", F.to_date("o_orderdate").alias("day"), link.alias("link"), title.alias("title"))
    return S.atom_entries(rows, "o_orderkey", "day", "title", "link")


@query(
    "S26_latest_publication",
    "SELECT o_orderkey FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) <= 30", "orders",
)
def _s26(o: DataFrame) -> DataFrame:
    return S.latest_publication(o.withColumn("day", F.to_date("o_orderdate")), "day").select("o_orderkey")


@query(
    "R01_window_coverage",
    """SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS days, least(100, round_even(100.0::DOUBLE * count(DISTINCT CAST(o_orderdate AS DATE)) / 182, 1)) AS pct
        FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""",
    "orders",
)
def _r01(o: DataFrame) -> DataFrame:
    return S.window_coverage(o.select(F.to_date("o_orderdate").alias("day")), "1996-01-01", "1996-06-30")


@query(
    "S14_dated_links",
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN '2024-01-02' WHEN 1 THEN '2024-05-01' ELSE '2024-03-07' END AS day,
          CASE page_id % 3 WHEN 0 THEN 'https://z.example/a/b/' || page_id WHEN 1 THEN 'https://z.example/r/' || page_id ELSE 'https://y.example/q' END AS url, 'A long label ' || page_id AS title FROM pages
        UNION ALL SELECT page_id, '2024-06-09', 'https://z.example/a/n' || page_id, 'Another label' FROM pages WHERE page_id % 3 < 2""",
    "pages",
)
def _s14(p: DataFrame) -> DataFrame:
    """A list of dated links before each page; what the page itself gives is left out."""
    k, three = F.col("page_id").cast("string"), F.col("page_id") % 3
    day = F.when(three == 0, "2024-01-02").when(three == 1, "1 mai 2024").otherwise("07/03/2024")
    href = F.when(three == 0, F.concat(F.lit("./b/"), k)).when(three == 1, F.concat(F.lit("../r/x/../"), k)).otherwise("//y.example/q")
    first = F.concat(F.lit("<li>"), day, F.lit(' <a class="c" href="'), href, F.lit('">A <b>long</b> label '), k, F.lit("</a></li>"), F.repeat(F.lit("."), F.lit(1600)))
    second = F.concat(F.lit('<a href="#top">A link within the page</a><a href="n'), k, F.lit('">Another label</a> <i>9 June 2024</i><a href="s">short</a>'), F.repeat(F.lit("."), F.lit(1600)))
    html = F.concat(first, F.when(three < 2, second).otherwise(""), F.coalesce("html", F.lit("")))
    got = S.dated_links(p.select("page_id", F.lit("https://z.example/a/index.html?x=1").alias("url"), html.alias("html")), "page_id", "url", "html")
    return got.filter(F.col("title").rlike("^(A long|Another) label"))
