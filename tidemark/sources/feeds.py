"""Feeds and structured data in pages (S-08...S-10, S-12, S-13, S-25, S-26, R-01, R-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import strip_html
from tidemark.functions.values import half_even, parse_date
from tidemark.operators.facts import first_alias, records_of

_RSS = "title string, link string, description string, pubDate string, guid string"
_ATOM = "title string, link struct<_href: string>, summary string, updated string, published string, id string"


def feed_day(value: Column) -> Column:
    """The day of an RFC 822 or ISO time, null where it is neither."""
    plain = F.regexp_replace(F.trim(value), r"^[A-Za-z]{3,9},\s*", "")
    mail = F.to_date(F.try_to_timestamp(F.regexp_extract(plain, r"^\d{1,2} [A-Za-z]{3} \d{4}", 0), F.lit("d MMM yyyy")))
    return F.coalesce(mail, F.to_date(F.try_to_timestamp(F.regexp_extract(plain, r"^\d{4}-\d{2}-\d{2}", 0), F.lit("yyyy-MM-dd"))))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """S-08: title, link, summary, day, native_id of the entries of RSS and Atom files; entries without a day are left out."""
    rss = spark.read.format("xml").options(rowTag="item").schema(_RSS).load(path)
    rss = rss.select("title", "link", F.col("description").alias("summary"), feed_day(F.col("pubDate")).alias("day"), F.coalesce("guid", "link").alias("native_id"))
    atom = spark.read.format("xml").options(rowTag="entry").schema(_ATOM).load(path)
    day = F.coalesce(feed_day(F.col("published")), feed_day(F.col("updated")))
    atom = atom.select("title", F.col("link._href").alias("link"), "summary", day.alias("day"), F.coalesce("id", "link._href").alias("native_id"))
    return rss.unionByName(atom).filter("day IS NOT NULL")


def window_coverage(entries: DataFrame, start: str, end: str) -> DataFrame:
    """R-01: one row: observed days of the window and their share of it in percent."""
    days = F.countDistinct(F.when(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.col("day")))
    length = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    return entries.agg(days.alias("days")).withColumn("pct", F.least(F.lit(100.0), half_even(100.0 * F.col("days") / length, 1)))


def union_posts(pages: DataFrame, native_id: str, page: str) -> DataFrame:
    """S-09: posts of all result pages and searches, each native id once, as its first page has it."""
    w = Window.partitionBy(native_id).orderBy(page)
    return pages.withColumn("_at", F.row_number().over(w)).filter("_at = 1").drop("_at")


def rendered(post: Column, field: str) -> Column:
    """R-03: a field of a post that is a text or an object with a `rendered` text."""
    return F.coalesce(F.get_json_object(post, f"$.{field}.rendered"), F.get_json_object(post, f"$.{field}"))


def alias_records(payloads: DataFrame, payload: str, aliases: dict[str, tuple[str, ...]], dedup: list[Column]) -> DataFrame:
    """S-10: one row per record of JSON payloads, fields by their first alias, equal `dedup` values once."""
    each = payloads.select(F.explode(records_of(F.col(payload))).alias("_r"))
    rows = each.select(*[first_alias(F.col("_r"), names).alias(f) for f, names in aliases.items()])
    keyed = rows.withColumns({f"_d{i}": c for i, c in enumerate(dedup)})
    return keyed.groupBy(*[f"_d{i}" for i in range(len(dedup))]).agg(F.min(F.struct(*rows.columns)).alias("_x")).select("_x.*")


def json_ld(pages: DataFrame, id: str, html: str, kinds: tuple[str, ...] = ("Article", "NewsArticle", "BlogPosting")) -> DataFrame:
    """S-12: id, type, url, headline, date of the articles in ld+json blocks: the block itself, its list, or its @graph, url once a page."""
    blocks = F.regexp_extract_all(F.col(html), F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    raw = pages.select(id, F.explode(blocks).alias("b"))
    graph = F.from_json(F.get_json_object("b", "$['@graph']"), "array<string>")
    nodes = F.when(F.trim("b").startswith("["), F.from_json("b", "array<string>")).when(graph.isNotNull(), graph).otherwise(F.array("b"))
    each = raw.select(id, F.explode(nodes).alias("n"))
    rows = each.select(
        id, F.get_json_object("n", "$['@type']").alias("type"), F.get_json_object("n", "$.url").alias("url"),
        F.get_json_object("n", "$.headline").alias("headline"), F.get_json_object("n", "$.datePublished").alias("date"),
    )
    return rows.filter(F.col("type").isin(*kinds)).groupBy(id, "url").agg(F.min(F.struct("type", "headline", "date")).alias("x")).select(id, "url", "x.*")


def time_elements(html: Column) -> Column:
    """S-13: the datetime values of <time> elements, in page order."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<time[^>]*\sdatetime="([^"]*)"'), F.lit(1))


def escaped(text: Column) -> Column:
    """Text as XML holds it."""
    out = F.coalesce(text, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def atom_entries(rows: DataFrame, id: str, day: str, title: str, link: str, most: int = 50) -> DataFrame:
    """S-25: id, entry: Atom entries of the latest rows by day and id, without links into hidden services or the wall clock."""
    shown = rows.filter(~F.coalesce(F.col(link), F.lit("")).rlike(r"^https?://[^/]*\.onion(/|$)")).orderBy(F.desc(day), F.desc(id)).limit(most)
    entry = F.concat(
        F.lit("<entry><id>"), escaped(F.col(id).cast("string")), F.lit("</id><title>"), escaped(F.col(title)), F.lit('</title><link href="'), escaped(F.col(link)),
        F.lit('"/><updated>'), F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z</updated></entry>"),
    )
    return shown.select(id, entry.alias("entry"))


def latest_publication(rows: DataFrame, day: str, days: int = 30) -> DataFrame:
    """S-26: rows of the last `days` days before the latest day of all."""
    newest = rows.agg(F.max(day).alias("_newest"))
    return rows.join(F.broadcast(newest)).filter(F.datediff("_newest", F.col(day)) <= days).drop("_newest")


# Month names as they stand beside a day in pages, and how a day can be written.
DAY_MONTHS = (
    "janvier", "février", "fevrier", "mars", "avril", "mai", "juin", "juillet", "août", "aout", "septembre", "octobre", "novembre", "décembre", "decembre",
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
    "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "sept", "oct", "nov", "dec",
)
_MONTH = "(?:" + "|".join(DAY_MONTHS) + ")"
# A day begins with a digit or with the first two letters of a month; any sign beyond ASCII may be either. Looked at first, as
# trying all names at each place of a text takes most of the time.
_DAY_OPENS = r"(?-iU:(?=[0-9\x{80}-\x{10FFFF}]|[jfmasondJFMASOND][aeuopvcAEUOPVC\x{80}-\x{10FFFF}]))"
WRITTEN_DAY = (
    rf"(?iU){_DAY_OPENS}(?<![\d/-])(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}[/.]\d{{1,2}}[/.]\d{{4}}|\d{{1,2}}(?:er)?\s+{_MONTH}\.?\s+\d{{4}}|{_MONTH}\.?\s+\d{{1,2}},?\s+\d{{4}})(?![\d/-])"
)
LINK = r"""(?is)<a[^>]+href=["']([^"']+)["'][^>]*>(.*?)</a>"""
NEAR, LEAST_LABEL = 1500, 12


def absolute_url(base: Column, href: Column) -> Column:
    """A link as its page means it: whole, without a scheme, from the root, a query, or from the page's folder, with dots resolved."""
    page = F.regexp_replace(F.coalesce(base, F.lit("")), r"[?#].*$", "")
    origin = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    folder = F.regexp_replace(F.substr(page, F.length(origin) + 1), r"[^/]*$", "")
    whole = F.when(href.startswith("/"), href).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), href))
    path, rest = F.regexp_extract(whole, r"^([^?#]*)", 1), F.regexp_extract(whole, r"^[^?#]*(.*)$", 1)

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    steps = F.split(F.regexp_replace(path, r"^/", ""), "/")
    walked = F.aggregate(steps, F.array().cast("array<string>"), step)
    ends = F.when(F.element_at(steps, -1).isin(".", "..") & (F.size(walked) > 0), "/").otherwise("")
    clean = F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(walked, "/"), ends)).otherwise(path)
    out = F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
    return out.when(href.startswith("?"), F.concat(page, href)).otherwise(F.concat(origin, clean, rest))


def _places(pages: DataFrame, id: str, html: str, pattern: str) -> DataFrame:
    """id, n, start, end, match of the matches of a pattern in a text: where they stand follows from what is between them."""
    matches = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))
    # after the last match one more text follows, with which no match goes
    both = F.arrays_zip(F.split(F.col(html), pattern, -1).alias("between"), matches.alias("match"))
    each = pages.filter(F.col(html).isNotNull()).select(id, F.posexplode(both).alias("n", "x")).filter("x.match IS NOT NULL")
    w = Window.partitionBy(id).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("x.match")
    end = F.sum(F.length("x.between") + length).over(w)
    return each.select(id, "n", (end - length).alias("start"), end.alias("end"), F.col("x.match").alias("match"))


def dated_links(pages: DataFrame, id: str, url: str, html: str) -> DataFrame:
    """S-14: id, day, url, title: days written in a page's text, each with the link nearest to it.

    A link counts if it has an address (none within the page, no script) and a label of 12 characters, and if all of it is at
    most 1500 characters before the day or after it. Nearest is the one that holds the day, else the one whose nearer edge
    is the fewest characters from the day's start, the earlier of two. Written days that C-01 does not read (a month first,
    "1er") are none. An address is given once a page, with its first day. Pages
    without html give nothing; ids are unique.

    Days and links of a page are sorted into one sequence, and each day looks at the link before it and at that after it, so
    the work grows with the page and not with pairs.
    """
    found = _places(pages, id, html, LINK)
    href, label = F.regexp_extract("match", LINK, 1), strip_html(F.regexp_extract("match", LINK, 2))
    links = found.select(id, "start", "end", href.alias("href"), label.alias("title"))
    links = links.filter(~F.col("href").startswith("#") & ~F.contains(F.lower("href"), F.lit("javascript:")) & (F.length("title") >= LEAST_LABEL))
    days = _places(pages, id, html, WRITTEN_DAY).select(id, "start", "end", parse_date(F.col("match")).alias("day"))
    link = F.struct("start", "end", "href", "title")
    line = links.select(id, "start", F.lit(0).alias("kind"), F.lit(None).cast("date").alias("day"), F.lit(None).cast("bigint").alias("until"), link.alias("link")).unionByName(
        days.filter("day IS NOT NULL").select(id, "start", F.lit(1).alias("kind"), "day", F.col("end").alias("until"), F.lit(None).cast(links.select(link.alias("l")).schema["l"].dataType).alias("link"))
    )
    before = Window.partitionBy(id).orderBy("start", "kind")
    after = Window.partitionBy(id).orderBy(F.desc("start"), F.desc("kind"))
    line = line.withColumns({"prev": F.last("link", ignorenulls=True).over(before), "next": F.last("link", ignorenulls=True).over(after)}).filter("kind = 1")

    def distance(near: str) -> Column:
        a, z = F.col(f"{near}.start"), F.col(f"{near}.end")
        gap = F.when(F.col("start").between(a, z), 0).otherwise(F.least(F.abs(a - F.col("start")), F.abs(z - F.col("start"))))
        return F.when((a >= F.col("start") - NEAR) & (z <= F.col("until") + NEAR), gap)

    back, ahead = distance("prev"), distance("next")
    nearest = F.when(back.isNotNull() & (ahead.isNull() | (back <= ahead)), F.col("prev")).when(ahead.isNotNull(), F.col("next"))
    told = line.select(id, "start", "day", nearest.alias("x")).filter("x IS NOT NULL").join(pages.select(id, F.col(url).alias("_base")), id)
    whole = told.select(id, "start", "day", absolute_url(F.col("_base"), F.col("x.href")).alias("url"), F.col("x.title").alias("title"))
    return whole.groupBy(id, "url").agg(F.min_by(F.struct("day", "title"), "start").alias("f")).select(id, "f.day", "url", "f.title")
