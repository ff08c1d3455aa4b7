"""Main text of HTML pages, with site templates found by counting element subtrees per host.

A first pass hashes the element subtrees of each page, each with what the page's text is without it; Spark counts these
rests per host and subtree. A subtree that recurs with several different rests stands in different articles: it is
template and is deleted. Copies of an article give one rest and count once, however many; near copies give rests that
share their smallest shingle. In an article, paragraphs, headings and the like are never taken for template. A second pass
parses each page again, drops template subtrees and everything that by its element, role or class is no article text, and
gives the blocks of what stays.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast

# Element names and the words of roles, classes and ids, as HTML and common site builders use them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template title iframe object embed applet canvas svg math audio video map nav footer aside "
    "form button select option textarea input fieldset dialog menu noframes noembed xmp".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split()
)
NOISE = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar ad ads adv "
    "advert adverts advertisement advertising adsense adbox adslot sponsor sponsored sponsors promo promotion banner cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations comment comments commentlist disqus reply replies respond pagination pager "
    "widget widgets copyright skip".split()
)
#: Headers belong to the page unless they stand in an article.
PAGE_HEAD = frozenset("header pageheader siteheader".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SELF_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",), "option": ("select",)}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <!\[CDATA\[.*?(?:\]\]>|\Z)
      | <[!?][^>]*+>?
      | <(?P<raw>script|style|noscript|template|textarea|title|iframe|noembed|noframes|xmp)\b
        (?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*+>|\Z)
      | <(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(?P<end2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.S | re.I | re.X,
)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_PART = re.compile(r"[A-Za-z][a-z]+|[A-Z]+|[a-z]+")


@dataclass
class Element:
    """An element with its children, which are elements and decoded strings."""

    tag: str
    attrs: dict[str, str]
    children: list = field(default_factory=list)

    #: Signed 64-bit hash of the subtree, once `_hash_subtrees` has run.
    hash: int = 0


def _hash_subtrees(root: Element) -> None:
    """Hashes of all subtrees, each from those of its children: names, and text with its white space collapsed."""
    order = [root]
    for e in order:
        order += [c for c in e.children if isinstance(c, Element)]
    for e in reversed(order):
        h = hashlib.blake2b(e.tag.encode(), digest_size=8)
        for c in e.children:
            if isinstance(c, str):
                h.update(b"\0" + " ".join(c.split()).encode("utf-8", "surrogatepass"))
            else:
                h.update(b"\1" + c.hash.to_bytes(8, "big", signed=True))
        e.hash = int.from_bytes(h.digest(), "big", signed=True)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def parse(page: str) -> Element:
    """The element tree of a page; anything malformed is read on as browsers would, at least roughly."""
    root = Element("#page", {})
    stack = [root]
    opened: Counter[str] = Counter()

    def close(tag: str, within: tuple[str, ...] = ()) -> None:
        if not opened[tag]:
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                opened.subtract(e.tag for e in stack[k:])
                del stack[k:]
                return
            if stack[k].tag in within:
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            stack[-1].children.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        tag = name.lower()
        if m["end"] or m["end2"]:
            close(tag)
            continue
        if tag in CLOSES_P:
            close("p", ("button", "td", "th", "object", "article", "section", "div"))
        if tag in SELF_CLOSING:
            close(tag, SELF_CLOSING[tag])
        attrs = m["attrs"] or m["attrs2"] or ""
        element = Element(tag, _attributes(attrs) if "=" in attrs or "hidden" in attrs else {})
        stack[-1].children.append(element)
        if tag not in VOID and not attrs.endswith("/"):
            stack.append(element)
            opened[tag] += 1
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def _is_main(e: Element) -> bool:
    return e.tag in ("article", "main") or e.attrs.get("role") in ("main", "article")


def _is_noise(e: Element, inside: bool) -> bool:
    """Whether an element is no article text by its name, role, class or id; `inside`: it stands in an article."""
    if e.tag in DROPPED:
        return True
    if not e.attrs:
        return e.tag == "header" and not inside
    if e.attrs.get("role", "").lower() in ROLES or "hidden" in e.attrs or e.attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", e.attrs.get("style", "")):
        return True
    if e.tag in ("html", "body", "main"):
        return False
    words = {w.lower() for k in ("class", "id") for w in _PART.findall(e.attrs.get(k, ""))}
    if words & NOISE:
        return True
    return not inside and (e.tag == "header" or bool(words & PAGE_HEAD))


def _rests(root: Element) -> list[tuple[int, int, int, int]]:
    """kind, subtree, rest, sketch of a page: what its article text is without each subtree that may be template.

    kind 0 is the page as a whole, 1 a PROSE element outside an article, 2 any other element. `rest` adds up hashes of the
    blocks that are left, `sketch` is the smallest hash of their five-word shingles. Noise is left out, as in `_kept`.
    """
    blocks: list[tuple[int, str]] = []
    spans: dict[int, list[tuple[int, int]]] = {}
    kinds: dict[int, int] = {}
    open_text: list[str] = []

    def end(part: int) -> None:
        text = " ".join("".join(open_text).split())
        open_text.clear()
        if text:
            blocks.append((part, text))

    _hash_subtrees(root)
    # Open elements, each with its children to come, whether it is in an article, its part and the blocks before it.
    frames: list[tuple] = [(iter(root.children), root, False, 0, 0)]
    while frames:
        children, e, inside, part, first = frames[-1]
        for c in children:
            if isinstance(c, str):
                open_text.append(c)
                continue
            if _is_noise(c, inside):
                continue
            if c.tag == "br":
                open_text.append(" ")
                continue
            role = c.attrs.get("role")
            of = 2 if "article" in (c.tag, role) else max(part, 1) if "main" in (c.tag, role) else part
            if c.tag not in INLINE:
                end(part)
            frames.append((iter(c.children), c, inside or _is_main(c), of, len(blocks)))
            break
        else:
            frames.pop()
            if e is root or e.tag in INLINE:
                continue
            end(part)
            prose = e.tag in PROSE
            if e.children and not _is_main(e) and e.tag not in ("html", "body") and not (inside and prose):
                spans.setdefault(e.hash, []).append((first, len(blocks)))
                kinds[e.hash] = 1 if prose else 2
    end(0)
    # The text is that of the articles, else of the main part, else all.
    part = max((k for k, _ in blocks), default=0)
    hashes, sketches = [0], []
    for k, (of, text) in enumerate(blocks):
        digest = 0
        if of == part:
            digest = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
            words = text.encode("utf-8", "surrogatepass").split()
            sketches.append((min(zlib.crc32(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))), k))
        hashes.append(hashes[-1] + digest)
    sketches.sort()

    def signed(x: int) -> int:
        return (x + 2**63) % 2**64 - 2**63

    out = [(0, 0, signed(hashes[-1]), sketches[0][0] if sketches else -1)]
    for subtree, found in spans.items():
        starts = [i for i, _ in found]

        def outside(k: int) -> bool:
            at = bisect_right(starts, k) - 1
            return at < 0 or found[at][1] <= k

        rest = hashes[-1] - sum(hashes[j] - hashes[i] for i, j in found)
        sketch = next((x for x, k in sketches if outside(k)), -1)
        out.append((kinds[subtree], subtree, signed(rest), sketch))
    return out


def _kept(root: Element, template: frozenset[int]) -> Element:
    """The tree without noise and template subtrees."""
    if template:
        _hash_subtrees(root)
    top = Element(root.tag, root.attrs)
    frames = [(iter(root.children), top, False)]
    while frames:
        children, out, inside = frames[-1]
        for c in children:
            if isinstance(c, str):
                out.children.append(c)
                continue
            if _is_noise(c, inside):
                continue
            within = inside or _is_main(c)
            known = c.children and c.hash in template and c.tag not in INLINE and not _is_main(c) and c.tag not in ("html", "body")
            if known and not (within and c.tag in PROSE):
                continue
            copy = Element(c.tag, c.attrs)
            out.children.append(copy)
            frames.append((iter(c.children), copy, within))
            break
        else:
            frames.pop()
    return top


def _mains(root: Element, tags: tuple[str, ...]) -> list[Element]:
    """The outermost elements of these names or roles, in page order."""
    found, ahead = [], [root]
    while ahead:
        e = ahead.pop()
        if e is not root and (e.tag in tags or e.attrs.get("role") in tags):
            found.append(e)
        else:
            ahead += [c for c in reversed(e.children) if isinstance(c, Element)]
    return found


def _blocks(root: Element) -> list[str]:
    """Texts of the blocks below an element, in page order."""
    out, open_text = [], []

    def end() -> None:
        text = " ".join("".join(open_text).split())
        open_text.clear()
        if text:
            out.append(text)

    frames = [(iter(root.children), True)]
    while frames:
        children, block = frames[-1]
        for c in children:
            if isinstance(c, str):
                open_text.append(c)
            elif c.tag == "br":
                open_text.append(" ")
            else:
                if c.tag not in INLINE:
                    end()
                frames.append((iter(c.children), c.tag not in INLINE))
                break
        else:
            frames.pop()
            if block:
                end()
    return out


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """Article text of a page: of its articles, else of its main part, else of all that is left."""
    if not page:
        return ""
    tree = _kept(parse(page), template)
    for tags in (("article",), ("main",)):
        text = "\n".join(b for e in _mains(tree, tags) for b in _blocks(e))
        if text:
            return text
    return "\n".join(_blocks(tree))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without port and www., null where there is none."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), r"^www\.", "")
    return F.when(host != "", host)


def site_templates(pages: DataFrame, min_pages: int = 4, min_share: float = 0.2, min_apart: float = 0.1) -> DataFrame:
    """host, template array<long>: subtrees that stand in at least `min_pages` different articles of a host.

    Articles differ if what their pages hold besides the subtree has another smallest shingle, so that copies and near
    copies count once; among very many near copies a few have another, so a subtree of whose different rests less than
    `min_apart` have one of their own is not template. Headings, cells, paragraphs and the like outside an article must
    stand in `min_share` of the host's articles besides, as different articles repeat short ones.

    `pages` has host and html. Pages without a host have no templates.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("subtree", pa.int64()), ("rest", pa.int64()), ("sketch", pa.int64())]))
        for batch in batches:
            out = []
            for page in batch.column("html").to_pylist():
                out.append([dict(zip(("kind", "subtree", "rest", "sketch"), x, strict=True)) for x in _rests(parse(page))])
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, kind)], ["host", "found"])

    rows = pages.select("host", "html").filter(F.col("host").isNotNull() & F.col("html").isNotNull())
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    hosts = measured_broadcast(cut(hosts))
    rows = rows.join(hosts.select("host"), "host", "left_semi")
    kind = "array<struct<kind:int,subtree:bigint,rest:bigint,sketch:bigint>>"
    found = rows.mapInArrow(run, f"host string, found {kind}").select("host", F.inline("found"))
    # One row per rest, then per sketch, then per subtree: no group holds all pages of a hot host.
    by = ["host", "kind", "subtree"]
    rests = found.groupBy(*by, "rest", "sketch").agg(F.lit(1).alias("one"))
    articles = rests.groupBy(*by, "sketch").agg(F.count(F.lit(1)).alias("versions"))
    counts = articles.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("versions").alias("versions"))
    counts = cut(counts.filter(F.col("n") >= min_pages))
    total = measured_broadcast(cut(counts.filter("kind = 0").select("host", F.col("n").alias("articles"))))
    often = counts.filter((F.col("kind") > 0) & (F.col("n") >= min_apart * F.col("versions"))).join(total, "host", "left")
    often = often.filter((F.col("kind") == 2) | (F.col("n") >= min_share * F.coalesce("articles", F.lit(0))))
    return often.groupBy("host").agg(F.collect_set("subtree").alias("template"))


def extract_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 4,
    min_share: float = 0.2,
) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars.

    Blocks are trimmed, joined by a line feed, and white space within them is one space. Null and empty pages have no
    text. Repeated rows repeat and, like copies of an article, count once among a host's articles. Elements can be nested
    to any depth. An empty table gives an empty result.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    pages = pages.withColumn("host", host_of(F.col("url")))
    templates = cut(site_templates(pages, min_pages, min_share))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True)
            text = [main_text(page, frozenset(template or ())) for page, template in pairs]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.join(measured_broadcast(templates), "host", "left").select("page_id", "url", "html", "template")
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
