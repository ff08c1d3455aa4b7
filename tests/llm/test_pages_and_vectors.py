"""WARC round trips, HTML extraction, embedding groups, the pipeline and the SQL twins."""

from __future__ import annotations

import base64
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import queries as Q
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.html_text import _rests, extract_text, main_text, parse
from tidemark.llm.warc import plan_records, read_warc, write_warc
from tidemark.session import TABLES, scratch_path, table


# SQL twins


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_sql_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = Q.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({Q.ORACLE_SQL[name]})").fetchall()

    def plain(rows):
        return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)

    assert plain(df.select(columns).collect()) == plain(wanted)


# WARC

MAGIC = "WARC/1.1\r\n"


def fake_record(body: str) -> str:
    return f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"


def test_warc_magic_inside_payloads(spark):
    rng = random.Random(2)
    html = {
        1: "<p>plain</p>", 2: fake_record("inner"), 3: "x" + fake_record("inner") * 3 + MAGIC, 4: None, 5: "", 6: "<p>plain</p>", 7: MAGIC,
        8: "ünï\r\n\r\ncode " * 1000, 9: "\r\n\r\n" + MAGIC + "\r\n\r\n", 10: fake_record("inner"), 11: "Content-Length: 5\r\n\r\n",
    }
    html |= {100 + i: "".join(rng.choice(["a", "\r\n", MAGIC, "é", " "]) for _ in range(rng.randrange(50))) for i in range(60)}
    df = spark.createDataFrame([(k, f"http://h{k}.org/a\r\nb", v) for k, v in html.items()], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    write_warc(plan_records(df), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # records and payloads over many splits
    try:
        got = {r.page_id: r for r in read_warc(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    top: dict[bytes, int] = {}
    for k, v in html.items():
        top[(v or "").encode()] = max(k, top.get((v or "").encode(), k))
    assert set(got) == set(html)
    for k, v in html.items():
        raw = (v or "").encode()
        r = got[k]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if top[raw] == k else ("revisit", top[raw]))
        assert r.url == f"http://h{k}.org/a%0D%0Ab"


def test_warc_odd_rows(spark):
    rows = [(None, None, None, "c"), (None, "u", "x", "c"), (3, "u", "x", "c"), (3, "u", "x", "c"), (4, None, "x", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    path = scratch_path(spark, "warc-test")
    write_warc(plan_records(df), path)
    assert read_warc(spark, path).count() == len(rows)
    empty = scratch_path(spark, "warc-test")
    write_warc(plan_records(df.limit(0)), empty)
    assert read_warc(spark, empty).count() == 0


# HTML


def test_main_text_drops_what_is_no_article():
    page = """<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a>Menu</a></nav>
      <article><h1>Title &amp; more</h1><p>First   <b>para</b>graph,<br>two&nbsp;lines.</p><ul><li>one<li>two</ul>
      <script>x="<p>no</p>"</script><div class="ad-slot">Buy</div><div id="comments">Nice!</div><form>Mail</form></article>
      <aside>Side</aside><footer>Foot</footer></body></html>"""
    assert main_text(page) == "Title & more\nFirst paragraph, two lines.\none\ntwo"
    assert main_text(None) == main_text("") == ""
    assert main_text("<p>open <i>and never closed") == "open and never closed"


@pytest.mark.parametrize("tag", ["div", "span", "b", "ul><li", "table><tr><td"])
def test_deep_markup_ends(tag):
    opened = f"<{tag}>" * 100_000
    assert main_text(opened + "x") == "x"
    assert main_text("<article>" + opened + "x</b>" * 50_000, frozenset([1])).startswith("x")
    assert _rests(parse("<article>" + opened + "x"))[0][0] == 0


def test_repeated_pages_are_no_template(spark):
    page = "<html><body><article><div><h1>A</h1><ul><li>one</li><li>two</li></ul></div></article></body></html>"
    rows = [(i, "http://s.example/a", page) for i in range(8)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"A\none\ntwo"}


def test_templates_are_found_by_host(spark):
    rows = [(i, f"http://www.a.org/{i}", f"<body><div><span>Same words all over</span></div><div>Own words {i}</div></body>") for i in range(8)]
    rows += [(9, "http://b.org/1", "<body><div><span>Same words all over</span></div></body>"), (10, None, "<p>no host"), (11, "x", None), (None, None, None)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extract_text(df).collect()}
    assert all(got[i].text == f"Own words {i}" for i in range(8))
    assert got[9].text == "Same words all over" and got[10].text == "no host" and got[11].text == ""
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extract_text(df.limit(0)).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    body = "<div><h2>Same head</h2><ul><li>one<li>two</ul><ol><li>three</ol><table><tr><td>four</table><section>Five words of one section</section></div>"
    words = [f"word{k}" for k in range(200)]

    def near(i):
        return " ".join([*words[:i], f"new{i}", *words[i + 1 :]])

    rows = [("copies", f"<body><nav>{i}</nav><article>{body}</article></body>") for i in range(40)]
    rows += [("bare", f"<body><div>Menu of the site</div>{body}<p>The end</p></body>") for i in range(40)]
    rows += [("bare", f"<body><div>Menu of the site</div><div>Other text {i}</div></body>") for i in range(40)]
    rows += [("near", f"<body><article>{body}<p>{near(i)}</p></article></body>") for i in range(100)]
    # A block on 5 % of a host's pages, all of other articles.
    rows += [("hot", f"<body><article>{'<div>Ask our shop</div>' * (i < 10)}<p>Article {i}</p></article></body>") for i in range(200)]
    df = spark.createDataFrame([(k, f"http://{h}.org/{k}", v) for k, (h, v) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    whole = "Same head\none\ntwo\nthree\nfour\nFive words of one section"
    for k, (h, v) in enumerate(rows):
        if h == "copies":
            assert got[k] == whole
        elif h == "bare":
            assert got[k] == (f"{whole}\nThe end" if body in v else f"Other text {k - 80}")
        elif h == "near":
            assert got[k] == f"{whole}\n{near(k - 120)}"
        else:
            assert got[k] == f"Article {k - 220}"


def test_html_query(spark, sf_dir):
    rows = Q.op10_html(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "pages").count()
    for r in rows:
        lines = r.text.split("\n")
        assert not r.text or all(x == " ".join(x.split()) and x for x in lines)


# embeddings


def random_vectors(n: int, dim: int, seed: int) -> dict:
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        if i and rng.random() < 0.5:
            base = out[rng.randrange(i)][1]
            v = [x + rng.gauss(0, rng.choice([0.0, 0.05, 0.2])) for x in base]
        else:
            v = [rng.gauss(0, 1) for _ in range(dim)]
        out[i] = (rng.randrange(3), [float(x) for x in v])
    return out


@pytest.mark.parametrize("cell_rows", [4096, 20])
def test_embedding_groups(spark, cell_rows):
    vectors = random_vectors(300, 6, 4)
    df = spark.createDataFrame([(k, v, label) for k, (label, v) in vectors.items()], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, cell_rows=cell_rows).collect()}
    assert got == brute.cosine_components(vectors, 0.98)


def test_embedding_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = {
        1: (1, [1.0, 0.0]), 2: (1, [2.0, 0.0]), 3: (2, [1.0, 0.0]), 4: (None, [1.0, 0.0]), 5: (1, None), 6: (1, [0.0, 0.0]), 7: (1, [nan, 1.0]),
        8: (1, [inf, 1.0]), 9: (1, [None, 1.0]), 10: (1, []), 11: (1, [1.0, 0.0, 0.0]), 12: (1, [1e300, 1e-300]), 13: (1, [1.0, 0.0]),
    }
    df = spark.createDataFrame([(k, v, label, "c") for k, (label, v) in vectors.items()], "vec_id long, embedding array<double>, label int, rep string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert len(got) == len(vectors)
    for k in (1, 2, 12, 13):
        assert got[k][:2] == (3, 1) and got[k][2] == (k == 1)
    for k in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert got[k] == (0, k, True)
    assert near_duplicates(df.limit(0)).count() == 0


# pipeline


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf_dir)
        path = scratch_path(spark, f"test-{name}")
        out.write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == columns
        before, after = {r.doc_id: r.text for r in kept.collect()}, {r.doc_id: r.text for r in out.collect()}
        gone = set(before) - set(after)
        assert set(after) <= set(before)
        if name == "near_duplicates":
            groups = brute.ngram_components(before)
            assert gone == {k for k, (_, c) in groups.items() if c != k}
        if name == "decontamination":
            items = {r.item_id: r.text for r in table(spark, sf_dir, "benchmark").collect()}
            assert gone == {k for k, v in brute.contamination(before, items).items() if v[-1]}
        if name == "secrets":
            assert not gone
            for k, text in after.items():
                assert not brute.base_secrets(text)
                assert (text == before[k]) == (corpus_pipeline.MARK not in (text or "")) or corpus_pipeline.MARK in (before[k] or "")
        else:
            assert all(before[k] == v for k, v in after.items())
        kept = out
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert last.count() == kept.count()


def test_stages_tell_rows_without_or_with_repeated_ids_apart(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")

    def kept(stage, rows):
        df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
        return sorted(((r.doc_id, r.text) for r in stage(spark, df, sf_dir).collect()), key=str)

    clean = "nothing of note stands here"
    labelled = docs.join(table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id").select("doc_id")
    after = corpus_pipeline.toxicity(spark, docs, sf_dir).select("doc_id")
    toxic = docs.join(labelled, "doc_id").join(after, "doc_id", "left_anti").orderBy("doc_id").first().text
    assert kept(corpus_pipeline.toxicity, [(None, toxic), (None, clean), (7, toxic), (7, clean)]) == [(7, clean), (None, clean)]

    item = max((r.text for r in table(spark, sf_dir, "benchmark").collect() if r.text), key=len)
    assert kept(corpus_pipeline.decontamination, [(None, item), (None, clean), (7, item), (7, clean)]) == [(7, clean), (None, clean)]

    words = [f"word{k}" for k in range(80)]
    one, near = " ".join(words), " ".join([*words, "more"])
    two, close = " ".join(reversed(words)), " ".join(["more", *reversed(words)])
    got = kept(corpus_pipeline.near_duplicates, [(None, one), (None, near), (3, two), (None, close), (5, two), (3, clean)])
    assert got == sorted([next(x for x in got if x[1] in (one, near)), (3, two), (3, clean)], key=str) and len(got) == 3


def test_masking(spark):
    found = "array<struct<s:bigint,e:bigint>>"
    rows = [("ab12cd34ef", [(2, 4), (3, 5), (6, 8)]), ("all", [(0, 3)]), ("none", []), (None, [])]
    df = spark.createDataFrame(rows, f"text string, found {found}").select(corpus_pipeline.masked(F.col("text"), F.col("found")).alias("m"))
    assert [r.m for r in df.collect()] == ["ab[SECRET]d[SECRET]ef", "[SECRET]", "none", None]
