"""Search, filter audit and BPE against plain versions and the library, on the smallest tables and on odd rows; ids of text."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_documents import SCHEMA, odd_rows
from tidemark.llm import bpe
from tidemark.llm import queries as Q
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.filter_audit import COUNTS, audit_filters
from tidemark.llm.lexicon import Lexicon, compile_lexicon
from tidemark.llm.ranked_search import build_index, search
from tidemark.llm.warc import plan_records, read_warc, write_warc
from tidemark.session import TABLES, scratch_path, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op11_search", "op12_filter_audit"])
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = Q.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({Q.ORACLE_SQL[name]})").fetchall())


def plain_search(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    terms = [(d, TERM.findall((t or "").translate(FOLD))) for d, t in docs]
    terms = [(d, w) for d, w in terms if w]
    n_docs, n_terms = len(terms), sum(len(w) for _, w in terms)
    df = Counter(x for _, w in terms for x in set(w))
    counted = [(d, len(w), Counter(w)) for d, w in terms]
    out = []
    for item, text in sorted(set(items), key=str):
        found = []
        for d, n, tf in counted:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m))
                for x in TERM.findall((text or "").translate(FOLD)) if tf[x]
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def test_search_equals_a_plain_version_on_odd_rows(spark, odd):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    items = [(1, "One two three w1 w1 W2 日本"), (2, None), (3, ""), (4, "zzz"), (1, "id here"), (1, "id here"), (None, "ünï çödé w7"), (5, "one one")]
    asked = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, term string")
    got = search(build_index(odd, buckets=3), asked, probe=2).collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=str) == plain_search(docs, items)


def test_search_breaks_ties_by_id_and_ranks_copies_as_often_as_they_are_there(spark):
    docs = [(i, "alpha beta") for i in range(30, 0, -1)] + [(5, "alpha beta"), (None, "alpha beta"), (40, "gamma")] + [(50 + i, "delta") for i in range(40)]
    items = [(1, "alpha alpha beta"), (2, "gamma")]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = search(build_index(df), asked).collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=str) == plain_search(docs, items)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank) if r.item_id == 1] == [1, 2, 3, 4, 5, 5, 6, 7, 8, 9]


def test_search_of_empty_tables(spark, odd, none):
    asked = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert search(build_index(none), asked).collect() == []
    assert search(build_index(odd), asked.limit(0)).collect() == []


def plain_audit(docs: list[tuple], labels: list[tuple]) -> dict:
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    firsts: dict[str, int] = {}
    for d, text, _ in docs:
        if d is not None:
            firsts[text or ""] = min(d, firsts.get(text or "", d))
    rows = []
    for d, text, lang in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {
            f for f, bad in zip(
                "ABCDE",
                (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)),
                 d is not None and firsts[t] < d), strict=True,
            ) if bad
        }
        rows.append((lang or "", fails, d is not None and d in good, d is not None and d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        total = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for i, f in enumerate(order):
                before = set(order[:i])
                here = [r for r in mine if f in r[0] and not r[0] & before]
                total[f] += len(here)
                out[part, order, i + 1] = [
                    sum(not r[0] & (before | {f}) for r in mine), len(here), sum(f in r[0] and bool(r[0] & before) for r in mine),
                    sum(r[0] == {f} for r in mine), sum(r[1] for r in here), sum(r[2] for r in here), f,
                ]
        for key, v in out.items():
            if key[0] == part:
                v[6] = total[v[6]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_a_plain_version_on_odd_rows(spark, odd):
    rng = random.Random(9)
    more = [(100 + i, rng.choice(["A B", "a#b " * 150, "w " * 300, None, "", " ".join(f"x{j}" for j in range(250))]), rng.choice(["en", None, ""])) for i in range(60)]
    rows = spark.createDataFrame(more + more[:5] + [(None, "A B", "en"), (None, "A B", "en")], "doc_id long, text string, lang string")
    docs = odd.select("doc_id", "text", "lang").unionByName(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(12), *range(100, 160), 3, 4, 101]] + [(None, 1, 1)]
    marked = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = audit_filters(docs.withColumn("good", F.lit(1)), marked, block=2).collect()
    want = plain_audit([tuple(r) for r in docs.collect()], labels)
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in got} == want and len(got) == len(want)


def test_audit_of_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(none, labels).collect() == []
    assert all(r.good_lost == r.toxic_lost == 0 for r in audit_filters(odd, labels).collect())


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(bpe.vocabulary_path())
    made.no_truncation()
    made.no_padding()
    return made


def test_every_character_splits_as_in_the_library(library):
    split = library.pre_tokenizer.pre_tokenize_str
    for c in [*range(0xD800), *range(0xE000, 0x3400), *range(0x10000, 0x11000), *range(0x1E900, 0x1FB00), *range(0xE000, 0x10000)]:
        text = f"a{chr(c)}{chr(c)}1{chr(c)}! {chr(c)} b"
        assert bpe.words_of(text) == [text[a:b] for _, (a, b) in split(text)], hex(c)


def test_texts_encode_and_decode_as_in_the_library(spark, sf_dir, odd, library):
    rng = random.Random(11)
    odd_texts = [
        "<|endoftext|>", "a <|endoftext|><|endoftext|> b<|endoftext", "it's we'll 'S  \t\n x  ", "a" * 5000, "ab" * 3000 + " é" * 50, "\x1c\x1f\x85 　 x",
        "".join(chr(rng.choice([*range(32, 127), *range(0x80, 0xD800, 37), *range(0x10000, 0x20000, 97)])) for _ in range(4000)), "👩‍👩‍👧 ﬁ ½ Ⅷ ٣ ",
    ]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd_texts)], "doc_id long, text string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(extra)
    decoded = bpe.decode_ids(bpe.encode_texts(docs, bpe.build_lexicon(docs, max_words=700))).collect()
    texts = [r.text or "" for r in docs.collect()]
    want = Counter()
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        want[tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((tuple(r.ids), r.text) for r in decoded) == want
    assert Counter(r.text for r in decoded) == Counter(texts)


def test_bpe_query_equals_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = Q.op13_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *digests)


def test_decoding_of_any_ids(spark, library):
    rng = random.Random(2)
    lists = [[rng.randrange(50257) for _ in range(40)] for _ in range(200)] + [[], [50256], [220, 127, 160]]
    rows = [(i, x) for i, x in enumerate(lists)] + [(-1, None), (-2, [-5, 60000, None, 64])]
    got = {r.doc_id: r.text for r in bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)} | {-1: "", -2: library.decode([64])}


def test_bpe_of_empty_tables(spark, odd, none):
    path = bpe.build_lexicon(none)
    assert bpe.encode_texts(none, path).collect() == []
    assert bpe.decode_ids(bpe.encode_texts(odd, path)).count() == odd.count()


@pytest.mark.parametrize("seed", range(4))
def test_lexicon_is_minimal_and_exact(tmp_path, seed):
    rng = random.Random(seed)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))): tuple(rng.randrange(4) for _ in range(rng.randint(0, 5))) for _ in range(400)}
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(sorted(words.items())))
    lexicon = Lexicon(str(path))
    for word in map(bytes, itertools.chain.from_iterable(itertools.product(b"abcd", repeat=n) for n in range(6))):
        assert lexicon.find(word) == (list(words[word]) if word in words else None)
    # as few states as there are distinct residual functions once the common prefix of outputs has been emitted
    behind = defaultdict(dict)
    for word, ids in words.items():
        for i in range(len(word) + 1):
            behind[word[:i]][word[i:]] = ids

    def residual(found: dict) -> frozenset:
        n = min(len(x) for x in found.values())
        first = next(iter(found.values()))
        shared = next((i for i in range(n) if any(x[i] != first[i] for x in found.values())), n)
        return frozenset((suffix, x[shared:]) for suffix, x in found.items())

    kinds = {residual(found) for prefix, found in behind.items() if prefix}
    assert lexicon.states == len(kinds | {frozenset(behind[b""].items())})


def test_lexicon_wants_sorted_words():
    with pytest.raises(ValueError):
        compile_lexicon([(b"b", (1,)), (b"a", (2,))])


def test_text_ids_of_vectors(spark):
    rows = [("b", [1.0, 0.0], 1), ("a", [1.0, 0.01], 1), ("c", [0.0, 1.0], 1), (None, [1.0, 0.0], 1), ("d", None, 1), ("e", [1.0, 0.0], None)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id string, embedding array<double>, label int")).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {
        ("b", 1, "a", False), ("a", 1, "a", True), ("c", 0, "c", True), (None, 0, None, True), ("d", 0, "d", True), ("e", 0, "e", True),
    }


def test_text_ids_of_archives(spark):
    rows = [("x>1\r\n", "u", "same"), ("y 2%", "u", "same"), ("z", None, None)]
    path = scratch_path(spark, "warc-test")
    write_warc(plan_records(spark.createDataFrame(rows, "page_id string, url string, html string")), path)
    got = {(r.page_id, r.record_type, r.refers_to) for r in read_warc(spark, path, "string").collect()}
    assert got == {("x>1\r\n", "revisit", "y 2%"), ("y 2%", "response", None), ("z", "response", None)}


def test_stages_pass_on_columns_of_any_name(spark, odd, sf_dir):
    out = corpus_pipeline.secrets(spark, odd, sf_dir)
    assert out.columns == odd.columns
    rows = out.collect()
    assert len(rows) == odd.count() and all(r.found == r.row == r.score == "clash" for r in rows)
    hit = next(r for r in rows if r.doc_id == 10)
    assert hit.text == "[SECRET] and [SECRET] [SECRET]" and hit.n_chars == len(hit.text)
    kept = corpus_pipeline.decontamination(spark, odd, sf_dir)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert corpus_pipeline.secrets(spark, odd.limit(0), sf_dir).count() == 0
