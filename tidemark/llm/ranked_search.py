r"""Ranked lexical search over postings stored by term bucket, with integer scores.

`build_index` reads every text once and writes postings (term_bucket, term, doc_id, twin, n, tf) as Parquet, partitioned by
term bucket straight from the tasks that read the texts: nothing is shuffled. A document also has one row of its own
(term null, bucket -1) with its length. `search` reads only the buckets its terms lie in, joins the terms of the items,
scores each match, sums by item and document, and ranks. Matches of common words are by far the most rows; postings are
therefore dealt by document once, before items multiply them, so that the sum needs no other shuffle and each task keeps
only the first `k` of an item before the last exchange.

A document is known by doc_id, a 64-bit hash of its text (`twin`) and its length, so rows that share an id stay apart.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.decontaminate import LOWER, UPPER
from tidemark.llm.decontaminate import TERM as ITEM_TERM
from tidemark.session import cut, measured_broadcast, scratch_path

#: A term, in UTF-8 after A-Z are lower-cased: digits, letters and every byte of a non-ASCII character.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
LONGEST = (1 << 63) - 1
#: Postings that leave a task's Python side together.
FLUSH = 1 << 18


@dataclass(frozen=True)
class SearchIndex:
    """Where the postings lie, how many buckets they have, and the totals over all documents."""

    spark: SparkSession
    path: str
    buckets: int
    n_docs: int
    n_terms: int
    schema: T.StructType

    def postings(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term), F.lit(buckets)).cast("int")


def postings_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, twin, n, term, tf: each document's terms, and one row with a null term for the document itself."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("text <> ''")
    rows = rows.withColumn("twin", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = batch.column("doc_id"), batch.column("twin")
            terms: list[bytes | None] = []
            tfs: list[int] = []
            at: list[int] = []
            sizes: list[int] = []
            lengths: list[int] = []

            def flush() -> pa.RecordBatch:
                where = pa.array(np.repeat(np.array(at, dtype=np.int64), sizes))
                columns = [
                    ids.take(where), twins.take(where), pa.array(np.repeat(np.array(lengths, dtype=np.int64), sizes)),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64()),
                ]
                for held in (terms, tfs, at, sizes, lengths):
                    held.clear()
                return pa.RecordBatch.from_arrays(columns, ["doc_id", "twin", "n", "term", "tf"])

            for i, text in enumerate(batch.column("text")):
                counts = Counter(TERM.findall(text.as_py().encode().lower()))
                if not counts:
                    continue
                n = counts.total()
                terms.append(None)
                terms.extend(counts)
                tfs.append(n)
                tfs.extend(counts.values())
                at.append(i)
                sizes.append(len(counts) + 1)
                lengths.append(n)
                if len(terms) >= FLUSH:
                    yield flush()
            yield flush()

    return rows.mapInArrow(run, f"doc_id {kind}, twin bigint, n bigint, term string, tf bigint")


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = 16, path: str | None = None) -> SearchIndex:
    """Postings of all terms of all rows of `docs`, written once under the shared folder or at `path`.

    Null and empty texts, and texts of separators alone, have no terms and are no documents. Rows that repeat an id and
    its text are documents of their own. Other columns of `docs` are not looked at. Give large splits to a large table:
    each task writes one file a bucket.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "postings")
    bucket = F.when(F.col("term").isNull(), -1).otherwise(bucket_of(F.col("term"), buckets))
    made = postings_of(docs, id_col, text_col).withColumn("term_bucket", bucket)
    made.write.option("maxConcurrentOutputFileWriters", buckets + 1).partitionBy("term_bucket").parquet(path)
    stored = spark.read.schema(made.schema).parquet(path)
    n_docs, n_terms = stored.filter("term_bucket = -1").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return SearchIndex(spark, path, buckets, n_docs, n_terms, made.schema)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, item_twin, term, times: the terms of each item; rows that repeat an item and its text count once."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(ITEM_TERM), 0)
    words = rows.select("item_id", F.xxhash64("text").alias("item_twin"), F.explode(terms).alias("term"))
    return words.groupBy("item_id", "item_twin", "term").agg(F.count(F.lit(1)).alias("times"))


def weigh_terms(index: SearchIndex, terms: DataFrame) -> DataFrame:
    """term_bucket, term, tid, weight of each of `terms` that the index holds; tid is a number for the term."""
    asked = terms.select("term").distinct().withColumn("term_bucket", bucket_of(F.col("term"), index.buckets))
    asked = cut(asked)
    found = index.postings().join(measured_broadcast(asked), ["term_bucket", "term"])
    df = found.groupBy("term_bucket", "term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * index.n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    return cut(df.select("term_bucket", "term", F.monotonically_increasing_id().alias("tid"), weight.alias("weight")))


def _posting_scores(index: SearchIndex, weighted: DataFrame, part: Column) -> DataFrame:
    """tid and points of every posting of the weighted terms: weight * ((10**9 * tf) div (1000 * tf + 8 * m)), with
    m = 25 + (75 * n * n_docs) div n_terms. Integers only; a product beyond 64 bits is taken in decimals."""
    docs, total = index.n_docs, max(1, index.n_terms)
    long_enough = LONGEST // (75 * max(1, docs))
    m = F.expr(
        f"""25 + CASE WHEN n <= {long_enough}L THEN (75L * n * {docs}L) DIV {total}L
            ELSE CAST((75BD * CAST(n AS DECIMAL(19, 0)) * CAST({docs}L AS DECIMAL(14, 0))) DIV {total}BD AS BIGINT) END"""
    )
    hits = index.postings().filter(part).join(measured_broadcast(weighted), ["term_bucket", "term"])
    points = F.expr("weight * ((1000000000L * tf) DIV (1000L * tf + 8L * m))")
    return hits.withColumn("m", m).select("doc_id", "twin", "n", "tid", points.alias("points"))


def _scored(index: SearchIndex, weighted: DataFrame, asking: DataFrame, repeats: DataFrame, part: Column) -> DataFrame:
    """item_id, item_twin, doc_id, score, copies: the sum over each item's terms, times included, for each document."""
    key = ["doc_id", "twin", "n"]
    dealt = _posting_scores(index, weighted, part).repartition(*key)
    matched = dealt.join(measured_broadcast(asking), "tid")
    sums = matched.groupBy("item_id", "item_twin", *key).agg(F.sum(F.col("points") * F.col("times")).alias("score"))
    # the postings of c copies of a row have met under one key
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    found = sums.alias("s").join(measured_broadcast(repeats).alias("r"), same, "left")
    return found.select("item_id", "item_twin", "s.doc_id", F.coalesce("copies", F.lit(1)).alias("copies"), "score").select(
        "item_id", "item_twin", "doc_id", "copies", F.expr("score DIV copies").alias("score")
    )


def _first(scored: DataFrame, k: int) -> DataFrame:
    """The first `k` of each item, copies and all, with their rank."""
    item = Window.partitionBy("item_id", "item_twin").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = scored.withColumn("rank", F.row_number().over(item)).filter(F.col("rank") <= k)
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(k), F.col("copies").cast("int")))))
    return each.withColumn("rank", F.row_number().over(item)).filter(F.col("rank") <= k)


def search(
    index: SearchIndex, items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", k: int = 10, probe: int = 32
) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best documents of each item with score above 0, ties by ascending doc_id.

    A term weighs floor(1000 * ln((2N + 2) / (2 df + 1))). Items that are null, empty or without a known term have no
    rows; rows that repeat an item's id and text rank once, items that share an id but not the text rank apart. Repeated
    documents rank as often as they are there; a null doc_id comes last among ties. An empty index gives no rows.

    One document in `probe` is ranked first: the k-th score found there bounds the k-th of all from below, so all else
    that scores less is dropped before the ranking sorts anything. The bound never drops a row of the result.
    """
    terms = cut(item_terms(items, id_col, text_col))
    weighted = weigh_terms(index, terms)
    asking = cut(terms.join(measured_broadcast(weighted), "term").select("tid", "item_id", "item_twin", "times"))
    docs = index.postings().filter("term_bucket = -1")
    repeats = docs.groupBy("doc_id", "twin", "n").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    repeats = cut(repeats)
    probed = _first(_scored(index, weighted, asking, repeats, F.pmod("twin", F.lit(probe)) == 0).filter("score > 0"), k)
    least = probed.groupBy("item_id", "item_twin").agg(F.count(F.lit(1)).alias("held"), F.min("score").alias("least"))
    least = cut(least.filter(F.col("held") >= k).select("item_id", "item_twin", "least"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}")) for c in ("item_id", "item_twin")]
    scored = _scored(index, weighted, asking, repeats, F.lit(True)).alias("s")
    scored = scored.join(measured_broadcast(least).alias("l"), same, "left").filter("score > 0 and score >= coalesce(least, 1)")
    return _first(scored.select("s.*"), k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
