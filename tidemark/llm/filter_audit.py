r"""Interaction of document filters under every order, as one product of incidence matrices.

What a document does under all 120 orders of five filters depends on nothing but the set of filters it fails: a mask of
five bits. So documents are counted by part and mask (rows of 32 integers, one for all documents, one for each label), and
these rows are multiplied by 32-by-600 matrices of zeros and ones, a column for each order and step. Only one row of
counts a part is left of the table when the product is made; blocks of parts are multiplied side by side.

Identical texts are told by 128 bits of SHA-256. They are counted by text and part before anything is shuffled by text,
so a text that makes up a third of the table is a handful of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MASKS, STEPS = 1 << len(FILTERS), len(FILTERS)
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = r"[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@dataclass(frozen=True)
class Matrices:
    """Orders, and integer matrices of a row for each mask and a column for each (order, step)."""

    orders: tuple[str, ...]
    kept: np.ndarray
    removed: np.ndarray
    redundant: np.ndarray
    unique: np.ndarray
    shapley: np.ndarray


@lru_cache(maxsize=1)
def matrices() -> Matrices:
    """The outcomes of every mask at every step of every order; bit i of a mask says that filter i fails."""
    orders = tuple("".join(p) for p in permutations(FILTERS))
    at = np.array([[FILTERS.index(c) for c in o] for o in orders])  # order, step -> filter
    bit = 1 << at
    before = np.cumsum(bit, axis=1) - bit
    mask = np.arange(MASKS)[:, None, None]
    fails, earlier = (mask & bit) > 0, (mask & before) > 0
    flat = lambda x: x.reshape(MASKS, -1).astype(np.int64)
    removed = flat(fails & ~earlier)
    # column f: how many orders, at any step, let filter f be the one that removes a document of the mask
    by_filter = np.zeros((MASKS, len(FILTERS)), dtype=np.int64)
    np.add.at(by_filter.T, at.reshape(-1), removed.T)
    return Matrices(
        orders, flat((mask & (before | bit)) == 0), removed, flat(fails & earlier), flat((mask == bit) & fails), by_filter[:, at.reshape(-1)]
    )


def text_failures(text: Column, words: Column) -> Column:
    """The bits of filters A to D; `words` are the text's words."""
    n, chars = F.size(words), F.length(text)
    checks = (
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * (chars - F.length(F.translate(text, UPPER, ""))).cast("long") > 3 * chars.cast("long"),
        text.rlike(SYMBOLS),
    )
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(checks)), F.lit(0))


def failure_counts(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """part, mask, good, toxic, n: documents by the filters they fail and the labels they have."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    )
    split = rows.withColumn("words", F.filter(F.split("text", SPACE, -1), lambda w: w != ""))
    digest = F.unhex(F.substring(F.sha2("text", 256), 1, 32))
    failed = split.select("doc_id", "part", text_failures(F.col("text"), F.col("words")).alias("fails"), digest.alias("twin"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    known = known.filter("good or toxic")
    # rows without an id have no label; salted by their text they are no hot key of the join
    lone = failed.filter("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    labelled = failed.filter("doc_id is not null").join(known, "doc_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}
    )
    # copies of one row stand together, so the count at a text's smallest id can be taken with min_by
    kind = ["twin", "part", "fails", "good", "toxic"]
    copies = labelled.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n")).unionByName(
        lone.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    )
    texts = copies.groupBy(kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    smallest = F.min("first").over(Window.partitionBy("twin"))
    # an id that is null is not larger than any other
    unlike = F.col("n_null") + F.when(F.col("first") == smallest, F.col("n_first")).otherwise(0)
    parted = texts.withColumn("unlike", unlike).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("fails").alias("mask"), F.col("unlike").alias("n")),
            F.struct((F.col("fails") + (1 << 4)).alias("mask"), (F.col("n") - F.col("unlike")).alias("n")),
        )).alias("v"),
    )
    return parted.groupBy("part", "good", "toxic", "v.mask").agg(F.sum("v.n").alias("n")).filter("n > 0").select(
        "part", "mask", "good", "toxic", "n"
    )


def histograms(counts: DataFrame) -> DataFrame:
    """part, and rows of MASKS counts: all, good, toxic."""

    def row(of: Column) -> list[Column]:
        return [F.sum(F.when(of & (F.col("mask") == m), F.col("n")).otherwise(0)) for m in range(MASKS)]

    kinds = {"all": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    return counts.groupBy("part").agg(*[F.array(*row(of)).alias(name) for name, of in kinds.items()])


def audit_filters(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", block: int = 64
) -> DataFrame:
    """part, filter_order, step and the counts of COUNTS: 600 rows for each value of `part_col`.

    Null texts are empty, a null part is the empty string. E compares whole texts over the whole table: a row fails it if
    another row of equal text has a smaller id, so rows that repeat an id and its text fail it together or not at all, and
    rows without an id never. Repeated rows count each time. A document is good (toxic) if any label row of its id says 1;
    null labels say nothing. `labels` has doc_id, quality, toxic. Other columns of either table are not looked at. An
    empty table gives no rows, an empty table of labels no good or toxic ones. `block` parts are multiplied together.
    """
    schema = f"part string, filter_order string, step int, {', '.join(f'{c} bigint' for c in COUNTS)}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matrices()
        orders = np.repeat(np.array(m.orders, dtype=object), STEPS)
        steps = np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(m.orders))
        for batch in batches:
            for low in range(0, batch.num_rows, block):
                piece = batch.slice(low, block)
                n = piece.num_rows
                every, good, toxic = (
                    np.asarray(piece.column(c).flatten(), dtype=np.int64).reshape(n, MASKS) for c in ("all", "good", "toxic")
                )
                products = (
                    every @ m.kept, every @ m.removed, every @ m.redundant, every @ m.unique,
                    good @ m.removed, toxic @ m.removed, every @ m.shapley,
                )
                columns = [
                    pa.array(np.repeat(np.array(piece.column("part").to_pylist(), dtype=object), len(steps)), pa.string()),
                    pa.array(np.tile(orders, n), pa.string()),
                    pa.array(np.tile(steps, n), pa.int32()),
                    *[pa.array(x.reshape(-1), pa.int64()) for x in products],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *COUNTS])

    counts = failure_counts(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    return histograms(counts).mapInArrow(run, schema)
