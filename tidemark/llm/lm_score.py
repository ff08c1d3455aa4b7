"""Language-model scoring by subword lattices.

The pieces of an existing subword vocabulary span a lattice over each word; the probability of a word is the sum over all
its segmentations, by a forward recursion in log space. The vocabulary's scores are the first piece weights; expected
counts over the training words (two forward-backward rounds) adapt them to each class of texts. A word that training
texts of a class have seen is also an arc of its own, with an absolutely discounted count, and what the discount frees is
the lattice's share:

    P(word | class) = max(c - d, 0) / N + d * types / N * sum over segmentations of the product of piece weights

A text's probability is the sum over all classes of the class's share, times those of its words, times that of its end,
so a text's own class is no part of its score: equal texts score alike. Classes come from a column of `docs` (languages
here) and are read from training rows only; rows without one are a class too.

Texts stay where they are read. Tasks cut them into chunks of one class, whose words become numbers, and write two
tables: packed chunks, and one row per chunk and distinct word. Only the second is shuffled by word, to count words over
all documents and to run each lattice once, under all classes; the numbers come back to their chunks by word.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.lattice import Lattice, pieces_of, rank_log_probs
from tidemark.session import scratch_path

VOCABULARY = "piece_bpe_32k.model"
#: Tokens that a chunk holds; a longer text is a chunk of its own.
CHUNK_TOKENS = 1_500_000
#: Words whose lattices run together.
BATCH_WORDS = 100_000
#: Bytes of words that run together, beyond what one Arrow batch brings.
BATCH_BYTES = 8 << 20
DISCOUNT = 0.6
_CHUNK = "kind int, class string, chunk bigint, word binary, at int, c bigint, blob binary"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    import io

    import zstandard as zstd

    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstd.ZstdCompressor(level=1).compress(out.getvalue())


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    import io

    import zstandard as zstd

    with np.load(io.BytesIO(zstd.ZstdDecompressor().decompress(blob))) as z:
        return dict(z)


class _Chunk:
    """Texts of one class whose words are numbered as they come."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.train: list[bool] = []
        self.ids: list[str | None] = []
        self.tokens = 0

    def add(self, doc_id: str | None, words: list[bytes], train: bool) -> None:
        numbers = self.numbers
        got = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint32, len(words))
        self.rows.append(np.sort(got))
        self.train.append(train)
        self.ids.append(doc_id)
        self.tokens += len(words)

    def written(self) -> tuple[bytes, np.ndarray]:
        """The packed texts, and how often each word stands in training texts."""
        n = np.array([len(r) for r in self.rows], np.int64)
        flat = np.concatenate([*self.rows, np.zeros(0, np.uint32)])
        train = np.repeat(np.array(self.train, bool), n)
        counts = np.bincount(flat[train], minlength=len(self.numbers))
        # Sorted numbers as differences: mostly small, so they pack well.
        steps = np.diff(flat.astype(np.int64), prepend=0).astype(np.int32)
        ids = np.frombuffer(json.dumps(self.ids).encode(), np.uint8)
        return _pack({"n": n, "steps": steps, "ids": ids}), counts


def _chunked(rows: DataFrame, limit: int) -> DataFrame:
    """kind 0: a packed chunk; kind 1: a chunk's word, its number and training count. `rows`: doc_id, class, train, text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[str | None, _Chunk] = {}
        numbers = itertools.count(TaskContext.get().partitionId() << 32)

        def closed(name: str | None) -> Iterator[pa.RecordBatch]:
            chunk = open_chunks.pop(name)
            blob, counts = chunk.written()
            key = next(numbers)
            words = list(chunk.numbers)
            n = len(words)
            yield _record([0], [name], [key], [None], [None], [chunk.tokens], [blob])
            for i in range(0, n, 50_000):
                part = words[i : i + 50_000]
                k = len(part)
                yield _record(np.ones(k, np.int32), [name] * k, np.full(k, key), part, np.arange(i, i + k, dtype=np.int32), counts[i : i + k], [None] * k)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "class", "train", "text")]
            for doc_id, name, train, text in zip(*columns, strict=True):
                chunk = open_chunks.setdefault(name, _Chunk())
                chunk.add(doc_id, text.encode().lower().split(), train)
                if chunk.tokens >= limit:
                    yield from closed(name)
            if sum(c.tokens for c in open_chunks.values()) > 2 * limit:
                yield from closed(max(open_chunks, key=lambda k: open_chunks[k].tokens))
        for name in list(open_chunks):
            yield from closed(name)

    def _record(kind, name, chunk, word, at, c, blob) -> pa.RecordBatch:  # noqa: ANN001
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary())
        values = (kind, name, chunk, word, at, c, blob)
        names = ["kind", "class", "chunk", "word", "at", "c", "blob"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    return rows.mapInArrow(run, _CHUNK)


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH_WORDS rows, fewer where words are long."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BATCH_WORDS or sum(b.nbytes for b in held) >= BATCH_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _seen(by: pa.Array, classes: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place of class, training count) of all classes that have a word in training."""
    flat = by.flatten()
    count = flat.field("c").to_numpy()
    row = np.repeat(np.arange(len(by)), np.diff(by.offsets.to_numpy()))
    kind = pc.index_in(flat.field("class"), value_set=pa.array(classes, pa.string())).to_numpy(zero_copy_only=False)
    on = count > 0
    return row[on], kind[on].astype(np.int64), count[on]


def _adapted(counts: DataFrame, pieces: list[bytes], start: np.ndarray, classes: list[str | None], rounds: int) -> np.ndarray:
    """Log piece weights by class, from expected counts over the distinct training words of each class."""
    weights = np.tile(start, (len(classes), 1))
    for _ in range(rounds):

        def run(batches: Iterable[pa.RecordBatch], now: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(pieces)
            total = np.zeros_like(now)
            for batch in _grouped(batches):
                words = batch.column("word").to_pylist()
                row, kind, _ = _seen(batch.column("by"), classes)
                for k in np.unique(kind):
                    part = [words[i] for i in row[kind == k]]
                    total[k] += lattice.expected_counts(part, np.ones(len(part)), now[k])
            k, used = np.nonzero(total > 1e-12)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(used), pa.array(total[k, used])], ["k", "piece", "uses"])

        uses = counts.select("word", "by").mapInArrow(run, "k bigint, piece bigint, uses double")
        # Classes times pieces bound what comes back.
        total = np.full_like(weights, 1e-2)
        for r in uses.groupBy("k", "piece").agg(F.sum("uses").alias("uses")).collect():
            total[r.k, r.piece] += r.uses
        weights = np.log(total / total.sum(axis=1, keepdims=True))
    return weights


def score_texts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str | None = "lang",
    train: Column | None = None,
    model_file: str | None = None,
    rounds: int = 2,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the text under A-Z lower case, then one end. `train`, a condition on the id, says which rows
    are learned from (all by default). Null and blank texts are just an end. Repeated rows repeat and are learned from as
    often; without training rows every count is 0 and the lattices keep the vocabulary's own weights. An empty table
    gives an empty result. Ids come back in their own type. Classes should be few, as languages are: the driver holds a
    row for each, and a text is weighed under every one.
    """
    pieces, scores = pieces_of(model_file or vocabulary_path())
    start = rank_log_probs(scores)
    spark = docs.sparkSession
    id_type = docs.select(F.col(id_col)).schema[0].dataType
    name = F.col(class_col).cast("string") if class_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), name.alias("class"))
    learned = F.coalesce(train if train is not None else F.lit(True), F.lit(True))
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "class", learned.alias("train"), "text")

    path = scratch_path(spark, "lm-chunks")
    _chunked(rows, chunk_tokens).write.parquet(path)
    words = spark.read.schema(_CHUNK).parquet(path).filter("kind = 1")
    counts = words.select("word", "class", "c").repartition("word").groupBy("word", "class").agg(F.sum("c").alias("c"))
    counts = counts.groupBy("word").agg(F.sum("c").alias("all"), F.collect_list(F.struct("class", "c")).alias("by"))
    count_path = scratch_path(spark, "lm-words")
    counts.write.parquet(count_path)
    counts = spark.read.schema("word binary, all bigint, by array<struct<class: string, c: bigint>>").parquet(count_path)

    each = counts.filter("all > 0").select(F.inline("by")).filter("c > 0")
    per_class = {r["class"]: r for r in each.groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("types")).collect()}
    ends = {r["class"]: r.n for r in rows.filter("train").groupBy("class").agg(F.count("*").alias("n")).collect()}
    whole = counts.filter("all > 0").agg(F.coalesce(F.sum("all"), F.lit(0)), F.count("*")).first()
    end_count = sum(ends.values())
    n_all, types = whole[0] + end_count, whole[1] + (end_count > 0)
    base_over = n_all + 0.1 * (types + 1)
    classes = list(ends) or [None]
    seen_words = counts.filter("all > 0")
    weights = _adapted(seen_words, pieces, start, classes, rounds if whole[0] else 0)
    # by class: training tokens (ends too), log of the lattice's share, log of class and end
    over, log_share, log_end = (np.full(len(classes), v) for v in (1.0, math.log(0.5), math.log(0.5)))
    for i, k in enumerate(classes if end_count else []):
        seen, n_texts = per_class.get(k), ends[k]
        n = (seen.n if seen else 0) + n_texts
        over[i] = n
        log_share[i] = math.log(DISCOUNT * max(seen.types if seen else 0, 1) / n)
        log_end[i] = math.log((n_texts - DISCOUNT) / n * n_texts / end_count)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Log probabilities of each word, one per class."""
        lattice = Lattice(pieces)
        for batch in _grouped(batches):
            part, every = batch.column("word"), batch.column("all").to_numpy()
            logs = lattice.log_likelihood(part.to_pylist(), weights) + log_share
            row, kind, count = _seen(batch.column("by"), classes)
            logs[row, kind] = np.logaddexp(logs[row, kind], np.log((count - DISCOUNT) / over[kind]))
            base = np.log10((every + 0.1) / base_over)
            limits = np.arange(len(part) + 1, dtype=np.int32) * len(classes)
            packed = pa.ListArray.from_arrays(pa.array(limits), pa.array(logs.astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([part, pa.array(every > 0), pa.array(base), packed], ["word", "known", "base", "logs"])

    table = counts.mapInArrow(scored, "word binary, known boolean, base double, logs array<float>")
    back = words.select("word", "chunk", "at").join(table, "word").drop("word")
    chunks = spark.read.schema(_CHUNK).parquet(path).filter("kind = 0").select(F.col("chunk").alias("chunk0"), "blob")
    base_end = math.log10((end_count + 0.1) / base_over)

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        known, base, logs = np.zeros(len(at)), np.zeros(len(at)), np.zeros((len(at), len(classes)), np.float32)
        known[at] = right.column("known").to_numpy(zero_copy_only=False)
        base[at] = right.column("base").to_numpy()
        logs[at] = right.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, len(classes))
        out = []
        for blob in left.column("blob").to_pylist():
            packed = _unpack(blob)
            n, flat = packed["n"], np.cumsum(packed["steps"].astype(np.int64))
            limits = np.r_[0, np.cumsum(n)]

            def total(values: np.ndarray, flat: np.ndarray = flat, limits: np.ndarray = limits) -> np.ndarray:
                return np.diff(np.r_[0.0, np.cumsum(values[flat], dtype=float)][limits])

            score = np.full(len(n), -np.inf)
            for k in range(len(classes)):
                score = np.logaddexp(score, total(logs[:, k]) + log_end[k])
            columns = {
                "doc_id": pa.array(json.loads(packed["ids"].tobytes()), pa.string()), "n_tokens": n + 1,
                "n_known": np.rint(total(known)).astype(np.int64) + (end_count > 0),
                "base_score": total(base) + base_end, "score": score / math.log(10),
            }
            out.append(pa.table(columns))
        return pa.concat_tables(out)

    kind = "doc_id string, n_tokens bigint, n_known bigint, base_score double, score double"
    found = chunks.groupBy("chunk0").cogroup(back.groupBy("chunk")).applyInArrow(joined, kind)
    return found.select(
        F.col("doc_id").cast(id_type).alias("doc_id"), "n_tokens", "n_known",
        F.lit(int(n_all)).cast("long").alias("train_tokens"), "base_score", "score",
    )
