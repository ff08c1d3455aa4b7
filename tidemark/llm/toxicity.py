"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Fitting. In labelled training rows every word is counted by its distinct left neighbours in toxic and in ordinary texts
(copies of a text add no neighbours). Words far more often in toxic text, by likelihood ratio, are the samples of the
toxic dictionary; the commonest words of ordinary text, to the same number of bytes, are those of the ordinary one.

Scoring. A text is cut into windows of one word, whatever its length; no part of a text is left out. A window, repeated a few times so that entropy headers weigh little, is
compressed with either dictionary. It is a hit if the toxic dictionary brings it down to at most `most` bytes and to at
least `gain` bytes less than the ordinary one. Both thresholds are calibrated on labelled rows, as is the probability
for each number of hits, with dictionaries that those rows had no part in: either half of the labelled rows is scored with
dictionaries of the other half. Equal windows of a task are compressed once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast

BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Hits are told apart up to this number.
LEVELS = 6
#: Thresholds that calibration tries: bytes under the toxic dictionary, and bytes gained by it.
GRID = tuple((most, gain) for most in range(15, 22) for gain in range(2, 7))
_REPEAT, _PAD = 4, b"\x01" * 32


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries, the hit thresholds and P(toxic) for 0, 1, ... LEVELS hits."""

    toxic: bytes
    ordinary: bytes
    most: int = 17
    gain: int = 3
    chance: tuple[float, ...] = field(default=(0.1,) * (LEVELS + 1))

    def lengths(self) -> WindowLengths:
        return WindowLengths(self.toxic, self.ordinary)


class WindowLengths:
    """Compressed lengths of a word's window under both dictionaries; made once per task."""

    def __init__(self, toxic: bytes, ordinary: bytes, limit: int = 300_000) -> None:
        import zstandard as zstd

        settings = zstd.ZstdCompressionParameters(
            window_log=17, chain_log=12, hash_log=12, search_log=5, min_match=5, target_length=32,
            strategy=zstd.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        self._by = []
        for content in (toxic, ordinary):
            made = zstd.ZstdCompressionDict(content + _PAD, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=settings)
            self._by.append(zstd.ZstdCompressor(dict_data=made, compression_params=settings))
        self._known: dict[bytes, tuple[int, int]] = {}
        self._limit = limit

    def __call__(self, word: bytes) -> tuple[int, int]:
        found = self._known.get(word)
        if found is None:
            window = (b" " + word) * (_REPEAT if len(word) <= 64 else 1) + b" "
            found = tuple(len(c.compress(window)) for c in self._by)
            if len(self._known) >= self._limit:
                self._known.clear()
            self._known[word] = found
        return found


def windows_of(text: str | None) -> list[bytes]:
    """The windows of a text in order: its words, the short ones too."""
    return _WORD.findall(text.encode().lower()) if text else []


def _training_labels(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """doc_id, y of at most `max_labelled` labelled documents, chosen by hash; a document's largest label counts."""
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    rows = rows.filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)


def _g2(c: Column, o: Column, all_c: Column, all_o: Column) -> Column:
    """Log-likelihood ratio of counts c of all_c against o of all_o."""
    share = (c + o) / (all_c + all_o)
    part = F.when(c > 0, c * F.log(c / (all_c * share))).otherwise(0.0)
    return 2.0 * (part + F.when(o > 0, o * F.log(o / (all_o * share))).otherwise(0.0))


def word_support(texts: DataFrame) -> DataFrame:
    """word, half, toxic, ordinary: distinct left neighbours of each word in texts (`text`, `y`, `half`) of either label."""
    pieces = F.filter(F.split(F.lower("text"), BREAK, -1), lambda w: w != "")
    words = texts.select("y", "half", pieces.alias("w"))
    pairs = F.transform("w", lambda w, i: F.struct(w.alias("word"), F.when(i > 0, F.get("w", i - 1)).alias("left")))
    rows = words.select("y", "half", F.explode(pairs).alias("p")).select("y", "half", "p.word", "p.left").distinct()
    return rows.groupBy("word", "half").agg(
        F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("ordinary")
    )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = 20_000,
    max_words: int = 1_000,
    min_g2: float = 20.0,
    min_ratio: float = 8.0,
) -> ToxicityModel:
    """Dictionaries and thresholds from at most `max_labelled` labelled rows for which `train` (on doc_id) holds.

    `max_words` bounds the dictionaries. Without toxic or without ordinary rows no window is a hit and every text gets
    the share of toxic rows, 0 where there are none at all.
    """
    chosen = _training_labels(labels.filter(train) if train is not None else labels, id_col, label_col, max_labelled)
    chosen = cut(chosen)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    texts = texts.withColumn("half", F.crc32(F.concat(F.lit("half:"), F.col("doc_id").cast("string"))) % 2)
    texts = cut(texts.join(measured_broadcast(chosen, max_labelled), "doc_id"))
    support = cut(word_support(texts))
    n, positive = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    whole = support.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    model = _dictionaries(whole, max_words, min_g2, min_ratio)
    if model is None or positive in (0, n):
        base = positive / n if n else 0.0
        return ToxicityModel(b" ", b" ", most=0, chance=(base,) * (LEVELS + 1))
    seen: list[tuple[int, list[int]]] = []
    for half in (0, 1):
        other = _dictionaries(support.filter(F.col("half") == 1 - half), max_words, min_g2, min_ratio)
        mine = texts.filter(F.col("half") == half)
        seen += [(r.y, r.hits) for r in _hits_by_threshold(mine, other or model).collect()]
    return _calibrated(model, seen)


def _dictionaries(support: DataFrame, max_words: int, min_g2: float, min_ratio: float) -> ToxicityModel | None:
    """Both dictionaries from the words of one part of the labelled rows; none if either would be empty."""
    longer = F.octet_length("word") > 3
    sums = support.agg(F.sum("toxic").alias("all_c"), F.sum("ordinary").alias("all_o"))
    rated = support.filter(longer).join(F.broadcast(sums)).withColumn(
        "g2", _g2(F.col("toxic"), F.col("ordinary"), F.col("all_c"), F.col("all_o"))
    )
    ratio = F.col("toxic") * F.col("all_o") >= min_ratio * F.col("ordinary") * F.col("all_c")
    good = rated.filter((F.col("toxic") >= 3) & ratio & (F.col("g2") >= min_g2))
    good_words = [r.word for r in good.orderBy(F.desc("g2"), "word").limit(max_words).collect()]
    common = support.filter(longer & (F.col("ordinary") > 0)).orderBy(F.desc("ordinary"), "word")
    common_words = [r.word for r in common.limit(4 * max_words).collect()]
    if not good_words or not common_words:
        return None
    # The last bytes of a dictionary are the cheapest to reach, so the strongest words come last.
    toxic = b" " + b" ".join(w.encode() for w in reversed(good_words)) + b" "
    ordinary = b" " + b" ".join(w.encode() for w in reversed(common_words)) + b" "
    return ToxicityModel(toxic, ordinary[-len(toxic):])


def _calibrated(model: ToxicityModel, seen: list[tuple[int, list[int]]]) -> ToxicityModel:
    """The thresholds with the best F1 of "any hit", and smoothed P(toxic) by hits, made non-decreasing."""
    best = (-1.0, 0)
    for k in range(len(GRID)):
        right = sum(1 for y, h in seen if y and h[k])
        told, true = sum(1 for _, h in seen if h[k]), sum(y for y, _ in seen)
        best = max(best, (2 * right / max(1, told + true), -k))
    k = -best[1]
    base = sum(y for y, _ in seen) / len(seen)
    n, positive = [0] * (LEVELS + 1), [0] * (LEVELS + 1)
    for y, h in seen:
        n[min(LEVELS, h[k])] += 1
        positive[min(LEVELS, h[k])] += y
    chance: list[float] = []
    for a, b in zip(positive, n, strict=True):
        here = (a + base) / (b + 1.0)
        chance.append(max(here, chance[-1]) if chance else here)
    return ToxicityModel(model.toxic, model.ordinary, *GRID[k], tuple(chance))


def _hits_by_threshold(texts: DataFrame, model: ToxicityModel) -> DataFrame:
    """y, hits: number of windows that are hits under each pair of GRID."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = model.lengths()
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                counts = [0] * len(GRID)
                for window, n in Counter(windows_of(text)).items():
                    toxic, ordinary = lengths(window)
                    if toxic <= GRID[-1][0] and ordinary - toxic >= GRID[0][1]:
                        for k, (most, gain) in enumerate(GRID):
                            counts[k] += n * (toxic <= most and ordinary - toxic >= gain)
                out.append(counts)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(out, pa.list_(pa.int32()))], ["y", "hits"])

    return texts.select("y", "text").mapInArrow(run, "y int, hits array<int>")


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_windows, n_hits, score in 0 to 1.

    Whole texts are read; null and empty texts have no windows and get the score of texts without hits. Repeated rows
    repeat; an empty table gives an empty result.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = model.lengths()
        for batch in batches:
            windows, hits, scores = [], [], []
            for text in batch.column("text").to_pylist():
                n = hit = 0
                for window, times in Counter(windows_of(text)).items():
                    n += times
                    toxic, ordinary = lengths(window)
                    hit += times * (toxic <= model.most and ordinary - toxic >= model.gain)
                windows.append(n)
                hits.append(hit)
                low = model.chance[min(LEVELS, hit)]
                # within a level, denser hits come first
                scores.append(low + (1.0 - low) * 0.01 * hit / (n + 1.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(windows, pa.int64()), pa.array(hits, pa.int64()), pa.array(scores, pa.float64())],
                ["doc_id", "n_windows", "n_hits", "score"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_windows bigint, n_hits bigint, score double")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts
