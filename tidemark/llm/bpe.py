r"""Byte-level BPE encoding and decoding with a lexicon of the corpus's frequent words.

Spark counts the words (pre-tokens) of all texts; the most frequent are merged once and compiled into a minimal acyclic
transducer with id outputs, written to the shared folder, handed to every executor and memory-mapped there. Tasks look
words up in it; words it does not hold are merged exactly, by the vocabulary's ranks. The lexicon only saves merges: what
it holds never changes a result.

Vocabulary files stay where they are installed; their path is a parameter and must be readable on every machine.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.lexicon import Lexicon, compile_lexicon
from tidemark.session import cut, scratch_path

VOCABULARY = "byte_bpe_50k.json"
#: The split pattern of byte-level vocabularies, a fixed value, for a class of letters, of numbers and of spaces.
SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{letter}{number}{space}]+|[{space}]+(?![^{space}])|[{space}]+"
#: Blocks in which no Unicode version changes what is a letter or number; the last holds neither. Texts with other
#: characters are split by the library itself.
SURE = r"\x00-\u0557\u0600-\u0887\u0900-\u0BFF\u0E00-\u0FFF\u1E00-\u206F\u20A0-\u2BFF\u3000-\uA6FF\uAC00-\uD7A3\uE000-\uFFEF\U0001F300-\U0001FAFF"
UNSURE = re.compile(f"[^{SURE}]")
#: Words of a task counted, or kept with their ids, before they are sent on or forgotten; longer words are not kept.
HELD, KEPT_CHARS = 200_000, 64
#: The rank of a pair that does not merge.
NO_RANK = 1 << 62
#: Ids that leave a task's Python side together.
FLUSH = 1 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on in order."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(256, 512))
    return [chr(b if b in plain else next(shifted)) for b in range(256)]


class Vocabulary:
    """Merges and ids of a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids, back = stored["model"]["vocab"], {c: b for b, c in enumerate(byte_characters())}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in stored["model"]["merges"])
        self.start = [ids[c] for c in byte_characters()]
        pairs = list(pairs)
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        size = 1 + max(tokens)
        known = (tokens.get(i, "") for i in range(size))
        plain = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in known]
        self.table = pa.array([*plain, b""], pa.binary())
        longest = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.special_at = regex.compile("(" + "|".join(longest) + ")") if longest else None

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word: the pair of the lowest rank first, the leftmost of equal ones. n log n for n bytes."""
        ids = [self.start[b] for b in word]
        if len(ids) <= KEPT_CHARS:
            return self._merge_short(ids)
        rank_of, end = self.ranks.get, len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        queue = [(r, i) for i, pair in enumerate(pairwise(ids)) if (r := rank_of(pair, NO_RANK)) < NO_RANK]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= end or rank_of((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (r := rank_of((ids[i], ids[k]), NO_RANK)) < NO_RANK:
                    heapq.heappush(queue, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of((ids[h], ids[i]), NO_RANK)) < NO_RANK:
                heapq.heappush(queue, (r, h))
        return [x for x in ids if x >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The same for few bytes, with the ranks of all pairs in a list instead of a queue."""
        rank_of = self.ranks.get
        ranks = [rank_of(pair, NO_RANK) for pair in pairwise(ids)]
        while ranks and (best := min(ranks)) < NO_RANK:
            i = ranks.index(best)
            ids[i] = self.made[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), NO_RANK)
        return ids

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; what is no token is skipped, bytes that are no UTF-8 become U+FFFD."""
        ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        # the last entry of the table is empty
        at = np.where((ids >= 0) & (ids < len(self.table) - 1), ids, len(self.table) - 1)
        ends = np.cumsum(np.concatenate([[0], np.asarray(lists.value_lengths().fill_null(0))]), dtype=np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), self.table.take(pa.array(at))), b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([raw.decode("utf-8", "replace") for raw in joined.to_pylist()], pa.string())


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def _splits() -> tuple[Callable, Callable]:
    """Splitters of texts in sure blocks, and of all others."""
    from tokenizers.pre_tokenizers import ByteLevel

    def members(category: str) -> str:
        """The sure characters of a category, for a character class: a plain class is matched faster than a property."""
        runs: list[list[int]] = []
        for c in range(0x10000):
            if not UNSURE.match(chr(c)) and regex.match(category, chr(c)):
                if runs and runs[-1][1] == c - 1:
                    runs[-1][1] = c
                else:
                    runs.append([c, c])
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)

    classes = {"letter": members(r"\p{L}"), "number": members(r"\p{N}"), "space": members(r"\s")}
    return re.compile(SPLIT.format(**classes)).findall, ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str


def words_of(text: str) -> list[str]:
    """The pre-tokens of a text without special tokens; joined they are the text."""
    sure, other = _splits()
    if not text.isascii() and UNSURE.search(text):
        return [text[a:b] for _, (a, b) in other(text)]
    return sure(text)


def _parts(vocabulary: Vocabulary, text: str) -> list[str]:
    """Ordinary stretches and special tokens by turns."""
    return vocabulary.special_at.split(text) if vocabulary.special_at else [text]


def word_counts(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """word, n: pre-tokens of at most KEPT_CHARS characters in all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        known = _vocabulary(vocabulary)

        def flush() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) <= KEPT_CHARS]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column("text"):
                for part in _parts(known, text.as_py() or "")[::2]:
                    held.update(words_of(part))
                if len(held) >= HELD:
                    yield flush()
        yield flush()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame, *, text_col: str = "text", vocabulary: str | None = None, max_words: int = 200_000, path: str | None = None
) -> str:
    """Path of the compiled lexicon of the most frequent words of all texts, at most `max_words`.

    Counts cover all texts. Words are taken by classes of counts (eight a doubling), the highest first, while a class fits
    whole, so no task ranks words and the driver gets a few hundred sums and the chosen words alone. `max_words` bounds
    the file, not what can be encoded. It is written through Spark's file system to `path`, by default under the shared
    folder.
    """
    spark, vocabulary = docs.sparkSession, vocabulary or vocabulary_path()
    level = F.floor(8 * F.log2("n")).cast("int").alias("level")
    counted = cut(word_counts(docs, vocabulary, text_col).filter("n > 1").select("word", level))
    least, taken = 1 << 30, 0
    for row in counted.groupBy("level").count().orderBy(F.desc("level")).collect():
        taken += row["count"]
        if taken > max_words:
            break
        least = row["level"]
    frequent = counted.filter(F.col("level") >= least)
    known = _vocabulary(vocabulary)
    words = sorted(r.word.encode() for r in frequent.select("word").collect())
    path = path or scratch_path(spark, "lexicon")
    _write_file(spark, path, compile_lexicon((w, tuple(known.merge(w))) for w in words))
    return path


def _write_file(spark: SparkSession, path: str, data: bytes) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


@lru_cache(maxsize=2)
def _mapped(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


@lru_cache(maxsize=1)
def _looked_up(name: str) -> dict[str, bytes]:
    """Ids of the words that tasks of this process have found in a lexicon: no more than it holds, so none is forgotten."""
    return {}


def encode_texts(
    docs: DataFrame, lexicon: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """doc_id, ids array<int>: one row per row of `docs`, whole texts, without special tokens around them.

    Strings of special tokens inside a text are those tokens. Null and empty texts have no ids; repeated rows repeat; an
    empty table gives an empty result; other columns are not looked at. A word of any length is merged whole.
    """
    spark, vocabulary = docs.sparkSession, vocabulary or vocabulary_path()
    spark.sparkContext.addFile(lexicon)
    name = lexicon.rsplit("/", 1)[-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mapped = _vocabulary(vocabulary), _mapped(name)
        found, held = _looked_up(name), {}

        def ids_of(word: str) -> bytes:
            raw = word.encode()
            ids = mapped.find(raw) if len(word) <= KEPT_CHARS else None
            made = array("i", known.merge(raw) if ids is None else ids).tobytes()
            if ids is not None:
                found[word] = made
            elif len(word) <= KEPT_CHARS:
                if len(held) >= HELD:
                    held.clear()
                held[word] = made
            return made

        for batch in batches:
            done: list[bytes] = []
            first = total = 0

            def flush(upto: int) -> pa.RecordBatch:
                ends = np.cumsum([0, *(len(x) // 4 for x in done)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(done), dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                done.clear()
                return pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, upto - first), lists], ["doc_id", "ids"])

            for i, text in enumerate(batch.column("text")):
                pieces: list[bytes] = []
                for k, part in enumerate(_parts(known, text.as_py() or "")):
                    if k % 2:
                        pieces.append(np.int32(known.special[part]).tobytes())
                    else:
                        pieces += [found.get(w) or held.get(w) or ids_of(w) for w in words_of(part)]
                done.append(b"".join(pieces))
                total += len(done[-1])
                if total >= 4 * FLUSH:
                    yield flush(i + 1)
                    first, total = i + 1, 0
            if done:
                yield flush(batch.num_rows)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids, text: the text of each row's ids, special tokens included.

    A null list gives an empty text and stays null; null entries and numbers that are no token are skipped; bytes that are
    no UTF-8 become U+FFFD. Repeated rows repeat; an empty table gives an empty result.
    """
    vocabulary = vocabulary or vocabulary_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _vocabulary(vocabulary)
        for batch in batches:
            lists = batch.column("ids")
            # tokens before each row; a row of more than FLUSH ids is a piece of its own
            ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64))
            first = 0
            while first < batch.num_rows:
                most = (ends[first - 1] if first else 0) + FLUSH
                upto = max(first + 1, int(np.searchsorted(ends, most, side="right")))
                piece = batch.slice(first, upto - first)
                yield pa.RecordBatch.from_arrays([*piece.columns, known.decode_lists(piece.column("ids"))], ["doc_id", "ids", "text"])
                first = upto

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
