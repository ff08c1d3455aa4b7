r"""Benchmark decontamination over a distributed positional inverted index, with DataFrame functions only.

Terms are runs of digits, lower-case letters and non-ASCII characters. One pass over the documents counts the terms that
the benchmark uses; every benchmark window is then represented by its rarest terms and their offsets. A second pass
stores postings (row, term, position) for those terms alone. Subtracting the offset from each posting turns the lists of
a window's rarest terms into lists of window starts: their intersection, rarest first, gives the candidates, and only
these are compared with the text word by word.

The index is keyed by Unicode lower case, a superset of equality under A-Z lower case, which the comparison decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast

#: What separates terms before case is folded: every ASCII character but digits and letters.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """The text's pieces between breaks; a break at either end gives an empty piece, which keeps its position."""
    return F.split(F.coalesce(text, F.lit("")), BREAK, -1)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a row key that tells repeated ids with other texts apart."""
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return out.withColumn("row", F.xxhash64("doc_id", "text"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """win (the words), words, items: the distinct windows of all items; an item below `width` words is one window."""
    words = F.filter(terms_of(F.translate(F.col(text_col), UPPER, LOWER)), lambda w: w != "")
    items = benchmark.select(F.col(id_col).alias("item"), words.alias("all")).filter(F.size("all") > 0)
    last = F.greatest(F.lit(1), F.size("all") - (width - 1))
    windows = items.select("item", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("all", i, width))).alias("words"))
    return windows.groupBy("words").agg(F.collect_set(F.col("item").cast("string")).alias("items")).select(
        F.array_join("words", " ").alias("win"), "words", "items"
    )


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """term, n: occurrences of each of `terms` in all documents."""
    tokens = docs.select(F.explode(terms_of(F.col(text_col))).alias("w")).select(F.lower("w").alias("term"))
    found = tokens.join(measured_broadcast(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_terms(windows: DataFrame, counts: DataFrame, keep: int = 2) -> DataFrame:
    """win, rank, term, offset: each window's `keep` rarest places, rank 1 the rarest."""
    places = windows.select("win", F.posexplode("words").alias("offset", "w")).withColumn("term", F.lower("w"))
    order = Window.partitionBy("win").orderBy("n", "offset")
    ranked = places.join(counts, "term").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= keep).select("win", "rank", "term", "offset")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """row, term, pos of every occurrence of `terms`; `docs` comes from `keyed`."""
    tokens = docs.select("row", F.posexplode(terms_of(F.col("text"))).alias("pos", "w"))
    return tokens.select("row", "pos", F.lower("w").alias("term")).join(measured_broadcast(terms), "term")


def phrase_candidates(index: DataFrame, rare: DataFrame) -> DataFrame:
    """row, win, start: starts on which the offset-adjusted lists of a window's rarest terms agree."""
    anchors = rare.groupBy("win").agg(F.max("rank").alias("last"))
    first = rare.filter("rank = 1").join(anchors, "win")
    starts = index.join(measured_broadcast(cut(first)), "term").select(
        "row", "win", "last", (F.col("pos") - F.col("offset")).alias("start")
    )
    starts = starts.filter("start >= 0")
    lone = starts.filter("last = 1")
    second = cut(rare.filter("rank = 2").select("win", "term", "offset"))
    wanted = starts.join(measured_broadcast(second), "win").select(
        "row", "win", "start", "term", (F.col("start") + F.col("offset")).alias("pos")
    )
    both = wanted.join(index, ["row", "term", "pos"])
    return both.select("row", "win", "start").unionByName(lone.select("row", "win", "start"))


def proximity_matches(index: DataFrame, rare: DataFrame, slop: int) -> DataFrame:
    """row, win, start, shift: the two rarest terms of a window stand at most `slop` places out of step.

    `start` is where the rarest term puts the window; shift 0 is what `phrase_candidates` gives. Neighbouring stretches
    of `slop` places share a join key, so no document's lists are paired in full.
    """
    step = max(1, slop)
    adjusted = index.join(measured_broadcast(cut(rare)), "term").select(
        "row", "win", "rank", (F.col("pos") - F.col("offset")).alias("start")
    )
    left = adjusted.filter("rank = 1").select("row", "win", "start", F.floor(F.col("start") / step).alias("cell"))
    near = F.explode(F.array(*[F.floor(F.col("start") / step) + d for d in (-1, 0, 1)]))
    right = adjusted.filter("rank = 2").select("row", "win", F.col("start").alias("other"), near.alias("cell"))
    shift = F.col("other") - F.col("start")
    pairs = left.join(right, ["row", "win", "cell"]).filter(F.abs(shift) <= slop)
    return pairs.select("row", "win", "start", shift.alias("shift"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 13,
) -> DataFrame:
    """One row per row of `docs`: doc_id, row, n_words, n_hit, items (sorted), hits array<struct<start, len, win>>.

    A word inside any occurrence of a benchmark window is hit. Null and empty texts have no words and no hits; empty
    items match nothing; repeated rows repeat; an empty table of either kind gives no hits.
    """
    docs = keyed(docs, id_col, text_col)
    windows = cut(benchmark_windows(benchmark, item_col, item_text_col, width))
    terms = cut(windows.select(F.explode("words").alias("w")).select(F.lower("w").alias("term")).distinct())
    rare = cut(rarest_terms(windows, cut(term_counts(docs, terms))))
    index = cut(postings(docs, cut(rare.select("term").distinct())))
    found = phrase_candidates(index, rare).join(measured_broadcast(windows), "win")
    spots = found.groupBy("row").agg(
        F.collect_list(F.struct("start", F.size("words").alias("len"), "win", "items")).alias("spots")
    )
    spots = cut(spots)
    texts = docs.join(measured_broadcast(spots.select("row").distinct()), "row", "left_semi")
    folded = texts.select("row", terms_of(F.translate(F.col("text"), UPPER, LOWER)).alias("w"))
    checked = folded.join(spots, "row").select(
        "row",
        F.filter(
            "spots", lambda s: F.array_join(F.slice("w", s["start"] + 1, s["len"]), " ") == s["win"]
        ).alias("hits"),
    )
    hits = checked.filter(F.size("hits") > 0).dropDuplicates(["row"]).select(
        "row",
        F.size(
            F.array_distinct(
                F.flatten(F.transform("hits", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
            )
        ).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("hits.items"))).alias("items"),
        F.transform("hits", lambda s: F.struct(s["start"], s["len"], s["win"])).alias("hits"),
    )
    n_words = F.coalesce(F.regexp_count(F.col("text"), F.lit(TERM)), F.lit(0)).cast("long")
    return (
        docs.select("doc_id", "row", n_words.alias("n_words"))
        .join(measured_broadcast(cut(hits)), "row", "left")
        .select(
            "doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hits",
        )
    )


def contamination_report(found: DataFrame, share: int = 20) -> DataFrame:
    """Digest of `decontaminate` output; contaminated: some word is hit, and at least 1 in `share`."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
