"""Exact Jaccard self-join on word shingles as a blocked sparse matrix product.

The matrix has a row per distinct shingle set (copies share one) and a column per shingle. Shingles are ordered by hash.
Rows of Jaccard similarity t share a shingle among the first |x| - ceil(t|x|) + 1 of either, so each row stores those
places, and all below a fixed hash limit besides. Column blocks of the stored places are multiplied: a column with fewer
than `dense` rows gives its pairs, overlaps are summed, and a pair stays only if its overlap plus all that the places not
multiplied could still add reaches t/(1+t) of both sizes. What remains is compared set by set.

Columns of `dense` rows or more are not multiplied. They matter only between rows that have too few other places for the
bound above. For those rows alone the product is made again over all their places. Rows that are starved even then
consist mostly of what many others hold too: groups of near copies. They are compared with one pivot per column, which
joins a group in linear work. Then only rows of different components that share a pivot, and whose distances to it differ
by at most 1 - t (the Jaccard distance is a metric), are compared with each other. No pair at or above t is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import connected_components
from tidemark.llm.shingles import set_signature, shingle_sets
from tidemark.session import cut, measured_broadcast

#: Share of the hash range of which every place is stored.
STORED = 0.35
#: Entries that a task gathers before it writes them out, entries that a block is to hold, and signatures that a task
#: remembers so as to leave out copies. Copies it forgets are left out by their block.
_FLUSH = 300_000
_BLOCK_ENTRIES = 500_000
_SEEN = 100_000


def _prefix(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _limit(stored: float) -> np.uint64:
    """Hashes up to this one are low places, all of which are stored."""
    return np.uint64(min(int(stored * 2**64), 2**64 - 1))


def profile_sets(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n, sig, n_low and text_key of each row of `docs` (doc_id, text): set size, signature, stored low places."""

    limit = _limit(STORED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig, low = [], [], []
            for _, h in shingle_sets(batch.column("text").to_pylist(), width):
                n.append(len(h))
                sig.append(set_signature(h))
                low.append(int(np.searchsorted(h, limit, side="right")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(low, pa.int64())],
                ["doc_id", "text_key", "n", "sig", "n_low"],
            )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, n bigint, sig bigint, n_low bigint")


def _incidence(docs: DataFrame, width: int, percent: int, blocks: int, dense: int, stored: float) -> DataFrame:
    """block, passed, places, owner, sigs: packed entries of column blocks.

    `places` are 4-byte hashes within the block, `owner` indexes `sigs`. Columns that a task finds dense already leave
    their first `dense` entries in their block and pass the others on, spread over all blocks.
    """
    limit = _limit(stored)
    scale = float(limit) / blocks

    def packed(block: int, passed: bool, keys: np.ndarray, owner: np.ndarray, sigs: np.ndarray) -> tuple:
        used, local = np.unique(owner, return_inverse=True)
        places = keys if passed else (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return block, passed, places.tobytes(), local.astype(np.uint32).tobytes(), sigs[used].tobytes()

    def blocked(keys: np.ndarray, owner: np.ndarray, sigs: np.ndarray, turn: int) -> Iterator[tuple]:
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        rank = np.arange(len(keys)) - np.repeat(first, size)
        over = rank >= dense
        if over.any():
            yield packed(turn % blocks, True, keys[over], owner[over], sigs)
            keys, owner = keys[~over], owner[~over]
        block = (keys >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        for a, b in zip(edges, np.r_[edges[1:], len(keys)], strict=True):
            yield packed(int(block[a]), False, keys[a:b], owner[a:b], sigs)

    def keys_of(h: np.ndarray) -> np.ndarray:
        """Block number in the upper half, hash bits within the block in the lower; blocks from `blocks` on are high."""
        block = np.minimum((h / scale).astype(np.uint64), np.uint64(blocks - 1))
        high = h > limit
        block[high] = np.uint64(blocks) + h[high] % np.uint64(blocks)
        return (block << np.uint64(32)) | (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "passed", "places", "owner", "sigs"]
        kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        seen: set[int] = set()
        keys, owner, sigs, held, turn = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                rows = list(blocked(np.concatenate(keys), np.concatenate(owner), np.array(sigs, np.int64), turn + sigs[0]))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for _, h in shingle_sets(batch.column("text").to_pylist(), width):
                if not len(h):
                    continue
                sig = set_signature(h)
                if sig in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(sig)
                places = h[: max(int(np.searchsorted(h, limit, side="right")), _prefix(len(h), percent))]
                keys.append(keys_of(places))
                owner.append(np.full(len(places), len(sigs), dtype=np.int64))
                sigs.append(sig)
                held += len(places)
                if held >= _FLUSH:
                    yield from flush()
                    keys, owner, sigs, held, turn = [], [], [], 0, turn + 1
        yield from flush()

    return docs.select("text").mapInArrow(run, "block int, passed boolean, places binary, owner binary, sigs binary")


def _block_products(incidence: DataFrame, blocks: int, dense: int) -> DataFrame:
    """kind, a, b, c. Kind 0: rows a < b share c low columns of this block (0: a high one). Kind 1: row a has a place in
    the dense column b; c is 1 for a low column."""

    def rows(kind: int, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        kinds = np.full(len(a), kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (kinds, a, b, c)], ["kind", "a", "b", "c"])

    def low(keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(32)) < np.uint64(blocks)).astype(np.int64)

    def product(keys: np.ndarray, sigs: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((sigs, keys))
        keys, sigs = keys[order], sigs[order]
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (sigs[1:] != sigs[:-1])]
        keys, sigs = keys[fresh], sigs[fresh]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        size = np.repeat(size, size)
        full = size >= dense
        if full.any():
            yield rows(1, sigs[full], keys[full].view(np.int64), low(keys[full]))
        keep = (size > 1) & ~full
        keys, sigs = keys[keep], sigs[keep]
        a, b, c = [], [], []
        for step in range(1, min(dense - 1, len(keys))):
            same = np.flatnonzero(keys[step:] == keys[:-step])
            if not len(same):
                break
            a.append(sigs[same])
            b.append(sigs[same + step])
            c.append(low(keys[same]))
        if a:
            a, b, c = np.concatenate(a), np.concatenate(b), np.concatenate(c)
            order = np.lexsort((b, a))
            a, b, c = a[order], b[order], c[order]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            yield rows(0, a[first], b[first], np.add.reduceat(c, first))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One block at a time: rows come sorted by block."""
        now, keys, sigs = -1, [], []
        for batch in batches:
            columns = [batch.column(c) for c in ("block", "passed", "places", "owner", "sigs")]
            for block, passed, places, owner, signed in zip(*columns, strict=True):
                number = block.as_py()
                if number != now and keys:
                    yield from product(np.concatenate(keys), np.concatenate(sigs))
                    keys, sigs = [], []
                now = number
                owners = np.frombuffer(signed.as_buffer(), np.int64)[np.frombuffer(owner.as_buffer(), np.uint32)]
                if passed.as_py():
                    far = np.frombuffer(places.as_buffer(), np.uint64)
                    yield rows(1, owners, far.view(np.int64), low(far))
                else:
                    near = np.frombuffer(places.as_buffer(), np.uint32).astype(np.uint64)
                    keys.append(near | (np.uint64(number) << np.uint64(32)))
                    sigs.append(owners)
        if keys:
            yield from product(np.concatenate(keys), np.concatenate(sigs))

    return incidence.mapInArrow(run, "kind int, a bigint, b bigint, c bigint")


def _texts_of(docs: DataFrame, sets: DataFrame, needed: DataFrame) -> DataFrame:
    """text of every row of `docs` that gives one of the `needed` signatures its text."""
    keys = cut(sets.join(needed.select("sig"), "sig").select("text_key").distinct())
    keyed = docs.select("text", F.xxhash64("text").alias("text_key"))
    return keyed.join(measured_broadcast(keys, 1_000_000), "text_key", "left_semi").select("text")


def _overlaps(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """a, b, na, nb, shared: the exact overlap of each pair of signatures. `sets` (sig, text_key) finds their texts."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, blob = [], []
            for _, h in shingle_sets(batch.column("text").to_pylist(), width):
                sig.append(set_signature(h))
                blob.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(blob, pa.binary())], ["sig", "hashes"])

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, shared = [], [], []
            for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                shared.append(int(np.count_nonzero(q[at] == p)))
                na.append(len(x.as_buffer()) // 8)
                nb.append(len(y.as_buffer()) // 8)
            counts = [pa.array(v, pa.int64()) for v in (na, nb, shared)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *counts], ["a", "b", "na", "nb", "shared"]
            )

    needed = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    hashes = cut(_texts_of(docs, sets, needed).mapInArrow(hashed, "sig bigint, hashes binary").dropDuplicates(["sig"]))
    with_a = pairs.join(hashes.select(F.col("sig").alias("a"), F.col("hashes").alias("ha")), "a")
    with_b = with_a.join(hashes.select(F.col("sig").alias("b"), F.col("hashes").alias("hb")), "b")
    return cut(
        with_b.select("a", "b", "ha", "hb").mapInArrow(compared, "a bigint, b bigint, na bigint, nb bigint, shared bigint")
    )


def ngram_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
    dense: int = 16,
    block_entries: int = _BLOCK_ENTRIES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the smallest doc_id reachable, itself included).

    Two rows link when 100 * intersection >= percent * union of their shingle sets. Rows of equal sets link; empty ones
    (null, blank) link with nothing. Null ids take part and name no component, unless nothing else is in it. An empty
    table gives an empty result. The entries stored decide the number of blocks, so a task's memory stays the same.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    profile = cut(profile_sets(docs, width))
    sets = cut(
        profile.filter("n > 0").groupBy("sig").agg(
            F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"),
            F.first("n").alias("n"), F.first("n_low").alias("n_low"), F.count(F.lit(1)).alias("copies"),
        )
    )
    links = _links(docs, sets, width, percent, dense, block_entries)
    groups = cut(connected_components(links))
    labelled = sets.join(groups.withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "first_id", F.coalesce("component", "sig").alias("component")
    )
    names = cut(labelled.groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = cut(labelled.join(names, "component").select("sig", "component_id"))
    full = profile.filter("n > 0").join(named, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = profile.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def _products(
    docs: DataFrame, sets: DataFrame, width: int, percent: int, dense: int, stored: float, block_entries: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, rows, crowded) of one round of column products over `docs`; `sets` has sig, n and n_low of its sets.

    pairs: a, b that may still reach the threshold. rows: sig, n and whether it is starved, that is, has fewer places in
    multiplied columns than a link must show. crowded: sig, column of the places in dense columns.
    """
    stored_places = F.greatest("n_low", F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1)
    entries = sets.agg(F.coalesce(F.sum(stored_places), F.lit(0))).first()[0]
    blocks = max(1, -(-entries // block_entries))
    incidence = _incidence(docs, width, percent, blocks, dense, stored)
    incidence = incidence.repartition(blocks, "block").sortWithinPartitions("block")
    products = cut(_block_products(incidence, blocks, dense))
    # Tasks pass on what they find dense, so a row can come twice.
    crowded = products.filter("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("column"), "c").distinct()
    crowded = cut(crowded)
    hidden = crowded.groupBy("sig").agg(F.sum("c").alias("hidden"))
    rows = sets.join(hidden, "sig", "left").withColumn("hidden", F.coalesce("hidden", F.lit(0)))
    least = F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1
    rows = cut(
        rows.select(
            "sig", "n", "hidden", (F.col("n") - F.col("n_low")).alias("high"),
            (F.col("n_low") - F.col("hidden") < least).alias("starved"),
        )
    )
    sums = products.filter("kind = 0").groupBy("a", "b").agg(F.sum("c").alias("overlap"))
    for side in ("a", "b"):
        facts = [F.col(c).alias(f"{c}_{side}") for c in ("n", "hidden", "high")]
        sums = sums.join(rows.select(F.col("sig").alias(side), *facts), side)
    most = F.col("overlap") + F.least("hidden_a", "hidden_b") + F.least("high_a", "high_b")
    most = F.least(most, F.col("n_a"), F.col("n_b"))
    # shared >= t / (1 + t) * (na + nb), in integers
    pairs = sums.filter((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    return cut(pairs), rows, crowded


def _links(docs: DataFrame, sets: DataFrame, width: int, percent: int, dense: int, block_entries: int) -> DataFrame:
    """a, b: signatures of linked sets; enough of them to connect all that exact links connect."""
    found, rows, crowded = _products(docs, sets.select("sig", "n", "n_low"), width, percent, dense, STORED, block_entries)
    # A place of a starved row counts only in a column that is crowded.
    hungry = rows.filter("starved").join(crowded.select("sig").distinct(), "sig", "left_semi").select("sig", "n")
    hungry = cut(hungry)
    texts = _texts_of(docs, sets, hungry)
    again = hungry.withColumn("n_low", F.col("n"))
    more, rows, crowded = _products(texts, again, width, percent, dense, 1.0, block_entries)

    # A pivot should stand in the middle of its group: an original has hardly a place that its near copies lack.
    alone = (1.0 - F.col("hidden") / F.col("n")).alias("alone")
    turn = F.xxhash64(F.col("sig"), F.lit(7)).alias("turn")
    starved = crowded.join(rows.filter("starved").select("sig", alone, turn), "sig")
    starved = cut(starved.select("sig", "column", "alone", "turn"))
    pivots = starved.groupBy("column").agg(F.min(F.struct("alone", "turn", "sig")).alias("p"))
    pivots = cut(pivots.select("column", F.col("p.sig").alias("pivot")))
    spokes = cut(starved.join(pivots, "column").filter("sig <> pivot").select("pivot", "sig").distinct())
    ends = (F.least("sig", "pivot").alias("a"), F.greatest("sig", "pivot").alias("b"))
    checked = _overlaps(cut(found.unionByName(more).unionByName(spokes.select(*ends)).distinct()), docs, sets, width)
    union = F.col("na") + F.col("nb") - F.col("shared")
    linked = 100 * F.col("shared") >= percent * union
    links = checked.filter(linked).select("a", "b")

    groups = connected_components(links).withColumnRenamed("node", "sig")
    distance = checked.withColumn("d", 1.0 - F.col("shared") / union).select("a", "b", "d")
    around = spokes.select("pivot", "sig", *ends).join(distance, ["a", "b"]).select("pivot", "sig", "d")
    hubs = spokes.select("pivot").distinct().select("pivot", F.col("pivot").alias("sig"), F.lit(0.0).alias("d"))
    around = around.unionByName(hubs).join(rows.select("sig", "n", "hidden"), "sig").join(groups, "sig", "left")
    around = cut(around.select("pivot", "sig", "n", "hidden", "d", F.coalesce("component", "sig").alias("component")))
    mixed = around.groupBy("pivot").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    own = around.filter("sig = pivot").select("pivot", F.col("component").alias("home"))
    open_rows = cut(around.join(mixed.select("pivot"), "pivot").join(own, "pivot").filter("sig <> pivot"))
    # Only neighbouring cells of distance to the pivot and of size can hold rows close enough.
    step, ratio = 1.0 - percent / 100.0 + 1e-9, 100.0 / percent * (1.0 + 1e-9)
    open_rows = open_rows.withColumns(
        {"ring": F.floor(F.col("d") / step), "class": F.floor(F.log("n") / float(np.log(ratio)))}
    )
    strays = open_rows.filter("component <> home")
    for cell in ("ring", "class"):
        strays = strays.withColumn(cell, F.explode(F.array(*[F.col(cell) + k for k in (-1, 0, 1)])))
    strays = strays.select("pivot", "ring", "class", *[F.col(c).alias(f"{c}_l") for c in ("sig", "n", "hidden", "d", "component")])
    close = (F.abs(F.col("d_l") - F.col("d")) <= 1.0 - percent / 100.0 + 1e-9) & (F.col("component_l") != F.col("component"))
    close &= 100 * F.least("n_l", "n") >= percent * F.greatest("n_l", "n")
    # Pairs that share places outside crowded columns have been compared by now; the others share crowded ones at most.
    close &= (100 + percent) * F.least("hidden_l", "hidden") >= percent * (F.col("n_l") + F.col("n"))
    close &= (F.col("component") == F.col("home")) | (F.col("sig_l") < F.col("sig"))
    rest = measured_broadcast(cut(strays)).join(open_rows, ["pivot", "ring", "class"]).filter(close)
    rest = cut(rest.select(F.least("sig_l", "sig").alias("a"), F.greatest("sig_l", "sig").alias("b")).distinct())
    late = _overlaps(rest, docs, sets, width)
    return links.unionByName(late.filter(linked).select("a", "b"))
