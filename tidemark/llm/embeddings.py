"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one representative per group.

Vectors are compared within a label. Equal vectors share one row with a count. Centroids come from spherical k-means on a
bounded sample, as many as the largest label asks for; then every vector is assigned. Cells lose no pair: with theta
the angle of the threshold, a vector whose neighbour lies in cell c is within 2 * theta of its own distance to c, and no
further from the plane between both centroids than from the neighbour. It visits the cells for which both hold. Owners of a cell meet owners and visitors in blocks of bounded size; a block product
gives, per vector, the number of links and the smallest neighbour seen, never the pairs.

What a product leaves for the components is a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.graph import connected_components
from tidemark.session import cut, measured_broadcast

#: Rows of a block; two blocks meet in one group.
BLOCK = 8192
#: Rows of either side that are multiplied at once.
STEP = 1024


def _unit_rows(vectors: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places, unit vectors) of the usable rows: not null, nothing null or non-finite inside, not zero."""
    ok, out = [], []
    for i, v in enumerate(vectors):
        if v is None or not len(v) or any(x is None for x in v):
            continue
        x = np.array(v, np.float64)
        top = np.max(np.abs(x))
        if np.isfinite(top) and top > 0:
            x = x / top
            ok.append(i)
            out.append(x / math.sqrt(float(x @ x)))
    return np.array(ok, np.int64), out


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, reps): vec_id, rep of every usable row; rep, label, unit (binary), n of every distinct vector.

    `rep` is the smallest id among equal labels and vectors.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, units = _unit_rows(batch.column("embedding").to_pylist())
            blobs = pa.array([u.tobytes() for u in units], pa.binary())
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(take), batch.column("label").take(take), blobs], ["vec_id", "label", "unit"]
            )

    rows = vectors.filter(F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    label = vectors.schema["label"].dataType.simpleString()
    units = cut(rows.mapInArrow(run, f"vec_id {kind}, label {label}, unit binary").withColumn("key", F.xxhash64("label", "unit")))
    reps = cut(
        units.groupBy("key").agg(
            F.min("vec_id").alias("rep"), F.first("label").alias("label"), F.first("unit").alias("unit"), F.count(F.lit(1)).alias("n")
        )
    )
    return units.select("vec_id", "key").join(reps.select("key", "rep"), "key").select("vec_id", "rep"), reps.drop("key")


def _joining(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the edges (x, y) that join trees of `parent`, which is brought up to date; one edge per tree and round."""
    px, py = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(x):
        rx, ry = parent[x], parent[y]
        apart = rx != ry
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        hi, first = np.unique(np.maximum(rx, ry), return_index=True)
        px.append(x[first])
        py.append(y[first])
        parent[hi] = np.minimum(rx, ry)[first]
        while np.any(parent[parent] != parent):
            parent[:] = parent[parent]
    return np.concatenate(px), np.concatenate(py)


def spherical_kmeans(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows. Starts from random rows; an emptied centroid keeps its place."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1)
        used = length > 1e-12
        centres[used] = sums[used] / length[used, None]
    return centres


def _number() -> Column:
    return F.when(F.col("vec_id").isNotNull(), F.xxhash64("vec_id"))


def _named(vectors: DataFrame, found: DataFrame) -> DataFrame:
    """`found` for the numbers of ids, with the ids themselves; a component is its smallest id."""
    names = vectors.filter("vec_id is not null").select(_number().alias("number"), F.col("vec_id").alias("name")).distinct()
    found = cut(found.withColumnRenamed("vec_id", "number").join(cut(names), "number", "left"))
    first = found.groupBy("component_id").agg(F.min("name").alias("first"))
    out = found.join(first, "component_id", "left").select(F.col("name").alias("vec_id"), "n_links", F.col("first").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    cell_rows: int = 16_384,
    max_cells: int = 4096,
    sample_rows: int = 20_000,
) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept (whether it represents its group).

    Links join rows of equal label, not null, with cosine >= threshold in double precision. Rows with unusable vectors
    or null labels link with nothing. Vectors of other lengths never link. `sample_rows` bounds what k-means is fitted
    on and `max_cells` its centroids, which are broadcast; cells beyond `cell_rows` only mean more blocks. Repeated ids
    are rows of their own. A null id gets no links and is kept. An empty table gives an empty result. Ids may be of any
    type that sorts; those that are no whole numbers are told by 64-bit hashes meanwhile.
    """
    vectors = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    if not isinstance(vectors.schema["vec_id"].dataType, T.IntegralType):
        limits = {"threshold": threshold, "cell_rows": cell_rows, "max_cells": max_cells, "sample_rows": sample_rows}
        return _named(vectors, near_duplicates(vectors.withColumn("vec_id", _number()), **limits))
    members, reps = distinct_vectors(vectors)
    members = cut(members)
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    cells = max(1, min(max_cells, largest // cell_rows))
    centres: dict[int, np.ndarray] = {}
    if cells > 1:
        chosen = reps.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("unit").collect()
        by_length: dict[int, list[np.ndarray]] = {}
        for r in chosen:
            by_length.setdefault(len(r.unit), []).append(np.frombuffer(r.unit, np.float64))
        centres = {k: spherical_kmeans(np.array(v), cells) for k, v in by_length.items()}
    reach = 2.0 * math.acos(threshold) + 1e-6
    chord = math.sqrt(2.0 - 2.0 * threshold) + 1e-6

    def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cell, own = [], [], []
            for i, blob in enumerate(batch.column("unit")):
                x = np.frombuffer(blob.as_buffer(), np.float64)
                near = centres.get(len(x) * 8)
                if near is None:
                    rows.append(i)
                    cell.append(0)
                    own.append(True)
                    continue
                cosine = near @ x
                angle = np.arccos(np.clip(cosine, -1.0, 1.0))
                first = int(np.argmin(angle))
                apart = np.linalg.norm(near - near[first], axis=1)
                for c in np.flatnonzero((angle <= angle[first] + reach) & (cosine[first] - cosine <= chord * apart + 1e-9)):
                    rows.append(i)
                    cell.append(int(c))
                    own.append(int(c) == first)
            take = pa.array(rows, pa.int64())
            columns = [batch.column(c).take(take) for c in ("rep", "label", "unit", "n")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cell, pa.int32()), pa.array(own, pa.bool_())], ["rep", "label", "unit", "n", "cell", "own"]
            )

    label = reps.schema["label"].dataType.simpleString()
    placed = reps.select(F.col("rep").cast("long").alias("rep"), "label", "unit", "n").mapInArrow(
        assigned, f"rep bigint, label {label}, unit binary, n bigint, cell int, own boolean"
    )
    placed = placed.withColumn("cell", F.struct(F.xxhash64("label", F.length("unit")).alias("g"), "cell"))
    placed = cut(placed.select("rep", "unit", "n", "own", F.col("cell.g").alias("g"), F.col("cell.cell").alias("cell")))
    sizes = placed.groupBy("g", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = placed.join(measured_broadcast(cut(sizes)), ["g", "cell"])
    placed = cut(placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    # Block i of a cell meets every block j >= i of it once.
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sent = placed.select("rep", "unit", "n", "own", "g", "cell", "block", every.alias("other"))
    sent = sent.select(
        "rep", "unit", "n", "own", "g", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"),
    )
    limit = threshold

    def product(table: pa.Table) -> pa.Table:
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        own = table.column("own").to_numpy(zero_copy_only=False)
        units = np.array([np.frombuffer(b.as_buffer(), np.float64) for b in table.column("unit")])
        left = np.flatnonzero(table.column("left").to_numpy(zero_copy_only=False))
        right = np.flatnonzero(table.column("right").to_numpy(zero_copy_only=False))
        same = len(left) == len(rep) and len(right) == len(rep)
        links = np.zeros(len(rep), np.int64)
        parent = np.arange(len(rep))
        forest = []
        for a in range(0, len(left), STEP):
            la = left[a : a + STEP]
            for b in range(0, len(right), STEP):
                rb = right[b : b + STEP]
                near = units[la] @ units[rb].T >= limit
                x, y = np.nonzero(near)
                x, y = la[x], rb[y]
                keep = (x < y) if same else (x != y)
                x, y = x[keep], y[keep]
                # An owner counts its neighbours in its own cell: owners and visitors alike.
                np.add.at(links, x[own[x]], n[y[own[x]]])
                np.add.at(links, y[own[y]], n[x[own[y]]])
                forest.append(_joining(parent, x, y))
        hit = np.flatnonzero(links)
        p, q = (np.concatenate([f[k] for f in forest] or [np.zeros(0, np.int64)]) for k in (0, 1))
        return pa.table(
            {
                "a": np.r_[rep[hit], rep[p]], "b": np.r_[np.full(len(hit), -1), rep[q]],
                "links": np.r_[links[hit], np.zeros(len(p), np.int64)], "edge": np.r_[np.zeros(len(hit), bool), np.ones(len(p), bool)],
            }
        )

    found = cut(sent.groupBy("g", "cell", "i", "j").applyInArrow(product, "a bigint, b bigint, links bigint, edge boolean"))
    links = found.filter("not edge").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("edge").select("a", "b")).withColumnRenamed("node", "rep")
    facts = reps.select(F.col("rep").cast("long").alias("rep"), "n").join(links, "rep", "left").join(groups, "rep", "left")
    facts = cut(
        facts.select(
            "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
        )
    )
    known = members.withColumn("rep", F.col("rep").cast("long")).join(facts, "rep").select("vec_id", "n_links", "component_id")
    lone = vectors.filter(F.col("label").isNull() | F.col("vec_id").isNull()).select("vec_id")
    used = vectors.filter(F.col("label").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id").exceptAll(members.select("vec_id"))
    lone = lone.unionByName(used).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    out = known.unionByName(lone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
