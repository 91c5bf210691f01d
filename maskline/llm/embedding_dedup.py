"""Embedding near-dedup with spherical-cap filters from random product codes.

A filter direction is a pair of codewords, one per half of the coordinates, each a random unit vector of a seeded codebook.
A vector is list-decoded to all directions whose inner product with it exceeds a threshold of its own, such that every vector has as many
directions (with one threshold for all, a few vectors have hundreds, and others none). The codebook grows with the largest label until a
direction holds about BUCKET vectors of it; how many a vector has is set by simulating seeded random pairs at the similarity asked
until RECALL of them share one.

Directions meet in cells: all those whose first codeword is in one group, so many groups that a cell's vectors take about CELL_BYTES.
Codewords lie in order of a seeded bisection, so a group's are alike and a vector goes to few cells, once to each. A task takes a
cell and multiplies only vectors that share a direction. A pair is kept at the least direction it shares, so it counts once, and if
its cosine in double precision reaches the threshold. A cell of more than twice its size is cut into blocks and every pair of blocks is
a task of its own. Equal vectors of a label are one vector with a count, so copies are never expanded. Tasks return sums of links and a
forest that connects what they linked, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link with
nothing: no links, a component of their own, kept. Vectors of different length are never linked. Labels are compared as they are, whatever
their type. Rows with equal ids stay apart as rows; a null id is never the smallest of a component unless all are null. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .storage import Workspace, sized

RECALL, BUCKET, SEED = 0.998, 16, 93
LEAST_CODE, MOST_CODE = 4, 1 << 15
#: Bytes of a cell's vectors in double precision, and rows and columns of one matrix product.
CELL_BYTES, TILE = 32 << 20, 2048
SIMULATED = 1000


def _in_order(words: np.ndarray) -> np.ndarray:
    """words reordered so that neighbours are alike: halves along the direction of greatest spread, again and again."""
    order, parts = [], [np.arange(len(words))]
    while parts:
        part = parts.pop()
        if len(part) <= 2:
            order.append(part)
            continue
        some = words[part] - words[part].mean(axis=0)
        axis = some[np.argmax((some * some).sum(axis=1))]
        for _ in range(5):
            axis = some.T @ (some @ axis)
            axis /= max(np.linalg.norm(axis), 1e-300)
        turn = part[np.argsort(some @ axis, kind="stable")]
        parts += [turn[len(turn) // 2 :], turn[: len(turn) // 2]]
    return words[np.concatenate(order)]


@lru_cache(8)
def codebooks(dim: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit codewords for the first and the second half of the coordinates."""
    rng = np.random.default_rng([SEED, dim, size])
    out = []
    for width in (dim - dim // 2, max(1, dim // 2)):
        words = rng.standard_normal((size, width))
        out.append(_in_order(words / np.linalg.norm(words, axis=1, keepdims=True)))
    return tuple(out)


def decode(x: np.ndarray, size: int, count: int) -> np.ndarray:
    """For each unit vector, the sorted numbers of the `count` directions that it exceeds its own threshold on: those of greatest inner product.

    Such a direction has both its codewords among the `count` best of their half, so no others are looked at.
    """
    if size == 1:
        return np.zeros((len(x), 1), np.int64)
    dim = x.shape[1]
    cut = dim - dim // 2
    first, second = codebooks(dim, size)
    each, halves = min(count, size), []
    for part, words in ((x[:, :cut], first), (x[:, cut:], second)):
        score = part @ words.T
        best = np.argpartition(-score, each - 1, axis=1)[:, :each]
        halves.append((best, np.take_along_axis(score, best, axis=1)))
    (i, a), (j, b) = halves
    both = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    top = np.argpartition(-both, count - 1, axis=1)[:, :count] if both.shape[1] > count else np.broadcast_to(np.arange(both.shape[1]), both.shape)
    return np.sort(np.take_along_axis(i, top // each, axis=1) * size + np.take_along_axis(j, top % each, axis=1), axis=1)


@lru_cache(32)
def calibrate(dim: int, size: int, threshold: float) -> int:
    """The fewest directions per vector at which RECALL of simulated pairs at the threshold share one."""
    rng = np.random.default_rng([SEED + 1, dim, size])
    x = units(rng.standard_normal((SIMULATED, dim)))
    z = rng.standard_normal((SIMULATED, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    y = threshold * x + np.sqrt(1 - threshold**2) * units(z)
    count = 4
    while count < size * size:
        met = (decode(x, size, count)[:, :, None] == decode(y, size, count)[:, None, :]).any(axis=(1, 2))
        if met.mean() >= RECALL:
            break
        count += max(1, count // 4)
    return min(count, size * size)


def _next(size: int) -> int:
    return size * 3 // 2 if size & (size - 1) == 0 else size * 4 // 3


def _plan(sizes: dict[int, int], threshold: float) -> dict[int, tuple[int, int, int]]:
    """Codewords per half, directions per vector and first codewords per group, by dimension; one direction serves few vectors, and dimensions up to 2."""
    out = {}
    for dim, n in sizes.items():
        size, count = 1, 1
        if dim > 2 and n > LEAST_CODE * LEAST_CODE * BUCKET:
            size = LEAST_CODE
            while n * 8 > BUCKET * size * size and size < MOST_CODE:  # about eight directions a vector, or more
                size = _next(size)
            count = calibrate(dim, size, threshold)
            while n * count > BUCKET * size * size and size < MOST_CODE:
                size = _next(size)
                count = calibrate(dim, size, threshold)
        groups = min(size, max(1, -(-int(n * dim * 8 * min(count, 2.5)) // CELL_BYTES)))
        out[dim] = (size, count, -(-size // groups))
    return out


def _most(plan: dict[int, tuple[int, int, int]]):
    """Vectors of a cell beyond which it is cut into blocks, by dimension."""
    return F.expr("CASE dim " + " ".join(f"WHEN {dim} THEN {max(64, 2 * CELL_BYTES // (8 * dim))}" for dim in plan) + " ELSE 64 END") if plan else F.lit(64)


def _meetings(vectors: DataFrame, plan: dict[int, tuple[int, int, int]], whole: bool) -> DataFrame:
    """A row per vector and cell: label, dim, cell, did and, if whole, mult, vector and ways, all of the vector's directions."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            lists = batch.column(4)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                size, count, per = plan[dim]
                for at in range(0, len(rows := np.flatnonzero(dims == dim)), 1024):
                    pick = rows[at : at + 1024]
                    x = units(flat[(ends[pick] - dim)[:, None] + np.arange(dim)].astype(np.float64))
                    ways = decode(x, size, count)
                    cell = ways // size // per
                    fresh = np.diff(cell, axis=1, prepend=-1) > 0
                    times = fresh.sum(axis=1)
                    owner = pa.array(np.repeat(pick, times), pa.int32())
                    columns = [*(batch.column(k).take(owner) for k in (1, 2)), pa.array(cell[fresh].astype(np.int32)), batch.column(0).take(owner)]
                    if whole:
                        columns += [*(batch.column(k).take(owner) for k in (3, 4)), pa.FixedSizeListArray.from_arrays(pa.array(np.repeat(ways, times, axis=0).astype(np.int32).ravel()), ways.shape[1]).cast(pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "cell", "did", "mult", "vector", "ways"][: len(columns)])

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    more = f", mult long, vector {kind['vector']}, ways array<int>" if whole else ""
    return vectors.select("did", "label", "dim", "mult", "vector").mapInArrow(emit, f"label {kind['label']}, dim int, cell int, did long{more}")


def units(x: np.ndarray) -> np.ndarray:
    """Rows at length 1, safe at any scale."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _met_before(ways: np.ndarray, s: np.ndarray, t: np.ndarray, way: int) -> np.ndarray:
    """Which rows of s and t share a direction below way."""
    flat = [ways[rows] for rows in (s, t)]
    known, out = np.intersect1d(*flat), np.zeros((len(s), len(t)), bool)
    known = known[known < way]
    for at in range(0, len(known), 2 * TILE):
        part, marks = known[at : at + 2 * TILE], []
        for own in flat:
            spot = np.minimum(np.searchsorted(part, own), len(part) - 1)
            row, place = np.nonzero(part[spot] == own)
            mark = np.zeros((len(own), len(part)), np.float32)
            mark[row, spot[row, place]] = 1
            marks.append(mark)
        out |= marks[0] @ marks[1].T > 0
    return out


def cell_links(x: np.ndarray, ways: np.ndarray, left: np.ndarray, right: np.ndarray | None, first: int, last: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the linked rows that share a direction in first..last, each pair once: at the least direction that both have.

    left, right: rows of two blocks; with right None, pairs within left.
    """
    side = np.zeros(len(ways), np.int8)
    side[left] = 1
    if right is not None:
        side[right] = 2
    row, place = np.nonzero((ways >= first) & (ways < last))
    held = ways[row, place]
    order = np.argsort(held, kind="stable")
    row, held = row[order], held[order]
    cuts = np.flatnonzero(np.diff(held, prepend=-1))
    ends = np.append(cuts[1:], len(held))
    for a, b in zip(cuts[ends - cuts > 1].tolist(), ends[ends - cuts > 1].tolist()):
        members = row[a:b]
        p = members[side[members] == 1]
        q = p if right is None else members[side[members] == 2]
        for u in range(0, len(p), TILE):
            for v in range(u if right is None else 0, len(q), TILE):
                s, t = p[u : u + TILE], q[v : v + TILE]
                near = x[s] @ x[t].T >= threshold
                if right is None and u == v:
                    near = np.triu(near, 1)
                if near.any():
                    s, t, near = s[near.any(axis=1)], t[near.any(axis=0)], near[near.any(axis=1)][:, near.any(axis=0)]
                    i, j = np.nonzero(near & ~_met_before(ways, s, t, held[a]))
                    if len(i):
                        yield s[i], t[j]


def _tile(threshold: float, plan: dict[int, tuple[int, int, int]]):
    """Links and a connecting forest of one cell, or pair of its blocks: rows (did, other, links)."""

    def tile(group: pa.Table) -> pa.Table:
        dim, cell, p, q = (group.column(c)[0].as_py() for c in ("dim", "cell", "p", "q"))
        size, _, per = plan[dim]
        mine, did, mult = (group.column(c).to_numpy() for c in ("mine", "did", "mult"))
        x = units(group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))
        ways = group.column("ways").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(did), -1)
        links, root = np.zeros(len(did), np.int64), np.arange(len(did))
        left = np.flatnonzero(mine == p)
        for i, j in cell_links(x, ways, left, None if p == q else np.flatnonzero(mine == q), cell * per * size, (cell + 1) * per * size, threshold):
            np.add.at(links, i, mult[j])
            np.add.at(links, j, mult[i])
            while True:  # least number over links, then over roots, until nothing changes
                ri, rj = root[i], root[j]
                low = np.minimum(ri, rj)
                if (ri == rj).all():
                    break
                np.minimum.at(root, ri, low)
                np.minimum.at(root, rj, low)
                root = root[root]
        while (root != root[root]).any():
            root = root[root]
        some = np.flatnonzero(links)
        return pa.table({"did": pa.array(did[some]), "other": pa.array(did[root[some]]), "links": pa.array(links[some])})

    return tile


def embedding_groups(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.93) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    work = Workspace(rows.sparkSession, "embeddings")
    vector = F.col(embedding)
    if rows.schema[embedding].dataType.simpleString() != "array<float>":  # single precision is exact in double, and half the bytes
        vector = vector.cast("array<double>")
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    held = work.save(rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), vector.alias("vector"),
                                 F.coalesce(F.col(label).isNotNull() & fine, F.lit(False)).alias("valid")), "rows")
    distinct = held.filter("valid").groupBy("label", "vector").agg(F.count("*").alias("mult"), F.min("vec_id").alias("least"))
    distinct = work.save(distinct.select(F.monotonically_increasing_id().alias("did"), "label", F.size("vector").alias("dim"), "mult", "least", "vector"), "distinct")
    sizes = distinct.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    plan = _plan({r["dim"]: r["n"] for r in sizes}, threshold)
    keys = ["label", "dim", "cell"]
    # vectors are sent once per cell, straight to the tasks; the cells are counted by their ids first
    large = _meetings(distinct, plan, False).groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > _most(plan))
    large = work.save(large.withColumn("blocks", F.ceil(2 * F.col("n") / _most(plan))).drop("n"), "large")
    met = _meetings(distinct, plan, True).join(sized(large, large.count(), 64), keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    dealt = met.withColumn("mine", F.pmod(F.xxhash64("did"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("p", F.least("mine", "other")).withColumn("q", F.greatest("mine", "other")).drop("blocks", "other")
    found = work.save(dealt.groupBy(*keys, "p", "q").applyInArrow(_tile(threshold, plan), "did long, other long, links long"), "found")
    links = found.groupBy("did").agg(F.sum("links").alias("links"))
    roots = work.save(components(found.select(F.col("did").alias("u"), F.col("other").alias("v")), work), "roots")
    of = distinct.join(links, "did", "left").join(roots, distinct["did"] == roots["node"], "left").withColumn("root", F.coalesce("root", "did"))
    tops = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = work.save(of.join(tops, "root").select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"), "component_id"), "verdicts")
    work.only(held, of)
    width = max([r["dim"] for r in sizes], default=1) * 8 + 48
    both = held.join(sized(of.withColumnsRenamed({"label": "l", "vector": "v"}).withColumn("ok", F.lit(True)), of.count(), width),
                     F.col("valid") & (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return both.select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
