"""SimHash near-dedup with generalised-pigeonhole search.

Fingerprint: A-Z are lower-cased, words are runs of bytes other than space and U+0009 to U+000D, shingles are `width`
words joined by one space (repeats included; fewer words: the whole sequence; none: fingerprint zero). A bit is 1 if it
is set in over half of the shingles' XXH64 hashes (seed 42).

Search: fingerprints within `limit` bits are linked. The 64 bits are grouped, correlated bits together, into m parts with
thresholds t_i whose sum is limit - m + 1 (so two fingerprints within the limit agree to within t_i bits on some part; a
threshold of -1 leaves a part out). For each m, dynamic programming over the parts picks the thresholds of least cost:
probes, plus candidates estimated from pairs of up to SAMPLED fingerprints, so correlated bits count as they are, and for chances
too small for that sample from each bit's share of ones over all fingerprints; the cheapest m is used. Each
distinct fingerprint probes every value within t_i bits of its own; those that meet are verified. Buckets of up to
HOT probes are verified in the join itself. Larger ones are cut into blocks, every pair of blocks is compared in numpy,
and only a spanning forest of the true links is kept, so output stays linear in the bucket.

Near copies (drop_near_copies) are found by this search first, each link verified by Jaccard similarity; an exact join over prefixes of
shingle sets then adds the links between groups that lie further apart in their fingerprints.

Defined results: null text counts as empty (fingerprint zero, linked like any other); rows with the same id stay apart as
rows; a null id belongs to its component but is never its smallest; component_id is null only where all ids are; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components
from .storage import Workspace, free_name, lean, numbered, sized, slices

#: Probes that a bucket may hold to be verified in the join; rows of a block beyond that.
HOT, BLOCK = 128, 2048
#: Near copies: rows of a bucket up to which its pairs between groups are rows of their own.
NEAR_HOT = 32
#: Cost of a probe (a shuffled row) in candidate comparisons inside the join.
PROBE_COST = 12.0
MOST_PARTS = 6
#: Fingerprints sampled to estimate candidates (cost only).
SAMPLED = 8192
#: Near copies: shingles of a block of a hot bucket; documents whose shingles are counted to order prefixes, and how many are kept (cost only).
BLOCK_SHINGLES, SAMPLE, MOST_COMMON = 1 << 20, 8192, 1 << 17
#: Near copies: one shingle hash in so many is counted over all documents to order prefixes (cost only).
COUNTED = 3


def fingerprint(text: bytes | None, width: int = 3) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: -width].tolist()]
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", width: int = 3) -> DataFrame:
    """docs with one more column, the fingerprint as a signed long."""

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def _bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and over all rows how often bits i and j are both set (64 x 64 sums: a bounded result)."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            x = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.float64)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(4097), pa.int32()), pa.array([*total.ravel().astype(np.int64), n], pa.int64())], names=["cell", "c"])

    cells = prints.select("fp").mapInArrow(count, "cell int, c long").groupBy("cell").agg(F.sum("c").alias("c")).collect()
    flat = np.zeros(4097)
    for row in cells:
        flat[row["cell"]] = row["c"]
    return int(flat[-1]), flat[:-1].reshape(64, 64)


def _parts(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m groups of bits of nearly equal size; each grows by the bit most correlated with those it has."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    rho = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(rho, 0)
    free, parts = set(range(64)), []
    for k in range(m):
        order = sorted(free)
        part = [max(order, key=lambda b: (rho[b, order].sum(), -b))]
        free.discard(part[0])
        while len(part) < (64 * (k + 1)) // m - (64 * k) // m:
            best = max(sorted(free), key=lambda b: (rho[b, part].sum(), -b))
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def _pair_differences(sample: np.ndarray) -> np.ndarray:
    """Differing bits of pairs of the sampled fingerprints: each with those 1, 2, 4, ... places on."""
    steps = [1 << k for k in range(12) if 1 << k < len(sample)]
    return np.concatenate([sample[s:] ^ sample[:-s] for s in steps]) if steps else np.zeros(0, np.uint64)


def plan(together: np.ndarray, n: int, limit: int, sample: np.ndarray | None = None) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of least estimated cost; thresholds sum to limit - m + 1, parts at -1 are left out."""
    differences = _pair_differences(sample) if sample is not None else np.zeros(0, np.uint64)
    p = np.diag(together) / max(n, 1)
    differ = 2 * p * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, MOST_PARTS + 1):
        parts = _parts(together, n, m)
        costs = []
        for bits in parts:
            chance = np.zeros(limit + 1)  # that two fingerprints differ in k of the part's bits
            chance[0] = 1
            for b in bits:
                chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
                chance[0] *= 1 - differ[b]
            if len(differences):  # seen among sampled pairs, where that is more
                apart = np.bitwise_count(differences & np.uint64(sum(1 << b for b in bits)))
                chance = np.maximum(chance, np.bincount(np.minimum(apart, limit + 1), minlength=limit + 2)[: limit + 1] / len(differences))
            costs.append([0.0] + [n * n / 2 * chance[: t + 1].sum() + PROBE_COST * n * (1 + sum(comb(len(bits), k) for k in range(t + 1))) for t in range(limit + 1)])
        goal = limit - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (spent, chosen) in table.items():
                for t in range(-1, limit + 1):
                    key, price = total + t, spent + cost[t + 1]
                    if key not in step or price < step[key][0]:
                        step[key] = (price, [*chosen, t])
            table = step
        if goal in table and (best is None or table[goal][0] < best[0]):
            best = (table[goal][0], [(b, t) for b, t in zip(parts, table[goal][1]) if t >= 0])
    assert best is not None
    return best[1]


def _probes(prints: DataFrame, chosen: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, fp, own) for every value within the part's threshold of each fingerprint; own: the value is its own."""
    masks = []
    for bits, t in chosen:
        flips = [0]
        for _ in range(t):
            flips = sorted({f ^ (1 << b) for f in flips for b in bits} | set(flips))
        masks.append((sum(1 << b for b in bits), np.array(flips, np.uint64)))

    @lean
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            for k, (mask, flips) in enumerate(masks):
                for at in range(0, len(fps), step := max(1, (1 << 18) // len(flips))):
                    own = fps[at : at + step]
                    value = ((own & np.uint64(mask))[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(value), k, np.int32)), pa.array(value.view(np.int64)), pa.array(np.repeat(own, len(flips)).view(np.int64)), pa.array(np.tile(flips == 0, len(own)))],
                        names=["part", "value", "fp", "own"],
                    )

    return prints.select("fp").mapInArrow(emit, "part int, value long, fp long, own boolean")


def _forest(values: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph that links values within limit bits."""
    rest, edges = np.unique(values), []
    while rest.size:
        stack, rest = [rest[0]], rest[1:]
        while stack and rest.size:
            x = stack.pop()
            near = np.bitwise_count(rest ^ x) <= limit
            if near.any():
                stack.extend(rest[near])
                edges.extend((int(x.view(np.int64)), int(y)) for y in rest[near].view(np.int64))
                rest = rest[~near]
    return edges


def links(prints: DataFrame, work: Workspace, limit: int = 3) -> DataFrame:
    """(u, v) links between distinct fingerprints (fp): enough of those within limit bits to connect all that are linked."""
    n, together = _bit_counts(prints)
    low = F.pmod(F.xxhash64("fp", F.lit(9)), F.lit(1 << 20)) < round(min(1.0, SAMPLED / max(n, 1)) * (1 << 20))
    sample = np.array([r["fp"] for r in prints.filter(low).select("fp").orderBy(F.xxhash64("fp")).limit(2 * SAMPLED).collect()], np.int64).view(np.uint64)
    probes = work.save(_probes(prints, plan(together, n, limit, sample)), "probes")
    buckets = work.save(probes.groupBy("part", "value").agg(F.count("*").alias("n"), F.max("own").alias("used")).filter("n > 1 and used").drop("used"), "buckets")
    total = buckets.agg(F.count("*").alias("n"), F.sum(F.expr(f"if(n > {HOT}, 1, 0)")).alias("hot")).first()
    if not total["n"]:
        return work.spark.createDataFrame([], "u long, v long")
    live = probes.join(sized(buckets, total["n"], 40), ["part", "value"])
    cold = live.filter(f"n <= {HOT}")
    a, b = cold.filter("own").alias("a"), cold.alias("b")
    near = (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.fp") != F.col("b.fp")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= limit)
    found = a.join(b, near).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    if total["hot"]:

        def tile(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(_forest(pdf["fp"].to_numpy().view(np.uint64), limit), columns=["u", "v"])

        blocks = F.ceil(F.col("n") / BLOCK)
        mine = F.pmod(F.xxhash64("fp"), blocks)
        hot = live.filter(f"n > {HOT}").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long"))))
        tiles = hot.groupBy("part", "value", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q")).applyInPandas(tile, "u long, v long")
        found = found.union(tiles)
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def simhash_groups(docs: DataFrame, work: Workspace, text: str = "text", doc_id: str = "doc_id", limit: int = 3) -> DataFrame:
    """One row per input row: rid, doc_id, fp, component_id (smallest id reachable), keep_rid (its row), saved."""
    picked = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = work.save(with_fingerprints(picked, "text").drop("text"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("rid").alias("c"))
    prints = work.save(rows.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    roots = work.save(components(links(prints, work, limit), work), "roots")
    least = prints.join(roots, prints["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    tops = least.groupBy("root").agg(F.min("first").alias("top"))
    of = work.save(least.select("fp", "root").join(tops, "root").select("fp", F.col("top.b").alias("component_id"), F.col("top.c").alias("keep_rid")), "components")
    return work.save(rows.join(sized(of, of.count(), 48), "fp"), "grouped")


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles (fewer words: the whole sequence; none: no shingle)."""
    parts = (text or b"").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    words = min(words, len(parts))
    starts = [0, *ends[: len(parts) - words].tolist()]
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())), np.uint64, len(starts)))


def _common_shingles(docs: DataFrame, work: Workspace, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (sorted) that several of about SAMPLE documents have, and how many have them: a bounded guide to the order of prefixes."""
    share = SAMPLE / max(docs.count(), SAMPLE)

    @lean
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text.as_py(), words).view(np.int64))], names=["token"])

    some = docs.filter(F.pmod(F.xxhash64("rid", F.lit(5)), F.lit(1 << 20)) < round(share * (1 << 20))).select("text")
    found = some.mapInArrow(shingles, "token long").groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "token").limit(MOST_COMMON).collect()
    tokens = np.array([r["token"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array([r["n"] for r in found], np.int64)[order]


def _repeated_shingles(docs: DataFrame, work: Workspace, words: int, common: np.ndarray) -> DataFrame:
    """(rid, often) of rows of docs (rid, text): the COUNTED shingles that several rows have, each with their number, but for those in common (sorted)."""

    @lean
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for text in batch.column(1).cast(pa.binary()):
                own = shingle_hashes(text.as_py(), words)
                own = own[own % np.uint64(COUNTED) == 0]
                if len(common):
                    own = own[common[np.minimum(np.searchsorted(common, own), len(common) - 1)] != own]
                found.append(own)
            rids = np.repeat(batch.column(0).to_numpy(), [len(own) for own in found])
            yield pa.RecordBatch.from_arrays([pa.array(rids), pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64))], names=["rid", "token"])

    entries = work.save(docs.select("rid", "text").mapInArrow(counted, "rid long, token long"), "counted")
    several = work.save(entries.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"), "several")
    often = entries.join(sized(several, several.count(), 24), "token").groupBy("rid").agg(F.collect_list(F.struct("token", "n")).alias("often"))
    often = work.save(often, "often")
    work.drop(entries)
    work.drop(several)
    return often


def _prefixes(docs: DataFrame, work: Workspace, words: int, similarity: float) -> DataFrame:
    """docs (rid, doc_id, text) to (rid, doc_id, high, low, size, prefix): digest and size of the shingle set, and its rarest shingles.

    Two sets whose Jaccard similarity reaches `similarity` share a shingle among their first size - ceil(similarity * size) + 1,
    in any order of shingles that is the same for all. Here: counted ones that no other row has, those not counted, counted ones by the number of rows
    that have them, and last those that several sampled rows have. So a text of which enough is its own meets no other.
    """
    common, seen = _common_shingles(docs, work, words)
    often = _repeated_shingles(docs, work, words, common)

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, sizes, prefixes = [], [], []
            known = batch.column(3)
            for k, text in enumerate(batch.column(2).cast(pa.binary())):
                own = shingle_hashes(text.as_py(), words)
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                n = len(own) - ceil(similarity * len(own) - 1e-9) + 1 if len(own) else 0
                rows = np.where(own % np.uint64(COUNTED) == 0, -1, 0)
                if known[k].is_valid:
                    pairs = known[k].values
                    rows[np.searchsorted(own, pairs.field(0).to_numpy().view(np.uint64))] = pairs.field(1).to_numpy()
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    rows = np.where(common[at] == own, (1 << 48) + seen[at], rows)
                prefixes.append(own[np.lexsort((own, rows))][:n].view(np.int64))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["rid", "doc_id", "high", "low", "size", "prefix"])

    rows = docs.join(often, "rid", "left").select("rid", "doc_id", "text", "often")
    return rows.mapInArrow(add, "rid long, doc_id long, high long, low long, size int, prefix array<long>")


def _joining_links(rids: np.ndarray, sets: list[np.ndarray], roots: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between rows whose sets (none empty) have that Jaccard similarity: enough to join the groups (roots) that any such link joins."""
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts, has = np.cumsum(sizes) - sizes, np.zeros(int(codes.max()) + 1, np.int64)
    group, edges = np.unique(roots, return_inverse=True)[1], []
    for x in range(len(sets)):
        fit = (group != group[x]) & (np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x]))
        if not fit.any():
            continue
        own = codes[starts[x] : starts[x] + sizes[x]]
        has[own] = 1
        shared = np.add.reduceat(has[codes], starts)
        has[own] = 0
        near = np.flatnonzero(fit & (shared >= similarity * (sizes[x] + sizes - shared)))
        for y in near.tolist():
            if group[y] != group[x]:
                edges.append((int(rids[x]), int(rids[y])))
                group[group == group[y]] = group[x]
    return edges


def _with_shingles(docs: DataFrame, keys: DataFrame, n: int, words: int, name: str) -> DataFrame:
    """keys (rid and more, n rows in all), each with the shingle set of its row of docs (rid, text) as bytes."""
    both = docs.select("rid", "text").join(sized(keys, n, 48), "rid")
    columns = keys.columns

    @lean
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = pa.array([shingle_hashes(t.as_py(), words).tobytes() for t in batch.column(len(columns)).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sets], names=[*columns, name])

    return both.select(*columns, "text").mapInArrow(shingles, T.StructType([*keys.schema.fields, T.StructField(name, T.BinaryType())]))


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, work: Workspace, words: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of rows (rid, size, prefix) whose sets have that Jaccard similarity.

    Of two such sets, the shingles in common are in both prefixes, or beyond the prefix of the one whose prefix ends first: so prefixes with
    too little in common rule a pair out, and only the others' sets are sent, each side of a pair once.
    """
    n = pairs.count()
    side = lambda end, names: rows.select(F.col("rid").alias(end), F.col("size").alias(names[0]), F.col("prefix").alias(names[1])).join(sized(pairs, n, 32), end)
    both = side("u", ("m", "p")).join(side("v", ("n", "q")), ["u", "v"])
    shared = F.size(F.array_intersect("p", "q")) + F.greatest(F.col("m") - F.size("p"), F.col("n") - F.size("q"))
    some = work.save(both.filter(shared >= similarity / (1 + similarity) * (F.col("m") + F.col("n")) - 1e-6).select("u", "v"), "possible")
    k = some.count()
    own = _with_shingles(docs, some.select(F.col("u").alias("rid"), "v"), k, words, "x").withColumnRenamed("rid", "u")
    other = _with_shingles(docs, some.select(F.col("v").alias("rid"), "u"), k, words, "y").withColumnRenamed("rid", "v")

    @lean
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.intersect1d(x, y, assume_unique=True).size
                linked.append(both >= similarity * (x.size + y.size - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return work.save(own.join(other, ["u", "v"]).select("u", "v", "x", "y").mapInArrow(verify, "u long, v long"), "links")


def print_links(rows: DataFrame, docs: DataFrame, work: Workspace, words: int, similarity: float, limit: int = 3) -> DataFrame:
    """(u, v) links of that Jaccard similarity between rows of distinct sets (rid, size, prefix), found by their fingerprints.

    Of each fingerprint the row of smallest rid stands for it: the fingerprint's other rows, and those that stand for fingerprints within
    limit bits of it, are candidates, each verified. Links that these miss are similar_links' to find.
    """
    held = docs.join(rows.select("rid"), "rid", "left_semi")
    prints = work.save(with_fingerprints(held.select("rid", "text")).drop("text"), "fingerprints")
    firsts = work.save(prints.groupBy("fp").agg(F.min("rid").alias("first")), "distinct")
    n = firsts.count()
    first = lambda end: sized(firsts.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_first")), n, 24)
    own = prints.join(sized(firsts, n, 24), "fp").filter("rid <> first").select(F.col("rid").alias("u"), F.col("first").alias("v"))
    found = work.save(links(firsts, work, limit), "print-links")
    far = found.join(first("u"), "u").join(first("v"), "v").select(F.greatest("u_first", "v_first").alias("u"), F.least("u_first", "v_first").alias("v"))
    return _verified(work.save(own.union(far).distinct(), "print-pairs"), rows, docs, work, words, similarity)


def similar_links(rows: DataFrame, docs: DataFrame, work: Workspace, words: int, similarity: float) -> DataFrame:
    """(u, v) links between rows of distinct sets (rid, size, prefix): enough of those of that Jaccard similarity to connect all that are linked.

    Links by fingerprints come first; what follows looks only at pairs between the groups that those make.
    Linked rows share a prefix shingle, so meet in its bucket. Every row is compared with two of each of its buckets: the least, and the
    one with most repeated shingles, which the others are likely to be edits of. Where that leaves a bucket in several groups, its
    pairs between groups are looked at: in buckets of up to NEAR_HOT rows each pair is a row, bounded by places and sizes, and verified;
    larger ones are cut into blocks with their sets, and every pair of blocks is verified in numpy. So every link between rows
    that are not yet connected is found, and buckets of one large group cost no more than their rows.
    """
    entries = rows.select("rid", "size", F.posexplode("prefix").alias("pos", "token"))
    buckets = work.save(entries.groupBy("token").agg(F.count("*").alias("n"), F.sum("size").alias("total")).filter("n > 1"), "buckets")
    n_buckets = buckets.count()
    if not n_buckets:
        return work.spark.createDataFrame([], "u long, v long")
    by_print = print_links(rows, docs, work, words, similarity)
    grouped = work.save(components(by_print, work), "print-roots")
    own_root = lambda some, roots: some.join(sized(roots, roots.count(), 24), F.col("rid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rid")).drop("node")
    live = work.save(own_root(entries.join(sized(buckets, n_buckets, 40), "token"), grouped), "entries")
    repeats = live.groupBy("rid").agg(F.count("*").alias("repeats"))
    place = F.struct("rid", "size", "pos", "root")
    heads = live.join(repeats, "rid").groupBy("token").agg(F.min(place).alias("least"), F.max(F.struct("repeats", (-F.col("rid")).alias("r"), place.alias("place")))["place"].alias("central"))
    heads = work.save(heads.select("token", F.explode(F.array_distinct(F.array("least", "central"))).alias("head")), "heads")
    least = similarity / (1 + similarity)  # of the sum of both sizes: the shingles that a linked pair shares

    def may_link(a: str, b: str) -> Column:
        """Whether rows that share a shingle at these places may have shingles enough in common: those up to there, and the fewer after."""
        rest = F.least(F.expr(f"{a}.size - {a}.pos - 1"), F.expr(f"{b}.size - {b}.pos - 1"))
        return F.least(f"{a}.pos", f"{b}.pos") + 1 + rest >= least * (F.col(f"{a}.size") + F.col(f"{b}.size")) - 1e-6

    met = live.alias("a").join(heads, "token").filter((F.col("a.root") != F.col("head.root")) & may_link("a", "head"))
    stars = work.save(met.select(F.greatest("a.rid", "head.rid").alias("u"), F.least("a.rid", "head.rid").alias("v")).distinct(), "stars")

    found = _verified(stars, rows, docs, work, words, similarity).union(by_print)
    roots = work.save(components(found, work), "star-roots")
    rooted = work.save(own_root(live.filter("n > 3").drop("root"), roots), "rooted")
    open_ = work.save(rooted.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("token"), "open")
    left = work.save(rooted.join(sized(open_, open_.count(), 16), "token"), "left")
    work.drop(live)
    work.drop(rooted)
    cold, hot = left.filter(f"n <= {NEAR_HOT}"), left.filter(f"n > {NEAR_HOT}")
    a, b = cold.alias("a"), cold.alias("b")
    near = (F.col("a.token") == F.col("b.token")) & (F.col("a.rid") > F.col("b.rid")) & (F.col("a.root") != F.col("b.root")) & may_link("a", "b")
    pairs = a.join(b, near).select(F.col("a.rid").alias("u"), F.col("b.rid").alias("v")).distinct().join(stars, ["u", "v"], "left_anti")
    found = found.union(_verified(work.save(pairs, "candidates"), rows, docs, work, words, similarity))
    if hot.isEmpty():
        return found

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        links = _joining_links(pdf["rid"].to_numpy(), [np.frombuffer(s, np.uint64) for s in pdf["shingles"]], pdf["root"].to_numpy(), similarity)
        return pd.DataFrame(links, columns=["u", "v"], dtype=np.int64)

    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    mine = F.pmod(F.xxhash64("rid"), blocks)
    cut = hot.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long"))))
    cut = cut.select("rid", "root", "token", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    ids = work.save(hot.select("rid").distinct(), "hot")
    cut = cut.join(work.save(_with_shingles(docs, ids, ids.count(), words, "shingles"), "shingles"), "rid")
    return found.union(work.save(cut.groupBy("token", "p", "q").applyInPandas(tile, "u long, v long"), "tiles"))


def near_copy_groups(docs: DataFrame, work: Workspace, text: str = "text", doc_id: str = "doc_id", rid: str = "rid", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(rid, keep_rid) of every row of docs in a group of near copies; keep_rid is the row of smallest id.

    Two rows are linked if the Jaccard similarity of their sets of `words`-word shingles reaches `similarity`; every such link
    counts, whatever the fingerprints: links by fingerprints are found first, the rest by an exact join. Rows of equal sets stand as one.
    Empty texts share no shingle but are alike: they are one group.
    """
    picked = docs.select(F.col(rid).alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = work.save(_prefixes(picked, work, words, similarity), "prefixes")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("rid").alias("c"))
    repeated = work.save(rows.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(order)["c"].alias("first")).filter("n > 1").drop("n"), "repeated")
    own = work.save(rows.join(sized(repeated, repeated.count(), 40), ["high", "low"]).filter("rid <> first").select(F.col("first").alias("u"), F.col("rid").alias("v")), "copies")
    singles = rows.join(sized(own.select(F.col("v").alias("rid")), own.count(), 16), "rid", "left_anti")
    roots = work.save(components(similar_links(singles, picked, work, words, similarity).union(own), work), "roots")
    grouped = rows.select("rid", "doc_id").join(sized(roots, roots.count(), 24), F.col("rid") == F.col("node"))
    best = grouped.groupBy("root").agg(F.min(order)["c"].alias("keep_rid"))
    return work.save(grouped.select("rid", "root").join(best, "root").select("rid", "keep_rid"), "groups")


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5, similarity: float = 0.8, work: Workspace | None = None) -> DataFrame:
    """docs with one row of each group of near copies, the one of smallest id; columns as they were."""
    work = work or Workspace(docs.sparkSession, "simhash-rows")
    (rid,) = free_name(docs, "row_number")
    held = numbered(docs, rid, work)
    groups = near_copy_groups(held, work, text, doc_id, rid, words, similarity)
    gone = work.save(groups.filter("rid <> keep_rid").select(F.col("rid").alias(rid)), "gone")
    work.only(held, gone)
    return held.join(sized(gone, gone.count(), 16), rid, "left_anti").drop(rid)


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
