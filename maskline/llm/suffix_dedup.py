"""Suffix-array dedup: every byte covered by a LENGTH-byte string that also starts in a document with a smaller id goes.

1. Documents are dealt by row number to shards, a table bucketed by shard, so later steps meet a shard's text without
   shuffling it again. Each LENGTH-byte window of a shard has an anchor: the leftmost of its GRAM-byte grams with the
   least hash. Equal windows have equal anchors, and neighbours share theirs, so one anchor stands for about 14 windows.
2. Each shard sends its distinct anchor hashes, packed and sorted, to the task of their hash range, which answers with two
   bitmaps: which of them other documents have too, and which are so frequent (HOT) that they must be split.
3. A shard sends the stretch of text of each repeated anchor (its windows' bytes), equal stretches once with their least id, to
   the task of the anchor; under a hot anchor, windows go one by one, by a hash of their own, so no task gathers them.
   Text and numbers of all stretches that one shard sends to one range are one compressed row, and go by shuffle alone.
4. That task takes the anchors of its range in PARTS turns. In each it forms bounded groups, suffix-sorts each by Larsson-Sadakane refinement in numpy (8-byte start keys, then
   doubling only what is unsorted), finds the common prefixes by Kasai's method, run over all stretches side by side,
   and merges the groups' sorted windows by binary search. Comparison is by bytes: hashes only route. The least id of each
   window goes back to the shard, which marks covered bytes.

Defined results: null text counts as empty; matches never cross documents; equal ids never remove each other's bytes; a null
id comes after all others, and null ids do not remove each other's; texts under LENGTH bytes lose nothing; texts of any length
are taken whole, in overlapping steps; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace, partitions

LENGTH, GRAM = 50, 24
#: Bytes of text per shard and per hash range, bytes of a suffix-sorted group, and windows hashed at once.
SHARD, RANGE, GROUP, STEP = 8 << 20, 8 << 20, 2 << 20, 1 << 19
#: Turns in which a range's anchors are compared, so memory goes by a turn and the rows between shards and ranges stay few.
PARTS = 4
#: Most buckets that a table may have; beyond that shards and ranges grow with the input.
MOST_SHARDS = 100_000
#: Documents with one anchor beyond which its windows are dealt one by one.
HOT = 1024
#: What is sent of a stretch beside its bytes. An anchor's lowest bits do: two that are taken for one cost time only.
ABOUT = np.dtype([("size", "<u2"), ("low", "<i8"), ("spread", "<i8"), ("gap", "<u4"), ("anchor", "<u4")])
#: An anchor entry is 6 bytes: 45 bits of hash over 3 bits that tell in how many documents of the shard it is.
ENTRY_BITS = 45
COUNT_STEPS = np.array([1, 2, 8, 32, 128, 512, 2048, 8192])
NO_ID = 2**63 - 1


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,)).astype(np.uint64)
    h = words[: len(data) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
    for at, factor in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9)):
        h ^= h >> np.uint64(32)
        h += words[at : at + len(h)]
        h *= np.uint64(factor)
    h ^= h >> np.uint64(29)
    return h


def anchor_runs(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first window, windows, anchor hash) of each run of windows with one anchor; windows stay within the documents that end at ends."""
    span = LENGTH - GRAM + 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    for a in range(0, len(data) - LENGTH + 1, STEP):
        part = data[a : a + STEP + LENGTH - 1]
        n = len(part) - LENGTH + 1
        hashes = _gram_hashes(part)
        least, at, size = hashes, np.zeros(len(hashes), np.uint8), 1
        while size < span:
            step = min(size, span - size)
            right = least[step:]
            less = right < least[: len(right)]
            least = np.minimum(least[: len(right)], right)
            at = np.where(less, at[step:] + np.uint8(step), at[: len(right)])
            size += step
        lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(ends, a + n + LENGTH, "left")
        edge = np.zeros(n + 1, np.int32)
        e, s = ends[lo : hi + 1], starts[lo : hi + 1]
        np.add.at(edge, np.clip(np.maximum(e - LENGTH + 1, s) - a, 0, n), 1)
        np.add.at(edge, np.clip(e - a, 0, n), -1)
        inside = np.cumsum(edge[:-1]) == 0
        anchor = np.arange(n) + at[:n]
        breaks = np.flatnonzero((anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])) + 1
        first = np.concatenate([[0], breaks])
        count = np.diff(np.append(first, n))
        ok = inside[first]
        first, count = first[ok], count[ok]
        yield first + a, count, hashes[anchor[first]]


class Shard:
    """The documents of one shard: rows in order of row number, their bytes end to end."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("rid")
        unpack = zstandard.ZstdDecompressor().decompress
        texts = [unpack(t) for t in table.column("packed").to_pylist()]
        self.rid = table.column("rid").to_numpy()
        self.doc_id = table.column("doc_id")
        self.order = self.doc_id.fill_null(NO_ID).to_numpy()
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, windows, hash of ENTRY_BITS, document) of all runs."""
        parts = list(anchor_runs(self.data, self.ends)) or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        first, count, hashes = (np.concatenate(c) for c in zip(*parts))
        # least hashes are small: mixed again, they spread evenly over the ranges
        mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return first, count, mixed >> np.uint64(64 - ENTRY_BITS), np.searchsorted(self.ends, first, "right")


def _entries(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, code of the number of documents of each, index of each run's hash)."""
    order = np.argsort(hashes, kind="stable")  # runs come by document, so equal hashes stay by document
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    fresh = new.copy()
    fresh[1:] |= d[1:] != d[:-1]
    group = np.cumsum(new) - 1
    docs = np.bincount(group[fresh], minlength=group[-1] + 1 if len(group) else 0)
    index = np.empty(len(h), np.int64)
    index[order] = group
    return h[new], np.searchsorted(COUNT_STEPS, docs, "right") - 1, index


def _bounds(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted hashes."""
    edges = np.array([-(-(r << ENTRY_BITS) // ranges) for r in range(ranges + 1)], np.uint64)
    return np.searchsorted(hashes, edges)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    edges = np.array([-(-(r << ENTRY_BITS) // ranges) for r in range(1, ranges)], np.uint64)
    return np.searchsorted(edges, hashes, "right")


def suffix_sort(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places of data in order of their first `depth` bytes, none taken past the end of its stretch: Larsson-Sadakane refinement.

    Groups of equal rank that are down to one place are done; the others are sorted by the rank `h` further on. Short tails are
    ordered by what they have, as if zero bytes followed.
    """
    n = len(data)
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), ">u8", padded.data, strides=(1,)).astype(np.uint64)
    short = np.maximum(8 - (end - np.arange(n)), 0).astype(np.uint64) * np.uint64(8)
    key = (key >> short) << short
    places = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0

    def renew(where: np.ndarray, base: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
        """Give the places at SA positions `base` their rank, the first position of their group; which are not alone."""
        new = np.ones(len(where), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        heads = np.maximum.accumulate(np.where(new, np.arange(len(where)), 0))
        rank[where] = base[heads] + 1
        alone = new.copy()
        alone[:-1] &= new[1:]
        return ~alone

    positions = np.arange(n)
    open_ = renew(places, positions, key[places])
    h = 8
    while h < depth:
        step = min(h, depth - h)
        positions = positions[open_]
        if not len(positions):
            break
        group = places[positions]
        onward = group + step
        second = np.where(onward < end[group], rank[np.minimum(onward, n)], 0)
        first = rank[group]
        order = np.lexsort((second, first))
        places[positions] = group[order]
        pair = (first[order].astype(np.uint64) << np.uint64(32)) | second[order].astype(np.uint64)
        # all ranks of a round are read before any is written
        open_ = renew(places[positions], positions, pair)
        h += step
    return places


def common_prefixes(data: np.ndarray, order: np.ndarray, firsts: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """For each place of order but the first, the length (up to `most`) it shares with the one before: Kasai's method.

    firsts and counts tell the runs of consecutive places; all runs advance side by side, each keeping its length less one
    where that holds: where the place after the former neighbour is in order too, and before this one. (Order goes no
    deeper than `most`, and places near a stretch's end are not in it, so it may not.)
    """
    where = np.full(len(data) + 1, -1, np.int64)
    where[order] = np.arange(len(order))
    out = np.zeros(len(order), np.int64)
    have, prior = np.zeros(len(firsts), np.int64), np.full(len(firsts), len(data) - 1, np.int64)
    for t in range(int(counts.max()) if len(counts) else 0):
        lanes = np.flatnonzero(counts > t)
        at = firsts[lanes] + t
        row = where[at]
        before = order[np.maximum(row - 1, 0)]
        onward = where[prior[lanes] + 1]
        h = np.where((onward >= 0) & (onward < row), np.maximum(have[lanes] - 1, 0), 0)
        going = np.flatnonzero((row > 0) & (h < most))
        while len(going):
            same = data[at[going] + h[going]] == data[before[going] + h[going]]
            going = going[same]
            h[going] += 1
            going = going[h[going] < most]
        out[row] = h
        have[lanes], prior[lanes] = h, before
    return out


def least_ids(stretches: bytes, sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of stretches: (stretch, place in it, least id over all stretches that have the window)."""
    ends = np.cumsum(sizes)
    cuts = np.concatenate([[0], np.searchsorted(ends, np.arange(GROUP, (ends[-1] if len(ends) else 0) + GROUP, GROUP), "right"), [len(sizes)]])
    cuts = np.unique(np.clip(cuts, 0, len(sizes)))
    groups, merged, least = [], None, None
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        begin = ends[lo] - sizes[lo]
        data = np.frombuffer(stretches, np.uint8)[begin : ends[hi - 1]]
        own_ends, own = ends[lo:hi] - begin, sizes[lo:hi]
        firsts, counts = own_ends - own, own - LENGTH + 1
        stretch = np.repeat(np.arange(hi - lo), own)
        is_window = np.arange(len(data)) < np.repeat(firsts + counts, own)
        order = suffix_sort(data, own_ends, LENGTH)
        order = order[is_window[order]]
        shared = common_prefixes(data, order, firsts, counts, LENGTH)
        new = shared < LENGTH
        new[:1] = True
        heads = np.flatnonzero(new)
        lowest = np.minimum.reduceat(ids[lo:hi][stretch[order]], heads)
        keys = None
        if len(cuts) > 2:
            text = np.empty((len(heads), LENGTH + 1), np.uint8)
            text[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[order[heads]]
            text[:, LENGTH] = 1  # else trailing zero bytes would not count
            keys = text.reshape(-1).view(f"S{LENGTH + 1}")
        if least is None:
            merged, least = keys, lowest
        else:
            spot = np.searchsorted(merged, keys)
            known = merged[np.minimum(spot, len(merged) - 1)] == keys
            np.minimum.at(least, spot[known], lowest[known])
            merged, least = np.insert(merged, spot[~known], keys[~known]), np.insert(least, spot[~known], lowest[~known])
        at = stretch[order]
        groups.append((lo, at.astype(np.int32), (order - firsts[at]).astype(np.int32), (np.cumsum(new) - 1).astype(np.int32), keys))
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = [(lo + s, p, (least if keys is None else least[np.searchsorted(merged, keys)])[c]) for lo, s, p, c, keys in groups]
    return tuple(np.concatenate(c) for c in zip(*out))


def _about(size: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray, anchor: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A row of bytes (of ABOUT) per stretch; between two edges numbers rise, and each is the step from the one before."""
    out = np.zeros(len(size), ABOUT)
    out["size"], out["low"], out["spread"] = size, low, high - low  # wraps around, and back in _stretches
    step = np.diff(number, prepend=0)
    heads = edges[:-1][edges[:-1] < edges[1:]]
    step[heads] = number[heads]
    out["gap"], out["anchor"] = step, anchor & np.uint64(0xFFFFFFFF)
    return out.view(np.uint8).reshape(-1, ABOUT.itemsize)


def _stretches(blob: bytes, n: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(text, what _about had of each stretch, numbers) of a row's n stretches: their ABOUT byte by byte, then their text."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    cut = n * ABOUT.itemsize
    about = np.ascontiguousarray(np.frombuffer(raw, np.uint8, cut).reshape(ABOUT.itemsize, n).T).view(ABOUT).ravel()
    return raw[cut:], about, np.cumsum(about["gap"], dtype=np.int64)


def _blobs(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", with_text: bool = True) -> DataFrame:
    """One row per document, saved: rid, doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary, spans array<struct<a:long,b:long>>.

    Without with_text, kept is null.
    """
    work = Workspace(docs.sparkSession, "suffix")
    spark = docs.sparkSession
    plain = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    total = plain.agg(F.sum(F.octet_length("raw").cast("long")).alias("n")).first()["n"] or 0
    shards = min(MOST_SHARDS, max(partitions(spark), -(-total // SHARD)))
    ranges = min(MOST_SHARDS, max(partitions(spark), -(-total // RANGE)))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([press(t.as_py()) for t in batch.column(2)], pa.binary())], names=["rid", "doc_id", "packed"])

    name = f"maskline_shards_{work.root[-12:]}"
    held = plain.mapInArrow(squeeze, "rid long, doc_id long, packed binary").withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int"))
    held.repartition(shards, "shard").write.bucketBy(shards, "shard").option("compression", "none").option("path", f"{work.root}/shards").saveAsTable(name)
    try:
        return _over_shards(spark.table(name), work, shards, ranges, with_text)
    finally:
        spark.sql(f"DROP TABLE {name}")
        work.delete(f"{work.root}/shards")


def _over_shards(texts: DataFrame, work: Workspace, shards: int, ranges: int, with_text: bool) -> DataFrame:
    """The result of suffix_dedup from the table bucketed by shard, saved."""

    def anchors(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        _, _, hashes, doc = Shard(group).runs()
        found, code, _ = _entries(hashes, doc)
        entry = (found << np.uint64(3)) | code.astype(np.uint64)
        packed = np.ascontiguousarray(entry.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
        edge = _bounds(found, ranges)
        rows = [(r, shard, packed[edge[r] : edge[r + 1]].tobytes()) for r in range(ranges) if edge[r + 1] > edge[r]]
        return _blobs(rows, pa.schema([("range", pa.int32()), ("shard", pa.int32()), ("entries", pa.binary())]))

    def repeated(group: pa.Table) -> pa.Table:
        blobs = group.column("entries").to_pylist()
        sizes = [len(b) // 6 for b in blobs]
        six = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
        wide = np.zeros((len(six), 8), np.uint8)
        wide[:, :6] = six
        entry = wide.view("<u8").ravel()
        del six, wide
        order = np.argsort(entry >> np.uint64(3), kind="stable")
        h = entry[order] >> np.uint64(3)
        heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        docs = np.add.reduceat(COUNT_STEPS[(entry[order] & np.uint64(7)).astype(np.int64)], heads) if len(h) else heads
        total = np.empty(len(h), np.int64)
        total[order] = np.repeat(docs, np.diff(np.append(heads, len(h))))
        at = np.cumsum([0, *sizes])
        rows = [(s, r, np.packbits(total[a:b] > 1).tobytes(), np.packbits(total[a:b] >= HOT).tobytes())
                for s, r, a, b in zip(group.column("shard").to_pylist(), group.column("range").to_pylist(), at[:-1], at[1:])]
        return _blobs(rows, pa.schema([("shard", pa.int32()), ("range", pa.int32()), ("often", pa.binary()), ("hot", pa.binary())]))

    marks = texts.groupBy("shard").applyInArrow(anchors, "range int, shard int, entries binary")
    marks = work.save(marks.groupBy("range").applyInArrow(repeated, "shard int, range int, often binary, hot binary"), "marks")

    out_schema = pa.schema([("range", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("body", pa.binary())])

    def stretches(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows or not answers.num_rows:
            return _blobs([], out_schema)
        number = group.column("shard")[0].as_py()
        own = Shard(group)
        first, count, hashes, doc = own.runs()
        found, _, index = _entries(hashes, doc)
        edge = _bounds(found, ranges)
        often, hot = np.zeros(len(found), bool), np.zeros(len(found), bool)
        for r, a, b in zip(answers.column("range").to_pylist(), answers.column("often").to_pylist(), answers.column("hot").to_pylist()):
            n = edge[r + 1] - edge[r]
            often[edge[r] : edge[r + 1]] = np.unpackbits(np.frombuffer(a, np.uint8), count=n)
            hot[edge[r] : edge[r + 1]] = np.unpackbits(np.frombuffer(b, np.uint8), count=n)
        use = often[index]
        split = use & hot[index]
        whole = use & ~split
        # a run under a hot anchor becomes as many runs of one window
        times = count[split]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first_ = np.concatenate([first[whole], np.repeat(first[split], times) + step])
        size_ = np.concatenate([count[whole], np.ones(len(step), np.int64)]) + LENGTH - 1
        doc_ = np.concatenate([doc[whole], np.repeat(doc[split], times)])
        n_whole = int(whole.sum())
        whole_hash = hashes[whole]
        known: dict[bytes, int] = {}
        raw = own.raw
        number_of = np.fromiter((known.setdefault(raw[a : a + n], len(known)) for a, n in zip(first_.tolist(), size_.tolist())), np.int64, len(first_))
        if not known:
            return _blobs([], out_schema)
        low = np.full(len(known), NO_ID, np.int64)
        np.minimum.at(low, number_of, own.order[doc_])
        high = np.full(len(known), -(2**63), np.int64)
        np.maximum.at(high, number_of, own.order[doc_])
        bodies = list(known)
        key, alone = np.zeros(len(known), np.uint64), np.ones(len(known), bool)
        key[number_of[:n_whole]] = whole_hash
        alone[number_of[:n_whole]] = False
        alone = np.flatnonzero(alone)
        digest = xxhash.xxh3_64_intdigest
        key[alone] = np.fromiter((digest(bodies[k]) for k in alone.tolist()), np.uint64, len(alone)) >> np.uint64(64 - ENTRY_BITS)
        where = _range_of(key, ranges)
        press = zstandard.ZstdCompressor(level=1).compress
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(ranges + 1))
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        about = _about(sizes[order], low[order], high[order], order, key[order], edges)
        rows = []
        for r in range(ranges):
            a, b = edges[r], edges[r + 1]
            if b > a:
                rows.append((r, number, int(b - a), press(about[a:b].T.tobytes() + b"".join([bodies[k] for k in order[a:b].tolist()]))))
        # a shard's own notes come back to it by the way of the others: its range is that of no anchor
        spots = np.stack([doc_, first_ - own.starts[doc_], number_of]).astype("<i8")
        rows.append((-1 - number, number, 0, press(spots.tobytes())))
        return _blobs(rows, out_schema)

    sent = texts.groupBy("shard").cogroup(marks.groupBy("shard")).applyInArrow(stretches, "range int, shard int, n int, body binary")
    back_schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])

    def earlier(group: pa.Table) -> pa.Table:
        owners, counts, blobs = (group.column(c).to_pylist() for c in ("shard", "n", "body"))
        if group.column("range")[0].as_py() < 0:
            return _blobs([(s, 1, b) for s, b in zip(owners, blobs)], back_schema)
        body, about, numbers = zip(*map(_stretches, blobs, counts))
        body, about, numbers = b"".join(body), np.concatenate(about), np.concatenate(numbers)
        shard = np.repeat(np.array(owners), counts)
        ends = np.cumsum(about["size"], dtype=np.int64)
        found = []
        for turn in range(PARTS):
            # a range is told by an anchor's highest bits, a turn by its lowest
            mine = np.flatnonzero(about["anchor"] % PARTS == turn)
            if len(mine):
                found.append(compared(body, ends[mine], about[mine], numbers[mine], shard[mine]))
        runs, owner = (np.concatenate(c, axis=-1) for c in zip(*found))
        order = np.argsort(owner, kind="stable")
        names, at = np.unique(owner[order], return_index=True)
        press = zstandard.ZstdCompressor(level=1).compress
        return _blobs([(int(s), 0, press(np.ascontiguousarray(runs[:, order[a:b]]).tobytes())) for s, a, b in zip(names, at, [*at[1:], len(order)])], back_schema)

    def compared(body: bytes, ends: np.ndarray, about: np.ndarray, numbers: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(stretch number, first window, end, least id) of runs of windows that an earlier document has, and the shard of each."""
        sizes = about["size"].astype(np.int64)
        known: dict[bytes, int] = {}
        kind = np.fromiter((known.setdefault(body[b - n : b], len(known)) for b, n in zip(ends.tolist(), sizes.tolist())), np.int64, len(sizes))
        low, anchor, size = np.full(len(known), NO_ID, np.int64), np.zeros(len(known), np.uint32), np.zeros(len(known), np.int64)
        np.minimum.at(low, kind, about["low"])
        anchor[kind] = about["anchor"]
        size[kind] = sizes
        # windows of an anchor with one stretch only are in no other stretch
        _, family, members = np.unique(anchor, return_inverse=True, return_counts=True)
        lone = np.flatnonzero(members[family] == 1)
        more = np.flatnonzero(members[family] > 1)
        bodies = list(known)
        stretch, place, least = least_ids(b"".join([bodies[k] for k in more.tolist()]), size[more], low[more])
        order = np.lexsort((place, stretch))
        stretch, place, least = more[stretch[order]], place[order].astype(np.int64), least[order]
        new = np.ones(len(stretch), bool)
        new[1:] = (stretch[1:] != stretch[:-1]) | (place[1:] != place[:-1] + 1) | (least[1:] != least[:-1])
        heads = np.flatnonzero(new)
        last = np.append(heads[1:], len(stretch))
        table = np.concatenate([np.stack([stretch[heads], place[heads], place[heads] + last - heads, least[heads]]), np.stack([lone, np.zeros_like(lone), size[lone] - LENGTH + 1, low[lone]])], axis=1)
        table = table[:, np.argsort(table[0], kind="stable")]
        lo, hi = np.searchsorted(table[0], kind, "left"), np.searchsorted(table[0], kind, "right")
        times = hi - lo
        pick = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        sent_as = np.repeat(np.arange(len(kind)), times)
        useful = table[3][pick] < (about["low"] + about["spread"])[sent_as]  # some document of that shard comes after the first that has the windows
        pick, sent_as = pick[useful], sent_as[useful]
        return np.concatenate([numbers[sent_as][None, :], table[1:, pick]]).astype("<i8"), shard[sent_as]

    notes = sent.groupBy("range").applyInArrow(earlier, "shard int, kind int, body binary")
    span = "array<struct<a:bigint,b:bigint>>"

    def finish(group: pa.Table, notes: pa.Table) -> pa.Table:
        own = Shard(group)
        unpack = zstandard.ZstdDecompressor().decompress
        spots, runs = np.zeros((3, 0), np.int64), [np.zeros((4, 0), np.int64)]
        for kind, body in zip(notes.column("kind").to_pylist(), notes.column("body").to_pylist()):
            numbers = np.frombuffer(unpack(body), "<i8")
            if kind:
                spots = numbers.reshape(3, -1)
            else:
                runs.append(numbers.reshape(4, -1))
        runs = np.concatenate(runs, axis=1)
        runs = runs[:, np.argsort(runs[0], kind="stable")]
        lo, hi = np.searchsorted(runs[0], spots[2], "left"), np.searchsorted(runs[0], spots[2], "right")
        times = hi - lo
        pick = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        doc, base = np.repeat(spots[0], times), np.repeat(spots[1], times)
        later = runs[3][pick] < own.order[doc]
        doc, a, b = doc[later], (base + runs[1][pick])[later], (base + runs[2][pick] + LENGTH - 1)[later]
        order = np.lexsort((a, doc))
        doc, a, b = doc[order], a[order] + own.starts[doc[order]], b[order] + own.starts[doc[order]]
        top = np.maximum.accumulate(b) if len(b) else b
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] > top[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        owner, begin, finish_ = doc[heads], a[heads], top[np.append(heads[1:], len(a)) - 1] if len(heads) else a[heads]
        edge = np.searchsorted(owner, np.arange(len(own.rid) + 1))
        kept, removed, spans, digests = [], [], [], []
        for k, (s, e) in enumerate(zip(own.starts.tolist(), own.ends.tolist())):
            cut = list(zip(begin[edge[k] : edge[k + 1]].tolist(), finish_[edge[k] : edge[k + 1]].tolist()))
            left = b"".join([own.raw[x:y] for x, y in zip([s, *(y for _, y in cut)], [*(x for x, _ in cut), e])]) if cut else own.raw[s:e]
            kept.append(left if with_text else None)
            removed.append(e - s - len(left))
            spans.append([{"a": x - s, "b": y - s} for x, y in cut])
            digests.append(hashlib.sha256(left).hexdigest())
        return pa.table(dict(
            rid=pa.array(own.rid), doc_id=own.doc_id, n_bytes=pa.array(own.ends - own.starts), n_removed=pa.array(removed, pa.int64()),
            n_spans=pa.array([len(s) for s in spans], pa.int64()), kept_sha256=pa.array(digests, pa.string()), kept=pa.array(kept, pa.binary()),
            spans=pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
        ))

    done = texts.groupBy("shard").cogroup(notes.groupBy("shard")).applyInArrow(
        finish, f"rid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans {span}")
    out = work.save(done, "result")
    work.drop(marks)
    return out
