"""Substring dedup by content-defined chunking.

A gear hash rolls over the UTF-8 bytes: h = 2h + G[byte], in 32 bits, so it depends on the last 32 bytes only. A chunk ends
after a byte whose hash has its top MASK_BITS bits zero, is at least LEAST and at most MOST bytes long, and is known by the
128-bit XXH3 digest of its bytes. Where no such byte comes in time, it ends at the least hash in the second half of what it may have, so
even text that repeats itself is cut by content. Chunk ends depend on content, so an insertion shifts them only nearby. Of equal chunks the
first (smallest id, then row, then place) stays. Later copies side by side are a run; every run, of one chunk too, is widened
byte by byte as far as it agrees with what stands beside the first copies of its outer
chunks (over REACH bytes, then four times as many for runs that agree on all of those, and so on), and goes if it then has at least `least_run`
bytes; shorter ones are chance repeats and stay. Decisions are taken
on the input as it is, and always against an earlier place, so one copy of every passage stays.

Defined results: null text stays null and has no chunks; empty text has none; a removed edge that would split a UTF-8
character moves to keep the character whole; rows with equal ids are ordered by row; null ids come last; an empty table
gives an empty result; other columns are carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import Workspace, free_name, lean, numbered, sized, slices

LEAST, MASK_BITS, MOST = 24, 5, 256
#: 50 words or so of the shortest kind: runs of repeated chunks below this are left alone.
LEAST_RUN = 120
#: Bytes beside a run that are looked at first, and at most (texts are shorter).
REACH, MOST_REACH = 256, 1 << 30

#: One 32-bit value per byte, from a fixed seed.
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling: 1, 2, 4, ... 32 bytes back."""
    h = GEAR[data]
    for back in (1, 2, 4, 8, 16):
        older = h[:-back] << np.uint32(back)
        h = h.copy()
        h[back:] += older
    return h


def cut_points(text: bytes) -> list[int]:
    """Ends of the chunks of text; the last is its length."""
    n = len(text)
    if not n:
        return []
    hashes = gear_hashes(np.frombuffer(text, np.uint8))
    marks = (np.flatnonzero(hashes < np.uint32(1 << (32 - MASK_BITS))) + 1).tolist()
    ends, start = [], 0

    def forced() -> int:
        least = start + MOST // 2
        return least + int(np.argmin(hashes[least - 1 : start + MOST]))

    for mark in [*marks, n]:
        while mark - start > MOST:
            start = forced()
            ends.append(start)
        if mark - start >= LEAST or mark == n > start:
            start = mark
            ends.append(start)
    return ends


@lean
def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, doc_id, text) to (high, low, doc_id, rid, start, size), a row per chunk."""
    digest = xxhash.xxh3_128_digest
    for batch in slices(batches):
        rids, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, owners, starts, sizes = [], [], [], []
        for k, text in enumerate(batch.column(2).cast(pa.binary())):
            text = text.as_py()
            if not text:
                continue
            ends = cut_points(text)
            begins = [0, *ends[:-1]]
            out.extend(digest(text[a:b]) for a, b in zip(begins, ends))
            owners.extend([k] * len(ends))
            starts.extend(begins)
            sizes.extend(b - a for a, b in zip(begins, ends))
        if not out:
            continue
        both = np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)
        at = pa.array(owners, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])), batch.column(1).take(at), batch.column(0).take(at), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32())],
            names=["high", "low", "doc_id", "rid", "start", "size"],
        )


@lean
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, chunks in order) to a row per run: rid, a, b, and where the first copies of its outer chunks begin and end."""
    for batch in slices(batches):
        chunks = batch.column(1)
        a, b, r, s = (chunks.values.field(k).to_numpy()[chunks.offsets[0].as_py() : chunks.offsets[-1].as_py()] for k in range(4))
        owner = np.repeat(np.arange(len(chunks)), np.diff(chunks.offsets.to_numpy()))
        new = np.ones(len(a), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (a[1:] != b[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(a))[: len(head)] - 1
        columns = [batch.column(0).to_numpy()[owner[head]], a[head], b[tail], r[head], s[head], r[tail], s[tail] + b[tail] - a[tail]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rid", "a", "b", "left_rid", "left_at", "right_rid", "right_at"])


def _agree(x: bytes, y: bytes, back: bool) -> int:
    """Bytes that x and y share at their beginning, or at their end."""
    n, most = 0, min(len(x), len(y))
    while n < most and (x[-1 - n] == y[-1 - n] if back else x[n] == y[n]):
        n += 1
    return n


def joined_spans(spans: list[tuple[int, int, int, int]], least_run: int) -> list[tuple[int, int]]:
    """Runs (a, b, bytes wider on the left, on the right) of at least least_run bytes once widened, joined where they meet."""
    out: list[tuple[int, int]] = []
    for a, b, left, right in spans:
        if b + right - (a - left) >= least_run:
            if out and out[-1][1] >= a - left:
                out[-1] = (min(out[-1][0], a - left), max(out[-1][1], b + right))
            else:
                out.append((a - left, b + right))
    return out


def repeated_runs(rows: DataFrame, work: Workspace, least_run: int = LEAST_RUN) -> DataFrame:
    """(rid, cuts): for each row of (rid, doc_id, text) with something to remove, its byte ranges as an array of struct(a, b) in order."""
    rid, doc_id, text = rows.columns
    chunks = work.save(rows.mapInArrow(_chunks, "high long, low long, doc_id long, rid long, start int, size int"), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("rid").alias("r"), F.col("start").alias("s"))
    firsts = work.save(chunks.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
                       .select("high", "low", F.col("first.r").alias("first_rid"), F.col("first.s").alias("first_start")), "repeated")
    # repeated chunks grow with the input: a join that shuffles at every size
    later = chunks.join(firsts, ["high", "low"]).filter("rid <> first_rid or start <> first_start")
    # a document's chunks are bounded by its length, so they may meet in one row
    one = F.struct(F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b"), F.col("first_rid").alias("r"), F.col("first_start").alias("s"))
    runs = later.groupBy("rid").agg(F.sort_array(F.collect_list(one)).alias("c")).mapInArrow(_runs, "rid long, a int, b int, left_rid long, left_at int, right_rid long, right_at int")
    runs = work.save(runs, "runs")
    raw = F.col(text).cast("binary")

    def widened(some: DataFrame, reach: int) -> DataFrame:
        """(rid, a, b, l, r): by how many bytes, up to reach, each run agrees with its first copies on the left and on the right."""
        n = 2 * some.count()

        def beside(of: str, left_at: str, right_at: str, name: str) -> DataFrame:
            """The bytes left of left_at and right of right_at in the rows that left_rid and right_rid (or rid) name."""
            key = lambda side: F.col("rid" if of == "own" else f"{side}_rid")
            sides = [some.select(key(side).alias("src"), F.col(at).alias("at"), F.lit(side == "left").alias("is_left"), "rid", "a", "b") for side, at in (("left", left_at), ("right", right_at))]
            asked = sides[0].unionByName(sides[1])
            start = F.greatest(F.col("at") - reach, F.lit(0))
            near = F.when(F.col("is_left"), F.substring(raw, start + 1, F.col("at") - start)).otherwise(F.substring(raw, F.col("at") + 1, F.lit(reach)))
            return rows.select(F.col(rid).alias("src"), F.col(text)).join(sized(asked, n, 48), "src").select("rid", "a", "b", "is_left", near.alias(name))

        both = beside("own", "a", "b", "mine").join(beside("first", "left_at", "right_at", "other"), ["rid", "a", "b", "is_left"])

        @lean
        def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                width = [_agree(x.as_py(), y.as_py(), left) for x, y, left in zip(batch.column(4), batch.column(5), batch.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(width, pa.int32())], names=["rid", "a", "b", "is_left", "wider"])

        wide = both.select("rid", "a", "b", "is_left", "mine", "other").mapInArrow(widen, "rid long, a int, b int, is_left boolean, wider int")
        pick = lambda left: F.max(F.when(F.col("is_left") == left, F.col("wider")))
        return wide.groupBy("rid", "a", "b").agg(pick(True).alias("l"), pick(False).alias("r"))

    # what agrees as far as it was looked at is looked at four times as far, so no row carries much more than it agrees on
    done, reach, some = [], REACH, runs
    while True:
        wide = work.save(widened(some, reach), "widened")
        done.append(wide.filter(F.greatest("l", "r") < reach) if reach < MOST_REACH else wide)
        far = wide.filter(F.greatest("l", "r") >= reach)
        if reach == MOST_REACH or far.isEmpty():
            break
        some = work.save(runs.join(far.select("rid", "a", "b"), ["rid", "a", "b"], "left_semi").select(*runs.columns), "far")
        reach = min(4 * reach, MOST_REACH)
    each = done[0]
    for part in done[1:]:
        each = each.unionByName(part)

    @lean
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [joined_spans([(s["a"], s["b"], s["l"], s["r"]) for s in spans], least_run) for spans in batch.column(1).to_pylist()]
            cuts = pa.array([[{"a": a, "b": b} for a, b in f] for f in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), cuts], names=["rid", "cuts"]).filter(pa.array([bool(f) for f in found], pa.bool_()))

    spans = each.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("a", "b", "l", "r"))).alias("s"))
    return work.save(spans.mapInArrow(join, "rid long, cuts array<struct<a:int,b:int>>"), "cuts")


def without(text: bytes, cuts: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """text without the ranges, each first shrunk to whole UTF-8 characters; and those ranges."""
    out, used, at = [], [], 0
    for a, b in cuts:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append(text[at:a])
            used.append((a, b))
            at = b
    out.append(text[at:])
    return b"".join(out), used


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_run: int = LEAST_RUN, work: Workspace | None = None) -> DataFrame:
    """docs with text shortened, and two more columns: removed_bytes long, removed_spans array<struct<a:int,b:int>> (bytes of the input).

    Columns of docs that have these two names are replaced.
    """
    docs = docs.drop("removed_bytes", "removed_spans")
    work = work or Workspace(docs.sparkSession, "chunks")
    rid, cuts = free_name(docs, "row_number", "cuts")
    held = numbered(docs, rid, work)
    runs = repeated_runs(held.select(F.col(rid), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), work, least_run)
    work.only(held, runs)
    runs = runs.select(F.col("rid").alias(rid), F.col("cuts").alias(cuts))
    size = runs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size(cuts)), F.lit(0)).alias("spans")).first()
    joined = held.join(sized(runs, 1, 64 * size["n"] + 32 * size["spans"]), rid, "left").drop(rid)
    at_text, at_cuts = joined.columns.index(text), joined.columns.index(cuts)
    schema = T.StructType(list(docs.schema.fields))
    span = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
    schema = schema.add("removed_bytes", T.LongType()).add("removed_spans", span)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, gone, spans = [], [], []
            for value, found in zip(batch.column(at_text).cast(pa.binary()), batch.column(at_cuts)):
                value, found = value.as_py(), found.as_py()
                used: list[tuple[int, int]] = []
                if value is not None and found:
                    value, used = without(value, [(s["a"], s["b"]) for s in found])
                texts.append(value)
                gone.append(sum(b - a for a, b in used))
                spans.append([{"a": a, "b": b} for a, b in used])
            columns = {c: batch.column(k) for k, c in enumerate(batch.schema.names) if k != at_cuts}
            columns[text] = pa.array(texts, pa.binary()).cast(batch.schema.field(at_text).type)
            columns["removed_bytes"] = pa.array(gone, pa.int64())
            columns["removed_spans"] = pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=[f.name for f in schema])

    return joined.mapInArrow(cut, schema)


def drop_repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", work: Workspace | None = None) -> DataFrame:
    """docs with repeated passages cut from their text; rows and columns as they were."""
    names = {c: name for c, name in zip(("removed_bytes", "removed_spans"), free_name(docs, "own_removed_bytes", "own_removed_spans")) if c in docs.columns}
    found = substring_dedup(docs.withColumnsRenamed(names), text, doc_id, work=work).drop("removed_bytes", "removed_spans")
    return found.withColumnsRenamed({new: c for c, new in names.items()})
