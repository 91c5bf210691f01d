"""Each training-data operator against a plain Python version, with nulls, ties, repeats, long texts and clashing names."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from maskline.llm import (
    bpe, chunk_dedup, embedding_dedup, exact_dedup, line_dedup, packing, quality, simhash, storage, suffix_dedup, toxicity,
)
from maskline.llm.graph import components
from maskline.llm.storage import Workspace
from maskline.sources.saved import shared_dir

SCHEMA = "doc_id long, text string, rid string, RID_ string, fp string, gone string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "r", "R", "f", "g") for i, t in rows], SCHEMA)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(rng, 60)
    rows = [(i, words(rng, rng.randint(1, 80))) for i in range(20, 40)]
    rows += [(1, base), (2, base), (3, base.replace(" ", "  \n")), (4, " ".join(near)), (5, None), (6, ""), (7, " \t"), (None, base), (None, "one two"), (9, "one two"), (9, "one two")]
    rows += [(11, words(rng, 30) + " " + passage + " " + words(rng, 30)), (12, words(rng, 10) + " " + passage), (13, "long " * 30000), (14, "é" * 400 + " ü"), (15, "Ab\x00c İ ß" * 9)]
    return rows


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (3, 1), (20, 21), (21, 22), (22, 23), (23, 24), (24, 8)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long"), Workspace(spark, "test")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 20: 8, 21: 8, 22: 8, 23: 8, 24: 8}
    assert components(spark.createDataFrame([], "u long, v long"), Workspace(spark, "test")).count() == 0


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_byte_level_bpe(spark, corpus):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows = corpus + [(100, "▁ <|endoftext|> 日本語  😀 don't 12345\r\n  x")]
    got = bpe.round_trip(frame(spark, rows), path, public_tokenizers.PATTERN).collect()
    want = []
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    both = bpe.decode_documents(bpe.encode_documents(frame(spark, rows), path, public_tokenizers.PATTERN), path).collect()
    assert sorted(bytes(r["text"]) for r in both) == sorted((t or "").encode() for _, t in rows)
    assert bpe.round_trip(frame(spark, []), path, public_tokenizers.PATTERN).count() == 0


def plain_fingerprint(text, width=3):
    parts = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(parts[k : k + width]) for k in range(len(parts) - width + 1)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(n, linked):
    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = sorted((root[a], root[b]))
                root = [x if r == y else r for r in root]
    return root


def test_simhash(spark, corpus):
    got = simhash.simhash_groups(frame(spark, corpus), Workspace(spark, "test")).select("doc_id", simhash.hexadecimal().alias("f"), "component_id").collect()
    prints = [plain_fingerprint(t) for _, t in corpus]
    root = closure(len(corpus), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    least = {r: min((i for (i, _), q in zip(corpus, root) if q == r and i is not None), default=None) for r in root}
    assert sorted(map(tuple, got), key=str) == sorted([(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(corpus, prints, root)], key=str)
    assert simhash.simhash_groups(frame(spark, []), Workspace(spark, "test")).count() == 0


def test_simhash_search_finds_every_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 8)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    values = []
    for seed in rng.integers(0, 2**63, 12, dtype=np.uint64):
        values.append(int(seed))
        for _ in range(40):
            x = values[-1 - int(rng.integers(0, min(5, len(values))))]
            for b in rng.integers(0, 64, int(rng.integers(1, 4))):
                x ^= 1 << int(b)
            values.append(x)
    values = sorted(set(values))
    for limit in (3, 6):
        signed = [v - (1 << 64) if v >> 63 else v for v in values]
        work = Workspace(spark, "test")
        edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), work, limit)
        assert all(((r["u"] ^ r["v"]) & (2**64 - 1)).bit_count() <= limit for r in edges.collect())
        got = {r["node"]: r["root"] for r in components(edges, work).collect()}
        root = closure(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= limit)
        classes = {}
        for v, r in zip(signed, root):
            classes.setdefault(r, set()).add(v)
        for members in classes.values():
            assert len({got.get(v, v) for v in members}) == 1
        assert len({got.get(v, v) for v in signed}) == len(classes)


@pytest.mark.parametrize("seed", [1, 2])
def test_thresholds_cover_every_split(seed):
    """Generalised pigeonhole: thresholds plus one sum to more than the limit."""
    rng = np.random.default_rng(seed)
    bits = rng.random((500, 64)) < rng.random(64)
    together = (bits.T.astype(float) @ bits)
    for limit, n in ((3, 500), (3, 10**7), (7, 10**5)):
        chosen = simhash.plan(together * (n / 500), n, limit)
        assert sum(t + 1 for _, t in chosen) == limit + 1
        used = [b for part, _ in chosen for b in part]
        assert len(used) == len(set(used))


def test_near_copies_leave_one(spark, corpus):
    left = {r["doc_id"]: r["text"] for r in simhash.drop_near_copies(frame(spark, corpus)).collect()}
    assert 1 in left and not {2, 3, 4} & left.keys()
    assert {11, 12, 13, 14, 15, *range(20, 40)} <= left.keys()
    assert simhash.drop_near_copies(frame(spark, corpus)).columns == frame(spark, []).columns


def plain_near_copies(rows):
    """Ids left by brute force over all pairs: Jaccard similarity of 0.8 or more on five-word shingles."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = closure(len(rows), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    return sorted(least.values())


def test_near_copies_in_hot_buckets_are_verified_before_the_forest(spark, monkeypatch):
    """Buckets over HOT whose rows are linked to some of the others only, in one block and in many."""
    monkeypatch.setattr(simhash, "HOT", 4)
    rng = random.Random(21)
    rows = []
    for g in range(6):
        base = words(rng, 300).split()
        for k in range(12):
            # rows that lack about a tenth of the base's shingles, and one that differs from a row by a word
            edited = list(base)
            for at in rng.sample(range(300), rng.randint(3, 9)):
                edited[at] = words(rng, 1)
            rows.append((g * 100 + 2 * k, " ".join(edited)))
            edited[rng.randrange(300)] = words(rng, 1)
            rows.append((g * 100 + 2 * k + 1, " ".join(edited)))
    for block in (2048, 5):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert sorted(r["doc_id"] for r in simhash.drop_near_copies(frame(spark, rows)).collect()) == plain_near_copies(rows)


def test_near_copies_far_in_fingerprint_are_found(spark):
    """Short texts with one or two words changed: 0.8 or more in Jaccard, often many fingerprint bits apart."""
    rng = random.Random(22)
    rows = []
    for g in range(60):
        base = words(rng, 110).split()
        other = list(base)
        for at in rng.sample(range(110), 2):
            other[at] = words(rng, 1)
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    prints = [plain_fingerprint(t) for _, t in rows]
    assert any((prints[k] ^ prints[k + 1]).bit_count() > 7 for k in range(0, 120, 2))
    assert sorted(r["doc_id"] for r in simhash.drop_near_copies(frame(spark, rows)).collect()) == plain_near_copies(rows)


def test_near_copies_go_by_fingerprints_first(spark, monkeypatch):
    """Links come from the fingerprint search, verified; pairs that it has joined are not looked at again, and what it misses is found."""
    rng = random.Random(24)
    rows = []
    for g in range(12):
        base = words(rng, 400).split()
        near, far = list(base), list(base)
        near[200] = words(rng, 1)
        for at in rng.sample(range(400), 8):
            far[at] = words(rng, 1)
        rows += [(10 * g + k, " ".join(t)) for k, t in enumerate((base, near, far))]
    prints = [plain_fingerprint(t) for _, t in rows]
    close = sum((prints[3 * g] ^ prints[3 * g + 1]).bit_count() <= 3 for g in range(12))
    asked, verified, searches, links = [], simhash._verified, [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda firsts, *more: searches.append(firsts.count()) or links(firsts, *more))
    monkeypatch.setattr(simhash, "_verified", lambda pairs, *more: asked.append({(r["u"], r["v"]) for r in pairs.collect()}) or verified(pairs, *more))
    assert sorted(r["doc_id"] for r in simhash.drop_near_copies(frame(spark, rows)).collect()) == plain_near_copies(rows)
    assert searches == [len(set(prints))] and len(asked[0]) >= close > 3 and not asked[0] & set().union(*asked[1:])


def test_near_copies_behind_one_fingerprint_are_found(spark):
    """A shingle repeated so often that it fixes every bit: the rows of the one fingerprint are alike only among themselves."""
    rng = random.Random(23)
    often, rows = "tick " * 2000, []
    for g in range(8):
        tail = words(rng, 100).split()
        rows.append((10 * g, often + " ".join(tail)))
        tail[50] = words(rng, 1)
        rows.append((10 * g + 1, often + " ".join(tail)))
    assert len({plain_fingerprint(t) for _, t in rows}) == 1
    assert sorted(r["doc_id"] for r in simhash.drop_near_copies(frame(spark, rows)).collect()) == plain_near_copies(rows) == list(range(0, 80, 10))


def test_chunks_cover_text_and_survive_insertion():
    rng = random.Random(7)
    text = words(rng, 3000).encode()
    ends = chunk_dedup.cut_points(text)
    assert ends[-1] == len(text) and all(0 < b - a <= chunk_dedup.MOST for a, b in zip([0, *ends], ends))
    h, slow = 0, []
    for byte in text[:300]:
        h = (2 * h + int(chunk_dedup.GEAR[byte])) % 2**32
        slow.append(h)
    assert slow == chunk_dedup.gear_hashes(np.frombuffer(text[:300], np.uint8)).tolist()
    moved = b"inserted here " + text
    a = {text[x:y] for x, y in zip([0, *ends], ends)}
    other = chunk_dedup.cut_points(moved)
    b = {moved[x:y] for x, y in zip([0, *other], other)}
    assert len(a & b) > 0.95 * len(a)
    assert chunk_dedup.cut_points(b"") == []


def test_substring_dedup(spark, corpus):
    got = chunk_dedup.substring_dedup(frame(spark, corpus)).collect()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None and r["doc_id"] != 9}
    text = dict((i, t) for i, t in corpus)
    assert by[1]["removed_bytes"] == 0 and by[2]["text"] == "" and by[11]["removed_bytes"] == 0
    assert by[12]["removed_bytes"] >= 0.75 * len(text[12])
    assert by[5]["text"] is None and by[6]["text"] == ""
    for i in range(20, 40):
        assert by[i]["text"] == text[i]
    for r in got:
        if r["text"] is not None and r["removed_spans"] and r["doc_id"] is not None:
            raw = text[r["doc_id"]].encode()
            for s in reversed(r["removed_spans"]):
                raw = raw[: s["a"]] + raw[s["b"] :]
            assert raw.decode() == r["text"]
    assert chunk_dedup.drop_repeated_passages(frame(spark, [])).count() == 0


def test_passages_with_one_short_shared_chunk_go(spark):
    """A single shared chunk of under 48 bytes is widened to the passage it stands in."""
    rng = random.Random(41)
    rows, short = [], []
    while len(short) < 5:
        passage = words(rng, 45)
        a, b = (f"{words(rng, 30)} {passage} {words(rng, 30)}" for _ in range(2))
        chunks = [{t[x:y] for x, y in zip([0, *ends], ends)} for t in (a.encode(), b.encode()) for ends in [chunk_dedup.cut_points(t)]]
        if len(shared := chunks[0] & chunks[1]) == 1 and len(shared.pop()) < 48:
            short.append((len(rows) + 1, len(passage)))
            rows += [(len(rows), a), (len(rows) + 1, b)]
    got = {r["doc_id"]: r["removed_bytes"] for r in chunk_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert all(n <= got[i] <= n + 4 for i, n in short)


def test_forced_cuts_follow_the_content():
    """Text without marks is cut alike whatever stands before it."""
    for body in (b"ab" * 5000, b"\x00" * 9000, b"abcdefg" * 3000):
        one, two = (chunk_dedup.cut_points(t) for t in (body, b"xyz" + body))
        parts = [{t[a:b] for a, b in zip([0, *e], e)} for t, e in ((body, one), (b"xyz" + body, two))]
        assert parts[0] & parts[1] and all(b - a <= chunk_dedup.MOST for a, b in zip([0, *two], two)) and two[-1] == len(body) + 3


def test_widening_goes_on_beyond_its_reach(spark, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "REACH", 4)
    rng = random.Random(17)
    passage = words(rng, 120)
    rows = [(1, words(rng, 40) + " # " + passage + " # " + words(rng, 40)), (2, words(rng, 40) + " @ " + passage + " @ " + words(rng, 40))]
    got = {r["doc_id"]: r["removed_bytes"] for r in chunk_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert got[1] == 0 and len(passage) <= got[2] <= len(passage) + 4


def test_chunks_go_in_small_pieces():
    """Long batches come out in pieces, so memory goes by a piece; the rows are the same."""
    rng = random.Random(28)
    texts = [words(rng, rng.randrange(200)) or None for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500), pa.int64()), pa.array(range(1500), pa.int64()), pa.array(texts)], names=["rid", "doc_id", "text"])
    out = list(chunk_dedup._chunks(iter([batch])))
    assert len(out) == 3 and [len(set(o.column(3).to_pylist())) <= 512 for o in out] == [True] * 3
    rows = [(o["rid"], o["start"], o["size"]) for b in out for o in b.to_pylist()]
    assert rows == [(k, a, b - a) for k, t in enumerate(texts) if t for ends in [chunk_dedup.cut_points(t.encode())] for a, b in zip([0, *ends], ends)]


def test_workers_keep_one_store_while_asked_for(spark):
    """A Python worker outlives its stage: it holds one store, the one asked for last, and none after a task that asks for none."""
    held = []

    def task(*make):
        def run(batches):
            held.append(storage.worker_store(*make) if make else None)
            yield from batches

        return list(storage.lean(run)(iter([1, 2])))

    assert task(dict) == task(dict) == [1, 2] and held[0] is held[1]
    task(list, "ab")
    assert held[2] == ["a", "b"] and storage._store == [(list, "ab"), held[2]]
    task()
    assert storage._store == []
    storage.worker_store(dict)
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([1], pa.int64()), pa.array(["one two"])], names=["rid", "doc_id", "text"])
    assert len(list(chunk_dedup._chunks(iter([batch])))) == 1 and storage._store == []

    def stores(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(storage._store)], pa.int64())], names=["n"])

    one = spark.range(1).repartition(1)
    path = public_tokenizers.path("word_bpe_49k.json")

    @storage.lean
    def asks(batches):  # a closure, which is sent to the worker by value
        packing.encoder_for(path)
        yield from stores(batches)

    assert [r["n"] for r in one.mapInArrow(asks, "n long").collect()] == [2]


def test_runs_of_chunks_by_arrays():
    rng = random.Random(27)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("r", pa.int64()), ("s", pa.int32())]))
    docs, want = [], []
    for rid in range(50):
        at, chunks = 0, []
        for _ in range(rng.randrange(6)):
            at += rng.choice((0, 0, 30))
            size = rng.randint(24, 60)
            first, place = rng.randrange(2**40), rng.randrange(1000)
            if chunks and chunks[-1]["b"] == at:
                want[-1][2], want[-1][5], want[-1][6] = at + size, first, place + size
            else:
                want.append([rid, at, at + size, first, place, first, place + size])
            chunks.append({"a": at, "b": at + size, "r": first, "s": place})
            at += size
        docs.append(chunks)
    batch = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array(docs, kind)], names=["rid", "c"])
    for parts in ([batch], [batch.slice(0, 20), batch.slice(20, 0), batch.slice(20)]):
        out = list(chunk_dedup._runs(iter(parts)))
        assert [list(r.values()) for o in out for r in o.to_pylist()] == want
        assert [f.type for f in out[0].schema] == [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    chunks = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip((range(0, 30 * 10**5, 30), range(30, 30 * 10**5 + 30, 30), range(10**5), range(10**5)), kind.value_type)], fields=list(kind.value_type))
    large = pa.RecordBatch.from_arrays([pa.array([5], pa.int64()), pa.ListArray.from_arrays(pa.array([0, 10**5], pa.int32()), chunks)], names=["rid", "c"])
    tracemalloc.start()
    assert list(chunk_dedup._runs(iter([large])))[0].to_pylist()[0]["b"] == 30 * 10**5
    assert tracemalloc.get_traced_memory()[1] < 100 * 10**5  # over 30 MB as a dictionary per chunk
    tracemalloc.stop()


def test_substring_dedup_recall_by_length(spark):
    """Passages of a length, each in two documents: the share that is found, which the README states."""
    rng = random.Random(23)
    for size, least in ((45, 0.9), (60, 0.97), (90, 0.99)):
        rows = []
        for _ in range(120):
            passage = words(rng, size)
            rows += [(len(rows) + k, words(rng, 30) + " " + passage + " " + words(rng, 30)) for k in range(2)]
        got = {r["doc_id"]: r["removed_bytes"] for r in chunk_dedup.substring_dedup(frame(spark, rows)).collect()}
        assert all(got[i] == 0 for i in got if i % 2 == 0)
        assert sum(got[i] > 0 for i in got if i % 2) >= least * 120


def test_toxicity(spark):
    rng = random.Random(5)
    bad = ["grubble", "snarkfit", "mudwit"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        text = words(rng, 30) + (" " + rng.choice(bad) + " " + words(rng, 5) if toxic else "")
        rows.append((i, text))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "grubble"), (1002, "Grubble! snarkfit"), (1003, "x " * 40000)]
    labels += [(0, None), (77777, 1)]
    frame_labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(frame(spark, rows), frame_labels).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if i is not None and i < 600:
            assert r["predicted"] == int(i % 5 == 0)
    assert got[1002]["predicted"] == 1 and got[1000]["predicted"] == got[1001]["predicted"] == 0
    empty = toxicity.toxicity(frame(spark, rows[:3]), frame_labels.limit(0)).collect()
    assert [r["score"] for r in empty] == [0.5] * 3


def test_toxicity_finds_the_example_that_is_alike_without_telling_terms(spark):
    """A text word for word like a labelled example has that example as its neighbour, though none of its terms stands for a label."""
    rng = random.Random(31)
    rows = [(i, words(rng, 30) + (" grubble" if i % 5 == 0 else "")) for i in range(400)]
    odd = [i for i in range(400, 440) if zlib.crc32(str(i).encode()) % 4 != 2][:5]
    rows += [(i, " ".join(f"odd{i}word{k}" for k in range(20))) for i in odd]
    rows += [(1000 + i, dict(rows)[i]) for i in odd]
    labels = spark.createDataFrame([(i, int(i % 5 == 0 or i >= 400)) for i, _ in rows if i < 1000], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(frame(spark, rows), labels).collect()}
    for i in odd:
        assert got[1000 + i]["predicted"] == 1
        assert got[1000 + i]["neighbours"][0]["id"] == i and got[1000 + i]["neighbours"][0]["cosine"] > 0.999


def test_terms_are_looked_up_together(monkeypatch):
    """Texts never go through a dictionary word by word; counts equal those of single texts, in any grouping."""
    rng = random.Random(34)
    texts = [None, "", " ", "A_b x1 a. B-a zz", "\x00\x1c\x7fa\tb\x0bc", "É a É İ ǅ ª²", "日本 a", *("".join(rng.choices("abAB_1 .\n-\x1dé", k=rng.randrange(40))) for _ in range(300))]
    some = sorted({w for t in texts[::2] for w in toxicity.term_counts(t)} | {"a", "é"})
    known, names = {w: k for k, w in enumerate(some)}, pa.array(some)
    want = [sorted(toxicity.term_counts(t, known).items()) for t in texts]
    for together in (1, 100, 1 << 22):
        monkeypatch.setattr(toxicity, "LOOK_UP", together)
        assert [list(map(tuple, c.tolist())) for c in toxicity.coded(texts, names)] == want
    assert [len(c) for c in toxicity.coded(["a b", "é"], pa.array([], pa.string()))] == [0, 0] and list(toxicity.coded([], names)) == []
    monkeypatch.setattr(toxicity, "term_counts", None)
    assert [c.tolist() for c in toxicity.coded(["a A é", None], names)] == [[[known["a"], 2], [known["é"], 1]], []]
    index = toxicity.Index([{0: 1, 7: 2}, {3: 1}], np.array([0, 1]), np.arange(2), np.arange(1.0, 9.0))
    for a, b in zip(index.unit_arrays({7: 2, 0: 4, 3: 1}), index.unit_arrays(np.array([[0, 4], [3, 1], [7, 2]]))):
        assert a.tolist() == b.tolist()


def test_search_over_many_terms_is_exact():
    rng = np.random.default_rng(2)
    idf = rng.random(400) * 6 + 1
    vectors = [{int(t): int(rng.integers(1, 5)) for t in (400 * rng.random(rng.integers(5, 60)) ** 3).astype(int)} for _ in range(1500)]
    index = toxicity.Index(vectors, rng.integers(0, 2, 1500), np.arange(1500), idf)
    dense = np.zeros((1500, 400))
    for k, v in enumerate(vectors):
        for t, w in index.unit(v).items():
            dense[k, t] = w
    for k in range(80):
        want = np.sort(dense @ dense[k])[::-1][:25]
        assert np.allclose([s for s, _ in index.nearest(index.unit(vectors[k]))], want[want > 0])


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    vectors = [{int(t): int(rng.integers(1, 5)) for t in rng.choice(30, rng.integers(0, 6), replace=False)} for _ in range(900)]
    index = toxicity.Index(vectors, rng.integers(0, 2, 900), np.arange(900), rng.random(30) + 0.5)
    units = [index.unit(v) for v in vectors]
    for v in units[:60]:
        if v:
            every = sorted(((-sum(w * u.get(t, 0) for t, w in v.items()), i) for i, u in enumerate(units)))
            want = [(-round(s, 9), i) for s, i in every if s < 0][:25]
            found = index.nearest(v)
            assert [round(s, 9) for s, _ in found] == [s for s, _ in want]


def test_toxicity_query_against_brute_force(spark):
    """Neighbours, cosines and votes of every document, with idf over all documents, from plain dictionaries; scores rise with the votes."""
    import math
    from collections import Counter

    rng = random.Random(8)
    rows = [(i, words(rng, rng.randint(0, 12)) + (" mudwit" if i % 4 == 0 else "")) for i in range(260)] + [(260, None), (261, "only here")]
    labels = {i: int(i % 4 == 0 or i % 37 == 0) for i in range(0, 200)}
    got = {r["doc_id"]: r for r in toxicity.toxicity(frame(spark, rows), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")).collect()}
    counts = {i: Counter((t or "").lower().split()) for i, t in rows}
    train = sorted(i for i in labels if zlib.crc32(str(i).encode()) % 4 != 2)
    df = Counter(t for c in counts.values() for t in c)
    seen, bad = Counter(t for i in train for t in counts[i]), Counter(t for i in train if labels[i] for t in counts[i])
    n, n1 = len(train), sum(labels[i] for i in train)

    def g(t):
        cells = [(bad[t], seen[t] * n1 / n), (seen[t] - bad[t], seen[t] * (n - n1) / n), (n1 - bad[t], (n - seen[t]) * n1 / n), (n - n1 - seen[t] + bad[t], (n - seen[t]) * (n - n1) / n)]
        return max(0.0, sum(2 * o * math.log(o / e) for o, e in cells if o > 0))

    def unit(c):
        w = {t: (1 + math.log(k)) * (math.log((1 + len(rows)) / (1 + df[t])) + 1) * (1 + g(t)) for t, k in c.items() if t in seen}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    units = {i: unit(counts[i]) for i in counts}
    share = sum(labels[i] for i in train if units[i]) / sum(bool(units[i]) for i in train)
    votes = {}
    for i, u in units.items():
        near = sorted((-sum(w * units[j].get(t, 0) for t, w in u.items()), j) for j in train if units[j])
        near = [(-s, j) for s, j in near if s < 0][:25]
        assert np.allclose([s for s, _ in near], [x["cosine"] for x in got[i]["neighbours"]])
        assert all(abs(sum(w * units[x["id"]].get(t, 0) for t, w in u.items()) - x["cosine"]) < 1e-9 and x["label"] == labels[x["id"]] for x in got[i]["neighbours"])
        if near:
            votes[i] = (sum(s * x["label"] for s, x in zip([s for s, _ in near], got[i]["neighbours"])) + 0.5 * share) / (sum(s for s, _ in near) + 0.5)
    order = sorted(votes, key=votes.get)
    assert all(got[a]["score"] <= got[b]["score"] + 1e-9 for a, b in zip(order, order[1:])) and len({got[i]["score"] for i in order}) > len(order) // 2


def test_toxicity_of_nothing_and_of_labels_of_one_kind(spark):
    labels = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int")
    assert toxicity.toxicity(frame(spark, []), labels).collect() == []
    one = toxicity.toxicity(frame(spark, [(i, "same words") for i in range(9)] + [(9, None)]), labels).collect()
    assert all(r["score"] < 0.3 and r["predicted"] == 0 for r in one)
    few = toxicity.toxicity(frame(spark, [(i, f"word{i} other") for i in range(40)]), spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"), most=10, pairs=7).collect()
    assert max(len(r["neighbours"]) for r in few) <= 3 and len(few) == 40


def test_word_encoder_and_packing(spark, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = corpus + [(98, "hello <|endoftext|> x<|EndOfText|>y <|endoftext|>")]
    rows += [(100, "It's we'll a\x1cb ΣΑΣ J̌ x'y <|endoftext|> 日本語 a.b, c., 12a")]
    got = packing.pack(frame(spark, rows), path).collect()
    want = []
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            want.append((i, p, a, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in bins.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack(frame(spark, []), path).count() == 0


def test_texts_are_split_as_the_tokenizer_splits_them():
    """Ids come from the tokenizer's own pieces, so a word beside marks or digits is encoded once; with characters of every kind beside each other."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, encoder, rng = Tokenizer.from_file(path), packing.WordEncoder(path), random.Random(33)
    texts = [f"{a}{c}{b}" for c in map(chr, [*range(0x380), 0x0958, 0x2C65, 0x3000, 0xAC00]) for a, b in (("", ""), ("a", "B"), ("'", "s"), ("!'", "'ll,"), (" X", "1. "))]
    kinds = list("abcXYZ'  \n\t.,!?;:|0123'stvemld\"-_é ßÀŻǅǰİıΣσ\u0301 \u0085²½ªʰ日本ПрȺ\u00a0\u2028\u3000\x1c\ufeff\u200b") + ["क\u093c", "\u0958,"]
    texts += ["".join(rng.choices(kinds, k=rng.randrange(60))) for _ in range(3000)]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, got, ids in zip(texts, encoder.encode_all(texts), want) if got != ids] == []
    calls, ids = [], encoder._ids
    encoder._ids, encoder._letters = (lambda words: calls.append(words) or ids(words)), (lambda words, own=encoder._letters: calls.append(words) or own(words))
    encoder.encode("zyzzyx (zyzzyx) zyzzyx1 -zyzzyx- 'Zyzzyx'")
    assert sum(words.count("zyzzyx") for words in calls) == 1 and not any(w != "zyzzyx" and "zyzzyx" in w.lower() for words in calls for w in words)


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 8, 9)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    assert bins.place(5) == (4, 0)  # bin 3, the fullest, closes
    assert bins.place(1) == (2, 8)


def test_quality(spark):
    rng = random.Random(6)
    good = [(i, words(rng, 40).capitalize() + ".") for i in range(300)]
    junk = [(i, (words(rng, 1) + " ") * 40 if i % 2 else words(rng, 30).upper().replace(" ", "!! ")) for i in range(300, 360)]
    rows = good + junk + [(1000, None), (1001, ""), (None, good[0][1]), (0, good[0][1])]
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(0, 360, 2)] + [(301, 0), (303, 0), (4, None), (99999, 1)], "doc_id long, quality int")
    got = quality.quality_scores(frame(spark, rows), labels, Workspace(spark, "test"), keep=304 / 364).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 360:
            assert r["kept"] == (r["doc_id"] < 300), r
    kept = quality.drop_low_quality(frame(spark, rows), labels)
    assert kept.columns == frame(spark, []).columns and kept.filter("doc_id < 300").count() == 301
    assert quality.drop_low_quality(frame(spark, rows), labels.limit(0)).count() == len(rows)
    assert quality.drop_low_quality(frame(spark, []), labels).count() == 0


def test_quality_against_brute_force(spark):
    """Weights, keys and the kept rows of the whole operator, from plain counts; the noise decides some of them."""
    import math

    rng = random.Random(12)
    rows = [(i, words(rng, rng.randint(0, 3)) + (" zz" if i % 3 == 0 else "")) for i in range(400)] + [(401, None), (5, "again"), (402, "!!!! ???")]
    labels = {i: int(i % 3 != 0) for i in range(0, 200)}
    frame_labels = spark.createDataFrame([*labels.items(), (7, None), (9999, 1)], "doc_id long, quality int")
    of, ratio = quality.Features(), None
    found = [of(t) for _, t in rows]
    target, raw = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for (i, _), f in zip(rows, found):
        for b in f:
            raw[b] += 1
            target[b] += labels.get(i) == 1
    ratio = [math.log(t + 50) - math.log(r * target.sum() / raw.sum() + 50) for t, r in zip(target, raw)]
    noise = {r["i"]: r["u"] for r in spark.createDataFrame([(i,) for i, _ in rows], "i long").selectExpr("i", "(shiftrightunsigned(xxhash64(i, 17), 11) + 0.5) / 9007199254740992D AS u").collect()}
    weights = [sum(ratio[b] for b in f) for f in found]
    keys = [w - math.log(-math.log(noise[i])) for (i, _), w in zip(rows, weights)]
    for keep in (None, 0.4):
        got = sorted((r["doc_id"], round(r["weight"], 6), round(r["key"], 6), r["kept"]) for r in quality.quality_scores(frame(spark, rows), frame_labels, Workspace(spark, "test"), keep=keep).collect())
        k = sum(w > 0 for w in weights) if keep is None else math.ceil(keep * len(rows) - 1e-9)
        least = sorted(keys, reverse=True)[k - 1]
        assert got == sorted((i, round(w, 6), round(x, 6), x >= least) for (i, _), w, x in zip(rows, weights, keys))
        assert sum(w >= sorted(weights, reverse=True)[k - 1] and x < least for w, x in zip(weights, keys)) > 0


def test_quality_ties_at_the_last_key_all_stay(spark):
    rows = [(1, "same text")] * 5 + [(2, "other")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = quality.quality_scores(frame(spark, rows), labels, Workspace(spark, "test"), keep=0.2).collect()
    assert sum(r["kept"] for r in got) in (2, 5, 6) and len({(r["doc_id"], r["kept"]) for r in got}) == 2


def test_kth_largest(spark):
    keys = [random.Random(k).gauss(0, 10 ** (k % 5)) for k in range(300)] + [1.5] * 20
    frame_ = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in (1, 5, 100, 160, 320):
        assert quality._kth_largest(frame_, k) == sorted(keys, reverse=True)[k - 1]


def plain_lines(rows, least):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    split = [None if t is None else t.split("\n") for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for k in order:
        for a in range(len(split[k] or []) - least + 1):
            key = tuple(split[k][a : a + least])
            if key in seen:
                gone[k].update(range(a, a + least))
            seen.add(key)
    longest = [0] * len(rows)
    alike = {}
    for k, s in enumerate(split):
        for a, line in enumerate(s or []):
            alike.setdefault(line, []).append((k, a))
    for spots in alike.values():
        for k, a in spots:
            for j, b in spots:
                n = 0
                while (k, a) != (j, b) and a + n < len(split[k]) and b + n < len(split[j]) and split[k][a + n] == split[j][b + n]:
                    n += 1
                longest[k] = max(longest[k], n)
    return [(i, None if s is None else "\n".join(x for a, x in enumerate(s) if a not in g), len(s or []), len(g), m) for (i, _), s, g, m in zip(rows, split, gone, longest)]


def test_line_dedup(spark):
    rng = random.Random(8)
    lines = [words(rng, 4) for _ in range(12)] + [""]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(1, 12)))) for i in range(30)]
    rows += [(40, None), (41, ""), (42, "\n".join(lines * 6)), (43, "\n".join(lines * 6)), (44, "x\nx\nx\nx"), (None, "\n".join(lines))]
    rows += [(50, "p\nq\nr\ns"), (51, "p\nq\nr\ns")]
    for least in (1, 2, 3, 4):
        got = line_dedup.line_dedup(frame(spark, rows), least_lines=least).select("doc_id", "text", "n_lines", "n_removed", "longest").collect()
        assert sorted(map(tuple, got), key=str) == sorted(plain_lines(rows, least), key=str)
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BUCKET", 2)
    monkeypatch.setattr(embedding_dedup, "CELL_BYTES", 1 << 11)
    monkeypatch.setattr(embedding_dedup, "TILE", 7)
    embedding_dedup.calibrate.cache_clear()
    rng = np.random.default_rng(9)
    rows = []
    for k in range(30):
        base = rng.standard_normal(16)
        for j in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (base + rng.standard_normal(16) * 0.08).astype(np.float32).tolist(), int(k % 2)))
    rows += [(500 + k, rows[0][1], rows[0][2]) for k in range(60)]
    rows += [(700, None, 0), (701, [0.0] * 16, 0), (702, [float("nan")] + [1.0] * 15, 0), (703, rows[1][1], None), (704, [1.0, 2.0], 0), (705, [2.0, 4.0], 0), (706, [], 0), (707, [None] * 16, 0), (708, rows[1][1], 5)]
    frame_ = spark.createDataFrame([(i, e, lab, "x") for i, e, lab in rows], "vec_id long, embedding array<float>, label int, did string")
    ok = [e is not None and len(e) > 0 and lab is not None and None not in e and np.isfinite(e).all() and np.any(e) for _, e, lab in rows]

    def linked(a, b):
        if not (ok[a] and ok[b]) or rows[a][2] != rows[b][2] or len(rows[a][1]) != len(rows[b][1]):
            return False
        x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93

    root = closure(len(rows), linked)
    links = [sum(linked(a, b) for b in range(len(rows)) if a != b) for a in range(len(rows))]
    want = {rows[a][0]: (links[a], rows[root[a]][0], root[a] == a) for a in range(len(rows))}
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.embedding_groups(frame_).collect()}
    right = sum(min(got[i][0], want[i][0]) for i in want)
    assert right >= 0.99 * sum(links) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)
    assert embedding_dedup.embedding_groups(frame_.limit(0)).count() == 0
    typed = spark.createDataFrame([(1, [1.0, 0.0, 3.0], "a"), (2, [1.0, 1e-9, 3.0], "a"), (3, [1.0, 0.0, 3.0], "b"), (4, [1e200, 0.0, 3e200], "a")], "vec_id long, embedding array<double>, label string")
    assert sorted(map(tuple, embedding_dedup.embedding_groups(typed).collect())) == [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 2, 1, False)]


def test_filters_do_less_than_all_pairs_and_find_them():
    """Random vectors, a tenth of them moved copies: over 0.99 of the links, at a small share of all pairs, each link once."""
    rng = np.random.default_rng(0)
    for n, most in ((4000, 0.15), (20000, 0.03)):
        size, count, _ = embedding_dedup._plan({64: n}, 0.93)[64]
        x = rng.standard_normal((n, 64))
        k = n // 10
        x[:k] = x[k : 2 * k] + rng.standard_normal((k, 64)) * 0.38 * rng.random((k, 1))
        x = embedding_dedup.units(x)
        ways = np.concatenate([embedding_dedup.decode(x[a : a + 1024], size, count) for a in range(0, n, 1024)])
        held = np.bincount(ways.ravel()).astype(float)
        assert (held * (held - 1) / 2).sum() < most * n * (n - 1) / 2
        got = [(min(a, b), max(a, b)) for i, j in embedding_dedup.cell_links(x, ways, np.arange(n), None, 0, size * size, 0.93) for a, b in zip(i.tolist(), j.tolist())]
        want = {(a + i, j) for a in range(0, n, 2000) for i, j in zip(*(v.tolist() for v in np.nonzero(x[a : a + 2000] @ x.T >= 0.93))) if a + i < j}
        assert len(set(got)) == len(got) and set(got) <= want and len(got) >= 0.99 * len(want) > 100


def plain_suffix(rows, length=50):
    first, last = {}, 2**63
    for i, t in rows:
        raw = (t or "").encode()
        for a in range(len(raw) - length + 1):
            key = raw[a : a + length]
            first[key] = min(first.get(key, last), last if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        cut = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if first[raw[a : a + length]] < (last if i is None else i):
                cut[a : a + length] = b"\1" * length
        spans = sum(1 for a in range(len(raw)) if cut[a] and not (a and cut[a - 1]))
        out.append((i, len(raw), sum(cut), spans, hashlib.sha256(bytes(b for b, c in zip(raw, cut) if not c)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [3, 1024])
def test_suffix_dedup(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(10)
    base = "".join(rng.choices("abcdefgh ", k=400))
    rows = [r for r in corpus if r[0] != 13] + [(50, base), (51, "x" + base[100:300] + "y"), (52, "a" * 500), (53, "a" * 120 + "b"), (54, base[:49]), (55, base[:50]), (0, base[350:] + base[:60]), (56, "\0" * 70 + "é" * 40), (57, "é" * 40 + "\0" * 60)]
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_suffix(rows), key=str)
    if hot == 3:
        assert suffix_dedup.suffix_dedup(frame(spark, [])).count() == 0


def test_stretches_are_never_saved_and_pack_small(spark, corpus, monkeypatch):
    saved, save = [], suffix_dedup.Workspace.save
    monkeypatch.setattr(suffix_dedup.Workspace, "save", lambda work, df, name="t", **more: saved.append(name) or save(work, df, name, **more))
    rows = [r for r in corpus if r[0] != 13]
    got = suffix_dedup.suffix_dedup(frame(spark, [*rows, (-7, rows[0][1]), (None, rows[1][1])])).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_suffix([*rows, (-7, rows[0][1]), (None, rows[1][1])]), key=str)
    assert saved == ["marks", "result"]
    low, high = np.array([-(2**63), -7, 5, 6, 7]), np.array([2**63 - 1, 2**63 - 1, 5, 9, 7])
    about = suffix_dedup._about(np.arange(50, 55), low, high, np.array([3, 9, 2**31, 0, 4]), np.arange(5, dtype=np.uint64) << np.uint64(30), np.array([0, 0, 3, 3, 5]))
    for a, b, numbers in ((0, 3, [3, 9, 2**31]), (3, 5, [0, 4])):
        body, back, number = suffix_dedup._stretches(suffix_dedup.zstandard.ZstdCompressor().compress(about[a:b].T.tobytes() + b"text"), b - a)
        assert (body, number.tolist(), back["size"].tolist(), back["low"].tolist()) == (b"text", numbers, list(range(50 + a, 50 + b)), low[a:b].tolist())
        assert (back["low"] + back["spread"]).tolist() == high[a:b].tolist() and back["anchor"].tolist() == [k << 30 & 0xFFFFFFFF for k in range(a, b)]


def test_least_ids_over_groups(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 300)
    rng = random.Random(11)
    source = "".join(rng.choices("ab\0", k=300)).encode()
    stretches = [source[a : a + rng.randint(50, 90)] for a in (rng.randrange(200) for _ in range(60))]
    stretches = [s for s in stretches if len(s) >= 50]
    ids = np.array([rng.randrange(1000) for _ in stretches])
    low = {}
    for s, i in zip(stretches, ids.tolist()):
        for a in range(len(s) - 49):
            low[s[a : a + 50]] = min(low.get(s[a : a + 50], 10**9), i)
    got = suffix_dedup.least_ids(b"".join(stretches), np.array(list(map(len, stretches))), ids)
    assert len(got[0]) == sum(len(s) - 49 for s in stretches)
    assert all(low[stretches[s][p : p + 50]] == i for s, p, i in zip(*(c.tolist() for c in got)))


def test_exact_dedup(spark, corpus):
    rows = corpus + [(60, "long " * 30000 + "tail"), (61, "long" * 30000), (62, "lon g" * 30000)]
    norm = [(t or "").translate({c: None for c in (9, 10, 11, 12, 13, 32)}) for _, t in rows]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    want = []
    for k, (i, t) in enumerate(rows):
        group = [j for j in range(len(rows)) if norm[j] == norm[k]]
        keep = min(group, key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0, j))
        want.append((i, rows[keep][0], len(group), keep == k, hashlib.sha256(norm[k].encode()).hexdigest()))
    pick = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got]
    assert sorted(pick, key=str) == sorted(want, key=str)
    assert exact_dedup.drop_exact_copies(frame(spark, rows)).count() == sum(w[3] for w in want)
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0
    assert exact_dedup.exact_dedup(frame(spark, [(1, "a"), (2, None)])).filter(F.col("kept")).count() == 2


def test_pipeline_against_plain_version(spark, tmp_path):
    """run() against plain versions of its stages, on documents whose quality is plain."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(12)
    base, passage = words(rng, 150), words(rng, 80)
    near = base.split()
    near[75] = "changed"
    rows = [(i, words(rng, rng.randint(60, 120)).capitalize() + ".") for i in range(200)]
    rows += [(300, base), (301, base + " "), (302, " ".join(near)), (303, words(rng, 60) + " " + passage + " " + words(rng, 60)), (304, words(rng, 50) + " " + passage + " " + words(rng, 50))]
    junk = [(i, (words(rng, 1) + " ") * 60) for i in range(400, 440)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows + junk], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 400), 0) for i, _ in rows + junk if i % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r["doc_id"] for r in got}
    assert kept == {i for i, _ in rows} - {300, 302} or kept == {i for i, _ in rows} - {301, 302}
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = {}
    for r in got:
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + r["length"]
    for i, t in rows:
        if i in kept and i != 304:
            assert n[i] == len(plain.encode(t, add_special_tokens=False).ids) + 1
    assert n[304] < 0.62 * len(plain.encode(dict(rows)[304], add_special_tokens=False).ids)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
