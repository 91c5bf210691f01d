"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index of all terms, distance-weighted votes.

Examples are labelled rows whose crc32 of the id as text, mod 4, is not 2: those of lowest hash, at most MOST_EXAMPLES and as many as
have MOST_PAIRS distinct terms between them (one at least), so the index is bounded. Terms are lower-cased runs of word
characters; the vocabulary holds every term of an example. A vector has (1 + ln tf) * idf * (1 + g) for each term it has, with length
1; idf is counted over all documents, g is the likelihood-ratio statistic of the term's shares among toxic and other examples.

Index: examples lie in blocks of BLOCK, those with the same heaviest term side by side. Terms of over a COMMON-th of the examples have
a list per block and the block's greatest weight; the others one short list. A text's short lists are added up in full; with the block maxima
they bound its cosine with any example of a block. The FIRST blocks of greatest bound are scored, then every block whose
bound reaches the K-th best so far, GROUP texts at a time. Examples within ERROR of the K-th best, far more than single-precision
rounding, are computed again in double precision, so the search is exact.

A text's vote is the similarity-weighted share of toxic neighbours, drawn towards the share of all examples that have any term by PRIOR. The
score is a logistic function of the vote's log odds, fitted to the examples themselves, each by its neighbours but itself. A text
with no known term scores the toxic share of examples with no term, drawn towards that of all examples by one example.

Defined results: null and empty texts have no term; null labels are ignored, several labels of an id count as its largest; a null id
is not held out; without examples every score is 0.5, without terms or with labels of one kind only the votes stand as they are; ties
among neighbours go to the smaller example id; an empty table gives an empty result; extra columns, and any but text and id, are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace

#: Stated bounds of the sample that the classifier is fitted on: labelled rows, and their distinct terms in all.
MOST_EXAMPLES, MOST_PAIRS = 4096, 2_000_000
#: Likelihood ratio from which a term is shown as evidence; the score does not depend on it.
MIN_RATIO = 10.0
K, COMMON, BLOCK, FIRST, GROUP, ERROR, PRIOR, CUT = 25, 32, 64, 4, 64, 1e-4, 0.5, 0.3
WORD = re.compile(r"\w+")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def term_counts(text: str | None, among: dict[str, int] | None = None) -> dict:
    words = WORD.findall((text or "").lower())
    if among is None:
        return Counter(words)
    return {among[w]: n for w, n in Counter(words).items() if w in among}


#: Bytes of ASCII text to their lower case, or a space where no term goes on; and characters of texts that are looked up together.
FOLD = bytes(ord(chr(b).lower()) if b < 128 and WORD.match(chr(b)) else 32 for b in range(256))
LOOK_UP = 1 << 23


def spaced(text: str | None) -> bytes:
    """A text's terms with spaces between them."""
    if not text or text.isascii():
        return (text or "").encode().translate(FOLD)
    return " ".join(WORD.findall(text.lower())).encode()


def coded(texts: list[str | None], names: pa.Array) -> Iterator[np.ndarray]:
    """Each text's terms among names as an array of (place in names, count) in order of places; many texts are looked up together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= LOOK_UP):
            size += len(texts[end] or "")
            end += 1
        some, at = texts[at:end], end
        terms = [spaced(t) for t in some]
        ends = np.cumsum([0, *map(len, terms)]).astype(np.int32)
        words = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(terms), pa.py_buffer(ends), pa.py_buffer(b"".join(terms))))
        number = pc.fill_null(pc.index_in(words.flatten(), value_set=names), -1).to_numpy()
        owner = np.repeat(np.arange(len(terms)), words.value_lengths().to_numpy())
        m = max(len(names), 1)
        pairs, times = np.unique((owner * m + number)[number >= 0], return_counts=True)
        both = np.stack([pairs % m, times], axis=1)
        edges = np.searchsorted(pairs, np.arange(len(terms) + 1) * m)
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            yield both[a:b]


class Index:
    """Examples by place and by term; ids, labels and vectors are small and bounded. A vector is {term: count} or an array of such pairs."""

    def __init__(self, vectors: list, labels: np.ndarray, ids: np.ndarray, idf: np.ndarray):
        self.idf, self.slope, self.shift = idf, 1.0, 0.0
        empty = np.array([not len(v) for v in vectors], bool)
        self.no_term = (labels[empty].sum() + labels.mean()) / (empty.sum() + 1.0) if len(labels) else 0.5
        units = {int(k): self.unit_arrays(vectors[k]) for k in np.flatnonzero(~empty)}
        heaviest = {k: int(t[np.argmax(w)]) for k, (t, w) in units.items()}
        full = np.array(sorted(units, key=lambda k: (heaviest[k], ids[k])), np.int64)
        self.share = labels[full].mean() if len(full) else self.no_term
        self.labels, self.ids = labels[full].astype(float), ids[full]
        self.edge = np.concatenate([[0], np.cumsum([len(units[k][0]) for k in full])]).astype(np.int64)
        none = [np.zeros(0)]
        self.terms = np.concatenate([units[k][0] for k in full.tolist()] or none).astype(np.int32)
        self.weights = np.concatenate([units[k][1] for k in full.tolist()] or none)
        self.ready = False

    def prepare(self) -> None:
        """The lists by term, and by block for common terms, made where they are used."""
        n, m = len(self.ids), len(self.idf)
        order = np.argsort(self.terms, kind="stable")
        self.places, self.by_term = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.edge))[order], self.weights[order]
        held = np.bincount(self.terms, minlength=m)
        self.start = np.concatenate([[0], np.cumsum(held)])
        common = np.flatnonzero(held * COMMON > n)
        self.row = np.full(m, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.blocks = -(-n // BLOCK)
        lists = np.zeros((len(common), self.blocks * BLOCK), np.float32)
        for k, t in enumerate(common.tolist()):
            lists[k, self.places[self.start[t] : self.start[t + 1]]] = self.by_term[self.start[t] : self.start[t + 1]]
        self.lists = [np.ascontiguousarray(lists[:, b * BLOCK : (b + 1) * BLOCK]) for b in range(self.blocks)]
        self.most = np.stack([part.max(axis=1) for part in self.lists], axis=1) if len(common) else np.zeros((0, self.blocks), np.float32)
        self.dense = np.zeros(m)
        self.ready = True

    def unit_arrays(self, counts) -> tuple[np.ndarray, np.ndarray]:
        """Terms in order, and their weights in a vector of length 1."""
        if isinstance(counts, dict):
            terms, times = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))
            order = np.argsort(terms)
            terms, times = terms[order], times[order]
        else:
            terms, times = counts[:, 0], counts[:, 1]
        raw = (1 + np.log(times)) * self.idf[terms]
        return terms, raw / np.sqrt((raw * raw).sum())

    def unit(self, counts: dict[int, int]) -> dict[int, float]:
        return dict(zip(*(x.tolist() for x in self.unit_arrays(counts)))) if counts else {}

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> list[list[tuple[float, int]]]:
        """For each query (terms, weights) the k examples of highest cosine over 0: (cosine, place), ties by example id."""
        if not self.ready:
            self.prepare()
        n, blocks = len(self.ids), self.blocks
        if not n:
            return [[] for _ in queries]
        heads = np.zeros((len(queries), len(self.most)), np.float32)
        score = np.zeros((len(queries), blocks * BLOCK), np.float32)
        for q, (terms, weights) in enumerate(queries):
            at = self.row[terms]
            heads[q, at[at >= 0]] = weights[at >= 0]
            rare = terms[at < 0]
            begin, sizes = self.start[rare], self.start[rare + 1] - self.start[rare]
            if total := int(sizes.sum()):
                spots = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
                score[q] = np.bincount(self.places[spots], np.repeat(weights[at < 0], sizes) * self.by_term[spots], blocks * BLOCK)
        bound = heads @ self.most + score.reshape(len(queries), blocks, BLOCK).max(axis=2)
        done = np.zeros((len(queries), blocks), bool)

        def settle(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                some = np.flatnonzero(wanted[:, b])
                score[some, b * BLOCK : (b + 1) * BLOCK] += heads[some] @ self.lists[b]
            np.logical_or(done, wanted, out=done)

        def least() -> np.ndarray:
            """The k-th best score of each query among the blocks that are done."""
            if n <= k:
                return np.zeros(len(queries), np.float32)
            known = np.where(np.repeat(done, BLOCK, axis=1), score, -1)
            return np.maximum(np.partition(known, -k, axis=1)[:, -k], 0)

        first = np.zeros_like(done)
        np.put_along_axis(first, np.argsort(-bound, axis=1)[:, :FIRST], True, axis=1)
        settle(first)
        settle((bound >= least()[:, None] - ERROR) & ~done)
        out = []
        for (terms, weights), own, bar, ok in zip(queries, score, least(), done):
            live = np.flatnonzero((own >= bar - ERROR) & (own > 0) & np.repeat(ok, BLOCK))
            # in full, and in one order of terms, so that equal examples have equal cosines
            self.dense[terms] = weights
            exact = [float(self.weights[a:b] @ self.dense[self.terms[a:b]]) for a, b in zip(self.edge[live].tolist(), self.edge[live + 1].tolist())]
            self.dense[terms] = 0
            best = sorted((-s, int(self.ids[p]), p) for s, p in zip(exact, live.tolist()) if s > 0)[:k]
            out.append([(-s, p) for s, _, p in best])
        return out

    def nearest(self, query: dict[int, float], k: int = K) -> list[tuple[float, int]]:
        return self.nearest_of([(np.array(list(query), np.int64), np.array(list(query.values()), float))], k)[0]

    def vote(self, near: list[tuple[float, int]]) -> float:
        total = sum(s for s, _ in near)
        return (sum(s * self.labels[p] for s, p in near) + PRIOR * self.share) / (total + PRIOR)

    def calibrated(self, vote: float) -> float:
        odds = math.log(max(vote, 1e-6) / max(1 - vote, 1e-6))
        return 1 / (1 + math.exp(-(self.slope * odds + self.shift)))

    def calibrate(self) -> None:
        """Fit slope and shift to the examples' labels, each voted on by its neighbours but itself (Platt's method, Newton's steps)."""
        n, toxic = len(self.ids), self.labels.sum()
        if not 0 < toxic < n:
            return
        votes = []
        for at in range(0, n, GROUP):
            places = range(at, min(at + GROUP, n))
            found = self.nearest_of([(self.terms[self.edge[p] : self.edge[p + 1]], self.weights[self.edge[p] : self.edge[p + 1]]) for p in places], K + 1)
            votes += [self.vote([x for x in near if x[1] != p][:K]) for p, near in zip(places, found)]
        odds = np.log(np.clip(votes, 1e-6, 1) / np.clip(1 - np.array(votes), 1e-6, 1))
        goal = np.where(self.labels == 1, (toxic + 1) / (toxic + 2), 1 / (n - toxic + 2))
        x, beta = np.stack([odds, np.ones(n)], axis=1), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - goal))
            beta = beta - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        if beta[0] > 0:
            self.slope, self.shift = float(beta[0]), float(beta[1])

    def scores(self, counts: list) -> Iterator[tuple[float, list[tuple[float, int]]]]:
        """The score of each text (its counts), and its neighbours."""
        for at in range(0, len(counts), GROUP):
            some = counts[at : at + GROUP]
            found = iter(self.nearest_of([self.unit_arrays(c) for c in some if len(c)]))
            for c in some:
                near = next(found) if len(c) else []
                yield (self.calibrated(self.vote(near)) if near else float(self.no_term)), near


def examples(docs: DataFrame, labels: DataFrame, work: Workspace, text: str, doc_id: str, most: int, pairs: int) -> DataFrame:
    """(id, text, label) of the examples: `most` of lowest hash, and of these the first with `pairs` distinct terms in all."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label")).dropna().filter(~held_out("id"))
    known = known.groupBy("id").agg(F.max("label").alias("label")).withColumn("turn", F.xxhash64("id", F.lit(5)))
    known = work.save(known.orderBy("turn", "id").limit(most), "labels")
    rows = work.save(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id").dropDuplicates(["id"]), "examples")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(term_counts(t.as_py())) for t in batch.column(1)], pa.int64())], names=["id", "n"])

    held = {r["id"]: r["n"] for r in rows.select("id", "text").mapInArrow(sizes, "id long, n long").collect()}
    order = [r["id"] for r in known.orderBy("turn", "id").select("id").collect() if r["id"] in held]
    ends = np.cumsum([held[i] for i in order])
    chosen = order[: max(1, int(np.searchsorted(ends, pairs, "right")))]
    return rows if len(chosen) == len(order) else rows.filter(F.col("id").isin(chosen))


def document_frequencies(docs: DataFrame, text: str, vocabulary: dict[str, int]) -> tuple[int, np.ndarray]:
    """Documents, and how many of them have each term; one sum per term and partition is shuffled."""
    m = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, names = np.zeros(m + 1, np.int64), pa.array(sorted(vocabulary, key=vocabulary.get), pa.string())
        for batch in batches:
            seen[m] += batch.num_rows
            for counts in coded(batch.column(0).to_pylist(), names):
                seen[counts[:, 0]] += 1
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], names=["term", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(m + 1, np.int64)
    total[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    return int(total[m]), total[:m].astype(float)


def likelihood_ratios(seen: np.ndarray, toxic: np.ndarray, n: int, n1: int) -> np.ndarray:
    """Per term, the likelihood-ratio statistic of having the term against being toxic, from its examples and its toxic ones."""
    g = np.zeros(len(seen))
    if 0 < n1 < n:
        for share, rows, has in ((n1 / n, n1, toxic), ((n - n1) / n, n - n1, seen - toxic)):
            for o, e in ((has, seen * share), (rows - has, (n - seen) * share)):
                some = o > 0
                g[some] += 2 * o[some] * np.log(o[some] / e[some])
    return np.maximum(g, 0)


def fit(rows: DataFrame, docs: DataFrame, text: str) -> tuple[dict[str, int], np.ndarray, Index]:
    """The vocabulary, each term's likelihood ratio (positive where toxic examples have it more often) and the index of examples (id, text, label)."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [term_counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([list(c) for c in own], pa.list_(pa.string())), pa.array([list(c.values()) for c in own], pa.list_(pa.int32()))], names=["id", "label", "terms", "counts"])

    held = rows.select("id", "text", "label").mapInArrow(vectors, "id long, label int, terms array<string>, counts array<int>").toArrow().combine_chunks().sort_by("id")
    lists = [held.column(c).combine_chunks() if isinstance(held.column(c), pa.ChunkedArray) else held.column(c) for c in ("terms", "counts")]
    coded = lists[0].flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    place = np.empty(len(names), np.int32)
    place[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    vocabulary = {t: int(p) for t, p in zip(names, place)}
    terms = place[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.int32)
    counts = lists[1].flatten().to_numpy(zero_copy_only=False)
    sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False) if held.num_rows else np.zeros(0, int)
    labels = (held.column("label").to_numpy() == 1).astype(int)
    toxic = np.repeat(labels, sizes)
    seen, t1 = np.bincount(terms, minlength=len(names)).astype(float), np.bincount(terms[toxic == 1], minlength=len(names)).astype(float)
    n, n1 = len(labels), int(labels.sum())
    g = likelihood_ratios(seen, t1, n, n1)
    total, df = document_frequencies(docs, text, vocabulary)
    idf = (np.log((1 + total) / (1 + df)) + 1) * (1 + g)
    ends = np.cumsum(sizes)
    pairs = []
    for a, b in zip(ends - sizes, ends):
        order = np.argsort(terms[a:b])
        pairs.append(np.stack([terms[a:b][order], counts[a:b][order]], axis=1).astype(np.int64))
    index = Index(pairs, labels, held.column("id").to_numpy(), idf)
    index.calibrate()
    sign = np.where(t1 * n > seen * n1, 1.0, -1.0) if n else np.ones(0)
    return vocabulary, g * sign, index


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", most: int = MOST_EXAMPLES, pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, terms (its K that speak most for toxic), neighbours (all that voted: example id, cosine, label)."""
    work = Workspace(docs.sparkSession, "toxicity")
    vocabulary, ratio, index = fit(examples(docs, labels, work, text, doc_id, most, pairs), docs, text)
    names = list(vocabulary)
    by_number = {vocabulary[t]: t for t in names}
    strong = set(np.flatnonzero(ratio > MIN_RATIO).tolist())
    work.close()
    index.ready = False
    for made in ("places", "by_term", "start", "row", "lists", "most", "dense"):
        index.__dict__.pop(made, None)
    near = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_order = pa.array(sorted(vocabulary, key=vocabulary.get), pa.string())
        for batch in batches:
            scores, terms, places, cosines, sizes = [], [], [], [], []
            texts = list(coded(batch.column(2).to_pylist(), in_order))
            for counts, (score, found) in zip(texts, index.scores(texts)):
                scores.append(min(1.0, max(0.0, score)))
                telling = strong.intersection(counts[:, 0].tolist())
                terms.append([by_number[t] for t in sorted(telling, key=lambda t: (-ratio[t], t))[:K]])
                sizes.append(len(found))
                cosines += [s for s, _ in found]
                places += [p for _, p in found]
            places = np.array(places, np.int64)
            ids, marks = (index.ids[places], index.labels[places]) if len(places) else (np.zeros(0, np.int64), np.zeros(0))
            votes = pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(cosines, pa.float64()), pa.array(marks.astype(np.int32))], fields=list(near.value_type))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= CUT) for s in scores], pa.int32()), pa.array(terms, pa.list_(pa.string())), pa.ListArray.from_arrays(offsets, votes)],
                names=["doc_id", "held_out", "score", "predicted", "terms", "neighbours"])

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, terms array<string>, neighbours array<struct<id:bigint,cosine:double,label:int>>")
