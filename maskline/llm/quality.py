"""Quality filter by importance resampling over hashed n-grams.

Tokens are runs of word characters and runs of marks. Features are unigrams and bigrams of tokens, and unigrams, bigrams
and trigrams of token forms (case and length class of words, the marks themselves, "=" for a token equal to the one
before it), all hashed into BUCKETS. Two generative models, smoothed bucket shares, are counted: target from the rows
labelled 1, raw from all rows. A document's log weight is the sum of
its features' log ratios target / raw. SMOOTHING is added to every bucket at the size of the target sample, so that a bucket of which that
sample can say little weighs little.

Resampling: key = log weight + Gumbel noise (from a hash of the row's id, so a retry draws the same), and the k rows of largest key
stay: draws without replacement in proportion to the weights. k is `keep` times the rows; where keep is not given, as many as the
target model explains better than the raw one (weight above 0). Labels are used from at most about
MOST_LABELS ids, those of lowest hash, so their side of a join is bounded; raw counts and scores cover every row. The k-th key is found by
counting in ever narrower bins, never by a global sort.

Defined results: null and empty texts have no features, weight 0. Without rows labelled 0, or without rows labelled 1, nothing is rejected
unless keep is given. Labels of unknown ids and null labels are ignored; several labels of an id count as its largest. Ties at the k-th key
all stay; rows with equal ids draw the same noise. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace, free_name, lean, numbered, sized, worker_store

BUCKETS = 1 << 16
SMOOTHING, SEED = 50.0, 17
MOST_LABELS = 200_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
CACHE_TOKENS = 100_000


def _form(token: str) -> str:
    if not (token[0].isalnum() or token[0] == "_"):
        return "".join(sorted(set(token))) + str(sum(len(token) > n for n in (1, 2, 3, 7, 20)))
    case = "d" if token.isdigit() else "l" if token.islower() else "T" if token.istitle() else "U" if token.isupper() else "m"
    return case + str(sum(len(token) > n for n in (1, 2, 4, 7, 12, 20)))


class Features:
    """Hashed features of a text, with a bounded store of tokens: 32 bits for the token and 32 for its form."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall(text or "")
        if not tokens:
            return np.zeros(0, np.int64)
        known = self.known
        if len(known) > CACHE_TOKENS:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = zlib.crc32(t.encode("utf-8", "surrogatepass")) << 32 | zlib.crc32(_form(t).encode("utf-8", "surrogatepass"))
        both = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        form[1:][word[1:] == word[:-1]] = 61
        a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        parts = [word * a, (word[:-1] * b + word[1:]) * a + np.uint64(1), form * a + np.uint64(2), (form[:-1] * b + form[1:]) * a + np.uint64(3), ((form[:-2] * b + form[1:-1]) * b + form[2:]) * a + np.uint64(4)]
        mixed = np.concatenate(parts)
        mixed ^= mixed >> np.uint64(29)
        mixed *= b
        return (mixed >> np.uint64(48)).astype(np.int64) % BUCKETS


def features_of_worker() -> Features:
    """One store of tokens per Python worker, kept over its tasks."""
    return worker_store(Features)


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, log of the smoothed target share over the smoothed raw share, both at the size of the target sample."""
    size = target.sum()
    return np.log(target + SMOOTHING) - np.log(raw * (size / max(raw.sum(), 1)) + SMOOTHING)


def weight(features: np.ndarray, ratio: np.ndarray) -> float:
    return float(ratio[features].sum())


def sampled_labels(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", most: int = MOST_LABELS) -> DataFrame:
    """(label_id, label): one row per labelled id, of about `most` ids at most."""
    known = labels.select(F.col(doc_id).cast("long").alias("label_id"), F.col(quality).cast("int").alias("label")).dropna()
    share = most / max(known.count(), most)
    low = F.pmod(F.xxhash64("label_id", F.lit(SEED + 1)), F.lit(1 << 20)) < round(share * (1 << 20))
    return known.filter(low).groupBy("label_id").agg(F.max("label").alias("label"))


def fit(rows: DataFrame) -> np.ndarray:
    """Log ratios per bucket from (text, label). At most BUCKETS sums reach the driver."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, target, raw = features_of_worker(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                found = features(text.as_py())
                if not len(found):
                    continue
                part = np.bincount(found, minlength=BUCKETS) if len(found) > BUCKETS // 8 else None
                for total in (raw, target) if label == 1 else (raw,):
                    if part is None:
                        np.add.at(total, found, 1)
                    else:
                        total += part
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(target[used]), pa.array(raw[used])], names=["bucket", "target", "raw"])

    sums = rows.select("text", "label").mapInArrow(count, "bucket int, target long, raw long").groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums.collect():
        target[row["bucket"]], raw[row["bucket"]] = row["target"], row["raw"]
    return log_ratio(target, raw)


def kept_rows(scores: DataFrame, keep: float | None) -> int:
    """How many rows stay: keep times the rows, or as many as have a weight above 0."""
    n = scores.agg(F.count("*").alias("n"), F.count_if(F.col("weight") > 0).alias("above"), F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")).first()
    if keep is not None:
        return min(n["n"], math.ceil(keep * n["n"] - 1e-9))
    return n["above"] if n["good"] and n["bad"] else n["n"]


def _kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest of column key, by counting in 4096 bins of an ever smaller range; exact."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low < high:
        width = (high - low) / 4096
        at = F.least(F.floor((F.col("key") - low) / F.lit(max(width, 5e-324))), F.lit(4095)).alias("at")
        bins = keys.filter((F.col("key") >= low) & (F.col("key") <= high)).groupBy(at).agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).collect()
        for row in sorted(bins, key=lambda r: -r["at"]):
            if row["n"] >= k:
                low, high = row["a"], row["b"]
                break
            k -= row["n"]
    return low


def quality_scores(docs: DataFrame, labels: DataFrame, work: Workspace, text: str = "text", doc_id: str = "doc_id", rid: str | None = None, keep: float | None = None) -> DataFrame:
    """One saved row per input row: rid, doc_id, weight (log importance weight), key, kept."""
    plain = docs.select((F.col(rid) if rid else F.monotonically_increasing_id()).alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = work.save(sampled_labels(labels), "labels")
    rows = plain.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"), "left").drop("label_id")
    ratio = fit(rows)

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = features_of_worker()
        for batch in batches:
            found = [weight(features(t.as_py()), ratio) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(found, pa.float64())], names=["rid", "doc_id", "label", "weight"])

    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 11) + 0.5) / float(1 << 53)
    scores = work.save(rows.mapInArrow(score, "rid long, doc_id long, label int, weight double")
                       .withColumn("key", F.col("weight") - F.log(-F.log(uniform))), "scores")
    k = kept_rows(scores, keep)
    kept = F.lit(False) if not k else F.col("key") >= _kth_largest(scores, k)
    return scores.select("rid", "doc_id", "weight", "key", kept.alias("kept"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", work: Workspace | None = None, keep: float | None = None) -> DataFrame:
    """docs without the rows that quality_scores rejects; columns as they were."""
    work = work or Workspace(docs.sparkSession, "quality-rows")
    (rid,) = free_name(docs, "row_number")
    held = numbered(docs, rid, work)
    scores = quality_scores(held, labels, work, text, doc_id, rid, keep)
    gone = work.save(scores.filter("not kept").select(F.col("rid").alias(rid)), "gone")
    work.only(held, gone)
    return held.join(sized(gone, gone.count(), 16), rid, "left_anti").drop(rid)
