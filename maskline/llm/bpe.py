"""Byte-level BPE through a sentencepiece model serialised directly from a ranked vocabulary.

Every byte maps to one printable character; a token of rank r becomes the piece of its mapped bytes with score -r, in rank
order, so piece ids are ranks. The model has identity normalisation and no dummy prefix. Texts are split by the pattern,
each match is encoded by itself (a match that is a token as it stands has its rank), and ids decode by the inverse map.

Defined results: null and empty texts have no ids; texts of any length are taken whole (long matches too: only distinct
matches are encoded, in batches of bounded size); a null id is kept; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Matches kept with their ids in a Python worker (two generations at most), and the longest kept.
CACHE_MATCHES, LONGEST = 400_000, 48
#: Matches looked at in one go.
STEP = 100_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints and is no space, else the next from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(shifted)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary whose ranks are 0, 1, 2, ..."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    characters = byte_characters()
    model = schema.ModelProto()
    for rank, token in enumerate(sorted(ranks, key=ranks.__getitem__)):
        if ranks[token] != rank:
            raise ValueError(f"rank {rank} is missing")
        model.pieces.add(piece="".join(characters[b] for b in token), score=-float(rank), type=schema.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=schema.ModelProto.SentencePiece.UNKNOWN)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    trainer.model_type = schema.TrainerSpec.BPE
    trainer.vocab_size = len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(ranks), -1, -1, -1
    trainer.byte_fallback = False
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = normalizer.remove_extra_whitespaces = normalizer.escape_whitespaces = False
    return model.SerializeToString()


class ByteBPE:
    """Encodes and decodes texts; holds a bounded store of matches."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = sorted(self.ranks, key=self.ranks.__getitem__)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.map = dict(enumerate(byte_characters()))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _encode(self, matches: list[str]) -> list[tuple[int, ...]]:
        raw = [m.encode("utf-8", "surrogatepass") for m in matches]
        out: list[tuple[int, ...] | None] = [(r,) if (r := self.ranks.get(b)) is not None else None for b in raw]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self.model.encode([raw[k].decode("latin-1").translate(self.map) for k in rest], num_threads=1)):
            out[k] = tuple(ids)
        return out

    def _learn(self, new: set[str]) -> None:
        if len(self.known) + len(new) > CACHE_MATCHES:
            self.older, self.known = self.known, {}
        fresh = [m for m in new if m not in self.older]
        self.known.update({m: self.older[m] for m in new if m in self.older})
        self.known.update(zip(fresh, self._encode(fresh)))

    def encode(self, text: str) -> Iterator[int]:
        matches = self.split(text)
        for at in range(0, len(matches), STEP):
            part = matches[at : at + STEP]
            if new := set(part).difference(self.known):
                long = {m for m in new if len(m) > LONGEST}
                own = dict(zip(long, self._encode(list(long)))) if long else {}
                if len(self.known) + len(new) > CACHE_MATCHES:
                    new = set(part)
                self._learn(new - long)
                for m in part:
                    yield from own[m] if m in own else self.known[m]
            else:
                for ids in map(self.known.__getitem__, part):
                    yield from ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(1)
def coder_for(path: str, pattern: str) -> ByteBPE:
    """One coder per Python worker, kept over its tasks."""
    return ByteBPE(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, ids array<int>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(path, pattern)
        for batch in batches:
            ids = [np.fromiter(coder.encode(t.as_py() or ""), np.int32) for t in batch.column(1)]
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) to (doc_id, text binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = [t for t, _ in sorted(read_ranks(path).items(), key=lambda item: item[1])]
        for batch in batches:
            found = [b"".join(map(tokens.__getitem__, ids.as_py() or ())) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_tokens, digest of its ids, and digest of the bytes they decode to, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(path, pattern)
        decimal = list(map(str, range(len(coder.tokens))))
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for value in batch.column(1):
                ids = list(coder.encode(value.as_py() or ""))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
