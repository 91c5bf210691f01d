"""Best-fit packing of tokenised documents into sequences of bounded length.

A document is its token ids and an end id; only one longer than a sequence is cut, into full pieces and a last shorter one.
Pieces are dealt to partitions by a hash of their document, then each partition packs its pieces as they come by
bounded-space online best-fit: at most OPEN bins are open, a bitset holds the free spaces that occur among them, a piece
goes to the open bin with the least free space that still holds it, and where a new bin would be one too many, the
fullest closes first. Placement is final at once, so a partition streams with memory bounded by OPEN.

Defined results: null and empty texts give the end id alone; a null id is kept as null; rows with equal ids are documents
of their own; texts of any length work, cut as said; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace, lean, worker_store

SEQUENCE, END_ID = 4096, 1
#: Open bins of a partition, and pieces that a partition packs: enough that bins left open at its end hardly count.
OPEN, PER_PARTITION = 1024, 25_000
#: Words of a generation kept with their ids in a Python worker (two generations at most), and the longest word kept.
CACHE_WORDS, LONGEST_WORD = 250_000, 48

#: Marks that are a token of their own after letters.
MARKS = frozenset(".,!?;:|")
#: White space to Python but not to the tokenizer; a text with any of these is encoded in one go, as is one with a special token written out.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: Characters that lower-case and compose one by one, whatever stands beside them.
PLAIN = re.compile("[\x00-įı-ǯǱ-˿]*")
#: Characters of texts that are encoded together, unless one text has more, and pieces of them that are looked up together.
GROUP_CHARS, GROUP_PIECES = 1 << 18, 100_000


def _pieces() -> tuple[re.Pattern, re.Pattern]:
    """The tokenizer's own split of lower-cased text, for plain characters that stay plain; and any other character but white space."""
    plain = [c for c in map(chr, range(0x300)) if PLAIN.fullmatch(c) and PLAIN.fullmatch(c.lower()) and c not in ODD_SPACE]
    of = lambda some: "[" + re.escape("".join(some)) + "]"
    letters, numbers = ([c for c in plain if unicodedata.category(c)[0] == kind] for kind in "LN")
    others = [c for c in plain if not c.isspace() and unicodedata.category(c)[0] not in "LN"]
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{of(letters)}+|{of(numbers)}|{of(others)}+"), re.compile(rf"[^\s{of(plain)[1:]}")


PIECE, BEYOND = _pieces()
NO_SPACE = re.compile(r"\S*")


class WordEncoder:
    """Encodes texts with a tokenizer whose tokens never cross white space, piece by piece, with a bounded store of pieces.

    The tokenizer composes, lower-cases and splits before anything else, so a text's ids are those of its pieces in turn; one
    seen lately is not encoded again. A piece is what the tokenizer splits off, or, with a character that may lower-case or compose otherwise than
    plain ones, a whole word. Ids are held as little-endian 32-bit bytes. Words of letters
    end in exactly one word-end token, so many are encoded in one call and cut apart there.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)  # the same merges, for pieces
        self.bare.pre_tokenizer = WhitespaceSplit()
        # a special token written out in a text is that token, wherever it stands: such texts are encoded in one go
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, marks)) or r"(?!)", re.IGNORECASE)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 512):
            part = words[at : at + 512]
            # ASCII pieces are lower-case and split already
            tokenizer = self.bare if all(map(str.isascii, part)) else self.tokenizer
            ids = np.asarray(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *stops], stops)] if len(stops) == len(part) else self._ids(part)
        return out

    def learn(self, words: set[str]) -> None:
        """Store the ids of pieces; words of letters beyond plain ones without the mark after them, where that is the same."""
        if len(self.known) + len(words) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        known, older, forms = self.known, self.older, []
        letters, beyond, others = [], set(), set(MARKS.difference(known))
        for w in words:
            if w in older:
                known[w] = older[w]
            elif w.isascii():
                if w.isalpha():
                    letters.append(w)
                else:
                    others.add(w)
            else:
                stem, mark = w, ""
                if w[-1] in MARKS and "'" not in w:
                    stem, mark = w[:-1], w[-1]
                # some letters lower-case or compose to letters and marks, which run into the mark after them
                if not (stem.isalpha() and unicodedata.normalize("NFC", stem).lower().isalpha()):
                    others.add(w)
                    continue
                if stem in older:
                    known[stem] = older[stem]
                elif stem not in known:
                    beyond.add(stem)
                if mark:
                    forms.append((w, stem, mark))
        for need, how in ((letters, self._letters), (list(beyond), self._letters), (list(others), self._ids)):
            known.update(zip(need, how(need)))
        for w, stem, mark in forms:
            known[w] = known[stem] + known[mark]

    @staticmethod
    def split(text: str) -> list[str]:
        """The pieces of a text, in order."""
        out, at = [], 0
        while beyond := BEYOND.search(text, at):
            head = text[at : beyond.start()]
            if head and not head[-1].isspace():  # the word begins before this character
                head = head[: len(head) - len(head.rsplit(None, 1)[-1])]
            if head:
                out += PIECE.findall(head.lower())
            words = NO_SPACE.match(text, beyond.start()).end()
            out.append(text[at + len(head) : words])
            at = words
        last = PIECE.findall(text[at:].lower())
        return out + last if out else last

    def known_ids(self, part: list[str]) -> list[bytes]:
        """The ids of each piece, those not in store learned."""
        ids = list(map(self.known.get, part))
        if need := [k for k, found in enumerate(ids) if found is None]:
            new = {part[k] for k in need}
            own = {}
            if long := [w for w in new if len(w) > LONGEST_WORD]:
                own = dict(zip(long, self._ids(long)))
                new.difference_update(long)
            self.learn(new)
            for k in need:
                ids[k] = own[part[k]] if part[k] in own else self.known[part[k]]
        return ids

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        whole = [any(c in t for c in ODD_SPACE) or bool(self.special.search(t)) for t in texts]
        found, ends = [], [0]
        for text, odd in zip(texts, whole):
            if not odd:
                found += self.split(text)
            ends.append(len(found))
        ids: list[bytes] = []
        for at in range(0, len(found), GROUP_PIECES):
            ids += self.known_ids(found[at : at + GROUP_PIECES])
        for text, odd, a, b in zip(texts, whole, ends, ends[1:]):
            yield self._ids([text])[0] if odd else b"".join(ids[a:b])

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        yield from self._group(group)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


def encoder_for(path: str) -> WordEncoder:
    """One encoder per Python worker, kept over its tasks."""
    return worker_store(WordEncoder, path)


def pieces(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32), a row per piece; row numbers the documents."""

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, width = encoder_for(path), int(end_id).to_bytes(4, "little"), 4 * length
        for batch in batches:
            at, number, start, size, crc = [], [], [], [], []
            for k, ids in enumerate(encoder.encode_all(value.as_py() or "" for value in batch.column(2))):
                ids += end
                for p, a in enumerate(range(0, len(ids), width)):
                    part = ids[a : a + width]
                    at.append(k)
                    number.append(p)
                    start.append(a // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                names=["row", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "row long, doc_id long, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Bounded-space online best-fit over bins of one capacity."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.bits = 0  # bit f is set if some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
        self.open = self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """The bin for a piece and the offset in it."""
        fits = self.bits >> size
        if fits:
            free = (fits & -fits).bit_length() - 1 + size
            bin_ = self.bins[free].pop()
            if not self.bins[free]:
                self.bits ^= 1 << free
            self.open -= 1
        else:
            if self.open >= self.most_open:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self.bins[fullest].pop()
                if not self.bins[fullest]:
                    self.bits ^= 1 << fullest
                self.open -= 1
            bin_, free = self.made, self.capacity
            self.made += 1
        left = free - size
        if left:  # a full bin closes of itself
            self.bins[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.capacity - free


def pack(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", length: int = SEQUENCE, end_id: int = END_ID, most_open: int = OPEN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    work = Workspace(docs.sparkSession, "packing")
    cut = work.save(pieces(docs, path, text, doc_id, length, end_id), "pieces")
    parts = max(1, -(-cut.count() // PER_PARTITION))
    dealt = cut.withColumn("deal", F.xxhash64("row")).repartition(parts, "deal").sortWithinPartitions("deal", "row", "piece").drop("deal", "row")

    @lean
    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, base = BestFit(length, most_open), TaskContext.get().partitionId() << 33
        for frame in frames:
            placed = [bins.place(size) for size in frame["length"].tolist()]
            frame["sequence_id"] = [base + b for b, _ in placed]
            frame["offset"] = [o for _, o in placed]
            yield frame

    return dealt.mapInPandas(fill, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
