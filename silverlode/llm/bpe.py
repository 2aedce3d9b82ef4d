"""Byte-level BPE encoding and decoding with padded numpy matrices.

Texts are cut into pieces by the tokenizer's pattern.  A batch's pieces that the
task has not met before are encoded together: bucketed by length, one padded row a
piece.  In every round each row merges its leftmost pair of minimum rank; pairs are
looked up in an open-addressing hash table of (left, right) token ids, rows are
compacted, and rows without a pair to merge leave the matrix.  Encoded pieces are
remembered up to ``MEMO_PIECES``, then the memory starts anew.

Padded rounds cost the square of a piece's length, so pieces of over
``LONG_PIECE`` bytes (a run of letters without a space) take a heap over the same
pair table, with the same order of merges.

Every text is encoded whole in the task that reads it; nothing is shuffled.  The
rank file is read once by the driver and broadcast: its size is fixed by the
vocabulary, not by the data.

Cases: a null or empty text has no tokens and decodes to nothing; text is never
normalised, and strings of special tokens are ordinary text; ids outside the
vocabulary raise an error when decoded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.arrays import mix, sliced
from silverlode.llm.shared import keyed_text

LONG_PIECE = 1024
MEMO_PIECES = 400_000
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Ranks as arrays: the bytes of every id, the ids of single bytes, and the pair table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.text_of = [str(i) for i in range(size)]
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():           # every split of a token into two tokens is a pair
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self._table(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int32))

    def _table(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        bits = max(4, int(4 * len(left)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.value = np.full(1 << bits, NONE, np.int32)
        key = (left << 32) | right
        slot = mix(key.astype(np.uint64)) & self.mask
        self.probes, todo = 0, np.arange(len(key))
        while len(todo):                            # linear probing, all open keys at once
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            _, first = np.unique(slot[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[slot[won]], self.value[slot[won]] = key[won], merged[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges into (its rank), or NONE."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        flat = key.ravel()
        slot = mix(flat.astype(np.uint64)) & self.mask
        out = np.full(len(flat), NONE, np.int32)
        todo = np.arange(len(flat))
        for _ in range(self.probes):
            at = slot[todo]
            k = self.keys[at]
            same = k == flat[todo]
            out[todo[same]] = self.value[at[same]]
            todo = todo[~same & (k != -1)]
            if not len(todo):
                break
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
        return out.reshape(key.shape)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        out: list[list[int]] = [[]] * len(pieces)
        length = np.array([len(p) for p in pieces], np.int64)
        for i in np.flatnonzero(length == 1).tolist():
            out[i] = [int(self.byte_id[pieces[i][0]])]
        for i in np.flatnonzero(length > LONG_PIECE).tolist():
            out[i] = self._encode_long(pieces[i])
        order = np.flatnonzero((length > 1) & (length <= LONG_PIECE))
        order = order[np.argsort(length[order], kind="stable")]
        i = 0
        while i < len(order):
            # one bucket: lengths within a quarter of each other, half a million cells at most
            width = int(length[order[i]] * 1.25) + 1
            j = min(int(np.searchsorted(length[order], width, "right")), i + max(1, (1 << 19) // width))
            for row, ids in zip(order[i:j].tolist(), self._encode_bucket([pieces[k] for k in order[i:j]])):
                out[row] = ids
            i = j
        return out

    def _encode_bucket(self, pieces: list[bytes]) -> list[list[int]]:
        n = np.array([len(p) for p in pieces], np.int64)
        width = int(n.max())
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < n[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[list[int]] = [[]] * len(pieces)
        row = np.arange(len(pieces))
        ranks = np.where(ids[:, 1:] >= 0, self.pair_ranks(ids[:, :-1], ids[:, 1:]), NONE)
        while len(row):
            at = ranks.argmin(1)                    # the leftmost of the least
            here = np.arange(len(row))
            least = ranks[here, at]
            done = least == NONE
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[row[k]] = ids[k, :n[k]].tolist()
                left = ~done
                row, n, ids, ranks, at, least = row[left], n[left], ids[left], ranks[left], at[left], least[left]
                if not len(row):
                    break
                here = np.arange(len(row))
            # the pair becomes one id; what follows moves one place left
            ids[here, at] = least
            shift = np.arange(ids.shape[1] - 1) > at[:, None]
            ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            shift = np.arange(ranks.shape[1] - 1) > at[:, None]
            ranks[:, :-1] = np.where(shift, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            n = n - 1
            width = int(n.max())
            ids, ranks = ids[:, :max(2, width)], ranks[:, :max(1, width - 1)]
            if width < 2:
                ranks[:] = NONE
                continue
            # new neighbours of the merged id
            for place, ok in ((at, at + 1 < n), (at - 1, at > 0)):
                rows = np.flatnonzero(ok)
                ranks[rows, place[rows]] = self.pair_ranks(ids[rows, place[rows]], ids[rows, place[rows] + 1])
            rows = np.flatnonzero((at + 1 >= n) & (at < ranks.shape[1]))
            ranks[rows, at[rows]] = NONE
        return out

    def _encode_long(self, piece: bytes) -> list[int]:
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        first = self.pair_ranks(ids[:-1], ids[1:]).tolist()
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        none = int(NONE)
        heap = [(r, i) for i, r in enumerate(first) if r != none]
        heapq.heapify(heap)
        rank = first + [none]

        def renew(i: int) -> None:
            j = after[i]
            rank[i] = none if j >= n else int(self.pair_ranks(np.array([ids[i]]), np.array([ids[j]]))[0])
            if rank[i] != none:
                heapq.heappush(heap, (rank[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r:
                continue
            j = after[i]
            ids[i], rank[j], after[i] = r, none, after[j]
            if after[j] < n:
                before[after[j]] = i
            ids[j] = -1
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return [x for x in ids if x >= 0]


class Codec:
    """Encodes and decodes texts in one task, remembering pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.memo: dict[str, list[int]] = {}

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        cut = [self.find(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.memo) if cut else set()
        if new:
            if len(self.memo) + len(new) > MEMO_PIECES:
                self.memo = {}
                new = set().union(*cut)
            pieces = list(new)
            self.memo.update(zip(pieces, self.v.encode_pieces([p.encode() for p in pieces])))
        get = self.memo.__getitem__
        for pieces in cut:
            yield list(chain.from_iterable(map(get, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes_of.__getitem__, ids))


def vocabulary(spark: SparkSession, path: str, pattern: str):
    """The vocabulary as a broadcast value; its size is that of the rank file."""
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))


def encode(docs: DataFrame, shared_vocabulary) -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared_vocabulary.value)
        for b in sliced(batches):
            ids = pa.array(list(codec.encode(b.column(1).to_pylist())), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    return keyed_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, shared_vocabulary) -> DataFrame:
    """doc_id and data (binary) of every row of ids; a null array has no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared_vocabulary.value)
        for b in batches:
            data = [codec.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, shared_vocabulary) -> DataFrame:
    """Counts and digests of the ids and of what they decode to, one row a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared_vocabulary.value)
        digits = codec.v.text_of.__getitem__
        for b in sliced(batches):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), codec.encode(b.column(1).to_pylist())):
                rows.append((doc_id, len(ids), hashlib.sha256(",".join(map(digits, ids)).encode()).hexdigest(),
                             hashlib.sha256(codec.decode(ids)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return keyed_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenize(docs: DataFrame, shared_vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids, and the SHA-256 of what the ids decode to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared_vocabulary.value)
        for b in sliced(batches):
            ids = list(codec.encode(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids])], ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return keyed_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")
