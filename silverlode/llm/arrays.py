"""Whole texts as flat numpy arrays inside a task.

A batch of texts is one byte buffer and one offset per text.  Words and windows
are found by table lookups and prefix sums over the buffer, so a task does no
work per word in Python.  Memory is a fixed multiple of the batch, and a batch
holds ``BATCH_BYTES`` of text or a single longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BATCH_BYTES = 1 << 19
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


mix = _mix
#: A random 64-bit value for each byte.
BYTE_VALUE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words between white space: every byte but space and \t\n\v\f\r.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: Words of digits, lower-case letters and everything beyond ASCII (text is lower-cased first).
LETTERED = np.zeros(256, dtype=bool)
LETTERED[48:58] = LETTERED[97:123] = LETTERED[128:] = True


class _Powers:
    """R^i and R^-i modulo 2^64, grown as needed and kept for the task's life."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(BATCH_BYTES + 1, 1 << int(n - 1).bit_length())
            with np.errstate(over="ignore"):
                for name, r in (("up", _R), ("down", _R_INV)):
                    a = np.full(size, r, np.uint64)
                    a[0] = 1
                    setattr(cls, name, np.multiply.accumulate(a))
        return cls.up[:n], cls.down[:n]


@dataclass
class Texts:
    """buf: UTF-8 bytes of all texts; at[i]:at[i+1] is text i (a null text is empty)."""

    buf: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a text or binary column; nulls have none."""
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    return Texts(np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0])


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds ``limit`` bytes of text at most, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        at = texts_of(batch.column(batch.schema.get_field_index(text))).at
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield batch.slice(i, min(j, n) - i)
            i = j


def byte_sums(buf: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """s with s[i] = sum of value(byte j) * R^j over j < i: the hash of any stretch
    is (s[end] - s[start]) * R^-start, the same wherever the stretch lies."""
    up, _ = _Powers.get(len(buf) + 1)
    s = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values[buf] * up[:len(buf)], out=s[1:])
    return s


def stretch_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _Powers.get(len(s))
    with np.errstate(over="ignore"):
        return _mix((s[end] - s[start]) * down[start])


@dataclass
class Words:
    """The words of a batch in order: byte spans, and first[i]:first[i+1] is text i."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts, inside: np.ndarray) -> Words:
    mask = inside[texts.buf]
    before = np.zeros_like(mask)
    before[1:] = mask[:-1]
    cuts = texts.at[:-1]
    before[cuts[cuts < len(mask)]] = False
    start = np.flatnonzero(mask & ~before)
    after = np.zeros_like(mask)
    after[:-1] = mask[1:]
    last = texts.at[1:] - 1
    after[last[last >= 0]] = False
    end = np.flatnonzero(mask & ~after) + 1
    return Words(start, end, np.searchsorted(start, texts.at))


def word_hashes(texts: Texts, words: Words, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    return stretch_hash(byte_sums(texts.buf, values), words.start, words.end)


def windows_of(words: Words, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First words and owning texts of all windows of ``size`` words; with ``short``
    a text of fewer words, but not none, is one window."""
    n = words.counts
    k = np.maximum(n - size + 1, 0)
    if short:
        k = np.where((n > 0) & (n < size), 1, k)
    owner = np.repeat(np.arange(len(n)), k)
    begin = np.cumsum(k) - k
    return words.first[:-1][owner] + np.arange(k.sum()) - begin[owner], owner


def sequence_hash(h: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    """Hash of ``size`` successive values of h (a number, or one per start)."""
    up, down = _Powers.get(len(h) + 1)
    s = np.zeros(len(h) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(h * up[:len(h)], out=s[1:])
        return _mix((s[start + size] - s[start]) * down[start] + _mix(np.asarray(size, np.uint64) + np.uint64(1)))


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches where mask holds."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the stretches."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0
