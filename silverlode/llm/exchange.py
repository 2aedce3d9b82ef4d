"""Numbers packed into binary columns, so that a shuffle moves blocks and not rows.

A sorted 64-bit column is stored byte plane by byte plane: the planes of its leading bytes
are runs, which Spark's shuffle compression shrinks to almost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text bytes behind one part of an exchange, and behind one block dealt out to parts.
PART_BYTES = 6 << 20
DEAL_BYTES = 4 << 20


def pack(a: np.ndarray) -> bytes:
    """The planes of a one-dimensional array of fixed-size items."""
    a = np.ascontiguousarray(a)
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unpack(data, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def parts_for(n_bytes: int, each: int = PART_BYTES) -> int:
    return max(4, -(-n_bytes // each))


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of the hash's upper half: sorted hashes have sorted parts."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def bucket_of(ids: np.ndarray, parts: int) -> np.ndarray:
    """The bucket of integer ids; ``bucket`` is the same as a column."""
    low = ids.astype(np.uint64) & np.uint64(0xFFFFFFFF)
    return ((low * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64)


def bucket(id_col: Column, salt: Column, parts: int) -> Column:
    """Bucket of an id; rows without an id are spread by ``salt``."""
    low = F.coalesce(id_col, salt).bitwiseAND(F.lit(0xFFFFFFFF))
    # low < 2^32: split the product so that it stays within 64 bits
    product = F.pmod(F.pmod(low * F.lit(2654435761 >> 16), F.lit(1 << 16)) * F.lit(1 << 16) + low * F.lit(2654435761 & 0xFFFF), F.lit(1 << 32))
    return F.pmod(product, F.lit(parts)).cast("long")


def cuts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted array and where they begin (with the end)."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys[at], np.append(at, len(keys))


def dealt(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(part, packed column ...) for each part; ``part`` is sorted."""
    names, at = cuts(part)
    for p, i, j in zip(names.tolist(), at[:-1].tolist(), at[1:].tolist()):
        yield (p, *(pack(c[i:j]) for c in columns))


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def joined(table: pa.Table, name: str, kind) -> np.ndarray:
    """All packed values of a binary column, in row order."""
    found = [unpack(x.as_buffer(), kind) for x in table.column(name)]
    return np.concatenate(found) if found else np.zeros(0, kind)
