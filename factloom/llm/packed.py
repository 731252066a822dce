"""Packed arrays in rows: sorted numbers as differences, byte planes, zstd; and how arrays are dealt out to parts.

Exchanges of many small numbers (hashes, counts) move as one row for each piece of documents and part of keys. Every piece
names each of its distinct keys once, so a key that is in every text costs one entry for each piece, and parts, dealt out
by hash, stay even whatever the frequencies are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

_32 = np.uint64(32)
_KINDS = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}


def pack(a: np.ndarray, kind: str = "<u4") -> bytes:
    a = np.ascontiguousarray(a, kind)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unpack(data: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a.astype(np.uint64), prepend=np.uint64(0)), "<u8")


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def pack_pairs(key: np.ndarray) -> bytes:
    """Sorted pairs of 32-bit numbers."""
    return framed(np.diff(key >> _32, prepend=np.uint64(0))) + framed(key & np.uint64(0xFFFFFFFF))


def unpack_pairs(data: bytes) -> np.ndarray:
    first, second = unframed(data)
    return (np.cumsum(first, dtype=np.uint64) << _32) | second


def framed(x: np.ndarray) -> bytes:
    """A packed array with its length before it; such can stand one after the other."""
    data = pack(x)
    return len(data).to_bytes(4, "little") + data


def unframed(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(unpack(data[at + 4 : at + 4 + size]))
        at += 4 + size
    return out


def dealt(part: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by part, and where each of the n parts ends in it."""
    return np.argsort(part, kind="stable"), np.cumsum(np.bincount(part.astype(np.int64), minlength=n))


def by_part(part: np.ndarray, n: int):
    """(part, places in it) for each part that is not empty."""
    order, ends = dealt(part, n)
    for q, (a, b) in enumerate(zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist())):
        if b > a:
            yield q, order[a:b]


def rows_table(rows: list[tuple], schema: str) -> pa.Table:
    """Rows with the names and types of a DDL schema."""
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[k] for r in rows], _KINDS[kind]) for k, (name, kind) in enumerate(fields)})


def column(t: pa.Table, name: str) -> list:
    return t.column(name).to_pylist()


def only(t: pa.Table) -> dict:
    """The one row of a table."""
    return {name: col[0].as_py() for name, col in zip(t.column_names, t.columns)}
