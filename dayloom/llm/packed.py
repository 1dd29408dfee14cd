"""Number arrays as compact binaries, for tables and shuffles between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard


def pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=3).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending numbers, as differences."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(blob, dtype), dtype=dtype)


def pack_strings(strings: list[str]) -> bytes:
    """Strings without line feeds."""
    return zstandard.ZstdCompressor(level=3).compress("\n".join(strings).encode("utf-8", "replace"))


def unpack_strings(blob: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(blob).decode().split("\n")


def bounds(sizes: np.ndarray) -> np.ndarray:
    """Where pieces of these sizes begin and end in one row: 0, then the running sums."""
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def rows(schema: pa.Schema, found: list[dict]) -> list[pa.RecordBatch]:
    """Record batches of rows given as dicts; missing fields are null.  Arrays of keys come as Arrow arrays."""
    columns = []
    for f in schema:
        values = [r.get(f.name) for r in found]
        if pa.types.is_list(f.type) and any(isinstance(v, pa.Array) for v in values):
            sizes = [0 if v is None else len(v) for v in values]
            flat = pa.concat_arrays([v.cast(f.type.value_type) for v in values if v is not None])
            offsets = pa.array(bounds(np.array(sizes)), pa.int32())
            columns.append(pa.ListArray.from_arrays(offsets, flat).cast(f.type))
        else:
            columns.append(pa.array(values, f.type))
    return [pa.RecordBatch.from_arrays(columns, schema=schema)]
