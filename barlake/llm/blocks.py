"""Blocks of documents and what they send to each other.

A block is a bounded batch of rows.  It is written once; operators then send
compressed messages from blocks to parts of a key space and back, so that a
word or word window costs a few bytes in a shuffle instead of a whole row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

BLOCK_BYTES = 16 << 20
_ZSTD = pa.Codec("zstd", compression_level=3)


def zip_bytes(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (_ZSTD.compress(data, asbytes=True) if data else b"")


def unzip_bytes(data: bytes) -> bytes:
    n = int.from_bytes(data[:8], "little")
    return _ZSTD.decompress(data[8:], decompressed_size=n, asbytes=True) if n else b""


def zip_array(a: np.ndarray) -> bytes:
    """Bytes of an array, plane by plane: planes that vary little compress well."""
    planes = np.ascontiguousarray(a).view("u1").reshape(len(a), -1).T if len(a) else np.empty((0, 0), "u1")
    return zip_bytes(np.ascontiguousarray(planes).tobytes())


def unzip_array(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(unzip_bytes(data), "u1")
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel() if len(raw) else np.empty(0, dtype)


def zip_fields(*fields: bytes) -> bytes:
    return b"".join(len(f).to_bytes(8, "little") + f for f in fields)


def unzip_fields(data: bytes) -> list[bytes]:
    out, i = [], 0
    while i < len(data):
        n = int.from_bytes(data[i:i + 8], "little")
        out.append(data[i + 8:i + 8 + n])
        i += 8 + n
    return out


def zip_strings(items: list[bytes]) -> bytes:
    return zip_fields(zip_array(np.fromiter(map(len, items), "<u4", len(items))), zip_bytes(b"".join(items)))


def unzip_strings(data: bytes) -> list[bytes]:
    sizes, raw = unzip_fields(data)
    ends = np.cumsum(unzip_array(sizes, "<u4"), dtype="i8").tolist()
    raw = unzip_bytes(raw)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def sized_batches(batches, text_col: str, limit: int = BLOCK_BYTES):
    """Arrow batches cut so that each holds about ``limit`` bytes of text at most, or one row."""
    for b in batches:
        col = b.column(text_col)
        sizes = np.array([0 if s is None else s for s in pc.binary_length(col).to_pylist()], "i8")
        start, total = 0, 0
        for i, s in enumerate(sizes):
            if total and total + s > limit:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += s
        if b.num_rows > start:
            yield b.slice(start)


def block_names():
    """Names of the blocks of this task: unique in the job and equal if the task runs again."""
    task, n = TaskContext.get().partitionId(), 0
    while True:
        yield f"{task}-{n}"
        n += 1


def parts_for(rows: int) -> int:
    """Number of parts of a key space for a table of ``rows`` documents."""
    return max(16, min(1 << 20, rows // 2000))
