"""Helpers shared by the operators of this subpackage.

Text kernels work on the flat UTF-8 buffers of an Arrow batch, so no Python
string is made per word.  Blocks of about ``BLOCK_BYTES`` bound the memory; a
single longer document makes a block of its own.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import shared_dir

BLOCK_BYTES = 1 << 20
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: rows of small tables that one task writes
ROWS_PER_TASK = 500_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder that the
    cluster names in ``spark.checkpoint.dir`` and read it again.  ``rows``, if
    known, is about how many there are, so that few rows aren't written by
    many tasks.

    Unlike a checkpoint, a table carries no size estimate or constraints over
    from its plan; those multiply from round to round of a loop."""
    spark = df.sparkSession
    path = shared_dir(spark, "carelake-llm", uuid.uuid4().hex)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are at most
    ``max_rows``, else as it is (Spark then joins by shuffle)."""
    return F.broadcast(df) if df.count() <= max_rows else df


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return off, data


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents of at most ``limit`` bytes together, or one document."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply rounds) of an unsigned array."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> U64(33))
        x = x * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(33))


_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
for _c in range(65, 91):  # A-Z count as a-z
    _BYTE[_c] = _BYTE[_c + 32]
_R = U64(0x9E3779B97F4A7C15)
_RINV = U64(pow(int(_R), -1, 1 << 64))
_POW: dict[str, np.ndarray] = {"f": np.ones(1, np.uint64), "b": np.ones(1, np.uint64)}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(which: str, n: int) -> np.ndarray:
    base = _R if which == "f" else _RINV
    if len(_POW[which]) < n:
        with np.errstate(over="ignore"):
            x = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            x[0] = 1
            x = np.cumprod(x, dtype=np.uint64)
        if n > 4 * BLOCK_BYTES:
            return x
        _POW[which] = x
    return _POW[which]


def words(data: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data[off[0]:off[-1]]`` (positions from
    off[0]), and how many words each document has.  ``gap`` marks the bytes
    between words; documents end words too."""
    base, d = off[0], data[off[0]:off[-1]]
    n = len(d)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    on = ~gap[d]
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(on[:-1], out=first[1:])
    last = np.empty(n, bool)
    last[-1] = True
    np.logical_not(on[1:], out=last[:-1])
    inner = (off[1:-1] - base)
    first[inner[inner < n]] = True
    last[inner[inner > 0] - 1] = True
    starts = np.flatnonzero(on & first)
    ends = np.flatnonzero(on & last) + 1
    counts = np.diff(np.searchsorted(starts, off - base))
    return starts, ends, counts


def span_hashes(d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, A-Z counted as a-z."""
    with np.errstate(over="ignore"):
        s = np.empty(len(d) + 1, np.uint64)
        s[0] = 0
        np.cumsum(_BYTE[d] * _powers("f", len(d) + 1)[:len(d)], out=s[1:])
        h = (s[ends] - s[starts]) * _powers("b", len(d) + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
