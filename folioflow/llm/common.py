"""Shared pieces of the training-data operators.

Texts are handled as the UTF-8 buffer of an Arrow column, a bounded slice at a
time, so that words, shingles and hashes come from a few numpy passes.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text handled at once; one longer document is a slice of its own.
SLICE_BYTES = 1 << 21
#: Word separators of every contract here: space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTE_VALUES = np.random.default_rng(20240601).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_own_dir: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); one of our own only in local mode, where none is set."""
    global _own_dir
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own_dir = _own_dir or tempfile.mkdtemp(prefix="folioflow-")
        path = _own_dir
    return path.rstrip("/")


#: Makes Spark drop a query's shuffle files as it ends; a written table needs none of them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote, once all that is made of them is written."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of at most limit text bytes (or one row), with their bytes and offsets."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the index of its first word (n + 1 values)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = SEPARATOR[data]
    before = np.empty(len(gap) + 1, bool)
    before[0], before[1:] = True, gap
    after = before[1:].copy()
    after[:-1], after[-1] = gap[1:], True
    before = before[:-1].copy()
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[edges] = True
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = True
    starts = np.flatnonzero(~gap & before)
    return starts, np.flatnonzero(~gap & after) + 1, np.searchsorted(starts, offsets)


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words, each followed by one space, with the words' new starts and ends."""
    if not len(starts):
        return np.empty(0, np.uint8), starts, ends
    sizes = ends - starts + 1
    to = np.cumsum(sizes)
    at = to - sizes
    out = np.append(data, np.uint8(0x20))[np.repeat(starts - at, sizes) + np.arange(to[-1])]
    out[to - 1] = 0x20
    return out, at, to - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    to = np.cumsum(sizes)
    at = to - sizes
    inside = np.arange(to[-1]) - np.repeat(at, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _GOLD, np.uint64))
    values = _BYTE_VALUES[data[np.repeat(starts, sizes) + inside]] * powers[inside]
    return mixed(np.add.reduceat(values, at) + sizes.astype(np.uint64) * _MIX)


def window_hashes(h: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hashes of each run of n consecutive values (len(h) - n + 1 of them, or none)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    factor = np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += h[j : j + m] * factor[j]
    return mixed(out)


def run_starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def distinct_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each slice's content, index of a slice that holds content i). Equal hashes are compared byte by byte."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sizes = ends - starts
    to = np.cumsum(sizes)
    inside = np.arange(to[-1]) - np.repeat(to - sizes, sizes)
    here = np.repeat(starts, sizes) + inside
    got = data[here]
    powers = np.cumprod(np.full(int(sizes.max()), _GOLD, np.uint64))
    h = np.add.reduceat(_BYTE_VALUES[got] * powers[inside], to - sizes) + sizes.astype(np.uint64) * _MIX
    _, where, of = np.unique(h, return_index=True, return_inverse=True)
    same = sizes == sizes[where][of]
    if not same.all() or not np.array_equal(data[np.repeat(starts[where][of], sizes) + inside], got):
        raw = data.tobytes()  # a collision of hashes: number the contents themselves
        seen: dict[bytes, int] = {}
        of = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist())])
        where = np.unique(of, return_index=True)[1]
    return of, where
