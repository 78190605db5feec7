"""What the operators of this subpackage share: tables, cuts of lineage, Arrow text blocks, hashes."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; its work arrays take some 60 times as much.
BLOCK = 1 << 20
ARROW_BYTES = 8 << 20


def lean(f):
    """A generator over batches that gives freed memory back to the system when it ends: workers are used again,
    and what one stage needed must not add to what the next one needs."""

    @functools.wraps(f)
    def run(*args):
        try:
            yield from f(*args)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Freed memory, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on rows reach Python in Arrow batches of some MB, however long their texts, and a query's shuffle
    files go when it ends: what later queries read is written by cut()."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="vellum-"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return f"file://{_own_dir[0]}"


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: its lineage ends there."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(*cuts: DataFrame) -> None:
    """Removes what cut() wrote, once all that is read from it has been written in its turn."""
    for df in cuts:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and its n + 1 offsets. Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n, at = len(column), column.offset
    _, offsets, data = column.buffers()
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[at : at + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batches in slices with at most limit bytes in the column, but never less than a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


# --- hashes of byte ranges: sums of table[byte] * base ** position, modulo 2 ** 64, by two families of tables and bases

_random = np.random.default_rng(20240607)
BYTES = [_random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC6A4A7935BD1E995)]
INVERSES = [np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_cache: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    if len(_cache.get(int(base), ())) < n:
        _cache[int(base)] = _powers(base, max(1 << 16, n, 2 * len(_cache.get(int(base), ()))))
    return _cache[int(base)][:n]


def prefix_hash(data: np.ndarray, family: int = 0) -> np.ndarray:
    """n + 1 sums; range_hash reads the hash of any byte range from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[family][data] * powers(BASES[family], len(data)), out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end); equal strings, equal hashes, wherever they stand."""
    raw = (prefix[end] - prefix[start]) * powers(INVERSES[family], len(prefix))[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def rolling_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """range_hash of every [i, i + width)."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    raw = (prefix[width:] - prefix[:n]) * powers(INVERSES[0], n)
    return mix(raw + np.uint64(width * 0xC2B2AE3D27D4EB4F % (1 << 64)))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every width neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def list_rows(table: pa.Table, *columns: str) -> list[tuple[np.ndarray, ...]]:
    """The rows of list columns as views of their buffers: no Python object for each element."""
    arrays = [table.column(c).combine_chunks() for c in columns]
    arrays = [pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a for a in arrays]
    parts = [(a.values.to_numpy(), a.offsets.to_numpy()) for a in arrays]
    return [tuple(v[o[i] : o[i + 1]] for v, o in parts) for i in range(table.num_rows)]


def batch_of(columns: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def with_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """df's columns of these names, cast to these types; others are left out, absent ones raise."""
    return df.select(*[F.col(f"`{k}`").cast(v).alias(k) for k, v in wanted.items()])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
