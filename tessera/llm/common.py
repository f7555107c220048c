"""Shared helpers of the training-data operators: tables, byte buffers, rolling hashes.

Texts reach Python as Arrow batches and are worked on as one byte buffer with
document offsets, so every per-byte step is a numpy call over the whole batch.
Hashes are polynomial sums modulo 2^64 over a random byte table: a prefix sum
gives the hash of any window as one subtraction and one multiplication.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir

#: Bytes of text handled by one numpy pass; a single longer document is one pass of its own.
CHUNK = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of redoing the
    work. The folder comes from ``spark.checkpoint.dir``.
    """
    return kept_table(df, tag)[0]


def kept_table(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``written``, and the table's path for ``discard``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of ``kept_table`` that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Inside, a finished step's shuffle files are dropped at once instead of with the driver's next
    garbage collection, so the steps of one operator do not add up on disk. The result that an
    operator returns is made outside and may be run more than once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bytes_of(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """One string or binary column as (bytes, offsets); null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = CHUNK):
    """Consecutive document ranges [a, b) of about ``limit`` bytes, never splitting a document."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = b


def row_slices(batch: pa.RecordBatch, column: int = -1, limit: int = CHUNK):
    """The batch in pieces of about ``limit`` bytes of a string column, without copying; what is
    made of a piece is small, whatever the batch holds."""
    arr = batch.column(column if column >= 0 else batch.num_columns + column)
    width = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    offsets = np.frombuffer(arr.buffers()[1], dtype=width)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64) \
        if len(arr) else np.zeros(1, np.int64)
    for a, b in slices(offsets, limit):
        yield batch.slice(a, b - a)


_rng = np.random.default_rng(0x7E55)
#: Random 64-bit value of every byte; the second table feeds the independent check hash.
BYTE_VALUE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE_2 = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
_powers = {"n": 0}
_lock = threading.Lock()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n (kept and grown per process)."""
    with _lock:
        if _powers["n"] < n:
            size = max(n, 1 << 16)
            for name, base in (("up", BASE), ("down", INVERSE)):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                _powers[name] = np.cumprod(p)
            _powers["n"] = size
        return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Prefix sums H with H[j] - H[i] = hash of data[i:j] times BASE^i."""
    up, _ = powers(len(data) + 1)
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(value[data] * up[:len(data)], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, starts, ends) -> np.ndarray:
    """Hash of every window [start, end), independent of its place."""
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges start, start + 1, ..., start + length - 1."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def runs_of(separator: np.ndarray, offsets: np.ndarray, also_break: np.ndarray | None = None):
    """Maximal runs of non-separator bytes that never cross a document.

    ``also_break`` marks bytes before which a run is cut too. Returns (starts,
    ends, runs per document).
    """
    n = len(separator)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets) - 1, np.int64)
    inside = ~separator
    begin = np.empty(n, dtype=bool)
    begin[0] = True
    begin[1:] = separator[:-1]
    heads = offsets[:-1]
    begin[heads[heads < n]] = True
    if also_break is not None:
        begin |= also_break
    begin &= inside
    last = np.empty(n, dtype=bool)
    last[-1] = True
    last[:-1] = separator[1:] | begin[1:]
    last &= inside
    tails = offsets[1:]
    tails = tails[tails > 0] - 1
    last[tails] |= inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the undirected links; component is the smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    each step is one grouped minimum and one join, and the number of rounds grows
    with the logarithm of the longest chain. A node with very many links is a hot
    key of the join only, which adaptive execution splits.
    """
    edges = links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    edges = cut_lineage(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.col("m").alias("lo"), "hi").unionByName(
            small.where("lo != m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))).where("lo < hi").distinct()
        small = cut_lineage(small)
        changed = small.exceptAll(edges).limit(1).count() or edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
