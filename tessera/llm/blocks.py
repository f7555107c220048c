"""Text blocks and the aligned exchange of sorted keys.

A block is one row holding about ``BLOCK_BYTES`` of consecutive documents: their
texts as one zstd frame and their other columns as Arrow IPC bytes. Blocks are
written once to the shared folder, so a block is the same in every later scan
and one row never splits.

The aligned exchange answers a question about every key of every block without
shuffling keys back: each block sends its sorted distinct keys, cut into hash
ranges ("buckets"); the task of a bucket compares the keys of all blocks and
returns one bit per key in the order received. The block makes the same sorted
keys again and reads off the bits. A key that is in every block costs one entry
a block, however often it occurs in it, so hot keys are pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bytes_of, kept_table, slices

BLOCK_BYTES = 2 << 20
#: Keys that one bucket's task holds at a time.
BUCKET_KEYS = 3_000_000
BLOCK_SCHEMA = "block long, n_bytes long, n_docs int, rest binary, offsets binary, text binary"


def build(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """Write ``docs`` as blocks: the ``keep`` columns and the text (null: empty). Returns the table and its path.

    ``block`` is the number of the block's first document: the partition in the upper 31 bits (as many as Spark
    numbers), the place in it in the lower 32. So ``block`` plus a place in the block is a row id, at any partition.
    """
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))

    def cut(batches):
        part, n = TaskContext.get().partitionId() << 32, 0
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = bytes_of(batch.column(batch.num_columns - 1))
            rest = batch.select(list(range(len(keep))))
            for a, b in slices(offsets, block_bytes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part + n]), pa.array([int(offsets[b] - offsets[a])]), pa.array([b - a], pa.int32()),
                     pa.array([table_bytes(rest.slice(a, b - a))], pa.binary()),
                     pa.array([squeeze.compress((offsets[a:b + 1] - offsets[a]).tobytes())], pa.binary()),
                     pa.array([squeeze.compress(np.ascontiguousarray(data[offsets[a]:offsets[b]]))], pa.binary())],
                    ["block", "n_bytes", "n_docs", "rest", "offsets", "text"])
                n += b - a
                if n >= 1 << 32:
                    raise ValueError("a partition of 2^32 documents or more: read the input in smaller splits")

    return kept_table(rows.mapInArrow(cut, BLOCK_SCHEMA), "blocks")


def table_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def expanded(frame: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame)


def rows_of(batches):
    """The rows of Arrow batches, one dict at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(c)[k].as_py() for c, name in enumerate(batch.schema.names)}


def opened(row: dict) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """(other columns, bytes, offsets) of a block row."""
    rest = pa.ipc.open_stream(row["rest"]).read_next_batch()
    expand = zstandard.ZstdDecompressor()
    return (rest, np.frombuffer(expand.decompress(row["text"]), np.uint8),
            np.frombuffer(expand.decompress(row["offsets"]), np.int64))


def bucket_bits(keys: int) -> int:
    """Buckets, as a power of two, so that one holds about BUCKET_KEYS of ``keys``."""
    return max(0, int(np.ceil(np.log2(max(1, keys / BUCKET_KEYS)))))


def packed(keys: np.ndarray, width: int = 8) -> bytes:
    """Sorted 64-bit keys; the top 16 bits change slowly and compress, ``width`` - 2 bytes follow."""
    hi = zstandard.ZstdCompressor(level=1).compress((keys >> np.uint64(48)).astype("<u2").tobytes())
    rest = ((keys >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    if width == 8:
        rest += (keys & np.uint64(0xFFFF)).astype("<u2").tobytes()
    elif width == 7:
        rest += ((keys >> np.uint64(8)) & np.uint64(0xFF)).astype("u1").tobytes()
    return len(hi).to_bytes(4, "little") + hi + rest


def unpacked(blob: bytes, width: int = 8) -> np.ndarray:
    size = int.from_bytes(blob[:4], "little")
    hi = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4:4 + size]), "<u2")
    n, at = len(hi), 4 + size
    keys = (hi.astype(np.uint64) << np.uint64(48)) | (np.frombuffer(blob, "<u4", n, at).astype(np.uint64) << np.uint64(16))
    at += 4 * n
    if width == 8:
        keys |= np.frombuffer(blob, "<u2", n, at).astype(np.uint64)
    elif width == 7:
        keys |= np.frombuffer(blob, "u1", n, at).astype(np.uint64) << np.uint64(8)
    return keys


def bucket_cuts(keys: np.ndarray, bits: int, first: int = 0, past: int | None = None):
    """(bucket, begin, end) of the nonempty buckets [first, past) of sorted keys."""
    past = 1 << bits if past is None else past
    if not len(keys):
        return
    if bits == 0:
        yield 0, 0, len(keys)
        return
    ids = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = run_starts(ids)
    ends = np.append(starts[1:], len(keys))
    buckets = ids[starts]
    mine = np.flatnonzero((buckets >= first) & (buckets < past))
    yield from zip(buckets[mine].tolist(), starts[mine].tolist(), ends[mine].tolist(), strict=True)


def answer(sent: DataFrame, decide: Callable[[dict], list[np.ndarray]]) -> DataFrame:
    """Per (block, bucket) what ``decide`` says of the block's keys, in their order.

    ``sent`` has block, bucket and blob columns; ``decide`` gets one bucket's
    columns as lists and returns one array per entry: booleans are sent as
    packed bits, bytes as a zstd frame.
    """
    def run(table: pa.Table) -> pa.Table:
        said = decide({name: table.column(name).to_pylist() for name in table.column_names})
        squeeze = zstandard.ZstdCompressor(level=1)
        said = [np.packbits(x).tobytes() if x.dtype == bool else squeeze.compress(x.tobytes()) for x in said]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "said": pa.array(said, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "block long, bucket int, said binary")


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with their answers, an array of (bucket, said); null if a block sent nothing."""
    per_block = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "said")).alias("answers"))
    return blocks.join(per_block, "block", "left")


def bits_in_order(answers: list[dict] | None, sizes: dict[int, int]) -> np.ndarray:
    """All bits in key order; ``sizes`` gives the keys of each bucket."""
    got = {a["bucket"]: a["said"] for a in answers or []}
    parts = [np.unpackbits(np.frombuffer(got[k], np.uint8), count=sizes[k]).astype(bool) for k in sorted(sizes)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def bytes_in_order(answers: list[dict] | None) -> np.ndarray:
    """All bytes in key order."""
    expand = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(expand.decompress(a["said"]), np.uint8) for a in sorted(answers or [], key=lambda a: a["bucket"])]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def run_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """First index of every run of equal keys."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in sorted_keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def over_runs(per_run: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A value per run, repeated for its members."""
    return np.repeat(per_run, np.diff(np.append(starts, n)))
