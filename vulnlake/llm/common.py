"""Helpers shared by the operators: work folders, staging, distributed ranks, and words of text batches."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnlake.session import work_dir

WHITE = r"\x20\x09-\x0D"
SUB_BUCKETS = 4096

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session may do without that setting: a temporary folder takes its place.
    """
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` once and go on from the files: cuts lineage and survives lost executors.

    ``file_rows`` limits the rows of a file (0: no limit), for tables whose rows are so large that a reader must not
    take thousands of them at once.
    """
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fraction(*cols: Column | str, seed: str) -> Column:
    """A number in [0, 1) that depends on the values only; nulls count as a value of their own."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def ranked(df: DataFrame, keys: list[str], order: Column, ties: list[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """Rank from 0 of every row within ``keys`` by ``order`` (a number in [0, 1)), and the group's size.

    A group is cut into ``SUB_BUCKETS`` slices of the order; rows are numbered within a slice, and the slices'
    counts give each slice its offset. So a group that holds most of all rows still spreads over many tasks.
    Ties on ``order`` are broken by ``ties``; rows equal in all of them are interchangeable.
    """
    sliced = df.withColumns({"_order": order, "_slice": F.floor(order * SUB_BUCKETS).cast("int")})
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    counts = counts.withColumns(
        {
            total: F.sum("_n").over(whole),
            "_before": F.sum("_n").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
        }
    ).drop("_n")
    local = Window.partitionBy(*keys, "_slice").orderBy("_order", *ties)
    rows = sliced.withColumn("_local", F.row_number().over(local) - 1)
    same = [rows[k].eqNullSafe(counts[k]) for k in [*keys, "_slice"]]
    joined = rows.join(counts, on=_all(same))
    for k in [*keys, "_slice"]:
        joined = joined.drop(counts[k])
    return joined.withColumn(rank, F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_order", "_slice", "_local", "_before")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def give_back() -> None:
    """Return a Python worker's free memory to the system: it waits for its next task beside the JVM's own."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# --- text batches in tasks -------------------------------------------------------------------------------------

#: Bytes of text handled at once in a task; a longer text forms a chunk of its own.
CHUNK_BYTES = 4 << 20


def text_chunks(batch: pa.RecordBatch, column: str, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch: first row, end row, the texts' bytes in a row, and where each text starts (and the end).

    Null texts are empty. A slice has ``size`` bytes at most (by default ``CHUNK_BYTES``), but for one longer text.
    """
    size = size or CHUNK_BYTES
    texts = batch.column(column).cast(pa.large_string())
    if not len(texts):
        return
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        end = min(end, len(texts))
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes flagged in ``inside`` that do not cross texts: starts, ends, and each run's text."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    new = np.zeros(n + 1, bool)
    new[at] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | new[:-1]))
    ends = np.flatnonzero(inside & (~after | new[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def table_of(flagged: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(flagged)] = True
    return table


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vector_bytes: int = 48) -> np.ndarray:
    """64-bit hashes of byte runs; runs longer than ``vector_bytes`` are hashed one by one."""
    length = ends - starts
    out = np.full(len(starts), 0x9E3779B97F4A7C15, np.uint64) + length.astype(np.uint64)
    order = np.argsort(-np.minimum(length, vector_bytes + 1), kind="stable")
    sizes, first = length[order], starts[order]
    long = int(np.searchsorted(-sizes, -vector_bytes, "left"))
    for i in order[:long]:
        out[i] = np.frombuffer(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
    order, sizes, first = order[long:], sizes[long:], first[long:]
    h = out[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -k, "left"))
        part = (h[:live] ^ data[first[:live] + k]) * np.uint64(0xFF51AFD7ED558CCD)
        h[:live] = part ^ (part >> np.uint64(32))
    out[order] = mix(h)
    return out


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` consecutive items of one owner, and the index of each window's first item."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + hashes[at + k])
    return h, at
