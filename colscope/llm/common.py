"""Helpers shared by the corpus operators: shared storage, code shipping, and hashing of words in Arrow batches.

Text is handled as UTF-8 bytes in numpy, a few megabytes at a time, so memory does not grow with a partition
and no Python object is made for each word.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that one numpy step handles; a longer document is handled alone.
CHUNK_BYTES = 2_000_000


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, whatever their working folder is."""
    sc = spark.sparkContext
    if getattr(sc, "_colscope_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="colscope-")) / "colscope_pkg.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(str(target))
    sc._colscope_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Where it is unset, a fresh local one, but only if
    the driver is the only machine; else that is an error, as executors would each write to their own disk."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_colscope_shared", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = sc._colscope_shared = "file://" + tempfile.mkdtemp(prefix="colscope-shared-")
    return found.rstrip("/")


class Kept:
    """A table written to the shared folder: lineage ends there, and lost executors take nothing along. ``df`` reads it; ``drop``
    deletes its files as soon as no step needs them, and what is left goes when the application ends."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = fresh_folder(self.spark, name)
        schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    found = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(found)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path.getParent())
    fs.deleteOnExit(path)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a kept table that stays until the application ends."""
    return Kept(df, name).df


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; one number, used only to choose how many groups to deal the rows into."""
    return int(df.select(F.sum(F.octet_length(F.col(column))).alias("n")).first()["n"] or 0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- hashing

_MULT = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over all output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_R = np.random.default_rng(11)
_ODD = _R.integers(0, 2**63, 64, dtype=U64) * U64(2) + U64(1)
_SEED_SUM, _SEED_CHAIN, _LENGTH = _R.integers(0, 2**63, 3, dtype=U64) * U64(2) + U64(1)
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as an integer, zeros beyond the end; a view, so only what is looked up is read."""
    return np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def same_spans(one: np.ndarray, start: np.ndarray, other: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes from ``start`` in ``one`` and from ``at`` in ``other`` (views by ``_blocks``) are equal."""
    same = np.ones(len(size), bool)
    rows, nth = np.flatnonzero(size), 0
    while len(rows):
        low = _LOW[np.minimum(size[rows] - 8 * nth, 8)]
        same[rows] &= (one[start[rows] + 8 * nth] & low) == (other[at[rows] + 8 * nth] & low)
        nth += 1
        rows = rows[same[rows] & (size[rows] > 8 * nth)]
    return same


def span_sums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes: blocks of eight bytes are mixed with their number in the span, and summed."""
    at, size = _blocks(data), end - start
    many = np.maximum((size + 7) >> 3, 1)
    if not len(many):
        return np.zeros(0, U64)
    if many.max() == 1:
        total = mix((at[start] & _LOW[size]) + _SEED_SUM)
    else:
        first = np.cumsum(many) - many
        nth = np.arange(int(many.sum())) - np.repeat(first, many)
        left = np.repeat(size, many) - 8 * nth
        value = at[np.repeat(start, many) + 8 * nth] & _LOW[np.minimum(left, 8)]
        total = np.add.reduceat(mix(value + _SEED_SUM + mix(nth.astype(U64) * _MULT)), first)
    return mix(total + size.astype(U64) * _LENGTH)


def span_chains(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of another family: each block is mixed into the hash of those before."""
    at, size = _blocks(data), end - start
    out = mix(size.astype(U64) + _SEED_CHAIN)
    many = (size + 7) >> 3
    order = np.argsort(-many, kind="stable")
    ranked = -many[order]
    for nth in range(int(many.max(initial=0))):
        rows = order[: np.searchsorted(ranked, -nth)] if nth else np.flatnonzero(many)
        value = at[start[rows] + 8 * nth] & _LOW[np.minimum(size[rows] - 8 * nth, 8)]
        out[rows] = mix(out[rows] * _MULT + (value ^ _SEED_CHAIN))
    return out


def run_sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of values (64 at most): each times the odd number of its place, summed."""
    size = end - start
    total = size.astype(U64) * _LENGTH
    for nth in range(int(size.max(initial=0))):
        if nth < size.min():
            total += values[start + nth] * _ODD[nth]
        else:
            rows = np.flatnonzero(size > nth)
            total[rows] += values[start[rows] + nth] * _ODD[nth]
    return mix(total)


def run_chains(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of another family: each value is mixed into the hash of those before."""
    size = end - start
    out = mix(size.astype(U64) + _SEED_CHAIN)
    for nth in range(int(size.max(initial=0))):
        if nth < size.min():
            out = mix(out * _MULT + values[start + nth])
        else:
            rows = np.flatnonzero(size > nth)
            out[rows] = mix(out[rows] * _MULT + values[start[rows] + nth])
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some texts, each a maximal run of bytes other than ASCII white space.

    ``start``/``end`` are byte positions in ``data``, ``doc`` the text's number, ``first`` the number of each
    text's first word (one more entry than texts).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        space = _SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = after[-1] = True
            before[1:] = space[:-1] | cut[1:n]
            after[:-1] = space[1:] | cut[1:n]
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(after & ~space) + 1
        self.space = space
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def sums(self) -> np.ndarray:
        return span_sums(self.data, self.start, self.end)

    def chains(self) -> np.ndarray:
        return span_chains(self.data, self.start, self.end)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about ``size`` bytes."""
    data, offsets = column_bytes(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        b = min(n, b, a + 100_000)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def int_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 where null) and the mask of those that aren't null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.asarray(column.is_valid())
    return np.asarray(column.fill_null(0)).astype(np.int64), valid


# ---------------------------------------------------------------- components


def _settled(edges: DataFrame) -> bool:
    """Whether every component is a star: no node has two others above it, or one above and one below."""
    sides = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return sides.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").limit(1).count() == 0


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> Kept:
    """(node, component) of an undirected graph given as rows (u, v); component is the smallest node reachable.

    Alternates large-star and small-star until every component is a star. Each round reads a written table, takes minima with
    partial aggregation and joins them back, so that the neighbours of one node are never gathered in a task.
    Nulls in u or v are dropped, as are loops. Nodes without an edge do not appear.
    """
    now = Kept(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges")
    for k in range(max_rounds):
        if _settled(now.df):
            break
        both = now.df.unionByName(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        last, now = now, Kept(small, f"{name}-round{k}")
        last.drop()
    else:
        raise RuntimeError("components did not settle")
    found = Kept(now.df.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), name)
    now.drop()
    return found
