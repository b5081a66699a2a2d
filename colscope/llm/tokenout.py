"""Token ids in a compact file format: canonical, length-limited Huffman codes of ids from global counts.

Writing: 1. texts become ids, kept as a table in the shared folder; 2. Spark counts all ids, the driver makes the code
lengths (package-merge over the vocabulary, whose size does not grow with the corpus); 3. documents are sorted into ranges
of doc_id of some millions of ids, and each range is packed into blocks in that order while it is read, so that no more than
a block is in memory.

The format: a Parquet table ``blocks`` with a row for each block and a table ``code`` with (id, length); canonical codes
follow from the lengths. A block holds whole documents, each starting at a byte border. ``checkpoints`` has the bit offset
of every 256th id of the block's payload (and of each document's start), so a block is decoded alone, and all its
segments at once: each step looks up one table entry for every segment.

Reading: blocks are decoded in any order and by any task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Kept, ship
from .tokens import encoded

#: Ids between two checkpoints, ids of a range, ids of a block (a longer document makes a larger one).
SEGMENT, RANGE, BLOCK = 256, 4_000_000, 262_144
#: Longest code in bits, unless the vocabulary needs more.
LONGEST = 18

IDS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
BLOCKS = pa.schema([("range", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])


# ---------------------------------------------------------------- codes


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits for the ids with a count above 0 (0 for the others): package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    longest = max(longest, (n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, current = [], leaves
    for _ in range(longest - 1):
        levels.append(current)
        pairs = current[: len(current) // 2 * 2].reshape(-1, 2).sum(axis=1)
        current = np.concatenate([leaves, pairs])
        by = np.argsort(current, kind="stable")
        levels[-1] = by < n  # which items of the next level are leaves
        current = current[by]
    take = 2 * (n - 1)
    depth = np.zeros(n, np.int64)
    for leaf in reversed(levels):
        k = int(leaf[:take].sum())
        depth[:k] += 1
        take = 2 * (take - k)
    depth[:take] += 1
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    ls = lengths[order]
    if len(order):
        # the first code is 0, the next (code + 1) << (growth in length): sums of 2**-length, scaled by the longest
        top = int(ls[-1])
        steps = np.concatenate([[0], np.cumsum(1 << (top - ls))[:-1]])
        codes[order] = steps >> (top - ls)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, length) for each value of the next ``width`` bits, and ``width``."""
    width = max(1, int(lengths.max(initial=0)))
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (width - lengths[order])
    ids, bits = np.zeros(1 << width, np.int64), np.ones(1 << width, np.int64)
    ids[: spans.sum()], bits[: spans.sum()] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, bits, width


def pack(ids: np.ndarray, doc_of: np.ndarray, first: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(payload, bit offset of each id, byte offset of each document and the end): each document starts at a byte border."""
    if not len(ids):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(len(first), np.int64)
    size = lengths[ids]
    before = np.concatenate([[0], np.cumsum(size)])
    doc_bits = before[first[1:]] - before[first[:-1]]
    borders = np.concatenate([[0], np.cumsum((doc_bits + 7) // 8)])
    at = before[:-1] + (borders[:-1] * 8 - before[first[:-1]])[doc_of]
    word, off = at >> 5, at & 31
    wide = codes[ids].astype(U64) << (64 - off - size).astype(U64)
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(borders[-1]) // 4 + 3, U64)
    out[word[starts]] += np.add.reduceat(wide >> U64(32), starts)
    out[word[starts] + 1] += np.add.reduceat(wide & U64(0xFFFFFFFF), starts)
    return out.astype(">u4").view(np.uint8)[: borders[-1]], at, borders


def unpack(payload: np.ndarray, starts: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of the segments that start at the bit offsets ``starts`` and have ``sizes`` ids, all segments in step."""
    ids, bits, width = table
    data = np.concatenate([payload, np.zeros(16, np.uint8)])
    words = (data[:-7].astype(U64) << U64(32)) | (data[1:-6].astype(U64) << U64(24)) | (data[2:-5].astype(U64) << U64(16)) | (data[3:-4].astype(U64) << U64(8)) | data[4:-3].astype(U64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(offsets[-1], np.int64)
    order = np.argsort(-sizes, kind="stable")
    at, to, left = starts[order].copy(), offsets[:-1][order], sizes[order]
    mask = U64((1 << width) - 1)
    for step in range(int(sizes.max(initial=0))):
        n = int(np.searchsorted(-left, -step, side="left"))  # those with more than ``step`` ids
        now = at[:n]
        look = ((words[now >> 3] >> (40 - width - (now & 7)).astype(U64)) & mask).astype(np.int64)
        out[to[:n] + step] = ids[look]
        now += bits[look]
    return out


# ---------------------------------------------------------------- writing


def _tokens(path: str, end_id: int):
    def run(batches):
        for batch in batches:
            doc = batch.column("doc_id")
            for a, ids, offs in encoded(batch.column("text"), path, end_id):
                n = len(offs) - 1
                raw = pa.py_buffer(ids.astype(np.uint16 if ids.max(initial=0) < 65536 else np.uint32).tobytes())
                width = len(raw) // max(len(ids), 1)
                kept = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((offs * width).astype(np.int64).tobytes()), raw]).cast(pa.binary())
                crc = pa.array([zlib.crc32(x) for x in kept.to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([doc.slice(a, n), pa.array(np.diff(offs)), crc, kept], schema=IDS)

    return run


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32)


def _joined(n: pa.Array, ids: pa.Array) -> np.ndarray:
    return np.concatenate([_wide(x, k) for x, k in zip(ids.to_pylist(), n.to_pylist(), strict=True)]).astype(np.int64) if len(n) else np.zeros(0, np.int64)


def _count(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        now = np.bincount(_joined(batch.column("n"), batch.column("ids")), minlength=len(total))
        now[: len(total)] += total
        total = now
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def _packer(lengths: np.ndarray, block: int):
    """Sorted rows of a range become blocks."""
    codes = canonical(lengths)

    def packed(part: int, group: int, done: int, held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        size = np.array([n for _, n, _ in held], np.int64)
        ids = np.concatenate([_wide(raw, n) for _, n, raw in held]).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        payload, at, _ = pack(ids, np.repeat(np.arange(len(size)), size), first, codes, lengths)
        row = (part, group, done, [d for d, _, _ in held], size.tolist(), at[segments(size)[0]].tolist(), payload.tobytes())
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, BLOCKS, strict=True)], schema=BLOCKS)

    def run(batches):
        group, done, total, held, part = 0, 0, 0, [], 0
        for batch in batches:
            for part, doc, n, raw in zip(*(batch.column(c).to_pylist() for c in ("range", "doc_id", "n", "ids")), strict=True):
                if held and total + n > block:
                    yield packed(part, group, done, held)
                    group, done, total, held = group + 1, done + total, 0, []
                held.append((doc, n, raw))
                total += n
        if held:
            yield packed(part, group, done, held)

    return run


def segments(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number (in the block) of each segment's first id, and each segment's size; documents begin segments."""
    parts = (sizes + SEGMENT - 1) // SEGMENT
    doc = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return first[doc] + nth * SEGMENT, np.minimum(sizes[doc] - nth * SEGMENT, SEGMENT)


def write_tokens(docs: DataFrame, out: str, tokenizer: str, end_id: int, range_ids: int = RANGE, block: int = BLOCK, longest: int = LONGEST) -> None:
    """Write the ids of all texts below ``out`` (a folder of the shared storage) in ascending doc_id order.

    Reads doc_id and text. A null text is an empty one, of just ``end_id``. A null doc_id comes first; rows that repeat
    a doc_id each stay, in order of length, then checksum. Very long texts stay whole. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = Kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokens(tokenizer, end_id), "doc_id long, n long, crc long, ids binary"), "token-ids")
    counted = kept.df.select("n", "ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    number, times = (np.asarray(counted.column(c)).astype(np.int64) for c in ("id", "n"))
    counts = np.zeros(int(number.max(initial=0)) + 1, np.int64)
    counts[number] = times
    lengths = code_lengths(counts, longest)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": used, "length": lengths[used]})).coalesce(1).write.parquet(f"{out}/code")
    ranges = max(1, -(-int(counts.sum()) // range_ids))
    # The last key parts rows that are equal in all, however many there are.
    order = ["doc_id", "n", "crc", "row"]
    dealt = kept.df.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    blocks = dealt.select("range", "doc_id", "n", "ids").mapInArrow(_packer(lengths, block), "range int, block int, first long, doc_ids array<long>, n_tokens array<long>, checkpoints array<long>, payload binary")
    blocks.write.option("compression", "zstd").parquet(f"{out}/blocks")
    kept.drop()


# ---------------------------------------------------------------- reading


DECODED = pa.schema([("range", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _decoder(lengths: np.ndarray, digest: bool):
    table = decode_table(lengths)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_tokens"], np.int64)
                ids = unpack(np.frombuffer(row["payload"], np.uint8), np.array(row["checkpoints"], np.int64), segments(sizes)[1], table).astype("<u4")
                cut = np.concatenate([[0], np.cumsum(sizes)])
                raw = memoryview(ids.tobytes())
                parts = [raw[4 * i : 4 * j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                last = pa.array([zlib.crc32(x) for x in parts], pa.int64()) if digest else pa.array([bytes(x) for x in parts], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([row["range"]] * len(sizes), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["first"] + cut[:-1]), pa.array(sizes), last], names=["range", "doc_id", "first", "n_tokens", "ids"])

    return run


def read_tokens(spark: SparkSession, out: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a written folder: ids are 32-bit little-endian numbers, or with ``digest`` their
    unsigned crc32. ``start`` counts the ids of all documents before."""
    ship(spark)
    code = spark.read.schema("id long, length long").parquet(f"{out}/code").toArrow()
    number, length = (np.asarray(code.column(c)).astype(np.int64) for c in ("id", "length"))
    lengths = np.zeros(int(number.max(initial=0)) + 1, np.int64)
    lengths[number] = length
    blocks = spark.read.parquet(f"{out}/blocks")
    docs = blocks.mapInArrow(_decoder(lengths, digest), f"range int, doc_id long, first long, n_tokens long, ids {'long' if digest else 'binary'}")
    # A range has some millions of ids; the sums over 1024 ranges, then over all such, stay small.
    sums = blocks.select("range", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("range").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("high", F.shiftright("range", 10))
    highs = sums.groupBy("high").agg(F.sum("n").alias("h")).withColumn("before_high", F.sum("h").over(Window.orderBy("high")) - F.col("h"))
    starts = sums.withColumn("inside", F.sum("n").over(Window.partitionBy("high").orderBy("range")) - F.col("n")).join(highs, "high").select("range", (F.col("inside") + F.col("before_high")).alias("before"))
    return docs.join(starts, "range").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids")

