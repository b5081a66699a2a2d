"""Best-fit packing of token pieces into sequences of a fixed capacity, with matching of large items.

Only lengths matter for a plan, and there are at most ``capacity`` of them. Spark counts the pieces of each length; from
these counts the driver plans runs of equal steps ("the next n pieces of this length, t to a bin, into the bins from
number b on"), so neither its time nor its memory grows with the number of pieces:

1. Pieces above one third of the capacity are large: two fit a bin at most. In descending length each takes the largest
   large piece that still fits beside it (greedy matching); without one it has a bin alone.
2. Smaller pieces, in descending length, go where the least gap remains that holds them (best fit); a new bin is opened
   when there is none.

Spark then numbers the pieces within each length (in groups of a bounded size, so that a common length is dealt to many
tasks), and a piece's length and number give its bin and place in the plan.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Kept, ship
from .tokens import encoded

#: A length's pieces are numbered in groups of about so many.
GROUP = 200_000
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("salt", pa.int32())])


# ---------------------------------------------------------------- the plan


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first, n, per_bin, bin, offset): the pieces of ``length`` numbered from ``first`` to ``first + n - 1`` go,
    ``per_bin`` to a bin, into the bins from number ``bin`` on, from place ``offset`` on."""
    left = {s: n for s, n in counts.items() if n > 0}
    done = dict.fromkeys(left, 0)
    steps: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first bin, bins)
    order: list[int] = []  # the gaps there are, ascending
    bins = 0

    def leave(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    def put(length: int, n: int, per_bin: int, first_bin: int, offset: int) -> None:
        steps.append((length, done[length], n, per_bin, first_bin, offset))
        done[length] += n
        left[length] -= n

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    by_size = large[::-1]
    for s in large:
        while left[s]:
            at = bisect.bisect_right(by_size, min(s, capacity - s)) - 1
            while at >= 0 and left[by_size[at]] < (2 if by_size[at] == s else 1):
                at -= 1
            if at < 0:
                n, first = left[s], bins
                put(s, n, 1, first, 0)
                leave(capacity - s, first, n)
                bins += n
            else:
                mate = by_size[at]
                n, first = (left[s] // 2 if mate == s else min(left[s], left[mate])), bins
                put(s, n, 1, first, 0)
                put(mate, n, 1, first, s)
                leave(capacity - s - mate, first, n)
                bins += n
    for s in sorted((s for s in left if left[s]), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at == len(order):  # no gap: new bins
                gap, first, n = capacity, bins, -(-left[s] // (capacity // s))
                bins += n
            else:
                gap = order[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
            fit = gap // s
            full = min(n, left[s] // fit)
            if full:
                put(s, full * fit, fit, first, capacity - gap)
                leave(gap - fit * s, first, full)
            rest = left[s] if full < n else 0
            if rest:
                put(s, rest, fit, first + full, capacity - gap)
                leave(gap - rest * s, first + full, 1)
                full += 1
            leave(gap, first + full, n - full)
    return steps


# ---------------------------------------------------------------- Spark


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches):
        done = 0
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for a, ids, offs in encoded(batch.column("text"), path, end_id):
                raw = memoryview(ids.astype("<u4").tobytes())
                rows = [(docs[a + k], p, i, min(capacity, n - i), zlib.crc32(raw[4 * (o + i) : 4 * (o + min(i + capacity, n))])) for k, (o, n) in enumerate(zip(offs[:-1].tolist(), np.diff(offs).tolist(), strict=True)) for p, i in enumerate(range(0, n, capacity))]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=False)]
                salt = pa.array((np.arange(done, done + len(rows)) % 2**31).astype(np.int32))
                done += len(rows)
                yield pa.RecordBatch.from_arrays([*columns, salt], schema=PIECES)

    return run


def _placer(steps: np.ndarray, first_group: np.ndarray, before: np.ndarray):
    """first_group: of each length, among the groups of all; before: pieces of its length in the groups before each."""
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    key = steps[:, 0] * (2**44) + steps[:, 1]

    def run(batches):
        for b in batches:
            length, salt, number = (np.asarray(b.column(c)).astype(np.int64) for c in ("length", "salt", "number"))
            number = number + before[first_group[length] + salt]
            s = steps[np.searchsorted(key, length * (2**44) + number, side="right") - 1]
            nth = number - s[:, 1]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")], pa.array(s[:, 4] + nth // s[:, 3]), pa.array(s[:, 5] + nth % s[:, 3] * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text, then ``end_id``; those above ``capacity`` are cut into pieces of that length, the
    last being the rest. Pieces of a sequence follow each other from place 0 without a gap.

    A null or empty text is one piece of ``end_id`` alone. Very long texts have many pieces. Rows that repeat a doc_id, or
    have none, are documents of their own. Reads doc_id and text only. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, end_id, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, salt int")
    pieces = Kept(found, "packing-pieces").df
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    groups = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        groups[length] = -(-n // GROUP)
    first_group = np.cumsum(groups) - groups
    many = spark.createDataFrame(pa.table({"length": np.arange(capacity + 1), "groups": groups}))
    pieces = pieces.join(F.broadcast(many), "length").withColumn("salt", F.pmod("salt", F.col("groups").cast("int")))
    # A row for each group of GROUP pieces, so some thousands for a billion pieces.
    sizes = np.zeros(int(groups.sum()), np.int64)
    for r in pieces.groupBy("length", "salt").agg(F.count("*").alias("n")).collect():
        sizes[first_group[r["length"]] + r["salt"]] = r["n"]
    total = np.cumsum(sizes) - sizes
    before = total - np.repeat(total[np.minimum(first_group, max(len(total) - 1, 0))] if len(total) else np.zeros(capacity + 1, np.int64), groups)
    steps = np.array(plan(counts, capacity), np.int64).reshape(-1, 6)
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return pieces.withColumn("number", F.row_number().over(within).cast("long") - 1).mapInArrow(_placer(steps, first_group, before), OUT)
