"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Words are runs of letters, digits and bytes beyond ASCII, lower-cased in A-Z; all else separates them.

1. Document frequencies of the items' pairs of words are counted over the whole corpus. An alignment with M matches and E edits
   scores M - E and has at most E + 1 runs of matches, so it holds at least M - E - 1 pairs of the item: all but at most
   L - T of the L - 1 pairs of an item of L words, where T is the least score that counts. Hence an item's seeds are its
   L - T + 1 rarest pairs: every alignment that counts holds one of them, however frequent they are and whichever are broken.
2. Every occurrence of a seed in a document joins a passage around it to the item: the seed's place says where the item would
   begin, and passages of one item that begin close together are one. An alignment leaves its diagonal by at most L - T words,
   so the passage holds it. Passages with fewer than T - 1 pairs of the item can't reach T and are left out.
3. Local alignment (match 1, mismatch and gap -1) of passage and item gives a score; its share of the item's length is the
   similarity, so edits, insertions and omissions lower it little by little.

Items are sent to every task in blocks of a bounded number of n-grams; more items mean more passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Kept, Words, chunks, mix, run_sums, ship

#: Words of a seed (the bounds above are for two); the least similarity; the least score of items that are longer than it.
SEED, SIMILAR, LEAST = 2, 0.5, 6
#: N-grams of a block of items (some 50 bytes each where they are sent).
BLOCK_GRAMS = 1_000_000
HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

_OTHER = U64(0x2545F4914F6CDD1D)
_WORD = np.full(256, 32, np.uint8)
for _a, _b in ((48, 57), (97, 122), (128, 255)):
    _WORD[_a : _b + 1] = np.arange(_a, _b + 1)
_WORD[65:91] = np.arange(97, 123)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, by both families, number of each text's first word)."""
    w = Words(_WORD[data], offsets)
    return mix(w.sums() ^ mix(w.chains() + _OTHER)), w.first


def grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the runs of ``n`` words within a text; a shorter text is one run."""
    count = np.diff(first)
    many = np.maximum(count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), many)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + first[:-1][doc]
    return run_sums(words, start, np.minimum(start + n, first[1:][doc])), start


class Items:
    """Test items as arrays: what every task gets."""

    def __init__(self, ids: list[int], texts: list[str], similar: float = SIMILAR):
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        words, first = words_of(np.frombuffer(b"".join(raw), np.uint8), offsets)
        kept = np.diff(first) > 0
        self.ids = np.array(ids, np.int64)[kept]
        self.words = [words[i:j] for i, j, k in zip(first[:-1], first[1:], kept, strict=True) if k]
        self.size = np.array([len(x) for x in self.words], np.int64)
        self.least = np.maximum(np.ceil(similar * self.size).astype(np.int64), np.minimum(LEAST, self.size))
        begin = np.concatenate([[0], np.cumsum(self.size)])
        gram, start = grams(np.concatenate(self.words) if self.words else np.zeros(0, U64), begin, SEED)
        self.item = np.searchsorted(begin, start, side="right") - 1
        self.place = start - begin[self.item]
        self.keys, self.key = np.unique(gram, return_inverse=True)
        #: Each item with each of its n-grams.
        self.pairs = np.unique(self.item * len(self.keys) + self.key)
        self.single = bool((self.size == 1).any())

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the key, first word) of the items' n-grams in some texts, in order; single words if an item is one."""
        gram, start = grams(words, first, SEED)
        if self.single:
            one = np.arange(len(words))
            gram, start = np.concatenate([gram, run_sums(words, one, one + 1)]), np.concatenate([start, one])
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, gram), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == gram)
        if self.single:
            hit = hit[np.argsort(start[hit], kind="stable")]
        return at[hit], start[hit]

    def seeds(self, frequency: np.ndarray) -> None:
        """Keep as seeds the rarest n-grams of each item, as many as its least score asks for. ``frequency`` goes with ``keys``."""
        order = np.lexsort((self.place, frequency[self.key], self.item))
        own = self.item[order]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        order = order[rank <= (self.size - self.least)[own]]
        order = order[np.argsort(self.key[order], kind="stable")]
        self.key, self.item, self.place = self.key[order], self.item[order], self.place[order]


def _ragged(low: np.ndarray, many: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ... (many[0] numbers), low[1], ..."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


# ---------------------------------------------------------------- alignment


def smith_waterman(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, start, end) of the best local alignment of each item with its passage; start and end in the passage.

    All pairs advance a row at a time. A cell holds its score and, in the low bits, where its alignment starts; a running
    maximum does a row's horizontal gaps at once. Of equal scores the later start wins, then the earlier end.
    """
    n, height, width = len(items), max(map(len, items)), max(map(len, passages))
    a, b = np.full((n, height), -1, np.int64), np.full((n, width), -2, np.int64)
    for k, (x, y) in enumerate(zip(items, passages, strict=True)):
        a[k, : len(x)] = x.astype(np.int64)
        b[k, : len(y)] = y.astype(np.int64)
    one = 1 << 24
    fresh = np.arange(width + 1, dtype=np.int64)
    slope = fresh * one
    row = np.tile(fresh, (n, 1))
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    every = np.arange(n)
    for i in range(height):
        now = np.empty_like(row)
        now[:, 0] = 0
        step = np.where((b == a[:, i : i + 1]) & (a[:, i : i + 1] != -1), one, -one)
        np.maximum(row[:, :-1] + step, row[:, 1:] - one, out=now[:, 1:])
        np.maximum(now, fresh, out=now)
        now = np.maximum(np.maximum.accumulate(now + slope, axis=1) - slope, fresh)
        at = (now >> 24).argmax(axis=1)
        top = now[every, at]
        better = (top >> 24) > (best >> 24)
        best[better], end[better] = top[better], at[better]
        row = now
    return best >> 24, best & (one - 1), end


def _matches(items: Items, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, float, int, int]]:
    """(text, item, score, similarity, start, end) of the items found in some texts."""
    code, start = items.hits(words, first)
    if not len(code):
        return []
    # Each hit with all seeds of its n-gram.
    low, high = np.searchsorted(items.key, code), np.searchsorted(items.key, code, side="right")
    entry = _ragged(low, high - low)
    place = np.repeat(start, high - low)
    item = items.item[entry]
    text = np.searchsorted(first, place, side="right") - 1
    size = items.size[item]
    bucket = (place - items.place[entry] - first[text] + size) // size  # where the item would begin, in item lengths
    found = np.unique(np.stack([text, item, bucket], axis=1), axis=0)
    text, item, bucket = found.T
    size = items.size[item]
    slack = np.maximum(size // 2, size - items.least[item]) + 4
    begin = np.maximum((bucket - 1) * size - slack, 0)
    stop = np.minimum((bucket + 1) * size + slack, (first[1:] - first[:-1])[text])
    # Only passages with enough of the item's n-grams to reach its least score.
    low, high = np.searchsorted(start, first[text] + begin), np.searchsorted(start, first[text] + stop)
    many = np.maximum(high - low, 0)
    shared = np.zeros(len(text), np.int64)
    ends = np.cumsum(many)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + 1_000_000, side="right")))
        pair = np.repeat(item[i:j], many[i:j]) * len(items.keys) + code[_ragged(low[i:j], many[i:j])]
        at = np.minimum(np.searchsorted(items.pairs, pair), len(items.pairs) - 1)
        shared[i:j] = np.bincount(np.repeat(np.arange(j - i), many[i:j]), weights=items.pairs[at] == pair, minlength=j - i)
        i = j
    enough = shared >= items.least[item] - 1
    text, item, begin, stop, size = text[enough], item[enough], begin[enough], stop[enough], size[enough]
    order = np.argsort(size, kind="stable")
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    i = 0
    while i < len(order):
        rows = order[i : i + max(1, 100_000 // int(size[order[i]] * 3 + 8))]  # a bounded number of cells, padding apart
        i += len(rows)
        passages = [words[first[text[r]] + begin[r] : first[text[r]] + stop[r]] for r in rows]
        rows, passages = [r for r, p in zip(rows, passages, strict=True) if len(p)], [p for p in passages if len(p)]
        if not rows:
            continue
        for r, score, a, b in zip(rows, *(x.tolist() for x in smith_waterman([items.words[item[r]] for r in rows], passages)), strict=True):
            key, value = (int(text[r]), int(item[r])), (score, -int(begin[r] + a), -int(begin[r] + b))
            if value > best.get(key, (0, 0, 0)):
                best[key] = value
    return [(t, k, s, s / int(items.size[k]), -a, -b) for (t, k), (s, a, b) in sorted(best.items()) if s >= items.least[k]]


# ---------------------------------------------------------------- Spark


def _blocks(benchmark: DataFrame, similar: float) -> Iterator[Items]:
    """All items, in blocks. Null or empty texts and null ids are left out; equal rows count once."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += len(r["text"]) // 2 + 1  # no text has more words
        if size > BLOCK_GRAMS:
            yield Items(ids, texts, similar)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, similar)


def _counted(docs: DataFrame, items: Items) -> Items:
    """The items with their seeds, after a count of documents that hold each n-gram."""
    size = len(items.keys)
    if not size:
        return items

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                words, first = words_of(data, offsets)
                code, start = items.hits(words, first)
                text = np.searchsorted(first, start, side="right") - 1
                total += np.bincount(np.unique(text * size + code) % size, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["k", "n"])

    got = docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(size, np.int64)
    frequency[np.asarray(got.column("k"))] = np.asarray(got.column("n"))
    items.seeds(frequency)
    return items


def find_leaks(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, item_id, score, similarity, start, end): a row for each document and item that align at ``similar`` or more.

    score is the local alignment's, similarity its share of the item's words; start and end (exclusive) are the
    passage's words in the document. An item's score must also reach the least of its length and ``LEAST``.

    Null or empty texts on either side, and null item_ids, match nothing. A null doc_id keeps its rows; rows that repeat a
    doc_id give rows each. Items with equal texts are found each. Very long texts are searched whole. Other columns are
    not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    out = spark.createDataFrame([], "doc_id long, item_id long, score long, similarity double, start long, end long")
    for k, items in enumerate(_blocks(benchmark, similar)):
        ready = _counted(docs, items)

        def run(batches, ready=ready):
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for a, _, data, offsets in chunks(batch.column("text")):
                    rows = [(ids[a + t], int(ready.ids[k]), s, share, i, j) for t, k, s, share, i, j in _matches(ready, *words_of(data, offsets))]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), HITS, strict=True)], schema=HITS)

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, out.schema)
        out = out.unionByName(found) if k else found
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``docs`` without the rows whose text holds an item of ``benchmark``, as ``find_leaks`` finds them; all columns stay."""
    ship(docs.sparkSession)
    original, kept = docs, None
    for k, items in enumerate(_blocks(benchmark, similar)):
        ready = _counted(original, items)
        if k:  # what is left after a block is written, so that each block aligns once
            before, kept = kept, Kept(docs, "decontam-left")
            docs = kept.df
            if before:
                before.drop()

        def run(batches, ready=ready):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for a, _, data, offsets in chunks(batch.column("text")):
                    keep[[a + m[0] for m in _matches(ready, *words_of(data, offsets))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
