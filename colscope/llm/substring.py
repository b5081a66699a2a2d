"""Exact substring deduplication by recompression.

Rounds of recompression parse each text: in a round, runs of a symbol get a name, then neighbours of different halves of
the alphabet (a hash bit of the name, another in each round) are paired and named. A name is the hash of what it stands
for, so all of the corpus names alike and equal substrings get the same symbols inside, wherever they lie. Each symbol
carries the stretch of words that decided it (itself and the neighbours that were looked at); every text that holds this
stretch has the symbol in the same place.

1. Each window (``window`` consecutive words) chooses, of the symbols whose stretch it contains, the one of the highest round
   with the least hash: its anchor. Equal windows choose alike. Windows without one (parts of long runs) are their own anchor.
   Successive windows with one anchor form a group, named by the hash of the anchor's stretch (``key``), with a hash of all
   the words that the group's windows cover (``around``).
2. Spark gathers, by key, the least doc_id, and whether ``around`` differs. Keys of one document only are done with.
3. Where all groups of a shared key have the same surroundings, all their windows are equal: those of documents after the
   first go. Otherwise the group's windows are compared one by one, by hash, in the same way.
4. The ranges of windows found go to their documents, whose words inside are removed.

Each of 2 to 4 shuffles hashes and places only; texts move once, in 4. Aggregates come before joins, so a key that a third of
all documents share makes one row for each task, and adaptive execution can split its join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Kept, Words, chunks, int_column, mix, release, run_chains, run_sums, ship

#: Rounds of recompression: symbols of two rounds stand for four words at most, apart from runs.
ROUNDS = 2
#: Most bits of a filter of shared keys (128 MB); it only spares rows a shuffle, so a fuller one changes no result.
MOST_BITS = 2**30
PAGE_BITS = 2**20


# ---------------------------------------------------------------- recompression


class Symbols:
    """A parse: names, and for each symbol the stretch of words [left, right) that decided it, and its text."""

    def __init__(self, name: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray):
        self.name, self.left, self.right, self.doc = name, left, right, doc

    def following(self, first: np.ndarray, salt: int) -> Symbols:
        """The parse after another round. A decision at a text's border has a stretch beyond it, which no window contains."""
        n = len(self.name)
        if not n:
            return self
        low, high = first[self.doc] - 1, first[self.doc + 1] + 1
        same = self.doc[1:] == self.doc[:-1]
        # Runs: the symbols on both sides were looked at.
        start = np.flatnonzero(np.concatenate([[True], ~(same & (self.name[1:] == self.name[:-1]))]))
        last = np.append(start[1:], n) - 1
        size = last - start + 1
        name = np.where(size > 1, mix(self.name[start] + size.astype(U64) * U64(0xD6E8FEB86659FD93) + U64(2 * salt + 1)), self.name[start])
        before, after = np.maximum(start - 1, 0), np.minimum(last + 1, n - 1)
        doc = self.doc[start]
        left = np.where((start > 0) & (self.doc[before] == doc), self.left[before], low[start])
        right = np.where((last < n - 1) & (self.doc[after] == doc), self.right[after], high[start])
        low, high = low[start], high[start]
        # Pairs: a first of one half beside a second of the other.
        m = len(start)
        second = (mix(name ^ U64(0xA24BAED4963EE407 * (salt + 1) % 2**64)) & U64(1)).astype(bool)
        same = doc[1:] == doc[:-1]
        pair = np.append(~second[:-1] & second[1:] & same, False)
        taken = np.concatenate([[False], pair[:-1]])
        head = np.flatnonzero(~taken)
        nxt, prv = np.minimum(head + 1, m - 1), np.maximum(head - 1, 0)
        paired = pair[head]
        named = np.where(paired, mix(name[head] * U64(0x9FB21C651E98DF25) + name[nxt] + U64(2 * salt)), name[head])
        # A single first looked at its right neighbour, a single second at its left one.
        next_right = np.where((head + 1 < m) & (doc[nxt] == doc[head]), right[nxt], high[head])
        prev_left = np.where((head > 0) & (doc[prv] == doc[head]), left[prv], low[head])
        single_second = ~paired & second[head]
        return Symbols(named, np.where(single_second, prev_left, left[head]), np.where(single_second, right[head], next_right), doc[head])


def _choose(symbols: Symbols, at: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """For each window start in ``at`` the symbol of the least rank within it (the leftmost of equals), or -1."""
    out = np.full(len(at), -1, np.int64)
    n = len(symbols.name)
    if not n or not len(at):
        return out
    low = np.cumsum(np.bincount(symbols.left + 1, minlength=n_words + 3))[at]  # symbols whose left is before the window
    high = np.cumsum(np.bincount(symbols.right, minlength=n_words + 3))[at + window] - 1  # the last that ends inside
    some = np.flatnonzero(low <= high)
    if not len(some):
        return out
    low, high = low[some], high[some]
    rank = mix(symbols.name ^ U64(0x5851F42D4C957F2D))
    level = np.frexp((high - low + 1).astype(float))[1] - 1
    best = np.arange(n)
    picked = np.empty(len(some), np.int64)
    for k in range(int(level.max()) + 1):
        rows = np.flatnonzero(level == k)
        if len(rows):
            a, b = best[low[rows]], best[high[rows] - (1 << k) + 1]
            picked[rows] = np.where(rank[b] < rank[a], b, a)
        if (1 << k) < len(best):
            a, b = best[: len(best) - (1 << k)], best[1 << k :]
            best = np.concatenate([np.where(rank[b] < rank[a], b, a), best[len(best) - (1 << k) :]])
    out[some] = picked
    return out


class Groups:
    """Groups of windows: text, key, around, and the windows' first and last start (numbers of words)."""

    def __init__(self, words: np.ndarray, others: np.ndarray, first: np.ndarray, window: int, rounds: int = ROUNDS):
        """``words`` name symbols and keys; ``others``, hashes of the same words of another family, tell windows apart."""
        n = len(words)
        count = np.diff(first)
        doc = np.repeat(np.arange(len(count)), count)
        at = np.flatnonzero(np.arange(n) + window <= first[1:][doc])
        self.words = others
        levels = [Symbols(words, np.arange(n), np.arange(n) + 1, doc)]
        for k in range(rounds):
            levels.append(levels[-1].following(first, k))
        chosen = np.full(len(at), -1, np.int64)
        left, right, name = at.copy(), at + window, np.zeros(len(at), U64)
        for k in range(rounds, 0, -1):
            rest = np.flatnonzero(chosen < 0)
            got = _choose(levels[k], at[rest], n, window)
            hit = rest[got >= 0]
            symbol = got[got >= 0]
            chosen[hit] = symbol * (rounds + 1) + k
            left[hit], right[hit], name[hit] = levels[k].left[symbol], levels[k].right[symbol], levels[k].name[symbol] + U64(k)
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (chosen[1:] < 0) | (at[1:] != at[:-1] + 1)
        else:
            new = np.zeros(0, bool)
        begin = np.flatnonzero(new)
        self.low = at[begin]
        self.high = at[np.append(begin[1:], len(at)) - 1] if len(begin) else self.low
        self.doc = doc[self.low]
        left, right, name = left[begin], right[begin], name[begin]
        self.key = mix(run_sums(words, left, right) ^ name).astype(np.int64)
        self.around = mix(run_chains(others, self.low, self.high + window) + (left - self.low).astype(U64)).astype(np.int64)


def _groups(column, window: int) -> Iterator[tuple[int, np.ndarray, Groups]]:
    for a, _, data, offsets in chunks(column, 1_000_000):
        w = Words(data, offsets)
        yield a, w.first, Groups(w.sums(), w.chains(), w.first, window)


# ---------------------------------------------------------------- tasks


def _keys(window: int):
    def run(batches):
        for batch in batches:
            ids, valid = int_column(batch.column("doc_id"))
            for a, _, g in _groups(batch.column("text"), window):
                doc = ids[a + g.doc]
                keep = np.flatnonzero(valid[a + g.doc])
                order = keep[np.lexsort((g.around[keep], doc[keep], g.key[keep]))]
                key, doc, around = g.key[order], doc[order], g.around[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (around[1:] != around[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(around[new]), pa.array(doc[new])], names=["key", "around", "doc_id"])

    return run


def _page(table: pa.Table) -> pa.Table:
    bits = np.zeros(PAGE_BITS, np.uint8)
    bits[np.asarray(table.column("bit").combine_chunks())] = 1
    return pa.table([table.column("page").slice(0, 1), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["page", "bits"])


def _filter(keys: DataFrame, n: int):
    """A filter of ``keys`` as a broadcast array of bits, with 32 bits for each key as far as ``MOST_BITS`` allows."""
    size = PAGE_BITS
    while size < min(32 * n, MOST_BITS):
        size *= 2
    place = F.shiftrightunsigned("key", 64 - (size.bit_length() - 1))
    paged = keys.select(F.shiftright(place, 20).cast("int").alias("page"), place.bitwiseAND(PAGE_BITS - 1).cast("int").alias("bit"))
    bits = np.zeros(size // 8, np.uint8)
    for r in paged.groupBy("page").applyInArrow(_page, "page int, bits binary").toLocalIterator():
        bits[r["page"] * (PAGE_BITS // 8) : (r["page"] + 1) * (PAGE_BITS // 8)] = np.frombuffer(r["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def _may_hold(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key.astype(U64) >> U64(64 - ((len(bits) * 8).bit_length() - 1))
    return (bits[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1


PLACED = "key long, doc_id long, sig long, low long, high long, windows array<long>"


def _placed(window: int, shared, varied):
    def run(batches):
        for batch in batches:
            ids, valid = int_column(batch.column("doc_id"))
            sigs = np.asarray(batch.column("sig"))
            for a, first, g in _groups(batch.column("text"), window):
                rows = np.flatnonzero(valid[a + g.doc] & _may_hold(shared.value, g.key))
                low, high = g.low[rows], g.high[rows]
                size = np.where(_may_hold(varied.value, g.key[rows]), high - low + 1, 0)
                at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
                hashes = run_chains(g.words, at, at + window).astype(np.int64)
                windows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(hashes))
                doc, base = a + g.doc[rows], first[g.doc[rows]]
                yield pa.RecordBatch.from_arrays([pa.array(g.key[rows]), pa.array(ids[doc]), pa.array(sigs[doc]), pa.array(low - base), pa.array(high - base), windows], names=["key", "doc_id", "sig", "low", "high", "windows"])

    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _kept(window: int, text_out: bool):
    """Remove the words covered by windows that start in the listed ranges."""

    def run(batches):
        for batch in batches:
            ranges = batch.column("ranges")
            for a, b, data, offsets in chunks(batch.column("text")):
                w = Words(data, offsets)
                part = ranges.slice(a, b - a)
                many = np.asarray(part.value_lengths().fill_null(0)).astype(np.int64)
                pairs = part.flatten()
                low, high = (np.asarray(pairs.field(k)).astype(np.int64) for k in (0, 1))
                base = w.first[:-1][np.repeat(np.arange(b - a), many)]
                n = len(w.start)
                step = np.bincount(base + low, minlength=n + 1)[: n + 1] - np.bincount(base + high + window, minlength=n + 1)[: n + 1]
                gone = np.cumsum(step)[:n] > 0
                removed = np.concatenate([[0], np.cumsum(gone)])
                keep = ~gone
                # A kept word with the byte after it, which becomes a space.
                edge = np.zeros(len(data) + 2, np.int64)
                np.add.at(edge, w.start[keep], 1)
                np.add.at(edge, np.minimum(w.end[keep] + 1, offsets[1:][w.doc[keep]]), -1)
                inside = np.cumsum(edge)[: len(data)] > 0
                plain = np.where(w.space, np.uint8(32), data)
                texts = []
                for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    one = plain[i:j][inside[i:j]].tobytes()
                    texts.append(one.removesuffix(b" "))
                if not text_out:
                    texts = [hashlib.sha256(x).hexdigest().encode() for x in texts]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(np.diff(w.first).astype(np.int64)), pa.array((removed[w.first[1:]] - removed[w.first[:-1]]).astype(np.int64)), pa.array(texts, pa.binary())], schema=RESULT)

    return run


# ---------------------------------------------------------------- Spark


def repeated_windows(docs: DataFrame, window: int = 13) -> Kept:
    """(doc_id, sig, ranges): for each text the ranges (low, high) of starts of windows that also start in a document with a
    smaller doc_id, as a kept table. sig is a hash of the text, which tells rows of one doc_id apart."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    found = rows.mapInArrow(_keys(window), "key long, around long, doc_id long").groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min("around").alias("a"), F.max("around").alias("b"))
    shared = Kept(found.where("least < most").select("key", "least", (F.col("a") < F.col("b")).alias("varied")), "substring-shared")
    release(spark)
    n = shared.df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("varied").cast("long")), F.lit(0)).alias("v")).first()
    all_keys, varied = _filter(shared.df, n["n"]), _filter(shared.df.where("varied"), n["v"])
    placed = rows.withColumn("sig", F.xxhash64("text", F.lit(4))).mapInArrow(_placed(window, all_keys, varied), PLACED)
    joined = Kept(placed.join(shared.df, "key").where("varied or doc_id > least").select("key", "doc_id", "sig", "low", "high", "varied", F.when(F.col("varied"), F.col("windows")).alias("windows")), "substring-joined")
    all_keys.unpersist()
    varied.unpersist()
    release(spark)
    single = joined.df.where("not varied").select("doc_id", "sig", "low", "high")
    each = joined.df.where("varied").select("key", "doc_id", "sig", "low", F.posexplode("windows").alias("i", "w"))
    # Written before it is joined, so that a window that many texts share can be split among tasks.
    firsts = Kept(each.groupBy("key", "w").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("key", "w", "least"), "substring-firsts")
    one_by_one = each.join(firsts.df, ["key", "w"]).where("doc_id > least").select("doc_id", "sig", (F.col("low") + F.col("i")).alias("low"), (F.col("low") + F.col("i")).alias("high"))
    ranges = single.unionByName(one_by_one).groupBy("doc_id", "sig").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    out = Kept(ranges, "substring-ranges")
    for x in (shared, joined, firsts):
        x.drop()
    release(spark)
    return out


def remove_repeats(docs: DataFrame, window: int = 13, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words that a repeated window covers.

    Words are runs of bytes other than ASCII white space, unchanged. A window goes if its words also start, in this order, in a
    document with a smaller doc_id; what is judged is the input, not what is left. kept is the rest, joined by one space, or
    with ``digest`` the lowercase hex SHA-256 of its UTF-8.

    A null, empty or blank text has no words; one with fewer than ``window`` words keeps them. Repeats within a document, or
    within rows of one doc_id, stay. A row with a null doc_id keeps its words and counts for no other. Rows are not merged.
    Very long texts are handled whole. Other columns are not read. An empty table gives no rows.
    """
    ranges = repeated_windows(docs, window)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("sig", F.xxhash64("text", F.lit(4)))
    both = texts.join(ranges.df, ["doc_id", "sig"], "left").select("doc_id", "text", "ranges")
    out = both.mapInArrow(_kept(window, not digest), "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))
