"""Scoring of texts by online logistic context mixing.

A text is its words, lower-cased in A-Z, then an end. Each is coded as binary decisions: a path in a Huffman tree of the
``VOCABULARY`` most frequent training words, the end, and an escape; after an escape, the word's bytes and a stop by a tree of
bytes. The model says for every decision how likely each bit is, so the product is the probability of the text, and its binary
logarithm the bits that a coder would need.

1. Spark counts the words of all training texts; base scores and the trees come from these counts.
2. Predictors: tables of counts of both bits, by the node in the tree alone, and by a hash of the node and of a context: the last
   very common word, or the word before; inside a spelled word the last three or five bytes. Each gives a log-odds.
3. Mixing: the log-odds are weighted by a gate (which tree, how deep) and summed. Every task learns on line over all its training
   texts: it predicts a run of text from the counts so far, moves the weights along the gradient, block by block, and
   only then counts that run. What the sums say and what came out is tallied by gate, which refines the probabilities adaptively.
4. Tables and tallies of tasks are added up in pages, weights averaged by decisions. The model has a fixed size, stated by
   ``VOCABULARY`` and ``SLOTS``, and is broadcast to score all texts.
5. Words beyond the vocabulary look their counts up by a join, for the base score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Kept, Words, chunks, column_bytes, release, ship
from .phrases import _strings
from .tokenout import canonical, code_lengths

#: Words with a code of their own, at most, and the occurrences that they need; others are spelled. Very common words.
VOCABULARY, OFTEN, COMMON = 1 << 18, 8, 64
#: Places of each table of counts: of nodes without a context (more than there can be), and of two hashed contexts.
SLOT_BITS = 21
SLOTS = (1 << 19, 1 << SLOT_BITS, 1 << SLOT_BITS)
TABLES = len(SLOTS)
PAGE = 1 << 12
#: Depths with a gate of their own, for each of the two trees; steps of the tally of refined probabilities, which reaches to +-REACH.
DEPTHS, STEPS, REACH = 16, 512, 8.0
GATES = 2 * DEPTHS
#: Longest code, symbols handled at once, bytes of text between two refreshes of a task's log-odds: at first, later.
LONGEST, BLOCK, FIRST_BYTES, RUN_BYTES = 24, 1 << 16, 50_000, 2_000_000
#: Counts that a place starts with, and tallies that a step of the refinement starts with.
PRIOR, TRUST = 0.4, 32.0

_M1, _M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_TREE = np.uint32(0x165667B1)
_START = np.uint32(0x27D4EB2F)


def _hash32(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(15))) * _M2
    return (x ^ (x >> np.uint32(13))) * _M3


@dataclass
class Trees:
    """The codes of words (the vocabulary's, then escape, then end) and of bytes (256 and stop)."""

    words: pa.Array
    count: np.ndarray
    word_code: np.ndarray
    word_size: np.ndarray
    byte_code: np.ndarray
    byte_size: np.ndarray
    inner: list[list[int]]  # of each tree and depth: what turns the path to a node into the node's number

    @staticmethod
    def of(words: pa.Array, count: np.ndarray, escapes: int, ends: int, byte_count: np.ndarray) -> Trees:
        if len(words) + 3 + 257 > SLOTS[0]:
            raise ValueError(f"a vocabulary of {len(words)} words has more nodes than {SLOTS[0]}")
        sizes = [code_lengths(x, LONGEST) for x in (np.concatenate([count, [escapes + 1, ends + 1]]), byte_count + 1)]
        codes = [canonical(x).astype(np.uint32) for x in sizes]
        inner, number = [], 0
        for size in sizes:
            # Canonical codes: of the paths of one length the first are leaves, all others nodes.
            inner.append([])
            first = 0
            for depth, leaves in enumerate(np.bincount(size).tolist()[:-1]):
                node = first + (leaves if depth else 0)
                inner[-1].append(number - node)
                number += (1 << depth) - node
                first = 2 * node
        return Trees(words.cast(pa.large_string()), count, codes[0], sizes[0].astype(np.int64), codes[1], sizes[1].astype(np.int64), inner)


@dataclass
class Symbols:
    """Codes to follow, with the hashes of their contexts, and the tree (0 words, 1 bytes); ``first``: where texts begin."""

    code: np.ndarray
    size: np.ndarray
    tree: np.ndarray
    context: np.ndarray
    first: np.ndarray
    word_ids: np.ndarray
    words: Words
    texts: pa.Array  # of all words


def _before(x: np.ndarray, k: int, place: np.ndarray, start: int) -> np.ndarray:
    out = np.full(len(x), start, x.dtype)
    out[k:] = x[:-k]
    out[place < k] = start
    return out


def symbols_of(trees: Trees, data: np.ndarray, offsets: np.ndarray) -> Symbols:
    w = Words(data, offsets, lower=True)
    texts, vocabulary = len(offsets) - 1, len(trees.words)
    nbytes = w.end - w.start
    strings = _strings(w.data[~w.space], np.concatenate([[0], np.cumsum(nbytes)]))
    ids = np.asarray(pc.index_in(strings, trees.words).fill_null(vocabulary)).astype(np.int64)
    # Tokens: the words of a text, and its end.
    n = len(ids) + texts
    at, end = np.arange(len(ids)) + w.doc, w.first[1:] + np.arange(texts)
    token, name = np.empty(n, np.int64), np.zeros(n, np.uint32)
    token[at], token[end] = ids, vocabulary + 1
    name[at] = w.sums().astype(np.uint32)
    first = w.first[:-1] + np.arange(texts)
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    one = _before(name, 1, place, int(_START))
    # The last token of a text so far that is very common: ids go by frequency.
    seen = np.where(token < COMMON, np.arange(1, n + 1), 0)
    seen = np.concatenate([[0], np.maximum.accumulate(seen)[:-1]])
    common = np.where(seen > np.repeat(first, np.diff(np.append(first, n))), token[np.maximum(seen - 1, 0)], COMMON).astype(np.uint32)
    contexts = [_hash32(common * _M1 + np.uint32(1)), _hash32(one * _M1 + np.uint32(2))]
    # Spelled words: their bytes and a stop follow the escape.
    rare = np.flatnonzero(ids == vocabulary)
    long = nbytes[rare] + 1
    many = np.ones(n, np.int64)
    many[at[rare]] += long
    offset = np.cumsum(many) - many
    total = int(many.sum())
    code, size, tree = np.empty(total, np.uint32), np.empty(total, np.int64), np.ones(total, np.int64)
    context = np.empty((TABLES - 1, total), np.uint32)
    code[offset], size[offset], tree[offset] = trees.word_code[token], trees.word_size[token], 0
    for k in range(TABLES - 1):
        context[k, offset] = contexts[k]
    if len(rare):
        j = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
        spot = np.repeat(offset[at[rare]] + 1, long) + j
        stop = np.cumsum(long) - 1
        letter = np.empty(len(j), np.int64)
        letter[stop] = 256
        inner = np.ones(len(j), bool)
        inner[stop] = False
        letter[inner] = w.data[(np.repeat(w.start[rare], long) + j)[inner]]
        code[spot], size[spot] = trees.byte_code[letter], trees.byte_size[letter]
        back = [_before((letter + 1).astype(np.uint32), k, j, 0) for k in (1, 2, 3, 4, 5)]
        three = _hash32(((back[0] * np.uint32(257) + back[1]) * np.uint32(257) + back[2]) * _M1 + np.uint32(3))
        context[0, spot] = three
        context[1, spot] = _hash32(three + (back[3] * np.uint32(257) + back[4]) * _M3)
    return Symbols(code, size, tree, context, offset[first] if texts else first, ids, w, strings)


def decisions(trees: Trees, s: Symbols, a: int, b: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(gate, symbols, bits, places in each table) of the decisions of symbols a to b, one tree and depth at a time: a gate's
    decisions are plain slices of the symbols in order of the length of their codes."""
    shift = np.uint32(32 - SLOT_BITS)
    for tree in (0, 1):
        rows = a + np.flatnonzero(s.tree[a:b] == tree)
        rows = rows[np.argsort(-s.size[rows], kind="stable")]
        code, size = s.code[rows], s.size[rows]
        contexts = [c[rows] for c in s.context]
        left, many = size.astype(np.uint32), len(rows) - np.cumsum(np.bincount(size, minlength=1))
        for depth in range(int(size[0]) if len(size) else 0):
            k = int(many[depth])
            rest = left[:k] - np.uint32(depth)
            node = code[:k] >> rest
            places = [node.astype(np.int64) + trees.inner[tree][depth]]
            node |= np.uint32(1 << depth)
            node *= _M1
            node ^= _TREE * np.uint32(tree)
            bit = ((code[:k] >> (rest - np.uint32(1))) & np.uint32(1)).astype(np.int32)
            for c in contexts:
                x = c[:k] + node
                x ^= x >> np.uint32(15)
                x *= _M2
                x >>= shift
                places.append(x.astype(np.int64))  # numpy looks up by 64 bits
            yield tree * DEPTHS + min(depth, DEPTHS - 1), rows[:k], bit, places


def blocks(s: Symbols) -> Iterator[tuple[int, int]]:
    for a in range(0, len(s.size), BLOCK):
        yield a, min(a + BLOCK, len(s.size))


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Of pairs (zeros, ones)."""
    ones, zeros = (counts[..., k].astype(np.float32) + np.float32(PRIOR) for k in (1, 0))
    ones /= zeros
    return np.log(ones, out=ones)


def _step(mixed: np.ndarray) -> np.ndarray:
    return np.clip((mixed + np.float32(REACH)) * np.float32(STEPS / (2 * REACH)), 0, STEPS - 1).astype(np.int64)


def _mixed(weights: np.ndarray, told: list[np.ndarray]) -> np.ndarray:
    mixed = weights[0] * told[0]
    for w, t in zip(weights[1:], told[1:], strict=True):
        mixed += w * t
    return mixed


class Learner:
    """What a task learns on line: counts, weights, and tallies of what the mixed log-odds were worth."""

    def __init__(self):
        self.counts = [np.zeros(2 * n, np.int32) for n in SLOTS]
        self.weights = np.full((TABLES, GATES), 0.4, np.float32)
        self.tally = np.zeros((GATES, 2 * STEPS), np.int64)
        self.seen = 0

    def learn(self, trees: Trees, s: Symbols) -> None:
        odds = [log_odds(c.reshape(-1, 2)) for c in self.counts]
        held: list[list[np.ndarray]] = [[] for _ in range(TABLES)]
        for a, b in blocks(s):
            for gate, _, bit, places in decisions(trees, s, a, b):
                told = [o.take(p) for o, p in zip(odds, places, strict=True)]
                weights = self.weights[:, gate]
                mixed = _mixed(weights, told)
                chance = 1 / (1 + np.exp(-np.clip(mixed, -20, 20)))
                wrong = bit.astype(np.float32) - chance
                spread = chance * (1 - chance)
                # 1 / TABLES of the diagonal Newton step of this block: the sum of all tables' steps does not overshoot.
                pull, curve = np.array([(wrong @ t, (spread * t) @ t) for t in told], np.float32).T
                weights += pull / (TABLES * (curve + 50))
                self.tally[gate] += np.bincount(_step(mixed) * 2 + bit, minlength=2 * STEPS)
                for h, p in zip(held, places, strict=True):
                    h.append(p.astype(np.int32) * np.int32(2) + bit)
                self.seen += len(bit)
        for c, h in zip(self.counts, held, strict=True):
            if h:
                c += np.bincount(np.concatenate(h).astype(np.int64), minlength=len(c)).astype(np.int32)

    def pages(self) -> Iterator[pa.RecordBatch]:
        for k, c in enumerate(self.counts):
            parts = c.reshape(-1, 2 * PAGE)
            used = np.flatnonzero(parts.any(axis=1))
            for i in range(0, len(used), 64):
                some = used[i : i + 64]
                yield _page_rows([(k, int(p), zlib.compress(parts[p].tobytes(), 1)) for p in some])
        if self.seen:
            yield _page_rows([(TABLES, 0, zlib.compress((self.weights.astype(float) * self.seen).tobytes() + np.float64(self.seen).tobytes(), 1)), (TABLES, 1, zlib.compress(self.tally.tobytes(), 1))])


PAGES = pa.schema([("part", pa.int32()), ("page", pa.int32()), ("data", pa.binary())])


def _page_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PAGES, strict=True)], schema=PAGES)


def _learned(trees):
    def run(batches):
        learner, size = Learner(), FIRST_BYTES
        for batch in batches:
            column, a = batch.column("text"), 0
            while a < len(column):
                _, b, data, offsets = next(chunks(column.slice(a), size))
                learner.learn(trees.value, symbols_of(trees.value, data, offsets))
                a, size = a + b, min(2 * size, RUN_BYTES)
        yield from learner.pages()

    return run


def _added(batches):
    """Sums of pages, read one by one; counts leave as log-odds, so a task holds the pages it is dealt once each."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for part, page, data in zip(*(batch.column(c) for c in ("part", "page", "data")), strict=True):
            key = part.as_py(), page.as_py()
            kind = np.int32 if key[0] < TABLES else np.float64 if key[1] == 0 else np.int64
            value = np.frombuffer(zlib.decompress(data.as_py()), kind)
            if key in sums:
                sums[key] += value
            else:
                sums[key] = value.astype(np.int64 if kind is np.int32 else kind)
    for key, value in sums.items():
        yield _page_rows([(*key, log_odds(value.reshape(PAGE, 2)).tobytes() if key[0] < TABLES else value.tobytes())])


@dataclass
class Model:
    """Log-odds by table, weights by table and gate, and the cost in bits of each bit by gate and step."""

    odds: list[np.ndarray]
    weights: np.ndarray
    cost: np.ndarray

    @staticmethod
    def of(rows: Iterator) -> Model:
        odds, weights, tally = [np.zeros(n, np.float32) for n in SLOTS], np.full((TABLES, GATES), 0.4, np.float32), np.zeros((GATES, STEPS, 2), np.int64)
        for r in rows:
            if r["part"] < TABLES:
                odds[r["part"]][r["page"] * PAGE : (r["page"] + 1) * PAGE] = np.frombuffer(r["data"], np.float32)
            elif r["page"] == 0:
                x = np.frombuffer(r["data"], np.float64)
                weights = (x[:-1] / x[-1]).reshape(TABLES, GATES).astype(np.float32)
            else:
                tally = np.frombuffer(r["data"], np.int64).reshape(GATES, STEPS, 2)
        middle = (np.arange(STEPS) + 0.5) * (2 * REACH / STEPS) - REACH
        plain = 1 / (1 + np.exp(-middle))
        ones = (tally[:, :, 1] + TRUST * plain) / (tally.sum(axis=2) + TRUST)
        return Model(odds, weights, -np.log2(np.stack([1 - ones, ones], axis=2)).reshape(GATES, 2 * STEPS))

    def bits(self, trees: Trees, s: Symbols) -> np.ndarray:
        """Bits of each text."""
        each = np.zeros(len(s.size))
        for a, b in blocks(s):
            for gate, rows, bit, places in decisions(trees, s, a, b):
                mixed = _mixed(self.weights[:, gate], [o.take(p) for o, p in zip(self.odds, places, strict=True)])
                each[rows] += self.cost[gate].take(_step(mixed) * 2 + bit)
        return np.add.reduceat(each, s.first) if len(s.first) else each


SCORED = pa.schema([("doc_id", pa.int64()), ("sig", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("n_bytes", pa.int64()), ("bits", pa.float64()), ("rare", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))])


def _rare_words(s: Symbols, beyond: int, texts: int) -> tuple[pa.Array, pa.Array]:
    """Of each text the different words beyond the vocabulary, and how often each occurs."""
    at = np.flatnonzero(s.word_ids == beyond)
    table = pa.table({"row": s.words.doc[at], "word": s.texts.take(pa.array(at)), "n": np.ones(len(at), np.int64)})
    table = table.group_by(["row", "word"]).aggregate([("n", "sum")])
    order = np.argsort(table.column("row").to_numpy(), kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    cut = pa.array(np.searchsorted(table.column("row").to_numpy(), np.arange(texts + 1)).astype(np.int32))
    lists = (table.column("word").cast(pa.string()), table.column("n_sum"))
    return tuple(pa.ListArray.from_arrays(cut, x.combine_chunks() if x.num_chunks != 1 else x.chunk(0)) for x in lists)


def _scored(trees, model, ends: int):
    def run(batches):
        t, m = trees.value, model.value
        worth = np.log10(np.append(t.count, 0) + 0.5)
        worth[-1] = 0  # words beyond the vocabulary are looked up
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text"), RUN_BYTES):
                s = symbols_of(t, data, offsets)
                many = np.diff(s.words.first)
                added = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[s.words.first])  # noqa: E731, B023
                known = added((s.word_ids < len(t.words)).astype(np.int64)) + (ends > 0)
                base = added(worth[s.word_ids]) + np.log10(ends + 0.5)
                size = added(s.words.end - s.words.start) + many  # a byte after each word: a space, or the end
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("sig").slice(a, b - a), pa.array(many + 1), pa.array(known), pa.array(base), pa.array(np.maximum(size, 1)), pa.array(m.bits(t, s)), *_rare_words(s, len(t.words), b - a)], schema=SCORED)

    return run


def _word_counts(batches):
    for batch in batches:
        texts = 0
        for a, b, data, offsets in chunks(batch.column("text"), 2 * RUN_BYTES):
            w = Words(data, offsets, lower=True)
            found = _strings(w.data[~w.space], np.concatenate([[0], np.cumsum(w.end - w.start)])).value_counts()
            texts += b - a
            yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1).cast(pa.int64())], names=["word", "n"])
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([texts], pa.int64())], names=["word", "n"])


def _byte_counts(trees):
    def run(batches):
        total = np.zeros(257, np.int64)
        for batch in batches:
            rare = np.asarray(pc.index_in(batch.column("word").cast(pa.large_string()), trees).is_null())
            times = np.asarray(batch.column("n")) * rare
            data, offsets = column_bytes(batch.column("word"))
            total[:256] += np.bincount(data, weights=np.repeat(times, np.diff(offsets)).astype(float), minlength=256).astype(np.int64)
            total[256] += times.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257, dtype=np.int32)), pa.array(total)], names=["byte", "n"])

    return run


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_texts(docs: DataFrame, learns: Column, vocabulary: int = VOCABULARY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Tokens are runs of bytes other than ASCII white space, lower-cased in A-Z, and one end for each text. ``learns`` says which rows
    are training texts. score is the model's log10 probability of the tokens, bits_per_byte the same in bits over the tokens' bytes
    (one more for what ends each). base_score sums log10((c + 0.5) / (N + 0.5 * (V + 1))) over tokens: c the token's count, N
    all (train_tokens), V the distinct ones, in training texts, ends included. n_known counts tokens with c > 0.

    A null or empty text is an end alone. A row with a null doc_id is scored, and learned from only if ``learns`` says so.
    Repeated rows count each time and score alike. Texts of any length are scored whole. Other columns are not read. Without
    training texts the predictors know nothing, and N is 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), learns.alias("learns")).withColumn("sig", F.xxhash64("text", F.lit(6)))
    training = rows.where("learns").select("text")
    counts = Kept(training.mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    release(spark)
    all_of = counts.df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)).alias("ends")).first()
    real = counts.df.where("word is not null")
    top = real.where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "word").limit(vocabulary).toArrow()  # ``vocabulary`` rows at most: the size of the model
    words, count = top.column("word").combine_chunks(), top.column("n").to_numpy()
    found = real.mapInArrow(_byte_counts(words.cast(pa.large_string())), "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()  # 257 rows
    by_byte = np.zeros(257, np.int64)
    for r in found:
        by_byte[r["byte"]] = r["n"]
    trees = spark.sparkContext.broadcast(Trees.of(words, count, int(by_byte[256]), int(all_of["ends"]), by_byte))
    pages = training.mapInArrow(_learned(trees), "part int, page int, data binary").repartition("part", "page").mapInArrow(_added, "part int, page int, data binary")
    kept = Kept(pages, "lm-model")
    release(spark)
    model = spark.sparkContext.broadcast(Model.of(kept.df.toLocalIterator()))  # as many numbers as SLOTS says, whatever the corpus
    kept.drop()
    scored = Kept(rows.select("doc_id", "sig", "text").mapInArrow(_scored(trees, model, int(all_of["ends"])), "doc_id long, sig long, n_tokens long, known long, base double, n_bytes long, bits double, rare array<string>, times array<long>"), "lm-scored")
    rare = scored.df.select("doc_id", "sig", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("doc_id", "sig", F.col("w.rare").alias("word"), F.col("w.times").alias("n"))
    rare = rare.join(real.withColumnRenamed("n", "c"), "word", "left")
    rare = rare.select("doc_id", "sig", (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("more_known"), F.lit(0).alias("copies"))
    # Rows of one doc_id and text each add their words; so each gets its share.
    both = rare.unionByName(scored.df.select("doc_id", "sig", F.lit(0.0).alias("more"), F.lit(0).alias("more_known"), F.lit(1).alias("copies")))
    sums = both.groupBy("doc_id", "sig").agg(F.sum("more").alias("more"), F.sum("more_known").alias("more_known"), F.sum("copies").alias("copies"))
    s = scored.df.drop("rare", "times")
    joined = s.join(sums, s["doc_id"].eqNullSafe(sums["doc_id"]) & (s["sig"] == sums["sig"]))
    bottom = float(np.log10(all_of["tokens"] + 0.5 * (all_of["distinct"] + 1)))
    result = joined.select(
        s["doc_id"],
        "n_tokens",
        (F.col("known") + F.col("more_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(int(all_of["tokens"])).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more") / F.col("copies") - F.col("n_tokens") * bottom).alias("base_score"),
        (-F.col("bits") * float(np.log10(2))).alias("score"),
        (F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )
    out = Kept(result, "lm-result")
    for x in (trees, model):
        x.unpersist()
    for k in (counts, scored):
        k.drop()
    release(spark)
    return out.df
