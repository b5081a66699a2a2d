"""Phrase collocations: which runs of words occur together far more often than their parts would by chance.

1. Texts are cut into pieces; identical pieces of a language collapse to one row with a multiplicity.
2. N-grams are counted with these weights, in three passes: words, pairs, longer ones. A task pre-aggregates what it reads (words
   and grams are named by exact codes within a chunk of text), Spark deals the sums to hash buckets by (lang, gram), and each
   bucket is counted by DuckDB, which spills to disk beyond ``BUCKET_MEMORY``. A gram is counted only where all its words (pairs)
   may be frequent, by a broadcast filter of at most 128 MB: as no part is rarer than the whole, nothing is lost.
3. Every cut of a candidate sends a lookup request for each of its two parts to where the part's count lies, and the answers
   meet by candidate. Parts that many candidates share are split by adaptive execution, as both sides are plain shuffles.
4. Candidates inside an equally frequent longer one go; the rest is ranked in two steps, by language and salt, then by language.
"""

from __future__ import annotations

import contextlib
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, U64, Kept, Words, chunks, column_bytes, mix, release, run_chains, ship, shuffle_partitions, span_chains, span_sums
from .substring import _filter, _may_hold

#: Bytes that end a piece: . , ; : ! ? and line breaks.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
#: Bytes of pieces that are named together; more is fewer rows to shuffle, and more memory.
NAMED_BYTES = 6_000_000
#: Rows of sums that a task holds back to add them up.
HELD_ROWS = 2_500_000
#: Bytes of grams whose places are named at once (eight bytes for each, three times), and rows of a batch that leaves a task.
SPAN_BYTES, SENT_ROWS = 1_000_000, 100_000
#: Memory of one bucket's counts before DuckDB spills.
BUCKET_MEMORY = "256MB"

PIECES = pa.schema([("lang", pa.string()), ("piece", pa.string()), ("n", pa.int64())])
GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _spans(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The spans of ``size`` bytes from ``start`` on as strings, gathered a block at a time."""
    ends = np.concatenate([[0], np.cumsum(size)])
    text, i = np.empty(ends[-1], np.uint8), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SPAN_BYTES, side="right")) - 1)
        text[ends[i] : ends[j]] = data[np.arange(ends[i], ends[j]) + np.repeat(start[i:j] - ends[i:j], size[i:j])]
        i = j
    return _strings(text, ends)


def _summed(table: pa.Table, by: list[str], schema: pa.Schema) -> pa.Table:
    # By one thread: each has a table of its own otherwise.
    return table.group_by(by, use_threads=False).aggregate([("n", "sum")]).rename_columns([*by, "n"]).select(schema.names).cast(schema)


def split_pieces(column) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(first row, row of each piece, pieces) for runs of rows: words lower-cased in A-Z, joined by one space; no empty pieces."""
    for a, _, data, offsets in chunks(column, 4_000_000):
        ends = _ENDS[data]
        gap = ends | (data == 32) | (data == 9)
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:] = gap[:-1] | cut[1:-1]
        after[:-1] = gap[1:] | cut[1:-1]
        start, end = np.flatnonzero(before & ~gap), np.flatnonzero(after & ~gap) + 1
        if not len(start):
            continue
        row = np.searchsorted(offsets, start, side="right") - 1
        part = np.cumsum(ends)[start]
        new = np.ones(len(start), bool)
        new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
        keep = ~gap
        joined = end[:-1][~new[1:]]  # the byte after a word that another of its piece follows
        keep[joined] = True
        plain = _LOWER[data]
        plain[joined] = 32
        place = np.concatenate([[0], np.cumsum(keep)])
        first = start[new]
        yield a, row[new], _strings(plain[keep], np.append(place[first], place[-1]))


def _pieces(batches):
    for batch in batches:
        langs = batch.column("lang")
        for a, row, pieces in split_pieces(batch.column("text")):
            yield from _summed(pa.table({"lang": langs.take(pa.array(a + row)), "piece": pieces, "n": np.ones(len(row), np.int64)}), ["lang", "piece"], PIECES).to_batches()


def _lang_hash(langs: list[str]) -> np.ndarray:
    data, offsets = column_bytes(pa.array(langs, pa.string()))
    return span_chains(data, offsets[:-1], offsets[1:])


def gram_keys(langs: pa.Array, grams: pa.Array) -> np.ndarray:
    """A 64-bit name of each (lang, gram), for filters only: counts go by the texts."""
    coded = langs.dictionary_encode() if not isinstance(langs, pa.DictionaryArray) else langs
    data, offsets = column_bytes(grams)
    w = Words(data, offsets)
    return mix(run_chains(w.sums(), w.first[:-1], w.first[1:]) ^ _lang_hash(coded.dictionary.to_pylist())[np.asarray(coded.indices)])


def _gathered(batches, size: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _grams(orders: tuple[int, ...], known: int, bits):
    """Weighted grams of the given orders in a task's pieces; those of more than ``known`` words only where all their runs of
    ``known`` words are in the filter. Sums of successive chunks are added up before they leave."""
    chunk = _chunk_grams(orders, known, bits)

    def run(batches):
        held, rows = [], 0
        for out in chunk(batches):
            held.append(out)
            rows += out.num_rows
            if rows > HELD_ROWS:
                held = [_summed(pa.concat_tables(held), ["lang", "gram"], GRAMS)]
                if held[0].num_rows > HELD_ROWS // 2:
                    yield from held[0].to_batches(SENT_ROWS)
                    held = []
                rows = sum(t.num_rows for t in held)
        if held:
            yield from (_summed(pa.concat_tables(held), ["lang", "gram"], GRAMS) if len(held) > 1 else held[0]).to_batches(SENT_ROWS)

    return run


def _chunk_grams(orders: tuple[int, ...], known: int, bits):
    def run(batches):
        for table in _gathered(batches, NAMED_BYTES):
            coded = table.column("lang").combine_chunks().dictionary_encode()
            coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
            langs, lang_of = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
            times = np.asarray(table.column("n").combine_chunks())
            data, offsets = column_bytes(table.column("piece"))
            w = Words(data, offsets)
            n = len(w.start)
            if not n:
                continue
            size = w.end - w.start
            codes = _strings(data[~w.space], np.concatenate([[0], np.cumsum(size)])).dictionary_encode()
            words, code = codes.dictionary, np.asarray(codes.indices).astype(np.int64)
            v = len(words)
            many, until = times[w.doc], w.first[1:][w.doc]
            at = np.arange(n)
            name = pd.factorize(lang_of[w.doc] * v + code)[0]
            flagged = None
            if known:
                hashed = np.zeros(0, U64) if not v else _word_sums(words)[code]
            for order in range(1, max(orders) + 1):
                if order > 1:
                    at = at[at + order <= until[at]]
                    if order > known:
                        at = at[flagged[at + order - known]]
                    if not len(at):
                        break
                    whole = np.full(n, -1, np.int64)
                    whole[at] = pd.factorize(name[at] * v + code[at + order - 1])[0]
                    name = whole
                if order == known or order in orders:
                    names = name[at]
                    seen = np.empty(int(names.max()) + 1, np.int64)
                    seen[names[::-1]] = at[::-1]
                if order == known:
                    key = mix(run_chains(hashed, seen, seen + order) ^ _lang_hash(langs.to_pylist())[lang_of[w.doc[seen]]])
                    flagged = np.zeros(n, bool)
                    flagged[at] = _may_hold(bits.value, key)[names]
                    at = at[flagged[at]]
                if order in orders:
                    count = np.bincount(names, weights=many[at].astype(float)).astype(np.int64)
                    grams = _spans(data, w.start[seen], w.end[seen + order - 1] - w.start[seen])
                    yield pa.table({"lang": langs.take(pa.array(lang_of[w.doc[seen]])), "gram": grams, "n": count}).cast(GRAMS)

    return run


def _word_sums(words: pa.Array) -> np.ndarray:
    data, offsets = column_bytes(words)
    return span_sums(data, offsets[:-1], offsets[1:])


def _counted(least: int):
    """The sums of a bucket by DuckDB, out of core; rows of at least ``least``, and the sum of all, by language, under a null gram."""

    def run(batches):
        import duckdb

        folder = tempfile.mkdtemp(prefix="colscope-bucket-")
        try:
            con = duckdb.connect(config={"threads": "1", "memory_limit": BUCKET_MEMORY, "temp_directory": folder, "preserve_insertion_order": "false"})
            sums = pa.RecordBatchReader.from_batches(GRAMS, iter(batches))  # noqa: F841 (DuckDB reads it by its name)
            con.execute("CREATE TEMP TABLE t AS SELECT lang, gram, CAST(sum(n) AS BIGINT) AS n FROM sums GROUP BY lang, gram")
            for batch in con.sql(f"SELECT lang, gram, n FROM t WHERE n >= {int(least)} UNION ALL SELECT lang, NULL, CAST(sum(n) AS BIGINT) FROM t GROUP BY lang").to_arrow_reader(50_000):
                yield from pa.Table.from_batches([batch]).cast(GRAMS).to_batches()
            con.close()
        finally:
            with contextlib.suppress(OSError):
                shutil.rmtree(folder)

    return run


def _keyed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(gram_keys(batch.column("lang"), batch.column("gram")).astype(np.int64))], names=["key"])


def frequent_grams(pieces: DataFrame, least: int, longest: int) -> tuple[list[Kept], DataFrame]:
    """Tables (lang, gram, n) of the grams of 1, 2, and more words that occur at least ``least`` times, and (lang, total words)."""
    kept: list[Kept] = []
    bits = None
    for orders in ((1,), (2,), tuple(range(3, longest + 1))):
        if not orders:
            break
        known = len(kept)
        sums = pieces.mapInArrow(_grams(orders, known, bits), "lang string, gram string, n long")
        # Buckets by hash: what AQE joins are whole buckets.
        kept.append(Kept(sums.repartition("lang", "gram").mapInArrow(_counted(least), "lang string, gram string, n long"), f"phrases-{orders[0]}"))
        if bits is not None:
            bits.unpersist()
        release(pieces.sparkSession)
        if len(kept) < 3:
            keys = kept[-1].df.where("gram is not null")
            bits = _filter(keys.mapInArrow(_keyed, "key long"), keys.count())
    totals = kept[0].df.where("gram is null").groupBy("lang").agg(F.sum("n").alias("n"))
    return kept, totals


def _scored(grams: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases of two words or more, by the cut that scores least."""
    words = F.split("gram", " ")
    phrases = grams.where(F.contains("gram", F.lit(" "))).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), words.alias("words"))
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    left = F.array_join(F.slice("words", 1, F.col("cut")), " ")
    right = F.array_join(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")), " ")
    requests = cuts.select("lang", "phrase", "a", F.explode(F.array(F.struct(left.alias("gram"), F.col("cut").alias("cut"), F.lit(True).alias("first")), F.struct(right.alias("gram"), F.col("cut").alias("cut"), F.lit(False).alias("first")))).alias("q")).select("lang", "phrase", "a", "q.*")
    answers = requests.join(grams, ["lang", "gram"]).groupBy("lang", "phrase", "cut").agg(F.max("a").alias("a"), F.max(F.when(F.col("first"), F.col("n"))).alias("l"), F.max(F.when(~F.col("first"), F.col("n"))).alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    answers = answers.join(totals, "lang").withColumns({"over": wide("a") * (F.lit(1000).cast("decimal(19,0)") * F.col("n")).cast("decimal(19,0)"), "under": wide("l") * wide("r")})
    answers = answers.withColumn("score", F.expr("cast(over as decimal(38,0)) div cast(under as decimal(38,0))"))
    best = answers.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def mine_phrases(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, cover: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` collocations of 2 to ``longest`` words.

    ``docs`` has text and lang. Words are runs of bytes other than space and tab inside pieces, lower-cased in A-Z; pieces end at
    ``.,;:!?`` and line breaks. n: all words of the language; a: occurrences of the phrase, at least ``least``; l, r: those of the two
    parts of the cut with the least score floor(1000*a*n/(l*r)), the earliest of equals. A phrase inside a longer one of at least
    ``cover`` percent of its occurrences goes, whether or not that one goes too. Order: score and a descending, phrase in byte order.

    A null text has no words, a null lang is ``und``; repeated rows count each time. Texts of any length are read whole. Other columns
    are not read. Counts are integers below 2**53 in a task, products decimals of 38 digits; more raises an error. No rows give none.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = Kept(rows.mapInArrow(_pieces, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")), "phrases-pieces")
    release(spark)
    kept, totals = frequent_grams(pieces.df, least, longest)
    pieces.drop()
    grams = kept[0].df
    for k in kept[1:]:
        grams = grams.unionByName(k.df)
    grams = grams.where("gram is not null")
    scored = Kept(_scored(grams, totals), "phrases-scored")
    # A phrase of one word less than a candidate, at either end of it. A longer one covers whatever lies deeper only if these do.
    longer = scored.df.select("lang", "a", F.split("phrase", " ").alias("words")).where(F.size("words") > 2)
    ends = F.array(F.array_join(F.slice("words", 1, F.size("words") - 1), " "), F.array_join(F.slice("words", 2, F.size("words") - 1), " "))
    around = longer.select("lang", F.explode(ends).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = scored.df.join(around, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < cover * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(spark)))
    first = left.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    out = Kept(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    for k in (*kept, scored):
        k.drop()
    return out.df
