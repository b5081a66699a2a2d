"""Spelling variants: words one edit apart, and the frequent form that each rare one stands for.

1. Tasks cut texts into runs of letters and send sums by word; words that are long and frequent enough are kept.
2. Each word has its trigrams with their positions. One edit spoils three of them at most, so two near words share one of the four
   trigrams of each that are rarest in all words (ties by position), at one place or shifted by one. Those four are
   the word's keys (length, trigram, position); a word also looks among those one letter shorter, at both places.
3. Words of a key meet in a bucket. There all positional trigrams make an inverted index; posting lists are merged (sorted
   together) under the limits of length and position, and pairs in fewer lists than one edit leaves are dropped. The rest is
   verified letter by letter. A pair that meets under several keys counts under the least one.
4. Keys of more than ``unit`` words are cut into blocks, and each pair of blocks is a unit of its own, so no key is one task's.
5. Forms are chains of words at least so many times more frequent each; roots follow by doubling.

Letters are U+0041 to U+00FF, so a word is held in one byte a letter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, U64, Kept, chunks, mix, release, ship

#: Trigrams that one edit spoils at most; one more is looked up.
SPOILED = 3
#: Letters a-z and U+00C0 to U+00FF, and all trigrams of them.
ALPHABET = 26 + 64
TRIGRAMS = ALPHABET**3
#: Rows of a bucket, and pairs that a task merges at a time.
BUCKET_ROWS, MERGED = 60_000, 3_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CODE = np.zeros(256, np.int32)
_CODE[97:123] = np.arange(26)
_CODE[0xC0:] = np.arange(26, ALPHABET)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def crc32_of(prefix: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """zlib.crc32 of spans of bytes, each continued from a checksum."""
    order = np.argsort(-size, kind="stable")
    state, begin, ranked = ~prefix[order].astype(np.uint32), start[order], -size[order]
    for nth in range(int(size.max(initial=0))):
        k = int(np.searchsorted(ranked, -nth))
        part = state[:k]
        state[:k] = _CRC[(part ^ data[begin[:k] + nth]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out = np.empty(len(size), np.uint32)
    out[order] = ~state
    return out


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def letter_runs(ids: list[str], column, shortest: int, spoil: int | None) -> Iterator[pa.Array]:
    """Runs of letters of at least ``shortest``, A-Z lower-cased, a byte a letter, for parts of a column of texts."""
    for a, b, data, offsets in chunks(column, 4_000_000):
        lead = data == 0xC3  # of U+00C0 to U+00FF
        letter = _LETTER[data] | lead
        letter[1:] |= lead[:-1]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before, after = letter.copy(), letter.copy()
        before[1:] &= ~letter[:-1] | cut[1:-1]
        after[:-1] &= ~letter[1:] | cut[1:-1]
        start, end = np.flatnonzero(before), np.flatnonzero(after) + 1
        leads = np.concatenate([[0], np.cumsum(lead)])
        size = end - start - (leads[end] - leads[start])
        long = size >= shortest
        start, end, size = start[long], end[long], size[long]
        if not len(start):
            continue
        low = _LOWER[data]
        keep = np.zeros(len(data) + 1, np.int8)
        keep[start] += 1
        keep[end] -= 1
        keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool) & ~lead
        plain = low.copy()
        plain[1:][lead[:-1]] += 0x40
        if spoil:
            doc = np.searchsorted(offsets, start, side="right") - 1
            prefix = np.array([zlib.crc32(f"{x}:".encode()) for x in ids[a:b]], np.uint32)[doc]
            h = crc32_of(prefix, low, start, end - start)
            hit = np.flatnonzero(h % np.uint32(spoil) == 0)
            if len(hit):
                place = np.concatenate([[0], np.cumsum(keep)])
                kept = np.flatnonzero(keep)
                keep[kept[place[start[hit]] + (h[hit] % size[hit].astype(np.uint32)).astype(np.int64)]] = False
                size[hit] -= 1
        words = _binaries(plain[keep], np.concatenate([[0], np.cumsum(size)]))
        yield words.filter(pa.array(size >= shortest)) if spoil else words


def _words(shortest: int, spoil: int | None):
    def run(batches):
        for batch in batches:
            ids = ["" if x is None else x for x in batch.column("id").to_pylist()]
            for words in letter_runs(ids, batch.column("text"), shortest, spoil):
                counts = words.value_counts()
                yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.binary()), counts.field(1).cast(pa.int64())], names=["word", "n"])

    return run


# ---------------------------------------------------------------- keys


class Letters:
    """Words as codes of letters: of word i those from first[i] to first[i + 1]."""

    def __init__(self, words: pa.Array):
        words = words.cast(pa.large_binary())
        n = len(words)
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = words.buffers()[2] if n else None
        self.code = _CODE[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw is not None else np.zeros(0, np.int32)
        self.first = offsets - offsets[0]
        self.size = np.diff(self.first)
        # The word, place and code of each trigram; words have three letters at least.
        many = self.size - 2
        self.begin = np.concatenate([[0], np.cumsum(many)])
        self.word = np.repeat(np.arange(n), many)
        self.place = np.arange(len(self.word)) - self.begin[:-1][self.word]
        at = self.first[:-1][self.word] + self.place
        c = self.code
        self.gram = (c[at] * ALPHABET + c[at + 1]) * ALPHABET + c[at + 2] if len(at) else np.zeros(0, np.int32)

    def rarest(self, rank: np.ndarray) -> np.ndarray:
        """Numbers of the trigrams by which words are found: of each word the ``SPOILED`` + 1 that are rarest, or all."""
        order = np.lexsort((self.place, rank[self.gram], self.word))
        return order[np.arange(len(order)) - self.begin[:-1][self.word] <= SPOILED]


def _key(size: np.ndarray, gram: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(size.astype(U64) * U64(0x9FB21C651E98DF25) + gram.astype(U64) * U64(0xD6E8FEB86659FD93) + place.astype(U64)).astype(np.int64)


def _lookups(letters: Letters, rank: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, role): role 0 for a word's own keys, 1 for those under which it looks for words one letter shorter."""
    best = letters.rarest(rank)
    word, gram, place = letters.word[best], letters.gram[best], letters.place[best]
    size = letters.size[word]
    same = size > shortest
    here, back = same & (place < size - 3), same & (place > 0)
    words = np.concatenate([word, word[here], word[back]])
    keys = np.concatenate([_key(size, gram, place), _key(size[here] - 1, gram[here], place[here]), _key(size[back] - 1, gram[back], place[back] - 1)])
    roles = np.concatenate([np.zeros(len(word), np.int8), np.ones(int(here.sum() + back.sum()), np.int8)])
    order = np.lexsort((keys, roles, words))
    words, keys, roles = words[order], keys[order], roles[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (keys[1:] != keys[:-1]) | (roles[1:] != roles[:-1])
    return words[new], keys[new], roles[new]


def _gram_counts(batches):
    total = np.zeros(TRIGRAMS, np.int64)
    for batch in batches:
        total += np.bincount(Letters(batch.column("word")).gram, minlength=TRIGRAMS)
    gram = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int32)), pa.array(total[gram])], names=["gram", "n"])


def _keyed(rank, shortest: int):
    def run(batches):
        for batch in batches:
            word, key, role = _lookups(Letters(batch.column("word")), rank.value, shortest)
            at = pa.array(word)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(role.astype(np.int32)), batch.column("word").take(at), batch.column("n").take(at)], names=["key", "role", "word", "n"])

    return run


# ---------------------------------------------------------------- pairs


def _spread(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nth, value): for each n the integers from first[n] on, ``many[n]`` of them."""
    nth = np.repeat(np.arange(len(many)), many)
    return nth, np.arange(len(nth)) - np.repeat(np.cumsum(many) - many, many) + first[nth]


def merged_pairs(letters: Letters, segment: np.ndarray, role: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one segment that share enough positional trigrams, the first of role 0, by merging posting lists.

    A row of role 1 is a letter longer than those of role 0 and stands in the lists of both places. Rows of ``side`` 1 and 2
    meet only those of the other side. Segments come in order.
    """
    own, far = np.flatnonzero(role[letters.word] == 0), np.flatnonzero(role[letters.word] == 1)
    entry = np.concatenate([own, far, far])
    place = np.concatenate([letters.place[own], letters.place[far], letters.place[far] - 1])
    row = letters.word[entry]
    list_of = (place.astype(np.int64) + 1) * TRIGRAMS + letters.gram[entry]
    order = np.lexsort((row, role[row], list_of, segment[row]))
    row, list_of = row[order], list_of[order]
    n = len(row)
    if not n:
        return
    new = np.ones(n, bool)
    new[1:] = (list_of[1:] != list_of[:-1]) | (segment[row[1:]] != segment[row[:-1]])
    until = np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
    many = np.where(role[row] == 0, until - np.arange(n) - 1, 0)
    # Parts of whole segments; a part's pairs are counted together.
    sums = np.concatenate([[0], np.cumsum(many)])
    starts = np.append(np.flatnonzero(np.concatenate([[True], segment[row[1:]] != segment[row[:-1]]])), n)
    a = 0
    while a < len(starts) - 1:
        b = max(a + 1, int(np.searchsorted(sums[starts], sums[starts[a]] + MERGED, side="right")) - 1)
        lo, hi = starts[a], starts[b]
        a = b
        if sums[hi] == sums[lo]:
            continue
        nth, other = _spread(np.arange(lo + 1, hi + 1), many[lo:hi])
        x, y = row[lo + nth], row[other]
        if side.any():
            apart = (side[x] == 0) | (side[x] != side[y])
            x, y = x[apart], y[apart]
        pair = np.sort(x * len(segment) + y)
        if not len(pair):
            continue
        at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        shared = np.diff(np.append(at, len(pair)))
        x, y = np.divmod(pair[at], len(segment))
        enough = (x != y) & (shared >= np.maximum(letters.size[x], letters.size[y]) - 2 - SPOILED)
        yield x[enough], y[enough]


def one_edit(letters: Letters, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the words of two rows, the second as long or a letter longer, differ by exactly one edit."""
    out = np.zeros(len(x), bool)
    short, more = letters.size[x], letters.size[y] - letters.size[x]
    for size in np.unique(short):
        for extra in (0, 1):
            rows = np.flatnonzero((short == size) & (more == extra))
            step = max(1, MERGED // int(size))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                a = letters.code[letters.first[x[part]][:, None] + np.arange(size)]
                b = letters.code[letters.first[y[part]][:, None] + np.arange(size + extra)]
                same = a == b[:, :size]
                if extra:
                    ahead = a == b[:, 1:]
                    head = np.where(same.all(axis=1), size, (~same).argmax(axis=1))
                    tail = np.where(ahead.all(axis=1), size, (~ahead[:, ::-1]).argmax(axis=1))
                    out[part] = head + tail >= size
                else:
                    out[part] = (~same).sum(axis=1) == 1
    return out


def _least_key(letters: Letters, rank: np.ndarray, shortest: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least key under which both words of a pair meet: an own one of the first, and one of the second for that length."""
    word, key, role = _lookups(letters, rank, shortest)
    first = np.searchsorted(word * 2 + role, np.arange(2 * len(letters.size) + 1))
    own = lambda r: (first[2 * r], first[2 * r + 1] - first[2 * r])
    side = 2 * y + (letters.size[y] > letters.size[x])
    n1, k1 = _spread(*own(x))
    n2, k2 = _spread(first[side], first[side + 1] - first[side])
    pair, keys = np.concatenate([n1, n2]), np.concatenate([key[k1], key[k2]])
    order = np.lexsort((keys, pair))
    pair, keys = pair[order], keys[order]
    twice = np.flatnonzero((pair[1:] == pair[:-1]) & (keys[1:] == keys[:-1]))
    out = np.full(len(x), np.iinfo(np.int64).max)
    np.minimum.at(out, pair[twice], keys[twice])
    return out


NEAR = pa.schema([("word", pa.binary()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.binary())])


def _near(rank, shortest: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        key, role, side = (table.column(c).to_numpy() for c in ("key", "role", "side"))
        coded = table.column("word").combine_chunks().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        name, times = np.asarray(coded.indices).astype(np.int64), table.column("n").to_numpy()
        letters, distinct = Letters(table.column("word").combine_chunks()), Letters(coded.dictionary)
        times_of = np.zeros(len(coded.dictionary), np.int64)
        times_of[name] = times
        segment = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(key) else key
        found = [np.zeros((2, 0), np.int64)]
        for x, y in merged_pairs(letters, segment, role, side):
            ok = one_edit(letters, x, y)
            x, y = x[ok], y[ok]
            if len(x):
                here = _least_key(distinct, rank.value, shortest, name[x], name[y]) == key[x]
                found.append(np.stack([name[x[here]], name[y[here]]]))
        one, two = np.concatenate(found, axis=1)
        word, near = np.concatenate([one, two]), np.concatenate([two, one])
        text = np.argsort(np.asarray(pa.compute.rank(coded.dictionary)))  # by bytes, that is by code points
        place = np.empty(len(text), np.int64)
        place[text] = np.arange(len(text))
        order = np.lexsort((place[near], -times_of[near], word))
        word, near = word[order], near[order]
        head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
        take = lambda rows: coded.dictionary.take(pa.array(rows)).cast(pa.binary())
        return pa.table([take(word[head]), pa.array(np.diff(np.append(head, len(word)))), pa.array(times_of[near[head]]), take(near[head])], schema=NEAR)

    return run


def _in_units(keyed: Kept, unit: int) -> DataFrame:
    """(bucket, key, role, side, word, n): rows dealt to buckets by key; a key of more than ``unit`` rows in pairs of blocks."""
    spark = keyed.df.sparkSession
    stats = keyed.df.groupBy("key").agg(F.count("*").alias("rows"))
    large = Kept(stats.where(F.col("rows") > unit), "variants-large")
    buckets = max(1, -(-keyed.df.count() // BUCKET_ROWS))
    dealt = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).alias("bucket")
    if not large.df.limit(1).count():
        return keyed.df.select(dealt("key"), "key", "role", F.lit(0).alias("side"), "word", "n")
    rows = keyed.df.join(large.df, "key", "left")
    small = rows.where("rows is null").select(dealt("key"), "key", "role", F.lit(0).alias("side"), "word", "n")
    blocks = F.ceil(F.col("rows") / (unit // 2)).cast("int")
    split = rows.where("rows is not null").withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("word"), blocks).cast("int")})
    split = split.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2)
    # Two units of a key in one bucket would let their blocks meet twice, so a unit is its own bucket.
    both = F.concat_ws(":", F.col("key").cast("string"), F.least("block", "with").cast("string"), F.greatest("block", "with").cast("string"))
    return small.withColumn("bucket", F.col("bucket").cast("string")).unionByName(split.select(both.alias("bucket"), "key", "role", side.alias("side"), "word", "n"))


def _roots(forms: DataFrame) -> Kept:
    """(word, root) of words with a form (word, form): the last word that forms lead to, by doubling."""
    now = Kept(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = now.df.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = Kept(now.df.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "variants-roots")
        now.drop()
        now = step
        if not now.df.where("moved").limit(1).count():
            return now


def group_variants(docs: DataFrame, shortest: int = 6, least: int = 5, factor: int = 5, spoil: int | None = None, unit: int = 8192) -> DataFrame:
    """(word, n, form, root, n_near, form_n): the words of ``docs`` (doc_id, text), and what each is a variant of.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are lower-cased, of at least ``shortest`` letters and
    ``least`` occurrences (n). n_near counts the words that differ by one inserted, deleted or replaced letter. form is the near
    word of largest n (the smallest in code points of equals) if its n is at least ``factor`` times the word's, else null; form_n
    its n; root is where forms lead in the end, or the word itself. With ``spoil`` a run of a text whose crc32 of
    ``<doc_id>:<run>`` that divides loses the letter at that crc32 modulo its length, before all else.

    A null text has no words, a null doc_id is an empty one; repeated rows count each time. Words and texts of any length are
    handled whole. Other columns are not read. No rows give none.
    """
    spark = docs.sparkSession
    ship(spark)
    if shortest < SPOILED + 3:
        raise ValueError(f"words of less than {SPOILED + 3} letters may share no trigram with a near one")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_words(shortest, spoil), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = Kept(counted, "variants-words")
    release(spark)
    sums = words.df.mapInArrow(_gram_counts, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # TRIGRAMS rows at most
    count = np.zeros(TRIGRAMS, np.int64)
    count[sums.column("gram").to_numpy()] = sums.column("n").to_numpy()
    rank = np.empty(TRIGRAMS, np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(TRIGRAMS)
    shared = spark.sparkContext.broadcast(rank)
    keyed = Kept(words.df.mapInArrow(_keyed(shared, shortest), "key long, role int, word binary, n long"), "variants-keys")
    pairs = _in_units(keyed, unit).groupBy("bucket").applyInArrow(_near(shared, shortest), "word binary, n_near long, best_n long, best binary")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    out = words.df.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("b.n") >= factor * F.col("n"), F.col("b")).alias("f"))
    formed = Kept(out.select("word", "n", F.col("f.word").alias("form"), "n_near", (-F.col("f.n")).alias("form_n")), "variants-formed")
    keyed.drop()
    words.drop()
    release(spark)
    roots = _roots(formed.df.where("form is not null").select("word", "form"))
    text = lambda c: F.decode(F.col(c), "ISO-8859-1")
    result = formed.df.join(roots.df, "word", "left").select(text("word").alias("word"), "n", text("form").alias("form"), text("root").alias("root"), "n_near", "form_n")
    result = Kept(result.withColumn("root", F.coalesce("root", "word")), "variants")
    formed.drop()
    roots.drop()
    return result.df
