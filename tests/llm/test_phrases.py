"""Phrase mining against brute force, with nulls, odd white space, ties, repeated rows, an empty table and clashing columns."""

import collections
import random
import re

DOCS = "doc_id long, text string, lang string, n string, rank int"


def brute(rows, least, longest, top, cover):
    count, total = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        count[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in count.items() if len(key[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, g), a in found.items():
        inside = lambda q: any(q[i : i + len(g)] == g for i in range(len(q) - len(g) + 1))
        if any(x == lang and len(q) > len(g) and 100 * f >= cover * a and inside(q) for (x, q), f in found.items()):
            continue
        n = total[lang]
        score, _, l, r = min((1000 * a * n // (count[lang, g[:k]] * count[lang, g[k:]]), k, count[lang, g[:k]], count[lang, g[k:]]) for k in range(1, len(g)))
        out[lang].append((" ".join(g), a, l, r, n, score))
    return {(lang, i, *x) for lang, rows in out.items() for i, x in enumerate(sorted(rows, key=lambda x: (-x[5], -x[1], x[0].encode()))[:top], 1)}


def odd_rows():
    r = random.Random(4)
    words = ["a", "B", "ça", "Éa", "d.", "e", "f!", "gg", "h\n", "\tx", "ÿ", "long" * 40]
    rows = [(i, " ".join(r.choice(words[: 3 + i % 10]) for _ in range(r.randrange(60))) + "  e  gg\te", ["en", "de", None, "und"][i % 4]) for i in range(60)]
    rows += [(60, None, "en"), (61, "", "en"), (62, " .\t.. \n", None), (None, "a b a b a b", "en"), (63, " ".join(r.choice(["a", "b", "c"]) for _ in range(9000)), "en"), (64, "z" * 300_000 + " z", "xx")]
    return rows + [rows[3]] * 12


def test_phrases_against_brute_force(spark):
    from colscope.llm.phrases import mine_phrases

    rows = odd_rows()
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], DOCS).repartition(3)
    for least, longest, top, cover in ((4, 5, 2000, 100), (9, 3, 5, 60), (2, 2, 7, 100)):
        got = mine_phrases(df, least, longest, top, cover)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(x) for x in got.collect()} == brute(rows, least, longest, top, cover)
    assert mine_phrases(df.limit(0)).count() == 0


def test_pieces_collapse_to_multiplicities(spark):
    from colscope.llm.phrases import split_pieces

    import pyarrow as pa

    got = [(int(a + r), p) for a, rows, pieces in split_pieces(pa.array([" The  cat,the\tcat", None, "", "THE CAT.É b "])) for r, p in zip(rows, pieces.to_pylist(), strict=True)]
    assert got == [(0, "the cat"), (0, "the cat"), (3, "the cat"), (3, "É b")]


def test_scores_beyond_64_bits(spark):
    """1000 * a * n and l * r pass 64 bits; the quotient is exact."""
    from pyspark.sql import functions as F

    from colscope.llm.phrases import _scored

    big = 10**13
    grams = spark.createDataFrame([("en", "x y", big + 7), ("en", "x", 3 * big + 1), ("en", "y", 2 * big + 3)], "lang string, gram string, n long")
    totals = spark.createDataFrame([("en", 91 * big)], "lang string, n long")
    got = _scored(grams, totals).select(F.col("score")).first()[0]
    assert got == 1000 * (big + 7) * 91 * big // ((3 * big + 1) * (2 * big + 3))


def test_grams_are_named_in_little_memory():
    """All places of a chunk's grams at once took 24 bytes for each byte of them."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from colscope.llm.phrases import GRAMS, PIECES, _grams

    words = [f"w{k:029d}" for k in range(190_000)]
    pieces = pa.table({"lang": ["en"] * 1_900, "piece": [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)], "n": np.full(1_900, 3)}, schema=PIECES)
    tracemalloc.start()
    got = pa.Table.from_batches(_grams((1,), 0, None)(pieces.to_batches()), GRAMS)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.column("gram").to_pylist() == words and set(got.column("n").to_pylist()) == {3}
    assert most < 80e6
