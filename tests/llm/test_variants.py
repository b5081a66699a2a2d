"""Spelling variants against brute force, with nulls, long words and texts, ties, repeated rows, an empty table and clashing columns."""

import collections
import random
import re
import zlib

import numpy as np

DOCS = "doc_id long, text string, lang string, n string, root int"


def words_of(rows, shortest, least, spoil):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(ch.lower() if ch.isascii() else ch for ch in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spoil and h % spoil == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= shortest and n >= least}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, shortest=6, least=5, factor=5, spoil=None):
    count = words_of(rows, shortest, least, spoil)
    beside = {w: [v for v in count if near(w, v)] for w in count}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= factor * count[w] else None
    out = set()
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, form[w], root, len(beside[w]), count[form[w]] if form[w] else None))
    return out


def odd_rows(seed=3):
    r = random.Random(seed)
    base = ["banana", "aaaaaa", "aaaaaaa", "Ananas", "élève×", "ÉLÈVES", "abcdefghij", "mississippi", "ininin", "q" * 300, "straße", "ab÷cdéf"]
    bad = lambda w: "".join(r.choice([ch, ch, ch, ch, ch, ch, ch, "", ch + r.choice("abé"), r.choice("abñ")]) for ch in w)
    known = base + [bad(w) for w in base for _ in range(12)] + ["".join(r.choice("ab") for _ in range(r.randrange(6, 9))) for _ in range(60)]
    pick = lambda n: " ".join(r.choice(known[: r.choice([3, 12, 80, len(known)])]) + r.choice(["", ".", "1", "-"]) for _ in range(n))
    rows = [(i, pick(r.randrange(80))) for i in range(60)] + [(60, None), (61, ""), (62, " 12 ÿ"), (None, pick(50)), (63, pick(6000)), (64, "ab" * 40_000 + " " + "ab" * 40_000 + "b")]
    return rows + [rows[5]] * 7 + [(64, rows[-1][1])] * 5


def test_variants_against_brute_force(spark):
    from colscope.llm.variants import group_variants

    rows = odd_rows()
    df = spark.createDataFrame([(*x, "en", "clash", 1) for x in rows], DOCS).repartition(3)
    for args in ({"spoil": 7}, {"shortest": 7, "least": 2, "factor": 2}, {"unit": 6, "spoil": 199}):
        got = group_variants(df, **args)
        assert got.columns == ["word", "n", "form", "root", "n_near", "form_n"]
        assert {tuple(x) for x in got.collect()} == brute(rows, **{k: v for k, v in args.items() if k != "unit"})
    assert group_variants(df.limit(0)).count() == 0


def test_checksums_of_spans():
    from colscope.llm.variants import crc32_of

    data = np.frombuffer("hällo world".encode(), np.uint8)
    start, size = np.array([0, 3, 7, 2]), np.array([6, 0, 5, 9])
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in range(4)], np.uint32)
    want = [zlib.crc32(f"{i}:".encode() + data[a : a + n].tobytes()) for i, (a, n) in enumerate(zip(start, size, strict=True))]
    assert crc32_of(prefix, data, start, size).tolist() == want
