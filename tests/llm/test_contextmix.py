"""Scoring by context mixing: base scores against brute force, probabilities that add up, held-out texts, odd tables."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, score string, n_tokens int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall("".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")) + [None]


def base_of(rows, learns):
    count = collections.Counter(t for i, text in rows if learns(i) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    out = []
    for i, text in rows:
        ts = tokens(text)
        out.append((i, len(ts), sum(count[t] > 0 for t in ts), n, round(sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), 6)))
    return out


def odd_rows():
    r = random.Random(8)
    known = [f"w{i}" for i in range(30)] + ["The", "the", "Éa", "x" * 50, "é b"]
    pick = lambda n: " ".join(r.choice(known if r.random() < 0.9 else [f"rare{r.randrange(400)}"]) + r.choice(["", "\t", "\n "]) for _ in range(n))
    rows = [(i, pick(r.randrange(50))) for i in range(80)] + [(80, None), (81, ""), (82, " \n"), (None, pick(9)), (83, pick(9000)), (84, "z" * 200_000)]
    return rows + [rows[4]] * 6 + [(5, "another text of a repeated id rare1 rare1")]


def test_scores_against_brute_force(spark):
    from colscope.llm.contextmix import in_fold, score_texts

    rows = odd_rows()
    df = spark.createDataFrame([(*x, "en", "clash", 1) for x in rows], DOCS).repartition(3)
    in_training = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    for vocabulary in (10, 1000):
        got = score_texts(df, ~in_fold(F.col("doc_id"), 5, 1), vocabulary)
        assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
        found = got.collect()
        shown = sorted((x.doc_id or -1, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in found)
        want = sorted((i or -1, *x) for i, *x in base_of(rows, in_training))
        assert [x[:4] for x in shown] == [x[:4] for x in want]
        assert all(math.isclose(a[4], b[4], abs_tol=1e-4) for a, b in zip(shown, want, strict=True))
        assert all(x.score < 0 and math.isclose(-x.score / math.log10(2) / x.bits_per_byte, sum(len(t.encode()) + 1 for t in tokens(dict(rows)[x.doc_id])[:-1]) or 1, rel_tol=1e-6) for x in found if x.doc_id != 5)
        assert len({x.score for x in found if x.doc_id == 4}) == 1
    assert score_texts(df.limit(0), F.lit(True)).count() == 0
    none = score_texts(df, F.lit(False)).collect()
    assert {x.train_tokens for x in none} == {0} and {x.n_known for x in none} == {0}


def small_model():
    from colscope.llm.contextmix import Learner, Model, Trees, _added, symbols_of
    from colscope.llm.common import column_bytes

    r = random.Random(1)
    text = " ".join(r.choice(["the cat", "a dog", "the dog sat", "on", "mat"]) for _ in range(4000))
    count = collections.Counter(text.split())
    words = sorted(count, key=lambda w: (-count[w], w))[:4]
    spelled = np.bincount([b for w in text.split() if w not in words for b in w.encode()], minlength=257)
    trees = Trees.of(pa.array(words), np.array([count[w] for w in words]), 500, 1, spelled)
    learner = Learner()
    for _ in range(3):
        learner.learn(trees, symbols_of(trees, *column_bytes(pa.array([text]))))
    pages = pa.Table.from_batches(list(_added(list(learner.pages()))))
    return trees, Model.of(iter(pages.to_pylist())), text


def test_probabilities_of_next_tokens_add_up():
    """After one and the same beginning, the chances of each word of the vocabulary, of the end and of an escape add up to 1."""
    from colscope.llm.common import column_bytes
    from colscope.llm.contextmix import symbols_of

    trees, model, _ = small_model()
    codes = [(int(c), int(s)) for c, s in zip(trees.word_code, trees.word_size, strict=True)]
    s = symbols_of(trees, *column_bytes(pa.array(["the cat the"])))
    total = 0.0
    for code, size in codes:
        s.code[-1], s.size[-1] = code, size
        each = model.bits(trees, s)
        s.size[-1] = 0
        total += 2.0 ** -(each[0] - model.bits(trees, s)[0])
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_mixing_beats_counts_of_words():
    from colscope.llm.common import column_bytes
    from colscope.llm.contextmix import symbols_of

    trees, model, text = small_model()
    bits = model.bits(trees, symbols_of(trees, *column_bytes(pa.array([text]))))[0]
    count = collections.Counter(text.split())
    assert bits < 0.9 * -sum(c * math.log2(c / count.total()) for c in count.values())


def test_nodes_are_numbered_without_gaps():
    from colscope.llm.contextmix import Trees, decisions, symbols_of
    from colscope.llm.common import column_bytes

    trees = Trees.of(pa.array(["a", "b", "c"]), np.array([9, 5, 2]), 3, 1, np.arange(257))
    s = symbols_of(trees, *column_bytes(pa.array(["a b c xyz " + "".join(chr(i) for i in range(33, 0x800)), ""])))
    seen = np.unique(np.concatenate([places[0] for _, _, _, places in decisions(trees, s, 0, len(s.size))]))
    assert seen.min() == 0 and seen.max() < 5 + 257 - 2


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out_texts_beat_the_base(spark, sf):
    from colscope.llm.queries import QUERIES

    df = QUERIES["op12_lm_scoring"](spark, f"/root/testdata/{sf}")
    score, base = df.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base
