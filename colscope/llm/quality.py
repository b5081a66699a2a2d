"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its words (lower-cased in A-Z, hashed, counts damped by a logarithm, scaled to length one), statistics
of its structure (case, symbols, repetition of words and lines, lengths) and numeric metadata columns. The machine adds a
weight for each feature and low-rank weights for each pair; the sum over pairs comes in linear time from
sum over factors of ((sum v x)**2 - sum (v x)**2) / 2. It is fitted to a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Words, chunks, ship, span_sums
from .langid import may_learn

#: Buckets of hashed words, factors of each feature.
BUCKETS, FACTORS = 2**15, 8
STATISTICS = ("bytes", "words", "lines", "upper", "digit", "space", "mark", "symbol", "beyond_ascii", "word_length", "long_words", "distinct_words", "distinct_lines", "capitals", "symbol_words", "line_length", "bare_symbols", "repeated_words")


def _kind(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


_UPPER, _DIGIT, _SPACE, _BEYOND = _kind((65, 90)), _kind((48, 57)), _kind((9, 13), (32, 32)), _kind((128, 255))
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:'\"-()"]] = True
_SYMBOL = _kind((33, 47), (58, 64), (91, 96), (123, 126)) & ~_MARK


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each word feature, its bucket, its value, statistics of each text)."""
    n = len(offsets) - 1
    w = Words(data, offsets, lower=True)
    named_words = w.sums()
    bucket = (named_words >> U64(49)).astype(np.int64)
    pair, count = np.unique(w.doc * BUCKETS + bucket, return_counts=True)
    doc, bucket = pair // BUCKETS, pair % BUCKETS
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(doc, value * value, n))
    value = value / norm[doc]
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)
    words = np.diff(w.first).astype(float)
    length = (w.end - w.start).astype(float)
    # lines: their starts, and how many different ones a text has
    breaks = np.flatnonzero(data == 10) + 1
    nonempty = np.flatnonzero(np.diff(offsets) > 0)
    starts = np.unique(np.concatenate([offsets[nonempty], breaks[breaks < len(data)]])).astype(np.int64)
    line_doc = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.append(starts[1:], len(data))
    lines = np.bincount(line_doc, minlength=n).astype(float)
    named = span_sums(data, starts, ends)
    order = np.lexsort((named, line_doc))
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = (named[order][1:] != named[order][:-1]) | (line_doc[order][1:] != line_doc[order][:-1])
    different = np.bincount(line_doc[order][first], minlength=n).astype(float)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
    again = np.zeros(len(named_words), bool)
    if len(again):
        again[1:] = (named_words[1:] == named_words[:-1]) & (w.doc[1:] == w.doc[:-1])
    per_word = lambda flags: np.bincount(w.doc, flags.astype(float), n) / np.maximum(words, 1)
    stats = np.stack([
        np.log1p(size), np.log1p(words), np.log1p(lines),
        *[_sums(k[data], offsets) / some for k in (_UPPER, _DIGIT, _SPACE, _MARK, _SYMBOL, _BEYOND)],
        per_word(length), per_word(length > 20), np.bincount(doc, minlength=n) / np.maximum(words, 1), different / np.maximum(lines, 1),
        per_word(uppers[w.end] - uppers[w.start] > 1), per_word(symbols[w.end] > symbols[w.start]), np.log1p(size / np.maximum(lines, 1)),
        per_word(symbols[w.end] - symbols[w.start] == length), per_word(again),
    ], axis=1)
    return doc, bucket, value, stats


@dataclass
class Model:
    """Weights and factors of features: words first, then statistics and metadata, which are shifted and scaled before."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    metadata: tuple[str, ...]

    def margins(self, doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
        n = len(dense)
        dense = np.clip((dense - self.shift) / self.scale, -4, 4) / 4
        out = self.bias + np.bincount(doc, value * self.weight[bucket], n) + dense @ self.weight[BUCKETS:]
        for f in range(self.factor.shape[1]):
            v = value * self.factor[bucket, f]
            d = dense * self.factor[BUCKETS:, f]
            total = np.bincount(doc, v, n) + d.sum(axis=1)
            out += 0.5 * (total * total - np.bincount(doc, v * v, n) - (d * d).sum(axis=1))
        return out


def fit(texts: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]], metadata: tuple[str, ...] = (), steps: int = 1500, batch: int = 64, rate: float = 0.1, seed: int = 1) -> Model:
    """A machine fitted to (buckets, values, statistics and metadata, label) of texts, by Adagrad steps on the logistic loss.

    Both labels weigh alike, however rare one is.
    """
    r = np.random.default_rng(seed)
    k = len(texts[0][2])
    dense = np.array([t[2] for t in texts])
    y = np.array([t[3] for t in texts])
    shift, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-3
    of_one = np.where(y > 0.5, 0.5 / max(1.0, (y > 0.5).sum()), 0.5 / max(1.0, (y <= 0.5).sum())) * len(y)
    m = Model(0.0, np.zeros(BUCKETS + k), r.normal(0, 0.05, (BUCKETS + k, FACTORS)), shift, scale, metadata)
    scaled = np.clip((dense - shift) / scale, -4, 4) / 4
    sum_w, sum_v = np.full(BUCKETS + k, 1e-2), np.full((BUCKETS + k, FACTORS), 1e-2)
    for _ in range(max(3, -(-steps * batch // len(texts)))):
        order = r.permutation(len(texts))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            idx = np.concatenate([*[texts[j][0] for j in rows], np.tile(np.arange(BUCKETS, BUCKETS + k), len(rows))])
            val = np.concatenate([*[texts[j][1] for j in rows], scaled[rows].ravel()])
            doc = np.concatenate([np.repeat(np.arange(len(rows)), [len(texts[j][0]) for j in rows]), np.repeat(np.arange(len(rows)), k)])
            vx = m.factor[idx] * val[:, None]
            total = np.stack([np.bincount(doc, vx[:, f], len(rows)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(doc, (vx * vx).sum(axis=1), len(rows))
            margin = m.bias + np.bincount(doc, val * m.weight[idx], len(rows)) + 0.5 * ((total * total).sum(axis=1) - squares)
            off = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows]) * of_one[rows] / len(rows)
            used, at = np.unique(idx, return_inverse=True)
            g_w = np.bincount(at, off[doc] * val) + 1e-5 * m.weight[used]
            part = (off[doc] * val)[:, None] * (total[doc] - vx)
            g_v = np.stack([np.bincount(at, part[:, f]) for f in range(FACTORS)], axis=1) + 1e-5 * m.factor[used]
            sum_w[used] += g_w * g_w
            sum_v[used] += g_v * g_v
            m.weight[used] -= rate * g_w / np.sqrt(sum_w[used])
            m.factor[used] -= rate * g_v / np.sqrt(sum_v[used])
            m.bias -= rate * float(off.sum())
    return m


# ---------------------------------------------------------------- Spark


def _metadata(batch: pa.RecordBatch, names: tuple[str, ...], a: int, n: int) -> np.ndarray:
    """Numeric columns on a logarithmic scale, null as 0."""
    if not names:
        return np.zeros((n, 0))
    return np.stack([np.log1p(np.maximum(0, np.nan_to_num(np.asarray(batch.column(c).slice(a, n).cast(pa.float64()).fill_null(0.0))))) for c in names], axis=1)


def train(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",), sample_rows: int = 4000) -> Model | None:
    """A machine of at most ``sample_rows`` labelled rows: those that ``may_learn`` allows, with the least hash of doc_id.

    Null labels don't count; of several labels of a doc_id the least does, and of several rows that with the least hash of its
    text. None if no label is left.
    """
    ship(docs.sparkSession)
    wanted = labels.where(may_learn(F.col("doc_id")) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # ``wanted`` has at most ``sample_rows`` rows, so it may be broadcast.
    sample = docs.select("doc_id", "text", *metadata).join(F.broadcast(wanted), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"), *[F.col(c).cast("double").alias(c) for c in metadata]))
    sample = sample.groupBy("doc_id", "label").agg(one.alias("one")).select("doc_id", "label", "one.text", *[f"one.{c}" for c in metadata])

    def run(batches):
        for batch in batches:
            ids, labelled = batch.column("doc_id"), batch.column("label")
            for a, b, data, offsets in chunks(batch.column("text")):
                doc, bucket, value, stats = features(data, offsets)
                dense = np.hstack([stats, _metadata(batch, metadata, a, b - a)])
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), labelled.slice(a, b - a), pa.array([bucket[i:j].astype(np.int32).tobytes() for i, j in spans], pa.binary()), pa.array([value[i:j].astype(np.float32).tobytes() for i, j in spans], pa.binary()), pa.array([x.tobytes() for x in dense], pa.binary())], names=["doc_id", "label", "bucket", "value", "dense"])

    got = sample.mapInArrow(run, "doc_id long, label double, bucket binary, value binary, dense binary").toArrow().sort_by("doc_id")
    texts = [(np.frombuffer(x["bucket"], np.int32).astype(np.int64), np.frombuffer(x["value"], np.float32).astype(float), np.frombuffer(x["dense"], float), x["label"]) for x in got.to_pylist()]
    return fit(texts, metadata) if texts else None


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` (but one named score) and score: from 0 to 1, higher where label 1 is likelier.

    Uses text and the model's metadata columns only. A null or empty text has no words and statistics of 0, and gets a score as
    others do; very long texts count whole. Null metadata count as 0. Without a model (no labels) each score is 0.5. Rows
    that repeat a doc_id or have none are scored alike. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "score"])

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                n = b - a
                if model is None:
                    score = np.full(n, 0.5)
                else:
                    doc, bucket, value, stats = features(data, offsets)
                    margin = model.margins(doc, bucket, value, np.hstack([stats, _metadata(batch, model.metadata, a, n)]))
                    score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                part = batch.slice(a, n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, "score"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())]))
