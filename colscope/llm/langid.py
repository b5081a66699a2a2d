"""Hierarchical language identification: the family first, then one-versus-one linear support vector machines within it.

Features are hashed byte n-grams (two to four bytes) of the whole text, lower-cased, with every run of bytes that aren't
part of a letter taken as one space; their counts are damped by a square root and scaled to length one. One machine for
each family against the rest picks the family; within it, each pair of languages has a machine, and votes (then sums of
margins) pick the language. Machines have squared hinge loss and are fitted on a bounded sample.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Kept, chunks, ship

#: Hash buckets of n-grams; the sizes of n-grams in bytes; texts that are handled at once.
BUCKETS, GRAMS, ROWS = 4096, (2, 3, 4), 256
UNDETERMINED = "und"

# Families of languages by ISO 639-1 code. A code that isn't listed is in the family "other".
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "celtic": "ga cy br gd",
    "baltic": "lt lv",
    "indic": "hi ur bn mr pa gu",
    "semitic": "ar he mt",
    "sinitic": "zh yue",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def held_out(doc_id: Column) -> Column:
    """Whether the remainder of crc32 of doc_id as text by 4 is 2; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    return doc_id.isNotNull() & ~held_out(doc_id)


# ---------------------------------------------------------------- features


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``BUCKETS`` values for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:  # capitals of two bytes, C3 80 to C3 9E
        low[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 32
    letter = _LETTER[low]
    low[~letter] = 32
    keep = letter.copy()
    if len(keep):
        keep[0] = True
        keep[1:] |= letter[:-1] | (doc[1:] != doc[:-1])
    low, doc = low[keep].astype(U64), doc[keep]
    out = np.zeros(n * BUCKETS)
    for g in GRAMS:
        if len(low) < g:
            continue
        code = np.full(len(low) - g + 1, U64(g))
        for k in range(g):
            code = (code << U64(8)) | low[k : len(low) - g + 1 + k]
        same = doc[: len(code)] == doc[g - 1 :]
        bucket = ((code[same] * U64(0x9E3779B97F4A7C15)) >> U64(52)).astype(np.int64)
        out += np.bincount(doc[: len(code)][same] * BUCKETS + bucket, minlength=n * BUCKETS)
    out = np.sqrt(out).reshape(n, BUCKETS)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def has_letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[data] & (data < 128))])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = data[offsets[i] : offsets[i + 1]]
        if (text >= 128).any():
            found[i] = any(c.isalpha() for c in text.tobytes().decode(errors="ignore"))
    return found


def feature_rows(column):
    """(first row, features, which have letters) of runs of rows."""
    for a, b, data, offsets in chunks(column):
        for i in range(0, b - a, ROWS):
            j = min(i + ROWS, b - a)
            part, offs = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            yield a + i, features(part, offs), has_letters(part, offs)


# ---------------------------------------------------------------- machines


def svm(x: np.ndarray, y: np.ndarray, c: float = 50.0, rounds: int = 150) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with squared hinge loss, classes weighted alike; y is -1 or 1."""
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32) * np.float32(c)
    step = np.float32(1 / (1 + 2 * 2 * c))  # rows have squared length 2 at most, the bias included
    w = ahead = np.zeros(x.shape[1] + 1, np.float32)
    for k in range(rounds):
        pull = weight * np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1])) * y
        nxt = ahead - step * (ahead - 2 * np.append(pull @ x, pull.sum()))
        ahead = nxt + np.float32(k / (k + 3)) * (nxt - w)
        w = nxt
    return w.astype(float)


@dataclass
class Model:
    """families: of each row of ``top``; languages by family; pairs: (family, language a, language b, weights)."""

    families: list[str] = field(default_factory=list)
    top: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS + 1)))
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, int, int, np.ndarray]] = field(default_factory=list)


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """A model of rows of features and their languages."""
    known = sorted(set(langs))
    family = np.array([FAMILY_OF.get(v, "other") for v in langs])
    lang = np.array(langs)
    m = Model(sorted(set(family.tolist())))
    m.languages = {f: [v for v in known if FAMILY_OF.get(v, "other") == f] for f in m.families}
    m.top = np.array([svm(x, np.where(family == f, 1.0, -1.0)) for f in m.families]) if len(m.families) > 1 else np.zeros((len(m.families), BUCKETS + 1))
    for f in m.families:
        for a, b in itertools.combinations(range(len(m.languages[f])), 2):
            one, two = m.languages[f][a], m.languages[f][b]
            rows = (lang == one) | (lang == two)
            m.pairs.append((f, a, b, svm(x[rows], np.where(lang[rows] == one, 1.0, -1.0))))
    return m


def predict(m: Model, x: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, score from 0 to 1) of rows of features: the score is how sure the deciding machines are."""
    if not m.families:
        return [UNDETERMINED] * len(x), np.zeros(len(x))
    sure = lambda margin: 1 / (1 + np.exp(-3 * np.clip(margin, -20, 20)))
    top = x @ m.top[:, :-1].T + m.top[:, -1]
    best = top.argmax(axis=1)
    rest = np.where(np.arange(len(m.families)) == best[:, None], -np.inf, top).max(axis=1) if len(m.families) > 1 else np.full(len(x), -np.inf)
    score = sure((top[np.arange(len(x)), best] - rest) / 2) if len(m.families) > 1 else np.ones(len(x))
    names = np.empty(len(x), object)
    for k, f in enumerate(m.families):
        rows = np.flatnonzero(best == k)
        langs = m.languages[f]
        votes, margins = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
        least = np.full((len(rows), len(langs)), np.inf)
        for _, a, b, w in (p for p in m.pairs if p[0] == f):
            margin = x[rows] @ w[:-1] + w[-1]
            votes[:, a] += margin >= 0
            votes[:, b] += margin < 0
            margins[:, a] += np.tanh(margin)
            margins[:, b] -= np.tanh(margin)
            least[:, a] = np.minimum(least[:, a], margin)
            least[:, b] = np.minimum(least[:, b], -margin)
        won = (votes + margins / (4 * max(1, len(langs)))).argmax(axis=1)
        names[rows] = np.array(langs, object)[won]
        if len(langs) > 1:
            score[rows] *= sure(least[np.arange(len(rows)), won])
    return names.tolist(), score


# ---------------------------------------------------------------- Spark


def _sample(docs: DataFrame, sample_rows: int) -> pa.Table:
    """(lang, bucket, value) of the features of the rows to learn from."""
    rows = docs.where(may_learn(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    # As many languages as there are rows to take, the most frequent ones.
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample_rows).collect()}
    if not known:
        return pa.table({"lang": pa.array([], pa.string()), "bucket": pa.array([], pa.binary()), "value": pa.array([], pa.binary())})
    share = max(1, sample_rows // len(known))
    # Only hashes below a border may be among the least ``share``; so the ranking gets about 4 * share rows of a language,
    # however common it is. Should repeated rows leave too few, the border is raised.
    border = {k: min(1.0, (4 * share + 64) / n) for k, n in known.items()}

    def run(batches):
        for batch in batches:
            langs = batch.column("lang")
            for a, x, letters in feature_rows(batch.column("text")):
                used = [np.flatnonzero(v) for v in x]
                columns = [langs.slice(a, len(x)), pa.array([i.astype(np.uint16).tobytes() for i in used], pa.binary()), pa.array([v[i].astype(np.float32).tobytes() for v, i in zip(x, used, strict=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "value"]).filter(pa.array(letters))

    while True:
        borders = docs.sparkSession.createDataFrame(pa.table({"lang": list(border), "border": list(border.values())}))  # at most sample_rows rows
        low = rows.join(F.broadcast(borders), "lang").where(F.shiftrightunsigned("h", 11) / 2.0**53 <= F.col("border"))
        low = low.groupBy("doc_id", "lang", "h").agg(F.first("text").alias("text"))
        first = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "doc_id", "h")
        least = Kept(low.withColumn("n", F.row_number().over(first)).where(F.col("n") <= share).select("lang", "text"), "language-sample")
        got = {r["lang"]: r["n"] for r in least.df.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        if not (short := [k for k, v in border.items() if v < 1 and got.get(k, 0) < share]):
            break
        least.drop()
        border |= {k: min(1.0, 16 * border[k]) for k in short}
    found = least.df.mapInArrow(run, "lang string, bucket binary, value binary").toArrow()
    least.drop()
    return found


def train(docs: DataFrame, sample_rows: int = 2000) -> Model:
    """A model of a sample of ``docs`` (doc_id, text, lang): at most ``sample_rows`` rows, shared out alike among the languages.

    Only rows that ``may_learn`` allows, with text and lang, are used; of each language those with the least hash of doc_id and
    text. Equal rows count once; rows of one doc_id with different texts each count.
    """
    ship(docs.sparkSession)
    got = _sample(docs, sample_rows)
    if not got.num_rows:
        return Model()
    pairs = sorted(zip(*(got.column(c).to_pylist() for c in ("lang", "bucket", "value")), strict=True))  # the same sums each time
    del got
    x = np.zeros((len(pairs), BUCKETS), np.float32)
    for row, (_, bucket, value) in zip(x, pairs, strict=True):
        row[np.frombuffer(bucket, np.uint16)] = np.frombuffer(value, np.float32)
    return fit(x, [p[0] for p in pairs])


def identify_languages(docs: DataFrame, model: Model | None = None, sample_rows: int = 2000, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` that aren't named like new ones, and lang_pred, score (or other ``names``), for each row.

    lang_pred is one of the languages learned, or ``und`` (score 0) where the text is null or empty or has no letter, or where
    nothing could be learned. Whole texts count, however long. Rows that repeat a doc_id or have none are predicted alike.
    Without ``model``, one is trained on ``docs`` itself. Of ties, the language first in the alphabet wins. An empty table
    gives no rows.
    """
    ship(docs.sparkSession)
    model = model or train(docs, sample_rows)
    kept = [c for c in docs.columns if c not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*source.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def run(batches):
        for batch in batches:
            for a, x, letters in feature_rows(batch.column("text")):
                found, score = predict(model, x)
                part = batch.slice(a, len(x))
                found = [v if ok else UNDETERMINED for v, ok in zip(found, letters.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(np.where(letters, score, 0.0))], names=[*part.schema.names, *names])

    return source.mapInArrow(run, schema)
