"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a row of weighted terms: its positions with a weight other than zero. Spark deals candidates into blocks and
queries into blocks, and brings each pair of blocks together in one group. There, postings (term -> candidates and
weights) are built once; each term of a query scatters its weighted postings into the query's dense score array. The
best k of every array are found by partition selection (``numpy.partition``), and Spark merges the blocks' winners by a
ranking window. A group holds at most one block of either side, whatever the sizes of the tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

#: Candidates and queries of one block: a candidate is sent once for each 4096 queries, a query once for each 8192 candidates.
CANDIDATES, QUERIES = 8192, 4096
#: A score beyond a long counts as the nearest long.
LEAST, MOST = -(2**63), 2**63 - 1
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, terms, weights): positions and values of floor(scale * x) that aren't zero, x taken as double."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(F.lit(float(scale)) * v))
    fine = F.forall(F.col("embedding").cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("w"))
    terms = F.filter(F.transform("w", lambda v, i: F.struct(i.cast("int").alias("t"), v.cast("long").alias("w"))), lambda s: s["w"] != 0)
    return rows.select("vec_id", terms.alias("e")).select("vec_id", F.col("e.t").alias("terms"), F.col("e.w").alias("weights"))


def _ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each value, and the values, of a list column."""
    column = column.combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths(), np.int64)
    return np.repeat(np.arange(len(column)), lengths), np.asarray(column.flatten(), np.int64)


def accumulate(n_rows: int, q_term: np.ndarray, q_weight: np.ndarray, postings: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The dense score array of one query: each of its terms adds its weighted postings. Longs wrap around; see ``bounded``."""
    scores = np.zeros(n_rows, q_weight.dtype)
    for t, w in zip(q_term.tolist(), q_weight, strict=True):
        if t not in postings:
            continue
        at, weights = postings[t]
        if len(at) == n_rows:  # a term of every candidate: its rows are 0, 1, 2, ...
            scores += w * weights
        else:
            scores[at] += w * weights
    return scores


def bounded(scores: np.ndarray, row: np.ndarray, term: np.ndarray, weight: np.ndarray, q_term: np.ndarray, q_weight: np.ndarray) -> np.ndarray:
    """Scores that may have wrapped around, set right: one that fits a long is exact even so, any other becomes the nearest long."""
    of = dict(zip(q_term.tolist(), q_weight.tolist(), strict=True))
    mine = np.array([of.get(t, 0) for t in term.tolist()], object)
    near = mine.astype(float) * weight
    total, size = np.bincount(row, near, len(scores)), np.bincount(row, np.abs(near), len(scores))
    doubt = size * 1e-9 + 1
    out = np.where(total - doubt > MOST, MOST, np.where(total + doubt < LEAST, LEAST, scores))
    for i in np.flatnonzero((np.abs(total) + doubt >= 2.0**63) & (out == scores)):
        own = row == i
        out[i] = min(MOST, max(LEAST, int((mine[own] * weight[own].astype(object)).sum())))
    return out


def select(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: higher score first, then smaller id. Partition selection, then a sort of the few left."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        above = at[scores[at] > least]
        ties = at[scores[at] == least]
        need = k - len(above)
        if len(ties) > need:
            ties = ties[np.argpartition(ids[ties], need - 1)[:need]]
        at = np.concatenate([above, ties])
    return at[np.lexsort((ids[at], ~scores[at]))]


def _search(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and candidates.num_rows:
            ids = candidates.column("vec_id").to_numpy()
            row, term = _ragged(candidates.column("terms"))
            weight = _ragged(candidates.column("weights"))[1]
            order = np.argsort(term, kind="stable")
            row, term, weight = row[order], term[order], weight[order]
            cuts = np.flatnonzero(np.diff(term)) + 1
            postings = {int(t[0]): (r, w) for t, r, w in zip(np.split(term, cuts), np.split(row, cuts), np.split(weight, cuts), strict=True) if len(t)}
            most, terms = float(np.abs(weight.astype(float)).max(initial=0)), np.bincount(row, minlength=len(ids)).max(initial=0)
            q_row, q_term = _ragged(queries.column("terms"))
            q_weight = _ragged(queries.column("weights"))[1]
            cut = np.searchsorted(q_row, np.arange(queries.num_rows + 1))
            for i, q in enumerate(queries.column("vec_id").to_pylist()):
                own = slice(cut[i], cut[i + 1])
                scores = accumulate(len(ids), q_term[own], q_weight[own], postings)
                if most * float(np.abs(q_weight[own].astype(float)).max(initial=0)) * terms >= 2.0**62:
                    scores = bounded(scores, row, term, weight, q_term[own], q_weight[own])
                best = select(scores, ids, ids != q, k)
                out.append((np.full(len(best), q), ids[best], scores[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(columns, schema=FOUND)

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, scale: int = 1024, candidate_block: int = CANDIDATES, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products, ties to the smaller vec_id.

    Both tables have vec_id and embedding; components become floor(scale * x). A query's candidates are all rows with
    another vec_id than its own; with fewer than ``k`` of them, all are returned. Vectors may differ in length: missing
    components count as zero. Left out of both sides: null vec_ids, null vectors, vectors with a null or non-finite component.
    Scaled components and scores beyond a long count as the nearest long. A vector of zeros takes part with scores of 0. Equal query rows are one query; different vectors under one
    query_id share one ranking; as candidates each row counts. Other columns are not read. Empty tables give no rows.
    """
    ship(candidates.sparkSession)
    q, c = scaled(queries, scale).distinct(), scaled(candidates, scale)
    n_q = max(1, -(-queries.count() // query_block))
    n_c = max(1, -(-candidates.count() // candidate_block))
    # Rows are numbered, so that the rows of one vec_id are dealt out as well.
    block = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(n)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("qb", F.pmod(F.xxhash64("vec_id", "terms", "weights"), F.lit(n_q)).cast("int")).withColumn("cb", every(n_c))
    c = c.withColumn("cb", block(n_c)).withColumn("qb", every(n_q))
    found = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

