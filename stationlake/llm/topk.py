"""Exact top-k search with multi-resolution segment statistics.

Vectors become whole numbers, floor(64 * x).  Cut into segments of L components with means m and
deviations s, two vectors have squared distance of at least

    sum over segments of L * ((m_q - m_x)^2 + (s_q - s_x)^2),

and as |q|^2 and |x|^2 are sums of L * (m^2 + s^2), a small lower bound of the distance is a
large upper bound of the inner product (|q|^2 + |x|^2 - d^2) / 2 = sum of L * (m_q m_x + s_q s_x).
Every pair is bounded at the coarsest resolution, those whose bound reaches the query's k-th
best score so far at the next finer one, and the survivors' scores are computed exactly.

Layout: vectors are packed into blocks of ``BLOCK`` rows, queries into blocks of about
``QUERY_BLOCK``; each task gets one query block and a group of at most ``GROUP`` data blocks, so
memory and task size are bounded; each leaves k rows a query, merged by a window over a query's
few candidates.  Nothing but the two block counts reaches the driver.

Edge cases: vectors that are null or hold null, NaN or infinite components take no part; a shorter vector is
continued with zeros; an empty vector is all zeros; a null vec_id is never a query and loses ties;
of rows with the same vec_id each is a row of its own (it is a candidate of the others);
numbers beyond 2^62 stop there, scores beyond the range of a long at its ends; an empty table
or one without queries gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import staged

K = 20
EVERY = 20
SCALE = 64
BLOCK = 4096
QUERY_BLOCK = 1024
GROUP = 8
SEGMENTS = (16, 4)  # components a segment, coarse to fine
DENSE = 0.05  # share of survivors from which a block product beats single products


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.floor(SCALE * flat.astype(np.float64))
    return np.clip(x, -(2.0 ** 62), 2.0 ** 62).astype(np.int64)


def statistics(x: np.ndarray, length: int) -> np.ndarray:
    """sqrt(L) times the means, then sqrt(L) times the deviations, of each row's segments."""
    n, d = x.shape
    pad = -d % length
    if pad:
        x = np.concatenate([x, np.zeros((n, pad))], 1)
    s = x.reshape(n, -1, length)
    m = s.mean(2)
    dev = np.sqrt(((s - m[:, :, None]) ** 2).mean(2))
    return np.concatenate([m, dev], 1) * np.sqrt(length)


def products(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs (rows, cols)."""
    if not len(rows):
        return np.zeros(0, np.int64)
    d = max(1, q.shape[1])
    top = float(max(1, np.abs(q).max(initial=0))) * float(max(1, np.abs(x).max(initial=0))) * d
    if top < 2 ** 53:
        if len(rows) > DENSE * len(q) * len(x):
            return (q.astype(np.float64) @ x.astype(np.float64).T)[rows, cols].astype(np.int64)
        out = np.empty(len(rows), np.int64)
        for at in range(0, len(rows), 1 << 16):
            sl = slice(at, at + (1 << 16))
            out[sl] = np.einsum("ij,ij->i", q[rows[sl]], x[cols[sl]])
        return out
    lo, hi = -(2 ** 63), 2 ** 63 - 1
    own = [int(min(hi, max(lo, sum(int(a) * int(b) for a, b in zip(q[r], x[c], strict=True)))))
           for r, c in zip(rows, cols, strict=True)]
    return np.array(own, np.int64)


class Best:
    """The k best candidates of each query so far, in order."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = [np.zeros(0, np.int64)] * queries
        self.vec = [np.zeros(0, np.int64)] * queries
        self.null = [np.zeros(0, bool)] * queries

    def floor(self) -> np.ndarray:
        """The score that a newcomer must reach."""
        return np.array([s[-1] if len(s) == self.k else -np.inf for s in self.score], np.float64)

    def add(self, i: int, score: np.ndarray, vec: np.ndarray, null: np.ndarray) -> None:
        if len(score) > 4 * self.k:
            keep = score >= np.partition(score, -self.k)[-self.k]
            score, vec, null = score[keep], vec[keep], null[keep]
        score = np.concatenate([self.score[i], score])
        vec, null = np.concatenate([self.vec[i], vec]), np.concatenate([self.null[i], null])
        order = np.lexsort((vec, null, np.invert(score)))[:self.k]  # ~score falls as score rises, without overflow
        self.score[i], self.vec[i], self.null[i] = score[order], vec[order], null[order]


def search(best: Best, q: np.ndarray, x: np.ndarray, vec: np.ndarray, null: np.ndarray, own: np.ndarray,
           segments: tuple[int, ...] = SEGMENTS) -> int:
    """Offer the rows of x to all queries; own: each query's own row in x or -1.  Returns the exact products made."""
    d = max(q.shape[1], x.shape[1])
    q, x = (np.concatenate([a, np.zeros((len(a), d - a.shape[1]), a.dtype)], 1) for a in (q, x))
    fq, fx = q.astype(np.float64), x.astype(np.float64)
    floor = best.floor()
    slack = 1e-9 * np.outer(np.linalg.norm(fq, axis=1), np.linalg.norm(fx, axis=1)) + 1e-6
    alive = np.ones((len(q), len(x)), bool)
    has = np.flatnonzero(own >= 0)
    alive[has, own[has]] = False
    if np.isfinite(floor).any():
        for length in segments:
            sq, sx = statistics(fq, length), statistics(fx, length)
            if alive.mean() > DENSE:
                alive &= sq @ sx.T + slack >= floor[:, None]
            else:
                r, c = np.nonzero(alive)
                alive[r, c] = np.einsum("ij,ij->i", sq[r], sx[c]) + slack[r, c] >= floor[r]
    rows, cols = np.nonzero(alive)
    score = products(q, x, rows, cols)
    hit = score >= floor[rows]
    rows, cols, score = rows[hit], cols[hit], score[hit]
    for i, lo, hi in zip(*_runs(rows), strict=True):
        best.add(int(i), score[lo:hi], vec[cols[lo:hi]], null[cols[lo:hi]])
    return int(alive.sum())


def _runs(sorted_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(sorted_rows):
        return (np.zeros(0, np.int64),) * 3
    starts = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    return sorted_rows[starts], starts, np.concatenate([starts[1:], [len(sorted_rows)]])


def _matrix(row, of: str = "numbers") -> np.ndarray:
    return np.frombuffer(row[of], row["kind"]).reshape(row["n"], row["dim"]).astype(np.int64)


def packed(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of valid vectors: block, n, dim, kind, numbers, vec, null, n_queries."""
    ok = "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, block):
                part = b.slice(at, block)
                lists = part.column(1)
                lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                n, dim = len(lens), int(lens.max(initial=0))
                x = np.zeros((n, dim), np.int64)
                x[np.arange(dim)[None, :] < lens[:, None]] = whole_numbers(lists.flatten().to_numpy(zero_copy_only=False))
                top = int(np.abs(x).max(initial=0))
                kind = "<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<i8"
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                vec = part.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_pylist([{
                    "block": uuid.uuid4().hex, "n": n, "dim": dim, "kind": kind, "numbers": x.astype(kind).tobytes(),
                    "vec": vec.tobytes(), "null": null.astype(np.uint8).tobytes()}],
                    pa.schema([("block", pa.string()), ("n", pa.int64()), ("dim", pa.int64()), ("kind", pa.string()),
                               ("numbers", pa.binary()), ("vec", pa.binary()), ("null", pa.binary())]))

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(ok)
    return staged(rows.mapInArrow(
        pack, "block string, n long, dim long, kind string, numbers binary, vec binary, null binary"), "vector-blocks")


def query_parts(blocks: DataFrame, every: int = EVERY) -> DataFrame:
    """Of each block, the rows that are queries: block, n, dim, kind, numbers, vec, pos."""

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                vec = np.frombuffer(r["vec"], "<i8")
                pos = np.flatnonzero((vec % every == 0) & (np.frombuffer(r["null"], np.uint8) == 0))
                if len(pos):
                    out.append({"block": r["block"], "n": len(pos), "dim": r["dim"], "kind": r["kind"],
                                "numbers": _matrix(r)[pos].astype(r["kind"]).tobytes(), "vec": vec[pos].tobytes(),
                                "pos": pos.astype("<i8").tobytes()})
            if out:
                yield pd.DataFrame(out)

    return staged(blocks.mapInPandas(
        pick, "block string, n long, dim long, kind string, numbers binary, vec binary, pos binary"), "query-blocks")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, query_block: int = QUERY_BLOCK,
          group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query."""
    blocks = packed(vectors, block)
    parts = query_parts(blocks, every)
    n_blocks = blocks.count()
    n_queries = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups, query_blocks = max(1, -(-n_blocks // group)), max(1, -(-n_queries // query_block))
    left = parts.select("*", F.expr(f"pmod(xxhash64(block), {query_blocks})").alias("qb"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
    right = blocks.select("*", F.expr(f"pmod(xxhash64(block, 1), {groups})").alias("g"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("qb"))

    def found(key: tuple, qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        names = ["qblock", "qpos", "query_id", "vec_id", "score"]
        out = []
        for q in qs.sort_values("block").to_dict("records"):
            ids, pos = np.frombuffer(q["vec"], "<i8"), np.frombuffer(q["pos"], "<i8")
            best, numbers = Best(len(ids), k), _matrix(q)
            for x in xs.sort_values("block").to_dict("records"):
                own = pos if x["block"] == q["block"] else np.full(len(ids), -1)
                search(best, numbers, _matrix(x), np.frombuffer(x["vec"], "<i8"),
                       np.frombuffer(x["null"], np.uint8).astype(bool), own)
            for i in range(len(ids)):
                vec = pd.array(best.vec[i], "Int64")
                vec[best.null[i]] = pd.NA
                out.append(pd.DataFrame({"qblock": q["block"], "qpos": pos[i], "query_id": ids[i], "vec_id": vec,
                                         "score": best.score[i]}))
        return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

    each = left.groupBy("qb", "g").cogroup(right.groupBy("qb", "g")).applyInPandas(
        found, "qblock string, qpos long, query_id long, vec_id long, score long")
    order = Window.partitionBy("qblock", "qpos").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle(k: int = K, every: int = EVERY) -> str:
    """DuckDB SQL: every query against every row (exact in double: the numbers are small)."""
    return f"""
WITH v AS (SELECT row_number() OVER () AS row_no, vec_id,
                  [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.row_no, q.vec_id AS query_id, x.vec_id, list_dot_product(q.e, x.e)::BIGINT AS score
      FROM v q JOIN v x ON q.row_no <> x.row_no WHERE q.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
