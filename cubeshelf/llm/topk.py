"""Exact top-k search by columnar branch and bound.

Vectors are cut to integers, floor(scale * x), so scores are exact. Queries go
to the tasks in blocks of at most `block_queries` (their bytes are checked
before they are sent); every block is one pass over the candidates, which stay
where they are. With several blocks, each one's findings are written before
the next block is read, so driver and tasks hold one block at a time. In a task the candidates of a batch lie in vertical layout, a
row for each dimension. Scores grow dimension block by dimension block; after
each block a candidate is dropped for a query when its score so far plus the
most that the remaining dimensions can add (Cauchy-Schwarz over the remaining
mass of both sides) is below the query's k-th best, and the survivors are
compacted. Every task sends k rows for each query at most.

Vectors that are null, or hold null or non-finite components, take no part;
neither do rows with a null id. Of vectors of different length the shorter one
counts as zero beyond its end. A query's own row is every row with its id.
Repeated query rows each get their ranks. A score beyond a long fails the job; it never wraps. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeshelf.llm.common import quoted, staged

BLOCK_QUERIES, BLOCK_MB, DIMS = 4096, 64, 16


def _matrix(vectors: list) -> np.ndarray:
    """Rows of integers as a matrix, zero beyond the end of a shorter row:
    int64 where every inner product surely fits, else Python integers."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if score.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k], dtype=int)
    return np.lexsort((ids, -score))[:k]


class Search:
    """The k best of all candidates seen so far, for each query of a block."""

    def __init__(self, qid: np.ndarray, queries: np.ndarray, k: int, dims: int = DIMS):
        self.qid, self.q, self.k, self.dims = qid, queries, k, dims
        self.top = [(np.empty(0, np.int64), np.empty(0)) for _ in qid]

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        """x: integer-valued float64, a row for each candidate. Float sums of
        integers are exact below 2**53; beyond, Python integers are used."""
        width = max(x.shape[1], self.q.shape[1])
        vert = np.ascontiguousarray(np.pad(x, ((0, 0), (0, width - x.shape[1]))).T)
        q = np.pad(self.q, ((0, 0), (0, width - self.q.shape[1])))
        if width * float(abs(q).max(initial=0)) * float(abs(vert).max(initial=0)) >= 2.0**53:
            return self._add_big(ids, vert, q)
        cuts = [*range(0, width, self.dims), width] if width else [0, 0]
        mass = lambda a, axis: np.sqrt((a * a).sum(axis=axis))
        left_x = [mass(vert[c:], 0) for c in cuts[1:]]
        left_q = [mass(q[:, c:], 1) for c in cuts[1:]]
        first = q[:, :cuts[1]] @ vert[:cuts[1]]
        for i in range(len(q)):
            old_ids, old = self.top[i]
            floor = old[-1] if len(old) >= self.k else -np.inf
            at = np.nonzero(ids != self.qid[i])[0]
            score = first[i][at]
            for b in range(len(cuts) - 1):
                if b:
                    score = score + q[i, cuts[b]:cuts[b + 1]] @ vert[cuts[b]:cuts[b + 1], at]
                reach = left_q[b][i] * left_x[b][at] * (1 + 1e-9) + 1
                low = score - reach
                if len(at) > self.k:
                    floor = max(floor, np.partition(low, len(low) - self.k - 1)[len(low) - self.k - 1])
                keep = np.nonzero(score + reach >= floor)[0]
                at, score = at[keep], score[keep]
            self._merge(i, ids[at], score)

    def _add_big(self, ids, vert, q):
        whole = [[int(v) for v in row] for row in vert.T]
        for i, row in enumerate(q):
            w = [int(v) for v in row]
            score = np.array([sum(a * b for a, b in zip(w, v)) for v in whole], dtype=object)
            mine = ids != self.qid[i]
            self._merge(i, ids[mine], score[mine])

    def _merge(self, i, ids, score):
        ids, score = np.concatenate([self.top[i][0], ids]), np.concatenate([self.top[i][1], score])
        best = _best(score, ids, self.k)
        self.top[i] = ids[best], score[best]


def _usable(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v): ids and integer-valued components of the vectors that take part."""
    v = F.col(quoted(vec_col))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    big = lambda x: F.abs(x) >= 2.0**52  # noqa: E731  such a double has no fraction to cut
    cut = F.transform(F.transform(v, lambda x: x.cast("double") * scale),
                      lambda y: F.when(big(y), y).otherwise(F.floor(F.when(big(y), 0.0).otherwise(y)).cast("double")))
    return df.where(v.isNotNull() & F.col(quoted(id_col)).isNotNull() & ~bad).select(
        F.col(quoted(id_col)).cast("long").alias("id"), cut.alias("v"))


def _search(cands: DataFrame, block: list, k: int):
    """The k best of each task for each query, and the broadcast block."""
    spark = cands.sparkSession
    sent = spark.sparkContext.broadcast((np.array([r.q for r in block]), np.array([r.id for r in block], np.int64),
                                         _matrix([r.v for r in block])))

    def run(batches):
        at, qid, queries = sent.value
        s = Search(qid, queries, k)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            lists = b.column(1)
            lens = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(n, -1) if (lens == lens[0]).all() else _matrix(lists.to_pylist())
            s.add(b.column(0).to_numpy(zero_copy_only=False), x)
        rows = [(int(at[i]), int(qid[i]), int(c), int(v)) for i, (ids, score) in enumerate(s.top) for c, v in zip(ids, score)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             ["q", "query_id", "vec_id", "score"])

    return cands.mapInArrow(run, "q long, query_id long, vec_id long, score long"), sent


def exact_top_k(cands: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
                vec_col: str = "embedding", block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of the highest
    integer inner product for each row of `queries`, ties to the smaller id."""
    mine = staged(_usable(queries, id_col, vec_col, scale).withColumn("q", F.monotonically_increasing_id()), "queries")
    size = mine.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    per = max(1, min(block_queries, (BLOCK_MB << 20) // (8 * max(1, size[1] or 1))))
    n = 1 if size[0] <= per else -(-5 * size[0] // (4 * per))  # blocks dealt by hash stay under their size
    rows = _usable(cands, id_col, vec_col, scale)
    dealt = F.pmod(F.xxhash64("q"), F.lit(n))
    found = []
    for i in range(n):
        block = mine.where(dealt == i).collect()
        if block:
            part, sent = _search(rows, block, k)
            if n > 1:
                part = staged(part, "top-k")
                sent.destroy()
            found.append(part)
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return (reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
