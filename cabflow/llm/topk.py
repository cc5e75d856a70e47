"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

A block of candidates holds one list per vector component, sorted by it.  A
query reads every list from the end its own component favours, in rounds of
growing depth.  After a round each candidate has a lower bound (what was read
of it, plus the least any unread component can give) and an upper bound (plus
the value at which its unread lists stand).  A candidate whose upper bound is
below the k-th lower bound cannot qualify; reading stops when at most
``RESOLVE`` candidates are left or the lists are read, and only those get
their final scores.  All numbers are whole; where a product could pass 2**52, the
lists are read whole in Python's own whole numbers, so scores are exact always.

Scale: candidates and queries are dealt by hash over a grid of cells of
about ``CANDIDATES`` x ``QUERIES`` rows, each one task's bounded work; a cell
sends k rows a query, which a ranking with a map-side limit merges.

Defined cases: a vector that is null, or holds a null or non-finite
component, or one whose floor(256 x) is not a long, takes no part, as does
a null id; a score beyond a long is the largest or smallest long; vectors of unequal length are compared as if the shorter ended in
zeros; a row given twice counts once, and of several vectors with one id the
best scoring counts; rows with the query's id are never its result; ties go
to the smaller id; empty tables give an empty result; only the named columns
are read, and the result has only its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm.common import map_groups, require, stored

SCALE, LIMIT = 256, 2.0 ** 63  # a whole component is a long
CANDIDATES, QUERIES, RESOLVE = 4096, 512, 64
#: Shares of the lists read before the bounds are compared.  With 64 even components
#: they part candidates from about four fifths on (README), so rounds are there.
DEPTHS = (0.8, 0.85, 0.9, 0.95, 1.0)
LONG = 2 ** 63 - 1
_CELL = "query_id long, vec_id long, score long"


def quantised(embedding: str):
    """Whole components, or null for a vector that takes no part."""
    out = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) * SCALE >= LIMIT)
    whole = F.transform(F.col(embedding), lambda x: F.when(~out(x), F.floor(x.cast("double") * SCALE).cast("long")))
    return F.when(~F.exists(F.col(embedding), out), whole)


def nra(X: np.ndarray, ids: np.ndarray, Q: np.ndarray, query_ids: np.ndarray, k: int, read_to: dict | None = None):
    """(query index, candidate index, score) of the k best of every query.
    ``read_to`` takes the share of the lists that each query read."""
    n, dims = X.shape
    exact = float(np.abs(X).max(initial=0)) * float(np.abs(Q).max(initial=0)) * dims < 2.0 ** 52
    X = X.astype(float if exact else object)
    Q = Q.astype(float if exact else object)
    order = np.argsort(X, 0, kind="stable")
    place = np.empty((n, dims), np.int32)  # from the top of the list
    np.put_along_axis(place, order, np.arange(n - 1, -1, -1, dtype=np.int32)[:, None].repeat(dims, 1), 0)
    lists = np.take_along_axis(X, order, 0)[::-1]
    up, down = np.maximum(Q, 0), np.minimum(Q, 0)  # which end of each list a query reads from
    both = np.concatenate([up, down], 1)
    own = query_ids[:, None] == ids[None, :]
    out, open_ = [], np.arange(len(Q))
    depths = DEPTHS if exact else (1.0,)
    for share in depths:
        depth = n if share == 1.0 else max(1, int(n * share))
        read = np.concatenate([place < depth, place >= n - depth], 1)
        two = np.concatenate([X, X], 1)
        seen = np.where(read, two, 0)
        if depth == n:
            high = low = both[open_] @ seen.T
        else:
            at = np.concatenate([lists[depth - 1], lists[n - depth]])
            least = np.concatenate([lists[-1], lists[0]])
            known = both[open_] @ seen.T
            high = known + both[open_] @ np.where(read, 0, at).T
            low = known + both[open_] @ np.where(read, 0, least).T
        low = np.where(own[open_], -np.inf, low).astype(float) if exact else np.where(own[open_], -2 ** 200, low)
        if n > k:  # the k-th best lower bound
            bar = np.sort(low, 1)[:, n - k] if not exact else np.partition(low, n - k, 1)[:, n - k]
        else:
            bar = low.min(1)
        alive = (high >= bar[:, None]) & ~own[open_]
        done = (alive.sum(1) <= max(RESOLVE, k)) | (depth == n)
        for i in np.nonzero(done)[0]:
            q = open_[i]
            if read_to is not None:
                read_to[int(q)] = share
            c = np.nonzero(alive[i])[0]
            score = X[c] @ Q[q]
            best = sorted(zip((-score).tolist(), ids[c].tolist(), c.tolist()))[:k]
            out += [(q, j, max(-LONG - 1, min(LONG, int(-s)))) for s, _, j in best]
        open_ = open_[~done]
        if not len(open_):
            break
    return out


def top_k(candidates: DataFrame, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of each query."""
    for d in (candidates, queries):
        require(d, vec_id=vec_id, embedding=embedding)
    whole = lambda d: (d.select(F.col(vec_id).cast("long").alias("id"), quantised(embedding).alias("v"))
                       .where("id is not null and v is not null").dropDuplicates(["id", "v"]))
    c, q = stored(whole(candidates)), stored(whole(queries))
    across, down = max(1, -(-c.count() // CANDIDATES)), max(1, -(-q.count() // QUERIES))
    deal = lambda d, n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = (c.withColumn("x", deal(c, across)).withColumn("y", every(down)).withColumn("query", F.lit(False))
             .unionByName(q.withColumn("y", deal(q, down)).withColumn("x", every(across)).withColumn("query", F.lit(True))))

    def cell(t):
        import pyarrow as pa
        is_query = t.column("query").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        if is_query.all() or not is_query.any():
            return
        ids = t.column("id").to_numpy()
        rows = t.column("v").combine_chunks()
        lengths = np.diff(rows.offsets.to_numpy())
        M = np.zeros((len(ids), int(lengths.max(initial=1)) or 1), np.int64)
        M[np.arange(M.shape[1]) < lengths[:, None]] = rows.flatten().to_numpy()
        found = nra(M[~is_query], ids[~is_query], M[is_query], ids[is_query], k)
        if found:
            a, b, s = (np.array(z) for z in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(ids[is_query][a], pa.int64()), pa.array(ids[~is_query][b], pa.int64()), pa.array(s, pa.int64())],
                                             names=["query_id", "vec_id", "score"])

    best = map_groups(cells.select("x", "y", "query", "id", "v"), ["x", "y"], cell, _CELL)
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
