"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

Each of ``TABLES`` tables rotates a unit vector twice by three rounds of
random signs and a fast Hadamard transform; the hash of a rotation is its
largest coordinate with its sign, and a bucket is the pair of both hashes.
Multiprobe: a vector is put in the bucket of its two best hashes and in those
where one of them is replaced by the second best.  Vectors that share a bucket are
compared in double precision, so no link is below the threshold.

Scale: equal vectors of a label are one row with a count before hashing.
A bucket's rows are dealt over cells of bounded size (``blocked``), each pair
of rows meeting in one cell; a pair that shares several buckets counts only
in the first.  A cell returns, per vector, how many it links to and the
smallest id it is connected to: never more rows than it read.

Defined cases: vectors that are null, zero or hold a null or non-finite
component, and rows with a null label, link with nothing and are components
of their own; so are rows with a null id, whose component is null.  Vectors
of different length never link.  Repeated rows are copies that link with
each other; rows that share an id are one node of the components.  An empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import blocked, components, map_groups, prepare, require, stored

TABLES, PROBES, THRESHOLD, ROWS, SEED = 8, 3, 0.93, 1024, 7


def hadamard(A: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, h = A.shape[1], 1
    while h < n:
        A = A.reshape(len(A), n // (2 * h), 2, h)
        A = np.stack([A[:, :, 0] + A[:, :, 1], A[:, :, 0] - A[:, :, 1]], 2).reshape(len(A), n)
        h *= 2
    return A / np.sqrt(n)


def buckets(X: np.ndarray, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """(rows, tables, PROBES) bucket numbers of unit vectors."""
    dims = 1 << max(1, (X.shape[1] - 1).bit_length())
    X = np.pad(X, ((0, 0), (0, dims - X.shape[1])))
    rng = np.random.default_rng([seed, dims])
    out = np.empty((len(X), tables, PROBES), np.int32)
    for t in range(tables):
        top = []
        for _ in range(2):
            A = X
            for _ in range(3):
                A = hadamard(A * rng.choice([-1.0, 1.0], dims))
            # two largest coordinates; equal ones in the order of their place
            best = np.argsort(-np.abs(A), 1, kind="stable")[:, :2]
            top.append(2 * best + (np.take_along_axis(A, best, 1) < 0))
        (a, b) = top
        for p, (i, j) in enumerate(((0, 0), (1, 0), (0, 1))):
            out[:, t, p] = a[:, i] * 2 * dims + b[:, j]
    return out


def links_in(X: np.ndarray, threshold: float, left: np.ndarray, right: np.ndarray):
    """Index pairs of rows of ``left`` and ``right`` with cosine at or above the threshold."""
    S = np.einsum("id,jd->ij", X[left], X[right], optimize=True)
    i, j = np.nonzero(S >= threshold)
    return left[i], right[j]


def local_components(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable from each of ``n`` rows over pairs (a, b)."""
    label = ids.copy()
    while True:
        old = label.copy()
        np.minimum.at(label, a, old[b])
        np.minimum.at(label, b, old[a])
        if (label == old).all():
            return label


def embedding_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, tables: int = TABLES) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    require(vectors, vec_id=vec_id, embedding=embedding, label=label)
    prepare(vectors.sparkSession)
    e = F.col("e")
    fine = (F.col("label").isNotNull() & e.isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(e, lambda x: x != 0))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"),
                          F.col(label).cast("string").alias("label")).withColumn("fine", F.coalesce(fine, F.lit(False)))
    rows = rows.withColumn("e", F.when(F.col("fine"), F.col("e"))).withColumn("group", F.xxhash64("label", "e"))
    # Equal vectors of a label: one row with the smallest id and a count.
    reps = stored(rows.where("fine").groupBy("label", "group", "e").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                  .where("rep is not null"))

    def hashed(batches):
        import pyarrow as pa
        for b in batches:
            es = b.column(1)
            lengths = np.diff(es.offsets.to_numpy())
            flat = es.flatten().to_numpy()
            out, start = np.empty(len(lengths), object), np.concatenate([[0], np.cumsum(lengths)])
            for d in np.unique(lengths):
                i = np.nonzero(lengths == d)[0]
                X = flat[start[i][:, None] + np.arange(d)]
                X = X / np.abs(X).max(1, keepdims=True)
                X = X / np.sqrt((X * X).sum(1, keepdims=True))
                H = buckets(X, tables)
                for r, h in zip(i, H):
                    out[r] = h.ravel()
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.diff(es.offsets.to_numpy()).astype(np.int32)), b.column(3), es,
                 pa.array([out[r].tolist() for r in range(n)], pa.list_(pa.int32()))],
                names=["rep", "label", "dims", "copies", "e", "buckets"])

    h = reps.select("rep", "e", "label", "copies").mapInArrow(hashed, "rep long, label string, dims int, copies long, e array<double>, buckets array<int>")
    put = (h.select("*", F.posexplode("buckets").alias("pos", "bucket"))
            .withColumn("table", F.floor(F.col("pos") / PROBES).cast("int")).drop("pos"))
    put = put.withColumn("e", F.col("e").cast("array<double>"))
    cells = blocked(put, ["label", "dims", "table", "bucket"], "rep", ROWS)
    keys = ["label", "dims", "table", "bucket", "cell_i", "cell_j"]

    def cell(t):
        import pyarrow as pa
        n = t.num_rows
        if n < 2:
            return
        ids, copies, block = (t.column(c).to_numpy() for c in ("rep", "copies", "block"))
        es = t.column("e").combine_chunks()
        X = es.flatten().to_numpy().reshape(n, -1)
        X = X / np.abs(X).max(1, keepdims=True)
        X = X / np.sqrt((X * X).sum(1, keepdims=True))
        i, j = t.column("cell_i")[0].as_py(), t.column("cell_j")[0].as_py()
        if i == j:
            a, b = links_in(X, threshold, np.arange(n), np.arange(n))
            a, b = a[a < b], b[a < b]
        else:
            a, b = links_in(X, threshold, np.nonzero(block == i)[0], np.nonzero(block == j)[0])
        if not len(a):
            return
        B = t.column("buckets").combine_chunks().flatten().to_numpy().reshape(n, -1, PROBES)
        table, bucket = t.column("table")[0].as_py(), t.column("bucket")[0].as_py()
        first = np.empty(len(a), bool)
        for s in range(0, len(a), 20_000):  # is this the first bucket that the pair shares?
            p, q = B[a[s:s + 20_000]], B[b[s:s + 20_000]]
            same = (p[:, :, :, None] == q[:, :, None, :]).any(3)
            at = same.any(2).argmax(1)
            shared = np.where(same[np.arange(len(p)), at], p[np.arange(len(p)), at], np.iinfo(np.int32).max).min(1)
            first[s:s + 20_000] = (at == table) & (shared == bucket)
        near = local_components(n, a, b, ids)
        a, b = a[first], b[first]
        links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        some = np.nonzero((links > 0) | (near != ids))[0]
        yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(links[some].astype(np.int64)), pa.array(near[some], pa.int64())],
                                         names=["rep", "links", "near"])

    found = stored(map_groups(cells.select(*keys, "block", "rep", "copies", "e", "buckets"), keys, cell, "rep long, links long, near long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    copies = (rows.where("fine and vec_id is not null").join(reps.select("label", "group", F.col("e").alias("same"), "rep", "copies"), ["label", "group"])
              .where(F.col("e") == F.col("same")).select("vec_id", "rep", "copies"))
    # Edges: cell links, plus every copy to the first of its group.
    part = components(found.select(F.col("rep").alias("a"), F.col("near").alias("b")).distinct()
                      .unionByName(copies.select(F.col("vec_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()))
    linked = copies.join(links, "rep", "left").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    every = linked.unionByName(rows.where("not fine or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links")))
    every = every.join(part.withColumnRenamed("id", "vec_id"), "vec_id", "left").withColumn("component_id", F.coalesce("component", "vec_id"))
    return every.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
                        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e,
         coalesce(label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, FALSE) AS fine
  FROM embeddings),
n AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v WHERE fine),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT l.a, r.c FROM l JOIN reach r ON l.b = r.id),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(k.n_links, 0)::BIGINT AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN (SELECT id, min(c) AS c FROM reach GROUP BY id) m ON m.id = v.vec_id LEFT JOIN k ON k.a = v.vec_id
"""
