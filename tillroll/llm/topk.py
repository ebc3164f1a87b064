"""Exact top-k inner-product search by the threshold algorithm.

Vectors are cut into blocks of rows; each block of queries meets each block of
candidates once. Within a block, every dimension has a list of candidates
sorted by component. A query reads its lists from the end that suits the sign
of its component, level by level; each candidate met gets its exact score by
random access, and the query stops when the sum of the list values at the
present depth, the most that an unseen candidate can score, is below its kth
score. Candidate blocks are met in rounds of growing size: after each, Spark
keeps the best k so far, and the kth of these is the next round's floor. A
floor tells beforehand at what depth a query stops at the latest, and scores
below it never leave a task, so the rows that a query sends grow with the
rounds, the logarithm of the blocks, and not with the blocks.

Results for odd input: vectors that are null or hold a null or non-finite
component take no part, as query or candidate; shorter vectors count as padded
with zeros, an empty one scores 0; null ids are never queries or candidates;
a repeated row is a row of its own: it is a candidate for its copies, and each
copy with a query's id gets its own k results; ties go to the smaller vec_id;
fewer than k candidates are all returned; an empty table gives an empty
result; other input columns are ignored, whatever their names. Components
beyond the range of a long are cut to it, and scores that pass it wrap round
(where one could, lists are read to the end, as no bound holds).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import stored

FIRST_LEVEL, STEP = 32, 2**0.5  # list depth at which the bound is first checked, and the ratio of the depths after it
LEAST = -(2**63)  # the floor of a query that has fewer than k candidates so far


def integer_vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """uid, vec_id and v, the components as floor(scale * x), of usable vectors of ``rows`` (vec_id, embedding)."""
    e = F.col("embedding").cast("array<double>")
    usable = e.isNotNull() & F.col("vec_id").isNotNull() & ~F.exists(
        e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.where(usable)
            .select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(e, lambda x: F.floor(x * scale)).cast("array<long>").alias("v")))


def blocks(vectors: DataFrame, count: int, name: str, *more: str) -> DataFrame:
    """One row for each of ``count`` blocks; rows are dealt by uid, so copies of a vector spread."""
    return (vectors.groupBy(F.pmod(F.xxhash64("uid"), F.lit(count)).alias(name))
            .agg(F.collect_list(F.struct("uid", "vec_id", "v", *more)).alias(f"{name}_rows")))


def rounds(count: int, growth: int) -> Iterator[tuple[int, int]]:
    """First and last + 1 of the blocks of each round: one block, then ``growth`` times as many as so far in all."""
    first, last = 0, 1
    while first < count:
        yield first, min(last, count)
        first, last = last, last * growth


def _matrix(rows: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """uid, vec_id and zero-padded components of one block's list of structs."""
    uid, vec_id, v = (rows.field(i) for i in range(3))
    out = np.zeros((len(rows), width), np.int64)
    sizes = v.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
    return uid.to_numpy(zero_copy_only=False), vec_id.to_numpy(zero_copy_only=False), out


def largest_product(a: np.ndarray, b: np.ndarray) -> float:
    """What no inner product of a row of a and a row of b exceeds, nor any part of its sum."""
    most = lambda x: float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0
    return most(a) * most(b) * max(1, a.shape[1])


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest number type in which no inner product of rows of a and b is rounded."""
    bound = largest_product(a, b)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


class SortedLists:
    """Per-dimension sorted lists of one block of candidates."""

    def __init__(self, uid: np.ndarray, vec_id: np.ndarray, vectors: np.ndarray):
        self.uid, self.vec_id, self.vectors = uid, vec_id, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")  # depth x dimension, smallest first
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.row = {u: i for i, u in enumerate(uid.tolist())}
        steps = np.arange(max(0, math.ceil(math.log(max(1, len(uid)) / FIRST_LEVEL, STEP))))
        self.levels = np.append((FIRST_LEVEL * STEP**steps).astype(np.int64), len(uid))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and each of ``levels``, the most that a candidate can score which no list shows down to there."""
        return (np.maximum(queries, 0) @ self.sorted[len(self.uid) - self.levels].T
                + np.minimum(queries, 0) @ self.sorted[self.levels - 1].T)

    def search(self, uid: int, query: np.ndarray, bounds: np.ndarray | None, k: int,
               floor: int = LEAST) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the k best candidates other than ``uid`` of no less than ``floor``, and how many were met.

        ``bounds`` is the query's row of ``bounds``, none where products may wrap round, so that no bound holds.
        Once the lists would take more reads to the next level than there are unmet candidates, these are scored
        without them."""
        n = len(self.vec_id)
        dims = np.flatnonzero(query)
        up = query[dims] > 0
        if bounds is None or not len(dims):
            levels = [n]  # no bound holds, or all scores are 0
        else:
            enough = np.flatnonzero(bounds < floor)
            levels = self.levels[:enough[0] + 1] if len(enough) else self.levels
        seen = np.zeros(n, bool)
        if uid in self.row:
            seen[self.row[uid]] = True  # never a candidate of its own
        rows, scores, every = [], [], None
        found, depth = 0, 0
        for level in levels:
            read = np.zeros(n, bool)
            if level == n or len(dims) * (level - depth) > n - np.count_nonzero(seen):
                level, read[:] = n, True
            else:
                read[self.order[depth:level, dims[~up]]] = True
                read[self.order[n - level:n - depth, dims[up]]] = True
            new = np.flatnonzero(read & ~seen)
            seen |= read
            if every is None and 8 * len(new) > n:
                every = self.vectors @ query  # cheaper than gathering that many rows
            rows.append(new)
            scores.append(self.vectors[new] @ query if every is None else every[new])
            found, depth = found + len(new), level
            if seen.all():
                break
            if found >= k and level < n:
                best = np.concatenate(scores)
                if np.partition(best, found - k)[found - k] > bounds[np.searchsorted(self.levels, level)]:
                    break
        rows, scores = np.concatenate(rows), np.concatenate(scores).astype(np.int64)
        some = scores >= floor
        rows, scores = rows[some], scores[some]
        if len(rows) > k:
            some = scores >= np.partition(scores, len(rows) - k)[len(rows) - k]
            rows, scores = rows[some], scores[some]
        first = np.lexsort((self.vec_id[rows], ~scores))[:k]  # ~ turns the order of every long, - not that of the least
        return rows[first], scores[first], found


def _search_blocks(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sides = [batch.column(name)[i].values for name in ("q_rows", "c_rows")]
                width = max([1, *(x for s in sides for x in s.field(2).value_lengths().to_numpy(zero_copy_only=False))])
                (quid, qid, q), (cuid, cid, c) = (_matrix(s, int(width)) for s in sides)
                floors = sides[0].field(3).to_pylist()
                kind = exact_type(q, c)
                q, lists = q.astype(kind), SortedLists(cuid, cid, c.astype(kind))
                bounds = lists.bounds(q) if largest_product(q, c) < 2**62 else [None] * len(q)
                out = []
                for u, x, most, floor in zip(quid.tolist(), q, bounds, floors, strict=True):
                    rows, scores, _ = lists.search(u, x, most, k, floor)
                    out.append((rows, scores))
                n = [len(r) for r, _ in out]
                rows = np.concatenate([r for r, _ in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(quid, n)), pa.array(np.repeat(qid, n)), pa.array(cid[rows]), pa.array(cuid[rows]),
                     pa.array(np.concatenate([s for _, s in out]))],
                    ["query_uid", "query_id", "vec_id", "uid", "score"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64, block_rows: int = 4096,
          query_rows: int = 2048, growth: int = 16) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row that ``is_query`` picks.

    A query block travels to every candidate block, so a larger ``query_rows``
    moves less; a block pair is what one task holds. Each round meets
    ``growth`` times as many candidate blocks as all before it.
    """
    vectors = stored(integer_vectors(rows, scale), "vectors")
    queries = vectors.where(is_query)
    n, nq = vectors.count(), queries.count()
    n_c, n_q = max(1, -(-n // block_rows)), max(1, -(-nq // query_rows))
    candidates = vectors.withColumn("c", F.pmod(F.xxhash64("uid"), F.lit(n_c)))
    meet = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))).alias("q")
    best = W.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    found = None
    for first, last in rounds(n_c, growth):
        if found is None:
            asked = queries.withColumn("floor", F.lit(LEAST))
        else:
            kth = found.where(F.col("rank") == k).select(F.col("query_uid").alias("uid"), F.col("score").alias("floor"))
            asked = queries.join(kth, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(LEAST)))
        some = candidates.where(F.col("c").between(first, last - 1)).drop("c")
        pairs = (blocks(some, n_c, "c").select("c", "c_rows", meet)
                 .join(blocks(asked, n_q, "q", "floor"), "q")
                 .repartition(min((last - first) * n_q, 20_000), "q", "c"))
        new = (pairs.select("q_rows", "c_rows")
               .mapInArrow(_search_blocks(k), "query_uid long, query_id long, vec_id long, uid long, score long"))
        every = new if found is None else found.drop("rank").unionByName(new)
        found = stored(every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "best")
    return found.select("query_id", "rank", "vec_id", "score")
