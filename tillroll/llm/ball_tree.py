"""Ranked lexical search: exact top-k inner products over sparse ball trees.

Every document is a sparse vector: for a term that it holds tf times,
``gain(tf)``, an integer that grows with tf and shrinks with the document's
length. A query is the set of its terms; its score is the sum of weight x gain
over them, in 64-bit integers.

Index. Documents are dealt to the nearest of ``pivots`` centres (fitted on a
bounded sample, ``sample_rows``; every document is indexed) and within them to
groups of about ``group_rows``. Each group is a ball tree, built in a task: nodes
are halved along their main direction down to ``leaf_rows`` documents; a node
keeps the centroid of its documents over the terms they hold, and the radius
that reaches the farthest.

Search. With a query q and a document x of a node with centroid c and radius r,
q.x = q.c + q.(x - c) <= q.c + |q over the node's terms| r. Nodes are opened
best bound first, and a subtree is left out once its bound is below the k-th
score found. Bounds are doubles, rounded up by far more than they can be off
(``SAFE``); only a bound strictly below the k-th score prunes, so ties stay.
Scores at the leaves are integers. Each query first searches the few groups
whose roots have the greatest bounds; the k-th score found there is where all
other groups start from.

Weights and gains: w = floor(1000 ln((2 N + 2) / (2 df + 1))) and
gain = (10^9 tf) div (1000 tf + 20 m), m = 50 + (50 n N) div L, with N documents
that hold a term, L their terms, n the document's, df those that hold the term.

Sizes: queries are searched in blocks of about ``block_terms`` terms, whose
vocabulary, weights and floors are broadcast; a block reads the texts once. A
group of documents is what one task holds.

Results for odd input: a null or empty text of a document holds no terms and is
never found; a null or termless query has no results; only scores above 0
count; repeated rows, of documents as of queries, count one by one; ties go to
the smaller id, a null id last; fewer than k documents are all returned; an
empty table on either side gives an empty result; other columns are dropped,
whatever their names; texts of any length are read whole.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import stored, texts_in_small_batches

TERM = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# lower-cases letters and blanks what no term has, as TERM does; bytes beyond ASCII stay
TO_TERMS = bytes(c + 32 if c in UPPER else c if re.match(TERM, bytes([c])) else 32 for c in range(256))
NO_ID = (1 << 63) - 1  # stands for a null id, so that it comes last
SAFE = 1e-9  # relative; sums of 10^5 doubles are off by 10^-11 at most
SKETCH = 128  # dimensions that vectors are folded to where only likeness counts


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TO_TERMS).split()


@dataclass(frozen=True)
class Queries:
    """A block of queries over one vocabulary."""

    uids: list[int]
    terms: list[np.ndarray]  # of each query, ascending numbers in the vocabulary
    vocabulary: dict[bytes, int]

    @staticmethod
    def of(rows: list) -> Queries:
        vocabulary: dict[bytes, int] = {}
        terms = [np.array(sorted(vocabulary.setdefault(t, len(vocabulary)) for t in r["terms"]), np.int64) for r in rows]
        return Queries([r["uid"] for r in rows], terms, vocabulary)


def gains(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_factor(n: int, documents: int, total: int) -> int:
    return 100 - 50 + (50 * n * documents) // total


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# documents as vectors ---------------------------------------------------------

VECTORS = "uid long, doc_id long, n long, terms binary, tf binary, term int, df long"


def _vectors(vocabulary: dict[bytes, int]):
    """Rows of documents (uid, doc_id, n, terms, tf) and, at the end, of the terms' document counts (term, df)."""
    names = [c.split()[0] for c in VECTORS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]

    def rows(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        df = np.zeros(len(vocabulary), np.int64)
        number = vocabulary.get
        for b in batches:
            n, terms, tf = [], [], []
            for text in b["text"].to_pylist():
                words = terms_of(text)
                found = Counter(map(number, words))
                found.pop(None, None)
                t = np.fromiter(found.keys(), np.int32, len(found))
                f = np.fromiter(found.values(), np.int64, len(found))
                order = np.argsort(t)
                t = t[order]
                df[t] += 1
                n.append(len(words))
                terms.append(t.tobytes())
                tf.append(f[order].astype(np.int32).tobytes())
            k = len(n)
            yield rows(range(uid, uid + k), b["doc_id"].to_pylist(), n, terms, tf, [None] * k, [None] * k)
            uid += k
        some = np.flatnonzero(df)
        none = [None] * len(some)
        yield rows(none, none, none, none, none, some, df[some])

    return run


@dataclass(frozen=True)
class Space:
    """What turns counts of terms into vectors."""

    documents: int
    total: int
    weights: np.ndarray  # of the vocabulary

    def values(self, n: np.ndarray, sizes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = np.array([length_factor(int(x), self.documents, self.total) for x in n], np.int64)
        return gains(tf.astype(np.int64), np.repeat(m, sizes))


def _flat(batch: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of documents and their terms and counts, one after the other."""
    terms = batch["terms"].to_pylist()
    sizes = np.array([len(t) // 4 for t in terms], np.int64)
    return (sizes, np.frombuffer(b"".join(terms), np.int32).astype(np.int64),
            np.frombuffer(b"".join(batch["tf"].to_pylist()), np.int32))


def sketches(sizes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors folded to SKETCH dimensions with signs; like documents have like sketches."""
    h = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    sign = np.where(h >> np.uint64(63), -1.0, 1.0)
    cell = np.repeat(np.arange(len(sizes)), sizes) * SKETCH + ((h >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64)
    return np.bincount(cell, values * sign, len(sizes) * SKETCH).reshape(len(sizes), SKETCH)


def fit_pivots(x: np.ndarray, pivots: int, rounds: int = 8) -> np.ndarray:
    """Centres of a bounded sample: farthest points, then Lloyd's rounds."""
    if not len(x):
        return np.zeros((1, SKETCH))
    centres = [x.mean(axis=0)]
    far = np.full(len(x), np.inf)
    for _ in range(min(pivots, len(x)) - 1):
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
        centres.append(x[far.argmax()])
    centres = np.array(centres)
    for _ in range(rounds):
        near = nearest(x, centres)
        for i in np.unique(near):
            centres[i] = x[near == i].mean(axis=0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


# trees ------------------------------------------------------------------------


@dataclass
class Tree:
    """A group's documents in the order of the leaves, and its nodes: node i has
    the children 2 i + 1 and 2 i + 2 and the documents from start[i] to end[i]."""

    ids: np.ndarray
    ends: np.ndarray  # of the documents' entries
    terms: np.ndarray
    gain: np.ndarray
    start: np.ndarray
    end: np.ndarray
    node_ends: np.ndarray  # of the nodes' entries
    node_terms: np.ndarray
    centroid: np.ndarray
    radius: np.ndarray

    KINDS = (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32, np.int32, np.int32, np.float32, np.float64)

    def packed(self) -> list[bytes]:
        return [np.asarray(getattr(self, f), k).tobytes() for f, k in zip(self.__dataclass_fields__, self.KINDS, strict=True)]

    @staticmethod
    def unpacked(parts: list[bytes]) -> Tree:
        return Tree(*(np.frombuffer(p, k) for p, k in zip(parts, Tree.KINDS, strict=True)))


def _halved(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in two equal parts along the main direction of their sketches."""
    y = x[rows] - x[rows].mean(axis=0)
    v = y[(y**2).sum(axis=1).argmax()]
    for _ in range(3):
        v = (y @ v) @ y
        v /= np.linalg.norm(v) or 1.0
    order = rows[np.argsort(y @ v, kind="stable")]
    return order[:len(order) // 2], order[len(order) // 2:]


def build_tree(ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, gain: np.ndarray,
               leaf_rows: int = 16) -> Tree:
    """A ball tree of documents given one after the other."""
    x = sketches(sizes, terms, gain)
    levels = [[np.arange(len(ids))]]
    while len(levels[-1][0]) > leaf_rows:
        levels.append([h for rows in levels[-1] for h in _halved(x, rows)])
    order = np.concatenate(levels[-1])
    ends = np.cumsum(sizes)
    new = sizes[order]
    place = np.repeat(ends[order] - new, new) + np.arange(int(new.sum())) - np.repeat(np.cumsum(new) - new, new)
    terms, gain, ends = terms[place], gain[place], np.cumsum(new)
    y = gain.astype(np.float64)
    norms = np.add.reduceat(np.append(y * y, 0.0), np.append(ends - new, len(y)))[:-1] if len(new) else y
    norms = np.where(new > 0, norms, 0.0)
    start, end, node_ends, node_terms, centroid, radius = [], [], [], [], [], []
    total = 0
    for level in levels:
        at = 0
        for rows in level:
            a, b = at, at + len(rows)
            at = b
            first, last = (int(ends[a - 1]) if a else 0), (int(ends[b - 1]) if b else 0)
            support, where = np.unique(terms[first:last], return_inverse=True)
            c = (np.bincount(where, y[first:last], len(support)) / max(1, b - a)).astype(np.float32)
            exact = c.astype(np.float64)  # the rounded centroid is the centroid
            doc = np.repeat(np.arange(b - a), new[a:b])
            dots = np.bincount(doc, y[first:last] * exact[where], b - a)
            square = float(exact @ exact)
            far = norms[a:b] - 2 * dots + square + SAFE * (norms[a:b] + 2 * dots + square)
            total += len(support)
            start.append(a)
            end.append(b)
            node_ends.append(total)
            node_terms.append(support)
            centroid.append(c)
            radius.append(math.sqrt(max(0.0, float(far.max()) if b > a else 0.0)) * (1 + SAFE))
    return Tree(ids[order], ends, terms, gain, np.array(start), np.array(end), np.array(node_ends),
                np.concatenate(node_terms), np.concatenate(centroid), np.array(radius))


def bound_of(node: int, tree: Tree, query: np.ndarray, weights: np.ndarray) -> float:
    """No document of the node scores more. ``query``: terms; ``weights``: theirs."""
    a, b = int(tree.node_ends[node - 1]) if node else 0, int(tree.node_ends[node])
    held = tree.node_terms[a:b]
    at = np.searchsorted(held, query)
    at[at == len(held)] = 0
    some = held[at] == query if len(held) else np.zeros(len(query), bool)
    if not some.any():
        return 0.0
    q = weights[some]
    return (float(q @ tree.centroid[a + at[some]]) + math.sqrt(float(q @ q)) * float(tree.radius[node])) * (1 + SAFE) + 1


def search_tree(tree: Tree, query: np.ndarray, weights: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best documents of the tree with a score of at
    least ``floor``, and how many documents were scored."""
    query = query[weights[query] > 0]
    doubles = weights[query].astype(np.float64)
    by_term = np.zeros(len(weights), np.int64)
    by_term[query] = weights[query]
    ids, scores, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    heap = [(-bound_of(0, tree, query, doubles), 0)] if len(tree.start) else []
    while heap:
        bound, node = heapq.heappop(heap)
        if -bound < floor:
            break
        if 2 * node + 2 < len(tree.start):
            for child in (2 * node + 1, 2 * node + 2):
                if (b := bound_of(child, tree, query, doubles)) >= floor:
                    heapq.heappush(heap, (-b, child))
            continue
        a, b = int(tree.start[node]), int(tree.end[node])
        scored += b - a
        ends = tree.ends[a:b]
        first = int(tree.ends[a - 1]) if a else 0
        sums = np.r_[0, np.cumsum(by_term[tree.terms[first:int(ends[-1])]] * tree.gain[first:int(ends[-1])])]
        got = np.diff(sums[np.r_[first, ends] - first])
        some = got >= floor
        if some.any():
            ids, scores = np.r_[ids, tree.ids[a:b][some]], np.r_[scores, got[some]]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(scores) == k:
                floor = max(floor, int(scores[-1]))
    return ids, scores, scored


# Spark ------------------------------------------------------------------------


def query_rows(items: DataFrame) -> DataFrame:
    """uid, item_id and the distinct terms of each row of ``items`` (item_id, text) that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            terms = [sorted(set(terms_of(t))) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(range(uid, uid + b.num_rows), pa.int64()), b["item_id"],
                                              pa.array(terms, pa.list_(pa.binary()))], ["uid", "item_id", "terms"])
            uid += b.num_rows

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.where("text is not null").mapInArrow(run, "uid long, item_id long, terms array<binary>").where(F.size("terms") > 0)


@dataclass(frozen=True)
class Plan:
    pivots: int = 32
    sample_rows: int = 4096
    group_rows: int = 4096
    leaf_rows: int = 16
    block_terms: int = 100_000
    first_groups: int = 4  # that each query searches before the others


def index_documents(docs: DataFrame, vocabulary: dict[bytes, int], plan: Plan) -> tuple[DataFrame, Space] | None:
    """(grp, tree columns) rows over ``vocabulary``, and the space; None if no document holds a term."""
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    every = stored(rows.mapInArrow(_vectors(vocabulary), VECTORS), "search-vectors")
    sums = every.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("total")).first()
    if not sums["n"]:
        return None
    weights = np.zeros(len(vocabulary))
    for r in every.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row for each term of the block
        weights[r["term"]] = weight(sums["n"], r["df"])
    space = Space(sums["n"], sums["total"], weights)
    shared = spark.sparkContext.broadcast(space)

    vectors = every.where(F.octet_length("terms") > 0).select("uid", "doc_id", "n", "terms", "tf")
    few = vectors.orderBy(F.xxhash64("uid"), "uid").limit(plan.sample_rows).toArrow()

    def sketched(t: pa.Table | pa.RecordBatch, space: Space) -> np.ndarray:
        sizes, terms, tf = _flat(t)
        return sketches(sizes, terms, space.values(t["n"].to_numpy(), sizes, tf))

    centres = spark.sparkContext.broadcast(fit_pivots(sketched(few, space), plan.pivots))

    @F.arrow_udf("int")
    def pivot(n: pa.Array, terms: pa.Array, tf: pa.Array) -> pa.Array:
        t = pa.RecordBatch.from_arrays([n, terms, tf], ["n", "terms", "tf"])
        return pa.array(nearest(sketched(pa.Table.from_batches([t]), shared.value), centres.value), pa.int32())

    dealt = stored(vectors.withColumn("pivot", pivot.asNondeterministic()("n", "terms", "tf")), "search-dealt")
    sizes = dealt.groupBy("pivot").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / plan.group_rows)).alias("parts"))
    grouped = (dealt.join(F.broadcast(sizes), "pivot")  # a row for each pivot
               .withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts"))))
    fields = list(Tree.__dataclass_fields__)

    def build(key: tuple, t: pa.Table) -> pa.Table:
        space = shared.value
        sizes, terms, tf = _flat(t)
        gain = space.values(t["n"].to_numpy(), sizes, tf)
        ids = np.array([NO_ID if x is None else x for x in t["doc_id"].to_pylist()], np.int64)
        tree = build_tree(ids, sizes, terms, gain, plan.leaf_rows)
        root = int(tree.node_ends[0])
        top = [np.asarray(x, k).tobytes() for x, k in ((tree.node_terms[:root], np.int32), (tree.centroid[:root], np.float32))]
        grp = (key[0].as_py() << 40) + key[1].as_py()
        return pa.Table.from_arrays([pa.array([grp], pa.int64()), *[pa.array([x], pa.binary()) for x in top],
                                     pa.array([float(tree.radius[0])], pa.float64()), *[pa.array([p], pa.binary()) for p in tree.packed()]],
                                    ["grp", "root_terms", "root_centroid", "root_radius", *fields])

    schema = f"grp long, root_terms binary, root_centroid binary, root_radius double, {', '.join(f'{f} binary' for f in fields)}"
    return stored(grouped.groupBy("pivot", "part").applyInArrow(build, schema), "search-index"), space


def search_block(docs: DataFrame, queries: Queries, k: int, plan: Plan) -> DataFrame | None:
    """(query, doc_id, score, scored): from each group the best of each query."""
    spark = docs.sparkSession
    got = index_documents(docs, queries.vocabulary, plan)
    if got is None:
        return None
    index, space = got
    shared = spark.sparkContext.broadcast((queries.terms, space.weights))
    texts_in_small_batches(spark, 16)  # a row is a tree

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = shared.value
        best: list[list] = [[] for _ in terms]
        for b in batches:
            for r in b.to_pylist():
                held, c = np.frombuffer(r["root_terms"], np.int32), np.frombuffer(r["root_centroid"], np.float32)
                empty = np.zeros(0)
                root = Tree(empty, empty, empty, empty, empty, empty, np.array([len(held)]), held, c, np.array([r["root_radius"]]))
                for i, q in enumerate(terms):
                    q = q[weights[q] > 0]
                    heapq.heappush(best[i], (bound_of(0, root, q, weights[q]), r["grp"]))
                    if len(best[i]) > plan.first_groups:
                        heapq.heappop(best[i])
        flat = [(i, g, x) for i, v in enumerate(best) for x, g in v]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in flat], pa.int64()), pa.array([r[1] for r in flat], pa.int64()),
                                          pa.array([r[2] for r in flat], pa.float64())], ["query", "grp", "bound"])

    top = W.partitionBy("query").orderBy(F.desc("bound"), "grp")
    first = (index.select("grp", "root_terms", "root_centroid", "root_radius").mapInArrow(bounds, "query long, grp long, bound double")
             .withColumn("r", F.row_number().over(top)).where(F.col("r") <= plan.first_groups).select("query", "grp").collect())
    wanted: dict[int, list[int]] = {}
    for r in first:  # first_groups rows for each query of the block
        wanted.setdefault(r["grp"], []).append(r["query"])

    def searched(floors: np.ndarray, only: dict[int, list[int]] | None):
        terms_and_weights, fields = shared, list(Tree.__dataclass_fields__)
        sent = spark.sparkContext.broadcast((floors, only))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms, weights = terms_and_weights.value
            floors, only = sent.value
            weights = weights.astype(np.int64)
            for b in batches:
                for r in range(b.num_rows):
                    tree = Tree.unpacked([b[f][r].as_py() for f in fields])
                    out = []
                    for i in range(len(terms)) if only is None else only.get(b["grp"][r].as_py(), ()):
                        ids, scores, scored = search_tree(tree, terms[i], weights, k, int(floors[i]))
                        out += [(i, d, s, scored) for d, s in zip(ids.tolist(), scores.tolist(), strict=True)] or [(i, None, None, scored)]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                         ["query", "doc_id", "score", "scored"])

        return run

    schema = "query long, doc_id long, score long, scored long"
    floors = np.ones(len(queries.terms), np.int64)
    best = W.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    found = (index.where(F.col("grp").isin(list(wanted))).mapInArrow(searched(floors, wanted), schema).where("score is not null")
             .withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("query", "score").collect())
    for r in found:  # a row for each query of the block
        floors[r["query"]] = r["score"]
    return index.mapInArrow(searched(floors, None), schema)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, plan: Plan = Plan()) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    queries = stored(query_rows(items), "search-queries")
    n_terms = queries.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-n_terms // plan.block_terms))
    schema = "item_id long, uid long, doc_id long, score long"
    out = spark.createDataFrame([], schema)
    for i in range(blocks):  # a block is broadcast: about block_terms terms
        rows = queries.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == i).collect()
        if rows:
            block = Queries.of(rows)
            got = search_block(docs, block, k, plan)
            if got is not None:
                ids = spark.createDataFrame([(n, r["uid"], r["item_id"]) for n, r in enumerate(rows)], "query long, uid long, item_id long")
                got = stored(got.where("score is not null"), "search-found")
                out = out.unionByName(got.join(ids, "query").select("item_id", "uid", "doc_id", "score"))
    texts_in_small_batches(spark)
    best = W.partitionBy("uid").orderBy(F.desc("score"), "doc_id")
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", F.nullif(F.col("doc_id"), F.lit(NO_ID)).alias("doc_id"), "score"))
