"""Clustering: RFM scaling, nearest-centroid assignment, quality metrics, K-Means fits.

Feature vectors are ``array<double>`` columns, so the same metric code serves
three RFM columns and 64-dimensional embeddings. Metrics cover exactly the
rows they are given; whoever wants them on a sample passes one (a cluster-safe
sample, say). A fitted model is k centroids, k a user parameter; those are what
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, fixed_layout, join_small
from tillroll.operators.features import fit_standard_scaler, standard_scale
from tillroll.operators.sampling import hash_key
from tillroll.sources.sinks import materialize

RFM_FEATURES = ["Recency", "Frequency", "Monetary"]
METRIC_SAMPLE = 10_000  # rows of the cluster-safe sample that the steps score
BLOCK_ROWS = 2048  # points of a silhouette block
WHOLE_BLOCKS = 64  # that a whole table's points are dealt to, so long as a block has no more than
WHOLE_BLOCK_ROWS = 131_072
TILE = 128, 1024  # points whose distances to points are worked out at once


def as_vector(cols: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def as_double_array(c: str) -> Column:
    return F.transform(F.col(c), lambda v: v.cast("double"))


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def scale_rfm(rfm: DataFrame, cols: list[str] = RFM_FEATURES) -> tuple[DataFrame, DataFrame]:
    """Standard-scaled copies ``<col>_s`` (population std) and the fitted params."""
    params = fit_standard_scaler(rfm, cols)
    return standard_scale(rfm, cols, params, suffix="_s"), params


# ---------------------------------------------------------------- assignment
def assign_nearest(df: DataFrame, features: list[str], centroids: list[tuple[int, list[float]]],
                   out: str = "Cluster", dist_out: str | None = None) -> DataFrame:
    """Nearest centroid by Euclidean distance; ties go to the lowest id.

    The k centroids are literals inside one codegen'd expression: the
    minimum of (squared distance, id) structs; no join, no shuffle.
    """
    cands = []
    for cid, c in centroids:
        d = None
        for col, v in zip(features, c):
            diff = F.col(col).cast("double") - F.lit(float(v))
            term = diff * diff
            d = term if d is None else d + term
        cands.append(F.struct(d.alias("d"), F.lit(int(cid)).alias("id")))
    best = F.array_min(F.array(*cands))
    out_df = df.withColumn("_best", best).withColumn(out, F.col("_best.id"))
    if dist_out:
        out_df = out_df.withColumn(dist_out, F.col("_best.d"))
    return out_df.drop("_best")


# --------------------------------------------------------------- centroids
def centroids(df: DataFrame, vec: str, label: str) -> DataFrame:
    """(label, n, centroid array<double>): one summary of whole vectors per label, combined map-side."""
    s = Summarizer.metrics("mean", "count").summary(array_to_vector(F.col(vec)))
    return (df.groupBy(label).agg(s.alias("s"))
            .select(label, F.col("s.count").alias("n"), vector_to_array("s.mean").alias("centroid")))


# ------------------------------------------------------------------ metrics
def _blocks(df: DataFrame, key: str, count: int, name: str) -> DataFrame:
    return (df.groupBy(F.pmod(F.xxhash64(key), F.lit(count)).alias(name))
            .agg(F.collect_list(F.struct(key, "vec", "labels")).alias(f"{name}_rows")))


def _distance_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks: every point of the first, and the sum of its
    distances to the second's points and their number, by labelling and label."""
    for batch in batches:
        for i in range(batch.num_rows):
            (ka, xa, _), (_, xb, lb) = ((s.field(0), np.stack(s.field(1).to_numpy(zero_copy_only=False)),
                                         np.array(s.field(2).to_pylist(), np.float64))
                                        for s in (batch.column(c)[i].values for c in ("a_rows", "b_rows")))
            d = np.zeros((len(xa), len(xb)))
            for j in range(xa.shape[1]):  # exact differences, one coordinate at a time
                d += (xa[:, j, None] - xb[None, :, j]) ** 2
            d = np.sqrt(d)
            out = []
            for m in range(lb.shape[1]):
                labels, at = np.unique(lb[~np.isnan(lb[:, m]), m], return_inverse=True)
                hot = np.eye(len(labels))[at]
                sums = d[:, ~np.isnan(lb[:, m])] @ hot
                n = hot.sum(axis=0)
                for c, label in enumerate(labels):
                    out.append((ka, np.full(len(xa), m), np.full(len(xa), label), sums[:, c], np.full(len(xa), n[c])))
            if out:
                keys = pa.concat_arrays([o[0] for o in out])
                m, other, total, n = (np.concatenate([o[j] for o in out]) for j in range(1, 5))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(m.astype(np.int32)), pa.array(other.astype(np.int64)), pa.array(total),
                     pa.array(n.astype(np.int64))], ["key", "labelling", "other", "total", "n"])


def silhouette_points(df: DataFrame, key: str, vec: str, labels: list[str]) -> DataFrame:
    """key, labelling (position in ``labels``), label, silhouette: the Euclidean
    silhouette of every row under each labelling; a null label means that the
    row is no part of that labelling. Singletons, and points of a labelling with
    one label, score 0.

    Distances are of all rows to all rows, so this is meant for a bounded
    sample: blocks of points meet blocks of points once, whatever the number of
    labellings, and only per-label sums leave a task.
    """
    pts = df.select(F.col(key).alias("key"), F.col(vec).alias("vec"),
                    F.array(*[F.col(x).cast("long") for x in labels]).alias("labels"))
    pts = materialize(pts.where(F.exists("labels", lambda x: x.isNotNull())), "silhouette-points")
    count = max(1, -(-pts.count() // BLOCK_ROWS))
    meet = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("b")
    pairs = (_blocks(pts, "key", count, "a").select("a", "a_rows", meet).join(_blocks(pts, "key", count, "b"), "b")
             .repartition(min(count * count, 20_000), "a", "b"))
    key_type = df.schema[key].dataType.simpleString()
    sums = (pairs.select("a_rows", "b_rows").mapInArrow(
                _distance_sums, f"key {key_type}, labelling int, other long, total double, n long")
            .groupBy("key", "labelling", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    own = pts.select("key", F.posexplode("labels").alias("labelling", "label")).where("label is not null")
    inside = F.col("other") == F.col("label")
    per = own.join(sums, ["key", "labelling"]).groupBy("key", "labelling", "label").agg(
        F.max(F.when(inside, F.col("n"))).alias("n"), F.max(F.when(inside, F.col("total"))).alias("total"),
        F.min(F.when(~inside, F.col("total") / F.col("n"))).alias("b"))
    a = F.col("total") / (F.col("n") - 1)
    top = F.greatest(a, F.col("b"))
    score = F.when((F.col("n") > 1) & F.col("b").isNotNull() & (top > 0), (F.col("b") - a) / top).otherwise(F.lit(0.0))
    return per.select(F.col("key").alias(key), "labelling", "label", score.alias("silhouette"))


def silhouette_samples(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """key, label, silhouette of every row."""
    return silhouette_points(df, key, vec, [label]).select(key, F.col("label").alias(label), "silhouette")


def _packed_points(d: int, labels: int):
    """applyInArrow over a block's points: a record of their features, those of equal labels side by side, and of where
    such a group begins and its labels."""

    def run(t: pa.Table) -> pa.Table:
        x = np.column_stack([t[f"f{j}"].to_numpy() for j in range(d)])
        of = np.column_stack([t[f"l{m}"].to_numpy() for m in range(labels)]).astype(np.int64)
        order = np.lexsort((*x.T, *of.T))
        x, of = x[order], of[order]
        begins = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]).any(axis=1)])
        return pa.table({"block": t["block"][:1].combine_chunks(), "x": pa.array([x.tobytes()], pa.binary()),
                         "begins": pa.array([begins.tobytes()], pa.binary()), "groups": pa.array([of[begins].tobytes()], pa.binary())})

    return run


def _unpacked_points(block: dict, d: int, labels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a block's points, the first point of each group and the groups' labels."""
    return (np.frombuffer(block["x"], np.float64).reshape(-1, d), np.frombuffer(block["begins"], np.int64),
            np.frombuffer(block["groups"], np.int64).reshape(-1, labels))


def _add_distances(out: np.ndarray, x: np.ndarray, y: np.ndarray, begins: np.ndarray, hot: np.ndarray) -> None:
    """Adds to ``out`` (row of x, label) the distances of the rows of x to all rows of y. ``begins``: the first row
    of each group of y, ``hot`` (group, label): 1 where it has the label.

    A tile's squared distances are one matrix product about the middle of its rows of y. Those so small beside its
    rows that the product's rounding would count are worked out again by coordinate; the error of any
    distance is below 1e-11 of the tile's extent."""
    high, wide = TILE
    space = np.empty((2, high * wide))
    for s in range(0, len(y), wide):
        b = y[s:s + wide]
        first, last = np.searchsorted(begins, s, "right") - 1, np.searchsorted(begins, s + len(b), "left")
        at, labels = np.maximum(begins[first:last] - s, 0), hot[first:last]
        middle = b.mean(axis=0)
        right, left = b - middle, x - middle
        b2, a2 = (right ** 2).sum(axis=1), (left ** 2).sum(axis=1)
        right = np.vstack([-2 * right.T, np.ones(len(b)), b2])
        left = np.column_stack([left, a2, np.ones(len(x))])
        for t in range(0, len(x), high):
            a = x[t:t + high]
            d, part = (v[:len(a) * len(b)].reshape(len(a), len(b)) for v in space)
            np.matmul(left[t:t + high], right, out=d)
            near = d < 1e-8 * (a2[t:t + high].max() + b2.max())
            found = np.count_nonzero(near)
            if found > d.size // 16:
                d[:] = 0
                for j in range(x.shape[1]):
                    np.subtract(a[:, j, None], b[None, :, j], out=part)
                    np.multiply(part, part, out=part)
                    d += part
            elif found:
                r, c = np.nonzero(near)
                d[r, c] = ((a[r] - b[c]) ** 2).sum(axis=1)
            np.sqrt(d, out=d)
            out[t:t + high] += np.add.reduceat(d, at, axis=1) @ labels


def _silhouettes(sums: np.ndarray, n: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The points' silhouettes in one labelling, from the sums of their distances to its clusters of sizes ``n``."""
    rows = np.arange(len(own))
    with np.errstate(invalid="ignore", divide="ignore"):
        a = sums[rows, own] / (n[own] - 1)
        mean = np.where(n > 0, sums / n, np.inf)
        mean[rows, own] = np.inf
        b = mean.min(axis=1)
        top = np.maximum(a, b)
        return np.where((n[own] < 2) | np.isposinf(b) | (top <= 0), 0.0, (b - a) / top)


def silhouette_means(df: DataFrame, features: list[str], labels: dict[str, int], key: str) -> list[float]:
    """The mean Euclidean silhouette of all rows under each labelling: columns of labels from 0, and how many there
    are. Singletons, and rows of a labelling with one label, score 0.

    All rows meet all rows, so the time grows with their square. They are dealt to blocks, and a task
    streams over the packed blocks to add up the distances of one block's rows by label; a distance is worked out once
    for all labellings. A task holds two blocks and a number for each row and label of one; each block is sent to each
    task, and a number for each labelling comes back."""
    d, m = len(features), len(labels)
    first = np.cumsum([0, *labels.values()])
    width = int(first[-1])
    rows = df.select(key, *[F.col(c).cast("double").alias(f"f{j}") for j, c in enumerate(features)],
                     *[(F.col(c) + int(first[i])).cast("int").alias(f"l{i}") for i, c in enumerate(labels)])
    rows = fixed_layout(rows, rows.columns).drop(key).withColumn("uid", F.monotonically_increasing_id())
    rows = materialize(rows, "silhouette-rows")
    n = rows.count()
    count = -(-n // min(max(-(-n // WHOLE_BLOCKS), BLOCK_ROWS), WHOLE_BLOCK_ROWS))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, sums, sizes, own = np.zeros((0, d)), np.zeros((0, width)), np.zeros(width), np.zeros((0, m), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                y, begins, groups = _unpacked_points({c: batch[c][i].as_py() for c in ("x", "begins", "groups")}, d, m)
                size = np.diff(np.r_[begins, len(y)])
                if batch["at"][i].as_py() == batch["block"][i].as_py():  # the task's own block is the first
                    x, sums, own = y, np.zeros((len(y), width)), np.repeat(groups, size, axis=0)
                hot = np.zeros((len(groups), width))
                hot[np.arange(len(groups))[:, None], groups] = 1
                sizes += size @ hot
                _add_distances(sums, x, y, begins, hot)
        total = [_silhouettes(sums[:, a:b], sizes[a:b], own[:, j] - a).sum() for j, (a, b) in enumerate(zip(first, first[1:], strict=False))]
        yield pa.RecordBatch.from_arrays([pa.array(range(m), pa.int32()), pa.array(total, pa.float64())], ["labelling", "s"])

    blocks = (rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(count)).cast("int")).repartition(count, "block")
              .groupBy("block").applyInArrow(_packed_points(d, m), "block int, x binary, begins binary, groups binary"))
    tasks = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))  # blocks are few: n / WHOLE_BLOCK_ROWS beyond WHOLE_BLOCKS
    met = blocks.select(tasks.alias("at"), "*").repartitionById(count, "at").sortWithinPartitions(F.col("at") != F.col("block"), "block")
    sums = met.mapInArrow(score, "labelling int, s double").groupBy("labelling").agg(F.sum("s").alias("s"))
    total = {r["labelling"]: r["s"] for r in sums.collect()}  # a row for each labelling
    return [total[i] / n for i in range(m)]


def _reference_sums(x: np.ndarray, refs: list[np.ndarray], replicate: list[np.ndarray], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """rows x clusters x replicates sums of Euclidean distances to the reference rows, and of their squares."""
    out, square = (np.zeros((len(x), len(refs), parts)) for _ in range(2))
    for c, (r, which) in enumerate(zip(refs, replicate, strict=True)):
        d2 = np.maximum(0.0, (x**2).sum(1)[:, None] - 2 * x @ r.T + (r**2).sum(1))
        d = np.sqrt(d2)
        for i in range(parts):
            out[:, c, i] = d[:, which == i].sum(axis=1)
            square[:, c, i] = d2[:, which == i].sum(axis=1)
    return out, square


def silhouette_replicates(x: np.ndarray, own: np.ndarray, key: np.ndarray, refs: list[np.ndarray], ref_keys: list[np.ndarray],
                          sizes: np.ndarray, centres: np.ndarray, spread: np.ndarray, parts: int) -> np.ndarray:
    """Sums of the rows' silhouettes, from all reference rows and with each of ``parts`` parts of them left out.

    A row's mean distance to a cluster is that to the cluster's reference rows,
    itself left out, corrected by how far their mean squared distance is from
    the cluster's, which is exact: |x - centre|^2 + spread (the cluster's mean
    squared distance to its centre). A cluster that is its own reference gives
    the exact mean."""
    replicate = [np.arange(len(r)) % parts for r in refs]
    sums, squares = _reference_sums(x, refs, replicate, parts)
    counts = np.array([[np.count_nonzero(w == i) for i in range(parts)] for w in replicate])
    counts = np.broadcast_to(counts, sums.shape).copy()
    for c, (keys, which) in enumerate(zip(ref_keys, replicate, strict=True)):
        place = {k: i for i, k in enumerate(keys.tolist())}
        for i in np.flatnonzero(own == c):
            at = place.get(key[i])
            if at is not None:
                counts[i, c, which[at]] -= 1
    rows, out = np.arange(len(x)), np.zeros(parts + 1)
    whole = np.array([len(r) for r in refs]) == sizes  # has no sampling error: it is never left out
    true = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1) + spread
    true[rows, own] *= sizes[own] / np.maximum(1, sizes[own] - 1)
    total, square, n = (v.sum(axis=2) for v in (sums, squares, counts))
    for i in range(parts + 1):
        gone = (0, 0, 0) if i == parts else tuple(np.where(whole, 0, v[:, :, i]) for v in (sums, squares, counts))
        m = n - gone[2]
        mean, mean2 = (np.divide(v, m, out=np.zeros(m.shape), where=m > 0) for v in (total - gone[0], square - gone[1]))
        root = np.sqrt(true)
        fix = np.divide(true - mean2, 2 * root, out=np.zeros(m.shape), where=(root > 0) & (m > 0))
        mean = np.maximum(0.0, np.where(whole, mean, mean + fix))
        a = mean[rows, own]
        mean[rows, own] = np.inf
        b = mean.min(axis=1)
        top = np.maximum(a, b)
        score = np.where((sizes[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)
        out[i] = score.sum()
    return out


def jackknife(sums: np.ndarray, n: int, z: float = 2.58) -> tuple[float, float, float]:
    """Estimate without its first-order bias, and an interval, from left-out-part means and the full one (last)."""
    means, parts = sums / n, len(sums) - 1
    left, full = means[:-1], means[-1]
    value = parts * full - (parts - 1) * left.mean()
    spread = z * np.sqrt((parts - 1) / parts * ((left - left.mean()) ** 2).sum())
    return float(value), float(value - spread), float(value + spread)


def silhouette_estimate(df: DataFrame, key: str, vec: str, label: str, reference: int = 256, parts: int = 16, seed: int = 42) -> DataFrame:
    """One row: n, silhouette, low, high: the mean Euclidean silhouette of all rows with an interval.

    Every row is scored, against ``reference`` rows of each cluster (the first in
    seeded hash order; all of a smaller cluster) and the cluster's exact mean
    squared distance, so the work is linear in the rows; clusters x reference rows
    are broadcast. Leaving out each of ``parts``
    parts of the references in turn gives the spread and removes the bias of the
    ratio. With every cluster within ``reference`` the value is exact and the
    interval empty. Fewer than two labels give 0."""
    from tillroll.operators.sampling import hash_key
    spark = df.sparkSession
    rows = materialize(df.select(F.col(key).cast("string").alias("key"), F.col(vec).cast("array<double>").alias("vec"), F.col(label).alias("label"))
                       .where("label is not null"), "silhouette-rows")
    stats = {s["label"]: s for s in cluster_stats(rows, "vec", "label")}
    sizes = {x: s["n"] for x, s in stats.items()}
    out = "n long, silhouette double, low double, high double"
    if len(sizes) < 2:
        return spark.createDataFrame([(sum(sizes.values()), 0.0, 0.0, 0.0)], out)
    labels = sorted(sizes)
    first = W.partitionBy("label").orderBy(hash_key("key", seed), "key")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= reference).orderBy("label", "r").collect()
    groups = [[r for r in few if r["label"] == x] for x in labels]
    refs, ref_keys = [np.array([r["vec"] for r in g]) for g in groups], [np.array([r["key"] for r in g]) for g in groups]
    size = np.array([sizes[x] for x in labels])
    centres, spread = np.array([stats[x]["centroid"] for x in labels]), np.array([stats[x]["W"] / stats[x]["n"] for x in labels])
    shared, place = spark.sparkContext.broadcast((refs, ref_keys)), {x: i for i, x in enumerate(labels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, ref_keys = shared.value
        total = np.zeros(parts + 1)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                b = batch.slice(a, 1024)
                x = np.array(b["vec"].to_pylist())
                own = np.array([place[v] for v in b["label"].to_pylist()])
                total += silhouette_replicates(x, own, np.array(b["key"].to_pylist()), refs, ref_keys, size, centres, spread, parts)
        yield pa.RecordBatch.from_arrays([pa.array(range(parts + 1), pa.int32()), pa.array(total)], ["part", "s"])

    sums = rows.mapInArrow(run, "part int, s double").groupBy("part").agg(F.sum("s").alias("s")).orderBy("part").collect()
    n = int(size.sum())
    return spark.createDataFrame([(n, *jackknife(np.array([r["s"] for r in sums]), n))], out)


def silhouette_squared(df: DataFrame, vec: str, label: str) -> float:
    """Mean silhouette by squared Euclidean distance over whole tables: linear in
    the rows, from per-cluster sums (0.0 when fewer than 2 labels)."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    if df.select(label).distinct().limit(2).count() < 2:
        return 0.0
    data = df.select(array_to_vector(F.col(vec)).alias("features"), F.col(label).cast("double").alias("prediction"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(data)


def cluster_stats(df: DataFrame, vec: str, label: str) -> list[dict]:
    """Per cluster: n, centroid, W (sum of squared distances to the centroid)
    and S (mean distance to it). Two aggregations; k rows are collected."""
    cents = centroids(df, vec, label)
    c = F.col("centroid")
    per = (join_small(df, cents, label, "inner").groupBy(label)
           .agg(F.first("n").alias("n"), F.first(c).alias("centroid"), F.sum(sq_dist(F.col(vec), c)).alias("W"),
                F.avg(F.sqrt(sq_dist(F.col(vec), c))).alias("S")))
    return [{"label": r[label], "n": r["n"], "centroid": np.array(r["centroid"]), "W": r["W"], "S": r["S"]}
            for r in per.collect()]


def metrics_from_stats(stats: list[dict]) -> dict:
    """inertia, davies_bouldin, calinski_harabasz from the k per-cluster rows."""
    k = len(stats)
    n = sum(s["n"] for s in stats)
    inertia = float(sum(s["W"] for s in stats))
    if k < 2:
        return {"inertia": inertia, "davies_bouldin": float("inf"), "calinski_harabasz": 0.0}
    cents = np.stack([s["centroid"] for s in stats])
    spread = np.array([s["S"] for s in stats])
    size = np.array([s["n"] for s in stats])
    between = float((size * ((cents - (size[:, None] * cents).sum(0) / n) ** 2).sum(axis=1)).sum())
    ch = 1.0 if inertia == 0 else between * (n - k) / (inertia * (k - 1))
    worst = []
    for i in range(k):  # one row of the k x k comparison at a time
        d = np.sqrt(((cents - cents[i]) ** 2).sum(axis=1))
        worst.append(np.divide(spread + spread[i], d, out=np.zeros(k), where=d > 0).max())
    return {"inertia": inertia, "davies_bouldin": float(np.mean(worst)), "calinski_harabasz": float(ch)}


def quality_summary(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """One row: n, k, inertia, silhouette, davies_bouldin, calinski_harabasz of
    exactly the rows of ``df``."""
    pts = materialize(df.select(key, label, vec), "quality-points")
    stats = cluster_stats(pts, vec, label)
    vals = metrics_from_stats(stats)
    score = silhouette_samples(pts, key, vec, label).agg(F.avg("silhouette")).first()[0] if len(stats) > 1 else 0.0
    return df.sparkSession.createDataFrame(
        [(sum(s["n"] for s in stats), len(stats), vals["inertia"], score, vals["davies_bouldin"],
          vals["calinski_harabasz"])],
        "n bigint, k bigint, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double")


# --------------------------------------------------------------- K-Means fit
@dataclass(frozen=True)
class KMeansFit:
    """Centroids (k x d), the sum of squared distances to them, and the passes taken."""

    centroids: np.ndarray
    cost: float
    passes: int


def _starts(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ seeding on weighted points with a few candidates for each centre."""
    cents = points[[rng.choice(len(points), p=weight / weight.sum())]]
    near = ((points - cents[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        share = near * weight
        total = share.sum()
        pick = rng.choice(len(points), 2 + int(np.log(k)), p=share / total if total > 0 else None)
        tries = np.minimum(near, ((points[None] - points[pick][:, None]) ** 2).sum(axis=2))
        best = (tries * weight).sum(axis=1).argmin()
        cents, near = np.vstack([cents, points[pick[best]]]), tries[best]
    return cents


def _hash_uniform(uid: np.ndarray, seed: int) -> np.ndarray:
    """A number in (0, 1) for each row id."""
    x = uid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53 + 2.0**-54


def _far_rows(chosen: list[np.ndarray], n: int, seeds: list[int], d: int):
    """mapInArrow over (f0.., uid): for each start ``n`` rows drawn with chances that follow the squared distance
    to the centres chosen so far (equal ones without a centre). A row's key is log(u) / weight, u being a hash of
    its id; the greatest keys of all rows are such a sample, so a task sends its n greatest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((0, d + 2)) for _ in chosen]  # key, place in ids, features
        ids: list[np.ndarray] = [np.zeros(0, np.int64) for _ in chosen]
        for batch in batches:
            whole = np.column_stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(d)])
            uids = batch.column(d).to_numpy()
            for a in range(0, len(whole), 4096):
                x, uid = whole[a:a + 4096], uids[a:a + 4096]
                for i, c in enumerate(chosen):
                    near = np.full(len(x), np.inf if len(c) else 1.0)
                    for centre in c:
                        np.minimum(near, ((x - centre) ** 2).sum(axis=1), out=near)
                    some = near > 0
                    key = np.log(_hash_uniform(uid[some], seeds[i])) / near[some]
                    rows = np.vstack([best[i], np.column_stack([key, np.zeros(len(key)), x[some]])])
                    uid_ = np.r_[ids[i], uid[some]]
                    top = np.lexsort((uid_, -rows[:, 0]))[:n]
                    best[i], ids[i] = rows[top], uid_[top]
        rows = np.concatenate(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), [len(x) for x in best]).astype(np.int32)), pa.array(rows[:, 0]),
             pa.array(np.concatenate(ids)), *[pa.array(rows[:, 2 + j]) for j in range(d)]],
            ["start", "key", "uid", *[f"f{j}" for j in range(d)]])

    return run


def seed_candidates(data: DataFrame, d: int, k: int, n_init: int, seed: int, rounds: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scalable seeding: for each start candidate centres and the rows nearest to each.

    ``data`` has f0.. and uid. A round draws 4 k rows for each start, by squared
    distance to those drawn before, in one pass over all rows for all starts;
    then all rows count for their nearest candidate. The driver gets 4 k rows a
    round and start."""
    schema = "start int, key double, uid long, " + ", ".join(f"f{j} double" for j in range(d))
    top = W.partitionBy("start").orderBy(F.desc("key"), "uid")
    chosen = [np.zeros((0, d)) for _ in range(n_init)]
    for step in range(rounds + 1):
        n = 4 * k if step else 1
        seeds = [int(np.random.default_rng([seed, i, step]).integers(2**63)) for i in range(n_init)]
        got = (data.mapInArrow(_far_rows(chosen, n, seeds, d), schema).withColumn("r", F.row_number().over(top))
               .where(F.col("r") <= n).orderBy("start", "r").collect())
        for i in range(n_init):
            new = [[r[f"f{j}"] for j in range(d)] for r in got if r["start"] == i]
            chosen[i] = np.vstack([chosen[i], new]) if new else chosen[i]
    sums = _sums(data, chosen, d)
    return [(c, t[:, d]) for c, t in zip(chosen, sums, strict=True)]


def _nearest(x: tuple[np.ndarray, ...], centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest centre of points given by feature, and the squared distance to it: a centre at a time, so
    that each step runs along the points."""
    at, near, dist, part = np.zeros(len(x[0]), np.intp), None, np.empty(len(x[0])), np.empty(len(x[0]))
    for i, centre in enumerate(centres):
        for j, v in enumerate(x):
            out = part if j else dist
            np.subtract(v, centre[j], out=out)
            np.multiply(out, out, out=out)
            if j:
                dist += part
        if near is None:
            near = dist.copy()
        else:
            np.copyto(at, i, where=dist < near)
            np.minimum(near, dist, out=near)
    return at, near


def _assign_and_add(models: list[np.ndarray], d: int):
    """mapInArrow over feature columns: for each model and centre the number of
    its points, their squared distances and their sums, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(c), d + 2)) for c in models]
        for batch in batches:
            whole = [batch.column(j).to_numpy(zero_copy_only=False) for j in range(d)]
            for x in zip(*(np.array_split(v, max(1, len(v) // 8192)) for v in whole), strict=True):
                for out, c in zip(sums, models, strict=True):
                    at, near = _nearest(x, c)
                    for j in range(d):
                        out[:, j] += np.bincount(at, x[j], len(c))
                    out[:, d] += np.bincount(at, minlength=len(c))
                    out[:, d + 1] += np.bincount(at, near, len(c))
        rows = np.concatenate(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(sums)), [len(s) for s in sums]).astype(np.int32)),
             pa.array(np.concatenate([np.arange(len(s)) for s in sums]).astype(np.int32)),
             pa.array(rows[:, d]), pa.array(rows[:, d + 1]), *[pa.array(rows[:, j]) for j in range(d)]],
            ["model", "centre", "n", "cost", *[f"s{j}" for j in range(d)]])

    return run


def _sums(data: DataFrame, models: list[np.ndarray], d: int) -> list[np.ndarray]:
    """For each model and centre the sums of its rows, their number and their squared distances."""
    sums = ["n", "cost", *[f"s{j}" for j in range(d)]]
    rows = (data.mapInArrow(_assign_and_add(models, d), "model int, centre int, " + ", ".join(f"{c} double" for c in sums))
            .groupBy("model", "centre").agg(*[F.sum(c).alias(c) for c in sums]).collect())
    total = [np.zeros((len(c), d + 2)) for c in models]
    for r in rows:
        total[r["model"]][r["centre"]] = [*[r[f"s{j}"] for j in range(d)], r["n"], r["cost"]]
    return total


def fit_kmeans_many(df: DataFrame, features: list[str], ks: list[int], seed: int = 42, n_init: int = 10,
                    max_iter: int = 300, tol: float = 1e-4) -> dict[int, KMeansFit]:
    """K-Means for every k, each the best of ``n_init`` starts.

    All starts of all k advance together: one pass over the rows assigns them
    under every model that still moves and adds up its centres, so the jobs are
    as many as the slowest model's iterations. Starts are seeded over all rows
    (``seed_candidates``), each from draws of its own, and reduced to k centres
    by weighted k-means++ on the driver. A model stops when the squared shift of
    its centres is at most ``tol`` times the mean feature variance. Ties go to
    the lower centre; an empty centre stays where it is. Spark adds the tasks'
    sums; the driver gets one row for each model and centre. Rows are numbered
    by a layout that the data alone decides. An empty table raises.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    rows = fixed_layout(rows, rows.columns, least=4)  # a pass over few rows is mostly the start of its tasks
    data = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "kmeans-rows")
    d = len(features)
    variance = data.agg(*[F.var_pop(f"f{j}") for j in range(d)]).first()
    if variance[0] is None:
        raise ValueError("K-Means needs at least one row")
    stop = tol * float(np.mean([v or 0.0 for v in variance]))
    data = data.persist()
    best: dict[int, KMeansFit] = {}
    try:
        seeds = seed_candidates(data, d, max(ks), n_init, seed)
        moving = [(k, _starts(*seeds[i], k, np.random.default_rng([seed, k, i])), False) for k in ks for i in range(n_init)]
        for step in range(1, max_iter + 2):
            total = _sums(data, [c for _, c, _ in moving], d)
            still = []
            for (k, c, settled), t in zip(moving, total, strict=True):
                cost = float(t[:, d + 1].sum())
                if settled or step > max_iter:
                    if k not in best or cost < best[k].cost:
                        best[k] = KMeansFit(c, cost, step)
                    continue
                new = np.where(t[:, [d]] > 0, t[:, :d] / np.maximum(t[:, [d]], 1), c)
                still.append((k, new, float(((new - c) ** 2).sum()) <= stop))
            moving = still
            if not moving:
                break
    finally:
        data.unpersist()
    return best


def fit_kmeans(df: DataFrame, features: list[str], k: int = 4, seed: int = 42, n_init: int = 10,
               max_iter: int = 300, tol: float = 1e-4) -> KMeansFit:
    """K-Means, the best of ``n_init`` starts (see ``fit_kmeans_many``)."""
    return fit_kmeans_many(df, features, [k], seed, n_init, max_iter, tol)[k]


def relabel_by(df: DataFrame, cluster: str, by: str, descending: bool = True) -> DataFrame:
    """Renumber cluster ids 0..k-1 by the mean of ``by`` (ids from a fit are arbitrary)."""
    order = F.col("_m").desc() if descending else F.col("_m").asc()
    ranks = (df.groupBy(cluster).agg(F.avg(by).alias("_m"))
             .withColumn("_new", F.row_number().over(W.orderBy(order, F.col(cluster))) - 1))
    return join_small(df, ranks.select(cluster, "_new"), cluster).withColumn(cluster, F.col("_new").cast("int")).drop("_new")


def model_centroids(model: KMeansFit) -> list[tuple[int, list[float]]]:
    return [(i, [float(x) for x in c]) for i, c in enumerate(model.centroids)]


def cluster_safe_labels(df: DataFrame, labels: list[str], key: str, n: int = METRIC_SAMPLE, seed: int = 42) -> DataFrame:
    """The cluster-safe sample of every labelling in one frame: ``labels`` are
    null where a row is not in that labelling's sample.

    The seeded order is taken once. Each labelling has the first row of each of
    its labels and, of the others in seeded order, as many as make up n.
    """
    if df.count() <= n:
        return df
    firsts = {x: df.groupBy(x).agg(F.min(key).alias(key)).select(key, F.lit(True).alias(f"_first_{x}")) for x in labels}
    out = df
    for first in firsts.values():
        out = join_small(out, first, key, "left")
    any_first = F.lit(False)
    for x in labels:
        any_first = any_first | F.col(f"_first_{x}").isNotNull()
    from tillroll.operators.sampling import random_sample
    top = random_sample(df.select(key), n, key, seed, tiebreak=[key])  # n rows
    top = top.withColumn("_order", F.row_number().over(W.orderBy(hash_key(key, seed), key)))
    out = materialize(out.join(F.broadcast(top), key, "left").where(any_first | F.col("_order").isNotNull()), "safe-sample")
    for x in labels:
        first = F.col(f"_first_{x}").isNotNull()
        k = out.where(first).count()
        before = F.count_if(first).over(W.orderBy(F.col("_order").asc_nulls_last()))  # at most n rows and the firsts
        taken = first | (F.col("_order").isNotNull() & (F.col("_order") - before <= n - k))
        out = out.withColumn("_in", taken).withColumn(x, F.when(F.col("_in"), F.col(x))).drop("_in")
    return out.select(df.columns)


def k_sweep(df: DataFrame, features: list[str], key: str = CUSTOMER, ks=range(2, 11), seed: int = 42,
            n_init: int = 10, max_iter: int = 300, tol: float = 1e-4) -> DataFrame:
    """(k, inertia, silhouette) for each k: the elbow table.

    Inertia and silhouette are those of all rows; their distances are worked out once for all k.
    """
    ks = list(ks)
    fits = fit_kmeans_many(df, features, ks, seed, n_init, max_iter, tol)
    labels = {f"_k{k}": k for k in ks}
    lab = df.select(key, *features)
    for x, k in labels.items():
        lab = assign_nearest(lab, features, model_centroids(fits[k]), out=x)
    scores = silhouette_means(lab, features, labels, key)
    return df.sparkSession.createDataFrame([(k, fits[k].cost, s) for k, s in zip(ks, scores, strict=True)],
                                           "k int, inertia double, silhouette double")
