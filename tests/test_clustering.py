"""Cluster quality metrics against brute-force numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import clustering as CL


def _points(spark, n=60, k=3, d=4, seed=0, singleton=True, sep=3.0):
    rng = np.random.default_rng(seed)
    X = np.concatenate([rng.normal(i * sep, 1.0, size=(n // k, d)) for i in range(k)])
    L = np.repeat(np.arange(k), n // k)
    if singleton:
        X = np.vstack([X, rng.normal(20, 1, size=(1, d))])
        L = np.append(L, k)
    rows = [(int(i), int(l), [float(v) for v in x]) for i, (x, l) in enumerate(zip(X, L))]
    return spark.createDataFrame(rows, "id long, label long, vec array<double>"), X, L


def _brute(X, L):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    labs = np.unique(L)
    s = np.zeros(len(X))
    for i in range(len(X)):
        own = L == L[i]
        if own.sum() <= 1:
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, L == l].mean() for l in labs if l != L[i])
        s[i] = (b - a) / max(a, b)
    cents = np.array([X[L == l].mean(0) for l in labs])
    S = np.array([np.linalg.norm(X[L == l] - cents[j], axis=1).mean() for j, l in enumerate(labs)])
    cd = np.sqrt(((cents[:, None] - cents[None]) ** 2).sum(-1))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = (S[:, None] + S[None]) / cd
    r[~np.isfinite(r)] = 0
    db = r.max(1).mean()
    g = X.mean(0)
    B = sum((L == l).sum() * ((cents[j] - g) ** 2).sum() for j, l in enumerate(labs))
    W = sum(((X[L == l] - cents[j]) ** 2).sum() for j, l in enumerate(labs))
    ch = B * (len(X) - len(labs)) / (W * (len(labs) - 1))
    return s, db, ch, W


def test_quality_metrics_match_bruteforce(spark):
    df, X, L = _points(spark)
    s, db, ch, W = _brute(X, L)
    q = CL.quality_summary(df, "id", "vec", "label").first()
    assert q["silhouette"] == pytest.approx(s.mean(), rel=1e-9)
    assert q["davies_bouldin"] == pytest.approx(db, rel=1e-9)
    assert q["calinski_harabasz"] == pytest.approx(ch, rel=1e-9)
    assert q["inertia"] == pytest.approx(W, rel=1e-9)
    per = {r["id"]: r["silhouette"] for r in CL.silhouette_samples(df, "id", "vec", "label").collect()}
    assert [per[i] for i in range(len(X))] == pytest.approx(s.tolist(), abs=1e-9)


def test_one_label(spark):
    df = spark.createDataFrame([(i, 0, [float(i), 1.0]) for i in range(3000)], "id long, label long, vec array<double>")
    q = CL.quality_summary(df, "id", "vec", "label").first()
    assert (q["n"], q["k"], q["silhouette"], q["davies_bouldin"], q["calinski_harabasz"]) == (3000, 1, 0.0, float("inf"), 0.0)
    assert CL.silhouette_squared(df, "vec", "label") == 0.0


def test_metrics_cover_exactly_the_rows_given(spark, monkeypatch):
    monkeypatch.setattr(CL, "BLOCK_ROWS", 17)  # many blocks
    df, X, L = _points(spark, n=300, k=3, singleton=True)
    per = CL.silhouette_samples(df, "id", "vec", "label").collect()
    assert sorted(r["id"] for r in per) == list(range(len(X)))
    want = _brute(X, L)[0]
    assert [r["silhouette"] for r in sorted(per, key=lambda r: r["id"])] == pytest.approx(want.tolist(), abs=1e-9)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_silhouette_keeps_the_key_type(spark, kind):
    df, X, L = _points(spark)
    out = CL.silhouette_samples(df.withColumn("id", F.col("id").cast(kind)), "id", "vec", "label")
    assert dict(out.dtypes)["id"] == kind and out.count() == len(X)


def test_silhouette_squared_against_brute_force(spark):
    df, X, L = _points(spark, singleton=False)
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    s = []
    for i in range(len(X)):
        own = L == L[i]
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, L == x].mean() for x in np.unique(L) if x != L[i])
        s.append((b - a) / max(a, b))
    assert CL.silhouette_squared(df, "vec", "label") == pytest.approx(np.mean(s), rel=1e-6)


def test_safe_labels_equal_one_sample_for_each_labelling(spark):
    from tillroll.operators import sampling as SM
    df = spark.createDataFrame([(i, i % 3, (i * 7) % 11) for i in range(500)], "id long, a int, b int").repartition(3)
    got = CL.cluster_safe_labels(df, ["a", "b"], "id", n=40).collect()
    for x in ("a", "b"):
        want = {r["id"] for r in SM.cluster_safe_sample(df, x, "id", n=40).collect()}
        assert {r["id"] for r in got if r[x] is not None} == want and len(want) == 40


def test_sweep_fits_every_k_and_scores_the_whole_sample(spark):
    df, X, L = _points(spark, n=90, k=3, singleton=False, sep=20.0)
    flat = df.select("id", *[F.col("vec")[i].alias(f"f{i}") for i in range(4)])
    rows = {r["k"]: r for r in CL.k_sweep(flat, [f"f{i}" for i in range(4)], "id", ks=[2, 3, 4]).collect()}
    assert rows[2]["inertia"] > rows[3]["inertia"] > rows[4]["inertia"]
    assert rows[3]["inertia"] == pytest.approx(_brute(X, L)[3], rel=1e-9)  # the blobs are found
    assert rows[3]["silhouette"] == pytest.approx(_brute(X, L)[0].mean(), rel=1e-9)


def _mean_silhouettes(X, labels):
    """Brute force over all rows, a few rows at a time."""
    total = np.zeros(len(labels))
    for i in range(0, len(X), 500):
        D = np.sqrt(((X[i:i + 500, None, :] - X[None, :, :]) ** 2).sum(-1))
        for m, L in enumerate(labels):
            ids, n = np.unique(L, return_counts=True)
            sums = np.stack([D[:, L == c].sum(axis=1) for c in ids], axis=1)
            own = np.searchsorted(ids, L[i:i + 500])
            r = np.arange(len(own))
            a, mean = sums[r, own] / np.maximum(n[own] - 1, 1), sums / n
            mean[r, own] = np.inf
            b = mean.min(axis=1)
            ok = (n[own] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0)
            total[m] += ((b - a)[ok] / np.maximum(a, b)[ok]).sum()
    return total / len(X)


def test_sweep_scores_all_rows(spark):
    rng = np.random.default_rng(11)
    X = np.vstack([rng.normal(size=(9000, 2)), rng.normal([3, 1], 0.5, size=(3000, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(X)], "id long, a double, b double")
    got = CL.k_sweep(df, ["a", "b"], "id", ks=[2, 3], n_init=1).collect()
    fits = CL.fit_kmeans_many(df, ["a", "b"], [2, 3], n_init=1)
    labels = [((X[:, None] - fits[k].centroids[None]) ** 2).sum(-1).argmin(axis=1) for k in (2, 3)]
    assert [r["silhouette"] for r in got] == pytest.approx(_mean_silhouettes(X, labels).tolist(), rel=1e-9)


def test_whole_silhouettes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(CL, "BLOCK_ROWS", 170)  # many blocks
    monkeypatch.setattr(CL, "TILE", (16, 64))
    rng = np.random.default_rng(12)
    X = np.vstack([rng.normal(size=(500, 3)), rng.normal(size=(300, 3)).round(), np.tile([[1.0, 2.0, 3.0]], (150, 1)), [[1e6, 0, 0], [1e6, 1e-7, 0]],
                   1e5 + rng.normal(scale=1e-4, size=(48, 3))])  # equal rows, far ones and close ones among them
    labels = [rng.integers(0, 2, len(X)), np.where(X[:, 0] > 0, 4, X[:, 1] > 0) - (X[:, 0] > 2), np.zeros(len(X), int), np.arange(len(X)) // 999]
    rows = [(None if i % 5 == 0 else i // 3, *map(float, x), *[int(v[i]) for v in labels]) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, p int, q int, r int, s int").repartition(3)
    got = CL.silhouette_means(df, ["a", "b", "c"], {"p": 2, "q": 6, "r": 1, "s": 2}, "id")  # q has empty clusters, r one, s a row alone
    assert got == pytest.approx(_mean_silhouettes(X, labels).tolist(), abs=1e-10)
    assert CL.silhouette_means(df.select("id", "a", "p"), ["a"], {"p": 2}, "id") == pytest.approx(_mean_silhouettes(X[:, :1], labels[:1]).tolist(), abs=1e-10)


def test_fit_does_not_depend_on_the_layout(spark):
    df, _, _ = _points(spark, n=120, k=3, singleton=False, sep=1.0)
    flat = df.select("id", *[F.col("vec")[i].alias(f"f{i}") for i in range(4)])
    a, b = (CL.fit_kmeans(flat.repartition(p), [f"f{i}" for i in range(4)], k=5) for p in (1, 7))
    assert np.allclose(a.centroids, b.centroids) and a.cost == pytest.approx(b.cost)


def _weighted_kmeans(points, weight, k, starts=200):
    """The least cost of plain Lloyd passes on weighted points from many starts."""
    rng, best = np.random.default_rng(0), np.inf
    for _ in range(starts):
        c = points[rng.choice(len(points), k, replace=False)]
        for _ in range(100):
            at = ((points[:, None] - c[None]) ** 2).sum(-1).argmin(1)
            new = np.array([np.average(points[at == i], axis=0, weights=weight[at == i]) if (at == i).any() else c[i] for i in range(k)])
            if np.allclose(new, c):
                break
            c = new
        best = min(best, (((points[:, None] - c[None]) ** 2).sum(-1).min(1) * weight).sum())
    return best


def test_a_third_of_equal_rows_costs_what_the_grouped_table_costs(spark):
    rng = np.random.default_rng(4)
    X = np.vstack([rng.normal(size=(120, 2)), np.tile([[6.0, 6.0]], (100, 1)), rng.normal([-7, 5], 0.5, size=(80, 2))])
    df = spark.createDataFrame([tuple(map(float, x)) for x in X], "a double, b double").repartition(5)
    points, weight = np.unique(X, axis=0, return_counts=True)
    for k in (3, 4):
        assert CL.fit_kmeans(df, ["a", "b"], k=k).cost == pytest.approx(_weighted_kmeans(points, weight, k), rel=1e-3)


def test_candidates_are_drawn_from_all_rows_for_each_start(spark):
    rng = np.random.default_rng(5)
    rows = [(float(x), float(y), i) for i, (x, y) in enumerate(rng.normal(size=(500, 2)))] + [(50.0, 50.0, 500)]
    schema = "f0 double, f1 double, uid long"
    one, many = (CL.seed_candidates(spark.createDataFrame(rows, schema).repartition(p), 2, 3, 4, 7) for p in (1, 9))
    for (a, n), (b, m) in zip(one, many, strict=True):
        assert np.array_equal(a, b) and np.array_equal(n, m)  # whatever the partitions
        assert len(a) == 1 + 3 * 12 and n.sum() == 501 and (a == 50).all(axis=1).any()  # the far row is found
    assert len({c.tobytes() for c, _ in one}) == 4
    few = CL.seed_candidates(spark.createDataFrame([(1.0, 1.0, 0), (1.0, 1.0, 1)], schema), 2, 3, 2, 7)
    assert [(c.tolist(), n.tolist()) for c, n in few] == [([[1.0, 1.0]], [2.0])] * 2
    equal = CL.fit_kmeans(spark.createDataFrame([(1.0, 1.0)] * 9, "a double, b double"), ["a", "b"], k=3, n_init=2)
    assert equal.cost == 0.0 and equal.centroids.shape == (3, 2)
    with pytest.raises(ValueError, match="at least one row"):
        CL.fit_kmeans(spark.createDataFrame([], "a double, b double"), ["a", "b"])


def test_assign_nearest_ties_to_lowest_id(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 0.0)], "x double, y double")
    cents = [(5, [1.0, 0.0]), (2, [-1.0, 0.0]), (7, [3.0, 0.0])]
    out = [r["Cluster"] for r in CL.assign_nearest(df, ["x", "y"], cents).orderBy("x").collect()]
    assert out == [2, 5]


def test_kmeans_fit_recovers_blobs(spark):
    df, X, L = _points(spark, n=90, k=3, singleton=False, sep=20.0)
    flat = df.select("id", *[F.col("vec")[i].alias(f"f{i}") for i in range(4)])
    model = CL.fit_kmeans(flat, [f"f{i}" for i in range(4)], k=3, seed=1)
    lab = CL.assign_nearest(flat, [f"f{i}" for i in range(4)], CL.model_centroids(model))
    pairs = {(int(L[r["id"]]), r["Cluster"]) for r in lab.collect()}
    assert len(pairs) == 3


def test_nearest_centre_works_along_the_points():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3)).round(1)
    centres = np.vstack([x[:4], x[:2]])  # equal centres: the first wins
    at, near = CL._nearest(tuple(x.T), centres)
    dist = sum((x[:, j, None] - centres[None, :, j]) ** 2 for j in range(3))
    assert (at == dist.argmin(axis=1)).all() and (near == dist.min(axis=1)).all()
