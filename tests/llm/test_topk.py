import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm.topk import SortedLists, exact_type, rounds, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, modulus):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i % modulus == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(ok) if b != a)  # noqa: B905
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, k=20, modulus=20, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    got = top_k(df, F.col("vec_id") % modulus == 0, k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("kw", [{}, {"block_rows": 37, "query_rows": 5}, {"block_rows": 11, "query_rows": 7, "growth": 2}])
def test_against_brute_force(spark, kw):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.2, (300, 8)).astype(np.float32))]
    assert search(spark, rows, **kw) == brute(rows, 20, 20)


def test_ties_copies_and_bad_vectors(spark):
    same = [0.5, -0.25, 0.0]
    rows = [(i, same) for i in range(70)] + [(i, [0.1 * (i % 3), -0.2, 0.3]) for i in range(70, 140)]
    rows += [(200, None), (220, [1.0, None, 2.0]), (240, [float("nan"), 1.0, 1.0]), (260, [float("inf"), 1.0, 1.0]),
             (280, []), (300, [0.0, 0.0, 0.0]), (320, [1.0]), (340, [-1e6, 2e6, 1.0]), (None, same)]
    assert search(spark, rows, block_rows=16, query_rows=4) == brute(rows, 20, 20)


def test_repeated_rows_are_candidates_of_each_other(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5])]
    got = search(spark, rows)
    assert got == sorted([(0, 1, 0, 4096), (0, 2, 1, 2048)] * 2)


def test_few_candidates_and_empty_table(spark):
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 8192)]
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_stops_early_where_the_bound_allows():
    rng = random.Random(3)
    v = np.zeros((5000, 4))
    v[:, 0] = np.arange(5000)  # one dimension decides
    v[:, 1:] = [[rng.randrange(3) for _ in range(3)] for _ in range(5000)]
    lists = SortedLists(np.arange(5000), np.arange(5000), v)
    query = np.array([10.0, 1, 0, -1])
    rows, scores, scored = lists.search(-1, query, lists.bounds(query[None])[0], 5)
    want = v @ np.array([10.0, 1, 0, -1])
    assert sorted(scores, reverse=True) == sorted(want, reverse=True)[:5] and scored < 1000


@pytest.mark.parametrize("over", [-1, 0, 1])
def test_a_floor_drops_only_what_is_below_it(over):
    rng = np.random.default_rng(5)
    v = rng.integers(-9, 10, (3000, 3))
    q, k = np.array([7, -3, 2]), 6
    lists = SortedLists(np.arange(3000), np.arange(3000), v)
    want = sorted(((-s, i) for i, s in enumerate((v @ q).tolist()) if i != 4))[:k]
    floor = -want[-1][0] + over
    bounds = lists.bounds(q[None])[0]
    rows, scores, scored = lists.search(4, q, bounds, k, floor)
    assert list(zip((-scores).tolist(), rows.tolist(), strict=True)) == [w for w in want if -w[0] >= floor]
    assert scored <= lists.search(4, q, bounds, k)[2] < 3000


def test_rounds_cover_every_block_once():
    assert list(rounds(300, 16)) == [(0, 1), (1, 16), (16, 256), (256, 300)]
    for count in (1, 2, 16, 17):
        assert [b for first, last in rounds(count, 16) for b in range(first, last)] == list(range(count))


def test_scores_beyond_the_range_of_a_long_wrap_round(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-3, 4, 3) * 2.0**25).tolist()) for i in range(200)]  # 64 x 2^25 squared is 2^62
    as_long = lambda s: (s + 2**63) % 2**64 - 2**63
    v = [[int(x) * 64 for x in r] for _, r in rows]
    want = []
    for i in range(0, 200, 20):
        best = sorted((-as_long(sum(x * y for x, y in zip(v[i], v[j], strict=True))), j) for j in range(200) if j != i)
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best[:20])]
    assert search(spark, rows, block_rows=30, query_rows=4) == sorted(want)


def test_number_type_never_rounds():
    a = np.full((2, 4), 2**20, np.int64)
    assert exact_type(a // 2**18, a // 2**18) is np.float32
    assert exact_type(a, a) is np.float64 and exact_type(a * 2**12, a) is np.int64


def test_clashing_columns(spark):
    df = spark.createDataFrame([(0, [1.0], 1, 2, 3), (1, [1.0], 1, 2, 3)], "vec_id long, embedding array<float>, uid int, v int, score int")
    row, = top_k(df, F.col("vec_id") == 0).collect()
    assert row.asDict() == {"query_id": 0, "rank": 1, "vec_id": 1, "score": 4096}
