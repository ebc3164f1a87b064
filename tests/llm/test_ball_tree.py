import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import ball_tree
from tillroll.llm.ball_tree import NO_ID, Plan, bound_of, build_tree, fit_pivots, nearest, rank_documents, search_tree, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, uid long, score string"


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    docs = [(i, Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs]
    held = [d for d in docs if d[2]]
    n, total = len(held), sum(d[2] for d in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def ranked(spark, make_docs, docs, items, k=50, parts=3, **plan):
    frame = spark.createDataFrame([(*x, 7, "x") for x in items], ITEMS)
    extra = make_docs(docs, parts).selectExpr("*", "1 as uid", "2 as pivot", "3 as grp", "4 as score")
    got = rank_documents(extra, frame, k, Plan(**plan))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = [[f"{p}{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] for p in ("x", "é", "ü")]
    docs = []
    for i in range(n):
        pool = rng.choice(words)
        docs.append((i, " ".join(pool[min(int(rng.expovariate(0.05)), 143)].title() + rng.choice(["", ",", "."])
                                 for _ in range(rng.randrange(1, 80)))))
    items = [(j, " ".join(pool[min(int(rng.expovariate(0.03)), 143)] for _ in range(12))) for j, pool in enumerate(words * 4)]
    return docs, items


SMALL = {"pivots": 3, "group_rows": 40, "leaf_rows": 4, "sample_rows": 50}


@pytest.mark.parametrize("plan", [{}, SMALL, {**SMALL, "block_terms": 40, "first_groups": 1}, {**SMALL, "group_rows": 1}])
def test_against_brute_force(spark, make_docs, plan):
    docs, items = corpus(120 if plan.get("group_rows") == 1 else 400)
    assert ranked(spark, make_docs, docs, items, 10, **plan) == brute(docs, items, 10)


def test_ties_copies_and_odd_input(spark, make_docs):
    docs, items = corpus(150)
    docs += [(1000 + i, "the same text 12 times") for i in range(120)] + [(5, "the same text 12 times")] * 3
    docs += [(None, "the same text 12 times"), (None, None), (900, None), (901, ""), (902, " -- "), (903, "xaa " * 200_000), (904, "Ünder 12 é")]
    items += [(50, "same TEXT"), (50, "same TEXT"), (None, "12"), (51, None), (52, ""), (53, "no such thing"), (54, "xaa xaa"), (55, "ünder Ünder É")]
    assert ranked(spark, make_docs, docs, items, **SMALL) == brute(docs, items)


def test_null_ids_come_last(spark, make_docs):
    docs = [(None, "a b"), (7, "a b"), (3, "a b"), (4, "c")]
    assert ranked(spark, make_docs, docs, [(1, "a")]) == sorted(brute(docs, [(1, "a")]), key=str)
    assert [r[2] for r in brute(docs, [(1, "a")])] == [3, 7, None]


def test_empty_tables(spark, make_docs):
    assert ranked(spark, make_docs, [], [(1, "a")], parts=1) == []
    assert ranked(spark, make_docs, [(1, "a")], []) == []
    assert ranked(spark, make_docs, [(1, None)], [(1, "a")]) == []


def random_tree(seed, n=300, vocabulary=60, leaf_rows=4):
    rng = np.random.default_rng(seed)
    kind = rng.integers(0, 3, n)
    docs = [np.unique(rng.integers(20 * x, 20 * x + 20, rng.integers(1, 15))) if rng.random() < 0.9 else np.zeros(0, np.int64) for x in kind]
    sizes = np.array([len(d) for d in docs])
    terms = np.concatenate(docs)
    gain = rng.integers(1, 1_000_000, len(terms))
    weights = rng.integers(0, 9000, vocabulary).astype(float)
    return build_tree(np.arange(n), sizes, terms, gain, leaf_rows), docs, gain, weights, rng


def plain_scores(docs, gain, weights, query):
    out, at = [], 0
    for d in docs:
        out.append(sum(int(weights[t]) * int(g) for t, g in zip(d, gain[at:at + len(d)], strict=True) if t in query))
        at += len(d)
    return np.array(out)


@pytest.mark.parametrize("seed", range(8))
def test_bounds_hold_and_the_search_is_exact(seed):
    tree, docs, gain, weights, rng = random_tree(seed)
    for _ in range(10):
        query = np.unique(rng.integers(0, 60, 8))
        want = plain_scores(docs, gain, weights, set(query.tolist()))
        for node in range(len(tree.start)):
            assert want[tree.ids[tree.start[node]:tree.end[node]]].max() <= bound_of(node, tree, query, weights[query])
        for floor in (1, int(np.sort(want)[-20])):
            ids, scores, scored = search_tree(tree, query, weights.astype(np.int64), 10, max(1, floor))
            best = [i for i in np.lexsort((np.arange(len(want)), -want))[:10] if want[i] >= max(1, floor)]
            assert ids.tolist() == best and scores.tolist() == want[best].tolist() and scored <= len(docs)


def test_the_bound_prunes_and_nodes_cover_their_documents():
    tree, docs, gain, weights, _ = random_tree(1, n=3000, leaf_rows=16)
    assert sorted(tree.ids.tolist()) == list(range(3000)) and tree.start[0] == 0 and tree.end[0] == 3000
    for i in range((len(tree.start) - 1) // 2):
        assert (tree.start[i], tree.end[i]) == (tree.start[2 * i + 1], tree.end[2 * i + 2])
    copy = ball_tree.Tree.unpacked(tree.packed())
    query = np.array([3, 8, 15])
    got = [search_tree(t, query, weights.astype(np.int64), 10) for t in (tree, copy)]
    assert got[0][0].tolist() == got[1][0].tolist() and got[0][2] == got[1][2] < 1500


def test_pivots_of_equal_and_few_rows():
    assert fit_pivots(np.zeros((0, ball_tree.SKETCH)), 4).shape == (1, ball_tree.SKETCH)
    same = np.ones((9, ball_tree.SKETCH))
    assert nearest(same, fit_pivots(same, 4)).tolist() == [0] * 9


def test_terms():
    for t in ["", "A-b_c9", "ÉTÉ 12x", *map(chr, range(300)), "".join(map(chr, range(300)))]:
        assert [x.decode() for x in terms_of(t.encode())] == plain_terms(t)
    assert NO_ID == 2**63 - 1


def test_query_against_brute_force(spark):
    from tillroll.llm.queries import op13_ranked_search
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").select(i, "text").collect() for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = sorted((tuple(r) for r in op13_ranked_search(spark, sf).collect()), key=str)
    assert got == brute([tuple(r) for r in docs], [tuple(r) for r in items])
