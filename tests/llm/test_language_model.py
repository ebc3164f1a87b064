import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import language_model as lm
from tillroll.llm.common import crc_mod


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]  # None: the end


def corpus(n=120, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["The", "É", "of"]
    out = []
    for i in range(n):
        at, text = rng.randrange(30), []
        for _ in range(rng.randrange(60)):
            at = (at * 7 + rng.choice([1, 1, 1, 2, 5])) % 33
            text.append(words[at])
        out.append((i, " ".join(text)))
    return out


def is_learn(d):
    return d is not None and d % 4 != 0


def is_deleted(d):
    return d is not None and d % 4 == 1


def score(make_docs, docs, parts=3, **kw):
    df = make_docs(docs, parts)
    return lm.score_texts(df, F.col("doc_id") % 4 != 0, F.col("doc_id") % 4 == 1, **kw).collect()


def plain(docs):
    """counts and the interpolated score with given weights, by loops"""
    uni, bi, ctx = Counter(), Counter(), Counter()
    for d, t in docs:
        if is_learn(d):
            seq = ["<s>", *tokens(t)]
            uni.update(seq[1:])
            bi.update(zip(seq, seq[1:]))  # noqa: B905
            ctx.update(seq[:-1])
    n, v = sum(uni.values()), len(uni)

    def of(text, weights):
        seq = ["<s>", *tokens(text)]
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in seq[1:])
        total = 0.0
        for a, b in zip(seq, seq[1:]):  # noqa: B905
            k = ctx[a].bit_length()
            p2 = bi[a, b] / ctx[a] if ctx[a] else 0.0
            total += math.log10(weights[k][0] * p2 + weights[k][1] * uni[b] / n + weights[k][2] / (v + 1))
        return len(seq) - 1, sum(uni[w] > 0 for w in seq[1:]), n, base, total

    return of


@pytest.mark.parametrize("chunk", [2_000_000, 50])
def test_scores_against_plain(make_docs, monkeypatch, chunk):
    docs = corpus() + [(901, None), (902, ""), (905, "unseen words only here xyz"), (904, " of\x0bThe\x1c "), (906, "w1 " * 4000)]
    seen = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda h: seen.setdefault("w", learn(h)))
    rows = {r["doc_id"]: r for r in score(make_docs, docs, chunk_tokens=chunk)}
    assert len(rows) == len(docs)
    of = plain(docs)
    for d, t in docs:
        want, r = of(t, seen["w"]), rows[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3], abs=1e-6) and r["score"] == pytest.approx(want[4], abs=1e-6)
    held = [d for d, _ in docs if d % 4 == 0 and d < 900]
    assert sum(rows[d]["score"] for d in held) > sum(rows[d]["base_score"] for d in held) * 0.8


def test_weights_are_those_of_plain_em_on_the_deleted_block(make_docs):
    docs = corpus(300)
    got = {}
    original = lm.held_out_histogram

    class Spy(Exception):
        pass

    def stop(chunks, answers, totals):
        got["h"], got["t"] = original(chunks, answers, totals), totals
        raise Spy

    lm.held_out_histogram = stop
    try:
        with pytest.raises(Spy):
            score(make_docs, docs)
    finally:
        lm.held_out_histogram = original
    kept = [(d, t) for d, t in docs if is_learn(d) and not is_deleted(d)]
    uni, bi, ctx = Counter(), Counter(), Counter()
    for _, t in kept:
        seq = ["<s>", *tokens(t)]
        uni.update(seq[1:])
        bi.update(zip(seq, seq[1:]))  # noqa: B905
        ctx.update(seq[:-1])
    n, v = sum(uni.values()), len(uni)
    assert (got["t"].tokens, got["t"].words) == (n, v)
    deleted = [(a, b) for d, t in docs if is_deleted(d) for seq in [["<s>", *tokens(t)]] for a, b in zip(seq, seq[1:])]  # noqa: B905
    assert got["h"][:, 3].sum() == len(deleted)
    w = lm.learn_weights(got["h"])
    assert np.allclose(w.sum(axis=1), 1) and (w[:, 2] > 0).all() and w[0, 0] == 0
    # exact EM for the fullest class, from the exact estimates
    k = Counter(ctx[a].bit_length() for a, _ in deleted).most_common(1)[0][0]
    p = np.array([[bi[a, b] / ctx[a], uni[b] / n, 1 / (v + 1)] for a, b in deleted if ctx[a].bit_length() == k])
    x = np.full(3, 1 / 3)
    for _ in range(2000):
        x = (p * x / (p * x).sum(axis=1, keepdims=True)).mean(axis=0)
    gain = lambda q: np.log((p * q).sum(axis=1)).mean()
    assert gain(w[k]) > gain(x) - 0.01


def test_a_distribution_over_words_and_one_unknown(make_docs):
    docs = corpus(80)
    words = sorted({w for d, t in docs if is_learn(d) for w in tokens(t) if w is not None})
    probes = [(4 * (1000 + i), w) for i, w in enumerate([*words, "never-seen"])]
    rows = {r["doc_id"]: r["score"] for r in score(make_docs, docs + probes + [(3996, "")])}
    # P(w | start) from P(w | start) P(end | w); compare with sums over all first words
    of_end = plain(docs)
    assert all(x <= 0 for x in rows.values()) and of_end is not None
    assert sum(10 ** rows[d] for d, _ in probes) + 10 ** rows[3996] < 1 + 1e-9


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for x in (np.array([], np.uint32), np.arange(1000, dtype=np.uint32), rng.integers(0, 2**63, 999).astype(np.uint64)):
        got = lm.unpack(lm.pack(x))
        assert (got == x).all() and got.dtype.itemsize == x.dtype.itemsize


def test_no_training_text_repeated_rows_and_empty_table(make_docs):
    rows = score(make_docs, [(4, "a b"), (4, "a b"), (8, None), (None, "a")])
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows) == \
        [(1, 0, 0, 0.0, 0.0), (2, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert score(make_docs, [], parts=1) == []
    clash = make_docs([(1, "a"), (2, "a"), (4, "a")]).selectExpr("*", "1 as learn", "2 as chunk", "3 as score")
    out = lm.score_texts(clash, F.col("doc_id") % 4 != 0, F.col("doc_id") % 4 == 1).collect()
    assert sorted((r["doc_id"], r["n_known"], r["train_tokens"]) for r in out) == [(1, 2, 4), (2, 2, 4), (4, 2, 4)]


def test_better_than_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    part = crc_mod("doc_id", 7)
    out = lm.score_texts(docs, part != 2, part == 5).where(part == 2).agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]
