import math
import random

import numpy as np
import pytest
import zstandard as zstd
from pyspark.sql import functions as F

from tillroll.llm.common import crc_mod
from tillroll.llm.compression_quality import (SampleBound, _dictionary, calibrate, calibrate_in_spark, labelled_measures,
                                              measures, quality_score, sample, score, settled, sigmoid, train)

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=200):
    rng = random.Random(2)
    good, bad = "the river was calm and we walked home".split(), "!!!BUY $$$ #win %% CLICK".split()
    docs, labels = [], []
    for i in range(n):
        q = i % 2
        docs.append((i, " ".join(rng.choice(good if q else bad) for _ in range(rng.randrange(20, 200)))))
        labels.append((i, q, 0))
    return docs, labels


def test_scores_on_a_table(spark, make_docs):
    docs, labels = corpus()
    odd = [(900, None), (901, ""), (902, "the river " * 60_000), (None, "we walked"), docs[1]]
    marks = labels + [(1, 1, 0), (None, 1, 0), (5000, 0, 0), (900, None, 0)]
    model = train(make_docs(docs + odd), spark.createDataFrame(marks, LABELS))
    rows = make_docs(docs + odd).selectExpr("*", "1 as score", "0 as quality") \
        .select("doc_id", quality_score(spark, F.col("text"), model).alias("s")).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r["s"] <= 1 for r in rows)
    by = {r["doc_id"]: r["s"] for r in rows}
    assert all((by[i] >= 0.5) == bool(q) for i, q, _ in labels)
    assert by[900] == by[901] == sigmoid(np.array([model.weights[-1]]))[0]


def test_sample_is_bounded_and_repeatable(spark, make_docs):
    docs, labels = corpus()
    docs.append((300, "x" * 5000))
    marks = spark.createDataFrame([*labels, (300, 1, 0)], LABELS)
    bound = SampleBound(rows=20, text_bytes=4000)
    got = [sample(make_docs(docs, p), marks, bound) for p in (1, 4)]
    assert got[0] == got[1] and len(got[0]) <= 40 and {r["quality"] for r in got[0]} == {0, 1}
    assert all(len(r["text"]) <= 4000 for r in got[0])


def test_one_label_none_and_empty_tables(spark, make_docs):
    docs, labels = corpus(20)
    only = train(make_docs(docs), spark.createDataFrame([x for x in labels if x[1]], LABELS))
    none = train(make_docs(docs), spark.createDataFrame([], LABELS))
    for model, p in ((only, 0.99), (none, 0.5)):
        rows = make_docs(docs).select(quality_score(spark, F.col("text"), model).alias("s")).collect()
        assert len(rows) == 20 and all(abs(r["s"] - p) < 1e-9 for r in rows)
    assert make_docs([], 1).select(quality_score(spark, F.col("text"), none).alias("s")).count() == 0
    assert train(make_docs([], 1), spark.createDataFrame([], LABELS)).good == b""


def test_shares_of_labels_do_not_depend_on_the_bound(spark, make_docs):
    rng = random.Random(5)
    words = "the river was calm and we walked home over green hills until night fell".split(), \
        "BUY now $$$ #win CLICK here cheap pills best free bets casino".split()
    docs, labels = [], []
    for i in range(2800):  # one bad text to six good ones, of mixed words
        q = int(i % 7 > 0)
        share = rng.gauss(0.6 if q else 0.4, 0.15)
        docs.append((i, " ".join(rng.choice(words[rng.random() > share]) for _ in range(60))))
        labels.append((i, q, 0))
    marks, texts = spark.createDataFrame(labels, LABELS), [t.encode() for _, t in docs]
    few, many = (score(texts, train(make_docs(docs), marks, SampleBound(rows=n))) for n in (200, 20_000))
    assert abs(few.mean() - 6 / 7) < 0.03 and abs(many.mean() - 6 / 7) < 0.03
    gap = np.log(few / (1 - few)) - np.log(many / (1 - many))
    assert abs(np.median(gap)) < 0.5


def test_calibration_in_spark_is_that_of_all_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < sigmoid(x @ [2.0, -1.0] + 1.5)).astype(int)
    rows = [(float(a), float(b), int(q), False) for (a, b), q in zip(x, y, strict=True)]
    frame = spark.createDataFrame(rows, "x0 double, x1 double, quality int, taken boolean")
    assert np.allclose(calibrate_in_spark(frame, np.zeros(3)), calibrate(x, y), atol=1e-6)
    taken = frame.unionByName(frame.where("quality = 0").withColumn("taken", F.lit(True)))
    assert np.allclose(calibrate_in_spark(taken, np.zeros(3))[:2], calibrate(x, y)[:2], atol=0.3)
    assert abs(calibrate_in_spark(taken, np.zeros(3))[2] - (calibrate(x, y)[2] - np.log(2))) < 0.2


def test_difference_is_normalised_and_signed():
    good, bad = b"the river was calm and we walked home " * 50, b"!!!BUY $$$ #win %% CLICK now " * 50
    x = measures([good[:200], bad[:200], b"", good * 20], good, bad)[:, 0]
    assert x[0] > 0.1 and x[1] < -0.1 and x[2] == 0 and x[3] > 0.05 and (abs(x) <= 1).all()


def test_calibration_finds_known_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20000, 2))
    y = (rng.random(20000) < sigmoid(x @ [2.0, -1.0] + 0.5)).astype(float)
    assert np.allclose(calibrate(x, y), [2.0, -1.0, 0.5], atol=0.12)


@pytest.mark.parametrize("times", [0.0, 1.0, 4.0, -4.0, 50.0])
def test_calibration_settles_from_any_start(spark, times):
    rng = np.random.default_rng(8)
    y = (rng.random(3000) < 0.86).astype(int)
    x = np.column_stack([rng.normal(0.01, 0.02, 3000) + 0.03 * y, rng.normal(-1.2, 0.1, 3000) - 0.4 * (rng.random(3000) < 0.1)])
    want = calibrate(x, y)
    assert np.allclose(calibrate(x, y, start=times * want), want, rtol=1e-6)
    frame = spark.createDataFrame([(float(a), float(b), int(q), False) for (a, b), q in zip(x, y, strict=True)],
                                  "x0 double, x1 double, quality int, taken boolean")
    assert np.allclose(calibrate_in_spark(frame, times * want), want, rtol=1e-5)


@pytest.fixture(scope="module")
def measured_table(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet").where(crc_mod("doc_id", 5) != 0) for t in ("documents", "labels"))
    rows = sample(docs, labels, SampleBound())
    texts = {q: [r["text"].encode() for r in rows[::2] if r["quality"] == q] for q in (0, 1)}
    every = labelled_measures(docs, labels, *(_dictionary(texts[q], 64 << 10) for q in (1, 0)), {r["doc_id"] for r in rows[::2]})
    return spark.createDataFrame(every.toPandas()).coalesce(4).cache()


@pytest.mark.parametrize("times", [0.0, 1.0, 4.0, -4.0])
def test_calibration_of_the_table_settles_from_any_start(measured_table, times):
    want = calibrate_in_spark(measured_table, np.zeros(3))
    assert np.allclose(calibrate_in_spark(measured_table, times * want), want, rtol=1e-5)


def test_what_does_not_settle_raises():
    with pytest.raises(RuntimeError):
        settled(lambda w: (float(w @ w), -2 * w - 1, np.eye(2)), np.ones(2))  # a gradient that points uphill
    with pytest.raises(RuntimeError):
        settled(lambda w: (float(np.exp(-w[0])), np.array([-np.exp(-w[0])]), np.array([[np.exp(-w[0])]])), np.zeros(1))


def plain_measures(text, good, bad):
    """Block by block with a fresh compressor each time."""
    size = []
    for d in (good, bad):
        c = zstd.ZstdCompressor(level=3, dict_data=zstd.ZstdCompressionDict(d), write_checksum=False,
                                write_content_size=False, write_dict_id=False)
        size.append(sum(len(c.compress(text[a:a + 4096])) for a in range(0, len(text), 4096)))
    return ((size[1] - size[0]) / sum(size), np.log(min(size) / len(text))) if text else (0.0, 0.0)


def test_measures_and_scores_against_plain_code(spark, make_docs):
    docs, labels = corpus()
    docs += [(500, "the river " * 3000), (501, "x"), (502, "é" * 5000)]
    model = train(make_docs(docs), spark.createDataFrame([*labels, (500, 1, 0), (501, 0, 0)], LABELS))
    want = np.array([plain_measures(t.encode(), model.good, model.bad) for _, t in docs])
    assert np.allclose(measures([t.encode() for _, t in docs], model.good, model.bad), want)
    rows = make_docs(docs).select("doc_id", quality_score(spark, F.col("text"), model).alias("s")).collect()
    line = {i: float(x @ model.weights[:2] + model.weights[2]) for (i, _), x in zip(docs, want, strict=True)}
    assert all(abs(r["s"] - 1 / (1 + math.exp(-line[r["doc_id"]]))) < 1e-12 for r in rows)


@pytest.mark.parametrize("broadcast_rows", [1, 1_000_000])
def test_labelled_measures_at_any_number_of_labels(spark, make_docs, broadcast_rows):
    docs, labels = corpus(40)
    good, bad = b"the river was calm " * 40, b"BUY now CLICK win " * 40
    marks = spark.createDataFrame([*labels[:30], labels[0], (900, 1, 0)], LABELS)
    rows = labelled_measures(make_docs([*docs, docs[3], (None, "we walked")]), marks, good, bad, {1, 2}, broadcast_rows).collect()
    want = [(*plain_measures(t.encode(), good, bad), i % 2, i in (1, 2)) for i, t in docs[:30]]
    assert np.allclose(sorted(tuple(r) for r in rows), sorted(want))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learn = crc_mod("doc_id", 5) != 0
    model = train(docs.where(learn), labels.where(learn))
    out = docs.where(~learn).join(labels, "doc_id").select("quality", quality_score(spark, F.col("text"), model).alias("s")).collect()
    good = [r["s"] >= 0.3 for r in out if r["quality"] == 1]
    bad = [r["s"] >= 0.3 for r in out if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.4
