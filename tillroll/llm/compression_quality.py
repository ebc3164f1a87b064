"""Quality classifier by compression: one zstandard dictionary from good and one
from bad labelled text. A text is cut into blocks; each block is compressed
with either dictionary, and the normalised size difference
``(bad - good) / (bad + good)`` over all blocks becomes a score, calibrated
together with the log of the compressed share of the text, which tells
repetitive text that either dictionary shrinks alike.

The dictionaries, whose size is fixed, are trained on a bounded sample of the
labelled rows (``SampleBound``): half of those with the smallest hash of their
id, as many for each label. The calibration reads every other labelled row,
whole, in Spark; each label is weighted so that it counts as often as among all
labelled rows, so the share of a label doesn't depend on the bound. Scoring
reads whole texts.

Results for odd input: null text counts as empty; an empty text has difference
and share 0 and gets the score of the calibration there; labels that are null or have no
document are not used; with fewer than two labels outside the dictionaries every text gets
the share of label 1 (0.5 without labels); labelled rows that are repeated count
once in the fit and are scored one by one; an empty table gives an empty result; ties have no part in a score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import stored, texts_in_small_batches

BLOCK = 4096  # bytes compressed at a time, so that a long text doesn't outgrow the dictionary
LEVEL = 3


@dataclass(frozen=True)
class SampleBound:
    """The dictionaries' sample has at most ``rows`` texts of each label, of at most ``text_bytes`` bytes each."""

    rows: int = 2000
    text_bytes: int = 32 << 10
    dictionary_bytes: int = 64 << 10


@dataclass(frozen=True)
class CompressionModel:
    good: bytes  # dictionaries; empty: none
    bad: bytes
    weights: np.ndarray  # of the difference, the log share and 1


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts' last bytes where there is too little to train on."""
    samples = [t[a:a + BLOCK] for t in texts for a in range(0, len(t), BLOCK)]
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(texts)[-size:]


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    if not dictionary:
        return zstd.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
    d = zstd.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                               write_dict_id=False)


def measures(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """For each text the normalised compressed-size difference and the log of
    the compressed share; zeros for an empty one."""
    g, b = _compressor(good).compress, _compressor(bad).compress
    out = np.zeros((len(texts), 2))
    for i, t in enumerate(texts):
        x = y = 0
        for a in range(0, len(t), BLOCK):
            part = t[a:a + BLOCK]
            x += len(g(part))
            y += len(b(part))
        if t:
            out[i] = (y - x) / (x + y), np.log(min(x, y) / len(t))
    return out


def settled(at: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], start: np.ndarray,
            steps: int = 100) -> np.ndarray:
    """The weights of least loss by damped Newton steps. ``at`` gives the loss,
    its gradient and its Hessian at some weights. A step is halved until the
    loss falls as its gradient promises, so any start leads to the one minimum
    of the convex loss; what doesn't settle raises."""
    w, (loss, grad, hessian) = start, at(start)
    for _ in range(steps):
        step = np.linalg.solve(hessian, grad)
        promised = float(grad @ step)
        if promised <= 1e-10 * abs(loss):
            return w - step
        size = 1.0
        while True:
            there = at(w - size * step)
            if there[0] <= loss - 1e-4 * size * promised:
                break
            size /= 2
            if size < 1e-9:
                raise RuntimeError(f"the calibration found no lower loss than {loss} at {w}")
        w, (loss, grad, hessian) = w - size * step, there
    raise RuntimeError(f"the calibration did not settle in {steps} steps: {w}")


def _in_units(w: np.ndarray, mean: np.ndarray, sd: np.ndarray, back: bool = False) -> np.ndarray:
    """Weights of raw columns as weights of standardised ones, or ``back``."""
    if back:
        raw = w[:-1] / sd
        return np.append(raw, w[-1] - raw @ mean)
    return np.append(w[:-1] * sd, w[-1] + w[:-1] @ mean)


def constant_weights(share: float, columns: int = 2) -> np.ndarray:
    """Every text gets the share of label 1."""
    p = np.clip(share, 0.01, 0.99)
    return np.append(np.zeros(columns), np.log(p / (1 - p)))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, start: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression; the last is the bias. The columns are standardised for the fit."""
    if not len(y) or y.min() == y.max():
        return constant_weights(y.mean() if len(y) else 0.5, x.shape[1])
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd = np.where(sd > 0, sd, 1.0)
    design = np.column_stack([(x - mean) / sd, np.ones(len(x))])

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = design @ w
        p = sigmoid(z)
        return (float((np.logaddexp(0, z) - y * z).sum() + ridge / 2 * w @ w), design.T @ (p - y) + ridge * w,
                (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w)))

    first = np.zeros(design.shape[1]) if start is None else _in_units(start, mean, sd)
    return _in_units(settled(at, first), mean, sd, back=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def sample(docs: DataFrame, labels: DataFrame, bound: SampleBound) -> list:
    """(text, quality) rows: for each label the ids with the smallest hash."""
    order = F.xxhash64("doc_id", F.lit("sample"))
    ids = labels.where("doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    few = None
    for q in (0, 1):
        part = ids.where(F.col("quality") == q).distinct().orderBy(order, "doc_id").limit(bound.rows)
        few = part if few is None else few.unionByName(part)
    size = F.octet_length(F.col("text").cast("string"))
    return (docs.select("doc_id", F.col("text").cast("string").alias("text")).where(size <= bound.text_bytes)
            .join(F.broadcast(few), "doc_id")  # at most 2 x rows ids
            .select("doc_id", "text", "quality").distinct()
            .orderBy("quality", order, "text").limit(4 * bound.rows).collect())


def labelled_measures(docs: DataFrame, labels: DataFrame, good: bytes, bad: bytes, taken: set,
                      broadcast_rows: int = 1_000_000) -> DataFrame:
    """(x0, x1, quality, taken) of every labelled row; ``taken``: its id is one the dictionaries were trained on.

    While the labelled ids number at most ``broadcast_rows`` they are broadcast and only their texts are compressed;
    beyond, every text is compressed where it lies and only its measures are joined, so that no text is shuffled."""
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    shared = spark.sparkContext.broadcast((good, bad))

    @F.arrow_udf("struct<x0:double,x1:double>")
    def measured(t: pa.Array) -> pa.Array:
        x = measures(t.to_pylist(), *shared.value)
        return pa.StructArray.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["x0", "x1"])

    text = F.col("text").cast("string")
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)").distinct()
    few = marks.limit(broadcast_rows + 1).count() <= broadcast_rows
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", text.alias("text"))
    if few:
        rows = rows.join(F.broadcast(marks.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"),
                       measured.asNondeterministic()(F.col("text").cast("binary")).alias("m"))
    ids = spark.createDataFrame([(i,) for i in taken], docs.select("doc_id").schema).withColumn("t", F.lit(True))
    return (rows.join(F.broadcast(marks) if few else marks, "doc_id").distinct()
            .join(F.broadcast(ids), "doc_id", "left")  # at most 4 x rows ids
            .select("m.x0", "m.x1", "quality", F.coalesce("t", F.lit(False)).alias("taken")))


def calibrate_in_spark(rows: DataFrame, start: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """``calibrate`` over the rows that are not taken, each label with the weight
    it has among all rows; the loss, gradient and Hessian at some weights are one
    aggregate of 10 sums."""
    rest = ~F.col("taken")
    counts = {r["quality"]: r for r in rows.groupBy("quality").agg(
        F.count("*").alias("n"), F.count_if(rest).alias("rest"),
        *[f(F.when(rest, F.col(c))).alias(f"{k}_{c}") for c in ("x0", "x1") for k, f in (("mean", F.avg), ("var", F.var_pop))]
    ).collect()}  # a row for each label
    if len(counts) < 2 or not all(r["rest"] for r in counts.values()):
        total = sum(r["n"] for r in counts.values())
        return constant_weights((counts[1]["n"] if 1 in counts else 0) / total if total else 0.5)
    share = np.array([counts[q]["n"] for q in (0, 1)], float)
    share /= share.sum()
    means = np.array([[counts[q][f"mean_{c}"] for c in ("x0", "x1")] for q in (0, 1)])
    mean = share @ means
    sd = np.sqrt(share @ (np.array([[counts[q][f"var_{c}"] for c in ("x0", "x1")] for q in (0, 1)]) + (means - mean) ** 2))
    sd = np.where(sd > 0, sd, 1.0)
    weight = F.when(F.col("quality") == 1, counts[1]["n"] / counts[1]["rest"]).otherwise(counts[0]["n"] / counts[0]["rest"])
    pairs = [(i, j) for i in range(3) for j in range(i + 1)]
    x = [(F.col(c) - float(mean[i])) / float(sd[i]) for i, c in enumerate(("x0", "x1"))] + [F.lit(1.0)]
    points = rows.where(rest).select(weight.alias("n"), F.col("quality").alias("q"), *[c.alias(f"z{i}") for i, c in enumerate(x)])

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = [F.col(f"z{i}") for i in range(3)]
        line = z[0] * float(w[0]) + z[1] * float(w[1]) + z[2] * float(w[2])
        there = points.withColumn("t", line).withColumn("p", 1 / (1 + F.exp(-F.col("t"))))
        n, q, t, p = (F.col(c) for c in "nqtp")
        sums = there.agg(F.sum(n * (F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t))) - q * t)),
                         *[F.sum(n * (p - q) * c) for c in z],
                         *[F.sum(n * p * (1 - p) * z[i] * z[j]) for i, j in pairs]).first()
        hessian = ridge * np.eye(3)
        for (i, j), v in zip(pairs, sums[4:], strict=True):
            hessian[i, j] += v
            if i != j:
                hessian[j, i] += v
        return sums[0] + ridge / 2 * float(w @ w), np.array(sums[1:4]) + ridge * w, hessian

    return _in_units(settled(at, _in_units(start, mean, sd)), mean, sd, back=True)


def train(docs: DataFrame, labels: DataFrame, bound: SampleBound = SampleBound()) -> CompressionModel:
    """Fit on the rows of ``docs`` that ``labels`` (doc_id, quality 0 or 1) marks."""
    rows = [(r["doc_id"], r["text"].encode(), r["quality"]) for r in sample(docs, labels, bound)]
    good = _dictionary([t for _, t, q in rows[::2] if q == 1], bound.dictionary_bytes)
    bad = _dictionary([t for _, t, q in rows[::2] if q == 0], bound.dictionary_bytes)
    rest = rows[1::2]
    start = calibrate(measures([t for _, t, _ in rest], good, bad), np.array([q for _, _, q in rest], float))
    every = stored(labelled_measures(docs, labels, good, bad, {i for i, _, _ in rows[::2]}), "quality-measures")
    return CompressionModel(good, bad, calibrate_in_spark(every, start))


def score(texts: list[bytes], model: CompressionModel) -> np.ndarray:
    x = measures(texts, model.good, model.bad)
    return sigmoid(np.column_stack([x, np.ones(len(x))]) @ model.weights)


def quality_score(spark: SparkSession, text: Column, model: CompressionModel) -> Column:
    """Calibrated probability of label 1 for a text column."""
    texts_in_small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of at most dictionary_bytes

    @F.arrow_udf("double")
    def quality(t: pa.Array) -> pa.Array:
        return pa.array(score([x or b"" for x in t.to_pylist()], shared.value), pa.float64())

    return quality.asNondeterministic()(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
