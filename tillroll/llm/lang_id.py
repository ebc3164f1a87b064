"""Language ID: multinomial naive Bayes over hashed character n-grams.

``train`` counts every n-gram of every labelled document in numpy inside Spark
tasks; each task sends one count vector for each language and block of buckets,
and Spark adds them up. The log-probability matrix (languages x 2**bits floats;
its size is a parameter) is broadcast, and ``predict`` scores Arrow batches.

The posterior only weighs the learnt languages against each other and nears 1
with length for any text. ``fit``, the mean log-probability per n-gram under the
language found, does not grow with length; ``least_fits`` learns from all
training rows of a language how low it may be.

Results for odd input: null text and text without a letter are ``und`` with
score 0 and no fit; rows without a language or id rule are never learnt from; ties go to
the language first by name; without any labelled row every text is ``und``;
repeated rows are scored one by one; an empty table gives an empty result;
documents of any length are read whole, in slices of ``SLICE`` characters
that give the n-grams of the whole text; a ``lang`` column of more than
``most_languages`` values raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import texts_in_small_batches

SLICE = 1 << 18  # characters worked on at a time
UND = "und"


@dataclass(frozen=True)
class Grams:
    """Which n-grams, and how many hash buckets."""

    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 16


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probs: np.ndarray  # buckets x languages
    log_priors: np.ndarray
    grams: Grams


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _last_symbols(text: str, n: int) -> str:
    """The last ``n`` characters of ``text`` with runs of non-letters as one blank."""
    out: list[str] = []
    for c in reversed(text):
        if c.isalpha():
            out.append(c)
        elif not out or out[-1] != " ":
            out.append(" ")
        if len(out) == n:
            break
    return "".join(reversed(out))


def _slices(texts: list[str], orders: tuple[int, ...]) -> Iterator[list[tuple[int, str, int]]]:
    """Lists of (document, part, old) of about SLICE characters, lower-cased and
    with a blank before and after each text. A long text comes in parts; each
    starts with the last symbols of the one before, ``old`` in number, so that
    the n-grams across a cut are the text's, and counted once."""
    now, size, carry = [], 0, max(orders, default=1) - 1
    for i, t in enumerate(texts):
        whole, before = f" {t.lower()} ", ""
        for a in range(0, len(whole), SLICE):
            part = before + whole[a:a + SLICE]
            now.append((i, part, len(before)))
            before = _last_symbols(part, carry) if a + SLICE < len(whole) and carry else ""
            size += len(part)
            if size >= SLICE:
                yield now
                now, size = [], 0
    if now:
        yield now


def hashed_grams(parts: list[tuple[int, str]], grams: Grams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``part_grams`` of whole texts."""
    return part_grams([(i, f" {t.lower()} ", 0) for i, t in parts], grams)


def part_grams(parts: list[tuple[int, str, int]], grams: Grams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: document numbers (ascending) and buckets of the n-grams.

    A run of other characters than letters counts as one blank. N-grams of
    blanks alone and those of old symbols alone don't count.
    """
    sizes = [len(t) for _, t, _ in parts]
    codes = np.frombuffer("".join(t for _, t, _ in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat([i for i, _, _ in parts], sizes)
    new = np.ones(len(codes), bool)
    for a, (_, _, old) in zip(np.cumsum([0, *sizes]).tolist(), parts, strict=False):
        new[a:a + old] = False
    letter = _letters()[codes]
    edge = np.empty(len(codes), bool)  # the first character of a part stays
    edge[0], edge[1:] = True, doc[1:] != doc[:-1]
    keep = letter | edge
    keep[1:] |= letter[:-1]
    codes, doc, letter, new = np.where(letter, codes, 32)[keep].astype(np.uint64), doc[keep], letter[keep], new[keep]
    top = np.uint64(64 - grams.bits)
    for n in grams.orders:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h, some = np.full(m, n, np.uint64), np.zeros(m, bool)
        for k in range(n):
            h = (h ^ codes[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            some |= letter[k:k + m]
        some &= (doc[:m] == doc[n - 1:]) & new[n - 1:]
        yield doc[:m][some], ((h[some] * np.uint64(0xBF58476D1CE4E5B9)) >> top).astype(np.int64)


def count_grams(texts: list[str], labels: np.ndarray, n_labels: int, grams: Grams) -> np.ndarray:
    out = np.zeros((n_labels, 1 << grams.bits), np.int64)
    for parts in _slices(texts, grams.orders):
        for doc, bucket in part_grams(parts, grams):
            flat = (labels[doc].astype(np.int64) << grams.bits) | bucket
            out += np.bincount(flat, minlength=out.size).reshape(out.shape)
    return out


def train(labelled: DataFrame, grams: Grams = Grams(), smoothing: float = 0.5, block: int = 4096,
          most_languages: int = 256) -> LanguageModel:
    """Fit on every row of ``labelled`` (text, lang) that has both.

    The counts that reach the driver and the matrix that is broadcast have a
    column for each language; more than ``most_languages`` (a column that isn't
    of languages) is an error."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if rows.select("lang").distinct().limit(most_languages + 1).count() > most_languages:
        raise ValueError(f"lang has more than {most_languages} values")
    texts_in_small_batches(labelled.sparkSession)
    blocks = max(1, (1 << grams.bits) // block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for b in batches:
            langs, texts = b["lang"].to_pylist(), b["text"].to_pylist()
            names = sorted(set(langs))
            index = {x: i for i, x in enumerate(names)}
            got = count_grams(texts, np.array([index[x] for x in langs], np.int32), len(names), grams)
            for x in names:
                total[x] = total.get(x, 0) + got[index[x]]
                docs[x] = docs.get(x, 0) + langs.count(x)
        for x, c in total.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([x] * blocks, pa.string()), "block": pa.array(range(blocks), pa.int32()),
                "docs": pa.array([docs[x]] * blocks, pa.int64()),
                "counts": pa.array([p.tobytes() for p in np.split(c, blocks)], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list] = {}
        for b in batches:
            for r in b.to_pylist():
                c = np.frombuffer(r["counts"], np.int64)
                d, t = total.get((r["lang"], r["block"]), (0, 0))
                total[r["lang"], r["block"]] = [d + r["docs"], t + c]
        if total:
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in total], pa.string()),
                "block": pa.array([k[1] for k in total], pa.int32()),
                "docs": pa.array([v[0] for v in total.values()], pa.int64()),
                "counts": pa.array([v[1].tobytes() for v in total.values()], pa.binary())})

    schema = "lang string, block int, docs long, counts binary"
    # one row for each language and block: languages x 2**bits counts in all
    got = rows.mapInArrow(count, schema).repartition("lang", "block").mapInArrow(add, schema).collect()
    names = sorted({r["lang"] for r in got})
    counts = np.zeros((len(names), 1 << grams.bits))
    docs = np.zeros(len(names))
    for r in got:
        i, width = names.index(r["lang"]), (1 << grams.bits) // blocks
        counts[i, r["block"] * width:(r["block"] + 1) * width] = np.frombuffer(r["counts"], np.int64)
        docs[i] = r["docs"]
    counts += smoothing
    probs = np.log(counts / counts.sum(axis=1, keepdims=True)) if names else counts
    return LanguageModel(names, np.ascontiguousarray(probs.T, np.float32),
                         np.log(docs / docs.sum()) if names else docs, grams)


def log_prob_sums(texts: list[str | None], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its n-grams' log-probabilities under each language, and the number of n-grams."""
    n, k = len(texts), len(model.languages)
    score, grams = np.zeros((n, max(1, k))), np.zeros(n, np.int64)
    for parts in _slices([t or "" for t in texts], model.grams.orders):
        for doc, bucket in part_grams(parts, model.grams):
            if not len(doc) or not k:
                continue
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            for lang in range(k):
                score[doc[first], lang] += np.add.reduceat(model.log_probs[:, lang][bucket], first, dtype=np.float64)
            grams[doc[first]] += np.diff(np.r_[first, len(doc)])
    return score, grams


def classify_with_fit(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior and fit (NaN for ``und``) of each text."""
    sums, grams = log_prob_sums(texts, model)
    seen = grams > 0
    score = sums + model.log_priors if model.languages else sums
    best = score.argmax(axis=1)
    posterior = 1 / np.exp(score - score.max(axis=1, keepdims=True)).sum(axis=1)
    fit = sums[np.arange(len(texts)), best] / np.maximum(grams, 1)
    return ([model.languages[b] if s else UND for b, s in zip(best, seen, strict=True)],
            np.where(seen, posterior, 0.0), np.where(seen, fit, np.nan))


def classify(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text."""
    return classify_with_fit(texts, model)[:2]


def least_fits(labelled: DataFrame, model: LanguageModel, deviations: float = 10.0, margin: float = 1.0) -> dict[str, float]:
    """For each language ``deviations`` standard deviations below the mean of
    the fits of all its rows in ``labelled`` (text, lang), but ``margin`` at
    least (nats; few or equal rows hardly deviate)."""
    spark = labelled.sparkSession
    texts_in_small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def own_fit(t: pa.Array, lang: pa.Array) -> pa.Array:
        m = shared.value
        sums, grams = log_prob_sums(t.to_pylist(), m)
        own = [m.languages.index(x) for x in lang.to_pylist()]
        return pa.array(sums[np.arange(len(own)), own] / np.maximum(grams, 1), pa.float64(), mask=grams == 0)

    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    rows = labelled.where(text.isNotNull() & lang.isin(model.languages)).select(
        lang.alias("lang"), own_fit.asNondeterministic()(text, lang).alias("fit"))
    got = rows.groupBy("lang").agg(F.avg("fit").alias("mean"), F.stddev_pop("fit").alias("sd")).where("mean is not null")
    return {r["lang"]: r["mean"] - max(deviations * r["sd"], margin) for r in got.collect()}  # a row for each language


def predict(spark: SparkSession, text: Column, model: LanguageModel) -> Column:
    """struct<lang_pred, score, fit> of a text column."""
    texts_in_small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,fit:double>")
    def language(t: pa.Array) -> pa.Array:
        langs, score, fit = classify_with_fit(t.to_pylist(), shared.value)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                                           pa.array(fit, pa.float64(), mask=np.isnan(fit))],
                                          ["lang_pred", "score", "fit"])

    return language.asNondeterministic()(text.cast("string"))  # so that no filter runs it a second time
