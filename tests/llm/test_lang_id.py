import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import lang_id
from tillroll.llm.common import crc_mod
from tillroll.llm.lang_id import Grams, classify, classify_with_fit, count_grams, hashed_grams, least_fits, predict, train

GRAMS = Grams(bits=12)


def plain_grams(text, orders=(1, 2, 3)):
    """n-grams of lower-cased letters, runs of anything else being one blank"""
    out, blank = [], False
    for c in f" {text.lower()} ":
        if c.isalpha():
            out.append(c)
        elif not out or out[-1] != " ":
            out.append(" ")
    s = "".join(out)
    return Counter(s[i:i + n] for n in orders for i in range(len(s) - n + 1) if s[i:i + n].strip())


def bucket_of(gram):
    out = {}
    for doc, bucket in hashed_grams([(0, gram)], Grams((len(gram),), GRAMS.bits)):
        out = Counter(bucket.tolist())
    return out


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    words = {"en": "the and thing over with".split(), "de": "der und über mit dass".split(), "fr": "le que où avec être".split()}
    return [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randrange(3, 30))), x)
            for i, x in enumerate(rng.choice(list(words)) for _ in range(n))]


def test_grams_are_those_of_a_plain_loop():
    for text in ["", "a", "The  Übung, 12 x", "a-b", "…", "x" * 50, "İstanbul ǅ"]:
        got = Counter()
        for doc, bucket in hashed_grams([(0, text)], GRAMS):
            got.update(bucket.tolist())
        assert sum(got.values()) == sum(plain_grams(text).values()), text


def test_counts_do_not_depend_on_slices_or_batches(monkeypatch):
    texts = [t for _, t, _ in corpus()]
    labels = np.arange(len(texts)) % 3
    whole = count_grams(texts, labels, 3, GRAMS)
    parts = sum(count_grams([t], np.array([x]), 3, GRAMS) for t, x in zip(texts, labels, strict=True))
    assert (whole == parts).all()
    monkeypatch.setattr(lang_id, "SLICE", 64)
    assert (count_grams(texts, labels, 3, GRAMS) == whole).all()


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_a_long_text_has_the_same_grams_in_any_slices(monkeypatch, size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("abcdÜß  ..12\nΣςé") for _ in range(rng.randrange(760))) for _ in range(20)]
    texts += ["", "...", " a ", "ab" + "." * 500 + "cd", "ΟΔΟΣ ΟΔΟΣ" * 30, "." * 300 + "x"]
    want = count_grams(texts, np.arange(len(texts)), len(texts), GRAMS)
    assert [int(c.sum()) for c in want] == [sum(plain_grams(t).values()) for t in texts]
    model = lang_id.LanguageModel(["a", "b"], np.random.default_rng(1).normal(size=(1 << 12, 2)).astype(np.float32), np.zeros(2), GRAMS)
    sums = lang_id.log_prob_sums(texts, model)
    monkeypatch.setattr(lang_id, "SLICE", size)
    assert (count_grams(texts, np.arange(len(texts)), len(texts), GRAMS) == want).all()
    assert all(np.allclose(a, b) for a, b in zip(sums, lang_id.log_prob_sums(texts, model), strict=True))


def test_too_many_languages_raise(make_docs):
    docs = make_docs([(i, "the thing", f"l{i}") for i in range(6)])
    assert len(train(docs, GRAMS, most_languages=6).languages) == 6
    with pytest.raises(ValueError, match="more than 5"):
        train(docs, GRAMS, most_languages=5)


def test_model_and_posterior_against_plain_naive_bayes(spark, make_docs):
    docs = corpus()
    model = train(make_docs(docs), GRAMS)
    assert model.languages == ["de", "en", "fr"]
    counts = {x: count_grams([t for _, t, y in docs if y == x], np.zeros(999, int), 1, GRAMS)[0] + 0.5 for x in model.languages}
    n = Counter(x for _, _, x in docs)
    for _, text, _ in docs[:20]:
        got = Counter()
        for _, bucket in hashed_grams([(0, text)], GRAMS):
            got.update(bucket.tolist())
        s = [math.log(n[x] / len(docs)) + sum(k * math.log(counts[x][b] / counts[x].sum()) for b, k in got.items())
             for x in model.languages]
        p = [1 / sum(math.exp(min(700, b - a)) for b in s) for a in s]
        (lang,), (score,) = classify([text], model)
        assert lang == model.languages[int(np.argmax(p))] and abs(score - max(p)) < 1e-3


def test_predictions_on_a_table(spark, make_docs):
    docs = corpus() + [(900, None), (901, ""), (902, "12 %% \n"), (903, "und " * 400_000), (904, "x", None), (None, "the thing")]
    model = train(make_docs(docs), GRAMS)
    rows = make_docs(docs + [docs[0]]).selectExpr("*", "1 as lang_pred", "2 as score") \
        .select("doc_id", predict(spark, F.col("text"), model).alias("p")).collect()
    assert len(rows) == len(docs) + 1
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["p"]["lang_pred"], r["p"]["score"]))
        assert 0 <= r["p"]["score"] <= 1
    assert got[900] == got[901] == got[902] == [("und", 0.0)]
    assert got[903][0][0] == "de" and got[None][0][0] == "en" and got[904][0][0] in model.languages
    assert sum(got[d][0][0] == x for d, _, x in docs[:60]) >= 58


def test_fit_is_a_mean_and_its_bound_that_of_all_rows(spark, make_docs):
    docs = corpus() + [(900, None, "en"), (901, "12 %", "en"), (902, "the", "xx")]
    model = train(make_docs(docs[:60]), GRAMS)
    fits = defaultdict(list)
    for _, t, x in docs[:60]:
        b = np.concatenate([b for _, b in hashed_grams([(0, t)], GRAMS)])
        fits[x].append(model.log_probs[b, model.languages.index(x)].mean())
    got = least_fits(make_docs(docs), model, deviations=3, margin=0.1)
    assert got.keys() == fits.keys()
    assert all(abs(got[x] - (np.mean(v) - max(3 * np.std(v), 0.1))) < 1e-4 for x, v in fits.items())
    (_, _), _, fit = classify_with_fit(["the thing", "12 %"], model)
    assert -9 < fit[0] < 0 and np.isnan(fit[1])
    assert least_fits(make_docs([], 1), model) == {} == least_fits(make_docs(docs), train(make_docs([], 1), GRAMS))


def test_no_labelled_rows_and_empty_table(spark, make_docs):
    model = train(make_docs([(1, "the", None)]))
    assert model.languages == [] and classify(["the", None], model)[0] == ["und", "und"]
    empty = make_docs([], 1).select(predict(spark, F.col("text"), model).alias("p"))
    assert empty.count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.where(crc_mod("doc_id", 4) != 2))
    out = docs.where((crc_mod("doc_id", 4) == 2) & F.col("lang").isNotNull()) \
        .select("lang", predict(spark, F.col("text"), model).alias("p")).collect()
    assert len(out) > 100 and sum(r["lang"] == r["p"]["lang_pred"] for r in out) / len(out) > 0.98
