import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from llm.test_simhash import plain_components, plain_fingerprint
from tillroll.llm import compression_quality, lang_id, queries
from tillroll.llm.common import stored
from tillroll.llm.simhash import one_of_each
from tillroll.llm.tokens import tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_run_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    model = queries.naive_bayes(spark, SF)
    langs, scores, fits = lang_id.classify_with_fit([r["text"] for r in docs], model)
    least_fit = lang_id.least_fits(queries.language_rows(spark, SF), model)
    kept = [r for r, x, s, f in zip(docs, langs, scores, fits, strict=True) if x != "und" and s >= 0.5 and f >= least_fit[x]]
    quality = compression_quality.score([(r["text"] or "").encode() for r in kept], queries.quality_model(spark, SF))
    kept = [r for r, s in zip(kept, quality, strict=True) if s >= 0.3]
    root = plain_components([plain_fingerprint(r["text"]) for r in kept])
    least = defaultdict(list)
    for r, c in zip(kept, root, strict=True):
        least[c].append(r["doc_id"])
    ids = {min(v) for v in least.values()}
    want = {r["doc_id"]: len(tokenizer().encode([r["text"]])[0]) // 4 + 1 for r in kept if r["doc_id"] in ids}
    rows = corpus_pipeline.run(spark, SF).collect()
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == want[r["doc_id"]]
    assert got == want and 0 < len(want) < len(docs)


def test_stages_return_the_columns_of_documents_and_keep_clean_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs, "/root/testdata/sf0.01")
        assert out.schema == docs.schema, name
        good = docs.join(labels.where("quality = 1"), "doc_id")
        assert out.join(good.select("doc_id"), "doc_id").count() >= 0.98 * good.count(), name


def test_texts_of_no_learnt_language_are_rejected(spark, make_docs):
    rng = random.Random(4)
    odd = ["Vandaag gaan wij samen naar huis omdat het weer zo mooi is geworden en de vogels zingen ",
           "Ala ma kota a kot ma Ale i wszyscy szczęśliwie żyją w wielkim domu nad rzeką ",
           "Сегодня мы идем домой по реке и лесу ", "def f(x):\n  return self.foo[x] + kwargs.get('bar')\nfor i in j: print(i)\n",
           "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)), "xq zzkj wqxv "]
    sf = "/root/testdata/sf0.01"
    learnt = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 20").select("text").collect()]
    texts = [t * n for t in odd for n in (1, 200)] + learnt
    got = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, make_docs(list(enumerate(texts))), sf).collect()}
    assert got == set(range(2 * len(odd), len(texts)))


def test_shares_kept_are_alike_at_two_sizes(spark):
    """The models see ten times the rows; the share of documents that each stage keeps hardly moves."""
    shares = []
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
        for _, stage in corpus_pipeline.STAGES[:2]:
            before = docs.count()
            docs = stored(stage(spark, docs, sf), "kept")
            kept.append(docs.count() / before)
        shares.append(kept)
    assert all(abs(a - b) < 0.03 and min(a, b) > 0.7 for a, b in zip(*shares, strict=True)), shares


@pytest.mark.parametrize("rows", [1, 2_000_000])
def test_one_of_each_with_repeated_rows_and_null_ids(make_docs, rows):
    a, b = "the first text of all here", "another one that is not like it"
    docs = [(1, a), (1, a), (2, a), (3, b), (4, None), (5, ""), (None, a), (None, "x y z only null"), (None, "x y z only null"),
            (6, b), (6, "and a text that differs with the same id")]
    out = one_of_each(make_docs(docs).selectExpr("*", "1 as fp", "2 as place"), broadcast_rows=rows).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out) == sorted([
        ("1", a), ("3", b), ("4", ""), ("None", "x y z only null"), ("6", docs[-1][1])])
    assert out[0].asDict().keys() >= {"fp", "place", "lang"}


def test_empty_table_passes_every_stage(spark, make_docs):
    docs = make_docs([], 1)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
