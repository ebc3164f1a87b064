import itertools
import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm.packing import closest_fill, minimum_bin_slack, pack, pack_documents
from tillroll.llm.tokens import tokenizer

TEXTS = ["", None, " \t", "One two", "don't STOP é ̈x", "x <|endoftext|> y", "a b c\x1cd", "éÉß ǅ İ",
         "日本 語 \U0001f600️", "word " * 6000, "a" * 9000]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_whole_texts(whole):
    rng = random.Random(1)
    marks = "aZé'ß \t\n.,!#|1٣日́  İΣς"
    texts = TEXTS + ["".join(rng.choice(marks) for _ in range(40)) for _ in range(3000)]
    for t, ids in zip(texts, tokenizer().encode(texts), strict=True):
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == whole(t), repr(t)


@pytest.mark.parametrize("seed", range(30))
def test_fill_is_the_closest_of_all_multisets(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
    space = rng.randrange(1, 60)
    sums = {sum(k * n for k, n in zip(counts, c, strict=True)) for c in itertools.product(*[range(v + 1) for v in counts.values()])}
    got = closest_fill(space, counts)
    assert all(0 < v <= counts[k] for k, v in got.items())
    assert sum(k * v for k, v in got.items()) == max(s for s in sums if s <= space)


def test_patterns_use_every_piece_and_fit():
    rng = random.Random(2)
    histogram = defaultdict(int)
    for _ in range(20000):  # lengths as of documents: many short, few long
        histogram[1 + int(rng.lognormvariate(6.2, 1)) % 2047] += rng.randrange(1, 50)
    got, windows = defaultdict(int), 0
    for p in minimum_bin_slack(histogram, 2048):
        assert sum(k * v for k, v in p.counts.items()) <= 2048 and p.times > 0
        windows += p.times
        for k, v in p.counts.items():
            got[k] += v * p.times
    assert got == histogram
    assert windows <= sum(k * v for k, v in histogram.items()) / 2048 * 1.001 + 1


def check(rows, docs, window, whole):
    want = sorted((d if d is not None else -1, tuple(whole(t)) + (1,)) for d, t in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
        assert 1 <= r["length"] <= window
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s in by_seq.values():
        s.sort(key=lambda r: r["offset"])
        at = 0
        for r in s:
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    crc = lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    pieces = sorted((d, a, len(ids[a:a + window]), crc(ids[a:a + window]), len(ids)) for d, ids in want
                    for a in range(0, len(ids), window))
    assert pieces == sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["start"], r["length"], r["ids_crc32"],
                             r["doc_tokens"]) for r in rows)


def test_documents_are_whole_and_sequences_gapless(make_docs, whole):
    rng = random.Random(4)
    docs = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choice(["ab", "cd", "efgh"]) for _ in range(rng.randrange(300))))
                                     for i in range(200)]
    docs += [(3, "One two"), (3, "One two"), (None, "no id"), (None, "no id")]
    for window in (64, 2048):
        check(pack_documents(make_docs(docs), window).collect(), docs, window, whole)


def test_a_third_of_the_pieces_have_one_length(spark):
    rows = [(i, 0, 700) for i in range(900)] + [(i, 0, 1 + i % 1500) for i in range(900, 2700)]
    out = pack(spark.createDataFrame(rows, "doc_id long, start long, length long")).collect()
    assert len(out) == 2700
    ends = defaultdict(int)
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048 and sorted(ends) == list(range(len(ends)))
    assert sum(r[2] for r in rows) / (2048 * len(ends)) > 0.85  # 700 has few complements here


def test_one_id_holds_a_third_of_the_pieces(spark):
    rows = [(7, 0, 40, 1)] * 600 + [(None, 0, 40, 2)] * 600 + [(i, 0, 1 + i % 90, 3) for i in range(600)]
    out = pack(spark.createDataFrame(rows, "doc_id long, start long, length long, _uid int").repartition(7), 128).collect()
    places = {(r["sequence_id"], r["offset"]) for r in out}
    assert len(out) == len(places) == 1800
    none = lambda x: -1 if x is None else x
    assert sorted((none(r[0]), *r[1:4]) for r in out) == sorted((none(r[0]), *r[1:]) for r in rows)
    ends = defaultdict(int)
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 128 and sorted(ends) == list(range(len(ends)))


def test_empty_table_and_clashing_columns(make_docs, whole):
    assert pack_documents(make_docs([], 1)).count() == 0
    clash = make_docs([(1, "a b c")]).selectExpr("*", "1 as start", "2 as length", "3 as offset", "4 as _rank", "5 as ids")
    check(pack_documents(clash).collect(), [(1, "a b c")], 2048, whole)
