import random

import pytest

from tillroll.llm import piece_lattice, queries
from tillroll.llm.piece_lattice import BLANK, lattice, nbest_segmentations

TEXTS = ["", None, " ", "  ", "a", "hello world", " a  b\n c\t d", "é𝄞日本x", "don't, stop!!", "x<unk>y </s>", "aaaaaaa", "the▁of",
         "\r\n\x00\x7f", "ﬁ ｆ é"]


def all_paths(text):
    """(score, ids) of every segmentation of a whole text, by recursion"""
    m = lattice()
    s = BLANK + text.replace(" ", BLANK) if text else ""

    def go(at):
        if at == len(s):
            return [(0.0, b"")]
        out = []
        for end in range(at + 1, min(len(s), at + m.longest) + 1):
            if (p := m.pieces.get(s[at:end])) is not None:
                out += [(p[0] + x, p[1] + y) for x, y in go(end)]
        if s[at] not in m.pieces:
            ids = b"".join(m.byte_ids[b] for b in s[at].encode())
            out += [(m.unknown + x, ids + y) for x, y in go(at + 1)]
        return out

    return sorted(go(0), key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["", "a", "hello", "to be", "in it,", "ab\ncd", "a  b", "é the", "aaaaa", "日x", "on on on"])
@pytest.mark.parametrize("n", [1, 3, 8])
def test_n_best_of_all_paths(text, n):
    want, got = all_paths(text), lattice().nbest(text, n)
    assert [round(s, 3) for s, _ in got] == [round(s, 3) for s, _ in want[:n]]
    assert len({ids for _, ids in got}) == len(got)
    scores = {ids: s for s, ids in want}
    assert all(abs(scores[ids] - s) < 1e-3 for s, ids in got)


def test_random_texts_against_all_paths():
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice("ab et,\n") for _ in range(rng.randrange(1, 11)))
        want, got = all_paths(text), lattice().nbest(text, 4)
        assert [round(s, 3) for s, _ in got] == [round(s, 3) for s, _ in want[:4]], repr(text)


def test_decoding_gives_every_text_back():
    rng = random.Random(2)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("aé日 \n,x𝄞") for _ in range(50)) for _ in range(200)]
    for t in texts:
        for _, ids in lattice().nbest(t, 3):
            assert lattice().decode(ids) == t.replace(BLANK, " ")


def test_search_completes_in_order_on_a_long_part_of_ties():
    got = [next(s for s, _ in [p]) for p in __import__("itertools").islice(lattice().search("a" * 3000), 5)]
    assert got == sorted(got, reverse=True)


def test_table(make_docs):
    docs = list(enumerate(TEXTS)) + [(99, "the of " * 20_000), (5, "hello world"), (None, "x y")]
    clash = make_docs(docs).selectExpr("*", "1 as rank", "2 as score", "3 as ids")
    rows = nbest_segmentations(clash, 3).collect()
    assert all(r["round_trip"] and len(r["ids"]) == 4 * r["n_pieces"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert sorted(r["rank"] for r in by[5]) == [1, 1, 2, 2, 3, 3]
    assert [(r["rank"], r["n_pieces"], r["score"]) for r in by[0] + by[1]] == [(1, 0, 0.0)] * 2
    assert len(by) == len(docs) - 1
    assert nbest_segmentations(make_docs([], 1)).count() == 0
    assert "ids" not in nbest_segmentations(make_docs([(1, "a")]), with_ids=False).columns


def test_each_path_is_decoded_and_the_query_returns_ids(spark):
    class Wrong:
        def nbest(self, text, n):
            return [(-1.0, b"a"), (-2.0, b"b"), (-3.0, b"a")][:n]

        def decode(self, ids):
            return "x" if ids == b"a" else "y"

    assert [r[3] for r in piece_lattice.ranked(Wrong(), "x", 3)] == [True, False, True]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    pieces = piece_lattice.lattice()
    for r in queries.op2_sentencepiece_nbest(spark, "/root/testdata/sf0.001").where("doc_id < 30").collect():
        assert r["round_trip"] and pieces.decode(bytes(r["ids"])) == docs[r["doc_id"]].replace(piece_lattice.BLANK, " ")
