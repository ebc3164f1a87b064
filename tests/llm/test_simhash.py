import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tillroll.llm import simhash
from tillroll.llm.simhash import GrayIndex, components, fingerprint, fingerprint_links, gray_rank, near_dedup, segment_masks


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def plain_components(prints):
    """{index: smallest index reachable} by comparing all pairs"""
    n = len(prints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


TEXTS = ["", None, " \n", "One", "one", "two words", "Two\twords", "a b c", "A B C d", "É b c", "é b c",
         "x " * 5000, "\x1f a\x85b c d e", "a\x0bb\x0cc\rd"]


def test_fingerprints_against_plain(monkeypatch):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("the of Ab cd éf gh".split()) for _ in range(rng.randrange(200))) for _ in range(60)]
    want = [plain_fingerprint(t) for t in texts]
    assert [fingerprint(t) for t in texts] == want
    monkeypatch.setattr(simhash, "SLICE", 7)  # texts in many slices give the same
    assert [fingerprint(t) for t in texts] == want
    assert fingerprint("") == fingerprint(None) == 0


def test_gray_rank_orders_the_gray_sequence():
    codes = np.arange(1 << 10, dtype=np.uint64)
    assert (gray_rank(codes ^ (codes >> np.uint64(1))) == codes).all()


def near_codes(seed, n, centres=8):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = {rng.getrandbits(64) for _ in range(n // 3)}
    while len(out) < n:
        c = rng.choice(base)
        for _ in range(rng.randrange(6)):
            c ^= 1 << rng.randrange(64)
        out.add(c)
    return sorted(out)


def test_index_finds_every_pair_and_no_other():
    codes = np.array(near_codes(1, 700), np.uint64)
    index = GrayIndex(np.zeros(len(codes), np.int64), codes)
    got = {(int(index.code[i]), int(index.code[j])) for a, b in index.pairs(2) for i, j in zip(a, b, strict=True)}
    want = {(int(a), int(b)) for a in codes for b in codes if a != b and (int(a) ^ int(b)).bit_count() <= 2}
    assert {frozenset(x) for x in got} == {frozenset(x) for x in want}


def test_segments_grow_with_the_entries():
    few, many = segment_masks(10**6, 2), segment_masks(10**11, 2)
    assert len(few) == 3 and len(many) == 6
    for masks in (few, many):  # whichever two bits differ, some pattern is shared
        assert all(any(not (m >> i & 1 or m >> j & 1) for m in masks) for i in range(64) for j in range(i))


@pytest.mark.parametrize("limit", [2048, 20])
def test_components_of_fingerprints_against_all_pairs(spark, limit):
    codes = near_codes(2, 600)
    signed = [int(np.array([c], np.uint64).view(np.int64)[0]) for c in codes]
    entries = spark.createDataFrame([(c,) for c in signed], "fp long").repartition(3)
    got = {r["node"]: r["root"] for r in components(fingerprint_links(entries, len(codes), node_limit=limit), 3 * len(codes)).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for c, r in zip(signed, plain_components(codes), strict=True):
        groups[got.get(c, c)].add(c)
        want[r].add(c)
    assert {frozenset(x) for x in groups.values()} == {frozenset(x) for x in want.values()}
    assert all(min(v) == k for k, v in groups.items())


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_long_chain_is_one_component(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", broadcast_rows)
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(5)
    got = components(links, 300).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}


def test_documents_against_plain(make_docs):
    rng = random.Random(5)
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(40):
        words = [rng.choice("aa bb cc dd ee ff gg hh".split()) for _ in range(120)]
        docs.append((100 + 3 * i, " ".join(words)))
        docs.append((101 + 3 * i, " ".join(words)))
        words[60] = "zz"
        docs.append((102 + 3 * i, " ".join(words)))
    docs += [(100, docs[14][1]), (None, docs[17][1]), (None, "only null ids here and no other row like it")]
    rows = near_dedup(make_docs(docs)).collect()
    assert len(rows) == len(docs)
    prints = [plain_fingerprint(t) for _, t in docs]
    root = plain_components(prints)
    least = defaultdict(list)
    for (d, _), r in zip(docs, root, strict=True):
        least[r] += [d] if d is not None else []
    want = sorted((-1 if d is None else d, p, min(least[r], default=-1)) for (d, _), p, r in zip(docs, prints, root, strict=True))
    none = lambda x: -1 if x is None else x
    assert sorted((none(r["doc_id"]), r["fp"] % 2**64, none(r["component_id"])) for r in rows) == want


def test_empty_table_and_clashing_columns(make_docs):
    assert near_dedup(make_docs([], 1)).count() == 0
    clash = make_docs([(1, "a b c"), (2, "a b c")]).selectExpr("*", "1 as fp", "2 as root", "3 as least", "4 as component_id")
    assert sorted((r["doc_id"], r["component_id"]) for r in near_dedup(clash).collect()) == [(1, 1), (2, 1)]
