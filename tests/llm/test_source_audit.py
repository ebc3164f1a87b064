import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tillroll.llm import source_audit
from tillroll.llm.queries import op11_source_audit
from tillroll.llm.source_audit import audit_sources, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, term int, block string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_docs=30, top=50):
    docs = [(t or "", x or "", s or "") for t, x, s in docs]
    held, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        terms = Counter(TERM.findall(text.translate(LOWER)))
        held[lang].update(terms.keys())
        counts[lang, source].update(terms)
        counts[lang].update(terms)
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]

        def p(group):
            total = sum(counts[group][t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[group][t] + 5) // total for t in kept}

        q = p(lang)
        all_p = {s: p((lang, s)) for s in names}
        for s in names:
            pairs = sorted((-sum(abs(all_p[s][t] - all_p[o][t]) for t in kept), o.encode(), o) for o in names if o != s)
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            terms = sorted((q[t] - all_p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and all_p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


def audited(spark, docs, parts=3, **kw):
    rows = [(i, *d, 1, "x") for i, d in enumerate(docs)]
    got = audit_sources(spark.createDataFrame(rows, SCHEMA).repartition(parts), **kw)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(r) for r in got.collect())


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "the,", "(the)", "river-side", "river", "RIVER", "été", "Été", "a b", "x1y2", "--", "12",
             *[f"w{chr(97 + i)}" for i in range(26)]]
    out = []
    for _ in range(n):
        lang = rng.choice(["en", "fr"])
        source = rng.choice(["s0"] * 5 + ["s1", "s2", "ü"])
        pool = words if source != "s1" else words[:20]
        out.append((rng.choice([" ", "\n", "\t "]).join(rng.choices(pool, k=rng.randrange(0, 40))), lang, source))
    return out


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 300}, {"block_bytes": 1}, {"top": 2, "min_docs": 3}])
def test_against_brute_force(spark, kw):
    docs = corpus()
    want = brute(docs, kw.get("min_docs", 30), kw.get("top", 50))
    assert {r[2] for r in want} == {"pair", "term"} and audited(spark, docs, **kw) == want


def test_entries_are_added_up_early_and_late(monkeypatch):
    rng = random.Random(4)
    want, held = Counter(), Counter()
    monkeypatch.setattr(source_audit, "ENTRIES", 10)
    slot = source_audit._Slot()
    for _ in range(40):
        terms, groups = rng.sample([b"a", b"b", b"c", b"d"], 3), rng.sample([(x, y) for x in "pq" for y in "uvw"], 4)
        entries = [(t, g, rng.randrange(1, 9), 1) for t in range(3) for g in range(4) if rng.random() < 0.5]
        for t, g, n, d in entries:
            want[groups[g][0], groups[g][1], terms[t].decode()] += n
            want[groups[g][0], None, terms[t].decode()] += n
            held[groups[g][0], terms[t].decode()] += d
        numbers = np.array(entries, np.int64).reshape(-1, 4).T
        slot.add([g[0] for g in groups], [g[1] for g in groups], b"\n".join(terms), numbers.tobytes())
    rows = slot.kept(30).to_pylist()
    assert {(r["lang"], r["source"], r["term"]): r["n"] for r in rows} == {k: v for k, v in want.items() if held[k[0], k[2]] >= 30}
    assert len(rows) > 8 and min(held.values()) < 30


def test_pair_sums_in_small_buckets_and_matrices(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "TERMS_A_BUCKET", 4)
    docs = corpus(200, 5)
    assert audited(spark, docs, min_docs=5) == brute(docs, 5)


def test_odd_input(spark):
    docs = corpus(100) + corpus(100) + [(None, None, None), ("", "", "x"), (None, "en", "empty"), ("12 -- ", "xx", "a"), (None, "xx", "b"),
                                        ("one word " * 40_000, "en", "long"), ("y" * 300_000, "en", "long"), ("the " * 50, None, "s0")]
    got = audited(spark, docs)
    assert got == brute(docs)
    assert ("xx", "a", "pair", "b", 0, 1) in got and ("", "", "pair", "s0", 0, 1) in got


def test_empty_table_and_one_source(spark):
    assert audited(spark, [], 1) == []
    docs = [("the river", "en", "s0")] * 40
    assert audited(spark, docs) == []
    assert audited(spark, [*docs, ("the", "en", "s1")]) == brute([*docs, ("the", "en", "s1")])


def test_terms_of_a_chunk():
    for t in ["", "A-b_c", "ÉTÉ12x", "[x]{y}`@", *map(chr, range(300)), "".join(map(chr, range(300)))]:
        assert [x.decode() for x in terms_of(t.encode())] == TERM.findall(t.translate(LOWER))


def test_each_distinct_chunk_is_tokenized_once(monkeypatch):
    batch = pa.RecordBatch.from_pydict({
        "block": pa.array([0, 1, 1], pa.int64()), "slot": pa.array([3, 3, 4], pa.int32()),
        "words": pa.array([zstandard.compress(x) for x in (b"a,\n--\nb-C", b"a,\nb-C\nx", b"x")], pa.binary())})
    seen = []
    monkeypatch.setattr(source_audit, "terms_of", lambda w: seen.append(w) or w.translate(source_audit.TO_TERMS).split())
    out, = source_audit.tokenize_slots([batch])
    assert [zstandard.decompress(x.as_py()) for x in out["terms"]] == [b"a\n\nb c", b"a\nb c\nx", b"x"]
    assert seen == [b"a,", b"--", b"b-C", b"x", b"x"]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang", "source").collect()
    got = sorted(tuple(r) for r in op11_source_audit(spark, "/root/testdata/sf0.001").collect())
    assert got == brute([tuple(r) for r in docs])
