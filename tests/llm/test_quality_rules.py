import random
import re
from collections import Counter

import pytest

from tillroll.llm.quality_rules import SYMBOLS, THRESHOLDS, Threshold, compile_rules, judge_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in SYMBOLS),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}


def texts():
    rng = random.Random(9)
    out = ["", None, " \t\n", "one", "one two", "a b c", "a b c a b c", "a a a", "a a a a", "x\n\nx\n x\nx", "#*$%&|<> é𝄞 <<",
           "a\x0bb\x0cc\rd a b c d", "a\x1cb\x85c", "w " * 5000, " ".join(str(i) for i in range(30000))]
    for _ in range(150):
        words = [rng.choice(["the", "of", "Ab,", "cd", "éf", "#x", "\n", " \t"]) for _ in range(rng.randrange(200))]
        out.append(" ".join(words))
    return out


def test_counts_against_plain(make_docs):
    docs = list(enumerate(texts()))
    rows = {r["doc_id"]: r for r in judge_quality(make_docs(docs)).collect()}
    assert len(rows) == len(docs)
    for i, t in docs:
        want = plain(t)
        assert {k: rows[i][k] for k in want} == want, repr(t)[:80]
        assert rows[i]["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        if rows[i]["base_failed"]:
            assert rows[i]["kept"] is False


def test_verdict_is_that_of_the_table(make_docs):
    prose = " ".join(f"the w{i} of und x{i} de y{i} en z{i}" for i in range(20))
    docs = [(1, prose), (2, prose.upper().replace(" ", "!! ")), (3, prose.replace(" ", "### ")), (4, " ".join(f"{i}a" for i in range(99))),
            (5, "\n".join(["le la les un"] * 9 + [f"q{i} the r{i}" for i in range(20)])), (1, prose), (None, prose)]
    got = [(r["doc_id"], r["kept"]) for r in judge_quality(make_docs(docs)).collect()]
    assert sorted(got, key=str) == sorted([(1, True), (1, True), (None, True), (2, False), (3, False), (4, False), (5, True)], key=str)
    strict = [*THRESHOLDS, Threshold("n_words", None, 10)]
    assert not any(r["kept"] for r in judge_quality(make_docs(docs), strict).collect())


def test_one_projection_without_user_functions(make_docs):
    assert set(compile_rules(THRESHOLDS)) == {f"ok_{t.metric}" for t in THRESHOLDS}
    plan = judge_quality(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan and "Arrow" not in plan
    assert "Aggregate" not in plan


def test_empty_table_and_clashing_columns(make_docs):
    assert judge_quality(make_docs([], 1)).count() == 0
    clash = make_docs([(1, "a b c a b c")]).selectExpr("*", "1 as words", "2 as grams", "3 as n_words", "true as kept")
    row, = judge_quality(clash).collect()
    assert (row["n_words"], row["n_repeat_words"], row["kept"]) == (6, 6, False)


@pytest.mark.parametrize("bad", [None, 3])
def test_text_of_another_type(spark, bad):
    row, = judge_quality(spark.createDataFrame([(1, bad)], "doc_id int, text int")).collect()
    assert row["n_words"] == (0 if bad is None else 1)
