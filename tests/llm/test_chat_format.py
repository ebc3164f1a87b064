import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import chat_format
from tillroll.llm.chat_format import Unreadable, _Reader, escape, format_turn, format_turns, parse_turn, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string, formatted int, n_turns string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/TEXT]", "[\\INST]", "<\\\\s>", "<\\<SYS>>",
          "<", "[", "\\", "]", ">", "/", "s>", "INST]", " ", "\n", "a", "é", "😀", " [/INST", "\n<</SYS>>\n", "[ROLE] x [TEXT] "]
texts = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), texts)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digest(conv_id, turns):
    """What is asked for, from the source turns alone but for the length of the formatted text."""
    loss = "".join(t for r, t in turns if r == "assistant")
    return (conv_id, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
            sum(len(format_turn(r, t)[0]) for r, t in turns))


@settings(max_examples=600, deadline=None)
@given(texts)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert unescape(escape(text)) == text and not chat_format._CONTROL.search(escape(text))


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_a_conversation_is_recovered_from_its_text_in_any_pieces(turns):
    done = [format_turn(r, t) for r, t in turns]
    whole, at, got = "".join(d[0] for d in done), 0, []
    while at < len(whole):
        role, text, at = parse_turn(whole, at)
        got.append((role, text))
    assert got == turns
    assert all(unescape(d[a:b]) == t for (d, a, b), (_, t) in zip(done, turns, strict=True))
    reader = _Reader(1)
    for c in whole:
        reader.feed(c, None, None)
    assert reader.row()[:3] == digest(1, turns)[:3] and reader.chars == len(whole)


def test_only_what_conflicts_is_escaped():
    assert format_turn("user", "a [ <b> \\ [x]")[0] == "<s>[INST] a [ <b> \\ [x] [/INST]"
    assert format_turn("user", "</s>[INST] ok [/INST]")[0] == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]"
    assert format_turn("assistant", "[\\INST]")[0] == " [\\\\INST] </s>"
    assert format_turn("tool", "x")[0] == "[ROLE] tool [TEXT] x [/TEXT]"
    assert format_turn("[TEXT]", "[")[0] == "[ROLE] [\\TEXT] [TEXT] [ [/TEXT]"


@pytest.mark.parametrize("bad", ["x", "<s>[INST] a </s>", "<s>[INST] a[/INST]", " a <s>", "[ROLE] user [TEXT] a [/TEXT]", "[INST] a [/INST]"])
def test_other_text_is_unreadable(bad):
    with pytest.raises(Unreadable):
        parse_turn(bad)


def test_an_unfinished_conversation_is_unreadable():
    reader = _Reader(3)
    reader.feed("<s>[INST] a [/INST] b", None, None)
    with pytest.raises(Unreadable):
        reader.row()


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in read_back(format_turns(df)).collect()), key=str)


def test_conversations_on_a_table(spark):
    rng = random.Random(6)
    turns = {i: [(rng.choice(["user", "assistant", "system", "tool"]), "".join(rng.choices(PIECES, k=rng.randrange(9))))
                 for _ in range(rng.randrange(1, 9))] for i in range(60)}
    turns[None] = [("user", "a"), ("assistant", "</s>")]
    turns[100] = [("assistant", "<s> word " * 200_000)]
    turns[101] = [("user", "x"), ("assistant", "y")] * 3000
    rows = [(i, k, r, t) for i, v in turns.items() for k, (r, t) in enumerate(v)]
    rng.shuffle(rows)
    assert run(spark, rows) == sorted((digest(i, v) for i, v in turns.items()), key=str)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, "user", "b"), (1, 0, None, None), (1, 0, "user", "z"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", None)]
    want = [("user", "b"), ("", ""), ("assistant", ""), ("user", "a"), ("user", "a"), ("user", "z")]
    assert run(spark, rows) == run(spark, rows[::-1], 1) == [digest(1, want)]
    assert run(spark, []) == []


def test_loss_spans_are_the_assistants(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<s>ok"), (1, 2, "tool", "t")]
    got = format_turns(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).orderBy("turn").collect()
    assert [(r["loss_start"], r["loss_end"]) for r in got] == [(None, None), (1, 7), (None, None)]
    assert got[1]["formatted"][1:7] == "<\\s>ok"


def test_query_against_plain_code(spark):
    from tillroll.llm.queries import op12_chat_formatting
    sf = "/root/testdata/sf0.001"
    turns = {-1: [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = sorted(tuple(r) for r in op12_chat_formatting(spark, sf).collect())
    assert got == sorted(digest(i, v) for i, v in turns.items())
