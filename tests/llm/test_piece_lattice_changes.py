"""The n best of a whole text when few of its words have a second path, and parts that are cut nowhere."""

from tillroll.llm import piece_lattice as PL


def test_no_more_changes_are_tried_than_words_with_a_second_path():
    pieces = PL.lattice()
    for text in ("a", "a a", "the a", "a, b", "  a", "the of and", "\x01 \x02"):
        got = pieces.nbest(text, 4)
        parts = [w for w in pieces.whole.findall(PL.BLANK + text.replace(" ", PL.BLANK)) if w]
        want = [(0.0, b"")]
        for w in parts:  # every path of every word, whole
            want = [(a + s, b + ids) for a, b in want for s, ids in pieces.stretch_nbest(w, 4)]
        scores = sorted((s for s, _ in want), reverse=True)[:4]
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s in scores]
        assert {ids for _, ids in got} <= {ids for _, ids in want}


def test_an_uncut_stretch_is_one_part_and_looked_up_once():
    pieces = PL.lattice()
    for stretch in ("▁the", "▁", "", "▁international"):
        assert pieces.cut(stretch) == [stretch]
    pairs = [a + b for a, b in zip("▁the\x01qé", "the\x01qé", strict=False)]
    assert "".join(pieces.cut("▁the\x01qé")) == "▁the\x01qé" and len(pieces.cut("▁the\x01qé")) == 1 + sum(p not in pieces.joined for p in pairs)


def test_best_of_a_part_is_the_search_s():
    import itertools
    import random
    pieces = PL.lattice()
    assert pieces.exact
    rng = random.Random(4)
    letters = "etaoinshr▁.,E1 é中\x01"
    parts = ["", "a", "▁the", "▁international", "aaaaaa", "\x01\x02"] + ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(2000)]

    def searched(part):
        first, *second = itertools.islice(pieces.search(part), 2)
        return first[1], first[0], first[0] - second[0][0] if second else float("inf")

    calls, search = [], pieces.search
    want = [searched(p) for p in parts]
    pieces.search = lambda part: (calls.append(part), search(part))[1]
    try:
        assert [pieces._best_of_part(p) for p in parts] == want
    finally:
        del pieces.search
    assert set(calls) == {p for p, w in zip(parts, want, strict=True) if w[2] == 0}  # ties alone are searched
