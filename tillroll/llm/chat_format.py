"""Chat formatting with a grammar round trip.

A template marks each turn; ``parse_turn``, a deterministic parser of the same
grammar, reads a turn back. A turn is first rendered as it is. If the parser
does not recover its role and text, as when the text holds a control string or
what looks like an escaped one, the parts that conflict are escaped and the turn
is rendered again, until what is recovered equals the source.

The grammar of a conversation (its turns one after the other, nothing between):

    turn := '<s>[INST] ' text ' [/INST]'                      of the user
          | ' ' text ' </s>'                                  of the assistant
          | '<<SYS>>\\n' text '\\n<</SYS>>\\n'                   of the system
          | '[ROLE] ' role ' [TEXT] ' text ' [/TEXT]'         of any other role

No text or role holds a control string: there, one backslash is put after its
first character, and where backslashes stand there already one more
(``[INST]`` -> ``[\\INST]`` -> ``[\\\\INST]``), so taking one away gives the text
back. The parser begins and ends at the same state at the borders of a turn, so
turns that are recovered one by one are recovered from the whole conversation.

``format_turns`` needs no shuffle. ``read_back`` streams each conversation
through the parser in the order of its turns, holding one turn at a time, so a
conversation may be of any length; its digests are those of one sequence, and
so are made in one task.

Results for odd input: null text and null role count as ''; null ids are one
conversation of their own; turns come in ascending order, null first, ties by
role, then by the formatted text, and a repeated row is a turn of its own; a
conversation without an assistant has loss_chars 0 and the digest of ''; an
empty table gives an empty result; other columns are dropped, whatever their
names; texts of any length are formatted whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import texts_in_small_batches

MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/TEXT]")
LEARNT = "assistant"  # whose texts the loss is taken over
# what follows the first character of each control string: <s> </s> <<SYS>> <</SYS>> [INST] [/INST] [ROLE] [TEXT] [/TEXT]
REST = r"(?:/?s>|</?SYS>>|/?INST\]|ROLE\]|/?TEXT\])"
_CONTROL = re.compile(rf"[<\[]{REST}")
_TO_ESCAPE = re.compile(rf"([<\[]\\*)(?={REST})")
_ESCAPED = re.compile(rf"([<\[]\\*)\\(?={REST})")


class Unreadable(ValueError):
    """The text is no sentence of the grammar."""


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int]:
    """A turn, and where its text starts."""
    if role in MARKS:
        start, end = MARKS[role]
    else:
        start, end = f"{OTHER[0]}{role}{OTHER[1]}", OTHER[2]
    return f"{start}{text}{end}", len(start)


def _field(s: str, at: int, end: str) -> tuple[str, int] | None:
    """What stands before the next control string, which must be that of ``end``, and where ``end`` is over.
    None: there is no control string yet."""
    found = _CONTROL.search(s, at)
    if found is None:
        return None
    start = found.start() - len(end) + len(end.lstrip())
    if start < at or not s.startswith(end, start):
        if end.startswith(s[max(start, at):]):
            return None  # the rest of the mark is still to come
        raise Unreadable(f"{end!r} expected before {s[found.start():found.start() + 20]!r}")
    return unescape(s[at:start]), start + len(end)


def parse_turn(s: str, at: int = 0) -> tuple[str, str, int] | None:
    """Role and text of the turn that starts at ``at``, and where it ends; None if it isn't over."""
    for role, (start, end) in MARKS.items():
        if s.startswith(start, at):
            got = _field(s, at + len(start), end)
            return got and (role, *got)
    if s.startswith(OTHER[0], at):
        name = _field(s, at + len(OTHER[0]), OTHER[1])
        got = name and _field(s, name[1], OTHER[2])
        if got and name[0] in MARKS:
            raise Unreadable(f"{name[0]!r} has marks of its own")
        return got and (name[0], *got)
    rest = s[at:]
    if any(m.startswith(rest) for m in (*(start for start, _ in MARKS.values()), OTHER[0])):
        return None
    raise Unreadable(f"no turn starts with {rest[:20]!r}")


def _recovered(turn: str, role: str, text: str) -> bool:
    try:
        return parse_turn(turn) == (role, text, len(turn))
    except Unreadable:
        return False


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and where its text, escaped if it had to be, starts and ends."""
    for name, content in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        turn, start = render(name, content)
        if _recovered(turn, role, text):
            return turn, start, start + len(content)
    raise Unreadable(f"a turn of {role!r} is not recovered from its escaped form")


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        roles = b["role"].to_pylist()
        turns = [format_turn(r, t) for r, t in zip(roles, b["text"].to_pylist(), strict=True)]
        learnt = [r == LEARNT for r in roles]
        spans = [pa.array([t[i] if x else None for t, x in zip(turns, learnt, strict=True)], pa.int64()) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays([b["conv_id"], b["turn"], b["role"], pa.array([t[0] for t in turns], pa.string()), *spans],
                                         ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"])


def format_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, formatted, loss_start, loss_end of ``rows`` (conv_id, turn, role, text).

    A conversation's text is its turns' ``formatted``, one after the other. The
    loss is taken from ``loss_start`` to ``loss_end`` (code points of the turn); null: nowhere."""
    texts_in_small_batches(rows.sparkSession)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    return rows.mapInArrow(_formatted, "conv_id long, turn long, role string, formatted string, loss_start long, loss_end long")


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Reader:
    """Reads the text of one conversation as it comes."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.left, self.n_turns = conv_id, "", 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0

    def feed(self, formatted: str, start: int | None, end: int | None) -> None:
        self.chars += len(formatted)
        if start is not None:
            text = unescape(formatted[start:end])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        s, at = self.left + formatted, 0
        while at < len(s) and (got := parse_turn(s, at)):
            role, text, at = got
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        self.left = s[at:]

    def row(self) -> tuple:
        if self.left:
            raise Unreadable(f"conversation {self.conv_id} ends within a turn")
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    reader = None
    for b in batches:
        done = []
        for conv_id, *turn in zip(*(b[c].to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
            if reader is None or reader.conv_id != conv_id:
                if reader:
                    done.append(reader.row())
                reader = _Reader(conv_id)
            reader.feed(*turn)
        if done:
            yield batch(done)
    if reader:
        yield batch([reader.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """READ rows of what ``format_turns`` gave: every conversation parsed anew from its text."""
    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
            .select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_read, READ))
