"""SentencePiece encoding and decoding: the n best segmentations of whole texts.

A text, its blanks written as U+2581 with one in front, is a lattice: nodes
between characters, an edge for each piece of the vocabulary that fits, with
the piece's score in the model file; a character without a piece has one edge
with the lowest score less ten, spelt in byte pieces. A forward Viterbi pass
gives the best score from the start to every node. Those scores are an exact
heuristic for a backward A* search from the end, which therefore completes
paths in order of their score.

Where no piece of the vocabulary holds two neighbouring characters, every path
passes between them. The search works on the parts between such places (words,
marks), which repeat, and the n best of a text come from the parts whose second
path loses least.

Results for odd input: null and empty texts have one segmentation, of no pieces
and score 0; fewer than n paths are all returned; equal scores keep the order
in which the search completes them; repeated rows and null ids are segmented
row by row; an empty table gives an empty result; texts of any length are
segmented whole; other input columns are ignored, whatever their names.
Decoding gives the text back, except that U+2581 itself becomes a blank.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from functools import cache
from operator import add

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import parts_of, texts_in_small_batches

BLANK = "▁"
KEPT = 450_000  # words, and parts, that a worker remembers, and as many that it used before those
BATCH_BYTES = 4 << 20
Path = tuple[float, bytes]  # score, ids as little-endian unsigned 32-bit


class Memory:
    """The best path's ids and score, and what the second loses, of what was
    asked last: two generations of KEPT entries."""

    def __init__(self):
        self.new: dict[str, tuple[bytes, float, float]] = {}
        self.old: dict[str, tuple[bytes, float, float]] = {}

    def find(self, key: str, make) -> tuple[bytes, float, float]:
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key) or make(key)
            if len(self.new) > KEPT:
                self.new, self.old = {}, self.new
            self.new[key] = got
        return got


class PieceLattice:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces: dict[str, tuple[float, bytes]] = {}
        spelling: list[bytes] = []  # what each id decodes to
        byte_ids: dict[int, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:-1], 16)] = i
                spelling.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelling.append(b"")
            else:
                self.pieces[piece] = (model.get_score(i), i.to_bytes(4, "little"))
                spelling.append(piece.replace(BLANK, " ").encode())
        self.spelling = np.array(spelling, object)
        self.byte_ids = [byte_ids[b].to_bytes(4, "little") for b in range(256)]
        self.unknown = min(s for s, _ in self.pieces.values() if s > -1e8) - 10
        self.exact = all(s.is_integer() and s > -2**31 for s, _ in self.pieces.values())  # any order of adding gives the same
        self.longest = max(map(len, self.pieces))
        self.finder = ahocorasick.Automaton()
        for piece, (score, ids) in self.pieces.items():
            self.finder.add_word(piece, (len(piece), score, ids))
        self.finder.make_automaton()
        self.single = {p for p in self.pieces if len(p) == 1}
        self.joined = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.whole = re.compile(f"{BLANK}*[^{BLANK}]*")
        self.words, self.parts = Memory(), Memory()  # words with a blank in front, and parts as they stand

    # -- the lattice of one part ------------------------------------------

    def _found(self, part: str) -> Iterator[tuple[int, tuple[int, float, bytes]]]:
        """The lattice's edges by their last characters: size, score, ids."""
        found = self.finder.iter(part)  # all pieces in the part, by their ends
        if not self.single.issuperset(part):
            spelt = [(i, (1, self.unknown, b"".join([self.byte_ids[x] for x in c.encode()])))
                     for i, c in enumerate(part) if c not in self.single]
            found = heapq.merge(found, spelt, key=lambda x: x[0])
        return found

    def _edges(self, part: str) -> tuple[list[list[tuple[int, float, bytes]]], list[float]]:
        """For each node the edges that end there (start, score, ids), and the
        best score from the start, by a forward Viterbi pass."""
        edges: list[list] = [[] for _ in range(len(part) + 1)]
        best = [0.0] + [-float("inf")] * len(part)
        for end, (size, score, ids) in self._found(part):
            end += 1
            a = end - size
            edges[end].append((a, score, ids))
            score += best[a]
            if score > best[end]:
                best[end] = score
        return edges, best

    def search(self, part: str) -> Iterator[Path]:
        """All segmentations of a part, the best first."""
        edges, best = self._edges(part)
        count, push = itertools.count(), heapq.heappush
        agenda = [(-best[-1], len(part), 0, 0.0, None)]  # ties: whoever is nearer to the start
        while agenda:
            _, at, _, score, path = heapq.heappop(agenda)
            if not at:
                ids = []
                while path:
                    ids.append(path[0])
                    path = path[1]
                yield score, b"".join(ids)
                continue
            for a, s, ids in edges[at]:
                g = score + s
                push(agenda, (-(g + best[a]), a, next(count), g, (ids, path)))

    # -- whole texts ----------------------------------------------------------

    def cut(self, stretch: str) -> list[str]:
        """The parts between places that no piece spans."""
        if self.joined.issuperset(map(add, stretch, stretch[1:])):
            return [stretch]
        at = [i for i in range(1, len(stretch)) if stretch[i - 1:i + 1] not in self.joined]
        return [stretch[a:b] for a, b in zip([0, *at], [*at, len(stretch)], strict=True)]

    def _best_of_part(self, part: str) -> tuple[bytes, float, float]:
        """By the two best scores of every node. Where scores tie, or don't add up exactly, the search decides."""
        if self.exact:
            none = -float("inf")
            best, second, back = [0.0] + [none] * len(part), [none] * (len(part) + 1), [None] * (len(part) + 1)
            for end, edge in self._found(part):
                end += 1
                a, score = end - edge[0], edge[1]
                through = best[a] + score
                if through > best[end]:
                    other = second[a] + score
                    second[end] = best[end] if best[end] > other else other
                    best[end], back[end] = through, edge
                elif through > second[end]:
                    second[end] = through
            if best[-1] > second[-1]:
                ids, at = [], len(part)
                while at:
                    edge = back[at]
                    ids.append(edge[2])
                    at -= edge[0]
                ids.reverse()
                return b"".join(ids), best[-1], best[-1] - second[-1]
        first, *second = itertools.islice(self.search(part), 2)
        return first[1], first[0], first[0] - second[0][0] if second else float("inf")

    def best_of(self, stretch: str) -> tuple[bytes, float, float]:
        each = [self.parts.find(p, self._best_of_part) for p in self.cut(stretch)]
        if len(each) == 1:
            return each[0]
        return b"".join([e[0] for e in each]), sum([e[1] for e in each]), min([e[2] for e in each])

    def _best_of_word(self, word: str) -> tuple[bytes, float, float]:
        return self.best_of(BLANK + word)

    def nbest(self, text: str | None, n: int) -> list[Path]:
        """The n best segmentations of a whole text, best first."""
        if not text:
            return [(0.0, b"")]
        if BLANK in text or "  " in text or text[0] == " ":  # runs of blanks: stretches as they stand
            stretches = [s for s in self.whole.findall(BLANK + text.replace(" ", BLANK)) if s]
            got, lead = [self.parts.find(s, self.best_of) for s in stretches], ""
        else:
            stretches, find, make = text.split(" "), self.words.find, self._best_of_word
            known = self.words.new.get
            got, lead = [known(s) or find(s, make) for s in stretches], BLANK
        score, spelt = sum([g[1] for g in got]), [g[0] for g in got]
        out = [(score, b"".join(spelt))]
        if n == 1:
            return out
        # n - 1 single changes beat any path that needs another stretch
        losses, few = [g[2] for g in got], []
        for _ in range(min(n - 1, len(got))):
            loss = min(losses)
            if loss == float("inf"):
                break
            few.append((loss, losses.index(loss)))
            losses[few[-1][1]] = float("inf")
        combined: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
        for _, i in few:
            paths = self.stretch_nbest(lead + stretches[i], n)
            combined = heapq.nsmallest(n, [
                (lost + paths[0][0] - s, {**change, i: ids} if k else change)
                for lost, change in combined for k, (s, ids) in enumerate(paths)], key=lambda x: x[0])
        for lost, change in combined[1:]:
            ids, at, done = [], 0, 0
            for i in sorted(change):
                start = done + sum(map(len, spelt[at:i]))
                ids += [out[0][1][done:start], change[i]]
                at, done = i + 1, start + len(spelt[i])
            out.append((score - lost, b"".join([*ids, out[0][1][done:]])))
        return out

    def stretch_nbest(self, stretch: str, n: int) -> list[Path]:
        combined: list[Path] = [(0.0, b"")]
        for part in self.cut(stretch):
            paths = list(itertools.islice(self.search(part), n))
            combined = heapq.nsmallest(n, [(a + s, b + ids) for a, b in combined for s, ids in paths], key=lambda x: -x[0])
        return combined

    def decode(self, ids: bytes) -> str:
        text = b"".join(self.spelling[np.frombuffer(ids, "<u4")].tolist()).decode("utf-8", "replace")
        return text.removeprefix(" ")


@cache
def lattice(name: str = "piece_bpe_32k.model") -> PieceLattice:
    return PieceLattice(public_tokenizers.path(name))


def ranked(pieces: PieceLattice, text: str | None, n: int) -> list[tuple[int, float, bytes, bool]]:
    """Rank, score, ids and round trip of each of a text's n best paths; every path is decoded for itself."""
    want = (text or "").replace(BLANK, " ")
    return [(k, score, ids, pieces.decode(ids) == want) for k, (score, ids) in enumerate(pieces.nbest(text, n), 1)]


def nbest_segmentations(docs: DataFrame, n: int = 3, with_ids: bool = True, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, rank, score, n_pieces, ids (little-endian unsigned 32-bit; on
    demand), ids_crc32 and round_trip (decoding the path's ids gives the document's
    text) of every row of ``docs`` (doc_id, text)."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model)
        for batch in batches:
            for part in parts_of(batch, BATCH_BYTES):
                rows = []
                for doc, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                    rows += [(doc, k, score, len(ids) // 4, *([ids] if with_ids else []), zlib.crc32(ids), same)
                             for k, score, ids, same in ranked(pieces, text, n)]
                types = [part.schema.field(0).type, pa.int32(), pa.float64(), pa.int64(), *([pa.binary()] if with_ids else []),
                         pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names)

    texts_in_small_batches(docs.sparkSession)
    ids = "ids binary, " if with_ids else ""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rank int, score double, n_pieces long, {ids}ids_crc32 long, round_trip boolean"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.mapInArrow(segment, schema)
