"""Source divergence audit: how far the words of each source of a language are
from those of the others, by chunk factorization.

Every document is cut at white space into chunks. A task numbers the distinct
chunks of a block of documents and keeps each document as chunk numbers and
counts. The chunks of all blocks are dealt by hash into slots; there each
distinct one is tokenized once, and its terms are joined back to the blocks that
hold it, where documents and occurrences of each term are counted. These counts
are dealt by the term into slots, and there added up over all blocks.

Terms are runs of letters (bytes beyond ASCII included), A-Z lower-cased; white
space never lies inside one, so the terms of the chunks are those of the text.
A language keeps the terms that ``min_docs`` of its documents hold. With c
occurrences in a group of N kept ones, a term has
p = 1 + floor(scale * (c + smoothing) / (N + smoothing * V)), V being the number
of the language's kept terms. Part ``pair`` sums |p - q| over all kept terms for
each two sources of a language; part ``term`` lists the terms that a source
holds most beyond its language.

Sizes: a block is ``block_bytes`` of text (the last may be longer) and lies in
one task; a slot's distinct chunks or term counts are held by one, and slots
grow in number with the text. A chunk or term counts once for each block (a term
once for each source there), so no key is hot; the pair sums hold a matrix of a language's sources by themselves in a
task, as many numbers as the result has rows for that language. Nothing passes
through the driver.

Results for odd input: null text, lang and source count as ''; every row is a
document of its own, repeated ids and rows included; a text without a term
still makes its group occur; a language without kept terms has pairs of value 0
and no terms; one source alone has no pairs; ties go to the item first in UTF-8
order; an empty table gives an empty result; other columns are ignored,
whatever their names; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, pairwise
from math import isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import stored, texts_in_small_batches

TERM = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# lower-cases letters and blanks what no term has, as TERM does; bytes beyond ASCII stay
TO_TERMS = bytes(c + 32 if c in UPPER else c if re.match(TERM, bytes([c])) else 32 for c in range(256))
TERMS_A_BUCKET = 2_000  # of the pair sums, so that a large language is spread
ENTRIES = 1 << 21  # of a slot of terms that are held before they are added up
CELLS = 1 << 21  # of a matrix of terms by sources

ENCODED = "block long, slot int, langs array<string>, sources array<string>, sizes binary, ids binary, counts binary, words binary"


def _packed(x: bytes) -> bytes:
    return zstandard.compress(x, 1)


def _unpacked(x: pa.Scalar) -> bytes:
    return zstandard.decompress(x.as_py())


def _numbers(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(_unpacked(x), np.int32)


def _by_slot(words: list[bytes], slots: int) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Slots in ascending order, the words in that order, and each word's place in it."""
    slot = np.fromiter(map(crc32, words), np.uint32, len(words)) % slots
    order = np.argsort(slot, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return slot[order], order.tolist(), place


def encode_blocks(block_bytes: int, slots: int):
    """Arrow batches of (lang, source, text) as ENCODED rows. A block has a row
    (slot -1) of its documents: how many distinct chunks each has, their numbers
    and counts; and a row for each slot, a hash of the chunk, with the chunks
    there. Chunks are numbered by slot, then as they came."""

    def rows_of(block: int, number: dict[bytes, int], langs: list, sources: list, sizes: list, ids: list, counts: list) -> pa.RecordBatch:
        words = list(number)
        slot, order, place = _by_slot(words, slots)
        used, starts = np.unique(slot, return_index=True)
        edges = [*starts.tolist(), len(words)]
        packed = [_packed(b"\n".join([words[i] for i in order[a:b]])) for a, b in pairwise(edges)]
        none = [None] * len(packed)
        numbers = [place[np.array(ids, np.int32)], np.array(counts, np.int32)]
        columns = [[block] * (1 + len(packed)), [-1, *used.tolist()], [langs, *none], [sources, *none],
                   *[[_packed(np.asarray(x, np.int32).tobytes()), *none] for x in (sizes, *numbers)], [None, *packed]]
        kinds = [pa.int64(), pa.int32(), *[pa.list_(pa.string())] * 2, *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          _fields(ENCODED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        number: defaultdict[bytes, int] = defaultdict(count().__next__)
        held: tuple[list, ...] = ([], [], [], [], [])
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")), strict=True):
                chunks = Counter(text.split())  # of bytes: cut at ASCII white space
                langs, sources, sizes, ids, counts = held
                langs.append(lang)
                sources.append(source)
                sizes.append(len(chunks))
                ids += [number[w] for w in chunks]
                counts += chunks.values()
                size += len(text) + 1
                if size >= block_bytes:
                    yield rows_of(block, number, *held)
                    number, held = defaultdict(count().__next__), ([], [], [], [], [])
                    block, size = block + 1, 0
        if size:
            yield rows_of(block, number, *held)

    return run


def terms_of(chunk: bytes) -> list[bytes]:
    """The terms of a chunk, in order."""
    return chunk.translate(TO_TERMS).split()


def tokenize_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks, sorted by slot, as rows of their terms: each distinct chunk is tokenized once."""
    slot, known = None, {}
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            if (now := batch["slot"][i].as_py()) != slot:
                slot, known = now, {}
            words = _unpacked(batch["words"][i]).split(b"\n")
            for w in words:
                if w not in known:
                    known[w] = b" ".join(terms_of(w))
            out.append(_packed(b"\n".join([known[w] for w in words])))
        yield pa.RecordBatch.from_arrays([batch["block"], batch["slot"], pa.array(out, pa.binary())], ["of", "place", "terms"])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal sorted keys start."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


COUNTED = "slot int, langs array<string>, sources array<string>, words binary, numbers binary"


def _fields(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def count_block(slots: int, docs: pa.Table, chunks: pa.Table) -> pa.Table:
    """Documents and occurrences of each term of a block in each of its (lang, source) groups: a row for each slot
    of terms, which holds the terms there and four numbers an entry (term, group, occurrences, documents).

    ``docs`` is the block's row of documents, ``chunks`` the terms of its chunks (place, terms)."""
    lines = b""
    if chunks.num_rows:
        order = np.argsort(chunks["place"].to_numpy()).tolist()
        lines = b"\n".join([_unpacked(chunks["terms"][i]) for i in order]) + b"\n"
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    code = np.array([number[t] for t in lines.split()], np.int64)
    at = np.frombuffer(lines, np.uint8)
    line_ends = np.flatnonzero(at == 10)  # terms of a chunk: blanks before the line's end, and one unless it is empty
    blanks = np.searchsorted(np.flatnonzero(at == 32), line_ends)
    sizes = np.diff(blanks, prepend=0) + (np.diff(line_ends, prepend=-1) > 1)
    ends = np.cumsum(sizes)
    names = list(number)
    slot, by_slot, place = _by_slot(names, slots)  # terms are numbered by slot
    code = place[code]
    group: defaultdict[tuple, int] = defaultdict(count().__next__)
    group_of = np.array([group[x] for x in zip(docs["langs"][0].as_py(), docs["sources"][0].as_py(), strict=True)], np.int64)
    n_terms, n_groups = max(1, len(names)), max(1, len(group))

    doc_sizes, ids, times = (_numbers(docs[c][0]) for c in ("sizes", "ids", "counts"))
    doc = np.repeat(np.arange(len(doc_sizes)), doc_sizes)
    each = sizes[ids]  # terms of each chunk of each document
    before = np.cumsum(each) - each
    term = code[np.repeat(ends[ids] - each - before, each) + np.arange(int(each.sum()))]
    key = np.repeat(doc, each) * n_terms + term
    times = np.repeat(times, each).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = _runs(key)  # a document and a term
    n, key = _sums(times[order], starts), key[starts]
    key = (key % n_terms) * n_groups + group_of[key // n_terms]
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = _runs(key)  # a term and a group
    n, held, key = _sums(n[order], starts), np.diff(np.r_[starts, len(key)]), key[starts]
    term, which = key // n_groups, key % n_groups
    langs, sources = [x for x, _ in group], [x for _, x in group]
    out: list[tuple] = []
    used, firsts = np.unique(slot, return_index=True)
    for s, (a, b) in zip(used.tolist(), pairwise([*firsts.tolist(), len(names)]), strict=True):
        x, y = np.searchsorted(term, [a, b])
        entries = np.stack([term[x:y] - a, which[x:y], n[x:y], held[x:y]])
        out.append((s, langs, sources, _packed(b"\n".join([names[i] for i in by_slot[a:b]])), _packed(entries.tobytes())))
    kinds = [pa.int32(), *[pa.list_(pa.string())] * 2, *[pa.binary()] * 2]
    return pa.Table.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], _fields(COUNTED))


KEPT = "lang string, source string, term string, n long"


class _Slot:
    """Adds up the entries of one slot of terms over all blocks."""

    def __init__(self) -> None:
        self.term, self.lang, self.source = (defaultdict(count().__next__) for _ in range(3))
        self.parts: list[np.ndarray] = []  # (term, lang, source, occurrences, documents)
        self.size, self.limit = 0, ENTRIES

    def add(self, langs: list, sources: list, words: bytes, numbers: bytes) -> None:
        term, group, n, held = np.frombuffer(numbers, np.int64).reshape(4, -1)
        terms = np.array([self.term[t] for t in words.split(b"\n")], np.int64)
        lang, source = (np.array([d[x] for x in v], np.int64) for d, v in ((self.lang, langs), (self.source, sources)))
        self.parts.append(np.stack([terms[term], lang[group], source[group], n, held]))
        self.size += len(n)
        if self.size > self.limit:
            self.total()
            self.limit = max(ENTRIES, 2 * self.size)

    def total(self) -> np.ndarray:
        """One entry for each term, language and source, in this order."""
        x = np.concatenate(self.parts, axis=1)
        x = x[:, np.lexsort(x[2::-1])]
        starts = np.flatnonzero(np.r_[True, (x[:3, 1:] != x[:3, :-1]).any(axis=0)])
        x = np.r_[x[:3, starts], np.add.reduceat(x[3:], starts, axis=1)]
        self.parts, self.size = [x], x.shape[1]
        return x

    def kept(self, min_docs: int) -> pa.RecordBatch:
        """KEPT rows of the terms that enough documents of a language hold; a null source has the language's count."""
        term, lang, source, n, held = self.total()
        starts = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])])
        enough = np.add.reduceat(held, starts) >= min_docs
        some = np.repeat(enough, np.diff(np.r_[starts, len(term)]))
        first = starts[enough]
        columns = [np.r_[lang[some], lang[first]], np.r_[term[some], term[first]], np.r_[n[some], np.add.reduceat(n, starts)[enough]]]
        names = [_strings(list(d)) for d in (self.lang, self.term)]
        sources = pa.array(np.r_[source[some], np.zeros(len(first), np.int64)], pa.int64(),
                           mask=np.r_[np.zeros(int(some.sum()), bool), np.ones(len(first), bool)])
        return pa.RecordBatch.from_arrays([names[0].take(pa.array(columns[0])), _strings(list(self.source)).take(sources),
                                           names[1].take(pa.array(columns[1])), pa.array(columns[2])], _fields(KEPT))


def _strings(x: list) -> pa.Array:
    kind = pa.binary() if x and isinstance(x[0], bytes) else pa.string()
    return pa.array(x, kind).cast(options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))


def keep_terms(min_docs: int):
    """COUNTED rows, sorted by slot, as KEPT rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, now = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if (here := batch["slot"][i].as_py()) != slot:
                    if now:
                        yield now.kept(min_docs)
                    slot, now = here, _Slot()
                now.add(batch["langs"][i].as_py(), batch["sources"][i].as_py(), _unpacked(batch["words"][i]), _unpacked(batch["numbers"][i]))
        if now:
            yield now.kept(min_docs)

    return run


def kept_counts(docs: DataFrame, min_docs: int, block_bytes: int) -> DataFrame:
    """KEPT rows of ``docs`` (lang, source, text)."""
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    slots = max(64, isqrt(size >> 16))  # 64 for up to 256 MB, 40 thousand for 100 TB
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       text.cast("binary").alias("text"))
    encoded = stored(rows.mapInArrow(encode_blocks(block_bytes, slots), ENCODED), "audit-encoded")
    back = (encoded.where("slot >= 0").select("block", "slot", "words").repartition("slot").sortWithinPartitions("slot")
            .mapInArrow(tokenize_slots, "of long, place int, terms binary"))
    held = encoded.where("slot < 0").select("block", "langs", "sources", "sizes", "ids", "counts")
    counted = held.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(
        lambda left, right: count_block(slots, left, right), COUNTED)
    return stored(counted.repartition("slot").sortWithinPartitions("slot").mapInArrow(keep_terms(min_docs), KEPT), "audit-kept")


def pair_sums(terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of |p - q| for each two sources over the terms of a bucket.

    ``terms`` has p where a source holds a term, ``sources`` the p of the terms it doesn't hold."""
    names = sources["source"].combine_chunks()
    absent = sources["absent"].to_numpy().astype(np.int64)
    k = len(names)
    sums = np.zeros((k, k), np.int64)
    if terms.num_rows and k > 1:
        column = {s: i for i, s in enumerate(names.to_pylist())}
        coded = terms["term"].combine_chunks().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        who = np.array([column[s] for s in terms["source"].to_pylist()])
        p = terms["p"].to_numpy()
        order = np.argsort(at, kind="stable")
        at, who, p = at[order], who[order], p[order]
        size = max(1, CELLS // k)
        for a in range(0, len(coded.dictionary), size):
            some = slice(*np.searchsorted(at, [a, a + size]))
            matrix = np.tile(absent[:, None], min(size, len(coded.dictionary) - a))
            matrix[who[some], at[some] - a] = p[some]
            for i in range(k):
                sums[i] += np.abs(matrix - matrix[i]).sum(axis=1)
    i, j = np.nonzero(~np.eye(k, dtype=bool))
    lang = sources["lang"].combine_chunks().take(pa.array(i))
    return pa.Table.from_arrays([lang, names.take(pa.array(i)), names.take(pa.array(j)), pa.array(sums[i, j])],
                                ["lang", "source", "item", "value"])


def audit_sources(docs: DataFrame, min_docs: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50,
                  block_bytes: int = 16 << 20) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (lang, source, text)."""
    kept = kept_counts(docs, min_docs, block_bytes)
    texts_in_small_batches(docs.sparkSession, 20_000)  # from here on rows are short
    totals = kept.where("source is null").select("lang", "term", F.col("n").alias("lang_n"))
    counts = kept.where("source is not null")
    groups = (docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
              .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("group_total")), ["lang", "source"], "left")
              .join(totals.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
              .na.fill(0, ["group_total", "v", "lang_total"]))
    groups = stored(groups, "audit-groups")

    def p(n: Column, total: Column) -> Column:
        part = (n + smoothing).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")  # exact beyond 64 bits
        return F.call_function("div", part, total + smoothing * F.col("v")) + 1

    rated = counts.join(totals, ["lang", "term"]).join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "v", p(F.col("n"), F.col("group_total")).alias("p"), p(F.col("lang_n"), F.col("lang_total")).alias("q"))
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))

    buckets = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / TERMS_A_BUCKET))
    spread = rated.select("lang", F.pmod(F.xxhash64("term"), buckets).alias("bucket"), "source", "term", "p")
    sides = groups.select(F.col("lang").alias("lang"), F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("bucket"), "source",
                          F.when(F.col("v") > 0, p(F.lit(0).cast("long"), F.col("group_total"))).otherwise(0).alias("absent"))
    pairs = (spread.groupBy("lang", "bucket").cogroup(sides.groupBy("lang", "bucket"))
             .applyInArrow(pair_sums, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(best)))
    return pairs.unionByName(terms)
