"""Packing by minimum bin slack.

A document of more than a window is cut into full windows and a rest. Only the
rests are packed, and only their length histogram (at most ``window - 1``
numbers, whatever the data) reaches the driver. There the longest length left is put
into a window, a bitset dynamic program over the other lengths finds the sum
closest to the space left, the choice is traced back to counts, and the same
pattern is used as often as the counts allow. Spark numbers the rests within
their length and looks up each one's window and offset.

Results for odd input: a null text is empty; every document has one more token,
the end id, so an empty one is a piece of length 1; null ids and repeated rows
are documents of their own; an empty table gives an empty result; very long
texts give many full windows; other input columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, parts_of, spread_rank, stored, texts_in_small_batches
from tillroll.llm.tokens import tokenizer

PIECES = "doc_id {id}, start long, length long, doc_tokens long, ids binary"
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Pattern:
    """``times`` windows that each hold ``counts`` = {length: pieces}."""

    counts: dict[int, int]
    times: int


def closest_fill(space: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths whose sum is closest to ``space`` from below.

    Bit s of the set is on if a sum of s can be reached; each length adds its
    copies by shifts, and the sets in between lead back to the counts.
    """
    if space in counts:
        return {space: 1}
    full = (1 << (space + 1)) - 1
    reached, steps = 1, []
    for length in sorted((x for x in counts if x <= space), reverse=True):
        left = min(counts[length], space // length)
        steps.append((length, left, reached))
        copies = 1
        while left:  # 1, 2, 4 ... copies, then what remains
            k = min(copies, left)
            reached |= reached << (k * length) & full
            left -= k
            copies *= 2
        if reached >> space & 1:
            break
    total, out = reached.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        used = next(k for k in range(most + 1) if total >= k * length and before >> (total - k * length) & 1)
        if used:
            out[length] = used
            total -= used * length
    return out


def minimum_bin_slack(histogram: dict[int, int], window: int) -> list[Pattern]:
    """Patterns that use up the histogram {length: pieces}."""
    left, out = {k: v for k, v in histogram.items() if v}, []
    while left:
        first = max(left)
        rest = dict(left)
        rest[first] -= 1
        pattern = closest_fill(window - first, {k: v for k, v in rest.items() if v}) if first < window else {}
        pattern[first] = pattern.get(first, 0) + 1
        times = min(left[k] // v for k, v in pattern.items())
        out.append(Pattern(pattern, times))
        for k, v in pattern.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
    return out


def token_pieces(docs: DataFrame, window: int = 2048, end_id: int = 1,
                 tokenizer_name: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian unsigned 32-bit)
    of the pieces of every row of ``docs`` (doc_id, text)."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_name).encode
        for batch in batches:
            for part in parts_of(batch, BATCH_BYTES):
                out = []
                for doc, ids in zip(part[0].to_pylist(), encode(part[1].to_pylist()), strict=True):
                    ids += end
                    n = len(ids) // 4
                    out += [(doc, a, min(window, n - a), n, ids[4 * a:4 * (a + window)]) for a in range(0, n, window)]
                yield record(out, batch.schema.field(0).type)

    def record(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          ["doc_id", "start", "length", "doc_tokens", "ids"])

    texts_in_small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(cut, PIECES.format(id=docs.schema["doc_id"].dataType.simpleString()))


def pack(pieces: DataFrame, window: int = 2048, rows: int | None = None) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, start, length of 1 to
    ``window``, any more columns). Sequences are numbered gapless from 0.
    ``rows``: about how many pieces there are, if known."""
    spark = pieces.sparkSession
    uid, columns = fresh(pieces, "_uid"), pieces.columns
    # uid tells repeated ids apart, so that they are numbered in many tasks
    pieces = stored(pieces.withColumn(uid, F.monotonically_increasing_id()), "pieces", rows, spread=True)
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most window rows
    full = histogram.pop(window, 0)
    patterns = minimum_bin_slack(histogram, window)

    # pieces of a length go to the patterns in order: ranks from first_rank on are dealt out, ``each`` to a window
    places, used, first_window = [], {window: full}, full
    if full:
        places.append((window, 0, 1, 0, 0))
    for p in patterns:
        offset = 0
        for length in sorted(p.counts, reverse=True):
            places.append((length, used.get(length, 0), p.counts[length], first_window, offset))
            used[length] = used.get(length, 0) + p.counts[length] * p.times
            offset += length * p.counts[length]
        first_window += p.times
    by_length: dict[int, list] = {}
    for length, *place in places:
        by_length.setdefault(length, []).append(tuple(place))
    plan = spark.createDataFrame(
        list(by_length.items()),
        "length long, places array<struct<first_rank:long,each:long,first_window:long,offset:long>>")

    ranked = spread_rank(pieces, "length", ["doc_id", "start", uid], ["doc_id", "start", uid], "_rank", sum(used.values()))
    # the last place that starts at or before the rank
    place = F.element_at(F.filter("places", lambda p: p["first_rank"] <= F.col("_rank")), -1)
    at = F.col("_rank") - F.col("_place.first_rank")
    return (ranked.join(F.broadcast(plan), "length")  # at most window rows
            .withColumn("_place", place)
            .select(*columns,
                    (F.col("_place.first_window") + F.floor(at / F.col("_place.each"))).cast("long").alias("sequence_id"),
                    (F.col("_place.offset") + at % F.col("_place.each") * F.col("length")).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, window: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: the ids
    themselves are not moved, only their checksum."""
    pieces = token_pieces(docs, window, end_id)
    return pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), window,
                rows=docs.count())
