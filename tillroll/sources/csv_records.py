"""CSV records whose quoted fields hold line breaks, from files that stay splittable.

A split of a file doesn't know whether it starts within quotes. So one pass
works out, for each split, the state (outside or within quotes) that it ends in
for either state it may start in. These maps are composed along each file with
window functions over one narrow row a split, which gives every split its true
start. A second pass joins the lines of each split to records; the few that
cross a border, at most two pieces a split, are put together in Spark. Lines are
not shuffled. The records are stored, so that the second pass runs once.

A quote opens a field only where the field begins; within quotes two quotes
stand for one. Line breaks within quotes stay as they are; a record's own ends
(``\\n`` or ``\\r\\n``) and empty records are dropped. A quote that is never closed
makes one record up to the end of its file, not ``closed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.sources.sinks import materialize

BROADCAST_SPLITS = 1_000_000
# a line whose quoted fields all begin and end in it
WHOLE_LINE = r'^(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)(?:,(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+))*+\r?$'


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split), id (order within it), the line's bytes, and whole: from outside it ends outside."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("line"), _whole().alias("whole")))


def _whole() -> Column:
    line = F.col("value")
    return ~line.contains('"') | line.rlike(WHOLE_LINE)


def has_broken_fields(spark: SparkSession, path: str) -> bool:
    """Whether a line has quotes that are not those of fields within the line."""
    return not spark.read.option("lineSep", "\n").text(path).where(~_whole()).isEmpty()


def ends_within(line: bytes, within: bool) -> bool:
    """The state after a line, from the state before it."""
    at = 0
    while True:
        if within:
            quote = line.find(b'"', at)
            if quote < 0:
                return True
            if line[quote + 1:quote + 2] == b'"':
                at = quote + 2
                continue
            within, at = False, quote + 1
        elif line[at:at + 1] == b'"':
            within, at = True, at + 1
            continue
        comma = line.find(b",", at)
        if comma < 0:
            return False
        at = comma + 1


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split the states that it ends in."""
    found: dict[tuple, list[bool]] = {}
    for b in batches:
        for file, start, line, whole in zip(*(b[c].to_pylist() for c in ("file", "start", "line", "whole")), strict=True):
            state = found.setdefault((file, start), [False, True])
            if state[0] == state[1]:  # they stay equal
                if state[0] or not whole:
                    state[:] = [ends_within(line, state[0])] * 2
            elif b'"' in line:
                state[:] = [ends_within(line, s) for s in state]
    rows = [(f, s, int(a), int(b)) for (f, s), (a, b) in found.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32()))],
                                     ["file", "start", "from_outside", "from_within"])


def split_states(rows: DataFrame) -> DataFrame:
    """file, start, within (1: the split starts within quotes) of each split of ``lines``."""
    maps = rows.select("file", "start", "line", "whole").mapInArrow(_split_maps, "file string, start long, from_outside int, from_within int")
    along = W.partitionBy("file").orderBy("start")  # a row for each split
    before = along.rowsBetween(W.unboundedPreceding, -1)
    fixed = F.col("from_outside") == F.col("from_within")  # whatever it starts in
    turns = F.sum((F.col("from_outside") > F.col("from_within")).cast("int")).over(along)
    maps = maps.withColumn("turns", turns)
    last = F.last(F.when(fixed, F.struct("from_outside", "turns")), ignorenulls=True).over(before)
    turned = F.coalesce(F.max("turns").over(before), F.lit(0)) - F.coalesce(last["turns"], F.lit(0))
    return maps.select("file", "start", ((F.coalesce(last["from_outside"], F.lit(0)) + turned) % 2).alias("within"))


PIECES = "file string, start long, seq long, head boolean, closed boolean, first boolean, value string"


def _pieces(encoding: str):
    """Records of the splits; what comes before the first one of a split that starts within quotes is a piece
    without a head, and the last one may not be closed."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        split, seq, head, state, held = None, 0, True, False, []

        def put(closed: bool) -> None:
            nonlocal seq, held
            text = b"\n".join(held)
            if closed:
                text = text.removesuffix(b"\r")
            if text or not (head and closed):
                out.append((*split, seq, head, closed, head and split[1] == 0 and seq == 0, text.decode(encoding, "replace")))
                seq += 1
            held = []

        for b in batches:
            for file, start, within, line, whole in zip(*(b[c].to_pylist() for c in ("file", "start", "within", "line", "whole")), strict=True):
                if (file, start) != split:
                    if held:
                        put(False)
                    split, seq, state = (file, start), 0, bool(within)
                    head = not state
                held.append(line)
                state = ends_within(line, state) if state or not whole else False
                if not state:
                    put(True)
                    head = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if held:
            put(False)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def read_records(spark: SparkSession, path: str, encoding: str = "UTF-8", broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """value (the record's text), first (it is its file's first), closed of every record."""
    rows = lines(spark, path)
    states = split_states(rows)
    if states.limit(broadcast_splits + 1).count() <= broadcast_splits:
        told = rows.join(F.broadcast(states), ["file", "start"])  # the order of the lines stays
    else:
        told = rows.join(states, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "id")
    pieces = materialize(told.select("file", "start", "within", "line", "whole").mapInArrow(_pieces(encoding), PIECES), "csv-records")
    whole = F.col("head") & F.col("closed")
    parts = pieces.where(~whole)  # at most two a split
    parts = parts.withColumn("record", F.sum(F.col("head").cast("int")).over(W.partitionBy("file").orderBy("start", "seq")))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "seq", "value"))), lambda x: x["value"])
    joined = (parts.groupBy("file", "record").agg(F.array_join(texts, "\n").alias("value"), F.max("first").alias("first"), F.max("closed").alias("closed"))
              .select("value", "first", "closed"))
    return pieces.where(whole).select("value", "first", "closed").unionByName(joined)
