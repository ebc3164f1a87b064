"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 63-bit ring; a key belongs to the first
point clockwise of its own position. A shard takes rows only up to its
capacity. Its own keys come first, in ring order; rows beyond the capacity move
on clockwise to the next point whose shard has room. With ``slack`` 0 the
capacities add up to the row count, so shard counts differ by at most one; with
a larger slack a shard may hold (1 + slack) times the mean and fewer rows move.

Spark counts rows by ring arc and numbers rows within an arc; only the arc
counts (shards x vnodes rows, whatever the data) reach the driver, which walks
the ring once and returns rank ranges.

Results for odd input: null text has size 1 and crc32 0; null ids hash like one
key and still spread over shards by overflow; repeated rows are separate rows
of the same key; an empty table gives an empty result; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import spread_rank, stored, texts_in_small_batches

_RING = 2**63


@dataclass(frozen=True)
class Piece:
    """Rows ``lo <= rank < hi`` of an arc go to ``shard`` from slot ``slot`` on."""

    arc: int
    lo: int
    hi: int
    shard: int
    slot: int


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of each virtual node, clockwise."""
    points = {}
    for s in range(shards):
        for v in range(vnodes):
            points.setdefault(xxhash.xxh64_intdigest(f"shard-{s}-node-{v}") % _RING, s)
    return sorted(points.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [max(1, -(-int(rows * (1 + slack) * 1000) // (1000 * shards)))] * shards


def bounded_loads(owner: list[int], counts: dict[int, int], caps: list[int]) -> list[Piece]:
    """Rank ranges by shard. ``owner``: the shard of each arc in ring order;
    ``counts``: rows by arc; the capacities must hold all rows."""
    room, used, pieces = list(caps), [0] * len(caps), []
    spare = []  # (arc, lo, hi) that found its shard full

    def put(arc: int, lo: int, hi: int, shard: int) -> int:
        take = min(hi - lo, room[shard])
        if take:
            pieces.append(Piece(arc, lo, lo + take, shard, used[shard]))
            room[shard] -= take
            used[shard] += take
        return lo + take

    for arc in range(len(owner)):
        lo = put(arc, 0, counts.get(arc, 0), owner[arc])
        if lo < counts.get(arc, 0):
            spare.append((arc, lo, counts[arc]))
    for arc, lo, hi in spare:
        at = arc
        while lo < hi:
            at = (at + 1) % len(owner)
            if room[owner[at]]:
                lo = put(arc, lo, hi, owner[at])
            elif not any(room):
                raise ValueError("capacities don't hold all rows")
    return pieces


def assign_shards(docs: DataFrame, shards: int = 16, vnodes: int = 64, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    points = ring_points(shards, vnodes)
    starts, owner = [p for p, _ in points], [s for _, s in points]
    at = F.xxhash64("doc_id").bitwiseAND(F.lit(_RING - 1))
    rows = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"), at.alias("at"))

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, position.to_numpy()) % len(starts))

    # uid tells repeated rows apart, so that they are numbered in many tasks
    rows = stored(rows.withColumns({"arc": arc_of("at"), "uid": F.monotonically_increasing_id()}), "shard-rows", rows=docs.count(), spread=True)
    counts = {r[0]: r[1] for r in rows.groupBy("arc").count().collect()}  # one row for each ring arc at most
    total = sum(counts.values())
    pieces = bounded_loads(owner, counts, capacities(total, shards, slack))
    ranked = spread_rank(rows, "arc", ["doc_id", "size", "text_crc32", "uid"], ["at", "doc_id", "size", "text_crc32", "uid"],
                         "rank", max(1, total // len(owner)), least=16)
    by_arc: dict[int, list[Piece]] = {}
    for p in pieces:
        by_arc.setdefault(p.arc, []).append(p)
    plan = spark.createDataFrame(
        [(arc, [(p.lo, p.hi, p.shard, p.slot) for p in ps]) for arc, ps in by_arc.items()],
        "arc int, pieces array<struct<lo:long,hi:long,shard:int,slot:long>>")
    piece = F.filter("pieces", lambda p: (F.col("rank") >= p["lo"]) & (F.col("rank") < p["hi"]))[0]
    return (ranked.join(F.broadcast(plan), "arc").withColumn("piece", piece)
            .select("doc_id", "size", "text_crc32", F.col("piece.shard").alias("shard"),
                    (F.col("piece.slot") + F.col("rank") - F.col("piece.lo")).alias("slot")))
