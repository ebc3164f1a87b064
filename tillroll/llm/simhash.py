"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprint: 64 bits; a bit is 1 if it is set in over half of the XXH64 hashes
of the text's word shingles. Fingerprints at most ``max_bits`` bits apart link,
and linked documents form components.

Candidates. Equal fingerprints are one entry from the start. The 64 bits are cut
into segments; two fingerprints within ``max_bits`` agree on all but that many
segments, so every choice of the other segments is an uppermost masked bit
pattern, and entries that share one meet in a node. Within a node, entries are
sorted by Gray rank, runs of four give a parent holding the bits that they
share, and so on up to one root. Pairs of nodes are compared from the root
down on the bits that both fix; a pair whose differences exceed ``max_bits`` goes
with all that is below it. A node returns a spanning link for each entry, not pairs.

A node of more than ``node_limit`` entries (a large group of near copies) is
not built in one task: its entries meet, exactly too, at every code within one
bit of them, where at most 65 different entries can meet. (That holds for
``max_bits`` 2; with another distance every node is indexed whole.)

Components come from large-star and small-star rounds over the links between
different fingerprints, each round written to the shared folder.

Results for odd input: null, empty and blank texts have fingerprint zero and
link like any other; fewer words than a shingle give one shingle of all words;
a null id takes part in linking but is never a component id (a component of
null ids alone has a null one); repeated rows each get a row; an empty table
gives an empty result; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, stored, texts_in_small_batches

FANOUT = 4
SLICE = 1 << 20  # bytes of a text worked on at a time
PAIRS = 1 << 16  # node pairs expanded at a time
CHUNK = 200_000  # entries of a task indexed at a time
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ALL = (1 << 64) - 1


def _word_slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in parts that end between words."""
    at = 0
    while at < len(data):
        end = len(data)
        if at + SLICE < end and (m := _BLANK.search(data, at + SLICE)):
            end = m.start()
        yield data[at:end].split()  # of bytes: at ASCII white space
        at = end


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text; its words are lower-cased in ASCII only."""
    ones, n, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for part in _word_slices((text or "").encode().lower()):
        words = carry + part
        if len(words) >= shingle:
            line = b" ".join(words)
            ends = list(itertools.accumulate(len(w) + 1 for w in words))
            starts = [0, *ends]
            hashes = np.array([digest(line[a:b - 1], seed)
                               for a, b in zip(starts, ends[shingle - 1:], strict=False)], np.uint64)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(hashes)
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if not n:
        return digest(b" ".join(carry), seed) if carry else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("long")
    def simhash(t: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(x, shingle) for x in t.to_pylist()], np.uint64).view(np.int64))

    return simhash.asNondeterministic()(text.cast("string"))


def segment_masks(entries: int, max_bits: int, per_node: int = 64) -> list[int]:
    """Bit masks of the uppermost patterns: every choice of all but ``max_bits``
    segments. More entries get more segments, so that a node of evenly spread
    fingerprints has about ``per_node`` entries at most."""
    for segments in range(max_bits + 1, 65):
        cuts = [64 * i // segments for i in range(segments + 1)]
        part = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
        masks = [sum(c) for c in itertools.combinations(part, segments - max_bits)]
        if entries <= per_node << min(m.bit_count() for m in masks) or segments >= 2 * max_bits + 2:
            return masks
    raise ValueError("max_bits must be below 64")


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code ^ (code >> np.uint64(s))
    return code


class GrayIndex:
    """Hierarchical index over the entries of many nodes at once.

    Level 0 are the entries, sorted by node and Gray rank. A parent stands for
    up to FANOUT neighbours of the same node; ``mask`` has the bits in which
    they agree, ``value`` those bits.
    """

    def __init__(self, node: np.ndarray, code: np.ndarray):
        order = np.lexsort((gray_rank(code), node))
        self.code = code[order]
        node = node[order]
        self.levels = [(self.code, np.full(len(code), _ALL, np.uint64), None, None)]
        while (first := np.r_[True, node[1:] != node[:-1]]).sum() < len(node):
            place = np.arange(len(node)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            start = np.flatnonzero(place % FANOUT == 0)
            count = np.diff(np.r_[start, len(node)])
            value, mask = self.levels[-1][:2]
            agree = mask & ~(value ^ np.repeat(value[start], count))
            self.levels.append((value[start], np.bitwise_and.reduceat(agree, start), start, count))
            node = node[start]

    def pairs(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of entries of one node that are at most ``max_bits`` apart, in parts."""
        top = np.arange(len(self.levels[-1][0]))
        todo = [(len(self.levels) - 1, top, top)]
        while todo:
            level, a, b = todo.pop()
            if level == 0:
                yield a, b
                continue
            if len(a) > PAIRS:
                todo += [(level, a[i:i + PAIRS], b[i:i + PAIRS]) for i in range(0, len(a), PAIRS)]
                continue
            _, _, start, count = self.levels[level]
            value, mask = self.levels[level - 1][:2]
            k = np.arange(FANOUT)
            x = (start[a][:, None] + k)[:, :, None]
            y = (start[b][:, None] + k)[:, None, :]
            ok = (k < count[a][:, None])[:, :, None] & (k < count[b][:, None])[:, None, :]
            ok &= (x < y) if level == 1 else (x <= y)  # a node against itself: each pair once
            x, y = np.broadcast_to(x, ok.shape)[ok], np.broadcast_to(y, ok.shape)[ok]
            near = np.bitwise_count((value[x] ^ value[y]) & mask[x] & mask[y]) <= max_bits
            todo.append((level - 1, x[near], y[near]))

    def links(self, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry, representative) codes: a spanning star of each linked set of a node."""
        label = np.arange(len(self.code))
        for a, b in self.pairs(max_bits):
            while len(a):
                x, y = label[a], label[b]
                low = np.minimum(x, y)
                np.minimum.at(label, x, low)
                np.minimum.at(label, y, low)
                while (label[label] != label).any():
                    label = label[label]
                open_ = label[a] != label[b]
                a, b = a[open_], b[open_]
        some = np.flatnonzero(label != np.arange(len(label)))
        return self.code[some], self.code[label[some]]


def _index_nodes(max_bits: int):
    """mapInArrow over (mask_no, node, fp) sorted by node: spanning links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(rows: np.ndarray) -> pa.RecordBatch:
            node = np.cumsum(np.r_[0, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])])
            a, b = GrayIndex(node, rows[:, 2].copy().view(np.uint64)).links(max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append(np.column_stack([batch[i].to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]))
            if sum(map(len, held)) >= CHUNK:
                rows = np.concatenate(held)
                last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
                cut = last[-1] + 1 if len(last) else 0  # the last node may go on
                if cut:
                    yield flush(rows[:cut])
                held = [rows[cut:]]
        rows = np.concatenate(held) if held else np.zeros((0, 3), np.int64)
        if len(rows):
            yield flush(rows)

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(entries: DataFrame, count: int, max_bits: int = 2, node_limit: int = 2048) -> DataFrame:
    """Links (a, b) that span every linked set of the distinct fingerprints ``entries`` (fp)."""
    masks = segment_masks(count, max_bits)
    if max_bits != 2:
        node_limit = 2**62
    seg = F.explode(F.array(*[F.struct(F.lit(i).alias("mask_no"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("node"))
                              for i, m in enumerate(masks)]))
    placed = entries.select(seg.alias("s"), "fp").select("s.mask_no", "s.node", "fp")
    sizes = stored(placed.groupBy("mask_no", "node").count().where(F.col("count") > 1), "simhash-nodes",
                   rows=len(masks) * count)
    small = sizes.where(F.col("count") <= node_limit).select("mask_no", "node")
    links = (placed.join(small, ["mask_no", "node"])  # a node with one entry has nothing to compare
             .repartition("mask_no", "node").sortWithinPartitions("mask_no", "node")
             .mapInArrow(_index_nodes(max_bits), "a long, b long"))
    large = sizes.where(F.col("count") > node_limit).select("mask_no", "node")
    if large.isEmpty():
        return links
    crowded = placed.join(large, ["mask_no", "node"], "left_semi").select("fp").distinct()
    near = F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)]))
    met = (crowded.select("fp", near.alias("at")).groupBy("at").agg(F.collect_set("fp").alias("fps"))  # 65 at most
           .where(F.size("fps") > 1))
    return links.unionByName(met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
                             .where("a <> b").distinct())


BROADCAST_ROWS = 500_000  # of two numbers each


def shuffled(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` narrow rows as a side of a join: beyond
    BROADCAST_ROWS the join sorts and merges, so that no task or driver holds it."""
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def components(links: DataFrame, count: int, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the least node reachable
    from it; ``count`` is an upper bound of the links' number.

    Large-star: a node hands its larger neighbours to its least one; small-star:
    its smaller ones. A node's neighbours are only ever reduced to their least,
    so no neighbour list is gathered. Rounds go on until one leaves every link as
    it was.
    """
    links = stored(links.where("a <> b"), "links", rows=count, spread=True)
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "components", rows=count)
    n = edges.count()
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = shuffled(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), 2 * n)
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = shuffled(large.groupBy("a").agg(F.min("b").alias("m")), n)
        small = large.join(least, "a")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, had = edges, n
        edges = stored(small, "components", rows=2 * n)
        n = edges.count()
        if n == had and edges.join(shuffled(before, n), ["a", "b"], "left_anti").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2, node_limit: int = 2048) -> DataFrame:
    """doc_id, fp, root (least fingerprint of the component) and component_id
    (least doc_id) of every row of ``docs`` (doc_id, text)."""
    texts_in_small_batches(docs.sparkSession)
    rows = docs.count()
    prints = stored(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-prints",
                    rows=rows, spread=True)
    entries = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-entries", rows=rows)
    count = entries.count()
    parts = components(fingerprint_links(entries, count, max_bits, node_limit), 3 * count)
    rooted = entries.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = stored(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components", rows=count)
    return prints.join(found, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the least
    doc_id. Of repeated rows, and of a component of null ids, one row stays."""
    rows = docs.count()
    found = stored(near_dedup(docs, shingle, max_bits), "simhash-found", rows=rows)
    often = stored(found.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
                   .select("doc_id"), "simhash-repeated", rows=rows)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    if gone.count() <= broadcast_rows:  # ids alone; else the texts are shuffled
        gone = F.broadcast(gone)
    out = docs.join(gone, "doc_id", "left_anti")
    if often.isEmpty():
        return out.select(docs.columns)
    # rows whose id does not tell them apart are told apart by their fingerprints
    once = out.where(F.col("doc_id").isNotNull()).join(often.where("doc_id is not null"), "doc_id", "left_anti")
    fp, place = fresh(docs, "fp"), fresh(docs, "place")
    keep = found.select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("component_id").alias("_id")).distinct()
    odd = (docs.alias("d").join(often.alias("o"), F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")), "left_semi")
           .withColumn(fp, fingerprint_column(F.col("text"), shingle))
           .join(keep, (F.col(fp) == F.col("_fp")) & F.col("doc_id").eqNullSafe(F.col("_id")))
           .withColumn(place, F.row_number().over(W.partitionBy("_root").orderBy("_fp", F.crc32(F.col("text").cast("binary")))))
           .where(F.col(place) == 1))
    return once.select(docs.columns).unionByName(odd.select(docs.columns))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
