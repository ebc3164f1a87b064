"""LM scoring by deleted interpolation of word n-grams.

P(w | v) = l2 c(v, w) / c(v) + l1 c(w) / N + l0 / (V + 1), the weights l chosen
by how often the context v was seen. The weights are learnt by expectation-
maximisation on a block of the training texts that is deleted from the counts
while they are learnt; the counts of the final model cover all training texts.

Words travel as 56-bit hashes in blocks, not as rows:

1. ``encode``: tasks turn texts into chunks, each a local vocabulary (word
   hashes) and the texts as numbers of it, written once.
2. ``count``: a chunk sends the sorted hashes of its distinct words and pairs,
   with their counts, cut by hash range; the range's group adds up all chunks
   and answers each with the totals in the order of its question. A word or
   pair is one entry of a chunk however often it occurs, so no key is hot.
3. Chunks meet their answers: deleted-block chunks give the statistics for the
   weights (a bounded histogram), then all chunks are scored.

Everything grows with the corpus; nothing is capped or pruned. The driver sees
only totals and the histogram.

Results for odd input: null and empty texts are scored as their end alone;
null ids and repeated rows are texts of their own; a text longer than a chunk
is scored in parts that carry their context over; without training texts every
token has probability 1 (no word is known, so the one unknown outcome is sure);
an empty table gives an empty result; other input columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored, texts_in_small_batches

CHUNK = 2_000_000  # tokens
RANGE = 2_000_000  # keys that a hash range may be expected to gather
BITS = 56
START, END = 0, 1  # local numbers; words follow
_SPECIAL = [xxhash.xxh64_intdigest(b"", seed) >> (64 - BITS) for seed in (1, 2)]
STEPS = 4  # histogram cells to an octave of a probability ratio
NEVER = -100_000  # cell of a probability of zero


# -- blocks of numbers ----------------------------------------------------------


def pack(x: np.ndarray) -> bytes:
    """Unsigned numbers by byte planes, compressed."""
    x = np.ascontiguousarray(x, "<u8" if x.dtype.itemsize == 8 else "<u4")
    planes = x.view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(bytes([x.dtype.itemsize]) + planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    planes = np.frombuffer(raw[1:], np.uint8).reshape(raw[0], (len(raw) - 1) // raw[0])
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").reshape(-1)


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of word pairs from the keys of their words."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h >> np.uint64(64 - BITS)


# -- 1: chunks ----------------------------------------------------------------------


class ChunkBuilder:
    """Gathers texts, or parts of them."""

    def __init__(self):
        self.ids: defaultdict = defaultdict()
        self.ids.default_factory = self.ids.__len__
        for special in (b" start", b" end"):  # never words: they hold a blank
            self.ids[special]
        self.tokens, self.texts, self.size = [], [], 0

    def add(self, uid: int, doc_id, learn: bool, words: list[bytes], first: bool, last: bool) -> None:
        """``words`` begin with a context word where the part isn't the text's first."""
        t = np.fromiter(map(self.ids.__getitem__, words), np.uint32, len(words))
        self.tokens.append(np.concatenate([np.array([START][:first], np.uint32), t, np.array([END][:last], np.uint32)]))
        self.texts.append((uid, doc_id, learn, len(self.tokens[-1])))
        self.size += len(t) + 1

    def row(self, chunk: int, deleted: bool) -> tuple:
        tokens = np.concatenate(self.tokens)
        order = np.argsort(-np.bincount(tokens, minlength=len(self.ids))[2:], kind="stable") + 2  # frequent words first
        number = np.concatenate([[START, END], np.empty(len(order), np.int64)]).astype(np.uint32)
        number[order] = np.arange(2, len(self.ids), dtype=np.uint32)
        words = list(self.ids)
        keys = np.array(_SPECIAL + [xxhash.xxh64_intdigest(words[i]) >> (64 - BITS) for i in order.tolist()], np.uint64)
        uid, doc_id, learn, size = zip(*self.texts, strict=True)
        trained = sum(n - 1 for n, x in zip(size, learn, strict=True) if x)
        return chunk, deleted, list(uid), list(doc_id), list(learn), list(size), trained, pack(keys), pack(number[tokens])


def encode(docs: DataFrame, chunk_tokens: int = CHUNK) -> DataFrame:
    """Chunks of ``docs`` (doc_id, learn, deleted, text) of about ``chunk_tokens``;
    deleted texts have chunks of their own."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"chunk long, deleted boolean, uid array<long>, doc_id array<{kind}>, learn array<boolean>, "
              "size array<int>, trained long, keys binary, tokens binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        base, n_rows, n_chunks = TaskContext.get().partitionId() << 33, 0, 0
        builders = {False: ChunkBuilder(), True: ChunkBuilder()}

        def close(deleted: bool) -> pa.RecordBatch:
            nonlocal n_chunks
            row = builders[deleted].row(base + n_chunks, deleted)
            builders[deleted] = ChunkBuilder()
            n_chunks += 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        for batch in batches:
            types = [pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(batch.schema.field(0).type), pa.list_(pa.bool_()),
                     pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
            for i in range(batch.num_rows):
                doc_id, learn, deleted, text = (batch[k][i].as_py() for k in range(4))
                words = (text or "").encode().lower().split()  # of bytes: ASCII only
                for a in range(0, len(words) or 1, chunk_tokens):
                    part = words[a - 1 if a else 0:a + chunk_tokens]
                    builders[deleted].add(base + n_rows, doc_id, learn, part, a == 0, a + chunk_tokens >= len(words))
                    if builders[deleted].size >= chunk_tokens:
                        yield close(deleted)
                n_rows += 1
        for deleted, b in builders.items():
            if b.texts:
                yield close(deleted)

    names = [x.split()[0] for x in schema.split(", ")]
    return docs.mapInArrow(run, schema)


class Chunk:
    """A chunk's tokens with their contexts, its distinct pairs, and the order of its keys."""

    def __init__(self, row: dict):
        self.uid = row["uid"]
        self.size = np.array(row["size"])
        self.keys, tokens = unpack(row["keys"]), unpack(row["tokens"])
        learn = np.repeat(np.array(row["learn"], bool), self.size)
        scored = np.ones(len(tokens), bool)  # all but the first of each part, which is context
        scored[np.cumsum(self.size) - self.size] = False
        at = np.flatnonzero(scored)
        self.cur, self.prev, self.learn = tokens[at], tokens[at - 1], learn[at]
        width = np.uint64(len(self.keys))
        pairs, self.pair = np.unique(self.prev.astype(np.uint64) * width + self.cur, return_inverse=True)
        all_keys = np.concatenate([self.keys, pair_keys(self.keys[pairs // width], self.keys[pairs % width])])
        self.order = np.argsort(all_keys, kind="stable")
        self.sorted_keys = all_keys[self.order]

    def counts(self) -> np.ndarray:
        """Learnt occurrences of each key, in sorted order. A start counts as often as there are ends."""
        words = np.bincount(self.cur[self.learn], minlength=len(self.keys))
        words[START] = words[END]
        pairs = np.bincount(self.pair[self.learn], minlength=len(self.order) - len(self.keys))
        return np.concatenate([words, pairs])[self.order]

    def totals(self, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Totals by word and by pair from answers in sorted order."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = answer
        return out[:len(self.keys)], out[len(self.keys):]


# -- 2: counts -------------------------------------------------------------------------


def _questions(bits: int):
    """mapInArrow over chunks: one row for each chunk and hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                counts, word = c.counts(), (c.order < len(c.keys))
                edges = np.searchsorted(c.sorted_keys, np.arange(0, 1 << bits, dtype=np.uint64) << np.uint64(BITS - bits))
                out = []
                for r, (a, b) in enumerate(zip(edges, [*edges[1:], len(c.order)], strict=True)):
                    if a < b:
                        steps = np.diff(c.sorted_keys[a:b], prepend=np.uint64(0))
                        out.append((r, row["chunk"], row["deleted"], pack(steps), pack(counts[a:b].astype(np.uint32)),
                                    pack(word[a:b].astype(np.uint32))))
                types = [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["range", "chunk", "deleted", "steps", "counts", "word"])

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one hash range for each of its chunks: kept and deleted counts."""
    rows = table.to_pylist()
    keys = [np.cumsum(unpack(r["steps"]), dtype=np.uint64) for r in rows]
    counts = [unpack(r["counts"]) for r in rows]
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    deleted = np.repeat([r["deleted"] for r in rows], [len(k) for k in keys])
    n = np.concatenate(counts)
    kept = np.bincount(back, np.where(deleted, 0, n), len(distinct)).astype(np.int64)
    gone = np.bincount(back, np.where(deleted, n, 0), len(distinct)).astype(np.int64)
    is_word = np.zeros(len(distinct), bool)
    is_word[back] = np.concatenate([unpack(r["word"]) for r in rows]).astype(bool)
    is_word &= distinct != np.uint64(_SPECIAL[START])
    at = np.cumsum([0, *map(len, keys)])
    parts = [back[a:b] for a, b in zip(at, at[1:], strict=False)]
    first = [i == 0 for i in range(len(rows))]
    number = lambda x: [int(x.sum()) if f else 0 for f in first]  # noqa: E731  once for each range
    return pa.table({
        "range": table["range"], "chunk": table["chunk"], "deleted": table["deleted"],
        "kept": pa.array([pack(kept[p].astype(np.uint64)) for p in parts], pa.binary()),
        "gone": pa.array([pack(gone[p].astype(np.uint64)) for p in parts], pa.binary()),
        "v_kept": pa.array(number(is_word & (kept > 0)), pa.int64()),
        "v_all": pa.array(number(is_word & (kept + gone > 0)), pa.int64())})


def count(chunks: DataFrame, tokens: int) -> DataFrame:
    bits = max(8, int(np.ceil(np.log2(max(1, tokens / RANGE)))))
    asked = chunks.mapInArrow(_questions(bits), "range int, chunk long, deleted boolean, steps binary, counts binary, word binary")
    return asked.groupBy("range").applyInArrow(
        _answer, "range int, chunk long, deleted boolean, kept binary, gone binary, v_kept long, v_all long")


def _meet(chunks: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """``run(chunk, kept, gone)`` for each chunk with its answers in key order."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        c = Chunk(left.to_pylist()[0])
        c.doc_id = left["doc_id"].combine_chunks().values
        rows = sorted(right.select(["range", "kept", "gone"]).to_pylist(), key=lambda r: r["range"])
        kept, gone = (np.concatenate([unpack(r[k]) for r in rows]).astype(np.int64) for k in ("kept", "gone"))
        return run(c, kept, gone)

    answers = answers.select("chunk", "range", "kept", "gone")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(one, schema)


# -- 3: weights and scores -----------------------------------------------------------------


@dataclass(frozen=True)
class Totals:
    tokens: int  # N
    words: int  # V, the end included


def frequency_class(context_count: np.ndarray) -> np.ndarray:
    """Bucket of a context: 0 if never seen, else 1 + floor(log2(count))."""
    return np.where(context_count > 0, np.floor(np.log2(np.maximum(context_count, 1))).astype(np.int64) + 1, 0)


def estimates(c: Chunk, answer: np.ndarray, totals: Totals):
    """For each token: context class, the pair's and the word's maximum-likelihood estimate, the word's count."""
    words, pairs = c.totals(answer)
    context, word = words[c.prev], words[c.cur]
    p2 = np.where(context > 0, pairs[c.pair] / np.maximum(context, 1), 0.0)
    return frequency_class(context), p2, word / max(1, totals.tokens), word


def _cells(ratio: np.ndarray) -> np.ndarray:
    """Histogram cell of an estimate's ratio to the uniform one."""
    with np.errstate(divide="ignore"):
        x = np.round(STEPS * np.log2(ratio))
    return np.where(ratio > 0, x, NEVER).astype(np.int64)


def held_out_histogram(chunks: DataFrame, answers: DataFrame, totals: Totals) -> np.ndarray:
    """Rows (class, mean ratio of p2, mean ratio of p1 to the uniform estimate, tokens) of cells of like ratios
    over the deleted texts. A cell carries the sums of its tokens' ratios, so its means are exact."""

    def run(c: Chunk, kept: np.ndarray, gone: np.ndarray) -> pa.Table:
        k, p2, p1, _ = estimates(c, kept, totals)
        r2, r1 = p2 * (totals.words + 1), p1 * (totals.words + 1)
        cells, back, n = np.unique(np.column_stack([k, _cells(r2), _cells(r1)]), axis=0, return_inverse=True, return_counts=True)
        return pa.table({"k": cells[:, 0], "x2": cells[:, 1], "x1": cells[:, 2], "n": n,
                         "s2": np.bincount(back.ravel(), r2, len(n)), "s1": np.bincount(back.ravel(), r1, len(n))})

    schema = "k long, x2 long, x1 long, n long, s2 double, s1 double"
    rows = _meet(chunks.where("deleted"), answers.where("deleted"), run, schema)
    # cells: classes x octaves x octaves x STEPS ** 2 at most, whatever the corpus
    got = rows.groupBy("k", "x2", "x1").agg(*[F.sum(c).alias(c) for c in ("n", "s2", "s1")]).collect()
    return np.array([[r["k"], r["s2"] / r["n"], r["s1"] / r["n"], r["n"]] for r in sorted(got)], float).reshape(-1, 4)


def maximise(n: np.ndarray, ratios: np.ndarray, prior: np.ndarray, strength: float = 10.0, steps: int = 200) -> np.ndarray:
    """Mixture weights by EM: ``ratios`` has each component's estimate for each
    cell, ``n`` the tokens; ``prior`` counts as ``strength`` tokens more."""
    w = prior.copy()
    for _ in range(steps):
        share = ratios * w
        mixed = share.sum(axis=1, keepdims=True)
        new = (n[:, None] * np.divide(share, mixed, out=np.zeros_like(share), where=mixed > 0)).sum(axis=0) + strength * prior
        new /= new.sum()
        if np.abs(new - w).max() < 1e-7:
            return new
        w = new
    return w


def learn_weights(histogram: np.ndarray) -> np.ndarray:
    """(l2, l1, l0) for each context class up to the largest possible count; a
    class without deleted tokens takes the weights of the one below it."""
    k, n = histogram[:, 0].astype(np.int64), histogram[:, 3]
    ratios = np.column_stack([histogram[:, 1], histogram[:, 2], np.ones(len(n))])
    prior = maximise(n, ratios, np.array([0.4, 0.4, 0.2]), 1.0)
    unseen = np.array([0.0, prior[1], prior[2]]) / (prior[1] + prior[2])
    out = [maximise(n[k == 0], ratios[k == 0], unseen)]  # no pair has been seen there
    for c in range(1, 65):
        out.append(maximise(n[k == c], ratios[k == c], prior) if (k == c).any() else out[-1] if c > 1 else prior)
    return np.array(out)


def score_chunks(chunks: DataFrame, answers: DataFrame, totals: Totals, weights: np.ndarray, id_type: str) -> DataFrame:
    def run(c: Chunk, kept: np.ndarray, gone: np.ndarray) -> pa.Table:
        k, p2, p1, count_ = estimates(c, kept + gone, totals)
        w = weights[k]
        p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (totals.words + 1)
        if not totals.tokens:
            p = np.ones(len(p))
        base = np.log10((count_ + 1) / (totals.tokens + totals.words + 1))
        part = np.repeat(np.arange(len(c.size)), c.size - 1)
        add = lambda x: np.bincount(part, x, len(c.size))
        return pa.table({"uid": pa.array(c.uid, pa.int64()), "doc_id": c.doc_id,
                         "n_tokens": pa.array(c.size - 1, pa.int64()), "n_known": add(count_ > 0).astype(np.int64),
                         "base_score": add(base), "score": add(np.log10(p))})

    return _meet(chunks, answers, run, f"uid long, doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")


def score_texts(docs: DataFrame, learn: Column, deleted: Column, chunk_tokens: int = CHUNK) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs`` (doc_id, text). The model learns from rows where ``learn`` holds; those of
    them where ``deleted`` holds too give the weights."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    rows = docs.select("doc_id", yes(learn).alias("learn"), (yes(learn) & yes(deleted)).alias("deleted"),
                       F.col("text").cast("string").alias("text"))
    texts_in_small_batches(docs.sparkSession)
    chunks = stored(encode(rows, chunk_tokens), "lm-chunks")
    n, n_deleted, size = chunks.agg(
        F.sum("trained"), F.sum(F.when(F.col("deleted"), F.col("trained"))),
        F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    answers = stored(count(chunks, size or 0), "lm-counts")
    v_kept, v_all = answers.agg(F.sum("v_kept"), F.sum("v_all")).first()
    n, kept = n or 0, (n or 0) - (n_deleted or 0)
    weights = learn_weights(held_out_histogram(chunks, answers, Totals(kept, v_kept or 0)))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    parts = score_chunks(chunks, answers, Totals(n, v_all or 0), weights, id_type)
    total = lambda c: F.sum(c).alias(c)
    return (parts.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), *map(total, ("n_tokens", "n_known", "base_score", "score")))
            .select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"))
