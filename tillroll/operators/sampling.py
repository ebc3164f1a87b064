"""Deterministic sampling and splitting.

Randomness is a seeded hash order: md5(key || ':' || seed). It is
independent of partitioning and task retries, so re-executed tasks after an
executor loss pick the same rows, and SQL engines reproduce it exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import col_of, join_small
from tillroll.sources.sinks import materialize

RANK_BUCKET_ROWS = 50_000  # rows that a range bucket of the hash may be expected to hold


def hash_key(key: str | Column, seed: int = 42) -> Column:
    """Seeded pseudo-random order key (hex string, uniform)."""
    return F.md5(F.concat(col_of(key).cast("string"), F.lit(f":{seed}")))


def _task_sketch(n: int, order: list[str], label: str | None, key: str | None) -> Callable:
    """Per task: the n lowest rows in ``order``, and the row of least ``key`` of each label."""

    def lowest(t: pa.Table) -> pa.Table:
        return t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")[:n])

    def least_of_each(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=[(key, "ascending"), ("_uid", "ascending")], null_placement="at_end"))
        at = pa.table({"label": t[label], "row": np.arange(t.num_rows), "rows": t["_rows"]})
        each = at.group_by("label", use_threads=False).aggregate([("row", "min"), ("rows", "sum")])
        return t.take(each["row_min"]).set_column(t.schema.get_field_index("_rows"), "_rows", each["rows_sum"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_uid = TaskContext.get().partitionId() << 40
        low, firsts, held, seen, waiting = [], [], [], 0, 0

        def merge() -> None:
            if label is not None:
                firsts[:] = [least_of_each(pa.concat_tables(firsts + held))]
            low[:] = [lowest(pa.concat_tables(low + held))]
            held.clear()

        for batch in batches:
            rows = batch.num_rows
            held.append(pa.Table.from_batches([batch])
                        .append_column("_uid", pa.array(np.arange(rows) + (first_uid + seen)))
                        .append_column("_rows", pa.array(np.ones(rows, np.int64))))
            seen, waiting = seen + rows, waiting + rows
            if waiting >= max(4 * n, 10_000):
                merge()
                waiting = 0
        if held:
            merge()
        for tables, is_first in ((low, False), (firsts, True)):
            for t in tables:
                if not is_first:  # without labels the rows seen are told with the lowest row
                    told = np.zeros(t.num_rows, np.int64)
                    told[:1] = seen if label is None else 0
                    t = t.set_column(t.schema.get_field_index("_rows"), "_rows", pa.array(told))
                yield from t.append_column("_first", pa.array([is_first] * t.num_rows, pa.bool_())).to_batches()

    return run


def sample_sketch(df: DataFrame, n: int, order: list[Column], label: str | None = None, key: str | None = None) -> DataFrame:
    """Bottom-k sketch of ``df`` in one pass, stored: of each task the ``n``
    lowest rows in ``order`` and, with ``label``, the row of least ``key`` of each
    label (``_first``). ``_rows`` adds up to the rows of ``df``, by label where
    labels are asked for; ``_uid`` tells rows apart. The lowest n rows of the
    sketch are those of ``df``. Null order values come first, NaN counts as
    infinity; a null key is the last."""
    names = [f"_o{i}" for i in range(len(order))]
    d = df.withColumns(dict(zip(names, order, strict=True)))
    for c in names:
        if isinstance(d.schema[c].dataType, (T.DoubleType, T.FloatType)):
            d = d.withColumn(c, F.nanvl(c, F.lit(float("inf"))))
    out = T.StructType([T.StructField(f.name, f.dataType) for f in d.schema.fields]
                       + [T.StructField("_uid", T.LongType()), T.StructField("_rows", T.LongType()),
                          T.StructField("_first", T.BooleanType())])
    return materialize(d.mapInArrow(_task_sketch(n, names, label, key), out).drop(*names), "sample-sketch")


def random_sample(df: DataFrame, n: int, key: str | Column, seed: int = 42,
                  tiebreak: list[str] | None = None, total: int | None = None, hashed: bool = False) -> DataFrame:
    """n rows in seeded hash order (all rows when fewer). With ``hashed`` the
    key is the hash already.

    ``df`` is read once, into a sketch that also tells its rows; a caller who
    knows them (``total``) gets the sample from ``df`` itself. The hash is
    uniform, so a threshold a little above n / total keeps about n rows before
    the top-n; only those reach the task that merges it. Should the threshold
    ever keep fewer than n, all rows are ordered instead."""
    order = [col_of(key) if hashed else hash_key(key, seed)] + [F.col(c) for c in (tiebreak or [])]
    if n < 1:
        return df.limit(0)
    if total is None:
        sketch = sample_sketch(df, n, order)
        total = sketch.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
        df = sketch.select(df.columns)
    if total > 4 * n:
        share = (n + 8 * n ** 0.5 + 50) / total
        if share < 1:
            below = df.where(order[0] < F.lit(f"{int(share * 16 ** 12):012x}"))
            few = materialize(below.orderBy(*order).limit(n), "sample")
            if few.count() == n:
                return few
    return df.orderBy(*order).limit(n)


def cluster_safe_sample(df: DataFrame, label: str, key: str, n: int = 10_000, seed: int = 42) -> DataFrame:
    """A sample of n rows (all, if fewer) with at least one row of every label.

    The first row of each label (the least key; of repeated keys any one row),
    then the rest in seeded hash order. With more labels than n the first rows
    alone are returned, one for each label. A table with one label is returned
    whole, whatever its size: there are no clusters to compare. One pass writes a
    sketch with the labels, their first rows and row counts and the lowest rows
    of each task; the sample is taken from it.
    """
    columns = df.columns
    sketch = sample_sketch(df, n, [hash_key(key, seed), F.col(key)], label, key)
    row = F.struct(*[F.col(f"`{c}`") for c in [*columns, "_uid"]])
    firsts = materialize(sketch.where("_first").groupBy(label)
                         .agg(F.min_by(row, F.struct(F.col(key).isNull(), key, "_uid")).alias("_row"),
                              F.sum("_rows").alias("_n")), "first-rows")
    k, total = firsts.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if k <= 1 or total <= n:
        return df
    reps = firsts.select("_row.*")
    if k >= n:
        return reps.select(columns)
    rest = join_small(sketch.where(~F.col("_first")), reps.select("_uid"), "_uid", "left_anti", broadcast_rows=n)
    return reps.select(columns).unionByName(
        random_sample(rest.select(columns), n - k, key, seed, tiebreak=[key], total=total - k))


def rank_in_group(df: DataFrame, group: str, order: Column, tiebreak: str, total: int, out: str = "_rank") -> DataFrame:
    """1-based rank of each row within ``group`` by (order, tiebreak).

    ``order`` must be a uniform hex string (a ``hash_key``). Its leading digits,
    as many as ``total`` rows ask for, cut every group into range buckets: a
    table of bucket counts gives each bucket's offset, and the row_number
    window only spans one (group, bucket). No task ever sorts a whole group.
    """
    digits = max(2, len(f"{total // RANK_BUCKET_ROWS:x}"))
    b = F.substring(order, 1, digits)
    d = df.withColumn("_ord", order).withColumn("_b", b)
    counts = d.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(group).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    j = d.join(offsets, on=[group, "_b"], how="inner")
    w2 = W.partitionBy(group, "_b").orderBy("_ord", tiebreak)
    return j.withColumn(out, F.col("_off") + F.row_number().over(w2)).drop("_ord", "_b", "_off")


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``is_test``: per class, the first round(test_fraction * n_class)
    rows in seeded hash order are test rows (exact per-class proportions)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_class_n"))
    total = df.count()
    ranked = rank_in_group(df, label, hash_key(key, seed), key, total)
    ranked = join_small(ranked, sizes, label, "inner")  # classes: never a shuffle of the rows by class
    n_test = F.floor(F.col("_class_n") * F.lit(test_fraction) + F.lit(0.5))
    return ranked.withColumn("is_test", F.col("_rank") <= n_test).drop("_rank", "_class_n")
