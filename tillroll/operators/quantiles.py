"""Exact quantiles without gathering a column into one task.

Linear-interpolated percentiles (numpy / pandas default, DuckDB
``quantile_cont``) need the order statistics at ranks floor(h) and ceil(h),
h = (n - 1) * p. They are found by distributed selection: each pass is one
aggregation that histograms the still-open value ranges into ``buckets``
bins (count, min, max per bin, map-side combined), and the bin holding the
wanted rank becomes the next range. Bins are of equal width; where those leave
most rows in one bin, the next pass tells signs apart and then uses bins of
equal ratio, so any finite range narrows within a few passes. The smallest ranges,
as long as they hold at most ``collect_limit`` rows together, are read off: their
distinct values with their counts are fetched. The limit decides how, not what. Infinities
and NaN are counted beforehand and take their places in the total order (-inf,
numbers, inf, NaN). Few ranges are told apart by one projection; ``MANY_RANGES`` or more by numpy
in the tasks, since planning and compiling an expression for each takes the driver more time
and memory than the rows. Only bin counts (``MAX_BINS`` a pass, shared by the open ranges) and the final small
ranges reach the driver, whatever the rows, columns and ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BINS = 16_384  # of all ranges of a pass; a range has 16 at least
MANY_RANGES = 64


def _order_stat_targets(n: int, probs: list[float]) -> dict[float, tuple[int, int, float]]:
    out = {}
    for p in probs:
        h = (n - 1) * p
        lo = int(math.floor(h))
        hi = min(int(math.ceil(h)), n - 1)
        out[p] = (lo, hi, h - lo)
    return out


def select_ranks(
    df: DataFrame,
    targets: dict[str, list[int]],
    bounds: dict[str, tuple[float, float, int]],
    buckets: int = 1024,
    collect_limit: int = 50_000,
    max_passes: int = 64,
) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks of each column's non-null values.

    ``bounds[col] = (min, max, n)``. Returns {(col, rank): value}.
    """
    # open ranges: key -> dict(col, lo, hi, below, count, ranks, bins)
    result: dict[tuple[str, int], float] = {}
    ranges = []
    for c, ranks in targets.items():
        mn, mx, n = bounds[c]
        if n == 0 or not ranks:
            continue
        ranges.append({"col": c, "lo": mn, "hi": mx, "below": 0, "count": n, "ranks": sorted(set(ranks)), "bins": "width"})
    for _ in range(max_passes):
        small, big, left = [], [], collect_limit
        for r in sorted(ranges, key=lambda r: r["count"]):
            if r["lo"] == r["hi"]:
                small.append(r)
            elif r["count"] <= left:
                small.append(r)
                left -= r["count"]
            else:
                big.append(r)
        if small:
            _resolve_small(df, small, result)
        if not big:
            return result
        ranges = _refine(df, big, max(16, min(buckets, MAX_BINS // len(big))))
    raise RuntimeError("quantile selection did not converge")


def _in_range(r) -> F.Column:
    x = F.col(r["col"]).cast("double")
    return x.isNotNull() & (x >= F.lit(r["lo"])) & (x <= F.lit(r["hi"]))


def _resolve_small(df: DataFrame, ranges: list[dict], result: dict) -> None:
    todo = []
    for i, r in enumerate(ranges):
        if r["lo"] == r["hi"]:
            for k in r["ranks"]:
                result[(r["col"], k)] = float(r["lo"])
        else:
            todo.append((i, r))
    if not todo:
        return
    if len(todo) < MANY_RANGES:
        items = [F.when(_in_range(r), F.struct(F.lit(i).alias("rid"), F.col(r["col"]).cast("double").alias("x")))
                 for i, r in todo]
        found = (df.select(F.explode(F.filter(F.array(*items), lambda s: s.isNotNull())).alias("s"))
                 .groupBy("s.rid", "s.x").agg(F.count(F.lit(1)).alias("n")))
    else:
        found = _values_of_many(df, dict(todo))
    by_rid: dict[int, list[tuple[float, int]]] = {}
    for row in found.collect():
        by_rid.setdefault(row["rid"], []).append((row["x"], row["n"]))
    for i, r in todo:
        vals = sorted(by_rid.get(i, []))
        for k in r["ranks"]:
            want = k - r["below"]
            acc = 0
            for x, cnt in vals:
                acc += cnt
                if acc > want:
                    result[(r["col"], k)] = float(x)
                    break


def _bin(r: dict, buckets: int) -> F.Column:
    """Bin number of a value of the range; never falls where the value rises."""
    x, lo, hi = F.col(r["col"]).cast("double"), r["lo"], r["hi"]
    if r["bins"] == "sign":
        return F.signum(x) + 1
    if r["bins"] == "ratio":  # all of one sign
        sign = 1.0 if lo > 0 else -1.0
        x, lo, hi = F.ln(F.abs(x)) * sign, sign * math.log(abs(lo)), sign * math.log(abs(hi))
    # halves, so that the width of the widest range is a number
    share = (x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
    return F.greatest(F.lit(0), F.least(F.floor(share * F.lit(buckets)), F.lit(buckets - 1)))


def _next_bins(r: dict, lo: float, hi: float, count: int) -> str:
    if 2 * count <= r["count"] and r["bins"] == "width":
        return "width"
    if r["bins"] != "width":
        return "ratio" if r["bins"] == "sign" and lo * hi > 0 else "width"
    return "ratio" if lo > 0 or hi < 0 else "sign"


def _lower_edges(r: dict, buckets: int) -> np.ndarray:
    """Where the bins of a range begin, ascending."""
    lo, hi = r["lo"], r["hi"]
    if r["bins"] == "sign":
        inner = np.array([0.0, np.nextafter(0.0, 1.0)])
    elif r["bins"] == "ratio":  # all of one sign
        inner = math.copysign(1.0, lo) * np.exp(np.linspace(math.log(abs(lo)), math.log(abs(hi)), buckets + 1)[1:-1])
    else:  # halves, so that the width of the widest range is a number
        inner = np.linspace(lo / 2, hi / 2, buckets + 1)[1:-1] * 2
    return np.unique(np.r_[lo, np.clip(inner, lo, hi)])


def _cells(ranges: dict[int, dict], edges: dict[int, np.ndarray]) -> dict[str, tuple[np.ndarray, ...]]:
    """By column: where the bins of its ranges begin, ascending, and each bin's range, number there and end of the
    range. Ranges of a column don't meet."""
    out = {}
    for c in dict.fromkeys(r["col"] for r in ranges.values()):
        ids = sorted((i for i, r in ranges.items() if r["col"] == c), key=lambda i: ranges[i]["lo"])
        size = [len(edges[i]) for i in ids]
        out[c] = (np.concatenate([edges[i] for i in ids]), np.repeat(ids, size), np.concatenate([np.arange(n) for n in size]),
                  np.repeat([ranges[i]["hi"] for i in ids], size))
    return out


def _placed(batch: pa.RecordBatch, c: str, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column that lie in a range, and their bins."""
    x = batch[c].to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # a null is NaN; one zero
    at = np.searchsorted(begins, x, side="right") - 1
    inside = (at >= 0) & (x <= ends[at])
    return x[inside], at[inside]


def _values_of_many(df: DataFrame, ranges: dict[int, dict]) -> DataFrame:
    """rid, x, n: the distinct values in the ranges, with their counts."""
    cells = _cells(ranges, {i: np.array([r["lo"]]) for i, r in ranges.items()})

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, (begins, rid, _, ends) in cells.items():
                x, at = _placed(batch, c, begins, ends)
                yield pa.RecordBatch.from_arrays([pa.array(rid[at], pa.int32()), pa.array(x)], ["rid", "x"])

    return (df.select(*[F.col(c).cast("double").alias(c) for c in cells]).mapInArrow(values, "rid int, x double")
            .groupBy("rid", "x").agg(F.count(F.lit(1)).alias("n")))


def _bins_of_many(df: DataFrame, ranges: list[dict], buckets: int) -> DataFrame:
    """rid, b, n, mn, mx of the bins that hold a value."""
    cells = _cells(dict(enumerate(ranges)), {i: _lower_edges(r, buckets) for i, r in enumerate(ranges)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {c: np.zeros(len(v[0]), np.int64) for c, v in cells.items()}
        mn, mx = ({c: np.full(len(v[0]), e) for c, v in cells.items()} for e in (np.inf, -np.inf))
        for batch in batches:
            for c, (begins, _, _, ends) in cells.items():
                x, at = _placed(batch, c, begins, ends)
                n[c] += np.bincount(at, minlength=len(begins))
                np.minimum.at(mn[c], at, x)
                np.maximum.at(mx[c], at, x)
        for c, (_, rid, b, _) in cells.items():
            k = np.flatnonzero(n[c])
            yield pa.RecordBatch.from_arrays([pa.array(rid[k], pa.int32()), pa.array(b[k], pa.int32()), pa.array(n[c][k]),
                                              pa.array(mn[c][k]), pa.array(mx[c][k])], ["rid", "b", "n", "mn", "mx"])

    return (df.select(*[F.col(c).cast("double").alias(c) for c in cells]).mapInArrow(add, "rid int, b int, n long, mn double, mx double")
            .groupBy("rid", "b").agg(F.sum("n").alias("n"), F.min("mn").alias("mn"), F.max("mx").alias("mx")))


def _refine(df: DataFrame, ranges: list[dict], buckets: int) -> list[dict]:
    if len(ranges) < MANY_RANGES:
        items = []
        for i, r in enumerate(ranges):
            x = F.col(r["col"]).cast("double")
            items.append(F.when(_in_range(r), F.struct(F.lit(i).alias("rid"), _bin(r, buckets).cast("int").alias("b"),
                                                       x.alias("x"))))
        hist = (df.select(F.explode(F.filter(F.array(*items), lambda s: s.isNotNull())).alias("s"))
                .groupBy("s.rid", "s.b")
                .agg(F.count(F.lit(1)).alias("n"), F.min("s.x").alias("mn"), F.max("s.x").alias("mx")))
    else:
        hist = _bins_of_many(df, ranges, buckets)
    by_rid: dict[int, list] = {}
    for row in hist.collect():
        by_rid.setdefault(row["rid"], []).append((row["b"], row["n"], row["mn"], row["mx"]))
    out = []
    for i, r in enumerate(ranges):
        bins = sorted(by_rid.get(i, []))
        # group this range's ranks by the bin that holds them
        chosen: dict[int, dict] = {}
        for k in r["ranks"]:
            want = k - r["below"]
            acc = 0
            for b, n, mn, mx in bins:
                if acc + n > want:
                    key = b
                    if key not in chosen:
                        chosen[key] = {"col": r["col"], "lo": mn, "hi": mx, "below": r["below"] + acc,
                                       "count": n, "ranks": [], "bins": _next_bins(r, mn, mx, n)}
                    chosen[key]["ranks"].append(k)
                    break
                acc += n
        out.extend(chosen.values())
    return out


def percentiles_exact(df: DataFrame, cols: list[str], probs: list[float],
                      collect_limit: int = 50_000) -> dict[str, dict[float, float | None]]:
    """{col: {p: value}} with numpy 'linear' interpolation; None for empty columns.

    ``df`` is read once for each pass, so pass a stored table: each pass reads
    the columns it still needs, and the narrowing ranges skip row groups.
    """
    narrow = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    aggs = []
    for c in cols:
        x, inf = F.col(c), float("inf")
        finite = ~F.isnan(x) & (F.abs(x) < inf)
        aggs += [F.min(F.when(finite, x)).alias(f"mn_{c}"), F.max(F.when(finite, x)).alias(f"mx_{c}"),
                 F.count_if(finite).alias(f"n_{c}"), F.count_if(x == -inf).alias(f"low_{c}"),
                 F.count_if((x == inf) & ~F.isnan(x)).alias(f"high_{c}"), F.count(x).alias(f"all_{c}")]
    row = narrow.agg(*aggs).first()
    bounds = {c: (row[f"mn_{c}"], row[f"mx_{c}"], row[f"n_{c}"]) for c in cols}
    plan = {c: _order_stat_targets(row[f"all_{c}"], probs) if row[f"all_{c}"] else {} for c in cols}
    wanted = {c: {k for lo, hi, _ in plan[c].values() for k in (lo, hi)} for c in cols}
    low = {c: row[f"low_{c}"] for c in cols}
    targets = {c: [k - low[c] for k in ks if 0 <= k - low[c] < bounds[c][2]] for c, ks in wanted.items()}
    found = select_ranks(narrow, targets, bounds, collect_limit=collect_limit)

    def value(c: str, k: int) -> float:
        if k < low[c]:
            return float("-inf")
        k -= low[c]
        if k < bounds[c][2]:
            return found[(c, k)]
        return float("inf") if k < bounds[c][2] + row[f"high_{c}"] else float("nan")

    out: dict[str, dict[float, float | None]] = {}
    for c in cols:
        out[c] = dict.fromkeys(probs)
        for p, (lo, hi, frac) in plan[c].items():
            a, b = value(c, lo), value(c, hi)
            # numpy's lerp form: a + (b - a) * frac, with the endpoint rule
            out[c][p] = a if frac == 0 or a == b else (
                b - (b - a) * (1 - frac) if frac >= 0.5 else a + (b - a) * frac)
    return out


# --------------------------------------------------------------- sketches
def sketch_error(k: int) -> float:
    """The rank error that a sketch of size ``k`` stays within, as a share of the
    rows: twice the published error that 99 of 100 sketches keep to."""
    return 2 * 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, cols: list[str], by: list[str], k: int = 800) -> DataFrame:
    """One mergeable KLL sketch a column and group of ``by``: (by.., col, sketch, n).

    A sketch has a few kB whatever the rows, is made map-side, and may be kept in
    a table and merged with others later (``merge_sketches``), so new partitions
    don't read the old ones again. Nulls and NaN are left out; a group without a
    value has a null sketch and n 0. For exact values: ``percentiles_exact``."""
    out = None
    for c in cols:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        one = (df.groupBy(*by).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"), F.count(x).alias("n"))
               .select(*by, F.lit(c).alias("col"), F.when(F.col("n") > 0, F.col("sketch")).alias("sketch"), "n"))
        out = one if out is None else out.unionByName(one)
    return out


def merge_sketches(sketches: DataFrame, by: list[str], k: int = 800) -> DataFrame:
    """Sketches of coarser groups: (by.., col, sketch, n)."""
    return (sketches.groupBy(*by, "col").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"))
            .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch"))))


def sketch_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """The sketches' rows with p and value for each of ``probs``; null without a sketch."""
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    return (sketches.withColumn("_v", F.when(F.col("sketch").isNotNull(), values))
            .withColumn("_p", F.explode(F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("p"), F.coalesce("_v", F.array()).alias("value"))))
            .select(*[c for c in sketches.columns if c != "sketch"], "_p.p", "_p.value"))


def rank_errors(df: DataFrame, quantiles: DataFrame) -> DataFrame:
    """(col, p, error): how far p lies from the shares of rows below and up to
    each value of ``quantiles`` (col, p, value), over all rows of ``df``."""
    rows = quantiles.select("col", "p", "value").collect()  # a row for each column and p
    aggs = []
    for i, r in enumerate(rows):
        x = F.col(r["col"]).cast("double")
        x = F.when(~F.isnan(x), x)
        low, high = F.count_if(x < r["value"]) / F.count(x), F.count_if(x <= r["value"]) / F.count(x)
        aggs.append(F.greatest(F.lit(0.0), low - r["p"], F.lit(r["p"]) - high).alias(f"e{i}"))
    got = df.agg(*aggs).first()
    return df.sparkSession.createDataFrame([(r["col"], r["p"], float(got[i])) for i, r in enumerate(rows)], "col string, p double, error double")
