"""URL filters: longest-prefix rules, then a blocked Bloom filter of listed
canonical URLs whose possible hits go to an exact hash join.

DataFrame functions only. Results for odd input:

* null url, or no ``://``: host and path are empty, no rule fits, not listed: allow.
* repeated pages each get a row; an empty page table gives an empty result;
  an empty list leaves only the rules; extra columns of the input are ignored.
* null, empty and repeated list entries are dropped before the filter is built.
* two rules of the same length that fit the same URL: the one given first wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LANES = 8  # 64-bit words of a 512-bit filter block


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def canonical_url(host: Column, path: Column) -> Column:
    """Host and path without trailing slashes: scheme, query and fragment don't count."""
    return F.concat(host, F.regexp_replace(path, "/+$", ""))


def rule_column(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, as one CASE expression."""
    out = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        on_host = (host == r.host) | F.endswith(host, F.lit("." + r.host))
        out = F.when(on_host & F.startswith(path, F.lit(r.path)), F.lit(value(r))).otherwise(out)
    return out


def _lanes(key: Column) -> list[Column]:
    """One bit for each lane, from eight six-bit fields of a second hash."""
    h = F.xxhash64(key, F.lit("lane"))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 7 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(_LANES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_table(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Filter blocks that have a bit set: block number and its eight 64-bit lanes."""
    bits = [b.alias(f"lane{i}") for i, b in enumerate(_lanes(F.col(key)))]
    return (listed.select(_block(F.col(key), blocks).alias("block"), *bits)
            .groupBy("block").agg(*[F.bit_or(f"lane{i}").alias(f"lane{i}") for i in range(_LANES)]))


def filter_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame, bits_per_url: int = 16,
                broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, maybe_listed.

    ``listed`` has one string column, canonical URLs to block. The filter and
    the list are broadcast only while their measured size is at most
    ``broadcast_bytes``. A list beyond it shuffles the possible hits alone: what
    the filter has ruled out doesn't move. A filter beyond it is joined by
    shuffles too.
    """
    name = listed.columns[0]
    listed = stored(listed.select(F.col(name).alias("listed_url"))
                    .where(F.col("listed_url") != "").distinct(), "listed-urls")
    n, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("listed_url") + 24), F.lit(0))).first()
    blocks = max(1, -(-n * bits_per_url // 512))
    bloom = bloom_table(listed, "listed_url", blocks)
    if min(n, blocks) * 80 <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    url = F.col("url").cast("string")
    judged = (pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"))
              .withColumn("canonical", canonical_url(F.col("host"), F.col("path")))
              .withColumn("block", _block(F.col("canonical"), blocks))
              .join(bloom, "block", "left"))
    possible = F.lit(True)
    for i, bit in enumerate(_lanes(F.col("canonical"))):
        possible = possible & (F.col(f"lane{i}").bitwiseAND(bit) == bit)
    judged = judged.withColumn("maybe_listed", F.coalesce(possible, F.lit(False)))
    probe = F.col("canonical") == F.col("listed_url")
    if size <= broadcast_bytes:
        exact = judged.join(F.broadcast(listed), F.col("maybe_listed") & probe, "left")
    else:
        hits = judged.where("maybe_listed").join(listed, probe, "left")
        exact = hits.unionByName(judged.where("not maybe_listed").withColumn("listed_url", F.lit(None).cast("string")))
    host, path = F.col("host"), F.col("path")
    return exact.select(
        "page_id", "host", "path",
        rule_column(rules, host, path, lambda r: r.text).alias("rule"),
        F.coalesce(rule_column(rules, host, path, lambda r: r.verdict),
                   F.when(F.col("listed_url").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "maybe_listed")
