"""Quality rules: a threshold table compiled into one Spark projection of
length, symbol, stop-word and line ratios. No user functions.

``text_stats`` counts, ``compile_rules`` turns the table into one boolean
column for each rule. Results for odd input: null text counts as empty; an
empty text, or one without words, has all counts 0 and fails the base check;
repeated rows are judged one by one; an empty table gives an empty result;
other input columns are ignored, whatever their names. A ratio over nothing
(no words, no lines) is 0. Word counts cover the whole text at any length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE, texts_in_small_batches

SYMBOLS = "#*$%&|<>"
# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in a is that it for was on with as be by at from this are or an which not have had he but his"
    " der die das und ist nicht ein eine von mit sich auf den dem für im zu"
    " le la les de des et un une dans que qui pour au aux du par sur est en il elle"
    " el los las y que se del una por con no su al lo como"
).split()


@dataclass(frozen=True)
class Threshold:
    """A row of the table: ``least <= metric <= most`` (None: open)."""

    metric: str
    least: float | None = None
    most: float | None = None


THRESHOLDS = [
    Threshold("mean_word_chars", 2.0, 14.0),
    Threshold("symbol_ratio", None, 0.10),
    Threshold("stop_word_ratio", 0.06, None),
    Threshold("dup_line_ratio", None, 0.40),
]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules use, one row for each document."""
    texts_in_small_batches(docs.sparkSession)
    n = F.size("words")
    words = F.array_remove(F.split(F.translate("text", SPACE, " " * len(SPACE)), " "), "")
    out = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = out.select("doc_id", "text", words.alias("words"),
                     F.filter(F.split("text", "\n"), lambda x: F.length(_without(x, SPACE)) > 0).alias("lines"))
    # each later step reads array columns of the step before, so nothing is split twice
    gram = F.transform(F.slice("words", 1, F.greatest(n - 2, F.lit(0))),
                       lambda w, i: F.concat_ws(" ", w, F.col("words")[i + 1], F.col("words")[i + 2]))
    lower = F.translate(F.lower("text"), SPACE + ".,;:", " " * (len(SPACE) + 4))
    out = out.select(
        "doc_id", n.cast("long").alias("n_words"),
        F.length(_without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(F.split(lower, " "), lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        gram.alias("grams"))
    kept = [c for c in out.columns if c != "grams"]
    # most texts repeat no window: a hash set tells, and only the others are sorted
    placed = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))
    out = out.select(*kept, F.when(F.size(F.array_distinct("grams")) < F.size("grams"), placed).alias("sorted"))
    same = lambda x, k: F.coalesce(x["gram"] == F.get("sorted", k)["gram"], F.lit(False))
    twice = F.filter("sorted", lambda x, k: same(x, k - 1) | same(x, k + 1))
    out = out.select(*kept, F.sort_array(F.transform(twice, lambda x: x["at"])).alias("starts"))
    # a window covers three words, or fewer if the next one starts inside it
    cover = F.transform("starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - s, F.lit(3))))
    repeated = F.aggregate(cover, F.lit(0), lambda a, x: a + x)
    return out.select(*kept, F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


METRICS = {
    "n_words": F.col,
    "mean_word_chars": lambda _: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda _: _ratio("n_symbols", "n_words"),
    "stop_word_ratio": lambda _: _ratio("n_stop_words", "n_words"),
    "dup_line_ratio": lambda _: _ratio("n_dup_lines", "n_lines"),
}


def compile_rules(thresholds: list[Threshold]) -> dict[str, Column]:
    """One boolean column for each row of the table: does the document pass?"""
    out = {}
    for t in thresholds:
        value, ok = METRICS[t.metric](t.metric), F.lit(True)
        if t.least is not None:
            ok = ok & (value >= t.least)
        if t.most is not None:
            ok = ok & (value <= t.most)
        out[f"ok_{t.metric}"] = ok
    return out


def judge_quality(docs: DataFrame, thresholds: list[Threshold] = THRESHOLDS, min_words: int = 50) -> DataFrame:
    """Counts, base_failed, one ok_ column for each rule, and kept."""
    rules = compile_rules(thresholds)
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~base_failed
    for ok in rules.values():
        kept = kept & ok
    return text_stats(docs).select("*", base_failed.alias("base_failed"),
                                   *[ok.alias(name) for name, ok in rules.items()], kept.alias("kept"))
