"""Corpus pipeline: language ID, quality, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; it works on all that
its predecessor kept. All but the last return the columns of ``documents``.
Models are trained on the labelled rows of the tables in ``sf_dir`` with the
same rules as the operators' own queries.

Results for odd input: null texts, empty ones and those without a letter are
rejected by language ID; texts of any length are read whole by every stage; of
repeated rows, and of a component whose ids are all null, one row stays; equal
fingerprints tie to the least doc_id; other columns of documents pass through
the first three stages, whatever their names; an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import compression_quality, lang_id, packing, queries, simhash
from tillroll.llm.common import fresh, stored, table

MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is found with a posterior of at least
    MIN_LANGUAGE_SCORE and that fit it as its training rows do, so that texts in
    other languages, code and noise are rejected at any length."""
    found = fresh(docs, "language")
    model = queries.naive_bayes(spark, sf_dir)
    lang, fit = F.col(found)["lang_pred"], F.col(found)["fit"]
    fits = F.lit(False)
    for name, least in lang_id.least_fits(queries.language_rows(spark, sf_dir), model).items():
        fits = fits | ((lang == name) & (fit >= least))
    return (docs.withColumn(found, lang_id.predict(spark, F.col("text"), model))
            .where((lang != lang_id.UND) & (F.col(found)["score"] >= MIN_LANGUAGE_SCORE) & fits)
            .select(docs.columns))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the compression classifier predicts as good."""
    score = fresh(docs, "quality_score")
    model = queries.quality_model(spark, sf_dir)
    return (docs.withColumn(score, compression_quality.quality_score(spark, F.col("text"), model))
            .where(F.col(score) >= queries.QUALITY_THRESHOLD).select(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the least doc_id."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, window=2048, end_id=1)


STAGES = [("language_id", identify_language), ("quality_classifier", keep_quality),
          ("simhash_dedup", drop_near_copies), ("packing", pack_sequences)]

ORACLE_SQL = None  # models, XXH64 fingerprints and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
