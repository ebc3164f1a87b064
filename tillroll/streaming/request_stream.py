"""Scoring of a stream of JSON-lines requests, batch by batch, with a result that a restart doesn't change.

Every micro-batch is written under its number, and a number's output replaces
what an earlier, interrupted try left there:

    <out>/accepted/batch=N    Parquet, the requests that were scored
    <out>/rejected/batch=N    Parquet, the others with their error and the line as it came
    <out>/responses/batch=N   JSON lines, the answer to every request
    <out>/commits/batch=N     Parquet, one row of counts, written last

A batch counts once its commit is there; ``read_committed`` sees no other. The
stream's checkpoint gives a batch that did not finish the same lines and number
again. The scoring function is a plan over a DataFrame, so the same one serves
batch tables and streams, whatever the model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Score = Callable[[DataFrame], DataFrame]
TABLES = ("accepted", "rejected", "responses", "commits")


def _write_commit(rows: DataFrame, out: str, batch: int) -> None:
    counts = rows.agg(F.count(F.lit(1)).alias("requests"), F.count_if("valid").alias("accepted"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/commits/batch={batch}")


def write_batch(lines: DataFrame, batch: int, out: str, score: Score) -> None:
    """Score the requests of one batch and replace the batch's output."""
    scored = score(lines).persist()
    try:
        scored.where("valid").write.mode("overwrite").parquet(f"{out}/accepted/batch={batch}")
        scored.where("not valid").select(*lines.columns, "error").write.mode("overwrite").parquet(f"{out}/rejected/batch={batch}")
        scored.select(F.col("response").alias("value")).write.mode("overwrite").text(f"{out}/responses/batch={batch}")
        _write_commit(scored, out, batch)
    finally:
        scored.unpersist()


def start_request_stream(spark: SparkSession, input_dir: str, out: str, checkpoint_dir: str, score: Score, envelope: bool = False,
                         text_col: str = "value", available_now: bool = True, files_a_batch: int | None = None) -> StreamingQuery:
    """A stream over the JSON-lines files that come into ``input_dir``.

    ``score`` adds valid, error and response to the rows with the request text in
    ``text_col``. With ``envelope`` each line is ``{"id": ..., "body": "<request
    JSON>"}``, and ``text_col`` holds the body. An empty line is a request, and
    rejected; a line that is no envelope has a null id and body."""
    source = spark.readStream.format("text")
    if files_a_batch:
        source = source.option("maxFilesPerTrigger", files_a_batch)
    lines = source.load(input_dir)
    if envelope:
        lines = lines.select(F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.body").alias(text_col))
    writer = (lines.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, out, score))
              .option("checkpointLocation", checkpoint_dir))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def read_committed(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The rows of ``table`` (one of TABLES) of all batches that were committed, with their batch number."""
    if table not in TABLES:
        raise ValueError(f"{table!r} is none of {TABLES}")
    commits = spark.read.parquet(f"{out}/commits")
    if table == "commits":
        return commits
    reader = spark.read.format("text" if table == "responses" else "parquet")
    return reader.load(f"{out}/{table}").join(commits.select("batch").distinct(), "batch", "left_semi")
