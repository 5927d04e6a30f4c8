"""Scoring a stream of tickets with a fitted flow. Stateless: no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import is_folder, scratch_path
from ticketloom.sources.tickets import INTERACTION, SUMMARY

BATCH = "_batch"


def ticket_stream(spark: SparkSession, folder: str, schema, file_filter: str | None = None, max_files: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream; ``file_filter`` picks files by a pattern, or names a table that is a folder itself."""
    reader = spark.readStream.schema(schema)
    if file_filter and is_folder(spark, f"{folder}/{file_filter}"):
        folder = f"{folder}/{file_filter}"
    elif file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def messages_as_tickets(messages: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    """Any text table in the shape a flow scores: one text as summary and interaction."""
    return messages.select(*key_cols, F.col(text_col).alias(SUMMARY), F.col(text_col).alias(INTERACTION))


def score_stream(model, stream: DataFrame, keep: list[str], path: str, checkpoint: str | None = None, model_name: str | None = None):
    """Start scoring into parquet with whatever is there now, then stop.

    Sink and progress log lie in shared storage, so a restart goes on where it ended. A model that joins its training rows
    (knn) scores each batch as a table against its stored cells; a batch is written under its number, so one that is
    repeated after a failure replaces itself. :func:`scored_rows` reads either kind of result.
    """
    log = checkpoint or scratch_path(stream.sparkSession, "score-log")
    if model.by_batch(model_name):
        def score(batch: DataFrame, number: int) -> None:
            model.transform(batch, model_name, keep).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

        return stream.writeStream.foreachBatch(score).option("checkpointLocation", log).trigger(availableNow=True).start()
    scored = model.transform(stream, model_name, keep)
    return (
        scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", log)
        .trigger(availableNow=True).start()
    )


def scored_rows(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`score_stream` has written."""
    return spark.read.parquet(path).drop(BATCH)
