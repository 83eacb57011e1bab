"""Incremental runs with Structured Streaming: prompt scoring that resumes, and snapshots as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.model_clients import Client, answers
from ..sources.tables import Target


def score_new_rows(spark: SparkSession, rows_folder: str, answers_folder: str, state_folder: str, targets: Sequence[Target], client: Client) -> StreamingQuery:
    """Answers for all rows (Parquet: row_id, row_ord, text) that arrived since the last run, appended to a
    table.  A row that has an answer is not asked again, also after a run that broke off."""

    def add(batch: DataFrame, number: int) -> None:
        try:
            done = spark.read.parquet(answers_folder).select("row_id")
        except Exception as error:  # no answers yet
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            done = None
        answers(batch, targets, client, done).write.mode("append").parquet(answers_folder)

    stream = spark.readStream.schema("row_id string, row_ord long, text string").parquet(rows_folder)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", state_folder).trigger(availableNow=True).start()


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events per type and window with a watermark, for streams and tables alike."""
    from pyspark.sql import functions as F

    counted = events.withWatermark("ts", late) if events.isStreaming else events
    return counted.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
