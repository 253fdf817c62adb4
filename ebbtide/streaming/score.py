"""Scoring of requests as they arrive: JSON files in, scored records out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ebbtide.operators.scoring import score_records
from ebbtide.schema import REQUEST


def request_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New JSON-lines files in ``folder``; the batch size is bounded by a file count."""
    return spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files_per_batch).json(folder)


def score_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] = score_records,
    until_done: bool = True,
) -> StreamingQuery:
    """Validate and score every record once and append it to ``target``.

    ``score`` is a batch operator: the linear scorer, or ``Bundle.score_records`` of a saved
    model. It keeps no state. Progress is kept in ``checkpoint``, so a restarted stream goes
    on where it stopped.
    """
    scored = score(request_stream(spark, source))
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if until_done else writer.trigger(processingTime="10 seconds")
    return writer.start(target)
