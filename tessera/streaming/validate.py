"""Validation of transcripts as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.gates import gate, word_errors

INPUT = "idx long, text string, transcription string, ts timestamp"


def arriving(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(INPUT).option("maxFilesPerTrigger", files_a_batch).json(path)


def validated(rows: DataFrame, threshold: float, late: str = "1 hour") -> DataFrame:
    """Each clip once (first arrival within the time that late rows are waited for), with wer, accepted and reason."""
    once = rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(["idx"])
    return gate(word_errors(once, "text", "transcription"), "wer", threshold, "wer")


def rates(rows: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Accepted and rejected clips by time window."""
    return rows.groupBy(F.window("ts", window)).agg(
        F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"), F.avg("wer").alias("mean_wer")
    )


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes to Parquet until what is there has been read; another start goes on from the checkpoint."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
