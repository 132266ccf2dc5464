"""Incremental transcript ingestion.

The original job re-reads the whole transcript folder on every run.  Here the
folder is a file stream source: each new CSV that lands is read once, turned
into the transcript measures (SCL12 + SCL16-SCL18) and appended to a Parquet
table.  ``availableNow`` processes what has landed and stops, so a scheduler
can run it like a batch job; the checkpoint (under the shared checkpoint
folder) records which files were done, so a restart after a lost executor or
driver neither skips nor repeats a file.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.scalars import transcript_key
from ledgerlake.functions.text import add_text_measures
from ledgerlake.session import checkpoint_dir
from ledgerlake.sources.files import TRANSCRIPT_SCHEMA_FLAT


def transcript_measures(df: DataFrame, scorer_factory=None) -> DataFrame:
    """Transcript rows -> transcriptID + the five measures (SCL18)."""
    measured = add_text_measures(df, "transcript", scorer_factory)
    return measured.select(
        transcript_key("ticker", "quarter", "year").alias("transcriptID"),
        "TransLength", "TotalTokens", "PositiveWordCount", "NegativeWordCount", "SentimentScore",
    )


def transcript_measures_stream(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    schema: T.StructType = TRANSCRIPT_SCHEMA_FLAT,
    scorer_factory=None,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream landing CSV -> measures -> Parquet (append)."""
    source = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(landing_dir)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    out = transcript_measures(source, scorer_factory)
    checkpoint = checkpoint or os.path.join(checkpoint_dir(spark), "transcript_measures_stream")
    writer = out.writeStream.format("parquet").option("path", output_dir).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
