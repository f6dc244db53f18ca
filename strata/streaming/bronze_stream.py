"""Bronze as a stream: new JSONL files in a folder are parsed by the same Bronze plan and
appended to a Parquet table. The file source and the Parquet sink are exactly-once with a
checkpoint in the shared scratch folder, so a restarted query resumes where it stopped."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.sources.jsonl import bronze


def start_bronze_stream(spark: SparkSession, raw_dir: str, out_path: str,
                        checkpoint: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there in bounded batches and
    stops (incremental batch); otherwise it keeps polling for new files. Without
    ``checkpoint`` the progress is kept under ``out_path`` (``_checkpoint``, which readers
    skip), so that a second start on one output goes on where the first ended."""
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    records = bronze(reader.load(raw_dir))
    writer = (
        records.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}/_checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
