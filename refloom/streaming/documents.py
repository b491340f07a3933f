"""Documents as a stream: the per-document functions hold no state, so each batch is processed as a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from refloom.sources.tei import strip_doctype


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """path and xml of files as they arrive."""
    raw = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).load(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), strip_doctype(F.col("value")).alias("xml"))


def run(docs: DataFrame, per_batch: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Append per_batch of each batch to a table; a batch that comes again overwrites its own part."""

    def write(batch: DataFrame, epoch: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return docs.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
