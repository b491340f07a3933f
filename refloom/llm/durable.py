"""Intermediate results that survive lost executors, and what bounds a task's memory."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


#: Setting for the bytes of a batch that a Python worker gets at once, and the operators' value; a task holds several copies of a batch.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches have at most BATCH_BYTES bytes, or one row; a lower value of the session's stays."""
    conf = df.sparkSession.conf
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", conf.get(BATCH_KEY).lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > BATCH_BYTES:
        conf.set(BATCH_KEY, str(BATCH_BYTES))
    return df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's spark.checkpoint.dir; where that is unset, a fresh local folder if all runs on this machine, and an error otherwise."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="refloom-"))


def settle(df: DataFrame) -> DataFrame:
    """The rows of df in the shared checkpoint folder, with its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
