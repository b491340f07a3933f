"""How rows lie before costly expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys into as many partitions as shuffles have; unlike small shuffles these aren't coalesced, so that all cores share costly expressions."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)
