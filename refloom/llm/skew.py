"""Joins with a table of names in which some keys may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.columns import spare

#: Keys that are looked up by a broadcast: those of over a share of 1 / HOT_KEYS of all rows, so at most that many.
HOT_KEYS, HOT_LEAST = 100_000, 64


def look_up(rows: DataFrame, names: DataFrame, key: str, total: int) -> DataFrame:
    """rows with the columns of names, which has one row a key and, as copies, how many of the total rows hold it.

    Rows of frequent keys stay where they are; the others' keys are too rare to be skewed.
    """
    (hot,) = spare(rows, "hot")
    often = F.col("copies") > max(HOT_LEAST, total // HOT_KEYS)
    met = rows.join(F.broadcast(names.where(often).drop("copies").withColumn(hot, F.lit(True))), key, "left")
    rare = met.where(F.col(hot).isNull()).select(*rows.columns).join(names.where(~often).drop("copies"), key, "left")
    return met.where(hot).drop(hot).unionByName(rare)
