"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.llm.durable import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
#: Documents of a source that are sorted together, about.
BUCKET_DOCS = 10_000
#: Sources that are broadcast at most.
BROADCAST_SOURCES = 100_000
KEY_BITS = 60


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, docs and target of each source of sizes (source, size).

    Sources by code point, null last, weigh as weights repeats. share of all words
    is split by weight; a target over epochs times its source stops there, and the
    excess is shared again. That is one water level: with sources by cap / weight,
    the level is the first at which those above it take what is left.
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("docs"))
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("double"))
    level = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = level.rowsBetween(W.unboundedPreceding, -1)
    after = level.rowsBetween(0, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap = F.col("source_size") * F.lit(float(epochs))
    by = by.withColumns({
        "cap": cap,
        "water": (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(after),
    })
    by = by.withColumn("level", F.min(F.when(F.col("water") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("water").alias("water")))).over(whole)["water"])
    return by.select("source", "source_size", "docs", F.least(F.col("cap"), F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every row of docs.

    Each document gets a random key, the start of the MD5 of its id. Keys are cut
    into ranges, of about BUCKET_DOCS documents of a source each, so that a hot
    source is spread; sums by range, their prefix sums and the prefix sums within a
    range give each document's place in its source's order (by key, id, then size).
    Whole epochs come first, and the rest is cut at the exact word. Reruns agree;
    a null text has size 0 and takes 0, a null id the key of '', a null source is
    a source, and equal rows share out the same amounts. Other columns aren't read.
    """
    size = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")
    base = settle(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size")))
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, KEY_BITS // 4), 16, 10).cast("long")
    targets = settle(source_targets(base))
    few = targets.count() <= BROADCAST_SOURCES
    keyed = base.withColumn("key", key).alias("d")
    joined = keyed.join((F.broadcast(targets) if few else targets).alias("t"), F.expr("d.source <=> t.source"))
    width = F.floor(F.lit(float(1 << KEY_BITS)) / F.ceil(F.col("docs") / BUCKET_DOCS)).cast("long") + 1
    placed = joined.select("doc_id", F.col("d.source").alias("source"), "size", "source_size", "target", "key", F.floor(F.col("key") / width).cast("int").alias("range"))
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    ahead = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("source", "range", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)).alias("start"))
    inner = W.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.withColumn("ahead", F.coalesce(F.sum("size").over(inner), F.lit(0))).alias("p")
    both = ranked.join(starts.alias("s"), F.expr("p.source <=> s.source and p.range = s.range"))
    words = F.floor(F.col("target")).cast("long")
    rounds = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    left = words - rounds * F.col("source_size") - F.col("start") - F.col("ahead")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return both.select("doc_id", F.col("p.source").alias("source"), "size", "source_size", "target", taken.cast("long").alias("taken"))
