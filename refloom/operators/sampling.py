"""Pools, quotas and reproducible stratified draws."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Labels of unknown criteria, as they are written in results.
UNKNOWN = {"lang": "UNKOWN_LANG", "genre": "UNKOWN_GENRE", "category": "UNKOWN_SCI_CAT"}


@dataclass(frozen=True)
class SampleConfig:
    size: int = 100
    runs: int = 5
    smoothing: float = 0.2
    under: float = 0.85
    seed: int = 0


#: Combinations of values that are broadcast at most.
BROADCAST_COMBOS = 100_000
# Codes of the steps of a run, as they are written in its log.
STEPS = ("INIT", "CRIT", "WITH", "XGOT", "LESS", "REDO", "SMOO", "RLAX", "XDEL", "SAVE")


def facet_terms(df: DataFrame, field: str) -> DataFrame:
    """Values of a field and how many rows have each."""
    return df.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"))


def pool(df: DataFrame, facets: list[str]) -> DataFrame:
    """Counts of all combinations of the facets' values, zero ones too. The product is of the values, not of rows.

    The values of all facets but the first are counted before they are sent to the
    rows of the first; where their product is over BROADCAST_COMBOS it is an error,
    since a pool of that size can't be sampled from.
    """
    values = [df.select(f).where(F.col(f).isNotNull()).distinct() for f in facets]
    if len(facets) > 1 and reduce(lambda a, b: a * b, [v.count() for v in values[1:]]) > BROADCAST_COMBOS:
        raise ValueError(f"over {BROADCAST_COMBOS} combinations of {facets[1:]}")
    combos = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), values)
    counts = df.groupBy(*facets).agg(F.count("*").alias("n"))
    return combos.join(counts, facets, "left").na.fill(0, ["n"])


def pool_totals(df: DataFrame, facets: list[str]) -> DataFrame:
    """Rows that have every facet, and all rows."""
    has = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in facets])
    return df.agg(F.count(F.when(has, 1)).alias("n_workdocs"), F.count("*").alias("n_docs"))


def quotas(counts: DataFrame, size: int, n: str = "n", smoothing: float = 0.0) -> DataFrame:
    """round(size * n / total + smoothing), half to even, for each stratum; zero quotas go. The total is one row."""
    total = counts.agg(F.sum(n).alias("__total"))
    out = counts.crossJoin(F.broadcast(total)).withColumn("quota", F.bround(F.lit(float(size)) * F.col(n) / F.col("__total") + F.lit(float(smoothing))).cast("long"))
    return out.where(F.col("quota") > 0).drop("__total")


def draw(df: DataFrame, strata: list[str], quota: DataFrame, order: list[Column]) -> DataFrame:
    """The first quota rows of each stratum in the given order (a hash of the id and a seed makes it random)."""
    rank = F.row_number().over(W.partitionBy(*strata).orderBy(*order))
    return df.join(quota.select(*strata, "quota"), strata).withColumn("rank", rank).where(F.col("rank") <= F.col("quota"))


def quota_total(quota: DataFrame) -> int:
    """Rows that all quotas ask for, after each was rounded."""
    return int(quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])


def without(df: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """Rows whose key no row of excluded has."""
    return df.join(excluded.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def hash_order(key: str, seed: int = 0) -> list[Column]:
    return [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)]


def under_filled(drawn: DataFrame, quota: DataFrame, strata: list[str], config: SampleConfig) -> DataFrame:
    """Strata with fewer rows than a share of their quota."""
    got = drawn.groupBy(*strata).agg(F.count("*").alias("got"))
    return quota.join(got, strata, "left").na.fill(0, ["got"]).where(F.col("got") < F.lit(config.under) * (F.col("quota") - F.lit(config.smoothing)))


def sample(df: DataFrame, key: str, criteria: list[str], config: SampleConfig = SampleConfig(), excluded: DataFrame | None = None, log: list[tuple[int, str, str]] | None = None) -> DataFrame:
    """A sample of config.size rows: runs draw what is missing, the last criterion goes where strata were under-filled, and what is over is pruned by hash.

    log, if given, gets (run, code, message) of each step. What a run drew is kept on
    the executors' disks until the sample is complete.
    """
    note = lambda run, code, text: log.append((run, code, text)) if log is not None else None
    note(0, "INIT", f"sampling {config.size}")
    note(0, "CRIT", f"fields({', '.join(criteria)})")
    held = []
    left = df if excluded is None else without(df, key, excluded)
    taken, missing = None, config.size
    for run in range(config.runs):
        if missing <= 0 or not criteria:
            break
        counts = left.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in criteria])).groupBy(*criteria).agg(F.count("*").alias("n"))
        quota = quotas(counts, missing, smoothing=config.smoothing * run)
        got = draw(left, criteria, quota, hash_order(key, config.seed + run)).select(*df.columns, F.lit(run).alias("run")).persist(StorageLevel.DISK_ONLY)
        held.append(got)
        less = under_filled(got, quota, criteria, config).limit(1).count()
        taken = got if taken is None else taken.unionByName(got)
        left = left.join(got.select(key), key, "left_anti")
        missing = config.size - taken.count()
        note(run, "XGOT", f"{config.size - missing} of {config.size}")
        if missing > 0 and run + 1 < config.runs:
            note(run, "REDO", f"{missing} missing")
            note(run, "SMOO", f"{config.smoothing * (run + 1):.2f}")
        if less:
            note(run, "LESS", f"strata under {config.under:.2f} of their quota")
        if less and len(criteria) > 1:
            note(run, "RLAX", f"without {criteria[-1]}")
            criteria = criteria[:-1]
    if taken is None:
        return df.limit(0).withColumn("run", F.lit(0))
    if missing < 0:
        note(config.runs, "XDEL", f"{-missing} over")
    # The sample is of a bounded size: it is taken to the driver once, so that what the runs held can be released.
    chosen = taken.orderBy(*hash_order(key, config.seed)).limit(config.size)
    out = df.sparkSession.createDataFrame(chosen.toArrow(), chosen.schema)
    for got in held:
        got.unpersist()
    note(config.runs, "SAVE", f"{min(config.size, config.size - missing)} documents")
    return out


def sample_ids(chosen: DataFrame, key: str, criteria: list[str]) -> DataFrame:
    """The sampled ids, by stratum and id."""
    return chosen.orderBy(*criteria, key).select(key)


def sample_table(chosen: DataFrame, key: str, criteria: list[str], columns: list[str]) -> DataFrame:
    """The sampled rows as a table: id, stratum and the columns, by stratum and id."""
    return chosen.withColumn("stratum", F.concat_ws(" AND ", *[F.concat(F.lit(f"{c}:"), F.col(c).cast("string")) for c in criteria])).orderBy(*criteria, key).select(key, "stratum", *columns)


def sample_documents(chosen: DataFrame, key: str, criteria: list[str], documents: DataFrame) -> DataFrame:
    """The sampled documents, by stratum and id; a sampled id without a document is left out."""
    return chosen.select(key, *criteria).join(documents.drop(*[c for c in criteria if c in documents.columns]), key).orderBy(*criteria, key)


def run_log(spark, log: list[tuple[int, str, str]]) -> DataFrame:
    """The steps of a run in order: step, run, code and message."""
    return spark.createDataFrame([(k, *entry) for k, entry in enumerate(log)], "step int, run int, code string, message string")


def limited(df: DataFrame, key: str, most: int | None = None, test: bool = False, seed: int = 0) -> DataFrame:
    """At most so many documents, the first by key; or for a test three at random, the same ones for a seed."""
    if test:
        return df.orderBy(*hash_order(key, seed)).limit(3)
    return df if most is None else df.orderBy(key).limit(most)


def complement(value: Column, named: list[str], rest: str = "others") -> Column:
    """The value if it is a named one, else rest."""
    return F.when(value.isin(*named), value).otherwise(F.lit(rest))


def sample_index(df: DataFrame) -> DataFrame:
    """Criteria with unknown values spelt out."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in UNKNOWN.items() if c in df.columns})
