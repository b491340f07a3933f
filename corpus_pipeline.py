"""A corpus pipeline: toxic documents go, boilerplate lines go, near copies go, benchmark leaks go, and sources are mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm.columns import spare
from refloom.llm.decontamination import drop_contaminated
from refloom.llm.durable import settle
from refloom.llm.line_dedup import line_dedup
from refloom.llm.mixing import mix_sources
from refloom.llm.ngram_join import keep_one
from refloom.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, each judged by its own text.

    Null and empty texts stay, rows of one text go or stay together whatever their
    ids, and without labels or documents nothing goes.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines; n_chars follows the text.

    Documents of such lines only are copies of each other: they stay whole here, and
    the next stage keeps one of each group of them. Each row counts as a page; rows
    without a source are one source; null texts stay null.
    """
    lines, dropped = spare(docs, "n_lines", "n_dropped")
    out = line_dedup(docs, whole_copies=True, counts=(lines, dropped))
    return out.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies.

    Rows are told apart by id and text, so rows of one id with other texts are other
    documents; of equal rows one stays. Rows without an id go where one of their group
    has one; else one of the group stays. Rows without words are no copies: those of
    one id are one document, those without an id all stay.
    """
    return keep_one(docs, keep_unnamed=False)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text isn't contaminated, whatever other rows of their id hold; null and empty texts stay."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; the last stage. A row for each row; null texts have no words, and rows without a source are a source."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: The first stage's classifier can't be expressed in SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs)
    return docs
