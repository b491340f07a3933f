"""Jobs from the command line: python -m refloom JOB --help."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from refloom.operators import sampling
from refloom.plans import evaluation, pipelines
from refloom.sources import tables


def link(spark: SparkSession, args: argparse.Namespace) -> None:
    """Link the references of documents (doc_key, xml) to a catalogue of hits."""
    known = tables.abbreviations(spark, args.abbreviations) if args.abbreviations else None
    pipelines.link(spark.read.parquet(args.docs), spark.read.parquet(args.catalogue), known).write.parquet(args.out)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Compare extracted references with gold ones: table, counters, lookup and a line for the report."""
    gold, todo = spark.read.parquet(args.gold), spark.read.parquet(args.todo)
    evaluation.table(gold, todo).write.parquet(f"{args.out}/table")
    counted = evaluation.counters(gold, todo, spark.read.parquet(f"{args.out}/table"))
    counted.write.parquet(f"{args.out}/counters")
    evaluation.lookup(gold, todo).write.parquet(f"{args.out}/lookup")
    evaluation.append_summary(evaluation.summary(spark.read.parquet(f"{args.out}/counters"), args.id), f"{args.out}/report")


def convert(spark: SparkSession, args: argparse.Namespace) -> None:
    """Convert publishers' documents (doc_key, xml) to documents with references of one schema."""
    pipelines.convert_corpus(spark.read.parquet(args.docs)).write.parquet(args.out)


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    """Draw a stratified sample: ids, rows and the log of the run."""
    criteria, log = args.criteria.split(","), []
    chosen = sampling.sample(spark.read.parquet(args.docs), args.key, criteria, sampling.SampleConfig(size=args.size, seed=args.seed), log=log)
    sampling.sample_ids(chosen, args.key, criteria).write.parquet(f"{args.out}/ids")
    chosen.write.parquet(f"{args.out}/rows")
    sampling.run_log(spark, log).write.parquet(f"{args.out}/log")


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write the training files of a model from marked lines or tagged references."""
    pipelines.training_file(args.model, spark.read.parquet(args.rows)).write.parquet(args.out)


#: Jobs and their arguments: (name, whether it must be given, kind).
JOBS = {
    link: (("docs", True, str), ("catalogue", True, str), ("abbreviations", False, str), ("out", True, str)),
    evaluate: (("gold", True, str), ("todo", True, str), ("id", False, str), ("out", True, str)),
    convert: (("docs", True, str), ("out", True, str)),
    sample: (("docs", True, str), ("key", True, str), ("criteria", True, str), ("size", True, int), ("seed", False, int), ("out", True, str)),
    train: (("model", True, str), ("rows", True, str), ("out", True, str)),
}


def main(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="refloom")
    jobs = parser.add_subparsers(required=True)
    for job, args in JOBS.items():
        own = jobs.add_parser(job.__name__, help=job.__doc__)
        for name, required, kind in args:
            own.add_argument(f"--{name}", required=required, type=kind, default=0 if kind is int else None)
        own.set_defaults(job=job)
    chosen = parser.parse_args(argv)
    chosen.job(SparkSession.builder.getOrCreate(), chosen)


if __name__ == "__main__":
    main(sys.argv[1:])
