"""The evaluation report: a row for each reference of either side, counters, the summary row and the table of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.operators import linkage
from refloom.operators.metrics import ratio
from refloom.sources import tei

# The columns of the table, the names of the outcomes, and how an original is classed, as they are written.
COLUMNS = ("tdoc_id", "gbib_id", "tbib_id", "match", "match_rule", "pubtype", "tei_analytic", "gfields", "tfields", *(f"F{f}" for f in linkage.FIELDS), "gnames", "tnames", "oknames")
ALIGNED, SILENCE, NOISE = "aligné", "silence", "bruit"
ANALYTIC, MONOGRAPH = "an+mo", "mo"
SUMMARY = ("n_docs", "n_gold", "R", "P", "by_title", "by_issue", "by_names", "found", "eval_id")


def sides(gold_docs: DataFrame, todo_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that both sides have, each with whether it and its partner are well-formed."""
    g, t = (tei.parsed(docs).withColumnRenamed("well_formed", "ok") for docs in (gold_docs, todo_docs))
    with_ok = lambda a, b: a.join(b.select("doc_key", F.col("ok").alias("other_ok")), "doc_key")
    return with_ok(g, t), with_ok(t, g)


def _fields(docs: DataFrame, wide: bool) -> DataFrame:
    """Canonical fields of the references of well-formed documents, numbered from 1."""
    return tei.canonical_fields(tei.references(docs.where("ok"), wide=wide)).withColumn("n", F.col("n") + 1)


def table(gold_docs: DataFrame, todo_docs: DataFrame) -> DataFrame:
    """COLUMNS of every reference of well-formed gold documents and their partners; null where nothing is to be said.

    A reference without a partner says of each field that it has that it is lost with it.
    """
    gold, todo = sides(gold_docs, todo_docs)
    g, t = _fields(gold, True).withColumnRenamed("n", "g"), _fields(todo.where("other_ok"), False).withColumnRenamed("n", "t")
    both = gold.where("ok").select("doc_key")
    rows = linkage.align(g, t).unionByName(_alone(g, t, both))
    named = lambda df, k: df.select("doc_key", k, *[F.col(c).alias(f"{k}_{c}") for c in (*linkage.FIELDS, "names", "has_analytic")])
    full = rows.join(named(g, "g"), ["doc_key", "g"], "left").join(named(t, "t"), ["doc_key", "t"], "left")
    pairs, alone = full.where("alignment = 'ali'"), full.where("alignment <> 'ali'")
    keep = ["doc_key", "g", "t", "alignment", "rule", *(f"{k}_{c}" for k in "gt" for c in (*linkage.FIELDS, "names", "has_analytic"))]
    said = linkage.diagnose(pairs, keep)
    lost = lambda f: F.when(F.coalesce(f"g_{f}", f"t_{f}").isNotNull(), F.when(F.col("alignment") == "silence", "NON_silence_captif").otherwise("NON_bruit_captif"))
    lost_rows = alone.select(*keep, *[lost(f).alias(f) for f in linkage.FIELDS])
    return said.unionByName(lost_rows).select(*_columns())


def _alone(g: DataFrame, t: DataFrame, both: DataFrame) -> DataFrame:
    """Rows of references whose partner document has none at all."""
    none = F.lit(None)
    row = lambda df, other, mine, name: df.join(both, "doc_key", "left_semi").join(other.select("doc_key").distinct(), "doc_key", "left_anti").select("doc_key", *[F.col(k).cast("long").alias(k) if k == mine else none.cast("long").alias(k) for k in "gt"], F.lit(name).alias("alignment"), none.cast("int").alias("rule"))
    return row(g, t, "g", "silence").unionByName(row(t, g, "t", "noise"))


def _columns() -> list[Column]:
    ali, has = F.col("alignment") == "ali", lambda k: F.col(k).isNotNull()
    kind = lambda k: F.when(has(k), F.when(F.col(f"{k}_has_analytic"), ANALYTIC).otherwise(MONOGRAPH))
    count = lambda k: F.when(has(k), linkage.defined_fields(lambda f: F.col(f"{k}_{f}")))
    names = lambda k: F.when(has(k), F.size(f"{k}_names"))
    rule = F.element_at(F.array(*map(F.lit, linkage.RULES)), F.col("rule"))
    return [
        F.col("doc_key").alias("tdoc_id"), F.col("g").alias("gbib_id"), F.col("t").alias("tbib_id"), F.when(ali, ALIGNED).when(has("g"), SILENCE).otherwise(NOISE).alias("match"), F.when(ali, rule).alias("match_rule"),
        kind("g").alias("pubtype"), kind("t").alias("tei_analytic"), count("g").alias("gfields"), count("t").alias("tfields"), *[F.col(f).alias(f"F{f}") for f in linkage.FIELDS],
        names("g").alias("gnames"), names("t").alias("tnames"), F.when(ali, linkage.names_aligned(F.col("g_names"), F.col("t_names"))).otherwise(0).alias("oknames"),
    ]


def counters(gold_docs: DataFrame, todo_docs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row: documents of either side, aligned, matchable (both well-formed), with errors and without references; references K and L and those that could match; found ones by rule, silence and noise; recall and precision, plain and on what could match.

    Gold references without structure could not be matched: what they gave rise to is
    taken off the noise and off what could match. rows is the table, if it was made already.
    """
    gold, todo = sides(gold_docs, todo_docs)
    n = lambda test: F.count(F.when(test, 1))
    k = tei.references(gold.where("ok"), wide=True).groupBy("doc_key").agg(F.count("*").alias("k"))
    l = tei.references(todo.where("ok")).groupBy("doc_key").agg(F.count("*").alias("l"))
    every = tei.references_anywhere(gold.where("ok")).join(tei.unstructured_count(gold.where("ok")), "doc_key")
    per = gold.select("doc_key", "ok", "other_ok").join(k, "doc_key", "left").join(l, "doc_key", "left").join(every, "doc_key", "left").na.fill(0, ["k", "l", "n_anywhere", "n_bibl"])
    loose = F.when(F.col("ok"), F.col("n_anywhere") + F.col("n_bibl") - F.col("k")).otherwise(0)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    docs = per.agg(
        F.count("*").alias("aligned_docs"), n(F.col("ok") & F.col("other_ok")).alias("matchable_docs"), n(~F.col("ok")).alias("gold_errors"), n(~F.col("other_ok")).alias("todo_errors"),
        n(F.col("ok") & (F.col("k") == 0)).alias("empty_gold"), n(F.col("ok") & F.col("other_ok") & (F.col("l") == 0)).alias("empty_todo"),
        total("k").alias("K"), total(F.when(F.col("other_ok"), F.col("k"))).alias("matchable_K"), total("l").alias("L"), (total("l") - total(loose)).alias("matchable_L"), total(loose).alias("loose"),
    )
    rows = table(gold_docs, todo_docs) if rows is None else rows
    by = rows.agg(*[n(F.col("match_rule") == r).alias(c) for r, c in zip(linkage.RULES, ("by_title", "by_names", "by_issue", "by_heuristic"), strict=True)], n(F.col("match") == ALIGNED).alias("found"))
    out = docs.crossJoin(F.broadcast(by)).crossJoin(F.broadcast(gold_docs.agg(F.count("*").alias("gold_docs")))).crossJoin(F.broadcast(todo_docs.agg(F.count("*").alias("todo_docs"))))
    out = out.withColumns({"silence": F.col("K") - F.col("found"), "noise": F.col("L") - F.col("found") - F.col("loose")}).drop("loose")
    return out.withColumns({"R": ratio(F.col("found"), F.col("K"), 3), "R_base": ratio(F.col("found"), F.col("matchable_K"), 3), "P": ratio(F.col("found"), F.col("L"), 3), "P_base": F.when(F.col("L") != 0, ratio(F.col("found"), F.col("matchable_L"), 3))})


def summary(counted: DataFrame, eval_id: str | None = None) -> DataFrame:
    """The row of SUMMARY that is appended to a report of evaluations; err where there is nothing to divide by, and an id of letters, digits, _ and - only."""
    share = lambda whole: F.when(F.col(whole) == 0, "err").otherwise(F.format_string("%.3f", F.col("found") / F.col(whole)))
    name = F.regexp_replace(F.lit(eval_id).cast("string"), "[^a-zA-Z0-9_-]", "_")
    return counted.select(F.col("aligned_docs").alias("n_docs"), F.col("K").alias("n_gold"), share("matchable_K").alias("R"), share("matchable_L").alias("P"), "by_title", "by_issue", "by_names", "found", name.alias("eval_id"))


def append_summary(row: DataFrame, path: str) -> None:
    """Add the row to a tab-separated report."""
    row.write.mode("append").option("sep", "\t").csv(path)


def lookup(gold_docs: DataFrame, todo_docs: DataFrame) -> DataFrame:
    """todo_id and name of the documents that both sides have, numbered by name; a list of documents, so one ordered partition."""
    names = todo_docs.select("doc_key").join(gold_docs.select("doc_key"), "doc_key", "left_semi").distinct()
    return names.select(F.row_number().over(W.orderBy("doc_key")).alias("todo_id"), F.col("doc_key").alias("name"))
