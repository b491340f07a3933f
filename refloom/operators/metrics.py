"""Counts, recall and precision, percentages and outcome tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Outcomes, and the patterns that recode diagnoses to them, in order.
OUTCOMES = ("F.aligne", "F.maisOK", "F.silence", "F.bruit", "F.les2")
RECODE = (("^OUI$", "F.aligne"), ("^OUI_si_nettoie$", "F.aligne"), ("^NON_silence.*$", "F.silence"), (r"^NON_\+court.*$", "F.silence"), ("^NON_bruit.*$", "F.bruit"), (r"^NON_\+long.*$", "F.bruit"), ("^NON_diff$", "F.les2"), ("^OUI_avec.*$", "F.maisOK"))


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole rounded half to even; null where whole is 0."""
    return F.bround(F.try_divide(part.cast("double"), whole), digits)


def contingency(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """A row for each value of row, a count for each given value of column; absent pairs are 0."""
    out = df.groupBy(row).pivot(column, values).count()
    return out.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(str(v)) for v in values])


def recall_precision(df: DataFrame, aligned: str, silence: str, noise: str) -> DataFrame:
    """df with R and P, two decimals."""
    a = F.col(aligned)
    return df.withColumns({"R": ratio(a, a + F.col(silence)), "P": ratio(a, a + F.col(noise))})


def field_recall_precision(df: DataFrame, ok: str = "F.aligne", soft: str = "F.maisOK", silence: str = "F.silence", noise: str = "F.bruit", both: str = "F.les2") -> DataFrame:
    """Strict R and P, the gains of soft matches, and their sums after each was rounded; both counts against both."""
    c = lambda n: F.col(f"`{n}`")
    found, gained = c(ok), c(soft)
    r_all, p_all = found + gained + c(silence) + c(both), found + gained + c(noise) + c(both)
    out = df.withColumns({"Rs": ratio(found, r_all), "Ps": ratio(found, p_all), "gR": ratio(gained, r_all), "gP": ratio(gained, p_all)})
    return out.withColumns({"R": F.col("Rs") + F.col("gR"), "P": F.col("Ps") + F.col("gP")})


def recall_by(df: DataFrame, aligned: str, silence: str) -> DataFrame:
    """df with R alone."""
    return df.withColumn("R", ratio(F.col(aligned), F.col(aligned) + F.col(silence)))


def precision_by(df: DataFrame, aligned: str, noise: str) -> DataFrame:
    """df with P alone."""
    return df.withColumn("P", ratio(F.col(aligned), F.col(aligned) + F.col(noise)))


def name_recall_precision(df: DataFrame, ok: str, gold: str, todo: str, errors: tuple[str, ...] = ()) -> DataFrame:
    """df with R and P of names; with columns of errors that could be mended, also the gains gR and gP that their sum would bring."""
    out = df.withColumns({"R": ratio(F.col(ok), F.col(gold)), "P": ratio(F.col(ok), F.col(todo))})
    if not errors:
        return out
    mended = sum((F.coalesce(F.col(e), F.lit(0)) for e in errors), F.lit(0))
    return out.withColumns({"gR": ratio(mended, F.col(gold)), "gP": ratio(mended, F.col(todo))})


def author_totals(df: DataFrame, key: str, ok: str, gold: str, todo: str, name: str = "names") -> DataFrame:
    """One row of key, aligned, noise and silence: names that agree, and those of one side only."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return df.agg(total(ok).alias("aligned"), (total(todo) - total(ok)).alias("noise"), (total(gold) - total(ok)).alias("silence")).select(F.lit(name).alias(key), "aligned", "noise", "silence")


def by_period(df: DataFrame, period: str) -> DataFrame:
    """Rows by the lower bound of their period, the open one first."""
    return df.orderBy(F.coalesce(F.regexp_extract(period, "([0-9]+)", 1).try_cast("int") * F.when(F.col(period).contains("[*"), -1).otherwise(1), F.lit(1 << 30)), period)


def wide_percentages(df: DataFrame, row: str, counts: list[str], across: bool = True, total: bool = False, digits: int = 2) -> DataFrame:
    """row with each count as a share of its row, or (not across) of its column; with total a column, or a row, of the shares' whole."""
    c = lambda n: F.col(f"`{n}`")
    if across:
        whole = sum((c(n) for n in counts), F.lit(0))
        out = df.select(row, *[ratio(c(n), whole, digits).alias(n) for n in counts])
        return out.withColumn("TOTAL", F.lit(1.0)) if total else out
    sums = df.agg(*[F.sum(c(n)).alias(f"__{n}") for n in counts])
    out = df.crossJoin(F.broadcast(sums)).select(F.col(row).cast("string").alias(row), *[ratio(c(n), c(f"__{n}"), digits).alias(n) for n in counts])
    return out.unionByName(sums.select(F.lit("TOTAL").alias(row), *[F.lit(1.0).alias(n) for n in counts])) if total else out


def verdicts(df: DataFrame, methods: list[str]) -> DataFrame:
    """How often each method got each verdict, from a column of verdicts for each method."""
    return df.select(*methods).unpivot([], methods, "method", "verdict").where("verdict is not null").groupBy("method", "verdict").agg(F.count("*").alias("n"))


def usable_documents(df: DataFrame, version: str = "pdfver", bad: tuple[str, ...] = ("data", "empty")) -> DataFrame:
    """Rows whose version is known and none of the bad ones."""
    return df.where(~F.col(version).isin(*bad))


def append_report(df: DataFrame, path: str, digits: int = 2) -> None:
    """Add rows to a tab-separated report, fractions with a decimal comma."""
    fractions = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "decimal")}
    df.select(*[decimal_comma(F.col(f"`{c}`"), digits).alias(c) if c in fractions else F.col(f"`{c}`") for c in df.columns]).write.mode("append").option("sep", "\t").csv(path)


def flag_listed(df: DataFrame, key: str, listed: DataFrame, name: str, yes: str, no: str) -> DataFrame:
    """df with a column that tells whether the row's key is in a list; equal keys of the list count once."""
    ids = listed.select(F.col(listed.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn("__in", F.lit(True))
    return df.join(ids, key, "left").withColumn(name, F.when(F.col("__in"), yes).otherwise(no)).drop("__in")


def percentages(df: DataFrame, row: str, column: str, digits: int = 4) -> DataFrame:
    """Counts of pairs with their share of the row and of the column."""
    n = df.groupBy(row, column).agg(F.count("*").alias("n"))
    share = lambda by: F.bround(F.col("n") / F.sum("n").over(W.partitionBy(by)), digits)
    return n.withColumns({"row_share": share(row), "column_share": share(column)})


def margins(df: DataFrame, keys: list[str], value: str, total: str = "TOTAL") -> DataFrame:
    """Sums by keys and their rollups, in which a rolled-up key reads total."""
    up = df.rollup(*keys).agg(F.sum(value).alias("sum"), F.count("*").alias("n"), F.grouping_id().alias("__g"))
    k = len(keys)
    return up.select(*[F.when(F.col("__g").bitwiseAND(1 << (k - 1 - i)) != 0, F.lit(total)).otherwise(F.col(c).cast("string")).alias(c) for i, c in enumerate(keys)], "sum", "n")


def recode(value: Column) -> Column:
    """A diagnosis as an outcome; what no pattern fits stays."""
    out = value
    for pattern, name in reversed(RECODE):
        out = F.when(value.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def melt(df: DataFrame, keep: list[str], fields: list[str]) -> DataFrame:
    """A row for each of fields: keep, field and outcome."""
    return df.unpivot(keep, fields, "field", "outcome")


def outcome_matrix(long: DataFrame) -> DataFrame:
    """Recoded outcomes of each field, counted, with all columns."""
    return contingency(long.where("outcome is not null").select("field", recode(F.col("outcome")).alias("outcome")), "field", "outcome", list(OUTCOMES))


def outcomes_in_row(fields: list[str]) -> dict[str, Column]:
    """For each outcome, how many of the row's fields have it."""
    every = F.array(*[recode(F.col(f)) for f in fields])
    count = lambda name: F.size(F.filter(every, lambda x: x == F.lit(name))).cast("long")
    return {name: count(name) for name in OUTCOMES}


def drop_empty_rows(df: DataFrame, counts: list[str]) -> DataFrame:
    total = sum((F.col(f"`{c}`") for c in counts), F.lit(0))
    return df.where(total > 0)


def with_total(df: DataFrame, key: str, sums: list[str], total: str = "TOTAL") -> DataFrame:
    """df with a row of column sums."""
    return df.select(key, *sums).unionByName(df.agg(*[F.sum(c).alias(c) for c in sums]).withColumn(key, F.lit(total)).select(key, *sums))


def statistics_by(df: DataFrame, by: str, doc: str, sums: list[str]) -> DataFrame:
    """Documents, rows and sums for each value of a variable, in one aggregation."""
    return df.groupBy(by).agg(F.countDistinct(doc).alias("n_docs"), F.count("*").alias("n_rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums])


def document_class(df: DataFrame, doc: str, status: str, aligned: str = "ali") -> DataFrame:
    """Each document as no output, all noise or alignable, from the status of its rows ('' or null for none)."""
    by = df.groupBy(doc).agg(F.count(F.when(F.col(status) == aligned, 1)).alias("n_aligned"), F.count(F.when(F.col(status) != "", 1)).alias("n_rows"))
    return by.withColumn("class", F.when(F.col("n_rows") == 0, "no output").when(F.col("n_aligned") == 0, "all noise").otherwise("alignable"))


def global_counters(rows: DataFrame, alignment: str = "alignment", rule: str = "rule") -> DataFrame:
    """One row: K gold, L extracted, found, silence, noise, and recall and precision in percent."""
    n = lambda x: F.count(F.when(F.col(alignment) == x, 1))
    out = rows.agg(n("ali").alias("found"), n("silence").alias("silence"), n("noise").alias("noise"))
    out = out.withColumns({"K": F.col("found") + F.col("silence"), "L": F.col("found") + F.col("noise")})
    return out.withColumns({"R": ratio(F.col("found") * 100, F.col("K"), 1), "P": ratio(F.col("found") * 100, F.col("L"), 1)})


def decimal_comma(value: Column, digits: int = 2) -> Column:
    """A number with so many digits after a comma; null stays null."""
    return F.when(value.isNotNull(), F.translate(F.format_string(f"%.{digits}f", value), ".", ","))
