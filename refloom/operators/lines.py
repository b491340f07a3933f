"""Ordered lines: scores, champions, zones, islands and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.functions.layout import spread

# The heading of a reference list, and what speaks for a reference line: (weight, pattern). The two of weight 1
# with [\s\d] look ahead to it elsewhere; they take it here, since not every engine looks ahead.
HEADER = r"R ?[Ee] ?[Ff] ?[Ee] ?[Rr] ?[Ee] ?[Nn] ?[Cc] ?[Ee] ?[Ss]?s*:?\s*"
FEATURES = (
    (2, r"[:;,.\(\[]?\s?(?:18|19|20)[0-9]{2}[abcde]?\s?[:;,.\)\]]"),
    (2, r"[0-9]+(?:\([0-9]+\))?\s?:\s?[0-9]+\s?(?:[-‒–—―−﹣]\s?[0-9]+)?"),
    (2, r"\b[Vv]ol\.?\s?[0-9]+\s?[,\.;]\s?[Nn]o\.?\s?[0-9]+\s?[,\.;]\s?pp?\.?\s?\d+\s?[-–]?\s?\d*"),
    (2, r"[0-9]+(?:\([0-9]+\))?\s?,\s?[0-9]+\s?[-‒–—―−﹣]\s?[0-9]+"),
    (2, r"\b[Ii]n ?:"),
    (3, r"\bdoi: ?10\.[\S]+"),
    (1, r"\b[Vv]ol\.?[\s\d]"),
    (1, r"\bpp\.?[\s\d]"),
    (1, r"\b[0-9]+\s?[-‒–—―−﹣]\s?[0-9]+\b"),
)
STARTS = ((2, r"^(?:\[.{1,4}\]|[0-9]{1,3}\. )"), (2, r"^(?:\[.{1,4}\])\s*[A-Z].*?\b[A-Z]"))


def line_score(line: Column) -> Column:
    """Points of a line's own features."""
    total = F.lit(0)
    for weight, pattern in FEATURES:
        total = total + F.regexp_count(line, F.lit(pattern)) * weight
    for weight, pattern in STARTS:
        total = total + F.when(line.rlike(pattern), weight).otherwise(0)
    return total


def is_header(line: Column) -> Column:
    return line.rlike(HEADER)


def known_tokens(refs: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct searchable words of all references of a document."""
    from refloom.functions.text import searchable

    return refs.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+)"), 1)).alias("token")).where(searchable(F.col("token"))).distinct()


def cooccurrence(lines: DataFrame, refs: DataFrame, key: str, line: str = "line", text: str = "text") -> DataFrame:
    """key, i, j and score: word occurrences of line i that stand, as whole words, in reference j. An equi-join on words."""
    stop = ("", "&", "and", "in", "In")
    split = lambda c: F.filter(F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}_]+)"), 1), lambda t: ~t.isin(*stop))
    occurrences = lines.select(key, "i", F.explode(split(F.col(line))).alias("token")).groupBy(key, "i", "token").agg(F.count("*").alias("n"))
    words = refs.select(key, "j", F.explode(F.array_distinct(split(F.col(text)))).alias("token"))
    return occurrences.join(words, [key, "token"]).groupBy(key, "i", "j").agg(F.sum("n").alias("score"))


def forward_sums(values: Column, span: Column, sums: Column | None = None) -> Column:
    """For each place of an array the sum of span values from it on, cut at the end; by differences of prefix sums, which are made here if they aren't given."""
    n = F.size(values)
    if sums is None:
        sums = F.transform(values, lambda x, i: F.aggregate(F.slice(values, 1, i + 1), F.lit(0).cast("bigint"), lambda acc, y: acc + y.cast("bigint")))
    upto = lambda k: F.when(k > 0, F.element_at(sums, F.greatest(k, F.lit(1)).cast("int"))).otherwise(F.lit(0).cast("bigint"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: upto(F.least(i + span, n)) - upto(i))).otherwise(F.array().cast("array<bigint>"))


def forward_window(rows: DataFrame, partition: list[str], order: str, value: str, span: int, name: str = "ahead") -> DataFrame:
    """The same with one literal span, as a window."""
    return rows.withColumn(name, F.sum(value).over(W.partitionBy(*partition).orderBy(order).rowsBetween(0, span - 1)))


def zones(scored: DataFrame, key: str, n_refs: str = "n_refs", parity: bool = False) -> DataFrame:
    """key, first and last line of the reference zone of each document (null where it would be over 12 times as long as there are references).

    scored has key, i, score, header and n_refs. The zone begins at the last header;
    else at the best line of a single reference; else one line before the best span
    of 3 n + 1 lines (never before the first line, but with parity). It goes on while
    the next short sum, of min(n / 2, 10) lines, is positive.
    """
    score = F.col("score").cast("bigint")
    summed = scored.withColumn("__sum", F.sum(score).over(W.partitionBy(key).orderBy("i").rowsBetween(W.unboundedPreceding, 0)))
    per = summed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", score.alias("score"), "__sum"))).alias("__l"), F.max(F.when(F.col("header"), F.col("i"))).alias("__h"), F.max(n_refs).cast("int").alias("n_refs"))
    per = per.withColumns({"__s": F.transform("__l", lambda x: x["score"]), "__sums": F.transform("__l", lambda x: x["__sum"])})
    best = lambda a: (F.array_position(a, F.array_max(a)) - 1).cast("int")
    per = per.withColumns({"__long": forward_sums(F.col("__s"), F.col("n_refs") * 3 + 1, F.col("__sums")), "__short": forward_sums(F.col("__s"), F.least((F.col("n_refs") / 2).cast("int"), F.lit(10)), F.col("__sums"))})
    before = best(F.col("__long")) - 1
    per = per.withColumn("first", F.coalesce("__h", F.when(F.col("n_refs") == 1, best(F.col("__s"))).otherwise(before if parity else F.greatest(before, F.lit(0)))))
    n = F.size("__s")
    stops = F.filter(F.sequence(F.col("first"), n - 1), lambda i: F.when(i >= n - 1, True).otherwise(F.element_at("__short", i + 2) <= 0))
    per = per.withColumn("last", F.element_at(stops, 1))
    fits = F.col("last") - F.col("first") <= F.col("n_refs") * 12
    return per.select(key, F.when(fits, F.col("first")).alias("first"), F.when(fits, F.col("last")).alias("last"), "n_refs")


#: Results of a fold that are gathered in one array.
CHUNK = 128


def champions(scores: DataFrame, lines: DataFrame, key: str, n_refs: str = "n_refs") -> DataFrame:
    """key, i and j: the reference that each line belongs to, or null.

    lines has key, i and n_refs; scores has key, i, j and score. The best reference
    needs 5 points, or, if it goes on from the line before, twice the mean of the
    others; a tie is kept by the line before's if over 5 points and few tie. What is
    remembered from line to line is the chosen reference even where it fell short.
    """
    top = scores.groupBy(key, "i").agg(F.max("score").alias("m"), F.sum("score").alias("s"), F.collect_list(F.struct("score", "j")).alias("__c"))
    top = top.select(key, "i", F.col("m").cast("bigint").alias("m"), F.col("s").cast("bigint").alias("s"), F.transform(F.filter("__c", lambda x: x["score"] == F.col("m")), lambda x: x["j"].cast("int")).alias("c"))
    rows = lines.select(key, "i", F.col(n_refs).cast("int").alias("n")).join(top, [key, "i"], "left")
    per = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("i").cast("int").alias("i"), F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("c", F.array().cast("array<int>")).alias("c"), "n"))).alias("__l"))
    none = F.lit(None).cast("int")

    def step(acc, x):
        before = acc["memory"]
        one = F.when(F.size(x["c"]) == 1, F.element_at(x["c"], 1))
        # With a single reference a line of no score is a candidate of that reference alone.
        one = F.when((x["m"] == 0) & (x["n"] == 1), F.lit(0)).otherwise(one)
        same = F.coalesce(one == before, F.lit(False))
        drift = (x["s"] - x["m"]) / x["n"]
        tie = (F.size(x["c"]) > 1) & (x["m"] > 5) & F.coalesce(F.array_contains(x["c"], before), F.lit(False)) & (F.size(x["c"]) <= x["n"] / 10)
        j = F.when(tie, before).when(one.isNotNull() & ~same & (x["m"] >= 5), one).when(one.isNotNull() & same & (x["m"] > drift * 2), one)
        memory = F.when(tie, before).when(one.isNotNull() & (same | (x["m"] >= 5)), one)
        # Results are gathered in chunks, so that a step copies one chunk and not all of them.
        full, one_more = F.size(acc["out"]) >= CHUNK, F.array(F.struct(x["i"].alias("i"), j.alias("j")))
        done = F.when(full, F.concat(acc["done"], F.array(acc["out"]))).otherwise(acc["done"])
        return F.struct(memory.alias("memory"), done.alias("done"), F.when(full, one_more).otherwise(F.concat(acc["out"], one_more)).alias("out"))

    start = F.struct(none.alias("memory"), F.array().cast("array<array<struct<i:int,j:int>>>").alias("done"), F.array().cast("array<struct<i:int,j:int>>").alias("out"))
    return per.select(key, F.inline(F.aggregate("__l", start, step, lambda a: F.concat(F.flatten(a["done"]), a["out"]))))


def checked(js: Column) -> Column:
    """Struct of ordered and js: whether an array of references (null for none) goes up one by one, with repeats, from 0; and the array with at most one stray corrected.

    A stray is neither the reference before it, gaps aside, nor the next number. The
    first stray whose two neighbours are alike (both null as well; before the first
    and after the last stands -1) becomes what they are; any other one breaks the
    order. The third stray ends the check. Repeats don't count as neighbours.
    """
    following = F.concat(F.slice(js, 2, F.greatest(F.size(js) - 1, F.lit(0))), F.array(F.lit(-1)))
    steps = F.transform(F.arrays_zip(js.alias("w"), following.alias("after")), lambda x, k: F.struct(k.alias("k"), x["w"].alias("w"), x["after"].alias("after")))
    none = F.lit(None).cast("int")

    def step(acc, x):
        w, up = x["w"], x["w"] == acc["known"] + 1
        stray = w.isNotNull() & (w != acc["known"]) & ~up
        strays = acc["strays"] + stray.cast("int")
        mend = stray & (strays < 3) & acc["at"].isNull() & acc["before"].eqNullSafe(x["after"])
        now = F.when(mend, acc["before"]).otherwise(w)
        new = F.struct(
            F.when(up, w).when(mend, F.coalesce(acc["before"], acc["known"])).otherwise(acc["known"]).alias("known"),
            F.when(w.isNull(), none).when(up | stray, now).otherwise(acc["before"]).alias("before"),
            strays.alias("strays"), F.when(mend, x["k"]).otherwise(acc["at"]).alias("at"), F.when(mend, acc["before"]).otherwise(acc["to"]).alias("to"), (acc["ordered"] & (~stray | mend | (strays >= 3))).alias("ordered"),
        )
        return F.when(acc["strays"] >= 3, acc).otherwise(new)

    start = F.struct(F.lit(-1).alias("known"), F.lit(-1).alias("before"), F.lit(0).alias("strays"), none.alias("at"), none.alias("to"), F.lit(True).alias("ordered"))
    end = lambda acc: F.struct(acc["ordered"].alias("ordered"), F.transform(js, lambda w, k: F.when(k == acc["at"], acc["to"]).otherwise(w)).alias("js"))
    return F.aggregate(steps, start, step, end)


def sequences(champs: DataFrame, key: str) -> DataFrame:
    """key, ordered and the corrected references of its lines in order."""
    per = champs.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "j"))), lambda x: x["j"].cast("int")).alias("js"))
    return per.select(key, checked(F.col("js")).alias("r")).select(key, "r.ordered", "r.js")


def islands(rows: DataFrame, partition: list[str], order: str, value: str, text: str, mark: str = "¤") -> DataFrame:
    """Runs of neighbours with one value: partition, island, value, first, n and their texts joined in order."""
    w = W.partitionBy(*partition).orderBy(order)
    new = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    numbered = rows.withColumn("__new", new).withColumn("island", F.sum("__new").over(w))
    out = numbered.groupBy(*partition, "island").agg(F.first(value).alias(value), F.min(order).alias("first"), F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]).alias("__t"))
    return out.withColumn("text", F.array_join("__t", mark)).drop("__t")


def group_lines(rows: DataFrame, keys: list[str], order: str, text: str, mark: str = "¤") -> DataFrame:
    """Texts of one reference joined in line order, wherever they stand."""
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), mark).alias("text"))


def numbered_consecutively(labels: DataFrame, key: str, order: str, n: str = "n") -> DataFrame:
    """Whether a document's labels are 1, 2, 3, ... in order."""
    place = F.row_number().over(W.partitionBy(key).orderBy(order))
    return labels.withColumn("__p", place).groupBy(key).agg(F.coalesce(F.every(F.col(n) == F.col("__p")), F.lit(False)).alias("consecutive"))


def duplicate_suffix(rows: DataFrame, partition: list[str], name: str, order: list[str]) -> DataFrame:
    """Repeated names get -1, -2, ... from their second appearance on."""
    k = F.row_number().over(W.partitionBy(*partition, name).orderBy(*order)) - 1
    return rows.withColumn("unique_name", F.when(k == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("-"), k)))


def padded_sequence(rows: DataFrame, order: list[str], width: int) -> DataFrame:
    """A zero-padded number of each row in order; one ordered partition, so for lists of documents, not of lines."""
    return rows.withColumn("seq", F.lpad(F.row_number().over(W.orderBy(*order)).cast("string"), width, "0"))


def lines_of_refs(grouped: DataFrame, refs: DataFrame, key: str, ref: str = "j", parity: bool = False) -> DataFrame:
    """Each reference's lines, grouped to one text, beside the reference itself. With parity a document's last group is left out."""
    if parity:
        grouped = grouped.withColumn("__last", F.max(ref).over(W.partitionBy(key))).where(F.col(ref) < F.col("__last")).drop("__last")
    return grouped.join(refs, [key, ref])


def line_statistics(lines: DataFrame, key: str, line: str = "line") -> DataFrame:
    return lines.groupBy(key).agg(F.count("*").alias("n_lines"), F.sum(F.length(line)).alias("total"), F.avg(F.length(line)).alias("mean"))
