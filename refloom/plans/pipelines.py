"""End-to-end jobs: linking, evaluation, conversion, and training data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.operators import lines as ln
from refloom.operators import convert, linkage, metrics, projection, query
from refloom.sources import tables, tei


def link(docs: DataFrame, catalogue: DataFrame, abbreviations: DataFrame | None = None) -> DataFrame:
    """source_id, bib_id and target of every reference: candidates share tokens, the best one is validated."""
    bibs = tei.references(tei.parsed(docs).where("well_formed"))
    values = tei.subvalues(tei.linkable(bibs))
    tokens = values.select("doc_key", "bib_id", F.explode(tei.tokens(F.col("field"), F.col("value"))).alias("token")).groupBy("doc_key", "bib_id").agg(F.array_join(F.collect_set("token"), " ").alias("q"))
    keyed = tokens.withColumn("ref", F.struct("doc_key", "bib_id"))
    text = F.concat_ws(" ", "title", "host.title", F.array_join(F.transform("author", lambda a: a["name"]), " "), "publicationDate", "host.volume", "host.pages.first")
    scores = query.match_any_token(keyed, catalogue.withColumn("__text", text), "ref", "q", "id", "__text", least=1)
    top = query.top_hit(scores, "ref", "id").select(F.col("ref.doc_key").alias("doc_key"), F.col("ref.bib_id").alias("bib_id"), "id")
    first = lambda f: F.first(F.when(F.col("field") == f, F.col("value")), ignorenulls=True)
    facts = values.groupBy("doc_key", "bib_id").agg(first("publicationDate").alias("date"), first("host.volume").alias("volume"), first("host.pages.first").alias("first_page"), first("host.title").alias("host_title"), first("title").alias("title"), first("author.name").alias("author"))
    facts = facts.withColumn("issn", F.lit(None).cast("string")) if abbreviations is None else linkage.with_issn(facts, abbreviations)
    joined = facts.join(top, ["doc_key", "bib_id"]).alias("b").join(catalogue.alias("h"), "id")
    rule = linkage.validate_hit(lambda c: F.col(f"b.{c}"), lambda c: F.col(f"h.{c}"), F.col("b.issn"))
    found = joined.withColumn("rule", rule).where("rule is not null").select("b.doc_key", "b.bib_id", F.col("id").alias("target"))
    return tei.link_table(bibs.select("doc_key", "bib_id"), found)


def evaluate(gold_docs: DataFrame, todo_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Aligned, missed and wrong references with rules, and the global counters."""
    fields = lambda docs, n: tei.canonical_fields(tei.references(tei.parsed(docs).where("well_formed"), wide=True)).withColumnRenamed("n", n)
    rows = linkage.align(fields(gold_docs, "g"), fields(todo_docs, "t"))
    return rows, metrics.global_counters(rows)


def training_lines(docs: DataFrame, refs: DataFrame, key: str = "doc_key") -> DataFrame:
    """key, i, line, zone and j of every line: the reference zone, and the reference of each line in it."""
    lines = tables.explode_lines(docs, key, "text")
    counts = refs.groupBy(key).agg(F.count("*").alias("n_refs"))
    known = ln.known_tokens(refs, key, "text")
    words = lines.select(key, "i", F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit(r"([\p{L}\p{N}_]+)"), 1))).alias("token"))
    hits = words.join(known, [key, "token"]).groupBy(key, "i").agg((F.count("*") * 2).alias("hits"))
    scored = lines.join(hits, [key, "i"], "left").join(counts, key).select(key, "i", (ln.line_score(F.col("line")) + F.coalesce("hits", F.lit(0))).alias("score"), ln.is_header(F.col("line")).alias("header"), "n_refs")
    marked = projection.mark_zone(lines, ln.zones(scored, key), key)
    inside = marked.where("zone = 'listBibl'")
    champs = ln.champions(ln.cooccurrence(inside, refs, key), inside.join(counts, key), key)
    return marked.join(champs, [key, "i"], "left")


def convert_corpus(docs: DataFrame) -> DataFrame:
    """doc_key and xml: a document with the converted references of each publisher's document for which there are rules."""
    bibs = convert.to_tei(convert.convert(convert.with_dialect(docs)))
    per = bibs.groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "bib"))), lambda x: x["bib"]), "").alias("bibs"))
    return per.select("doc_key", F.concat(F.lit("<TEI><text><back><div><listBibl>"), "bibs", F.lit("</listBibl></div></back></text></TEI>")).alias("xml"))


def _joined(rows: DataFrame, key: str, order: str, text, between: str) -> DataFrame:
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text.alias("__x")))), lambda x: x["__x"]), between).alias("text"))


def _listed(rows: DataFrame, key: str, order: str, text) -> DataFrame:
    return _joined(rows, key, order, text, "\n").withColumn("text", F.concat(F.lit("<listBibl>\n"), "text", F.lit("\n</listBibl>")))


def zone_file(marked: DataFrame, key: str = "doc_key") -> DataFrame:
    """key and text: a document's lines in order, those of the reference zone in a list."""
    ends = marked.where("zone = 'listBibl'").groupBy(key).agg(F.min("i").alias("__a"), F.max("i").alias("__b"))
    line = F.concat(F.when(F.col("i") == F.col("__a"), "<listBibl>").otherwise(""), tei.escape(F.col("line")), F.when(F.col("i") == F.col("__b"), "</listBibl>").otherwise(""))
    return _joined(marked.join(ends, key, "left"), key, "i", F.coalesce(line, tei.escape(F.col("line"))), "<lb/>\n").withColumn("text", F.concat(F.lit("<text>"), "text", F.lit("</text>")))


def line_file(marked: DataFrame, key: str = "doc_key") -> DataFrame:
    """key and text: the lines of each reference, in the order of the references."""
    groups = ln.group_lines(marked.where("j is not null").withColumn("line", tei.escape(F.col("line"))), [key, "j"], "i", "line", "<lb/>")
    return _listed(groups, key, "j", F.concat(F.lit("<bibl>"), "text", F.lit("</bibl>")))


def field_file(tagged: DataFrame, key: str = "doc_key") -> DataFrame:
    """key and text: each reference with its fields tagged."""
    return _listed(tagged, key, "j", F.concat(F.lit("<bibl>"), "tagged", F.lit("</bibl>")))


def name_file(tagged: DataFrame, key: str = "doc_key") -> DataFrame:
    """key and text: the names of each reference that has any."""
    names = F.array_join(F.regexp_extract_all("tagged", F.lit("(<author>.*?</author>)"), 1), "")
    return _listed(tagged.withColumn("__n", names).where("__n <> ''"), key, "j", F.col("__n"))


#: What each model is trained on.
MODELS = {"zone": zone_file, "lines": line_file, "fields": field_file, "names": name_file}


def training_file(model: str, rows: DataFrame, key: str = "doc_key") -> DataFrame:
    """key and text of the training file of each document for a model."""
    if model not in MODELS:
        raise ValueError(f"models are {', '.join(MODELS)}")
    return MODELS[model](rows, key)
