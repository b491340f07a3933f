"""Tabular and line sources, manifests, and hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = "___"
HIT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()), T.StructField("publicationDate", T.StringType()), T.StructField("corpusName", T.StringType()),
    T.StructField("doi", T.ArrayType(T.StringType())), T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("host", T.StructType([T.StructField("title", T.StringType()), T.StructField("issn", T.ArrayType(T.StringType())), T.StructField("volume", T.StringType()), T.StructField("pages", T.StructType([T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]))])),
    T.StructField("fulltext", T.ArrayType(T.StructType([T.StructField("extension", T.StringType()), T.StructField("uri", T.StringType())]))),
])


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, null: str | None = None) -> DataFrame:
    """A tab-separated table with a header, all strings, no quoting; columns give the schema without a look at the data."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "")
    reader = reader.option("nullValue", null) if null else reader
    return (reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])) if columns else reader).csv(path)


def write_table(df: DataFrame, path: str, null: str = NULL_TOKEN) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", null).option("emptyValue", "").csv(path)


# The form of an abbreviation's row, and of a document's id.
ABBREVIATION_ROW, ID_ROW = r"^[0-9]{4}-[0-9Xx]{4}\t[\w ]+$", "^[0-9A-F]{40}$"


def rejected(rows: DataFrame, pattern: str, value: str = "value") -> DataFrame:
    """bad and n: lines that aren't of the form, for a warning."""
    return rows.where(F.col(value).isNotNull() & ~F.col(value).rlike(pattern)).groupBy(F.col(value).alias("bad")).agg(F.count("*").alias("n"))


def abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """issn and key of each well-formed row (issn, tab, words); rejected tells the others."""
    rows = spark.read.text(path).where(F.col("value").rlike(ABBREVIATION_ROW))
    parts = F.split("value", "\t")
    return rows.select(parts[0].alias("issn"), F.lower(parts[1]).alias("key"))


def abbreviation_key(title: Column, trim: bool = True) -> Column:
    """A journal title as abbreviations have it; without trim a final point leaves a space, and so no match."""
    key = F.regexp_replace(F.lower(title), r"(?U)\W+", " ")
    return F.trim(key) if trim else key


def id_list(spark: SparkSession, path: str, pattern: str = ID_ROW, strict: bool = False) -> DataFrame:
    """Valid ids, one a line; with strict a line that isn't one is an error, else rejected tells them."""
    rows = spark.read.text(path).select(F.trim("value").alias("id"))
    if strict:
        return rows.withColumn("id", F.when(F.col("id").rlike(pattern), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("no id: "), "id")).cast("string")))
    return rows.where(F.col("id").rlike(pattern))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, i and line of each text file, form feeds being line ends."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return explode_lines(whole, "path", "value")


def explode_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, i and line, empty lines included."""
    return docs.select(key, F.posexplode(F.split(F.replace(F.col(text), F.lit("\f"), F.lit("\n")), "\n")).alias("i", "line"))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search hits from JSON lines; absent keys are null."""
    return spark.read.schema(HIT).json(path)


def has_pdf(files: str = "fulltext") -> Column:
    return F.coalesce(F.exists(files, lambda f: f["extension"] == "pdf"), F.lit(False))


def read_pool(spark: SparkSession, path: str) -> DataFrame:
    """combo and n of a stored pool {f: {combo: n}, ...}."""
    kind = "f map<string,bigint>, nr bigint, nd bigint, totd bigint"
    return spark.read.schema(kind).json(path, multiLine=True).select(F.explode("f").alias("combo", "n"))


def manifest(files: DataFrame, expected: DataFrame) -> DataFrame:
    """expected (corpus, shelf, basename) with path and whether it is there."""
    return expected.join(files, ["corpus", "shelf", "basename"], "left").withColumn("present", F.col("path").isNotNull())


def shelves_of_files(files: DataFrame, shelves: dict[str, tuple[str, str]]) -> DataFrame:
    """corpus, shelf, basename and path of each file that lies in a shelf's folder with its extension: a manifest made anew from a listing (path)."""
    parts = F.split("path", "/")
    name, folder, corpus = (F.element_at(parts, -k) for k in (1, 2, 3))
    out = None
    for shelf, (place, extension) in shelves.items():
        found = files.where((folder == place) & name.endswith(extension)).select(corpus.alias("corpus"), F.lit(shelf).alias("shelf"), F.substring(name, F.lit(1), F.length(name) - len(extension)).alias("basename"), "path")
        out = found if out is None else out.unionByName(found)
    return out


def overridden(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; where extra has a key, its row stands for base's."""
    return base.join(extra.select(*keys).distinct(), keys, "left_anti").select(*base.columns).unionByName(extra.select(*base.columns))


def write_corpus(manifest: DataFrame, infos: DataFrame, path: str) -> None:
    """What describes a corpus, as tables under path: infos, basenames, flags (which shelves are there) and map (where each file is)."""
    infos.write.mode("overwrite").parquet(f"{path}/infos")
    manifest.select("basename").distinct().write.mode("overwrite").parquet(f"{path}/basenames")
    manifest.groupBy("corpus", "shelf").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/flags")
    manifest.write.mode("overwrite").parquet(f"{path}/map")


def basename(corpus: str = "corpus", record: str = "record_id") -> Column:
    return F.concat_ws("-", F.col(corpus), F.col(record))


def first_corpus(files: DataFrame, key: str = "basename", position: str = "corpus_pos") -> DataFrame:
    """Of rows with one basename, that of the first corpus."""
    return files.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(position))).where("__n = 1").drop("__n")


def dataset_links(links: DataFrame) -> DataFrame:
    """links (basename, size; size null where there is no file) with why each is skipped: duplicate, absent, empty, or null if it is used."""
    n = F.row_number().over(W.partitionBy("basename").orderBy(F.col("size").isNull(), "size"))
    return links.withColumn("skip", F.when(n > 1, "duplicate").when(F.col("size").isNull(), "absent").when(F.col("size") == 0, "empty"))


def next_number(names: DataFrame, name: str = "name") -> DataFrame:
    """One more than the largest number that a name ends in."""
    return names.agg((F.coalesce(F.max(F.regexp_extract(name, "([0-9]+)$", 1).try_cast("int")), F.lit(0)) + 1).alias("next"))
