"""References in XML documents: reading, shredding, enriching and writing."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.functions import text as tx
from refloom.functions.layout import spread

# Where a reference's values stand, and the search field that each feeds.
FIELDS = {
    'analytic/title[@level="a"]': "title",
    'analytic/title[@level="a"][@type="main"]': "title",
    'monogr/title[@level="m"][@type="main"]': "title",
    'monogr/imprint/date[@type="published"]/@when': "publicationDate",
    "monogr/imprint/date": "publicationDate",
    'monogr/imprint/date[@type="year"]': "publicationDate",
    'monogr/imprint/biblScope[@unit="volume"]': "host.volume",
    'monogr/imprint/biblScope[@unit="vol"]': "host.volume",
    'monogr/imprint/biblScope[@unit="issue"]': "host.issue",
    'monogr/imprint/biblScope[@unit="page"]/@to': "host.pages.last",
    'monogr/imprint/biblScope[@unit="page"]/@from': "host.pages.first",
    'monogr/imprint/biblScope[@unit="pp"]/@to': "host.pages.last",
    'monogr/imprint/biblScope[@unit="pp"]/@from': "host.pages.first",
    "analytic/author/persName/surname": "author.name",
    'analytic/author/persName/forename[@type="first"]': "__IGNORE__",
    'analytic/author/persName/forename[@type="middle"]': "__IGNORE__",
    'monogr/title[@level="m"]': "host.title",
    'monogr/title[@level="j"]': "host.title",
    "monogr/author/persName/surname": "host.author.name",
    'monogr/author/persName/forename[@type="first"]': "__IGNORE__",
    'monogr/author/persName/forename[@type="middle"]': "__IGNORE__",
    "monogr/meeting": "host.conference.name",
    "monogr/editor": "host.editor",
    "monogr/imprint/publisher": "host.editor",
    "monogr/imprint/pubPlace": "__IGNORE__",
    "note": "_NULL_",
    "monogr/meeting/address/addrLine": "_NULL_",
}
UNKNOWN_FIELD = "_CHAMP_INCONNU_"
NUMERIC = ("publicationDate", "host.volume", "host.issue", "host.pages.first", "host.pages.last")
_BIB = r"(?s)(<biblStruct\b[^>]*/>|<biblStruct\b.*?</biblStruct>)"


def read_documents(spark: SparkSession, path: str, glob: str = "*.tei.xml") -> DataFrame:
    """doc_key, path and xml of each file, doctype removed."""
    raw = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    where = F.input_file_name()
    return raw.select(tx.doc_key(where, glob.lstrip("*")).alias("doc_key"), where.alias("path"), strip_doctype(F.col("value")).alias("xml"))


def strip_doctype(xml: Column) -> Column:
    """Without the document type, which the xpath functions would try to load."""
    return F.regexp_replace(xml, r"(?s)<!DOCTYPE[^\[>]*(?:\[.*?\]\s*)?>", "")


def document_id(path: Column, required: bool = False) -> Column:
    """First run of 40 upper-case hex digits; null if there is none, or an error where it is required."""
    found = F.nullif(F.regexp_extract(path, "[0-9A-F]{40}", 0), F.lit(""))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no document id in "), path)).cast("string")) if required else found


def listed(docs: DataFrame, names: DataFrame, name: str = "value") -> DataFrame:
    """Those of docs whose key a list names, one a line."""
    return docs.join(names.select(F.trim(name).alias("doc_key")).where("doc_key <> ''").distinct(), "doc_key", "left_semi")


def doctype_counts(docs: DataFrame) -> DataFrame:
    """One row: documents that are missing, that aren't UTF-8 (with the mark of undecodable bytes), without a DOCTYPE, and all."""
    n = lambda test: F.count(F.when(test, 1))
    xml = F.col("xml")
    return docs.agg(n(xml.isNull()).alias("missing"), n(xml.contains("\ufffd")).alias("undecodable"), n(xml.isNotNull() & ~xml.contains("<!DOCTYPE")).alias("no_doctype"), F.count("*").alias("docs"))


def parsed(docs: DataFrame) -> DataFrame:
    """docs with whether the xml is well-formed, told by a permissive parser that doesn't fail the task."""
    root = F.from_xml("xml", "_corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true"})
    return docs.withColumn("well_formed", F.col("xml").isNotNull() & root["_corrupt_record"].isNull())


def references(docs: DataFrame, wide: bool = False) -> DataFrame:
    """doc_key, n, bib_id and bib (XML) of each reference: those of the back's lists, or where there are none of the whole back.

    References without an id are named NO_ID-1, ... in their document's order.
    With wide, references anywhere in a list count where they are more.
    """
    back = F.regexp_extract("xml", r"(?s)<back\b.*</back>", 0)
    every = lambda x: F.regexp_extract_all(x, F.lit(_BIB), 1)
    lists = F.flatten(F.transform(F.regexp_extract_all(back, F.lit(r"(?s)(<listBibl\b.*?</listBibl>)"), 1), every))
    strict = F.when(F.size(lists) > 0, lists).otherwise(every(back))
    if wide:
        anywhere = F.flatten(F.transform(F.regexp_extract_all("xml", F.lit(r"(?s)(<listBibl\b.*?</listBibl>)"), 1), every))
        strict = F.when(F.size(anywhere) > F.size(strict), anywhere).otherwise(strict)
    rows = docs.select("doc_key", F.posexplode(strict).alias("n", "bib"))
    own = F.nullif(F.regexp_extract("bib", r'^<biblStruct\b[^>]*\bxml:id="([^"]*)"', 1), F.lit(""))
    rows = rows.withColumn("__id", own)
    k = F.count(F.when(F.col("__id").isNull(), 1)).over(W.partitionBy("doc_key").orderBy("n").rowsBetween(W.unboundedPreceding, 0))
    return rows.select("doc_key", "n", F.coalesce("__id", F.concat(F.lit("NO_ID-"), k)).alias("bib_id"), "bib")


def references_anywhere(docs: DataFrame) -> DataFrame:
    """doc_key and how many structured references its lists have, wherever these stand."""
    lists = F.array_join(F.regexp_extract_all("xml", F.lit(r"(?s)(<listBibl\b.*?</listBibl>)"), 1), "")
    return docs.select("doc_key", F.regexp_count(lists, F.lit(r"<biblStruct[\s>/]")).alias("n_anywhere"))


def unstructured_count(docs: DataFrame) -> DataFrame:
    """doc_key and how many semi-structured bibl elements its lists have."""
    lists = F.array_join(F.regexp_extract_all("xml", F.lit(r"(?s)(<listBibl\b.*?</listBibl>)"), 1), "")
    return docs.select("doc_key", F.regexp_count(lists, F.lit(r"<bibl[\s>]")).alias("n_bibl"))


#: Attributes that tell elements of one name apart in paths.
TELLING = ("type", "level", "unit")
ROOT = "biblStruct"


def element_path(names: list[str]) -> str:
    """The path of an element from the names, with attributes, of those it stands in and its own; . for the reference itself."""
    return "/".join(names) or "."


def _named(element) -> str:
    """Local name with the telling attributes, in their order."""
    return element.tag.rpartition("}")[2] + "".join(f'[@{k}="{v}"]' for k, v in element.attrib.items() if k in TELLING)


def _own_values(element, path: str) -> list[tuple[str, str, int]]:
    """(path, text, how often it is cleaned) of what an element itself says."""
    name, text = element.tag.rpartition("}")[2], element.text
    if name == "date":
        return [(f"{path}/@when", element.get("when"), 1)] if element.get("when") is not None else [(path, text, 2)] if text else []
    if name == "biblScope" and element.get("unit") == "page":
        return [(f"{path}/@from", text, 1)] if text else [(f"{path}/@{end}", element.get(end), 1) for end in ("from", "to") if element.get(end)]
    return [(path, text, 1)] if text and re.search(r"\w", text) else []


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each value of each element, in document order; none for references that can't be parsed."""
    kinds = (pa.int32(), pa.string(), pa.string(), pa.int32())
    for batch in batches:
        at, rows = [], []
        for place, bib in enumerate(batch["bib"].to_pylist()):
            try:
                root = ET.fromstring(bib or "")
            except ET.ParseError:
                continue
            seq, open_ = 0, [(root, [])]
            while open_:
                element, names = open_.pop()
                for path, text, times in _own_values(element, element_path(names)):
                    at.append(place)
                    rows.append((seq, path, text, times))
                    seq += 1
                open_ += [(x, [*names, _named(x)]) for x in reversed(element) if isinstance(x.tag, str)]
        kept = [batch[c].take(pa.array(at, pa.int64())) for c in ("doc_key", "bib_id")]
        yield pa.record_batch([*kept, *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names=["doc_key", "bib_id", "seq", "path", "raw", "times"])


def subvalues(bibs: DataFrame, every: bool = False) -> DataFrame:
    """doc_key, bib_id, seq, path, field and value of each value of all elements; ignored fields dropped.

    A date's @when is its value, or else its text, which is cleaned twice; a page
    scope's text is its first page, or else its attributes are. Paths that feed no
    field have the field UNKNOWN_FIELD; they are dropped but with every. Elements
    stand in any depth, which column functions can't follow, so each reference is
    parsed once, in Arrow batches.
    """
    kinds = {f.name: f.dataType.simpleString() for f in bibs.schema}
    rows = spread(bibs, "doc_key", "bib_id").select("doc_key", "bib_id", "bib").mapInArrow(_walk, f"doc_key {kinds['doc_key']}, bib_id {kinds['bib_id']}, seq int, path string, raw string, times int")
    once = tx.query_fragment(F.col("raw"))
    rows = rows.withColumn("value", F.when(F.col("times") == 2, tx.query_fragment(once)).otherwise(once)).where("value <> ''").drop("raw", "times")
    rows = translate_paths(rows).where(F.col("field") != "__IGNORE__").withColumn("k", F.lit(0))
    return rows if every else rows.where(F.col("field") != UNKNOWN_FIELD)


def simple_path(path: Column) -> Column:
    """A path without attributes and namespaces."""
    return F.regexp_replace(F.regexp_replace(path, r"\[@[^\]]*\]|/@.*$", ""), r"(^|/)[^/:]*:", "$1")


def dates_without_when(rows: DataFrame) -> DataFrame:
    """doc_key, bib_id and path of the dates that have a text but no @when."""
    return rows.where(F.col("path").rlike(r"(^|/)date[^/]*$")).select("doc_key", "bib_id", "path")


def unknown_paths(rows: DataFrame) -> DataFrame:
    """Paths that feed no field, and how often they occur: what a warning would say of each."""
    return rows.where(F.col("field") == UNKNOWN_FIELD).groupBy("path").agg(F.count("*").alias("n"))


def without_tokens(rows: DataFrame) -> DataFrame:
    """doc_key, bib_id and no_token of each reference with values: whether the filter of tokens left none."""
    kept = F.sum(F.size(tokens(F.col("field"), F.col("value"))))
    return rows.groupBy("doc_key", "bib_id").agg((kept == 0).alias("no_token"))


def translate_paths(rows: DataFrame, path: str = "path") -> DataFrame:
    """rows with the field of each path; unknown paths have a field of their own."""
    table = F.create_map(*[F.lit(x) for kv in FIELDS.items() for x in kv])
    return rows.withColumn("field", F.coalesce(table[F.col(path)], F.lit(UNKNOWN_FIELD)))


def field_map(rows: DataFrame) -> DataFrame:
    """doc_key, bib_id and a map of field to values in document order."""
    per = rows.groupBy("doc_key", "bib_id", "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "k", "value"))), lambda x: x["value"]).alias("values"))
    return per.groupBy("doc_key", "bib_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "values")))).alias("fields"))


def tokens(field: Column, value: Column) -> Column:
    """Tokens of a value for a query: the first digits of numeric fields, two characters or j, J or ] for names and journals, four for others."""
    every = F.filter(F.split(value, r"(?U)[^\w?*]+"), lambda t: t != "")
    number = F.filter(F.transform(every, lambda t: F.regexp_extract(t, "[0-9]+", 0)), lambda t: t != "")
    short = F.filter(every, lambda t: (F.length(t) >= 2) | t.isin("j", "J", "]"))
    return F.when(field.isin(*NUMERIC), number).when(field.isin("host.title", "author.name"), short).otherwise(F.filter(every, lambda t: F.length(t) >= 4))


def linkable(bibs: DataFrame, longest: int = 300) -> DataFrame:
    """References with an analytic part and without an over-long title."""
    titles = F.xpath("bib", F.lit('/biblStruct/analytic/title[@level="a"]/text()'))
    return bibs.where(F.col("bib").rlike(r"<analytic[\s/>]") & (F.coalesce(F.length(F.try_element_at(titles, F.lit(-1))), F.lit(0)) <= longest))


_READ = ("tit", "date", "j", "vol", "iss", "fpg", "lpg", "psher")


def _first(found: list) -> str | None:
    """What XPath says of the first of the nodes, attributes being strings; null for none and for an empty one."""
    return (found[0] if isinstance(found[0], str) else "".join(found[0].itertext())) or None if found else None


def _read(bib: str | None) -> tuple | None:
    """Compared fields and names of a reference, or null where only XPath can tell: other than elements, attributes and texts, namespaces, and what isn't well-formed."""
    if not bib or "<!" in bib or "<?" in bib or "xmlns" in bib:
        return None
    try:
        root = ET.fromstring(bib)
    except ET.ParseError:
        return None
    parts = lambda name, of: [x for y in of if y.tag == name for x in y]
    named = [root] if root.tag == ROOT else []
    inner = [x for r in named for x in r]
    analytic, monogr = [x for x in parts("analytic", inner) if x.tag == "title"], parts("monogr", inner)
    imprint, titles = parts("imprint", monogr), [x for x in monogr if x.tag == "title"]
    scopes = [x for x in imprint if x.tag == "biblScope"]
    level = lambda of, v: _first([x for x in of if x.get("level") == v])
    unit = lambda *vs: next((v for u in vs if (v := _first([x for x in scopes if x.get("unit") == u]))), None)
    page = lambda end: next((v for u in ("page", "pp") if (v := _first([x.get(end) for x in scopes if x.get("unit") == u and end in x.keys()]))), None)
    date = _first([x.get("when") for x in imprint if x.tag == "date" and "when" in x.keys()])
    names = []
    for x in root.iter("surname"):
        if len(x):
            if any(y is not x for y in x.iter("surname")):
                return None
            names += [t for t in (x.text, *(y.tail for y in x)) if t]
        elif x.text:
            names.append(x.text)
    return (
        level(analytic, "a") or _first(analytic) or level(titles, "m"), date[:4] if date else None, level(titles, "j"), unit("vol", "volume"), unit("issue", "iss"), page("from"), page("to"),
        _first([x for x in imprint if x.tag == "publisher"]), names,
    )


def _read_all(bibs: pa.Array) -> pa.Array:
    """_read of each, null for null; for an Arrow UDF."""
    rows = [_read(x) for x in bibs.to_pylist()]
    kinds = [pa.string()] * len(_READ) + [pa.list_(pa.string())]
    columns = [pa.array([r and r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.StructArray.from_arrays([*columns, pa.array([r is not None for r in rows])], names=[*_READ, "names", "plain"])


def canonical_fields(bibs: DataFrame) -> DataFrame:
    """The eight compared fields and the names of each reference; volume, pages and dates where either spelling has them.

    Each reference is parsed once, in Arrow batches; XPath, which parses it for every
    path, is left for those with comments, namespaces and the like.
    """
    one = lambda *paths: F.coalesce(*[F.nullif(F.xpath_string("bib", F.lit(f"/biblStruct/{p}")), F.lit("")) for p in paths])
    unit = lambda u: f'monogr/imprint/biblScope[@unit="{u}"]'
    paths = {
        "tit": one('analytic/title[@level="a"]', "analytic/title", 'monogr/title[@level="m"]'), "date": F.substring(one("monogr/imprint/date/@when"), 1, 4), "j": one('monogr/title[@level="j"]'),
        "vol": one(unit("vol"), unit("volume")), "iss": one(unit("issue"), unit("iss")), "fpg": one(unit("page") + "/@from", unit("pp") + "/@from"), "lpg": one(unit("page") + "/@to", unit("pp") + "/@to"),
        "psher": one("monogr/imprint/publisher"), "names": F.xpath("bib", F.lit("//surname/text()")),
    }
    read = F.arrow_udf(_read_all, ", ".join(f"{f} string" for f in _READ) + ", names array<string>, plain boolean")
    rows = spread(bibs, "doc_key", "bib_id").withColumn("__read", read("bib"))
    told = lambda f: F.when(F.col("__read.plain"), F.col(f"__read.{f}")).otherwise(paths[f])
    return rows.withColumns({f: told(f) for f in paths} | {"has_analytic": F.col("bib").rlike(r"<analytic[\s/>]")}).drop("__read")


def root_path(xml: Column) -> Column:
    """The names of the root and of its first child, by /."""
    names = F.regexp_extract_all(F.regexp_replace(xml, r"(?s)<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>", ""), F.lit(r"<([A-Za-z][\w.+:-]*)"), 1)
    return F.array_join(F.slice(names, 1, 2), "/")


def enrich(docs: DataFrame, links: DataFrame, base_url: str, kind: str = "catalogue-url") -> DataFrame:
    """docs whose linked references end in a ref element with the target's address; one row a document, links grouped first."""
    by = links.where("target is not null").groupBy("doc_key").agg(F.map_from_entries(F.collect_list(F.struct("bib_id", "target"))).alias("__to"))
    joined = docs.join(by, "doc_key", "left")
    pieces = F.split("xml", "(?<=</biblStruct>)")
    mark = lambda x: F.element_at("__to", F.regexp_extract(x, r'<biblStruct\b[^>]*\bxml:id="([^"]*)"[^>]*>(?!(?s:.*)<biblStruct\b)', 1))
    put = lambda x: F.when(mark(x).isNotNull(), F.regexp_replace(x, F.lit("</biblStruct>$"), F.concat(F.lit(f'<ref type="{kind}">{base_url}'), mark(x), F.lit("</ref></biblStruct>")))).otherwise(x)
    return joined.withColumn("xml", F.when(F.col("__to").isNotNull(), F.array_join(F.transform(pieces, put), "")).otherwise(F.col("xml"))).drop("__to")


def link_table(bibs: DataFrame, links: DataFrame) -> DataFrame:
    """source_id, bib_id and target of every reference, None where there is no match."""
    return bibs.join(links, ["doc_key", "bib_id"], "left").select(F.col("doc_key").alias("source_id"), "bib_id", F.coalesce("target", F.lit("None")).alias("target"))


def grouped_corpus(ids: DataFrame, docs: DataFrame, empty: str = "<TEI/>") -> DataFrame:
    """One row for each id, in order, with its document or a placeholder."""
    return ids.join(docs, ids["id"] == docs["doc_key"], "left").select("id", F.coalesce("xml", F.lit(empty)).alias("xml")).orderBy("id")


def simplified(xml: Column) -> Column:
    """A document with an empty header, and collapsed if its text is empty."""
    return F.regexp_replace(F.regexp_replace(xml, r"(?s)<teiHeader\b.*?</teiHeader>", "<teiHeader/>"), r"(?s)<text\b[^>]*>\s*(?:<back\b[^>]*>\s*(?:<div\b[^>]*>\s*<listBibl\s*/>\s*</div>\s*)?</back>\s*)?</text>", "<text/>")


def raw_text(xml: Column, region: str | None = None) -> Column:
    """The text between tags, the five entities decoded; with region only what stands between that element's first start tag and its last end tag."""
    if region:
        xml = F.regexp_extract(xml, rf"(?s)<{region}\b[^>]*>(.*)</{region}>", 1)
    out = F.regexp_replace(xml, "<[^>]+>", "")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def escape(value: Column) -> Column:
    out = value
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def resolution_log(links: DataFrame) -> DataFrame:
    """One JSON array of its references' records for each document, in order."""
    cols = sorted(c for c in links.columns if c != "doc_key")
    return links.groupBy("doc_key").agg(F.to_json(F.array_sort(F.collect_list(F.struct("bib_id", *[c for c in cols if c != "bib_id"])))).alias("log"))


def glance(author: Column, date: Column) -> Column:
    """(Autho-YYYY), with _ for what is missing."""
    return F.concat(F.lit("("), F.coalesce(F.substring(author, 1, 5), F.lit("_")), F.lit("-"), F.coalesce(F.substring(date, 1, 4), F.lit("_")), F.lit(")"))


def label(n: Column, bib_id: Column) -> Column:
    """A reference's printed number: @n's digits, else those at the end of its id; none without an id."""
    return F.when(bib_id.isNotNull(), F.coalesce(F.nullif(F.regexp_extract(n, "[0-9]+", 0), F.lit("")), F.nullif(F.regexp_extract(bib_id, "[0-9]+$", 0), F.lit("")))).cast("int")
