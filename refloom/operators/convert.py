"""Publisher XML to one schema: which publisher a document is from, and a table of rules for each kind of reference.

What an element becomes depends on what stands beside it and on nested hosts, which
column functions can't follow; so each reference is parsed once, in Arrow batches,
and the rules are data.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each dialect's reference elements, and the element that may hold several of them.
CONTAINERS = {"nlm": ("ref",), "elsevier": ("ce:bib-reference",), "springer": ("BibArticle", "BibChapter", "BibBook", "BibUnstructured"), "iop": ("journal-ref", "book-ref", "conf-ref", "misc-ref"), "nature": ("bib",), "wiley": ("citation",)}
#: Dialects whose dates are given as text only, which evaluation doesn't compare.
TEXT_DATES = frozenset(("nlm", "iop", "nature", "wiley"))
#: The dialect of each publisher's references.
DIALECT_OF = {"bmj": "nlm", "scholarone": "nlm", "nlm": "nlm", "nlm2": "nlm", "sage": "nlm", "rsc": "nlm", "elsevier": "elsevier", "springer2": "springer", "springer3": "springer", "springer-chapter": "springer", "nature": "nature", "wiley": "wiley", "iop": "iop"}

ONE = ("tit", "m", "j", "s", "date", "vol", "iss", "fpg", "lpg", "pages", "psher")
MANY = ("names", "ids")


@dataclass(frozen=True)
class Rule:
    """References for which every path of has finds something, and none of lacks does, get the type and, by target, what the first path that finds something finds; titles move by what else there is."""

    type: str | None
    targets: dict[str, tuple[str, ...]]
    has: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    analytic: bool = True
    #: Type by what is found, before the rule's own.
    types: tuple[tuple[str, str], ...] = field(default=())


_NLM = {"names": (".//surname",), "j": ("./*/source",), "date": ("./*/year",), "ids": (".//pub-id",)}
_PAGED = {"vol": ("./*/volume", "./*/volumeno"), "iss": ("./*/issue",), "fpg": (".//fpage",), "lpg": (".//lpage",)}
_HOST = "./reference/host"
_ELSEVIER = {"names": ("./reference/contribution//surname",), "fpg": (f"{_HOST}/pages/first-page",), "lpg": (f"{_HOST}/pages/last-page",)}
_SPRINGER = {"names": ("./BibAuthorName/FamilyName",), "date": ("./Year",)}
_SPRINGER_PAGED = {"j": ("./JournalTitle",), "vol": ("./VolumeID",), "iss": ("./IssueID",), "fpg": ("./FirstPage",), "lpg": ("./LastPage",)}
_IOP = {"names": ("./authors//second-name",), "date": ("./year",), "vol": ("./volume",), "pages": ("./pages",), "psher": ("./publication/publisher",), "ids": ("./crossref/cr_doi", "./misc-text/extdoi", "./art-number")}
_WILEY = {"names": (".//familyName",), "date": (".//pubYear",), "vol": (".//vol",), "iss": (".//issue",), "fpg": (".//pageFirst",), "lpg": (".//pageLast",), "psher": (".//publisherName",), "ids": (".//accessionId",)}


def _hosted(host: str) -> tuple[Rule, ...]:
    """Elsevier's books: without a title of the host the contribution's is the book's; a series' title is the book's where no other is."""
    own, series = (f"{_HOST}/title", f"{_HOST}/{host}/title"), f"{_HOST}/{host}/book-series/series/title"
    rest = _ELSEVIER | {"date": (f"{_HOST}/{host}/date",), "psher": (f"{_HOST}/{host}/publisher/name",)}
    here, a = f"{_HOST}/{host}", ("./reference/contribution/title",)
    return (
        Rule("book", rest | {"m": a}, has=(here,), lacks=(f"{_HOST}//title",)),
        Rule("book", rest | {"tit": a, "m": (series,)}, has=(here, series), lacks=own),
        Rule("book", rest | {"tit": a, "m": own, "s": (series,)}, has=(here,)),
    )


#: Rules by dialect and reference element; the first that fits counts, and where none does the reference is unstructured.
RULES: dict[str, dict[str, tuple[Rule, ...]]] = {
    "nlm": {"ref": (
        *(Rule("article", _NLM | _PAGED | {"tit": ("./*/article-title", "./*/art_title"), "j": ("./*/source", "./*/title")}, has=(f"./*[@{kind}='journal']",)) for kind in ("citation-type", "publication-type")),
        *(Rule("inproceedings", _NLM | _PAGED | {"tit": ("./*/article-title",)}, has=(f"./*[@{kind}='confproc']",)) for kind in ("citation-type", "publication-type")),
        *(Rule("book", _NLM | {"psher": ("./*/publisher-name",)}, has=(f"./*[@{kind}='book']",), analytic=False) for kind in ("citation-type", "publication-type")),
    )},
    "elsevier": {"bib-reference": (
        Rule("article", _ELSEVIER | {"tit": ("./reference/contribution/title",), "j": (f"{_HOST}/issue/series/title",), "date": (f"{_HOST}/issue/date",), "vol": (f"{_HOST}/issue/series/volume-nr",), "iss": (f"{_HOST}/issue/issue-nr",)}, has=(f"{_HOST}/issue",), lacks=("./other-ref",)),
        *_hosted("edited-book"), *_hosted("book"),
    )},
    "springer": {
        "BibArticle": (Rule("article", _SPRINGER | _SPRINGER_PAGED | {"tit": ("./ArticleTitle",)}),),
        "BibChapter": (Rule("inBook", _SPRINGER | _SPRINGER_PAGED | {"tit": ("./ChapterTitle",)}),),
        "BibBook": (Rule("book", _SPRINGER | {"m": ("./BookTitle",), "psher": ("./PublisherName",)}, analytic=False),),
    },
    "iop": {
        "journal-ref": (Rule("article", _IOP | {"tit": ("./art-title",), "j": ("./jnl-title",), "iss": ("./issno",)}),),
        "book-ref": (Rule("book", _IOP | {"tit": ("./art-title",), "m": ("./book-title",)}, has=("./art-title",)), Rule("book", _IOP | {"m": ("./book-title",)}, analytic=False)),
        "conf-ref": (Rule("conf", _IOP | {"tit": ("./art-title",), "m": ("./conf-title",)}),),
        "misc-ref": tuple(
            Rule("misc", _IOP | {"m": ("./misc-title",)} | ({"tit": ("./art-title",)} if chapter else {}), has=chapter, analytic=bool(chapter), types=(("./thesis", "thesis"), ("./patent-number", "patent"), ("./misc-text^PAT", "patent"), (".//*~Report", "report")))
            for chapter in (("./art-title",), ())
        ),
    },
    "nature": {"bib": (Rule(None, {"names": (".//snm",), "tit": ("./atl",), "m": ("./btl",), "j": ("./jtl",), "date": ("./cd",), "vol": ("./vid",), "iss": ("./iid",), "fpg": (".//ppf",), "lpg": (".//ppl",), "ids": (".//refdoi",)}),)},
    "wiley": {"citation": (
        Rule("article", _WILEY | {"tit": (".//articleTitle", ".//chapterTitle"), "j": (".//journalTitle",), "m": (".//bookTitle",)}, has=(".//articleTitle",)),
        Rule("inBook", _WILEY | {"tit": (".//chapterTitle",), "m": (".//bookTitle",)}, has=(".//chapterTitle",)),
        Rule("book", _WILEY | {"m": (".//bookTitle",)}, has=(".//bookTitle",), analytic=False),
        Rule("misc", _WILEY | {"j": (".//journalTitle",)}, has=(".//journalTitle",)),
    )},
}


def publisher(xml: Column) -> Column:
    """The publisher, and its format, that a document's root and marks tell; unidentified if none does. The first of the branches that fits counts."""
    bare = F.regexp_replace(xml, r"(?s)<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^\[>]*(?:\[.*?\]\s*)?>", "")
    root = F.regexp_extract(bare, r"<(?:[\w.-]+:)?([A-Za-z][\w.-]*)", 1)
    has = lambda name: bare.rlike(rf"<(?:[\w.-]+:)?{name}[\s/>]")
    says = lambda name, what: bare.rlike(rf"(?s)<{name}[^>]*>[^<]*(?:{what})")
    starts = lambda name, what: bare.rlike(rf"<{name}[^>]*>(?:{what})")
    chapters = F.regexp_count(bare, F.lit(r"<Chapter[\s>]"))
    book = has("Series") & has("Book") & (chapters > 0)
    branches = [
        (root == "metadata", "bmj"), (root == "article_set", "scholarone"), ((root == "article") & has("front"), "nlm"), (root.isin("article", "converted-article") & has("item-info"), "elsevier"), (root == "nihms-submit", "nihms"), (root == "ArticleSet", "nlm2"), (root == "SAGEmeta", "sage"), (root == "EDPSArticle", "edps"), (root == "edp-article", "edps-backfile"),
        ((root == "Article") & has("ArticleInfo"), "springer2"), ((root == "Publisher") & has("PublisherInfo") & ~book, "springer3"), ((root == "Publisher") & book & (chapters == 1), "springer-chapter"), ((root == "article") & has("art-admin"), "rsc"), (root.isin("article", "headerx") & has("pubfm") & starts("cpn", "Nature|Macmillan"), "nature"),
        ((root == "component") & bare.rlike(r"""<(?:[\w.-]+:)?component\b[^>]*\btype=["']serialArticle["']"""), "wiley"), ((root == "article") & has("article-metadata") & (says("copyright", "IOP") | says("jnl-imprint", "IOP|Institute of Physics")) & bare.rlike(r"""<article-type\b[^>]*\bsort=["']regular["']"""), "iop"),
    ]
    out = F.lit("unidentified")
    for test, name in reversed(branches):
        out = F.when(F.coalesce(test, F.lit(False)), name).otherwise(out)
    return out


def with_dialect(docs: DataFrame) -> DataFrame:
    """docs with their publisher and the dialect of its references, null where there are no rules for it."""
    table = F.create_map(*[F.lit(x) for kv in DIALECT_OF.items() for x in kv])
    return docs.withColumn("publisher", publisher(F.col("xml"))).withColumn("dialect", table[F.col("publisher")])


def references(docs: DataFrame, dialect: str) -> DataFrame:
    """doc_key, n and bib (XML) of each reference of one dialect, however lists are nested."""
    names = "|".join(CONTAINERS[dialect])
    found = F.regexp_extract_all("xml", F.lit(rf"(?s)(<({names})(?=[\s>])[^>]*(?<!/)>.*?</\2>)"), 1)
    return docs.select("doc_key", F.posexplode(found).alias("n", "bib"))


def _text(element) -> str:
    return " ".join("".join(element.itertext()).split())


def _finds(root, path: str) -> bool:
    """Whether a path finds something; path^start and path~part ask what its text starts with or holds."""
    for sign, test in (("^", str.startswith), ("~", str.__contains__)):
        if sign in path:
            path, _, what = path.partition(sign)
            return any(test(_text(x), what) for x in root.iterfind(path))
    return root.find(path) is not None


def convert_one(dialect: str, bib: str) -> dict | None:
    """The reference by the rules; None if it isn't XML. An unstructured one has its text only."""
    plain = re.sub(r"(</?)[\w.-]+:", r"\1", bib)
    try:
        root = ET.fromstring(re.sub(r"\s[\w.-]+:([\w.-]+=)", r" \1", plain))
    except ET.ParseError:
        return None
    out = {"label": next((_text(x) for p in ("label", "CitationNumber") for x in root.iterfind(f"./{p}")), None) or root.get("num"), "names": [], "ids": []}
    for rule in RULES[dialect].get(root.tag, ()):
        if all(_finds(root, p) for p in rule.has) and not any(_finds(root, p) for p in rule.lacks):
            for target, paths in rule.targets.items():
                every = ([t for x in root.iterfind(p) if (t := _text(x))] for p in paths)
                if target in MANY:
                    out[target] = [t for ts in every for t in ts]
                else:
                    out[target] = next((ts[0] for ts in every if ts), None)
            kind = next((name for path, name in rule.types if _finds(root, path)), rule.type)
            return out | {"type": kind, "structured": True, "has_analytic": rule.analytic}
    return out | {"structured": False, "text": _text(root)}


_SCHEMA = {"doc_key": None, "n": pa.int32(), "label": pa.string(), "type": pa.string(), "structured": pa.bool_(), "has_analytic": pa.bool_(), "text": pa.string()} | {c: pa.string() for c in ONE} | {c: pa.list_(pa.string()) for c in MANY}
_DDL = "n int, label string, type string, structured boolean, has_analytic boolean, text string, " + ", ".join(f"{c} string" for c in ONE) + ", " + ", ".join(f"{c} array<string>" for c in MANY)


def _rules_of(dialect: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [convert_one(dialect, x or "") for x in batch["bib"].to_pylist()]
            kept = [k for k, x in enumerate(found) if x is not None]
            part = batch.take(pa.array(kept, pa.int64()))
            rows = [found[k] for k in kept]
            yield pa.record_batch([part["doc_key"], part["n"].cast(pa.int32()), *(pa.array([r.get(c) for r in rows], kind) for c, kind in list(_SCHEMA.items())[2:])], names=list(_SCHEMA))

    return run


def convert(docs: DataFrame) -> DataFrame:
    """One schema for documents with a dialect column: doc_key, n, dialect, label, type, structured, has_analytic, text, the titles tit (article), m (book), j (journal) and s (series), the other compared fields, names, ids and when; what was absent is null.

    A reference that isn't XML gives no row; one that no rule fits is unstructured and
    has its text. when is the date where the dialect gives it as a value.
    """
    key = dict(docs.dtypes)["doc_key"]
    out = None
    for dialect in RULES:
        rows = references(docs.where(F.col("dialect") == dialect), dialect).mapInArrow(_rules_of(dialect), f"doc_key {key}, {_DDL}").withColumn("dialect", F.lit(dialect))
        rows = rows.withColumn("when", F.lit(None).cast("string") if dialect in TEXT_DATES else F.substring("date", 1, 4))
        out = rows if out is None else out.unionByName(rows)
    return out


def conversion_counts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """For each publisher: documents, those without rules, and references, unstructured ones among them."""
    by = rows.groupBy("doc_key").agg(F.count("*").alias("refs"), F.count(F.when(~F.col("structured"), 1)).alias("unstructured"))
    joined = docs.select("doc_key", "publisher", "dialect").join(by, "doc_key", "left").na.fill(0, ["refs", "unstructured"])
    return joined.groupBy("publisher").agg(F.count("*").alias("docs"), F.count(F.when(F.col("dialect").isNull(), 1)).alias("skipped"), F.sum("refs").alias("refs"), F.sum("unstructured").alias("unstructured"))


def to_tei(rows: DataFrame, flat: bool = False) -> DataFrame:
    """doc_key, n and bib: a biblStruct of each converted reference, or with flat a bibl for training; unstructured ones are a bibl of their text."""
    from refloom.sources.tei import escape

    tag = lambda name, attrs, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{name}{attrs}>"), escape(F.col(c)), F.lit(f"</{name}>"))).otherwise("")
    names = F.array_join(F.transform("names", lambda x: F.concat(F.lit("<author><persName><surname>"), escape(x), F.lit("</surname></persName></author>"))), "")
    title, book, journal, series = tag("title", ' level="a" type="main"', "tit"), tag("title", ' level="m"', "m"), tag("title", ' level="j"', "j"), tag("title", ' level="s"', "s")
    when = F.when(F.col("when").isNotNull(), F.concat(F.lit('<date type="published" when="'), escape(F.col("when")), F.lit('"/>'))).otherwise(tag("date", "", "date"))
    last = F.when(F.col("lpg").isNotNull(), F.concat(F.lit('" to="'), escape(F.col("lpg")))).otherwise("")
    pages = F.when(F.col("fpg").isNotNull(), F.concat(F.lit('<biblScope unit="page" from="'), escape(F.col("fpg")), last, F.lit('"/>'))).otherwise(tag("biblScope", ' unit="pp"', "pages"))
    imprint = F.concat(when, tag("publisher", "", "psher"), tag("biblScope", ' unit="vol"', "vol"), tag("biblScope", ' unit="issue"', "iss"), pages)
    loose = F.concat(F.lit("<bibl>"), escape(F.coalesce("text", F.lit(""))), F.lit("</bibl>"))
    if flat:
        whole = F.concat(F.lit("<bibl>"), names, title, book, journal, imprint, F.lit("</bibl>"))
        return rows.select("doc_key", "n", F.when(F.col("structured"), whole).otherwise(loose).alias("bib"))
    head = F.concat(F.lit('<biblStruct xml:id="b'), F.col("n"), F.lit('"'), F.when(F.col("type").isNotNull(), F.concat(F.lit(' type="'), F.col("type"), F.lit('"'))).otherwise(""), F.lit(">"))
    above = F.when(F.col("has_analytic"), F.concat(F.lit("<analytic>"), title, names, F.lit("</analytic><monogr>"))).otherwise(F.concat(F.lit("<monogr>"), names))
    tail = F.when(series != "", F.concat(F.lit("<series>"), series, F.lit("</series>"))).otherwise("")
    whole = F.concat(head, above, book, journal, F.lit("<imprint>"), imprint, F.lit("</imprint></monogr>"), tail, F.lit("</biblStruct>"))
    return rows.select("doc_key", "n", F.when(F.col("structured"), whole).otherwise(loose).alias("bib"))
