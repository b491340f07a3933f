"""Queries over small tables of cases; their SQL holds the rows to expect, written by hand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.functions import text as tx
from refloom.functions import values as vl
from refloom.operators import convert, linkage, metrics, projection, query, sampling
from refloom.operators import lines as ln
from refloom.plans import evaluation
from refloom.sources import tei

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _literal(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, float):
        return f"CAST({x!r} AS DOUBLE)"
    return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def _expect(columns: str, *rows: tuple):
    """Register a query that gives these rows of these columns."""
    sql = ", ".join(f"({', '.join(map(_literal, r))})" for r in rows)
    names = ", ".join(f'"{c}"' for c in columns.split())

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = f"SELECT * FROM (VALUES {sql}) AS t({names})"
        return f

    return add


def _inputs(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    """The rows, numbered by k from 1."""
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows, 1)], f"k int, {schema}")


# Values


@_expect(
    "date label parity",
    ("1899", "[* TO 1979]", "[* TO 1979]"), ("1978-12", "[* TO 1979]", "[* TO 1979]"), ("1979", "[* TO 1979]", "[1980 TO 1999]"), ("1980-05-01", "[1980 TO 1999]", "[1980 TO 1999]"), ("1999", "[1980 TO 1999]", "[2000 TO *]"),
    ("2000", "[2000 TO *]", "[2000 TO *]"), ("2100", "[2000 TO *]", "[2000 TO *]"), ("2101", "YEAR_OUT_OF_RANGE", "YEAR_OUT_OF_RANGE"), ("99991", "YEAR_OUT_OF_RANGE", "YEAR_OUT_OF_RANGE"), ("-123", "YEAR_OUT_OF_RANGE", "YEAR_OUT_OF_RANGE"),
    ("abcd", "UNKOWN_PERIOD", "UNKOWN_PERIOD"), ("", "UNKOWN_PERIOD", "UNKOWN_PERIOD"), (None, "UNKOWN_PERIOD", "UNKOWN_PERIOD"),
)
def period_cases(spark, d):
    rows = _inputs(spark, "date string", *[(x,) for x in ("1899", "1978-12", "1979", "1980-05-01", "1999", "2000", "2100", "2101", "99991", "-123", "abcd", "", None)])
    return rows.select("date", vl.period(F.col("date")).alias("label"), vl.period(F.col("date"), parity=True).alias("parity"))


@_expect("code iso", ("EN", "en"), ("En", "en"), ("--", "en"), ("DE", "de"), ("De", "de"), ("FR", "fr"), ("Fr", "fr"), ("en", "en"), ("fra", "fra"), ("ES", "ES"), ("English", "English"), ("", ""), (None, None))
def language_cases(spark, d):
    rows = _inputs(spark, "code string", *[(x,) for x in ("EN", "En", "--", "DE", "De", "FR", "Fr", "en", "fra", "ES", "English", "", None)])
    return rows.select("code", vl.language_code(F.col("code")).alias("iso"))


@_expect(
    "name level",
    ("University of Leeds", "institution"), ("Polish Academy of Sciences", "institution"), ("Institut Pasteur", "institution"), ("Inserm U123", "institution"), ("Universidad de Chile", "institution"),
    ("Department of Physics", "department"), ("Dept of Law", "department"), ("Dipartimento di Fisica", "department"), ("Département de chimie", "department"), ("Medical School", "department"), ("Faculty of Arts", "department"), ("Institute of Optics", "department"),
    ("Unité Inserm 9", "laboratory"), ("Laboratoire de physique", "laboratory"), ("Service de radiologie", "laboratory"),
    ("National Institute", None), ("General Hospital", None), ("College of Europe", None), ("Research Centre", None), ("", None), (None, None),
)
def org_level_cases(spark, d):
    names = ("University of Leeds", "Polish Academy of Sciences", "Institut Pasteur", "Inserm U123", "Universidad de Chile", "Department of Physics", "Dept of Law", "Dipartimento di Fisica", "Département de chimie", "Medical School", "Faculty of Arts", "Institute of Optics", "Unité Inserm 9", "Laboratoire de physique", "Service de radiologie", "National Institute", "General Hospital", "College of Europe", "Research Centre", "", None)
    return _inputs(spark, "name string", *[(x,) for x in names]).select("name", vl.org_level(F.col("name")).alias("level"))


@_expect(
    "k org address country",
    (1, "Institute of Optics, University of Graz", "Schubertstr. 1, 8010 Graz", "Austria"), (2, "Dept of Law", "", "Leeds"), (3, "", "12 Main Street", "Boston"), (4, "Inserm U1", "", None), (5, "Service de radiologie, Institut Pasteur", "", "France"),
)
def affiliation_cases(spark, d):
    rows = _inputs(spark, "a string", ("Institute of Optics, University of Graz, Schubertstr. 1, 8010 Graz, Austria",), ("Dept of Law, Leeds",), ("12 Main Street, Boston",), ("Inserm U1",), ("Service de radiologie, Institut Pasteur, France",))
    return rows.select("k", vl.affiliation_parts(F.col("a")).alias("p")).select("k", "p.org", "p.address", "p.country")


@_expect(
    "k safe name",
    (1, "_tude_de_l_été", "AB12-elsevier-Müller_J_-1999-_tude_de_l_été"), (2, "Gröβe_α_Teilchen", "AB12-elsevier-Müller_J_-1999-Gröβe_α_Teilchen"),
    (3, "_ber_die_Bestimmung_der_Elementarladungen", "AB12-elsevier-Müller_J_-1999-_ber_die_Bestimmung_der_Elemen"), (4, "plain", "AB12-elsevier-Müller_J_-1999-plain"),
)
def file_name_cases(spark, d):
    rows = _inputs(spark, "title string", ("Étude de l'été",), ("Gröβe, α-Teilchen",), ("Über die Bestimmung der Elementarladungen",), ("plain",))
    return rows.select("k", tx.plain_name(F.col("title")).alias("safe"), tx.file_name(F.lit("AB12"), F.lit("elsevier"), F.lit("Müller, J."), F.lit("1999"), F.col("title")).alias("name"))


@_expect("value quoted", ("title:(a b)", "title:%28a%20b%29"), ("~foo bar~", "foo%20bar"), ("a/b c?", "a%3Fb%20c"), ("x ?y* z", "x%20y%2A%20z"), ("été:1", "%C3%A9t%C3%A9:1"), ("", ""))
def query_quote_cases(spark, d):
    rows = _inputs(spark, "value string", *[(x,) for x in ("title:(a b)", "~foo bar~", "a/b c?", "x ?y* z", "été:1", "")])
    return rows.select("value", tx.query_quote(F.col("value")).alias("quoted"))


@_expect(
    "k ids year month day kind name",
    (1, "a b c", "1999", "12", "31", "doi", "pages"), (2, "one", "2001", "05", None, "isbn", "pages.first"), (3, "", "1987", None, None, "patent", "genre"), (4, "x y", "2003", "Jan", "7", "other", "lang"),
)
def id_and_cover_cases(spark, d):
    rows = _inputs(spark, "ids string, cover string, id string, facet string", (" a b  c ", "19991231", "doi: 10.1016/x", "host.pages"), ("one", "200105", "978-0-306-40615-7", "host.pages.first"), ("", "1987", "PAT 123", "genre"), ("x y", "2003 Jan 7", "B123", "api.lang"))
    cover = vl.cover_date(F.col("cover"))
    return rows.select("k", F.array_join(vl.id_parts(F.col("ids")), " ").alias("ids"), cover["year"].alias("year"), cover["month"].alias("month"), cover["day"].alias("day"), vl.id_kind(F.col("id")).alias("kind"), tx.facet_name(F.col("facet")).alias("name"))


# Text


@_expect(
    "k canonical",
    (1, "A-B \"c\" 'd'"), (2, "office flow co-op"), (3, "\"cité\" 'x'"), (4, "a b"), (5, "OE"), (6, '"'),
)
def canonical_cases(spark, d):
    rows = _inputs(spark, "a string", ("A–B “c”\t‘d’",), ("oﬃce  ﬂow co- op",), ("« cité » ‹x›",), (" a\u00a0\n b ",), ("Œ",), ("''",))
    return rows.select("k", tx.canonical(F.col("a")).alias("canonical"))


@_expect(
    "a link_form eval_form plain match_key",
    ("corner", "e0mer", "c0mcr", "corner", "c0mcr"), ("Study 10", "5fadv I0", "5cadv 10", "Study 10", "5cadv10"), ("notice", "n0fIee", "a011cc", "notice", "a011cc"), ("Ångström Łódź", "Ångsfr6m Łódź", "Åagscr6m Łódź", "Angstrom Lodz", "agscr6md"),
    ("Thin films, of Gold!", "ThIn fIIms, 0f G0Id!", "Th1a 111ms, 0c G01d!", "Thin films, of Gold!", "th1a111ms0cg01d"), ("[3-Sot. C)", "β-50e. 0", "β-50c. 0", "[3-Sot. C)", "50c0"),
)
def letter_cases(spark, d):
    rows = _inputs(spark, "a string", *[(x,) for x in ("corner", "Study 10", "notice", "Ångström Łódź", "Thin films, of Gold!", "[3-Sot. C)")])
    return rows.select("a", tx.ocr_link(F.col("a")).alias("link_form"), tx.ocr_eval(F.col("a")).alias("eval_form"), tx.unaccent(F.col("a")).alias("plain"), tx.match_key(F.col("a")).alias("match_key"))


@_expect(
    "a b soft archive clean",
    ("Soc. Chem.", "Sot. Chem.", True, True, True), ("co-op", "coop", True, False, True), ("ab1", "abl", False, True, True), ("Modern art", "rnodern art", True, False, True), ("Abc", "abc", True, False, True),
    ("Thin films of gold", "Thin films of go1d in water", False, False, False), ("Thin films of gold", "Thin fi1ms of gold, x", False, False, True), ("short", "a much longer text", False, False, False), ("", "", True, True, False),
)
def comparison_cases(spark, d):
    rows = _inputs(spark, "a string, b string", ("Soc. Chem.", "Sot. Chem."), ("co-op", "coop"), ("ab1", "abl"), ("Modern art", "rnodern art"), ("Abc", "abc"), ("Thin films of gold", "Thin films of go1d in water"), ("Thin films of gold", "Thin fi1ms of gold, x"), ("short", "a much longer text"), ("", ""))
    a, b = F.col("a"), F.col("b")
    return rows.select("a", "b", tx.soft_equal(a, b).alias("soft"), tx.archive_equal(a, b).alias("archive"), tx.clean_equal(a, b).alias("clean"))


@_expect("a joined", ("e´te", "éte"), ("Mu¨ller", "Müller"), ("c¸a", "ça"), ("Sˇkoda", "Škoda"), ("a^ge", "âge"), ("e\u0301", "é"), ("x¯y", "x\u0304y"), ("1´", "1´"), ("o˝", "ő"))
def accent_cases(spark, d):
    rows = _inputs(spark, "a string", *[(x,) for x in ("e´te", "Mu¨ller", "c¸a", "Sˇkoda", "a^ge", "e\u0301", "x¯y", "1´", "o˝")])
    return rows.select("a", F.pandas_udf(tx.compose_accents, "string")("a").alias("joined"))


@_expect("name code", ("France", "FR"), ("FRA", "FR"), (" Deutschland ", "DE"), ("Germany", "DE"), ("Atlantis", None), ("", None), (None, None))
def any_cell_cases(spark, d):
    table = spark.createDataFrame([("FR", "FRA", "France", "France"), ("DE", "DEU", "Germany", "Deutschland"), ("XX", None, "", "")], "code string, a3 string, en string, own string")
    rows = _inputs(spark, "name string", *[(x,) for x in ("France", "FRA", " Deutschland ", "Germany", "Atlantis", "", None)])
    return linkage.any_cell(rows, "name", table, ["code", "a3", "en", "own"], "code").select("name", "code")


@_expect("path simple", ('monogr/imprint/biblScope[@unit="page"]/@from', "monogr/imprint/biblScope"), ('tei:analytic/tei:title[@level="a"]', "analytic/title"), ("note", "note"))
def simple_path_cases(spark, d):
    rows = _inputs(spark, "path string", ('monogr/imprint/biblScope[@unit="page"]/@from',), ('tei:analytic/tei:title[@level="a"]',), ("note",))
    return rows.select("path", tei.simple_path(F.col("path")).alias("simple"))


@_expect("k line", (1, "the last and longest line of them"), (2, "one"), (3, "bb"), (4, ""))
def error_line_cases(spark, d):
    rows = _inputs(spark, "message string", ("first\nsecond line\nthe last and longest line of them",), ("one",), ("aa\nbb",), ("",))
    return rows.select("k", tx.best_error_line(F.col("message")).alias("line"))


@_expect(
    "gold todo found",
    ("abc-def", "abcdef", "OUI_avec:rmhyph.OK"), ("x", None, "NON_silence"), (None, "x", "NON_bruit"), (None, None, None), ("x", "", "NON_silence_vide"), ("x", "x", "OUI"), ("Long enough", "Long enough http://x", "NON_+long_tit_http"), ("Long enough ones", "Long enough ones!", "OUI_avec:allongé.OK"),
    ("Long enough ones!", "Long enough ones", "OUI_avec:raccourci.OK"), ("an en-try “x”", 'an entry "x"', "OUI_avec:rmhyph.norpun.OK"), ("a  b", "a b", "OUI_avec:norspa.OK"), ("modern", "rnodern", "OUI_avec:OCeeRs.OK"), ("abc", "xyz", "NON_diff"),
)
def diagnosis_cases(spark, d):
    rows = _inputs(spark, "g_tit string, t_tit string", ("abc-def", "abcdef"), ("x", None), (None, "x"), (None, None), ("x", ""), ("x", "x"), ("Long enough", "Long enough http://x"), ("Long enough ones", "Long enough ones!"), ("Long enough ones!", "Long enough ones"), ("an en-try “x”", 'an entry "x"'), ("a  b", "a b"), ("modern", "rnodern"), ("abc", "xyz"))
    return linkage.diagnose(rows, ["k", "g_tit", "t_tit"], ("tit",)).select(F.col("g_tit").alias("gold"), F.col("t_tit").alias("todo"), F.col("tit").alias("found"))


# References in XML


_BIBS = (
    ("d", "b0", '<biblStruct xml:id="b0"><analytic><title level="a" type="main">Gold (films)</title><author><persName><surname>Smith</surname><forename type="first">A</forename></persName></author></analytic><monogr><title level="j">J. Phys</title><imprint><biblScope unit="volume">12</biblScope><biblScope unit="page">33</biblScope><date type="published" when="1999"/></imprint></monogr><note>x-1</note><idno type="DOI">10.1/x</idno></biblStruct>'),
    ("d", "b1", '<biblStruct><monogr><title level="m"> - </title><imprint><biblScope unit="page" from="5" to="9"/><date>May 2001-02</date></imprint></monogr></biblStruct>'),
    ("d", "b2", "<biblStruct><monogr>"),
)


@_expect(
    "bib_id path field value",
    ("b0", 'analytic/title[@level="a"][@type="main"]', "title", r"Gold \(films\)"), ("b0", "analytic/author/persName/surname", "author.name", "Smith"), ("b0", 'monogr/title[@level="j"]', "host.title", "J. Phys"), ("b0", 'monogr/imprint/biblScope[@unit="volume"]', "host.volume", "12"),
    ("b0", 'monogr/imprint/biblScope[@unit="page"]/@from', "host.pages.first", "33"), ("b0", 'monogr/imprint/date[@type="published"]/@when', "publicationDate", "1999"), ("b0", "note", "_NULL_", r"x\-1"), ("b0", 'idno[@type="DOI"]', "_CHAMP_INCONNU_", "10.1/x"),
    ("b1", 'monogr/imprint/biblScope[@unit="page"]/@from', "host.pages.first", "5"), ("b1", 'monogr/imprint/biblScope[@unit="page"]/@to', "host.pages.last", "9"), ("b1", "monogr/imprint/date", "publicationDate", r"May 2001\\\-02"),
)
def shredding_cases(spark, d):
    return tei.subvalues(spark.createDataFrame(_BIBS, "doc_key string, bib_id string, bib string"), every=True).select("bib_id", "path", "field", "value")


@_expect("bib_id no_token", ("b0", False), ("b1", True))
def token_cases(spark, d):
    rows = spark.createDataFrame([("d", "b0", "title", "Gold films"), ("d", "b0", "host.volume", "x"), ("d", "b1", "title", "a of"), ("d", "b1", "host.volume", "vol")], "doc_key string, bib_id string, field string, value string")
    return tei.without_tokens(rows).select("bib_id", "no_token")


_REF = '<biblStruct xml:id="{0}"><analytic><title level="a" type="main">{1}</title>{2}</analytic><monogr><title level="j">J Phys</title><imprint><biblScope unit="vol">12</biblScope><biblScope unit="page" from="33" to="44"/><date type="published" when="{3}"/></imprint></monogr></biblStruct>'
_SMITH = "<author><persName><surname>Smith</surname></persName></author>"
_SHORT = '<biblStruct><analytic><title level="a" type="main">{0}</title>{1}</analytic><monogr><imprint><date when="{2}"/></imprint></monogr></biblStruct>'
_BOOK = '<biblStruct><monogr><title level="m">A book</title><imprint><date when="2001"/></imprint></monogr></biblStruct>'
_TEI = "<TEI><text><back><div><listBibl>{0}</listBibl></div></back></text></TEI>"


def _sides(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    gold = [("d1", _TEI.format(_REF.format("b0", "Thin films of gold", _SMITH, "1999") + _BOOK + "<bibl>loose</bibl>")), ("d2", _TEI.format("")), ("d3", "<TEI><text>"), ("d4", _TEI.format(_BOOK)), ("d5", _TEI.format(_BOOK))]
    todo = [("d1", _TEI.format(_SHORT.format("Thin films of gold", _SMITH, "1999") + _SHORT.format("Unknown work", "", "2010"))), ("d2", "<TEI>"), ("d3", _TEI.format(_BOOK)), ("d5", _TEI.format(""))]
    return tuple(spark.createDataFrame(x, "doc_key string, xml string") for x in (gold, todo))


@_expect(
    "tdoc_id gbib_id tbib_id match match_rule pubtype tei_analytic gfields tfields Ftit Fdate Fj gnames tnames oknames",
    ("d1", 1, 1, "aligné", "strict:ti+date", "an+mo", "an+mo", 7, 3, "OUI", "OUI", "NON_silence", 1, 1, 1),
    ("d1", 2, None, "silence", None, "mo", None, 3, None, "NON_silence_captif", "NON_silence_captif", None, 0, None, 0),
    ("d1", None, 2, "bruit", None, None, "an+mo", None, 3, "NON_bruit_captif", "NON_bruit_captif", None, None, 0, 0),
    ("d5", 1, None, "silence", None, "mo", None, 3, None, "NON_silence_captif", "NON_silence_captif", None, 0, None, 0),
)
def evaluation_table(spark, d):
    rows = evaluation.table(*_sides(spark))
    return rows.select("tdoc_id", *[F.col(c).cast("int").alias(c) for c in ("gbib_id", "tbib_id")], "match", "match_rule", "pubtype", "tei_analytic", "gfields", "tfields", "Ftit", "Fdate", "Fj", "gnames", "tnames", "oknames")


@_expect(
    "gold_docs todo_docs aligned_docs matchable_docs gold_errors todo_errors empty_gold empty_todo K matchable_K L matchable_L by_title by_names by_issue by_heuristic found silence noise R R_base P P_base",
    (5, 4, 4, 2, 1, 1, 1, 1, 3, 3, 3, 2, 1, 0, 0, 0, 1, 2, 1, 0.333, 0.333, 0.333, 0.5),
)
def evaluation_counters(spark, d):
    out = evaluation.counters(*_sides(spark))
    return out.select(*[F.col(c).cast("int").alias(c) if kind == "bigint" else F.col(c) for c, kind in out.dtypes])


@_expect("n_docs n_gold R P by_title by_issue by_names found eval_id", (4, 3, "0.333", "0.500", 1, 0, 0, 1, "run_1_a"), (0, 0, "err", "err", 0, 0, 0, 0, None))
def evaluation_summary(spark, d):
    none = [df.limit(0) for df in _sides(spark)]
    out = evaluation.summary(evaluation.counters(*_sides(spark)), "run 1/a").unionByName(evaluation.summary(evaluation.counters(*none)))
    return out.select(*[F.col(c).cast("int").alias(c) if kind == "bigint" else F.col(c) for c, kind in out.dtypes])


@_expect("todo_id name", (1, "d1"), (2, "d2"), (3, "d3"), (4, "d5"))
def evaluation_lookup(spark, d):
    return evaluation.lookup(*_sides(spark))


_MATCHES = "g int, tit string, date string, names array<string>, j string, vol string, fpg string"


@_expect("g t alignment rule", (1, 1, "ali", 1), (2, 2, "ali", 2), (3, 3, "ali", 3), (4, 4, "ali", 4), (5, None, "silence", None), (None, 5, "noise", None))
def match_rule_cases(spark, d):
    gold = [
        (1, "Thin films of gold", "1999", ["Smith"], "J Phys", "1", "10"), (2, "Silver", "2000", ["Jones"], "A", "2", "20"), (3, "Copper wires", "2002", ["Brown"], "Nature", "7", "70"), (4, "Iron oxides", "2003", ["Miller"], "D", "8", "80"), (5, "Never seen again", "1980", ["Nobody"], "E", "5", "50"),
    ]
    todo = [
        (1, "Thin fiIms of goId", "1999", ["Other"], "X", "9", "99"), (2, "Completely different", "2001", ["Jones"], "B", "3", "30"), (3, "", None, [], "Nature", "7", "70"), (4, "A long preface about everything: iron oxides in rocks", "2003", ["Zed"], "C", "1", "80"), (5, "Noise of the crowd", "2011", ["Who"], "F", "6", "60"),
    ]
    frames = [spark.createDataFrame(x, _MATCHES.replace("g int", f"{k} int")).withColumn("doc_key", F.lit("d")) for x, k in ((gold, "g"), (todo, "t"))]
    return linkage.align(*frames).select(F.col("g").cast("int").alias("g"), F.col("t").cast("int").alias("t"), "alignment", "rule")


# Publishers' XML


@_expect(
    "k publisher dialect",
    (1, "nlm", "nlm"), (2, "elsevier", "elsevier"), (3, "elsevier", "elsevier"), (4, "scholarone", "nlm"), (5, "springer2", "springer"), (6, "springer3", "springer"), (7, "springer-chapter", "springer"), (8, "rsc", "nlm"), (9, "nature", "nature"), (10, "wiley", "wiley"), (11, "iop", "iop"), (12, "unidentified", None),
    (13, "bmj", "nlm"), (14, "nihms", None), (15, "nlm2", "nlm"), (16, "sage", "nlm"), (17, "edps", None), (18, "edps-backfile", None), (19, "unidentified", None), (20, "unidentified", None), (21, "unidentified", None),
)
def publisher_cases(spark, d):
    docs = (
        "<?xml version='1.0'?><!DOCTYPE article SYSTEM 'x.dtd'><article><front/></article>", "<els:article xmlns:els='e'><els:item-info/></els:article>", "<converted-article><item-info/></converted-article>", "<article_set/>", "<Article><ArticleInfo/></Article>", "<Publisher><PublisherInfo/><Journal/></Publisher>",
        "<Publisher><PublisherInfo/><Series><Book><Chapter ID='1'/></Book></Series></Publisher>", "<article><art-admin/></article>", "<headerx><pubfm><cpg><cpn>Macmillan Ltd</cpn></cpg></pubfm></headerx>", "<component xmlns='w' type='serialArticle'><header/></component>",
        "<article><article-metadata><article-data><copyright>2001 IOP Ltd</copyright><article-type sort='regular'/></article-data></article-metadata></article>", "<article><article-metadata><article-data><copyright>Other</copyright><article-type sort='regular'/></article-data></article-metadata></article>",
        "<metadata/>", "<nihms-submit/>", "<ArticleSet/>", "<SAGEmeta/>", "<EDPSArticle/>", "<edp-article/>", "<article><body/></article>", "", None,
    )
    rows = _inputs(spark, "xml string", *[(x,) for x in docs])
    return convert.with_dialect(rows).select("k", "publisher", "dialect")


_ELS = "<ce:bib-reference id='r{0}'><ce:label>[{0}]</ce:label><sb:reference><sb:contribution><sb:authors><sb:author><ce:surname>Roe</ce:surname></sb:author></sb:authors><sb:title><sb:maintitle>Part</sb:maintitle></sb:title></sb:contribution><sb:host>{1}</sb:host></sb:reference></ce:bib-reference>"
_T = "<sb:title><sb:maintitle>{0}</sb:maintitle></sb:title>"


@_expect(
    "doc n label type structured tit m j s date vol fpg psher names text analytic",
    ("els", 0, "[0]", "article", True, "Part", None, "J Phys", None, "1999", "7", "11", None, "Roe", None, True), ("els", 1, "[1]", "book", True, None, "Part", None, None, "2001", None, None, "Pub", "Roe", None, True), ("els", 2, "[2]", "book", True, "Part", "Whole", None, "Series", "2002", None, None, None, "Roe", None, True),
    ("els", 3, "[3]", "book", True, "Part", "Series", None, None, None, None, None, None, "Roe", None, True), ("els", 4, "[4]", "book", True, "Part", "Whole", None, None, "2004", None, None, None, "Roe", None, True), ("els", 5, "[5]", None, False, None, None, None, None, None, None, None, None, "", "[5] Private note, 1999", None),
    ("spr", 0, None, "article", True, "Art", None, "J", None, "1998", "2", "5", None, "Doe Poe", None, True), ("spr", 1, None, "inBook", True, "Chap", None, None, None, "1997", None, None, None, "", None, True), ("spr", 2, None, "book", True, None, "Book", None, None, "1996", None, None, "House", "", None, False), ("spr", 3, None, None, False, None, None, None, None, None, None, None, None, "", "Some words & more", None),
    ("iop", 0, "1", "article", True, "Art", None, "J", None, "1995", "3", None, None, "Coe", None, True), ("iop", 1, "2", "book", True, "Chap", "Book", None, None, "1994", None, None, "House", "Coe", None, True), ("iop", 2, "3", "book", True, None, "Book", None, None, "1993", None, None, None, "", None, False), ("iop", 3, "4", "conf", True, "Talk", "Proc. Conf", None, None, "1992", None, None, None, "", None, True),
    ("iop", 4, "5", "thesis", True, None, "PhD", None, None, "1991", None, None, None, "", None, False), ("iop", 5, "6", "patent", True, None, "X", None, None, None, None, None, None, "", None, False), ("iop", 6, "7", "report", True, None, "Annual Report", None, None, None, None, None, None, "", None, False), ("iop", 7, "8", "misc", True, None, "Y", None, None, None, None, None, None, "", None, False),
    ("nlm", 0, None, "article", True, "Art", None, "J", None, "1990", "4", "9", None, "Moe", None, True), ("nlm", 1, None, "inproceedings", True, "Talk", None, "Proc", None, "1989", None, None, None, "", None, True), ("nlm", 2, None, "book", True, None, None, "Tome", None, "1988", None, None, "House", "Moe", None, False), ("nlm", 3, None, None, False, None, None, None, None, None, None, None, None, "", "As is.", None),
    ("nat", 0, None, None, True, "Art", None, "J", None, "1987", "5", "6", None, "Zoe", None, True), ("wil", 0, None, "article", True, "Art", None, "J", None, "1986", "6", "7", None, "Joe", None, True), ("wil", 1, None, "inBook", True, "Chap", "Book", None, None, "1985", None, None, "House", "", None, True), ("wil", 2, None, "book", True, None, "Book", None, None, None, None, None, None, "", None, False), ("wil", 3, None, None, False, None, None, None, None, None, None, None, None, "", "Loose", None),
)
def conversion_cases(spark, d):
    els = (
        "<sb:issue><sb:series>" + _T.format("J Phys") + "<sb:volume-nr>7</sb:volume-nr></sb:series><sb:date>1999</sb:date></sb:issue><sb:pages><sb:first-page>11</sb:first-page></sb:pages>", "<sb:book><sb:date>2001</sb:date><sb:publisher><sb:name>Pub</sb:name></sb:publisher></sb:book>",
        "<sb:edited-book>" + _T.format("Whole") + "<sb:book-series><sb:series>" + _T.format("Series") + "</sb:series></sb:book-series><sb:date>2002</sb:date></sb:edited-book>", "<sb:edited-book><sb:book-series><sb:series>" + _T.format("Series") + "</sb:series></sb:book-series></sb:edited-book>", _T.format("Whole") + "<sb:book><sb:date>2004</sb:date></sb:book>",
    )
    docs = [
        ("els", "elsevier", "".join(_ELS.format(k, x) for k, x in enumerate(els)) + "<ce:bib-reference id='r5'><ce:label>[5]</ce:label> <ce:other-ref><ce:textref>Private note, 1999</ce:textref></ce:other-ref></ce:bib-reference>"),
        ("spr", "springer", "<Citation><CitationNumber>1.</CitationNumber><BibArticle><BibAuthorName><FamilyName>Doe</FamilyName></BibAuthorName><BibAuthorName><FamilyName>Poe</FamilyName></BibAuthorName><Year>1998</Year><ArticleTitle>Art</ArticleTitle><JournalTitle>J</JournalTitle><VolumeID>2</VolumeID><FirstPage>5</FirstPage></BibArticle><BibChapter><Year>1997</Year><ChapterTitle>Chap</ChapterTitle></BibChapter></Citation><Citation><BibBook><Year>1996</Year><BookTitle>Book</BookTitle><PublisherName>House</PublisherName></BibBook><BibUnstructured>Some <b>words</b> &amp; more</BibUnstructured></Citation>"),
        ("iop", "iop", "<reference-list><journal-ref num='1'><authors><author><second-name>Coe</second-name></author></authors><art-title>Art</art-title><jnl-title>J</jnl-title><year>1995</year><volume>3</volume><pages>1-2</pages></journal-ref><multipart><book-ref num='2'><authors><author><second-name>Coe</second-name></author></authors><art-title>Chap</art-title><book-title>Book</book-title><year>1994</year><publication><publisher>House</publisher></publication></book-ref><multipart><book-ref num='3'><book-title>Book</book-title><year>1993</year></book-ref></multipart></multipart><conf-ref num='4'><art-title>Talk</art-title><conf-title>Proc. Conf</conf-title><year>1992</year></conf-ref><misc-ref num='5'><thesis/><misc-title>PhD</misc-title><year>1991</year></misc-ref><misc-ref num='6'><misc-title>X</misc-title><misc-text>PAT 5</misc-text></misc-ref><misc-ref num='7'><misc-title>Annual Report</misc-title></misc-ref><misc-ref num='8'><misc-title>Y</misc-title></misc-ref></reference-list>"),
        ("nlm", "nlm", "<ref-list><ref id='a'><citation citation-type='journal'><person-group><name><surname>Moe</surname></name></person-group><article-title>Art</article-title><source>J</source><year>1990</year><volume>4</volume><fpage>9</fpage></citation></ref><ref><element-citation publication-type='confproc'><article-title>Talk</article-title><source>Proc</source><year>1989</year></element-citation></ref><ref><citation citation-type='book'><person-group><name><surname>Moe</surname></name></person-group><source>Tome</source><year>1988</year><publisher-name>House</publisher-name></citation></ref><ref><mixed-citation>As <i>is</i>.</mixed-citation></ref></ref-list>"),
        ("nat", "nature", "<bib><refau><snm>Zoe</snm></refau><atl>Art</atl><jtl>J</jtl><cd>1987</cd><vid>5</vid><ppf>6</ppf></bib><bib><broken></bib>"),
        ("wil", "wiley", "<citation type='journal'><author><familyName>Joe</familyName></author><articleTitle>Art</articleTitle><journalTitle>J</journalTitle><pubYear>1986</pubYear><vol>6</vol><pageFirst>7</pageFirst></citation><citation type='book'><chapterTitle>Chap</chapterTitle><bookTitle>Book</bookTitle><pubYear>1985</pubYear><publisherName>House</publisherName></citation><citation type='book'><bookTitle>Book</bookTitle></citation><citation type='other'>Loose</citation>"),
        ("none", None, "<bib><atl>x</atl></bib>"),
    ]
    rows = convert.convert(spark.createDataFrame(docs, "doc string, dialect string, xml string").withColumnRenamed("doc", "doc_key"))
    return rows.select(F.col("doc_key").alias("doc"), "n", "label", "type", "structured", "tit", "m", "j", "s", "date", "vol", "fpg", "psher", F.array_join("names", " ").alias("names"), "text", F.col("has_analytic").alias("analytic"))


# Queries


@_expect(
    "strategy query",
    ("bag_of_words", "Thin films J. Mol. Biol 1999 note x"), ("all_quoted", 'title:"Thin films" AND host.title:"J. Mol. Biol" AND publicationDate:"1999" AND "note x"'), ("any_quoted", 'title:"Thin films" host.title:"J. Mol. Biol" publicationDate:"1999" "note x"'),
    ("any_token", "title:(Thin films) host.title:(J Mol Biol) publicationDate:1999 note"), ("must_should", "(publicationDate:1999) AND (title:(Thin films) host.title:(J Mol Biol) note)"), ("must_should_wild", "(publicationDate:1999) AND (title:(Thin films) host.title:(journal Mol* Biol*) note)"),
    ("all_tokens", "title:(Thin films) AND host.title:(J Mol Biol) AND publicationDate:1999 AND note"), ("all_tokens_wild", "title:(Thin films) AND host.title:(journal Mol* Biol*) AND publicationDate:1999 AND note"), ("production", "note title:(Thin films) host.title:(journal Mol* Biol*) publicationDate:1999"),
)
def strategy_cases(spark, d):
    values = {"title": ["Thin films"], "host.title": ["J. Mol. Biol"], "publicationDate": ["1999"], "_NULL_": ["note x"]}
    tokens = {"title": ["Thin", "films"], "host.title": ["J", "Mol", "Biol"], "publicationDate": ["1999"], "_NULL_": ["note"]}
    pairs = lambda m: F.map_from_arrays(F.array(*map(F.lit, m)), F.array(*[F.array(*map(F.lit, v)) for v in m.values()]))
    one = spark.range(1).select(F.lit("d").alias("doc_key"), F.lit("b").alias("bib_id"), pairs(values).alias("values"), pairs(tokens).alias("tokens"))
    out = None
    for name in query.STRATEGIES:
        part = query.build_queries(one, name).select(F.lit(name).alias("strategy"), "query")
        out = part if out is None else out.unionByName(part)
    return out


_HITS = ((1, "Gold films", "1999", "12"), (2, "Silver", "1999", "13"), (3, "Gold", "2005", "12"), (4, None, None, None))


@_expect(
    "q ids",
    ("(publicationDate:1999) AND ()", "1 2"), ("(publicationDate:1999 AND host.volume:12) AND ()", "1"), ("(host.volume:12) AND (title:gold title:films)", "1 3"), ("(publicationDate:1999) AND (title:nothing)", ""), ("title:* AND NOT ()", "1 2 3"), ('title:"Gold films"', "1"), ("title:go?d OR publicationDate:[2000 TO *]", "1 3"),
)
def search_cases(spark, d):
    docs = spark.createDataFrame(_HITS, "id int, title string, date string, vol string")
    out = None
    for q in ("(publicationDate:1999) AND ()", "(publicationDate:1999 AND host.volume:12) AND ()", "(host.volume:12) AND (title:gold title:films)", "(publicationDate:1999) AND (title:nothing)", "title:* AND NOT ()", 'title:"Gold films"', "title:go?d OR publicationDate:[2000 TO *]"):
        hits = query.search(docs, q, {"title": "title", "publicationDate": "date", "host.volume": "vol"})
        part = hits.agg(F.array_join(F.array_sort(F.collect_list("id")), " ").alias("ids")).select(F.lit(q).alias("q"), "ids")
        out = part if out is None else out.unionByName(part)
    return out


@_expect("start id title", (0, 1, "Gold films"), (0, 3, "Gold"), (1, 3, "Gold"))
def page_cases(spark, d):
    docs, fields = spark.createDataFrame(_HITS, "id int, title string, date string, vol string"), {"title": "title"}
    pages = [query.page(docs, "title:(gold films)", fields, start, 2, ["id", "title"]).select(F.lit(start).alias("start"), "id", "title") for start in (0, 1, 2)]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


# Lines


@_expect(
    "line score header",
    ("(1999)", 2, False), ("68(3):858-862", 3, False), ("[12] Smith and Jones", 4, False), ("plain prose here", 0, False), ("doi: 10.1000/xyz", 3, False), ("Vol. 5, No. 8, pp. 1371", 4, False), ("REFERENCES", 0, True), ("R E F E R E N C E S", 0, True), ("3. In: A book", 4, False), ("68, 858-862", 3, False),
)
def line_cases(spark, d):
    rows = _inputs(spark, "line string", *[(x,) for x in ("(1999)", "68(3):858-862", "[12] Smith and Jones", "plain prose here", "doi: 10.1000/xyz", "Vol. 5, No. 8, pp. 1371", "REFERENCES", "R E F E R E N C E S", "3. In: A book", "68, 858-862")])
    return rows.select("line", ln.line_score(F.col("line")).alias("score"), ln.is_header(F.col("line")).alias("header"))


@_expect("doc first last", ("header", 1, 3), ("single", 1, 1), ("long", None, None), ("spread", 0, 3))
def zone_cases(spark, d):
    rows = [("header", i, s, i == 1, 2) for i, s in enumerate((0, 5, 4, 3, 0, 2))] + [("single", i, s, False, 1) for i, s in enumerate((1, 7, 0))] + [("long", i, 1, i == 0, 2) for i in range(30)] + [("spread", i, s, False, 2) for i, s in enumerate((0, 3, 3, 2, 0, 0, 0, 0))]
    return ln.zones(spark.createDataFrame(rows, "doc string, i int, score int, header boolean, n_refs int"), "doc").select("doc", "first", "last")


@_expect("doc i j", ("a", 0, 0), ("a", 1, 0), ("a", 2, 1), ("a", 3, None), ("one", 0, 0), ("one", 1, None), ("tie", 0, 1), ("tie", 1, 1))
def champion_cases(spark, d):
    scores = [("a", 0, 0, 9), ("a", 0, 1, 1), ("a", 1, 0, 3), ("a", 2, 1, 6), ("one", 0, 0, 8), ("tie", 0, 1, 7), ("tie", 1, 1, 6), ("tie", 1, 2, 6)]
    lines = [("a", i, 2) for i in range(4)] + [("one", i, 1) for i in range(2)] + [("tie", i, 20) for i in range(2)]
    return ln.champions(spark.createDataFrame(scores, "doc string, i int, j int, score int"), spark.createDataFrame(lines, "doc string, i int, n_refs int"), "doc")


@_expect(
    "k ordered js",
    (1, True, "0 0 1 1 1 2"), (2, False, "0 5 7 9"), (3, True, ""), (4, True, "0 - - - 1"), (5, False, "0 1 4 2 9 3"), (6, True, "0 1 2 2 2"), (7, True, "-"),
)
def sequence_cases(spark, d):
    rows = _inputs(spark, "js array<int>", ([0, 0, 1, 9, 1, 2],), ([0, 5, 7, 9],), ([],), ([0, None, 3, None, 1],), ([0, 1, 4, 2, 9, 3],), ([0, 1, 2, 0, 2],), ([None],))
    r = ln.checked(F.col("js"))
    return rows.select("k", r["ordered"].alias("ordered"), F.array_join(r["js"], " ", "-").alias("js"))


@_expect(
    "k tagged missing",
    (1, '<title level="a">0xldation cf Meta1s</title>. 1999', ""), (2, '<title level="a">therrno-¤dynarnics</title> 3', "vol"), (3, 'A <title level="j">Nat .</title> 7', ""), (4, 'pp <biblScope unit="page">33-4</biblScope>.', ""), (5, "nothing here", "tit"),
)
def projection_cases(spark, d):
    field = "fields array<struct<name:string,alternatives:array<string>>>"
    rows = _inputs(spark, f"line string, {field}", ("0xldation cf Meta1s. 1999", [("tit", ["Oxidation of Metals"])]), ("therrno-¤dynarnics 3", [("tit", ["thermodynamics"]), ("vol", ["12"])]), ("A Nat . 7", [("j", ["Nat."])]), ("pp 33-4.", [("fpg", ["33-44", "33-4"])]), ("nothing here", [("tit", ["Oxidation of Metals"])]))
    return projection.project_fields(rows, ["k"]).select("k", "tagged", F.array_join("missing", " ").alias("missing"))


# Counts


@_expect("code outcome", ("OUI", "F.aligne"), ("OUI_si_nettoie", "F.aligne"), ("OUI_avec:punct.OK", "F.maisOK"), ("NON_silence", "F.silence"), ("NON_silence_captif", "F.silence"), ("NON_+court_x", "F.silence"), ("NON_bruit", "F.bruit"), ("NON_+long_tit_http", "F.bruit"), ("NON_diff", "F.les2"), ("other", "other"))
def recode_cases(spark, d):
    rows = _inputs(spark, "code string", *[(x,) for x in ("OUI", "OUI_si_nettoie", "OUI_avec:punct.OK", "NON_silence", "NON_silence_captif", "NON_+court_x", "NON_bruit", "NON_+long_tit_http", "NON_diff", "other")])
    return rows.select("code", metrics.recode(F.col("code")).alias("outcome"))


@_expect("k R P gR gP", ("a", 0.8, 0.4, 0.2, 0.1), ("b", None, 0.0, None, 0.5))
def name_gain_cases(spark, d):
    rows = spark.createDataFrame([("a", 4, 5, 10, 1, 0), ("b", 0, 0, 2, None, 1)], "k string, ok int, gold int, todo int, e1 int, e2 int")
    return metrics.name_recall_precision(rows, "ok", "gold", "todo", ("e1", "e2")).select("k", "R", "P", "gR", "gP")


@_expect("k aligned noise silence", ("names", 4, 8, 1))
def author_total_cases(spark, d):
    rows = spark.createDataFrame([("a", 4, 5, 10), ("b", 0, 0, 2)], "k string, ok int, gold int, todo int")
    out = metrics.author_totals(rows, "k", "ok", "gold", "todo")
    return out.select("k", *[F.col(c).cast("int").alias(c) for c in ("aligned", "noise", "silence")])


@_expect("side k x y TOTAL", ("row", "a", 0.25, 0.75, 1.0), ("row", "b", 1.0, 0.0, 1.0), ("column", "a", 0.25, 1.0, None), ("column", "b", 0.75, 0.0, None), ("column", "TOTAL", 1.0, 1.0, None))
def share_cases(spark, d):
    rows = spark.createDataFrame([("a", 1, 3), ("b", 3, 0)], "k string, x int, y int")
    across = metrics.wide_percentages(rows, "k", ["x", "y"], total=True).withColumn("side", F.lit("row"))
    down = metrics.wide_percentages(rows, "k", ["x", "y"], across=False, total=True).withColumns({"side": F.lit("column"), "TOTAL": F.lit(None).cast("double")})
    return across.unionByName(down).select("side", "k", "x", "y", "TOTAL")


@_expect("place label", (1, "[* TO 1979]"), (2, "[1980 TO 1999]"), (3, "[2000 TO *]"), (4, "UNKOWN_PERIOD"))
def period_order_cases(spark, d):
    rows = spark.createDataFrame([("[2000 TO *]",), ("UNKOWN_PERIOD",), ("[* TO 1979]",), ("[1980 TO 1999]",)], "label string")
    ordered = [r["label"] for r in metrics.by_period(rows, "label").collect()]
    return spark.createDataFrame(list(enumerate(ordered, 1)), "place int, label string")


@_expect("method verdict n", ("m1", "ok", 2), ("m1", "no", 1), ("m2", "ok", 1), ("m2", "no", 1))
def verdict_cases(spark, d):
    rows = spark.createDataFrame([("ok", "no"), ("ok", "ok"), ("no", None)], "m1 string, m2 string")
    return metrics.verdicts(rows, ["m1", "m2"]).withColumn("n", F.col("n").cast("int"))


@_expect("doc kind", ("a", "listed"), ("b", "other"), ("c", "listed"))
def listed_cases(spark, d):
    rows, listed = spark.createDataFrame([("a",), ("b",), ("c",)], "doc string"), spark.createDataFrame([("c",), ("a",), ("a",), (None,)], "id string")
    return metrics.flag_listed(rows, "doc", listed, "kind", "listed", "other")


@_expect("code message", ("INIT", "sampling 6"), ("CRIT", "fields(a)"), ("XGOT", "6 of 6"), ("SAVE", "6 documents"))
def run_log_cases(spark, d):
    log: list[tuple[int, str, str]] = []
    sampling.sample(spark.range(12).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).cast("string").alias("a")), "id", ["a"], sampling.SampleConfig(size=6, smoothing=0.0), log=log)
    return sampling.run_log(spark, log).select("code", "message")
