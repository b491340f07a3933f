"""Operators on small tables, and what always holds."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refloom.operators import convert, linkage, metrics, projection, query, sampling
from refloom.operators import lines as ln
from refloom.plans import evaluation, pipelines
from refloom.sources import tables, tei
from refloom.streaming import documents

TEI = """<?xml version="1.0"?><!DOCTYPE TEI SYSTEM "x.dtd"><TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><a>x</a></teiHeader><text><body/><back><div><listBibl>
<biblStruct xml:id="b0"><analytic><title level="a" type="main">Thin films of gold</title><author><persName><forename type="first">A</forename><surname>Smith</surname></persName></author></analytic>
<monogr><title level="j">J. Mol. Biol</title><imprint><biblScope unit="volume">12</biblScope><biblScope unit="page" from="33" to="44"/><date type="published" when="1999"/></imprint></monogr></biblStruct>
<biblStruct><monogr><title level="m">A book</title><imprint><date>2001</date></imprint></monogr></biblStruct>
<biblStruct><analytic><title level="a" type="main">Unfindable words</title></analytic><monogr/></biblStruct></listBibl></div></back></text></TEI>"""


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("d1", TEI), ("bad", "<TEI><text>"), ("none", "<TEI><text/></TEI>")]
    return spark.createDataFrame(rows, "doc_key string, xml string").withColumn("xml", tei.strip_doctype(F.col("xml")))


def test_references(docs):
    ok = tei.parsed(docs)
    assert {r["doc_key"]: r["well_formed"] for r in ok.collect()} == {"d1": True, "bad": False, "none": True}
    bibs = tei.references(ok.where("well_formed"))
    assert [r["bib_id"] for r in bibs.orderBy("n").collect()] == ["b0", "NO_ID-1", "NO_ID-2"]
    got = {(r["bib_id"], r["field"]): r["value"] for r in tei.subvalues(bibs).collect()}
    assert got[("b0", "title")] == "Thin films of gold"
    assert got[("b0", "host.pages.first")] == "33" and got[("b0", "host.pages.last")] == "44"
    assert got[("b0", "publicationDate")] == "1999" and got[("NO_ID-1", "publicationDate")] == "2001"
    assert ("b0", "__IGNORE__") not in got
    assert [r["bib_id"] for r in tei.linkable(bibs).orderBy("n").collect()] == ["b0", "NO_ID-2"]
    f = tei.canonical_fields(bibs).where("bib_id = 'b0'").first()
    assert (f["tit"], f["date"], f["vol"], f["fpg"], f["lpg"], f["names"], f["has_analytic"]) == ("Thin films of gold", "1999", "12", "33", "44", ["Smith"], True)
    assert tei.field_map(tei.subvalues(bibs)).where("bib_id = 'b0'").first()["fields"]["author.name"] == ["Smith"]


def test_linking(spark, docs):
    hit = {"id": "T1", "title": "Thin films of gold", "publicationDate": "1999", "author": [{"name": "A Smith"}], "host": {"title": "Journal of Molecular Biology", "issn": ["0022-2836"], "volume": "12", "pages": {"first": "33", "last": "44"}}}
    cat = spark.createDataFrame([(json.dumps(hit),)], "j string").select(F.from_json("j", tables.HIT).alias("h")).select("h.*")
    out = {(r["source_id"], r["bib_id"]): r["target"] for r in pipelines.link(docs, cat).collect()}
    assert out == {("d1", "b0"): "T1", ("d1", "NO_ID-1"): "None", ("d1", "NO_ID-2"): "None"}
    links = spark.createDataFrame([("d1", "b0", "T1")], "doc_key string, bib_id string, target string")
    xml = tei.enrich(docs.where("doc_key = 'd1'"), links, "https://example.org/document/").first()["xml"]
    assert xml.count("<ref type=") == 1 and "document/T1</ref></biblStruct>" in xml
    abbr = spark.createDataFrame([("0022-2836", "j mol biol")], "issn string, key string")
    b = spark.createDataFrame([("J. Mol. Biol.",)], "host_title string")
    assert linkage.with_issn(b, abbr).first()["issn"] == "0022-2836" and linkage.with_issn(b, abbr, trim=False).first()["issn"] is None


def test_evaluation(docs):
    good = docs.where("doc_key <> 'bad'")
    rows, counters = pipelines.evaluate(good, good)
    c = counters.first()
    assert c["K"] == c["found"] + c["silence"] and c["L"] == c["found"] + c["noise"] and c["K"] == 3
    assert rows.where("alignment = 'ali' and rule = 1").count() == 1


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), max_size=12, unique=True))
def test_greedy_is_one_to_one(spark, pairs):
    got = [(r["g"], r["t"]) for r in linkage.greedy(spark.createDataFrame([("d", g, t, 1) for g, t in pairs], "doc_key string, g int, t int, rule int")).collect()]
    want, used = [], set()
    for g, t in sorted(pairs):
        if g not in {x for x, _ in want} and t not in used:
            want.append((g, t))
            used.add(t)
    assert sorted(got) == want


def test_names_aligned(spark):
    df = spark.createDataFrame([(["Smith", "Jones", "Smith"], ["Jones", "Smlth"]), ([], ["x"])], "g array<string>, t array<string>")
    assert [r[0] for r in df.select(linkage.names_aligned(F.col("g"), F.col("t"))).collect()] == [2, 0]


def test_query_language(spark):
    df = spark.createDataFrame([(1, "Gold films", 1995), (2, "Silver", 2005), (3, None, None)], "id int, title string, year int")
    ids = lambda q: [r["id"] for r in query.search(df, q, {"title": "title", "year": "year"}).orderBy("id").collect()]
    assert ids("title:gold") == [1] and ids("title:(gold silver)") == [1, 2] and ids("gold silver") == [1, 2]
    assert ids("title:(gold films) AND year:[1990 TO 2000]") == [1] and ids("year:[* TO 2010]") == [1, 2]
    assert ids("title:*") == [1, 2] and ids("*") == [1, 2, 3] and ids("NOT title:gold") == [2, 3]
    assert ids('title:"gold films"') == [1] and ids("title:sil*") == [2] and ids("title:g?ld") == [1]
    assert query.search(df, "title:(gold films) year:1995", {"title": "title", "year": "year"}).first()["score"] == 3


def test_sampling(spark):
    df = spark.createDataFrame([(f"k{i:03d}", "ab"[i % 2], "xyz"[i % 3]) for i in range(120)], "id string, a string, b string")
    config = sampling.SampleConfig(size=20)
    first, again = (sorted(r["id"] for r in sampling.sample(df, "id", ["a", "b"], config).collect()) for _ in range(2))
    assert first == again and len(first) == 20 == len(set(first))
    p = sampling.pool(df, ["a", "b"])
    assert p.count() == 6 and p.agg(F.sum("n")).first()[0] == 120
    out = sampling.sample(df, "id", ["a"], config, excluded=df.where("id < 'k060'"))
    assert out.where("id < 'k060'").count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([("x", 7, 3, 1)], "k string, a int, s int, n int")
    r = metrics.recall_precision(df, "a", "s", "n").first()
    assert (r["R"], r["P"]) == (0.7, 0.88)
    assert spark.range(1).select(metrics.ratio(F.lit(1), F.lit(0))).first()[0] is None
    codes = ["OUI", "OUI_si_nettoie", "OUI_avec:x.OK", "NON_silence_vide", "NON_+court", "NON_bruit_captif", "NON_+long_tit_http", "NON_diff"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in codes], "c string").select(metrics.recode(F.col("c"))).collect()]
    assert got == ["F.aligne", "F.aligne", "F.maisOK", "F.silence", "F.silence", "F.bruit", "F.bruit", "F.les2"]


def test_lines(spark):
    a = spark.createDataFrame([([1, 2, 3, 4],)], "a array<int>")
    assert a.select(ln.forward_sums(F.col("a"), F.lit(2))).first()[0] == [3, 5, 7, 4]
    js = spark.createDataFrame([(1, [0, 0, 1, 9, 1, 2]), (2, [0, 5, 7, 9])], "k int, js array<int>").select("k", ln.checked(F.col("js")).alias("r")).orderBy("k").select("r.*").collect()
    assert tuple(js[0]) == (True, [0, 0, 1, 1, 1, 2]) and js[1]["ordered"] is False
    scores = spark.createDataFrame([("d", 0, 0, 9), ("d", 0, 1, 1), ("d", 1, 0, 3), ("d", 2, 1, 6)], "k string, i int, j int, score int")
    lines = spark.createDataFrame([("d", i, 2) for i in range(4)], "k string, i int, n_refs int")
    assert [r["j"] for r in ln.champions(scores, lines, "k").orderBy("i").collect()] == [0, 0, 1, None]
    assert ln.sequences(ln.champions(scores, lines, "k"), "k").first()["ordered"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 9), max_size=40), st.integers(1, 12))
def test_forward_sums(spark, values, span):
    df = spark.createDataFrame([(values,)], "a array<int>")
    sums = F.transform("a", lambda x, i: F.aggregate(F.slice("a", 1, i + 1), F.lit(0).cast("bigint"), lambda acc, y: acc + y))
    want = [sum(values[k : k + span]) for k in range(len(values))]
    assert [list(r) for r in df.select(ln.forward_sums(F.col("a"), F.lit(span)), ln.forward_sums(F.col("a"), F.lit(span), sums)).first()] == [want, want]


def test_champions_of_many_lines(spark):
    """More lines than are gathered at once."""
    n = ln.CHUNK * 2 + 7
    scores = spark.createDataFrame([("d", i, i // 2, 9) for i in range(n)], "k string, i int, j int, score int")
    lines = spark.createDataFrame([("d", i, n) for i in range(n)], "k string, i int, n_refs int")
    assert [(r["i"], r["j"]) for r in ln.champions(scores, lines, "k").orderBy("i").collect()] == [(i, i // 2) for i in range(n)]


def test_training_lines(spark):
    text = "Title\nSome prose here\nREFERENCES\nSmith A. Thin films of gold. J Mol 1999; 12: 33-44\nJones B. Silver grains growing. Phys 2001; 3: 1-9\n\nAppendix"
    docs = spark.createDataFrame([("d", text)], "doc_key string, text string")
    refs = spark.createDataFrame([("d", 0, "Smith Thin films of gold Mol 1999 12 33 44"), ("d", 1, "Jones Silver grains growing Phys 2001 3 1 9")], "doc_key string, j int, text string")
    got = {r["i"]: (r["zone"], r["j"]) for r in pipelines.training_lines(docs, refs).collect()}
    assert got[0] == ("body", None) and got[3] == ("listBibl", 0) and got[4] == ("listBibl", 1) and got[6] == ("end", None)


def test_projection():
    tagged, missing = projection.project("Smith J. Big titIe here. 1999; 12: 3", [("names", ["Smith"]), ("tit", ["Big title here"]), ("vol", ["12"]), ("lpg", ["99"])])
    assert tagged == '<author>Smith</author> J. <title level="a">Big titIe here</title>. 1999; <biblScope unit="vol">12</biblScope>: 3' and missing == ["lpg"]


def test_conversion(spark):
    xml = "<bib><snm>Smith</snm><atl>Gold &amp; films</atl><jtl>Nat</jtl><vid>3</vid><cd>1999</cd><ppf>1</ppf><ppl>9</ppl></bib>"
    rows = convert.convert(spark.createDataFrame([("d", "nature", xml)], "doc_key string, dialect string, xml string"))
    r = rows.first()
    assert (r["j"], r["vol"], r["fpg"], r["lpg"], r["names"], r["when"]) == ("Nat", "3", "1", "9", ["Smith"], None)
    assert "<surname>Smith</surname>" in convert.to_tei(rows).first()["bib"] and convert.to_tei(rows, flat=True).first()["bib"].startswith("<bibl>")


def test_sources(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('id\tv\nA\t___\nB\tx"y\n')
    assert [tuple(r) for r in tables.read_table(spark, str(tmp_path / "t.tsv"), null="___").orderBy("id").collect()] == [("A", None), ("B", 'x"y')]
    (tmp_path / "a.tsv").write_text("0022-2836\tJ Mol Biol\nbad row\n")
    assert [r["key"] for r in tables.abbreviations(spark, str(tmp_path / "a.tsv")).collect()] == ["j mol biol"]
    (tmp_path / "l.txt").write_text("a\fb\n\nc")
    assert [r["line"] for r in tables.read_lines(spark, str(tmp_path / "l.txt")).orderBy("i").collect()] == ["a", "b", "", "c"]
    (tmp_path / "p.json").write_text('{"f": {"a:1": 3, "a:2": 0}, "nr": 3, "nd": 3, "totd": 0}')
    assert {r["combo"]: r["n"] for r in tables.read_pool(spark, str(tmp_path / "p.json")).collect()} == {"a:1": 3, "a:2": 0}
    links = spark.createDataFrame([("x", 3), ("x", 3), ("y", None), ("z", 0)], "basename string, size int")
    assert sorted(str(r["skip"]) for r in tables.dataset_links(links).collect()) == ["None", "absent", "duplicate", "empty"]
    assert spark.createDataFrame([("<a><b/></a>",)], "x string").select(convert.publisher(F.col("x")), tei.root_path(F.col("x"))).first()[:] == ("unidentified", "a/b")


def test_sampler_outputs(spark):
    df = spark.createDataFrame([(f"k{i:02d}", "ab"[i % 2], i) for i in range(10)], "id string, a string, n int")
    chosen = df.where("n < 4")
    assert [r["id"] for r in sampling.sample_ids(chosen, "id", ["a"]).collect()] == ["k00", "k02", "k01", "k03"]
    assert [tuple(r) for r in sampling.sample_table(chosen, "id", ["a"], ["n"]).collect()][0] == ("k00", "a:a", 0)
    assert [r["xml"] for r in sampling.sample_documents(chosen, "id", ["a"], spark.createDataFrame([("k01", "x"), ("k00", "y")], "id string, xml string")).collect()] == ["y", "x"]
    assert [r["id"] for r in sampling.limited(df, "id", 3).collect()] == ["k00", "k01", "k02"] and sampling.limited(df, "id", test=True).count() == 3 and sampling.limited(df, "id").count() == 10
    assert sampling.quota_total(spark.createDataFrame([(2,), (3,)], "quota long")) == 5 and sampling.quota_total(spark.createDataFrame([], "quota long")) == 0
    with pytest.raises(ValueError, match="combinations"):
        sampling.BROADCAST_COMBOS, before = 5, sampling.BROADCAST_COMBOS
        try:
            sampling.pool(df, ["a", "n"])
        finally:
            sampling.BROADCAST_COMBOS = before


def test_search_tools(spark):
    df = spark.createDataFrame([(k, "gold" if k % 3 else "silver", "ab"[k % 2]) for k in range(12)], "id int, title string, kind string")
    assert query.count(df, "title:gold", {"title": "title"}) == 8
    assert {r["value"]: r["n"] for r in query.facet(df, "kind", "title:gold", {"title": "title"}).collect()} == {"a": 4, "b": 4}
    assert query.both("kind:a", None) == "kind:a" and query.both("kind:a", query.corpora_constraint(["x", "y"])) == "(kind:a) AND (refBibsNative:true AND (corpusName:x OR corpusName:y))"
    assert query.unknown_fields(["kind", "genre"], ["kind", "lang"]) == ["genre"]


def test_documents(spark):
    df = spark.createDataFrame([("a", "<!DOCTYPE x><a/>"), ("b", None), ("c", "<a>\ufffd</a>")], "doc_key string, xml string")
    assert tei.doctype_counts(df).first().asDict() == {"missing": 1, "undecodable": 1, "no_doctype": 1, "docs": 3}
    assert [r["doc_key"] for r in tei.listed(df, spark.createDataFrame([(" a ",), ("",), ("z",)], "value string")).collect()] == ["a"]
    path = spark.createDataFrame([("/x/" + "A1" * 20 + ".tei.xml",)], "p string")
    assert path.select(tei.document_id(F.col("p"), required=True)).first()[0] == "A1" * 20
    with pytest.raises(Exception, match="no document id"):
        spark.createDataFrame([("/x/y.xml",)], "p string").select(tei.document_id(F.col("p"), required=True)).collect()
    assert spark.range(1).select(tei.raw_text(F.lit("<t>out<p>in &lt;b&gt;</p></t>"), "p")).first()[0] == "in <b>"


def test_lines_of_refs(spark):
    grouped = spark.createDataFrame([("d", 0, "l0"), ("d", 1, "l1"), ("e", 0, "m0")], "k string, j int, lines string")
    refs = spark.createDataFrame([("d", 0, "r0"), ("d", 1, "r1"), ("e", 0, "s0")], "k string, j int, text string")
    assert ln.lines_of_refs(grouped, refs, "k").count() == 3 and [tuple(r) for r in ln.lines_of_refs(grouped, refs, "k", parity=True).collect()] == [("d", 0, "l0", "r0")]


def test_summary_is_appended(spark, tmp_path):
    row = spark.createDataFrame([(1, 2, "0.500", "err", 1, 0, 0, 1, "x")], ", ".join(f"{c} string" if c in ("R", "P", "eval_id") else f"{c} int" for c in evaluation.SUMMARY))
    evaluation.append_summary(row, str(tmp_path / "report"))
    evaluation.append_summary(row, str(tmp_path / "report"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()] == ["1\t2\t0.500\terr\t1\t0\t0\t1\tx"] * 2


def test_training_files(spark):
    rows = [("d", 0, "Title", "body", None), ("d", 1, "REFERENCES", "listBibl", None), ("d", 2, "1. Smith A & B", "listBibl", 0), ("d", 3, "Thin films 1999", "listBibl", 0), ("d", 4, "2. Jones", "listBibl", 1), ("d", 5, "end", "end", None)]
    marked = spark.createDataFrame(rows, "doc_key string, i int, line string, zone string, j int")
    text = lambda df: df.first()["text"]
    assert text(pipelines.training_file("zone", marked)) == "<text>Title<lb/>\n<listBibl>REFERENCES<lb/>\n1. Smith A &amp; B<lb/>\nThin films 1999<lb/>\n2. Jones</listBibl><lb/>\nend</text>"
    assert text(pipelines.training_file("lines", marked)) == "<listBibl>\n<bibl>1. Smith A &amp; B<lb/>Thin films 1999</bibl>\n<bibl>2. Jones</bibl>\n</listBibl>"
    tagged = spark.createDataFrame([("d", 1, "<author>Jones</author> x"), ("d", 0, "<author>Smith</author>, <author>Roe</author> <date>1999</date>")], "doc_key string, j int, tagged string")
    assert text(pipelines.training_file("fields", tagged)) == "<listBibl>\n<bibl><author>Smith</author>, <author>Roe</author> <date>1999</date></bibl>\n<bibl><author>Jones</author> x</bibl>\n</listBibl>"
    assert text(pipelines.training_file("names", tagged)) == "<listBibl>\n<author>Smith</author><author>Roe</author>\n<author>Jones</author>\n</listBibl>"
    with pytest.raises(ValueError, match="zone, lines, fields, names"):
        pipelines.training_file("other", marked)


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0.256, 3), ("b", None, 4)], "k string, r double, n int").coalesce(1)
    metrics.append_report(rows, str(tmp_path / "report"))
    metrics.append_report(rows.limit(1), str(tmp_path / "report"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()) == ["a\t0,26\t3", "a\t0,26\t3", "b\t\t4"]
    docs = spark.createDataFrame([("1.4",), ("data",), ("empty",), (None,)], "pdfver string")
    assert [r[0] for r in metrics.usable_documents(docs).collect()] == ["1.4"]


def test_corpora(spark, tmp_path):
    files = spark.createDataFrame([("/data/c1/A-pdfs/x.pdf",), ("/data/c1/B-xmlnatifs/x.xml",), ("/data/c1/B-xmlnatifs/y.xml",), ("/data/c1/other/z.txt",)], "path string")
    shelves = {"PDF0": ("A-pdfs", ".pdf"), "XMLN": ("B-xmlnatifs", ".xml")}
    found = tables.shelves_of_files(files, shelves)
    assert sorted(tuple(r) for r in found.select("corpus", "shelf", "basename").collect()) == [("c1", "PDF0", "x"), ("c1", "XMLN", "x"), ("c1", "XMLN", "y")]
    base, extra = spark.createDataFrame([("PDF0", "a"), ("XMLN", "b")], "shelf string, dir string"), spark.createDataFrame([("XMLN", "c"), ("TEI", "d")], "shelf string, dir string")
    assert sorted(tuple(r) for r in tables.overridden(base, extra, ["shelf"]).collect()) == [("PDF0", "a"), ("TEI", "d"), ("XMLN", "c")]
    tables.write_corpus(found, spark.createDataFrame([("c1", "gold")], "corpus string, kind string"), str(tmp_path / "corpus"))
    assert sorted(r["basename"] for r in spark.read.parquet(str(tmp_path / "corpus" / "basenames")).collect()) == ["x", "y"] and spark.read.parquet(str(tmp_path / "corpus" / "flags")).count() == 2
    assert {r["bad"] for r in tables.rejected(spark.createDataFrame([("0022-2836\tJ Mol",), ("bad row",), ("",)], "value string"), tables.ABBREVIATION_ROW).collect()} == {"bad row", ""}


def test_jobs(spark, tmp_path, capsys):
    from refloom import __main__ as cli

    docs = [("d1", "<article><front/><ref-list><ref id='a'><citation citation-type='journal'><article-title>Gold films</article-title><source>J Phys</source><year>1999</year></citation></ref></ref-list></article>"), ("d2", "<x/>")]
    spark.createDataFrame(docs, "doc_key string, xml string").write.parquet(str(tmp_path / "docs"))
    cli.main(["convert", "--docs", str(tmp_path / "docs"), "--out", str(tmp_path / "tei")])
    out = {r["doc_key"]: r["xml"] for r in spark.read.parquet(str(tmp_path / "tei")).collect()}
    assert set(out) == {"d1"} and tei.references(spark.createDataFrame(list(out.items()), "doc_key string, xml string")).count() == 1 and "Gold films" in out["d1"]
    cli.main(["evaluate", "--gold", str(tmp_path / "tei"), "--todo", str(tmp_path / "tei"), "--out", str(tmp_path / "eval"), "--id", "self"])
    # Its date is text only, which evaluation doesn't compare, so the reference isn't found again.
    assert sorted(r["match"] for r in spark.read.parquet(str(tmp_path / "eval" / "table")).collect()) == ["bruit", "silence"] and spark.read.text(str(tmp_path / "eval" / "report")).first()["value"].endswith("self")
    cli.main(["sample", "--docs", str(tmp_path / "docs"), "--key", "doc_key", "--criteria", "xml", "--size", "1", "--out", str(tmp_path / "sample")])
    assert spark.read.parquet(str(tmp_path / "sample" / "ids")).count() == 1
    with pytest.raises(SystemExit):
        cli.main(["unknown"])


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.xml").write_text(TEI)
    q = documents.run(documents.read_stream(spark, str(src)), lambda b: tei.references(b.withColumn("doc_key", F.col("path"))), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
