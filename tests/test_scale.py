"""What lets queries grow with their input: one pass where pairs, parses or joins were made, and the same results as the plain forms."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from refloom.functions import text as tx
from refloom.operators import linkage
from refloom.plans import catalogue
from refloom.sources import tables, tei

SMALL = "/root/testdata/sf0.001"
REFERENCE = "doc_key string, {} int, tit string, date string, j string, vol string, fpg string, names array<string>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_match_keys_are_those_of_columns(spark):
    rnd = random.Random(5)
    letters = "nrtifüoOøC)1IlftyeSERu][3éöçæﬁﬃſİKÅß \n-abXZ\u009c0^—"
    values = ["".join(rnd.choices(letters, k=rnd.randint(0, 12))) for _ in range(3000)] + ["", "\n", "a\nb"]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string").select("k", tx.match_key(F.col("v")).alias("key")).orderBy("k").collect()
    assert tx.match_keys(values) == [r["key"] for r in rows]
    assert tx.match_keys([]) == [] and tx.match_keys([""]) == [""] and tx.match_keys(["a\nb", "c"]) == ["ab", "c"]


def odd_references(rnd, name):
    some = lambda *x: rnd.choice([*x, None])
    title = lambda: some("", "a", "Thin films of gold", "Thin fi1ms 0f g0ld", "of gold", "films of gold and silver", "Rnodern times", "Modern times", "ﬁnal — words", "x" * 30, "x" * 25)
    row = lambda doc, k: (doc, k, title(), some("2001", "2001", "2002"), title(), some("1", "2"), some("10", "11"), some([], ["Miller"], ["Mi11er", "B"], [None, "B"], ["Z"]))
    return [row(rnd.choice(["d", "d", "e", "only " + name, None]), rnd.randint(0, 12)) for _ in range(40)]


@pytest.mark.parametrize("compare_dates", [False, True])
def test_alignment_is_greedy_over_all_candidates(spark, compare_dates):
    rnd = random.Random(7 + compare_dates)
    g, t = (odd_references(rnd, k) for k in "gt")
    g, t = spark.createDataFrame(g, REFERENCE.format("g")), spark.createDataFrame(t, REFERENCE.format("t"))
    want = sorted(tuple(r) for r in linkage.greedy(linkage.candidates(g, t, compare_dates=compare_dates)).collect())
    assert sorted(tuple(r) for r in linkage.paired(g, t, compare_dates=compare_dates).collect()) == want and want
    rows = linkage.align(g, t, compare_dates=compare_dates).collect()
    assert sorted((r["doc_key"], r["g"], r["t"], r["rule"]) for r in rows if r["alignment"] == "ali") == want
    ids = lambda df, k, n: sorted((r[0], r[1]) for r in df.where("doc_key in ('d', 'e')").select("doc_key", k).collect() if (r[0], r[1]) not in {(w[0], w[n]) for w in want})
    for name, df, k, n in (("silence", g, "g", 1), ("noise", t, "t", 2)):
        assert sorted((r["doc_key"], r[k]) for r in rows if r["alignment"] == name) == ids(df, k, n)


def test_documents_stay_whole_over_batches(spark):
    rows = [(f"d{k % 7}", k, f"Title number {k}", "2001", "J", str(k), "1", [str(k)]) for k in range(200)]
    g, t = spark.createDataFrame(rows, REFERENCE.format("g")), spark.createDataFrame(rows, REFERENCE.format("t"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 3, 58, 10000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            assert sorted((r["g"], r["t"]) for r in linkage.align(g, t).collect()) == [(k, k) for k in range(200)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("name", ["greedy_align", "rule_breakdown", "global_counters", "field_diagnosis"])
def test_alignment_joins_nothing(spark, name):
    assert "Join" not in plan(catalogue.QUERIES[name](spark, SMALL))


def test_languages_are_the_only_join(spark):
    assert plan(catalogue.recall_precision_by_language(spark, SMALL)).count("Join") == 1


def plain_sides(docs):
    """The references of catalogue's documents by columns, as two tables."""
    rows = tables.explode_lines(docs, "doc_key", "text").where("line <> ''")
    gold = rows.selectExpr("doc_key", "i g", "line tit", "'2001' date", "line j", "string(length(line)) vol", "string(i) fpg", "slice(split(line, ' '), 1, 1) names")
    seen = rows.where("length(line) >= 20").selectExpr("*", "translate(line, 'lo', '10') noisy", "length(line) > 400 cut")
    first = seen.selectExpr("doc_key", "i * 2 t", "if(cut, substring(noisy, 1, 400), noisy) tit", "'2001' date", "noisy j", "if(cut, '0', string(length(line))) vol", "string(i) fpg", "slice(split(noisy, ' '), 1, 1) names")
    second = seen.where("cut").selectExpr("doc_key", "i * 2 + 1 t", "substring(noisy, 401) tit", "'2001' date", "'' j", "'0' vol", "string(i) fpg", "array('x') names")
    return gold, first.unionByName(second)


def odd_texts(rnd):
    words = ["Gold", "films", "of", "rnodern", "Modern", "times", "l", "o", "", "ﬁnal", "é\u2029x", "𝔸", "x" * 90]
    line = lambda: " ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 6, 60])))
    texts = ["".join(line() + rnd.choice("\n\f\r") for _ in range(rnd.randint(0, 9))) for _ in range(60)]
    return [(rnd.choice([k, k, k // 4, None]), x) for k, x in enumerate([*texts, None, "", "\n", "short", "a line of twenty cha", "y" * 401])]


def test_documents_that_hold_both_sides_align_as_tables(spark, tmp_path):
    docs = spark.createDataFrame(odd_texts(random.Random(11)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    g, t = plain_sides(docs.withColumnRenamed("doc_id", "doc_key"))
    told = lambda df: sorted(map(str, df.select("doc_key", "g", "t", "alignment", "rule").collect()))
    want = linkage.align(g, t)
    assert told(catalogue.greedy_align(spark, str(tmp_path))) == told(want) and want.where("rule = 1").count() and want.where("alignment = 'noise'").count()
    fields = ("tit", "date", "j", "vol", "fpg")
    once = docs.groupBy("doc_id").count().where("count = 1").selectExpr("doc_id doc_key")
    pairs = lambda df: sorted(map(str, df.join(once, "doc_key", "left_semi").collect()))
    got = catalogue._aligned(spark, str(tmp_path), alone=False, fields=fields).drop("alignment")
    assert pairs(got) == pairs(linkage.paired(g, t, fields=fields)) and pairs(got)


@pytest.mark.parametrize("portion", [1, 1000])
def test_portions_lose_no_reference(spark, monkeypatch, portion):
    texts = pa.record_batch({"k": pa.array([1, 1, 2, 3, 3, 4]), "text": pa.array(["Thin films of rnodern gold", "Other lines of gold and more", None, "Thin films of gold or not", "", "short"])})
    run = lambda: [r for b in linkage._meet_within("k", ["text"], catalogue._references, False, (), True)(iter([texts.slice(0, 1), texts.slice(1)])) for r in b.to_pylist()]
    want = run()
    monkeypatch.setattr(linkage, "PORTION", portion)
    assert run() == want and [(r["k"], r["alignment"]) for r in want] == [(1, "ali"), (3, "ali")]


@pytest.mark.parametrize("name", ["recall_precision_by_language", "greedy_align", "field_diagnosis", "rule_breakdown", "global_counters"])
def test_lines_are_made_where_they_meet(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SMALL))
    assert "Generate" not in text and "Union" not in text


def test_keys_are_looked_up_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(tx, "_BLOCK", 7)
    rnd = random.Random(6)
    values = ["".join(rnd.choices("nnrtifC)[3] üéßoO0-\0A", k=rnd.randint(0, 40))) for _ in range(2000)] + ["n" * 50, "rn" + "n" * 51, "n" * 8 + "rn"]
    assert tx._fast_keys("\n".join(values).encode()) is not None and tx._fast_keys("ﬁ".encode()) is None
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string").select("k", tx.match_key(F.col("v")).alias("key")).orderBy("k").collect()
    assert tx.match_keys(values) == [r["key"] for r in rows]


def test_comparers_are_their_steps():
    rnd = random.Random(3)
    letters = "nrtifüoOøC)1IlyeSERu][3éöçæﬁ '`\"-‐—«»‹›“’¯\t\n\u0092\u00a0\u200b\ufeff\u2029 ab -"
    plain = ((tx.ocr_eval_text, tx.OCR_EVAL), (tx.even_spaces_text, tx.SPACE_STEPS_EVAL), (tx.even_punctuation_text, tx.PUNCT_STEPS), (tx.simple_punctuation_text, tx.SIMPLE_PUNCT_STEPS))
    for value in ("".join(rnd.choices(letters, k=rnd.randint(0, 14))) for _ in range(5000)):
        for fast, steps in plain:
            assert fast(value) == tx.python(value, steps)


def test_equal_pairs_are_diagnosed_once_for_all_fields(spark):
    row = ("Long enough", "Long enough http://x", "Long enough", "Long enough http://x", None, "x")
    rows = spark.createDataFrame([(1, *row)], "k int, " + ", ".join(f"{k}_{f} string" for f in ("tit", "j", "vol") for k in "gt"))
    out = linkage.diagnose(rows, ["k"], ("tit", "j", "vol"), dealt=True)
    assert tuple(out.first()) == (1, "NON_+long_tit_http", "NON_diff", "NON_bruit")
    assert plan(out).count("ArrowEvalPython") == 1 and "Exchange" not in plan(out)


ODD_BIBS = [
    '<biblStruct xml:id="b0"><analytic><title>No level</title><title level="a">Thin <hi>films</hi> of<x/> gold</title><author><persName><surname>Smith</surname><forename>A</forename></persName></author></analytic></biblStruct>',
    '<biblStruct><analytic><title level="a"/><title level="a">second</title></analytic><monogr><title level="m">Book</title><title level="j">J</title><title level="j">K</title></monogr></biblStruct>',
    '<biblStruct><monogr><title level="m">B &amp; C</title><imprint><date when=""/><date>1999</date><date when="2001-02-03"/><biblScope unit="volume">3</biblScope><biblScope unit="vol"/><biblScope unit="pp" from="1" to="9"/><biblScope unit="page">5</biblScope></imprint></monogr></biblStruct>',
    '<biblStruct><monogr><imprint><date>x</date><date when="12345"/><biblScope unit="vol">1</biblScope><biblScope unit="volume">2</biblScope><biblScope unit="iss">7</biblScope><biblScope unit="page" from="" to="4"/><biblScope unit="pp" from="8"/><publisher>P<i>Q</i></publisher></imprint></monogr></biblStruct>',
    "<biblStruct><surname>S<i>y</i>Q</surname><c><surname/><surname> </surname><surname>é&#233;\r\nz</surname></c><analytic/><analytic><title>T</title></analytic></biblStruct>",
    "<biblStruct><surname>a<!-- c -->b<?pi x?>c<![CDATA[d]]></surname><analytic><title><![CDATA[<q>]]></title></analytic></biblStruct>",
    "<biblStruct><surname>out<surname>in</surname>after</surname></biblStruct>",
    '<biblStruct xmlns="u" xmlns:t="v"><t:analytic><title t:level="a">N</title></t:analytic></biblStruct>',
    '<biblStruct><t:analytic><title level="a">unbound</title></t:analytic><monogr t:x="1"/></biblStruct>',
    "<other><analytic><title>T</title></analytic><surname>S</surname></other>", "<biblStruct/>", "", None,
]


def test_references_are_read_as_xpath_reads_them(spark, monkeypatch):
    bibs = spark.createDataFrame([("d", f"b{k}", x) for k, x in enumerate(ODD_BIBS)], "doc_key string, bib_id string, bib string")
    got = {r["bib_id"]: r for r in tei.canonical_fields(bibs).collect()}
    assert sum(tei._read(x) is not None for x in ODD_BIBS) == 7

    def xpath_alone(given: pa.Array) -> pa.Array:
        none = [None] * len(given)
        return pa.StructArray.from_arrays([*[pa.array(none, pa.string())] * 8, pa.array(none, pa.list_(pa.string())), pa.array([False] * len(given))], names=[*tei._READ, "names", "plain"])

    monkeypatch.setattr(tei, "_read_all", xpath_alone)
    want = {r["bib_id"]: r for r in tei.canonical_fields(bibs).collect()}
    assert got == want
    assert got["b0"]["tit"] == "Thin films of gold" and got["b2"]["date"] is None and got["b4"]["names"] == ["S", "Q", " ", "éé\nz"]


def test_malformed_references_fail_as_before(spark):
    bibs = spark.createDataFrame([("d", "b", "<biblStruct><a></biblStruct>")], "doc_key string, bib_id string, bib string")
    with pytest.raises(Exception, match="SAXParseException|biblStruct"):
        tei.canonical_fields(bibs).collect()


def test_references_are_parsed_once(spark):
    assert plan(catalogue.tei_canonical_fields(spark, SMALL)).count("ArrowEvalPython") == 1


def test_keys_of_lines_are_made_by_batch(spark):
    values = ["Thin ﬁlms of gold", "", None, "a\nb", "é" * 3, "𝔸 rnn", "--"]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    got = tx.with_match_key(rows, "v", "key", "n").orderBy("k").collect()
    assert got == rows.select("k", tx.match_key(F.col("v")).alias("key"), F.length("v").alias("n")).orderBy("k").collect()
    text = plan(catalogue.soft_equal_pairs(spark, SMALL))
    assert text.count("MapInArrow") == 1 and "line#" not in text.split("MapInArrow")[0]
