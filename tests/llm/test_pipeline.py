"""The pipeline's stages in order, against brute-force versions of what each keeps."""

import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from refloom.llm import decontamination, line_dedup, toxicity
from test_corpus_operators import BLANK_RE, brute_components, brute_hits, key, lower


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    item = prose(40)
    rows, labels = [], []
    for k in range(400):
        bad = k % 5 == 0
        rows.append((k, f"Site menu\n{prose(60)}{' grimble snarf' * bad}", "en", "src0" if k % 3 else "src1", 0))
        labels.append((k, 1, int(bad)))
    rows += [(1000, rows[1][1], "en", "src0", 0), (1001, rows[1][1] + " x", "en", "src1", 0), (1002, f"{prose(20)} {item}", "en", "src0", 0), (1003, None, None, None, None), (1004, "", "en", "src0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        kept.append({r["doc_id"]: r for r in docs.collect()})
    clean = {k for k in range(400) if k % 5}
    assert len(clean - set(kept[0])) <= 4 and len({k for k in range(0, 400, 5)} & set(kept[0])) <= 4 and {1000, 1001, 1002, 1003, 1004} <= set(kept[0])
    assert set(kept[1]) == set(kept[0]) and not kept[1][1]["text"].startswith("Site menu") and kept[1][1]["n_chars"] == len(kept[1][1]["text"])
    assert set(kept[1]) - set(kept[2]) == {1000, 1001}
    assert set(kept[2]) - set(kept[3]) == {1002}
    assert set(kept[4]) == set(kept[3]) and all(r["taken"] <= 2 * r["size"] for r in kept[4].values())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept[4])
    assert toxicity.THRESHOLD == 0.3 and decontamination.WINDOW == 13


#: Names that operators use or could use for columns of their own.
CLASHES = ("key", "keys", "site", "none", "frame", "kept", "_fp", "n_lines", "n_dropped", "size", "score", "hot", "node", "row", "upto")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def brute_lines(rows):
    """(doc_id, text) after the line stage, by source."""
    blank = " \t\n\x0b\x0c\r"
    pages, seen = Counter(r["source"] for r in rows), Counter()
    for r in rows:
        for line in {x.strip(blank) for x in (r["text"] or "").split("\n")} - {""}:
            seen[r["source"], line] += 1
    out = []
    for r in rows:
        text = r["text"]
        if text is not None:
            often = lambda x, s=r["source"]: seen[s, x.strip(blank)] >= line_dedup.LEAST_PAGES and seen[s, x.strip(blank)] > line_dedup.RATIO * pages[s]
            kept = [x for x in text.split("\n") if not often(x)]
            text = "\n".join(kept) if any(x.strip(blank) for x in kept) else text
        out.append((r["doc_id"], text))
    return out


def brute_copies(rows):
    """(doc_id, words of the text) that stay of each group of near copies, as sets to choose one from."""
    groups, bare = {}, Counter()
    # Components by the index of their first row, so that null ids tell groups apart too.
    marked = brute_components([(k, r["text"]) for k, r in enumerate(rows)])
    for r, (_, n, group) in zip(rows, marked, strict=True):
        if n == 0:
            bare[r["doc_id"]] = 1 if r["doc_id"] is not None else bare[r["doc_id"]] + 1
        else:
            groups.setdefault(group, []).append(r)
    out = []
    for own in groups.values():
        ids = [r["doc_id"] for r in own if r["doc_id"] is not None]
        out.append({(min(ids, default=None), r["text"]) for r in own if r["doc_id"] == min(ids, default=None)})
    return out, bare


def test_stages_on_odd_rows(spark, tmp_path):
    """Each stage against brute force on its own input: repeated ids of equal and of other texts, null ids, texts and sources, and names that clash."""
    rng = random.Random(2)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    item, a, b, c = prose(40), prose(50), prose(50), prose(50)
    bad = lambda: f"{prose(40)} grimble snarf {prose(5)}"
    rows, labels = [], []
    for k in range(300):
        rows.append((k, f"Menu here\n{bad() if k % 5 == 0 else prose(40)}", "src0" if k % 3 else None))
        labels.append((k, int(k % 5 == 0)))
    rows += [(403, a, "s1"), (407, b, "s1"), (407, a, "s1"), (409, b + " x", "s1"), (403, a, "s1"), (403, a, "s1"), (410, c, "s1"), (410, f"{prose(10)} {item}", "s1"), (410, bad(), "s1"), (None, a, "s1"), (None, c + " y", "s2"), (None, prose(30), "s2")]
    rows += [(None, t := prose(30), "s2"), (None, t, "s2"), (None, f"{item} tail", "s2"), (None, bad(), "s2"), (411, None, None), (411, None, None), (None, None, "s1"), (None, "", "s1"), (412, "", "s1"), (412, " \n ", "s1"), (413, "x" * 200_000 + " end of it", "s2")]
    docs = spark.createDataFrame([(i, t, None, s, len(t or ""), *["v"] * len(CLASHES)) for i, t, s in rows], SCHEMA).repartition(5)
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    steps = [docs.collect()]
    for k, name in enumerate(stages):
        before = spark.read.parquet(str(tmp_path / (f"s{k - 1}" if k else "documents.parquet")))
        stages[name](spark, before, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        after = spark.read.parquet(str(tmp_path / f"s{k}"))
        if k < 4:
            assert after.dtypes == docs.dtypes and after.where(" or ".join(f"`{x}` <> 'v' or `{x}` is null" for x in CLASHES)).count() == 0
        steps.append(after.collect())
    texts = lambda rs: key([(r["doc_id"], r["text"]) for r in rs])

    numbered = spark.createDataFrame([(k, r["text"]) for k, r in enumerate(steps[0])], "doc_id long, text string")
    verdict = dict(zip([r["text"] for r in steps[0]], scored(spark, docs, numbered, tmp_path), strict=True))
    assert texts(steps[1]) == texts([r for r in steps[0] if not verdict[r["text"]]])
    assert sum(verdict.values()) > 50 and not verdict[""] and not verdict[None]

    assert texts(steps[2]) == key(brute_lines(steps[1])) and any(a != b for a, b in zip(texts(steps[1]), texts(steps[2]), strict=True))

    groups, bare = brute_copies(steps[2])
    left = Counter((r["doc_id"], r["text"]) for r in steps[3])
    assert Counter(r["doc_id"] for r in steps[3] if not BLANK_RE.findall(lower(r["text"]))) == bare
    worded = [x for x in left.elements() if BLANK_RE.findall(lower(x[1]))]
    assert len(worded) == len(groups) and all(sum(x in g for x in worded) == 1 for g in groups)
    assert {(407, b), (403, a)} <= set(worded)

    items = [(1, item), (2, None)]
    assert texts(steps[4]) == texts([r for r in steps[3] if not brute_hits(r["text"], items)[4]]) and len(steps[4]) < len(steps[3])

    assert key([(r["doc_id"], r["size"]) for r in steps[5]]) == key([(r["doc_id"], len(BLANK_RE.findall(lower(r["text"])))) for r in steps[4]])
    by = Counter()
    for r in steps[5]:
        by[r["source"], r["target"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(n - target) < 1.001 for (_, target), n in by.items())


def scored(spark, docs, rows, tmp_path):
    """What the model that docs train predicts of each row in order."""
    model = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(str(tmp_path / "labels.parquet")))
    out = rows.mapInArrow(toxicity._score(*model), "doc_id long, score double")
    return [r["predicted"] for r in out.orderBy("doc_id").select((F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")).collect()]


def test_stages_of_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    some = spark.createDataFrame([(1, "a text", None, "s", 6, *["v"] * len(CLASHES))], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, some, str(tmp_path)).count() == 1
