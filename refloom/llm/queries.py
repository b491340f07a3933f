"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm.ann import nearest_neighbours
from refloom.llm.decontamination import decontaminate
from refloom.llm.html_text import extract_text
from refloom.llm.licenses import license_scan
from refloom.llm.line_dedup import line_dedup
from refloom.llm.mixing import mix_sources
from refloom.llm.ngram_join import ngram_jaccard_join
from refloom.llm.secrets import secret_scan
from refloom.llm.toxicity import toxicity
from refloom.llm.url_filter import url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_ngram_jaccard_join, op3_secret_scan, op4_line_dedup, op5_url_filter, op6_decontamination, op7_html_text, op8_toxicity, op9_nearest_neighbours, op10_source_mix)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op2_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
        sets AS (SELECT min(doc_id) AS rep, any_value(sh) AS sh, len(any_value(sh)) AS n FROM s WHERE len(sh) > 0 GROUP BY list_sort(sh)),
        t AS (SELECT rep, n, unnest(sh) AS g FROM sets),
        inter AS (SELECT a.rep AS x, b.rep AS y, a.n AS nx, b.n AS ny, count(*) AS i FROM t a JOIN t b ON a.g = b.g AND a.rep < b.rep GROUP BY ALL),
        e AS (SELECT x, y FROM inter WHERE 100 * i >= 80 * (nx + ny - i)),
        both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
        reach(a, b) AS (SELECT rep, rep FROM sets UNION SELECT r.a, k.y FROM reach r JOIN both_ways k ON r.b = k.x),
        comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a),
        named AS (SELECT list_sort(sets.sh) AS sh, component_id FROM sets JOIN comp USING (rep))
        SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(named.component_id, s.doc_id) AS component_id FROM s LEFT JOIN named ON list_sort(s.sh) = named.sh""",
    "op4_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
        l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d WHERE text IS NOT NULL),
        k AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare FROM l),
        total AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
        often AS (SELECT k.source, bare FROM k JOIN total ON k.source IS NOT DISTINCT FROM total.source WHERE bare <> '' GROUP BY k.source, bare, pages HAVING count(DISTINCT r) >= 3 AND count(DISTINCT r) > pages * 0.1),
        m AS (SELECT k.*, often.bare IS NOT NULL AS frame FROM k LEFT JOIN often ON k.source IS NOT DISTINCT FROM often.source AND k.bare = often.bare),
        g AS (SELECT r, count(*) AS n, count(*) FILTER (frame) AS f, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT frame) AS kept FROM m GROUP BY r)
        SELECT doc_id, source, CASE WHEN f > 0 THEN coalesce(kept, '') ELSE text END AS text, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(f, 0) AS BIGINT) AS n_dropped FROM d LEFT JOIN g USING (r)""",
    "op6_decontamination": f"""
        WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
        bw AS (SELECT DISTINCT item_id, least(len(ws), 13) AS k, unnest(list_transform(range(1, len(ws) - least(len(ws), 13) + 2), lambda i: array_to_string(ws[i:i + least(len(ws), 13) - 1], ' '))) AS win FROM b WHERE len(ws) > 0),
        ks AS (SELECT DISTINCT k FROM bw),
        dw AS (SELECT r, k, unnest(range(1, len(ws) - k + 2)) AS p, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS win FROM w, ks WHERE len(ws) >= k),
        o AS (SELECT r, p, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
        h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM o) GROUP BY r),
        i AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM o) GROUP BY r)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM w LEFT JOIN h USING (r) LEFT JOIN i USING (r)""",
    "op9_nearest_neighbours": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op10_source_mix": r"""
        WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
        l AS (SELECT *, source_size * 2.0::DOUBLE AS cap,
                (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS water FROM w),
        lv AS (SELECT coalesce((SELECT water FROM l WHERE water * weight <= cap ORDER BY cap / weight LIMIT 1), 0) AS level),
        t AS (SELECT source, source_size, least(cap, level * weight) AS target FROM l, lv),
        o AS (SELECT d.doc_id, d.size, t.source_size, t.target,
                CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        e AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS rounds FROM o)
        SELECT doc_id, size, source_size, target, CAST(rounds * size + greatest(0, least(budget - rounds * source_size - ahead, size)) AS BIGINT) AS taken FROM e""",
}
