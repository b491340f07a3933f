"""Line dedup by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.columns import spare
from refloom.llm.durable import settle

RATIO = 0.1
LEAST_PAGES = 3
#: Line keys of all sites that are broadcast at most (about 16 bytes each); more are joined by a shuffle.
BROADCAST_LINES = 1_000_000


def _key(line: Column) -> Column:
    """Key of a line: without blanks at its ends; null for a blank line."""
    bare = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return F.when(F.length(bare) > 0, F.xxhash64(bare))


def line_dedup(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, whole_copies: bool = False, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """docs with boilerplate lines taken out of text, and long columns, named by counts, of a text's lines and dropped lines.

    A line is boilerplate on a site if more than ratio of the site's pages (rows),
    and at least least_pages, contain it, ends trimmed. Blank lines stay. With
    whole_copies a page on which every line that isn't blank is boilerplate counts as
    a copy, which other operators reduce, and stays whole. A null text stays null and
    counts as a page, with no line; rows of a null site are one site; an empty text
    has one (blank) line. All other columns are kept, whatever their names (those of
    counts are replaced). No text is shuffled: lines are counted by hash,
    combined before the shuffle, and each site's boilerplate (at most mean lines a
    page / ratio) comes back as one array.
    """
    base = docs.drop(*counts)
    s_at, s_none, s_frame, s_kept = spare(base, "site", "none", "frame", "kept")
    lines = F.split(F.col(f"`{text}`"), "\n")
    at, missing = F.coalesce(F.col(f"`{site}`").cast("string"), F.lit("")), F.col(f"`{site}`").isNull()
    pages = base.select(at.alias("site"), missing.alias("none"), F.array_distinct(F.array_compact(F.transform(lines, _key))).alias("keys"))
    totals = pages.groupBy("site", "none").agg(F.count("*").alias("pages"))
    seen = pages.select("site", "none", F.explode("keys").alias("key")).groupBy("site", "none", "key").agg(F.count("*").alias("k")).where(F.col("k") >= least_pages)
    often = settle(seen.join(totals, ["site", "none"]).where(F.col("k") > F.col("pages") * F.lit(ratio)).select("site", "none", "key"))
    frames = often.groupBy(F.col("site").alias(s_at), F.col("none").alias(s_none)).agg(F.array_sort(F.collect_set("key")).alias(s_frame))
    out = base.withColumns({s_at: at, s_none: missing})
    out = out.join(F.broadcast(frames) if often.count() <= BROADCAST_LINES else frames, [s_at, s_none], "left")
    hit = lambda line: F.coalesce(F.array_contains(F.col(s_frame), _key(line)), F.lit(False))
    out = out.withColumn(s_kept, F.when(F.col(s_frame).isNull(), lines).otherwise(F.filter(lines, lambda x: ~hit(x))))
    drop = F.coalesce(F.size(s_kept) < F.size(lines), F.lit(False))
    if whole_copies:
        drop = drop & F.exists(s_kept, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    new = {counts[1]: F.when(drop, F.size(lines) - F.size(s_kept)).otherwise(0).cast("long"), text: F.when(drop, F.array_join(s_kept, "\n")).otherwise(F.col(f"`{text}`"))}
    new[counts[0]] = F.when(F.col(f"`{text}`").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    return out.select(*[new[c].alias(c) if c == text else F.col(f"`{c}`") for c in base.columns], *(new[c].alias(c) for c in counts))
