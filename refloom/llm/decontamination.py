"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.llm.columns import spare
from refloom.llm.durable import settle, small_batches
from refloom.llm.words import ALNUM, Words, split_words, word_chunks

WINDOW = 13
#: UTF-8 bytes of benchmark text in one search; a larger benchmark is searched in several rounds.
ROUND_BYTES = 8 << 20
#: Positions that one lane of the scan walks over.
LANE = 512
SHIFT_BITS = 18
#: Names of contaminated texts that are broadcast at most (64 bytes each); more are joined by a shuffle.
BROADCAST_TEXTS = 100_000


class Patterns:
    """Windows of benchmark items: Wu-Manber tables for each pattern length.

    Words are numbers (0: no word of any pattern). Blocks are pairs of words (one
    word for patterns of one word). shift[hash of block] is how far the scan may
    move on; 0 sends a place to the bucket of patterns that end in that block.
    """

    def __init__(self, items: list[tuple[int, str]]) -> None:
        texts = [(t or "").encode() for _, t in items]
        offsets = np.cumsum([0, *map(len, texts)])
        w = split_words(np.frombuffer(b"".join(texts), np.uint8), offsets, ALNUM)
        self.hashes, first, ids = np.unique(w.hashes, return_index=True, return_inverse=True)
        self.words = [b""] + [w.data[w.starts[k] : w.ends[k]].tobytes() for k in first]
        ids = ids + 1
        by_length: dict[int, dict[tuple, set[str]]] = {}
        for d, (item, _) in enumerate(items):
            own = ids[w.ptr[d] : w.ptr[d + 1]]
            size = min(len(own), WINDOW)
            for k in range(len(own) - size + 1 if size else 0):
                by_length.setdefault(size, {}).setdefault(tuple(own[k : k + size].tolist()), set()).add(str(item))
        self.tables = [self._table(size, windows) for size, windows in sorted(by_length.items())]

    @staticmethod
    def blocks(ids: np.ndarray, width: int) -> np.ndarray:
        """Hash of the block that ends at each place, from width - 1 on."""
        h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if width == 2:
            h = h[1:] * np.uint64(3) + h[:-1]
            h = h * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    def _table(self, size: int, windows: dict[tuple, set[str]]) -> dict:
        width = min(2, size)
        matrix = np.array(list(windows), np.int64)
        shift = np.full(1 << SHIFT_BITS, size - width + 1, np.int32)
        for end in range(width - 1, size):
            np.minimum.at(shift, self.blocks(matrix[:, end - width + 1 : end + 1].ravel(), width)[:: width] if width == 2 else self.blocks(matrix[:, end], 1), size - 1 - end)
        last = self.blocks(matrix[:, size - width :].ravel(), width)[::width] if width == 2 else self.blocks(matrix[:, -1], 1)
        by = np.argsort(last, kind="stable")
        return {"size": size, "width": width, "shift": shift, "suffix": last[by], "windows": matrix[by], "items": [sorted(list(windows.values())[k]) for k in by]}

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + 1, 0)

    def scan(self, ids: np.ndarray, ptr: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list[str]]]]:
        """(pattern length, last places, rows of its windows, items of a row) of all occurrences in documents ptr[d]:ptr[d + 1]."""
        for t in self.tables:
            size, width = t["size"], t["width"]
            first, end = ptr[:-1] + size - 1, ptr[1:]
            lanes = np.maximum(0, -((first - end) // LANE))
            doc = np.repeat(np.arange(len(first)), lanes)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
            at = first[doc] + nth * LANE
            stop = np.minimum(at + LANE, end[doc])
            hashed = np.concatenate([np.zeros(width - 1, np.int64), self.blocks(ids, width)]) if len(ids) else np.zeros(0, np.int64)
            found = []
            while len(at):
                move = t["shift"][hashed[at]]
                found.append(at[move == 0])
                at = at + np.maximum(move, 1)
                going = at < stop
                at, stop = at[going], stop[going]
            at = np.concatenate(found) if found else np.zeros(0, np.int64)
            lo, hi = (np.searchsorted(t["suffix"], hashed[at], side=s) for s in ("left", "right"))
            many = hi - lo
            rows = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            at = np.repeat(at, many)
            for back in range(size):  # direct comparison, from the end
                same = ids[at - back] == t["windows"][rows, size - 1 - back]
                at, rows = at[same], rows[same]
            yield size, at, rows, t["items"]


def hits(patterns: Patterns, w: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words of the documents lie inside occurrences, and the items that occur in a document."""
    ids = patterns.number(w.hashes)
    hit = np.zeros(len(ids) + 1, np.int64)
    found: dict[int, set[str]] = {}
    for size, at, row, names in patterns.scan(ids, w.ptr):
        places = np.unique((at[:, None] - np.arange(size)).ravel())
        true = np.array([w.data[w.starts[p] : w.ends[p]].tobytes() == patterns.words[ids[p]] for p in places], bool)
        if not true.all():  # a word shares its hash with another one
            bad = places[~true]
            ok = ~np.isin(at[:, None] - np.arange(size), bad).any(axis=1)
            at, row = at[ok], row[ok]
        np.add.at(hit, at - size + 1, 1)
        np.add.at(hit, at + 1, -1)
        pairs = np.unique(np.stack([np.searchsorted(w.ptr, at, side="right") - 1, row]), axis=1)
        for d, r in pairs.T.tolist():
            found.setdefault(d, set()).update(names[r])
    return np.cumsum(hit[:-1]) > 0, found


def _counts(patterns: Patterns, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Words, hit words and items of each text."""
    n_words, n_hit = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    items: list[list[str]] = [[]] * len(column)
    for i, j, w in word_chunks(column, ALNUM):
        n_words[i:j] = np.diff(w.ptr)
        inside, found = hits(patterns, w)
        up_to = np.concatenate([[0], np.cumsum(inside)])
        n_hit[i:j] = up_to[w.ptr[1:]] - up_to[w.ptr[:-1]]
        for d, names in found.items():
            items[i + d] = sorted(names)
    return n_words, n_hit, items


def _search(patterns: Patterns):
    """Counts and items of each row, whose other columns stay before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "text"]
            n_words, n_hit, items = _counts(patterns, batch["text"])
            yield pa.record_batch([*(batch[c] for c in kept), n_words, n_hit, pa.array(items, pa.list_(pa.string()))], names=[*kept, "n_words", "n_hit", "items"])

    return run


def _clean(patterns: Patterns, text: str):
    """The rows whose text isn't contaminated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit, _ = _counts(patterns, batch[text])
            yield batch.filter(pa.array((n_hit == 0) | (20 * n_hit < n_words)))

    return run


FOUND = "n_words long, n_hit long, items array<string>"


def _spans(patterns: Patterns):
    """(key, a, b, items): hit words of each text as intervals, the items with the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            keys = batch["key"].to_pylist()
            for i, _, w in word_chunks(batch["text"], ALNUM):
                inside, found = hits(patterns, w)
                for d, names in found.items():
                    edge = np.diff(np.concatenate([[0], inside[w.ptr[d] : w.ptr[d + 1]].astype(np.int8), [0]]))
                    for k, (x, y) in enumerate(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)):
                        out.append((keys[i + d], x, y, [] if k else sorted(names)))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["key", "a", "b", "items"])

    return run


def _in_rounds(texts: DataFrame, rounds: list[Patterns]) -> DataFrame:
    """key, n_hit and items of each distinct text (key, text) that is hit: the union of the rounds' intervals."""
    parts = [texts.mapInArrow(_spans(p), "key string, a long, b long, items array<string>").distinct() for p in rounds]
    spans = settle(reduce(DataFrame.union, parts))
    before = W.partitionBy("key").orderBy("a", "b").rowsBetween(W.unboundedPreceding, -1)
    new = F.greatest(F.col("b") - F.greatest(F.col("a"), F.coalesce(F.max("b").over(before), F.lit(0))), F.lit(0))
    n_hit = spans.select("key", new.alias("new")).groupBy("key").agg(F.sum("new").alias("n_hit"))
    named = spans.select("key", F.explode("items").alias("item")).groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return n_hit.join(named, "key")


def _rounds(benchmark: DataFrame, item_col: str, item_text: str, round_bytes: int) -> list[Patterns]:
    """The benchmark's windows, dealt by item into rounds of about round_bytes; its bytes are summed first."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = -(-size // round_bytes) or 1
    take = lambda k: [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k).orderBy("item_id", "text").toLocalIterator()]
    return [Patterns(take(k)) for k in range(rounds)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs.

    Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z
    became a-z. Null and empty texts have none, on either side: such a document has
    counts 0, such an item no window. Items of one text each count; an item's null
    id takes no part. The benchmark's bytes are summed first: up to round_bytes its
    tables go to every task, and no row is shuffled; beyond that its items are dealt
    into rounds of about round_bytes, and hit words are united by text, named by its
    SHA-256. An empty benchmark hits nothing. Repeated rows and null ids give a row
    each; other columns are not read.
    """
    rounds = _rounds(benchmark, item_col, item_text, round_bytes)
    src = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if len(rounds) == 1:
        rows = src.mapInArrow(_search(rounds[0]), "doc_id long, " + FOUND)
    else:
        keyed = src.select("doc_id", F.sha2("text", 256).alias("key"), "text")
        counted = keyed.mapInArrow(_search(Patterns([])), "doc_id long, key string, " + FOUND).drop("n_hit", "items")
        found = _in_rounds(keyed.select("key", "text"), rounds)
        rows = counted.join(found, "key", "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """The rows of docs whose own text isn't contaminated, all columns as they were.

    Each row is judged by its text alone, whatever its id and however often that
    occurs; null and empty texts stay. An empty benchmark keeps all.
    """
    rounds = _rounds(benchmark, item_col, item_text, round_bytes)
    if len(rounds) == 1:
        return small_batches(docs).mapInArrow(_clean(rounds[0], text_col), docs.schema)
    (key,) = spare(docs, "key")
    texts = small_batches(docs).select(F.sha2(F.col(text_col), 256).alias("key"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    words = texts.mapInArrow(_search(Patterns([])), "key string, " + FOUND).groupBy("key").agg(F.max("n_words").alias("n_words"))
    bad = settle(_in_rounds(texts, rounds).join(words, "key").where(F.col("n_hit") * 20 >= F.col("n_words")).select(F.col("key").alias(key)))
    kept = docs.withColumn(key, F.sha2(F.col(text_col), 256)).join(F.broadcast(bad) if bad.count() <= BROADCAST_TEXTS else bad, key, "left_anti")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def items_digest(items: list[int]) -> str:
    """The digest of a set of item ids, as in items_sha256."""
    return hashlib.sha256(",".join(sorted(str(x) for x in set(items))).encode()).hexdigest()
