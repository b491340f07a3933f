"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.llm.durable import settle, small_batches
from refloom.llm.words import ALNUM, Words, combine, hash_words, word_chunks

#: Labelled rows that are learnt from, at most (those of the least hash), and distinct features of each, at most that many bytes in all.
TRAIN_ROWS = 12_000
#: Bytes of their texts, at most: rows come by their hash until these are spent.
TRAIN_BYTES = 64 << 20
BITS = 22
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.15, 1.0, 2.0, 0.5
THRESHOLD = 0.3
#: Bytes of a word's start that stand for its stem.
STEMS = (4, 5)
_GAP = 0x5851F42D4C957F2D


def _times(a: int, b: int) -> np.uint64:
    """Product modulo 2**64."""
    return np.uint64(a * b % 2**64)


def slots(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first words' places, slots) of all words, their stems, pairs of neighbours, and pairs with one word between, within documents."""
    hashes, ptr = w.hashes, w.ptr
    shift = np.uint64(64 - BITS)
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    out = [(np.arange(len(hashes)), (combine([hashes]) >> shift).astype(np.int64))]
    for size in STEMS:
        stem = hash_words(w.data, w.starts, np.minimum(w.ends, w.starts + size))
        out.append((out[0][0], (combine([stem ^ _times(_GAP, size + 16)]) >> shift).astype(np.int64)))
    for gap in (1, 2):
        if len(hashes) > gap:
            at = np.flatnonzero(doc[:-gap] == doc[gap:])
            pair = combine([hashes[at], hashes[at + gap] ^ _times(_GAP, gap)])
            out.append((at, (pair >> shift).astype(np.int64)))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, w in word_chunks(batch["text"], ALNUM):
            all_slots = slots(w)
            docs = [np.searchsorted(at, w.ptr) for at, _ in all_slots]
            rows = [np.unique(np.concatenate([s[p[d] : p[d + 1]] for (_, s), p in zip(all_slots, docs, strict=True)])).astype(np.int32).tobytes() for d in range(j - i)]
            yield pa.record_batch([batch["doc_id"][i:j].cast(pa.int64()), batch["toxic"][i:j].cast(pa.int32()), pa.array(rows, pa.binary())], names=["doc_id", "toxic", "slots"])


class Ftrl:
    """Per-coordinate FTRL-proximal; weights exist only where the gradients' sum outgrows L1.

    The bias is the rate of toxic rows and isn't learnt, so that a text without known slots scores that rate.
    """

    def __init__(self, rate: float) -> None:
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias = float(np.log(rate / (1 - rate)))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias, -35, 35))) - y
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown


def _train(key: tuple, table: pa.Table) -> pa.Table:
    """Learn from all rows of the (bounded) sample, in the order of a hash of their ids; returns the weights, slot -1 being the bias."""
    ids, toxic = table["doc_id"].to_pylist(), table["toxic"].to_pylist()
    rows = [np.frombuffer(x.as_buffer(), np.int32) for x in table["slots"]]  # views, no copies
    model = Ftrl((sum(toxic) + 0.5) / (len(toxic) + 1))
    for epoch in range(EPOCHS):
        for k in sorted(range(len(ids)), key=lambda k: (zlib.crc32(f"{epoch}:{ids[k]}".encode()), ids[k], len(rows[k]))):
            model.learn(rows[k], int(toxic[k]))
    at = np.flatnonzero(np.abs(model.z) > L1)
    return pa.table({"slot": np.append(at, -1), "weight": np.append(model.weights(at), model.bias)})


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, bias) learnt from at most most labelled rows of docs, with most_bytes of text, none of which is held out."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The ids are at most most rows of 12 bytes, so they are broadcast at every size.
    ids = F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    sizes = docs.join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.coalesce(F.max(F.octet_length("text")), F.lit(0)).cast("long").alias("size"))
    upto = F.sum("size").over(W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, 0))
    ids = F.broadcast(settle(sizes.withColumn("upto", upto).where(F.col("upto") <= most_bytes).select("doc_id", "toxic")))
    # One text of each id, however often that is repeated.
    texts = docs.join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = texts.mapInArrow(_features, "doc_id long, toxic int, slots binary")
    got = sample.groupBy(F.lit(0).alias("all")).applyInArrow(_train, "slot long, weight double").toArrow()
    at, weight = got["slot"].to_numpy(), got["weight"].to_numpy()
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    real = at >= 0
    by = np.argsort(at[real])
    return at[real][by], weight[real][by], float(weight[~real][0])


def _score(at: np.ndarray, weight: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, np.float32)
        table[at] = weight
        for batch in batches:
            out = np.zeros(len(batch))
            for i, j, w in word_chunks(batch["text"], ALNUM):
                docs, found = [], []
                for places, s in slots(w):
                    hit = np.flatnonzero(table[s] != 0)
                    docs.append(np.searchsorted(w.ptr, places[hit], side="right") - 1)
                    found.append(s[hit])
                pairs = np.unique((np.concatenate(docs) << BITS) | np.concatenate(found))
                np.add.at(out, i + (pairs >> BITS), table[pairs & ((1 << BITS) - 1)])
            score = 1 / (1 + np.exp(-np.clip(out + bias, -35, 35)))
            yield pa.record_batch([batch["doc_id"].cast(pa.int64()), pa.array(score), *[batch[c] for c in batch.schema.names if c not in ("doc_id", "text")]], names=["doc_id", "score", *[c for c in batch.schema.names if c not in ("doc_id", "text")]])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Only the text is scored: a document's features are the distinct slots of its
    words, their stems, neighbours and pairs with a gap, over the whole text. Labels are learnt only from
    rows whose crc32(doc_id as text) mod 4 is not 2; a doc_id with both labels counts
    as toxic, one with several texts has one of them learnt, one without an id or a
    label of 0 or 1 isn't learnt from. A null or
    empty text scores the rate of toxic rows learnt from; without any labelled text all scores are
    0.5. A null id is not held out. Repeated rows give a row each; other columns are
    not read. The weights are few (L1) and below 2**BITS, whatever the input.
    """
    src = small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    model = train(src, labels)
    rows = src.mapInArrow(_score(*model), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents whose own text scores below threshold, all columns as they were.

    Rows are judged one by one, whatever their ids: repeated rows go or stay together,
    and null and empty texts score the rate of toxic rows, so they stay below it.
    Without labelled texts nothing is known of any row, and all stay. Other columns,
    of any name, are not read.
    """
    model = train(small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    if not len(model[0]) and model[2] == 0:
        return docs
    return docs.mapInArrow(_below(*model, threshold), docs.schema)


def _below(at: np.ndarray, weight: np.ndarray, bias: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.record_batch([pa.nulls(len(batch), pa.int64()), batch["text"]], names=["doc_id", "text"])
            for scored in _score(at, weight, bias)(iter([plain])):
                yield batch.filter(pa.array(scored["score"].to_numpy() < threshold))

    return run
