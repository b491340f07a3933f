"""URL filters: rules by host and path, and gradient-boosted trees on lexical features."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.durable import settle, small_batches
from refloom.llm.skew import look_up

#: The rules, by what they fit.
RULES = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}

#: Labelled URLs that the trees are trained on, at most: those of the least hash.
TRAIN_ROWS = 20_000
#: Rows that are scored at once.
SCORE_ROWS = 2048
SCHEMA = "page_id long, host string, path string, rule string, score double"
#: Folds of the labelled URLs; a training row's counts are those of the other folds.
FOLDS = 5
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 40, 3, 0.3, 32, 20
#: What labels are counted by, over all labelled URLs, and keys that are broadcast at most; tables of more are joined by a shuffle.
KINDS = ("suffix", "domain", "segment")
BROADCAST_KEYS = 200_000
FEATURES = ("length", "host length", "host labels", "path depth", "last segment length", "digit ratio", "digits", "entropy", "host entropy", "parameters", "fragment", "hyphens", "https", "suffix rate", "suffix rows", "domain rate", "domain rows", "segment rate", "segment rows")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ://: up to /, ?, # or end with A-Z as a-z, and then up to ?, # or end; empty for null or without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits the host or a domain above it, and the start of the path; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0


def features(urls: list[str], hosts: list[str], paths: list[str], rows: np.ndarray, blocked: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each URL; rows and blocked count labelled URLs of its KINDS."""
    out = np.zeros((len(urls), len(FEATURES)))
    for k, (url, host, path) in enumerate(zip(urls, hosts, paths, strict=True)):
        digits = sum(map(url.count, "0123456789"))
        query = url.partition("?")[2].partition("#")[0]
        out[k, :13] = (
            len(url), len(host), host.count(".") + bool(host), sum(map(bool, path.split("/"))), len(path.rpartition("/")[2]), digits / max(1, len(url)), digits, _entropy(url), _entropy(host),
            sum(map(bool, query.split("&"))), "#" in url, url.count("-"), url.startswith("https"),
        )
    out[:, 13::2] = (blocked + 1) / (rows + 2)
    out[:, 14::2] = np.log1p(rows)
    return out


def _kinds(host: Column, path: Column) -> dict[str, Column]:
    """Last label and last two labels of the host, and first segment of the path."""
    labels = F.split(host, r"\.")
    return {"suffix": F.element_at(labels, -1), "domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host), "segment": F.regexp_extract(path, "^.([^/]*)", 1)}


def _with_counts(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """rows with how many labelled URLs share each kind, and how many of them are blocked: n_ and b_ columns."""
    for kind in KINDS:
        table = settle(labelled.groupBy(kind).agg(F.count("*").alias(f"n_{kind}"), F.sum("y").alias(f"b_{kind}")))
        if table.count() <= BROADCAST_KEYS:
            rows = rows.join(F.broadcast(table), kind, "left")
        else:
            held = rows.groupBy(kind).agg(F.count("*").alias("copies"))
            rows = look_up(rows, table.join(held, kind), kind, rows.count())
    return rows


def _counts(rows: pa.RecordBatch | pa.Table, letter: str) -> np.ndarray:
    return np.array([rows[f"{letter}_{kind}"].fill_null(0).to_pylist() for kind in KINDS], float).reshape(len(KINDS), -1).T


class Trees:
    """Gradient-boosted trees for log loss, with histograms of quantile bins and Newton leaves."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start = math.log(rate / (1 - rate))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            split_on, split_at, leaf = np.full(2**DEPTH - 1, -1), np.zeros(2**DEPTH - 1), np.zeros(2**DEPTH)
            node = np.zeros(len(y), np.int64)
            for level in range(DEPTH):
                for k in range(2**level):
                    at, rows = 2**level - 1 + k, np.flatnonzero(node == k)
                    best = (1e-6, -1, 0)
                    for f, c in enumerate(cuts):
                        if len(c) and len(rows) >= 2 * LEAST_LEAF:
                            g, h, n = (np.cumsum(np.bincount(binned[rows, f], v, len(c) + 1))[:-1] for v in (grad[rows], hess[rows], np.ones(len(rows))))
                            gs, hs = grad[rows].sum(), hess[rows].sum()
                            gain = g * g / (h + 1) + (gs - g) ** 2 / (hs - h + 1) - gs * gs / (hs + 1)
                            gain[(n < LEAST_LEAF) | (len(rows) - n < LEAST_LEAF)] = 0
                            j = int(np.argmax(gain))
                            if gain[j] > best[0]:
                                best = (float(gain[j]), f, j)
                    if best[1] >= 0:
                        split_on[at], split_at[at] = best[1], cuts[best[1]][best[2]]
                right = np.zeros(len(y), bool)
                f = split_on[2**level - 1 + node]
                ok = f >= 0
                right[ok] = x[np.flatnonzero(ok), f[ok]] > split_at[2**level - 1 + node[ok]]
                node = node * 2 + right
            for k in range(2**DEPTH):
                rows = node == k
                leaf[k] = RATE * grad[rows].sum() / (hess[rows].sum() + 1)
            self.trees.append((split_on, split_at, leaf))
            score += leaf[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for split_on, split_at, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                at = 2**level - 1 + node
                f = split_on[at]
                node = node * 2 + ((f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > split_at[at]))
            total += leaf[node]
        return 1 / (1 + np.exp(-total))


def _score(model: Trees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), SCORE_ROWS):
                part = batch.slice(i, SCORE_ROWS)
                urls = [u or "" for u in part["url"].to_pylist()]
                x = features(urls, part["host"].to_pylist(), part["path"].to_pylist(), _counts(part, "n"), _counts(part, "b"))
                p = model.score(x) if model else np.zeros(len(urls))
                yield pa.record_batch([part["page_id"].cast(pa.int64()), part["host"], part["path"], part["rule"], pa.array(p)], names=["page_id", "host", "path", "rule", "score"])

    return run


def fit(labelled: DataFrame, most: int = TRAIN_ROWS) -> Trees | None:
    """Trees learnt from at most most of the labelled URLs, each beside the counts of all others outside its own of FOLDS folds; None without both labels.

    Counts without the URL alone would tell its label: they are lower for the blocked
    ones of a kind than for the others.
    """
    fold = (F.crc32(F.col("url").cast("binary")) % FOLDS).alias("fold")
    sample = settle(labelled.orderBy(F.xxhash64("url"), "url").limit(most).select("*", fold))
    known = _with_counts(sample, labelled)
    for kind in KINDS:
        # The sample is of a bounded size, so its keys are broadcast at every size.
        own = labelled.select(kind, "y", fold).join(F.broadcast(sample.select(kind, "fold").distinct()), [kind, "fold"], "left_semi")
        known = known.join(own.groupBy(kind, "fold").agg(F.count("*").alias(f"own_n_{kind}"), F.sum("y").alias(f"own_b_{kind}")), [kind, "fold"], "left")
    known = known.orderBy("url").toArrow()
    y = known["y"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    rows, blocked = (_counts(known, c) - _counts(known, f"own_{c}") for c in "nb")
    return Trees(features(known["url"].to_pylist(), known["host"].to_pylist(), known["path"].to_pylist(), rows, blocked), y)


def _judged(pages: DataFrame, id_col: str, url_col: str, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Each page's url, host, path, rule and KINDS; and the distinct URLs that a rule decides, with y 1 for block."""
    host, path = host_and_path(F.col("url"))
    src = small_batches(pages).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    src = src.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    src = src.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumns(_kinds(F.col("host"), F.col("path")))
    y = F.col("rule").isin([r for r, v in rules.items() if v == "block"]).cast("int")
    return src, settle(src.where("rule is not null").select("url", "host", "path", *KINDS, y.alias("y")).distinct())


def held_out_scores(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: dict[str, str] | None = None) -> DataFrame:
    """url, y and score of the labelled URLs whose crc32 mod 4 is 2, by trees and counts of the other labelled ones."""
    _, labelled = _judged(pages, id_col, url_col, RULES if rules is None else rules)
    out = F.crc32(F.col("url").cast("binary")) % 4 == 2
    rest = settle(labelled.where(~out))
    rows = _with_counts(labelled.where(out).select("*", F.lit(0).cast("long").alias("page_id"), F.lit("").alias("rule")), rest)
    scored = rows.withColumn("rule", F.col("url")).mapInArrow(_score(fit(rest)), SCHEMA)
    return scored.select(F.col("rule").alias("url"), "score").join(labelled.select("url", "y"), "url")


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: dict[str, str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' probability of block) for every row of pages.

    The URLs that a rule decides are the labelled ones. Labels are counted over all
    of them, by host suffix, domain and first path segment; the trees learn from
    TRAIN_ROWS at most, those of the least hash, each beside the counts of other folds,
    so the model is of bounded size and reruns agree. A rule's verdict stands; the
    trees judge the rest, at 0.5. A null url, and one without ://, has an empty host
    and path and no rule, and is judged by its features. Without labelled URLs of both
    kinds the trees allow all (score 0). Repeated rows and null ids give a row each;
    other columns are not read.
    """
    rules = RULES if rules is None else rules
    src, labelled = _judged(pages, id_col, url_col, rules)
    rows = _with_counts(src, labelled).mapInArrow(_score(fit(labelled)), SCHEMA)
    decided = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        decided = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(decided)
    return rows.select("page_id", "host", "path", "rule", F.coalesce(decided, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
