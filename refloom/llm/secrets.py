"""Secret scans: fixed patterns, and a randomness test battery with false-discovery control."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.durable import settle, small_batches

#: The base patterns, with the least length of what counts.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")
#: A run of 32 or more; the same runs as HEX finds, without visiting the short ones.
HEX_RUN = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

#: False-discovery level in each band of lengths, and the bands' lower ends.
LEVEL = 0.01
BANDS = (20, 24, 32, 48, 80)
#: Steps of log10(p) in which p-values are counted, and how many.
STEP, BINS = 0.25, 160
#: Level below which a token isn't taken for random: about that share of random strings is lost.
NOT_RANDOM = 1e-3
#: Ordinary identifiers: sum of squares of their letter frequencies, and how often the kind of character changes.
ORDINARY_SQUARES, ORDINARY_CHANGES = 0.065, 0.12
#: How often the case of a letter changes in ordinary identifiers without digits, a word's capital and what follows it counting once.
ORDINARY_CASES = 0.2

_KIND = np.zeros(128, np.int64)
_KIND[48:58], _KIND[65:91], _KIND[97:123] = 1, 2, 3


def encoding(raw: np.ndarray) -> tuple[int, np.ndarray] | None:
    """Size of the narrowest alphabet that holds the token, and its codes; None for tokens without letters and digits. Of tokens without letters, only the digits have codes."""
    kind = _KIND[raw]
    digits, upper, lower, other = ((kind == k) for k in (1, 2, 3, 0))
    if not (upper.any() or lower.any()):
        return (10, raw[digits] - 48) if digits.any() else None
    plain = np.where(upper, raw + 32, raw)
    letters = plain[upper | lower] - 97
    if not other.any() and not digits.any():
        return (52, np.where(upper, raw - 65, raw - 71)) if upper.any() and lower.any() else (26, letters)
    if not other.any() and not (upper.any() and lower.any()):
        if letters.max() < 6:
            return 16, np.where(digits, raw - 48, plain - 87)
        if upper.any() and raw[digits].min() >= 50 and raw[digits].max() <= 55:
            return 32, np.where(digits, raw - 24, raw - 65)
        return 36, np.where(digits, raw - 48, plain - 87)
    return 64, np.where(digits, raw + 4, np.where(upper, raw - 65, np.where(lower, raw - 71, np.where((raw == 43) | (raw == 45), 62, 63))))


def _below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def uniform(size: int, codes: np.ndarray) -> tuple[float, float, float]:
    """p-values of chi-squared, runs and serial correlation under "independent and uniform over an alphabet of size letters".

    Chi-squared is too large; its law has the multinomial's mean and variance, in
    Wilson and Hilferty's form. Runs are of codes in the lower and the upper half of
    the alphabet, where each change comes with probability 1/2, too many or too few.
    Correlation is that of neighbours, too far from its mean of -1 / n.
    """
    n = len(codes)
    counts = np.bincount(codes, minlength=size)[:size]
    chi = float(((counts - n / size) ** 2).sum() / (n / size))
    scale = (n - 1) / n
    free = (size - 1) / scale
    spread = 2 / (9 * free)
    p_chi = _below(-((max(chi, 1e-9) / (scale * free)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    half = codes >= size // 2
    changes = int((half[1:] != half[:-1]).sum())
    p_runs = min(1.0, 2 * _below(-(abs(changes - (n - 1) / 2) - 0.5 * (changes * 2 != n - 1)) / math.sqrt((n - 1) / 4)))
    c = codes - codes.mean()
    total = float((c * c).sum())
    p_corr = 2 * _below(-abs(float((c[1:] * c[:-1]).sum()) / total + 1 / n) * math.sqrt(n)) if total else 0.0
    return p_chi, p_runs, p_corr


def fisher(*p: float) -> float:
    """Fisher's combined p-value of independent tests."""
    x = -sum(math.log(max(v, 1e-300)) for v in p)
    return min(1.0, math.exp(-x) * sum(x**k / math.factorial(k) for k in range(len(p))))


def battery(token: str) -> float:
    """p-value of the token under 'an ordinary identifier'; small for random strings, 1 for what isn't random.

    Chi-squared, runs and serial correlation give a p-value each under a uniform
    alphabet; a token whose combined p-value is below NOT_RANDOM isn't random. Others
    are tested against ordinary identifiers: chi-squared, which is noncentral for
    them, so that longer tokens separate better, and runs of kinds of characters
    (binomial), joined by Fisher's method. Without digits, runs are those of the
    letters' cases: what separates words is left out, and a capital starts a word
    rather than being a run of its own.
    """
    raw = np.frombuffer(token.rstrip("=").encode(), np.uint8).astype(np.int64)
    found = encoding(raw) if len(raw) >= BANDS[0] else None
    if found is None or len(found[1]) < 2:
        return 1.0
    size, codes = found
    n = len(codes)
    if fisher(*uniform(size, codes)) < NOT_RANDOM:
        return 1.0
    counts = np.bincount(codes, minlength=size)[:size]
    chi = float(((counts - n / size) ** 2).sum() / (n / size))
    shift = n * max(0.6, size * ORDINARY_SQUARES - 1)
    p_chi = _below((chi - (size - 1) - shift) / math.sqrt(2 * (size - 1 + 2 * shift)))
    kinds, usual = _KIND[raw], ORDINARY_CHANGES
    if not (kinds == 1).any() or not (kinds > 1).any():
        kinds, usual = kinds[kinds > 0], ORDINARY_CASES
        change = kinds[1:] != kinds[:-1]
        # From a capital to a small letter, where a small letter or nothing stands before the capital.
        change[1:] &= ~((kinds[2:] == 3) & (kinds[1:-1] == 2) & (kinds[:-2] == 3))
        change[:1] &= kinds[0] != 2
    else:
        change = kinds[1:] != kinds[:-1]
    tried = len(change)
    p_runs = _below(-(int(change.sum()) - 0.5 - usual * tried) / math.sqrt(tried * usual * (1 - usual))) if tried else 1.0
    return fisher(p_chi, p_runs)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(text)]
    return sorted(out)


def outside(a: int, b: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What of a to b lies in no base span (they are in order of their starts), in pieces of BANDS[0] characters at least."""
    out = []
    for s, _, e in base:
        if a < e and s < b:
            out.append((a, s))
            a = max(a, e)
    return [(x, y) for x, y in [*out, (a, b)] if y - x >= BANDS[0]]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, band, bin of the p-value) of each token, or part of one outside base spans, that the battery doesn't veto."""
    out = []
    for m in CANDIDATE.finditer(text):
        for a, b in outside(*m.span(), base):
            p = battery(text[a:b])
            if p < 1:
                band = sum(b - a >= x for x in BANDS) - 1
                out.append((a, b, band, min(BINS - 1, int(-math.log10(max(p, 1e-300)) / STEP))))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("bin", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, found, tests = [], [], []
        for value in batch["text"]:
            text = value.as_py() or ""
            base = base_spans(text)
            spans.append([dict(zip(("start", "kind", "end"), x, strict=True)) for x in base])
            tests.append(candidates(text, base))
            found.append([dict(zip(("start", "end", "band", "bin"), x, strict=True)) for x in tests[-1]])
        yield pa.record_batch([batch["doc_id"].cast(pa.int64()), pa.array(spans, SPANS), pa.array(found, FOUND)], names=["doc_id", "base", "found"])


def discovery_bins(counts: dict[tuple[int, int], int], level: float = LEVEL) -> dict[int, int]:
    """Per band, the least bin that is a discovery by Benjamini and Hochberg's step-up rule; counts by (band, bin)."""
    out = {}
    for band in {b for b, _ in counts}:
        total, above = sum(k for (b, _), k in counts.items() if b == band), 0
        for x in range(BINS - 1, -1, -1):
            above += counts.get((band, x), 0)
            if above and total * 10 ** (-x * STEP) <= level * above:
                out[band] = x
    return out


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of docs; spans are code points, end exclusive.

    Texts are read once; p-values of all candidates of all rows are counted by
    length band and step, and each band's cut (a few numbers) decides which are
    spans of kind random. A null or empty text has no span: counts 0, the digest of
    '' and spans ''. Repeated rows and null ids give a row each, and repeated
    candidates count each time; other columns are not read.
    """
    src = small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    rows = settle(src.mapInArrow(_scan, "doc_id long, base array<struct<start:long,kind:int,end:long>>, found array<struct<start:long,end:long,band:int,bin:int>>"))
    seen = rows.select(F.inline("found")).groupBy("band", "bin").count().collect()
    cuts = discovery_bins({(r["band"], r["bin"]): r["count"] for r in seen})
    least = F.lit(BINS)
    name = lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])

    def passes(x):
        cut = least
        for band, at in sorted(cuts.items()):
            cut = F.when(x["band"] == band, F.lit(at)).otherwise(cut)
        return x["bin"] >= cut

    extra = F.transform(F.filter("found", passes), lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
    joined = lambda spans: F.array_join(F.transform(spans, name), ",")
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return rows.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", extra))).alias("spans"))
