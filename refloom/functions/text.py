"""Cleaning and soft comparison of noisy strings, as rewriting steps for Spark columns and for SQL.

A step is (kind, what, by): "re" replaces a pattern that Java and RE2 read alike,
"tr" maps characters one to one, "lit" replaces a literal.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Step = tuple[str, str, str]
WORD = r"[\p{L}\p{N}_]"

# Characters that count as spaces, dashes and quotes, ligatures, and letters that OCR confuses.
SPACES = "  ᠎           ​  　﻿"
DASHES = "‐‑‒–—―−﹣"
LIGATURES = {
    "Ꜳ": "AA", "ꜳ": "aa", "Æ": "AE", "æ": "ae", "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz", "ﬃ": "ffi", "ﬀ": "ff", "ﬁ": "fi", "ﬄ": "ffl", "ﬂ": "fl", "ﬅ": "ft",
    "Ĳ": "IJ", "ĳ": "ij", "Ǉ": "LJ", "ǉ": "lj", "Ǌ": "NJ", "ǌ": "nj", "Œ": "OE", "œ": "oe", "\u009c": "oe", "ﬆ": "st", "Ꜩ": "Tz", "ꜩ": "tz",
}
UNACCENT = {
    "A": "ÀÁÂÃÄÅĄĀĂ", "a": "àáâãäåąāă", "C": "ÇĆĈĊČ", "c": "çćĉċč", "D": "ĎĐ", "d": "ďđ", "E": "ÈÉÊËĘĒĔĖĚ", "e": "èéêëęēĕėě", "G": "ĜĞĠĢ", "g": "ĝğġģ", "H": "ĤĦ", "h": "ĥħ",
    "I": "ÌÍÎÏĨĪĬĮİ", "i": "ìíîïĩīĭįı", "J": "Ĵ", "j": "ĵ", "K": "Ķ", "k": "ķ", "L": "ŁĹĻĽĿ", "l": "łĺļľŀ", "N": "ÑŃŅŇ", "n": "ñńņň", "O": "ÒÓÔÕÖØŌŎŐ", "o": "òóôõöøōŏő",
    "R": "ŔŖŘ", "r": "ŕŗř", "S": "ŚŜŞŠ", "s": "śŝşš", "T": "ŢŤŦ", "t": "ţťŧ", "U": "ÙÚÛÜŨŪŬŮŰŲ", "u": "ùúûüũūŭůűų", "W": "Ŵ", "w": "ŵ", "Y": "ŸÝŶ", "y": "ÿýŷ", "Z": "ŹŻŽ", "z": "źżž",
}
OCR_LINK = [
    ("re", r"Sot\.", "Soc."), ("re", "nn|rn", "m"), ("re", r"0|O|o|ø|C\)", "0"), ("re", r"1|I|l|i|\]", "I"), ("tr", "tcySERu", "fev5BKa"), ("re", r"\]|\.I", "J"), ("lit", "[3", "β"), ("tr", "éöç", "66q"),
]
OCR_EVAL = [
    ("re", "nn|rn", "m"), ("re", "ü|ti|fi", "ii"), ("re", r"O|o|ø|C\)", "0"), ("tr", "1Ili", "1111"), ("tr", "fte", "ccc"), ("tr", "ySERnu", "v5BKaa"), ("lit", "]", "J"), ("lit", "[3", "β"), ("tr", "éöç", "66q"),
]

CONTROLS = "".join(map(chr, range(1, 32)))
LIGATURE_STEPS: list[Step] = [("lit", a, b) for a, b in LIGATURES.items()]
SPACE_STEPS: list[Step] = [("tr", CONTROLS + "  \u0092" + SPACES, " " * (len(CONTROLS) + 3 + len(SPACES))), ("re", " +", " "), ("re", "^ | $", "")]
#: Without the paragraph separator, as the evaluation side has it.
SPACE_STEPS_EVAL: list[Step] = [("tr", CONTROLS + " \u0092" + SPACES, " " * (len(CONTROLS) + 2 + len(SPACES))), ("re", " +", " "), ("re", "^ | $", "")]
PUNCT_STEPS: list[Step] = [("tr", DASHES + "¯", "-" * 9), ("tr", "‘’‚`‛", "'" * 5), ("re", "‹ ?| ?›", "'"), ("tr", "“”„‟", '"' * 4), ("re", "« ?| ?»", '"'), ("lit", "''", '"')]
SIMPLE_PUNCT_STEPS: list[Step] = [("tr", SPACES, " " * len(SPACES)), ("tr", DASHES, "-" * 8), ("tr", "“”„‟‘’‚‛", '"' * 8), ("re", "« ?| ?»|‹ ?| ?›", '"')]
JOIN_HYPHEN: list[Step] = [("re", f"({WORD})- ", r"\1-")]
UNACCENT_STEPS: list[Step] = [("tr", "".join(UNACCENT.values()), "".join(k * len(v) for k, v in UNACCENT.items()))]
COMMON_STEPS: list[Step] = SPACE_STEPS + PUNCT_STEPS + JOIN_HYPHEN + LIGATURE_STEPS


def merged(steps: list[Step]) -> list[Step]:
    """The same steps with neighbours that map single characters made one."""
    out: list[Step] = []
    for kind, what, by in steps:
        if kind == "tr" and out and out[-1][0] == "tr":
            first, then = dict(zip(out[-1][1], out[-1][2], strict=True)), dict(zip(what, by, strict=True))
            both = {a: then.get(b, b) for a, b in first.items()} | {a: b for a, b in then.items() if a not in first}
            out[-1] = ("tr", "".join(both), "".join(both.values()))
        else:
            out.append((kind, what, by))
    return out


def near(characters: Iterable[str], gap: int = 16) -> str:
    """A pattern for at least the characters, in few ranges, which are faster to test than many single ones."""
    spans: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if spans and c - spans[-1][1] <= gap:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def apply(value: Column, steps: list[Step]) -> Column:
    """The column after the steps. A run of literal steps is skipped for rows that hold none of them."""
    steps, k = merged(steps), 0
    while k < len(steps):
        kind, what, by = steps[k]
        run = list(itertools.takewhile(lambda x: x[0] == "lit", steps[k:]))
        k += len(run) if len(run) > 2 else 1
        if len(run) > 2:
            done = reduce(lambda v, x: F.replace(v, F.lit(x[1]), F.lit(x[2])), run, value)
            value = F.when(value.rlike("|".join(re.escape(x[1]) for x in run) if any(len(x[1]) > 1 for x in run) else near(x[1] for x in run)), done).otherwise(value)
        elif kind == "re":
            value = F.regexp_replace(value, what, by.replace("$", r"\$").replace("\\1", "$1"))
        elif kind == "tr":
            value = F.translate(value, what, by)
        else:
            value = F.replace(value, F.lit(what), F.lit(by))
    return value


def sql(value: str, steps: list[Step]) -> str:
    """The same as a DuckDB expression."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    for kind, what, by in steps:
        if kind == "re":
            value = f"regexp_replace({value}, {quote(what)}, {quote(by)}, 'g')"
        elif kind == "tr":
            value = f"translate({value}, {quote(what)}, {quote(by)})"
        else:
            value = f"replace({value}, {quote(what)}, {quote(by)})"
    return value


@cache
def _compiled(kind: str, what: str, by: str) -> Callable[[str], str]:
    if kind == "re":
        pattern = re.compile(what.replace(WORD, r"\w"))
        return lambda x: pattern.sub(by, x)
    if kind == "tr":
        table = str.maketrans(what, by)
        return lambda x: x.translate(table)
    return lambda x: x.replace(what, by)


def python(value: str, steps: list[Step]) -> str:
    """The same in Python, for functions that depend on order and so run in a UDF."""
    for step in steps:
        value = _compiled(*step)(value)
    return value


def _letters(steps: list[Step]) -> str:
    """A pattern for characters without which single-character maps, and replacements of « » ‹ ›, change nothing."""
    return "[" + "".join(map(re.escape, "".join(what if kind == "tr" else re.sub(r"[ ?|]", "", what) for kind, what, _ in steps))) + "]"


_PUNCTUATED, _SIMPLY_PUNCTUATED = (re.compile(_letters(x)) for x in (PUNCT_STEPS[:5], SIMPLE_PUNCT_STEPS))
_OCR_MAP = str.maketrans("Ooø1IlifteySERnu]éöç", "0001111cccv5BKaaJ66q")


def ocr_eval_text(value: str) -> str:
    """OCR_EVAL in Python, by plain replacements; see match_keys."""
    for a, b in (("rn", "m"), ("nn", "m"), ("ti", "11"), ("fi", "11"), ("ü", "11"), ("C)", "0")):
        value = value.replace(a, b)
    return value.translate(_OCR_MAP).replace("[3", "β")


def even_spaces_text(value: str) -> str:
    """SPACE_STEPS_EVAL in Python."""
    if not value.isprintable():  # No other space is printable than " ".
        value = _compiled(*SPACE_STEPS_EVAL[0])(value)
    while "  " in value:
        value = value.replace("  ", " ")
    return value.strip(" ")


def even_punctuation_text(value: str) -> str:
    """PUNCT_STEPS in Python."""
    return python(value, PUNCT_STEPS) if "''" in value or "`" in value or (not value.isascii() and _PUNCTUATED.search(value)) else value


def simple_punctuation_text(value: str) -> str:
    """SIMPLE_PUNCT_STEPS in Python."""
    return python(value, SIMPLE_PUNCT_STEPS) if not value.isascii() and _SIMPLY_PUNCTUATED.search(value) else value


def canonical(value: Column) -> Column:
    """Spaces, dashes, quotes, hyphens at line ends and ligatures made uniform."""
    return apply(value, COMMON_STEPS)


def ocr_link(value: Column) -> Column:
    """Letters that OCR confuses made alike, for linking."""
    return apply(value, OCR_LINK)


def ocr_eval(value: Column) -> Column:
    """Letters that OCR confuses made alike, for evaluation; another table than that for linking."""
    return apply(value, OCR_EVAL)


def unaccent(value: Column) -> Column:
    return apply(value, UNACCENT_STEPS)


def trim_marks(value: Column) -> Column:
    """Line ends become ¤; those at the ends, and spaces there, go; a null becomes ''."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), "\n", "¤"), r"^[¤\s]+|[¤\s]+$", "")


def query_fragment(value: Column) -> Column:
    """A value made safe for a query: trimmed, special characters escaped, then unsure ones as single wildcards."""
    return F.translate(F.regexp_replace(trim_marks(value), r"([():\[\]\\-])", r"\\$1"), "~]", "??")


def soft_equal(a: Column, b: Column) -> Column:
    """Equal after canonical form, without hyphens and case; or, both over five characters long, after OCR letters too."""
    a, b = F.replace(canonical(a), F.lit("-"), F.lit("")), F.replace(canonical(b), F.lit("-"), F.lit(""))
    same = F.lower(a) == F.lower(b)
    drop = lambda x: F.lower(F.replace(ocr_link(x), F.lit("-"), F.lit("")))
    return same | ((F.length(a) > 5) & (F.length(b) > 5) & (drop(a) == drop(b)))


def archive_equal(a: Column, b: Column) -> Column:
    """Equal after canonical form, or after OCR letters too; case, hyphens and lengths count."""
    a, b = canonical(a), canonical(b)
    return (a == b) | (ocr_link(a) == ocr_link(b))


def best_error_line(message: Column) -> Column:
    """Of a message's lines the one of the highest log(length + 1) * sqrt(place), the last of equals: later and longer lines say more. A run of blanks counts once."""
    lines = F.split(message, "\n")
    rated = F.transform(lines, lambda x, i: F.struct((F.log(F.length(F.regexp_replace(x, r"\s+", " ")) + F.lit(1.0)) * F.sqrt(i + F.lit(1.0))).alias("r"), i.alias("k"), x.alias("line")))
    return F.element_at(F.array_sort(rated), -1)["line"]


def match_key(value: Column, accents: bool = False) -> Column:
    """What clean_equal compares: OCR letters, ligatures and quotes made alike, then only a-z and 0-9.

    Spaces, dashes and quotes aren't made alike first, since none of them is kept.
    """
    value = apply(value, OCR_EVAL + LIGATURE_STEPS + (UNACCENT_STEPS if accents else []))
    return F.regexp_replace(F.lower(value), "[^a-z0-9]+", "")


def _bytes(pairs: dict[str, str]) -> list[tuple[bytes, bytes]]:
    return [(a.encode(), b.encode()) for a, b in pairs.items()]


def _table(pairs: dict[str, str]) -> bytes:
    return bytes.maketrans(*("".join(x).encode() for x in zip(*pairs.items(), strict=True)))


# OCR_EVAL on UTF-8 bytes. No "rn" shares its r with another match, so that one may go first; "ti", "fi" and "ü" become what "ii" does in the end.
_OCR_PAIRS = _bytes({"rn": "m", "nn": "m", "ti": "11", "fi": "11", "C)": "0", "[3": " "})
_OCR_LETTERS = _bytes({"ü": "11", "ø": "0", "é": "6", "ö": "6", "ç": "q"})
_OCR_TABLE = _table(dict(zip("OoIliftySERenu]", "00111ccv5BKcaaJ", strict=True)))
# Ligatures stay as they are spelled, and so do the two other characters whose small letter is in a-z.
_SPELLED = _bytes(LIGATURES | {"\u0130": "i", "\u212a": "k"})
_SMALL = _table({chr(c): chr(c).lower() for c in range(ord("A"), ord("Z") + 1)})
_ASCII = bytes(range(128))
_NO_KEY = bytes(c for c in range(256) if chr(c) not in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789\n")


# What a byte becomes in a key, by itself and the byte after it (first + 256 * second); 0 is no part of one. From _RN on, more than one byte is meant.
_RN, _NN, _OPEN_3, _U, _SPELLED_HERE = range(128, 133)


def _pair_table() -> np.ndarray:
    alone = [c if c == 10 else 0 if _OCR_TABLE[c] in _NO_KEY else _SMALL[_OCR_TABLE[c]] for c in range(256)]
    out = np.tile(np.array(alone, np.uint8), 256)
    for pair, code in {"rn": _RN, "nn": _NN, "ti": ord("1"), "fi": ord("1"), "C)": ord("0"), "[3": _OPEN_3, "ü": _U, "ø": ord("0"), "é": ord("6"), "ö": ord("6"), "ç": ord("q")}.items():
        out[int.from_bytes(pair.encode(), "little")] = code
    for a, _ in _SPELLED:
        out[int.from_bytes(a[:2], "little")] = _SPELLED_HERE
    return out


_PAIRS = _pair_table()
#: Bytes that are looked up at once, so that they stay in the cache.
_BLOCK = 1 << 15


def _fast_keys(raw: bytes) -> bytes | None:
    """Keys of lines by one lookup of each byte and the next; None if a character may be there that is spelled with several letters."""
    n = len(raw)
    pairs, out, special = np.ndarray(n, "<u2", raw + b"\n", strides=(1,)), np.empty(n, np.uint8), []
    for k in range(0, n, _BLOCK):
        block = out[k : k + _BLOCK]
        np.take(_PAIRS, pairs[k : k + _BLOCK], out=block, mode="clip")
        special.append(np.flatnonzero(block >= _RN) + k)
    at = np.concatenate(special) if special else np.empty(0, np.int64)
    code = out[at]
    if (code == _SPELLED_HERE).any():
        return None
    # No "rn" shares its r with another match, so these go first; of a run of n that is left the first two are a pair, and so on.
    rn, nn = at[code == _RN], np.setdiff1d(at[code == _NN], at[code == _RN] + 1, assume_unique=True)
    if nn.size:
        k = np.arange(nn.size)
        nn = nn[(k - np.maximum.accumulate(np.where(np.diff(nn, prepend=-2) > 1, k, 0))) % 2 == 0]
    for found in (rn, nn):
        out[found] = ord("m")
        out[found + 1] = 0
    found = at[code == _OPEN_3]
    out[found] = out[found + 1] = 0
    found = at[code == _U]
    out[found] = out[found + 1] = ord("1")
    return out.tobytes().translate(None, b"\0")


def match_keys(values: list[str]) -> list[str]:
    """match_key of each value, in Python for Arrow batches: the steps run once over all values, as bytes with a line for each."""
    if not values:
        return []
    every = "\n".join(values)
    if every.count("\n") >= len(values):
        # A line end is no part of a key, nor of what the steps replace.
        every = "\n".join([v.replace("\n", " ") for v in values])
    raw = every.encode()
    keys = _fast_keys(raw)
    if keys is not None:
        return keys.decode().split("\n")
    there = {c.encode() for c in set(raw.translate(None, _ASCII).decode())}
    for a, b in _OCR_PAIRS + [x for x in _OCR_LETTERS if x[0] in there]:
        raw = raw.replace(a, b)
    raw = raw.translate(_OCR_TABLE)
    for a, b in _SPELLED:
        raw = raw.replace(a, b) if a in there else raw
    return raw.translate(_SMALL, _NO_KEY).decode().split("\n")


def with_match_key(rows: DataFrame, value: str, key: str, length: str) -> DataFrame:
    """rows with match_key of a value in its place, and the value's length; null for null. The keys of an Arrow batch are made at once."""
    kept = [f for f in rows.schema if f.name != value]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch[value].to_pylist()
            keys = match_keys([v or "" for v in values])
            made = [pa.array([None if v is None else k for v, k in zip(values, keys, strict=True)], pa.string()), pc.utf8_length(batch[value]).cast(pa.int32())]
            yield pa.record_batch([*(batch[f.name] for f in kept), *made], names=[*(f.name for f in kept), key, length])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(key, T.StringType()), T.StructField(length, T.IntegerType())]))


def match_key_sql(value: str) -> str:
    return f"regexp_replace(lower({sql(value, OCR_EVAL + LIGATURE_STEPS + SIMPLE_PUNCT_STEPS)}), '[^a-z0-9]+', '', 'g')"


def length_gate(a: Column, b: Column) -> Column:
    """Whether two strings can be compared: neither is empty nor over twice as long as the other."""
    return lengths_gate(F.length(a), F.length(b))


def lengths_gate(la: Column, lb: Column) -> Column:
    """The same of their lengths."""
    return (la > 0) & (lb > 0) & (la <= 2 * lb) & (lb <= 2 * la)


def clean_equal(a: Column, b: Column, accents: bool = False, keys: tuple[Column, Column] | None = None) -> Column:
    """Soft equality for evaluation: the length gate, equal match keys, or one key within the other where lengths are close.

    keys are the match keys of both where they are columns already, as in joins.
    """
    (ka, kb), la, lb = keys or (match_key(a, accents), match_key(b, accents)), F.length(a), F.length(b)
    close = (la > 5) & (lb > 5) & (F.try_divide(la, lb) > 0.7) & (F.try_divide(la, lb) < 1.3)
    # Only the longer key can hold the other one; keys are ASCII.
    within = F.when(F.octet_length(ka) >= F.octet_length(kb), F.contains(ka, kb)).otherwise(F.contains(kb, ka))
    return F.coalesce(length_gate(a, b) & ((ka == kb) | (close & within)), F.lit(False))


def clean_equal_text(a: str | None, b: str | None) -> bool:
    """clean_equal in Python."""
    if not a or not b or len(a) > 2 * len(b) or len(b) > 2 * len(a):
        return False
    ka, kb = (re.sub("[^a-z0-9]+", "", python(x, OCR_EVAL + LIGATURE_STEPS + SIMPLE_PUNCT_STEPS).lower()) for x in (a, b))
    return ka == kb or (len(a) > 5 and len(b) > 5 and 0.7 < len(a) / len(b) < 1.3 and (ka in kb or kb in ka))


def words(value: Column) -> Column:
    """Runs of word characters, as an array."""
    return F.regexp_extract_all(value, F.lit(f"({WORD}+)"), 1)


def searchable(value: Column) -> Column:
    """Long enough to be looked for: not blank, and over four characters or beginning with a capital or digit."""
    return (F.length(value) > 1) & (F.trim(value) != "") & ((F.length(value) > 4) | value.rlike("^[A-Z0-9]"))


# Letters that names of files keep beside A-Z, a-z and digits.
NAME_LETTERS = "àäçéèïîøöôüùαβγ"


def plain_name(value: Column) -> Column:
    """A name safe for files: runs of other characters become _."""
    return F.regexp_replace(value, f"[^A-Za-z0-9{NAME_LETTERS}]+", "_")


def file_name(doc: Column, corpus: Column, author: Column, year: Column, title: Column) -> Column:
    """A file name that people can read: id, corpus, author, year and the title's first 30 characters, made safe first."""
    return F.concat_ws("-", doc, *map(plain_name, (corpus, author, year)), F.substring(plain_name(title), 1, 30))


def facet_name(value: Column) -> Column:
    """A facet's name without what stands before its first point."""
    return F.regexp_replace(value, r"^[^.]+\.", "")


def url_quote(value: Column) -> Column:
    """Percent-encoding in which a space is %20, and colons stay."""
    out = F.url_encode(value)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%3A", ":")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def query_quote(value: Column) -> Column:
    """url_quote of a query in which ~ and / are single wildcards; these go at the start or end of the query and beside spaces, where they aren't allowed."""
    out = url_quote(F.translate(value, "~/", "??"))
    for pattern, by in (("^%3F", ""), ("%20%3F", "%20"), ("%3F%20", "%20"), ("%3F$", "")):
        out = F.regexp_replace(out, pattern, by)
    return out


def doc_key(path: Column, extension: str) -> Column:
    """File name without the literal extension."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return F.when(name.endswith(extension), F.substring(name, F.lit(1), F.length(name) - len(extension))).otherwise(name)


# Accents that stand after their letter, as combining characters or with a place of their own, and combining forms of those that don't decompose to one.
ACCENTS = "\u0300-\u036f`¨¯´¸ˇ˘˙˚\u02db˜˝^\uff3e\uff40\uffe3"
COMBINING = {"`": "\u0300", "^": "\u0302", "ˇ": "\u030c", "\uff40": "\u0300", "\uff3e": "\u0302", "\uffe3": "\u0304"}


def _with_accent(letter: str, accent: str) -> str:
    """One character of both where there is one; an accent without a combining form goes."""
    apart = unicodedata.normalize("NFKD", accent)
    mark = apart[1] if len(apart) == 2 and apart[0] == " " else COMBINING.get(accent, accent)
    return unicodedata.normalize("NFC", letter + mark) if "\u0300" <= mark <= "\u036f" else letter


def join_accents(value: str) -> str:
    """Latin letters and separate accents after them joined."""
    return re.sub(f"([A-Za-z])([{ACCENTS}])", lambda m: _with_accent(m[1], m[2]), value)


def compose_accents(values):
    """join_accents for a pandas UDF, since no column function normalises Unicode."""
    return values.map(lambda x: None if x is None else join_accents(x))


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))
