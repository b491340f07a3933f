"""Projection of structured fields onto raw lines: tolerant patterns, consumed in order, marked, then put back as tags."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What OCR may show for a character, and the tag that each field is written with.
LOOKALIKES = {
    "0": ("0", "O"), "1": ("1", "l", "I"), "2": ("2", "E"), "5": ("S", "5"), "8": ("8", "B"),
    "a": ("a", "u", "n"), "b": ("b", "h"), "ä": ("ä", "a", "g", "L"), "c": ("c", "e", "t"), "ç": ("ç", "q"), "d": ("d", "cl"), "e": ("e", "c", "¢"), "é": ("é", "6", "e", "d", "~"), "è": ("è", "e", "Q"), "f": ("f", "t"), "h": ("h", "b"),
    "i": ("i", ";", "l"), "l": ("1", "l", "i", "I", "]", "/", "Z"), "m": ("m", "rn", "nn", "ni"), "n": ("n", "rt", "ll"), "o": ("o", "c"), "ø": ("ø", "o"), "ö": ("ö", "o", "6", "S", "b", "~"), "t": ("t", "f", "¹", "r"), "ü": ("ü", "u", "ii", "ti", "fi"),
    "v": ("v", "y"), "y": ("y", "v"), "B": ("B", "8"), "D": ("D", "I)"), "E": ("E", "B"), "F": ("F", "E"), "J": ("J", ".I"), "O": ("O", "0", "C)"), "P": ("P", "I'"), "R": ("R", "K"), "S": ("S", "5"), "V": ("V", "Y"), "Y": ("Y", "V"), "β": ("β", "[3", "b", "fl"),
    "·": (".", "·"), "—": ("—", "--", "-"), '"': ('"', "“", "”", "‟"), "“": ('"', "“", "”", "‟"), "”": ('"', "“", "”", "‟"), "‟": ('"', "“", "”", "‟"), "'": ("'", "‘", "’", "‛"), "‘": ("'", "‘", "’", "‛"), "’": ("'", "‘", "’", "‛"), "‛": ("'", "‘", "’", "‛"),
}
TAGS = {"tit": ("<title level=\"a\">", "</title>"), "j": ("<title level=\"j\">", "</title>"), "date": ("<date>", "</date>"), "vol": ('<biblScope unit="vol">', "</biblScope>"), "iss": ('<biblScope unit="issue">', "</biblScope>"), "fpg": ('<biblScope unit="page">', "</biblScope>"), "lpg": ('<biblScope unit="page">', "</biblScope>"), "names": ("<author>", "</author>"), "psher": ("<publisher>", "</publisher>")}
GAP, SPACE = r"[-¤ ]{0,3}", r"[¤ \W]{0,4}"


#: Characters that a match may be longer than the text, for each PER characters begun; shorter texts than SHORT are matched plainly.
LONGER, PER, SHORT = 3, 80, 6


@lru_cache(4096)
def tolerant(text: str) -> str:
    """A pattern for the text as OCR and line ends may show it, between word boundaries where it starts or ends in a word; short texts are matched plainly."""
    pieces = re.findall(r"\w+|[^\w\s]", text)
    if not pieces:
        return r"(?!)"
    if len(text) < SHORT:
        body = SPACE.join(map(re.escape, pieces))
    else:
        one = lambda c: f"(?:{'|'.join(map(re.escape, LOOKALIKES[c]))})" if c in LOOKALIKES else re.escape(c)
        body = f"(?=.{{{len(text)},{len(text) + LONGER * (len(text) // PER + 1)}}})" + SPACE.join(GAP.join(map(one, piece)) for piece in pieces)
    edge = lambda piece: r"\b" if re.match(r"\w", piece) else ""
    return edge(pieces[0]) + body + edge(pieces[-1])


def any_of(alternatives: Iterable[str]) -> re.Pattern:
    """Any of the texts, the first listed one of those that match at a place; not right after the start of a placeholder."""
    return re.compile(f"(?<!#\\(#)(?:{'|'.join(f'(?:{tolerant(x)})' for x in alternatives)})", re.IGNORECASE)


def project(line: str, fields: Iterable[tuple[str, list[str]]]) -> tuple[str, list[str]]:
    """The line with each field's first free match tagged, in the fields' order, and the fields that weren't found.

    A match becomes a placeholder, so that later fields don't match within it; of
    alternatives that which stands first in the line counts, and of matches the first.
    """
    found: list[str] = []
    missing = []
    for name, alternatives in fields:
        texts = [x for x in alternatives if x]
        m = any_of(texts).search(line) if texts else None
        if m and m[0]:
            opened, closed = TAGS.get(name, ("<note>", "</note>"))
            found.append(opened + m[0] + closed)
            line = f"{line[: m.start()]}#(#{len(found) - 1}-{name}#)#{line[m.end() :]}"
        else:
            missing.append(name)
    return re.sub(r"#\(#(\d+)-\w+#\)#", lambda m: found[int(m[1])], line), missing


def project_fields(rows: DataFrame, keep: list[str], line: str = "line", fields: str = "fields") -> DataFrame:
    """keep, tagged and missing, from a line and an array of structs (name, alternatives); Arrow batches of whole references."""

    @F.pandas_udf("tagged string, missing array<string>")
    def run(lines, wanted):
        import pandas as pd

        out = [project(x or "", [(f["name"], list(f["alternatives"])) for f in fs]) for x, fs in zip(lines, wanted, strict=True)]
        return pd.DataFrame({"tagged": [a for a, _ in out], "missing": [b for _, b in out]})

    return rows.select(*keep, run(line, fields).alias("r")).select(*keep, "r.tagged", "r.missing")


def mark_zone(lines: DataFrame, zones: DataFrame, key: str) -> DataFrame:
    """lines with where they stand: body, listBibl or end."""
    z = lines.join(zones.select(key, "first", "last"), key, "left")
    inside = F.col("i").between(F.col("first"), F.col("last"))
    return z.withColumn("zone", F.when(inside, "listBibl").when(F.col("i") > F.col("last"), "end").otherwise("body")).drop("first", "last")
