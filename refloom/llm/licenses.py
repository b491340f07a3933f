"""License scans by a positional rare-token index.

Templates are word sequences in which some runs of words are mandatory. The index
has, for each template, the postings (word, position) of its mandatory words of the
highest inverse document frequency over the templates. A file's places of such a
word, less the word's position, are the offsets at which the template may stand; the
offsets of all postings of a template are intersected, fewest places first, and a
template counts where its mandatory phrases stand at an offset that is left. A
counting template has all its mandatory words at one offset, so none is missed,
however many words of the index a file has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.durable import small_batches
from refloom.llm.words import ALNUM, word_chunks, word_hash

#: Phrases whose every place counts, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of common notices; [] mark mandatory phrases.
TEMPLATES = {
    "mit": ["released under the [mit license]", "licensed under the [mit license]", "[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated documentation files"],
    "apache-2.0": ["licensed under the [apache license version 2 0]", "[apache license] [version 2 0] january 2004"],
    "bsd": ["[redistribution and use in source and binary forms] with or without modification are permitted", "released under the [bsd license]", "licensed under the [bsd license]"],
    "isc": ["[permission to use copy modify and or distribute this software for any purpose] with or without fee is hereby granted"],
    "mpl-2.0": ["this source code form is subject to the terms of the [mozilla public license v 2 0]", "[mozilla public license version 2 0]"],
    "gpl": ["this work is licensed under the [gnu general public license] version 3", "under the terms of the [gnu general public license] as published by the free software foundation"],
    "lgpl": ["under the terms of the [gnu lesser general public license] as published by the free software foundation"],
    "agpl": ["under the terms of the [gnu affero general public license] as published by the free software foundation"],
    "cc-by": ["licensed under [cc by] 4 0", "[creative commons attribution] 4 0 international license"],
    "cc-by-nc": ["licensed under [cc by nc] 4 0", "[creative commons attribution noncommercial] 4 0 international license"],
    "cc-by-sa": ["licensed under [cc by sa] 4 0", "[creative commons attribution sharealike] 4 0 international license"],
    "cc0": ["[creative commons zero]", "[cc0 1 0 universal]"],
    "epl": ["[eclipse public license] v 2 0"],
    "unlicense": ["this is free and unencumbered software [released into the public domain]"],
    "zlib": ["[this software is provided as is without any express or implied warranty]"],
    "reserved": ["[all rights reserved]"],
}


class Index:
    """The positional index; its size is fixed by TEMPLATES."""

    def __init__(self) -> None:
        self.labels, self.words, self.keys = [], [], []
        for label, notices in TEMPLATES.items():
            for notice in notices:
                words, keys, open_at = [], [], 0
                for part in notice.split(" "):
                    if part.startswith("["):
                        open_at = len(words)
                    words.append(part.strip("[]"))
                    if part.endswith("]"):
                        keys.append((open_at, len(words)))
                self.labels.append(label)
                self.words.append(words)
                self.keys.append(keys)
        vocabulary = sorted({w for ws in self.words for w in ws} | {w for p in BASE for w in p.split(" ")})
        hashes = np.array([word_hash(w) for w in vocabulary], np.uint64)
        by = np.argsort(hashes)
        self.hashes = hashes[by]
        ids = {vocabulary[k]: n for n, k in enumerate(by)}
        self.templates = [np.array([ids[w] for w in ws]) for ws in self.words]
        self.base = [(np.array([ids[w] for w in p.split(" ")]), label) for p, label in BASE.items()]
        df = np.zeros(len(vocabulary))
        for t in self.templates:
            df[np.unique(t)] += 1
        self.idf = np.log(len(self.templates) / np.maximum(df, 1))
        self.needs = np.zeros((len(self.templates), len(vocabulary)), bool)
        self.rare = np.zeros(len(vocabulary), bool)
        self.postings: list[np.ndarray] = []
        for k, t in enumerate(self.templates):
            at = np.concatenate([np.arange(a, b) for a, b in self.keys[k]])
            self.needs[k, t[at]] = True
            self.postings.append(at[self.idf[t[at]] == self.idf[t[at]].max()])
            self.rare[t[self.postings[k]]] = True
        for phrase, _ in self.base:
            self.rare[phrase[np.argmax(self.idf[phrase])]] = True

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def stands(self, ids: np.ndarray, at: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        """Those places of at where phrase begins."""
        at = at[(at >= 0) & (at + len(phrase) <= len(ids))]
        ok = np.ones(len(at), bool)
        for k, w in enumerate(phrase):
            ok &= ids[at + k] == w
        return at[ok]

    def meet(self, places: list[np.ndarray], phrase: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Offsets at which every word of phrase at a position of at stands, by places of each word."""
        left = None
        for k in sorted(at.tolist(), key=lambda k: len(places[phrase[k]])):
            own = places[phrase[k]] - k
            if left is None:
                left = own
            else:
                near = np.minimum(np.searchsorted(own, left), len(own) - 1)
                left = left[own[near] == left] if len(own) else own
            if not len(left):
                break
        return left

    def scan(self, ids: np.ndarray) -> tuple[list[tuple[str, np.ndarray]], dict[str, float]]:
        """Places of each base label, and the method's labels with their best share of template words, in one file."""
        known = np.flatnonzero(ids >= 0)
        by = known[np.argsort(ids[known], kind="stable")]
        count = np.bincount(ids[known], minlength=len(self.hashes))
        places = np.split(by, np.cumsum(count)[:-1])
        base = [(label, at) for phrase, label in self.base if len(at := self.meet(places, phrase, np.arange(len(phrase))))]
        labels: dict[str, float] = {}
        for k in np.flatnonzero(~(self.needs & (count == 0)).any(axis=1)):
            template = self.templates[k]
            offset = self.meet(places, template, self.postings[k])
            for a, b in self.keys[k]:
                offset = self.stands(ids, offset + a, template[a:b]) - a
            if len(offset):
                share = np.zeros(len(offset))
                for at, w in enumerate(template):
                    place = offset + at
                    inside = (place >= 0) & (place < len(ids))
                    share[inside] += ids[place[inside]] == w
                labels[self.labels[k]] = max(labels.get(self.labels[k], 0.0), float(share.max() / len(template)))
        return base, labels


@cache
def index() -> Index:
    return Index()


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ix = index()
    for batch in batches:
        rows = len(batch)
        words, n_base, score = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows)
        first, last, base_labels, labels = [None] * rows, [None] * rows, [""] * rows, [""] * rows
        for i, j, w in word_chunks(batch["text"], ALNUM):
            words[i:j] = np.diff(w.ptr)
            ids = ix.word_ids(w.hashes)
            hit = np.flatnonzero((ids >= 0) & ix.rare[ids])
            for d in np.unique(np.searchsorted(w.ptr, hit, side="right") - 1):
                base, found = ix.scan(ids[w.ptr[d] : w.ptr[d + 1]])
                if base:
                    places = np.concatenate([p for _, p in base])
                    n_base[i + d], first[i + d], last[i + d] = len(places), int(places.min()), int(places.max())
                    base_labels[i + d] = ",".join(sorted({x for x, _ in base}))
                labels[i + d] = ",".join(sorted({x for x, _ in base} | set(found)))
                score[i + d] = max([1.0] * bool(base) + [*found.values(), 0.0])
        yield pa.record_batch([batch["doc_id"].cast(pa.int64()), words, n_base, pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), score], names=[x.split()[0] for x in SCHEMA.split(", ")])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row of SCHEMA for each row of docs, made without a shuffle.

    Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z
    became a-z; a null or empty text has none: n_words and n_base 0, first_word and
    last_word null, labels '', score 0. score is 1 where a base phrase stands, else
    the best share of a verified template's words found at their places. Repeated
    rows and null ids give a row each; other columns are not read.
    """
    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(_scan, SCHEMA)
