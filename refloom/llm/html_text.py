"""HTML extraction: page structure proposes, and a suffix array over each host's text decides.

A page's stream has the words of its blocks outside an article, each block of an
article as one token (its paragraphs are the page's own, and are judged whole), and
a token for each element whose names only suggest that it is no part of the article.
Suffix arrays with longest common prefixes find what repeats on a host's distinct
pages. A token lies in a repeated substring of DEPTH tokens or more on some number of
pages exactly if one of the substring's windows of DEPTH tokens around it does, so
what the arrays of several blocks of pages find merges by the hashes of such windows.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.durable import settle, small_batches
from refloom.llm.words import NONSPACE, combine, mix, split_words

#: Tokens of the shortest repeat that counts, and on how many of a host's pages it must stand.
DEPTH = 8
LEAST_PAGES, LEAST_SHARE = 3, 0.2
#: Share of a host's pages on which a whole block of articles must stand to go, and share of an article's words that such blocks may make up; beyond, pages are copies of each other.
BLOCK_SHARE, MOST_COVERED = 0.5, 0.5
#: Keys of all hosts that are broadcast at most (8 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
#: Tokens of one suffix array.
ARRAY_TOKENS = 1 << 18
#: Kinds of evidence: windows of words, blocks of articles, names of elements.
WINDOW, BLOCK, NAME = 0, 1, 2

_RAW = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|textarea|title)(?=[\s/>])[^>]*+(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)")
_TAG = re.compile(r"""(?s)<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*+(?:>|\Z)""")
_ATTR = re.compile(r"""(?is)([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
_NAMES = re.compile(r"[^a-z0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose text isn't shown; they end with the element they stand in, at the latest, and a select before any block but its options.
_UNSEEN = frozenset("noscript template iframe select".split())
_OPTIONS = frozenset("option optgroup hr".split())
#: Elements with a place of their own in a line; what they hold is text.
_APART = frozenset("object svg canvas audio video".split())
_DROPPED = frozenset("nav footer aside form menu dialog button fieldset search head frameset datalist".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status tablist".split())
_FRAME = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promos promotion sidebar sidebars rail widget widgets nav navbar navigation navi menu menus breadcrumb breadcrumbs "
    "masthead footer foot cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login register search searchbox share sharing social "
    "comment comments commentlist disqus reply replies respond toolbar pagination pager copyright topbar bottombar alert toast paywall tagcloud hidden".split()
)
#: Names that an article's own parts have as well; where the host knows such an element from few pages only, it is such a part.
_MAYBE = frozenset("discussion related recommended recommendations legal disclaimer teaser tags".split())
_CONTENT = frozenset("article articlebody content entry post story main".split())
#: Where an element of the key opens, an open one of the values ends, unless one of the last set lies between.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, set())}


def _kind(tag: str, attributes: str, in_content: bool) -> tuple[bool, int, str]:
    """Whether the element is dropped; 2 for an article or main element, 1 for one whose names say so, else 0; its names where they only suggest that it is dropped."""
    names: set[str] = set()
    role = ""
    hidden = False
    if attributes and not attributes.isspace():
        for m in _ATTR.finditer(attributes):
            key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id"):
                names.update(_NAMES.split(value))
            elif key == "role":
                role = value.strip()
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
                hidden = True
    if tag in ("html", "body"):
        return False, 0, ""
    if hidden or tag in _DROPPED or role in _ROLES or names & _FRAME:
        return True, 0, ""
    if (tag == "header" or "header" in names) and not in_content and not names & {"article", "entry", "post"}:
        return True, 0, ""
    content = 2 if tag in ("article", "main") or role in ("main", "article") else 1 if names & _CONTENT else 0
    return False, content, f"{tag} {' '.join(sorted(names & _MAYBE))}" if names & _MAYBE and not content else ""


class _Open:
    """The open elements. What is asked of them is kept by count or by place, so that each answer takes a time that doesn't depend on how many are open."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, int, bool, str]] = []  # tag, dropped, content, heading wanted, names
        self.by_tag: dict[str, list[int]] = defaultdict(list)
        self.by_kind: dict[str, list[int]] = defaultdict(list)

    def _kinds(self, x: tuple[str, bool, int, bool, str]) -> Iterator[str]:
        tag, dropped, content, wanted, names = x
        flags = (("block", tag in _BLOCK and tag != "p"), ("unseen", tag in _UNSEEN), ("dropped", dropped), ("wanted", wanted), ("heading", tag in _HEADINGS), ("named", bool(names)), (f"content {content}", content > 0))
        return (name for name, is_so in flags if is_so)

    def push(self, *x) -> None:
        self.by_tag[x[0]].append(len(self.stack))
        for kind in self._kinds(x):
            self.by_kind[kind].append(len(self.stack))
        self.stack.append(x)

    def cut(self, size: int) -> None:
        """Close all but the first size elements."""
        while len(self.stack) > size:
            x = self.stack.pop()
            self.by_tag[x[0]].pop()
            for kind in self._kinds(x):
                self.by_kind[kind].pop()

    def last(self, tag: str) -> int:
        at = self.by_tag.get(tag)
        return at[-1] if at else -1

    def last_of(self, kind: str) -> int:
        at = self.by_kind.get(kind)
        return at[-1] if at else -1

    def seen(self) -> bool:
        return not self.by_kind["unseen"]

    def first_unseen(self) -> int:
        return self.by_kind["unseen"][0] if self.by_kind["unseen"] else len(self.stack)

    def content(self) -> int:
        return 2 if self.by_kind["content 2"] else 1 if self.by_kind["content 1"] else 0

    def place(self) -> int:
        """-1 in the frame, else 2, 1 or 0. A header in an article counts from a heading in it on only."""
        if self.by_kind["dropped"] or self.last_of("wanted") > self.last_of("heading"):
            return -1
        return self.content()

    def names(self) -> str:
        return self.stack[self.by_kind["named"][0]][4] if self.by_kind["named"] else ""

    def end(self, names: set[str], stops: set[str]) -> None:
        """Close the last open element of names, unless one of stops or an unseen one lies above it."""
        at = max(map(self.last, names))
        if at >= 0 and at > max(map(self.last, stops), default=-1) and at > self.last_of("unseen"):
            self.cut(at)

    def end_paragraph(self) -> None:
        at = self.last("p")
        if at > self.last_of("block") and at > self.last_of("unseen"):
            self.cut(at)


def blocks_of(page: str) -> list[tuple[int, str, str]]:
    """(place, names, text) of a page's blocks: place is 2 or 1 in its article, 0 in neither article nor frame, -1 in its frame; names are those of an element of _MAYBE around it.

    White space in a block is one space; character references are decoded.
    """
    page = _RAW.sub("", page)
    open_ = _Open()
    parts: list[str] = []
    out: list[tuple[int, str, str]] = []

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((open_.place(), open_.names(), text))

    last = 0
    for m in _TAG.finditer(page):
        if m.start() > last and open_.seen():
            parts.append(page[last : m.start()])
        last = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        block = tag in _BLOCK
        if block and not m[1] and tag not in _OPTIONS and not open_.seen() and open_.stack[open_.first_unseen()][0] == "select":
            open_.cut(open_.first_unseen())
        seen = open_.seen()
        if tag == "br" or tag in _APART:
            if seen:
                parts.append(" ")
            continue
        if m[1]:
            k = open_.last(tag)
            if seen and (block or k >= 0 and parts and tag not in _UNSEEN) or 0 <= k < open_.first_unseen():
                flush()
            if k >= 0:
                open_.cut(k)
            continue
        if block and seen:
            flush()
        if tag in _VOID:
            continue
        if block and tag in _ENDS:
            open_.end(*_ENDS[tag])
        if block:
            open_.end_paragraph()
        if tag in _UNSEEN:
            if not m[3].endswith("/"):
                open_.push(tag, False, 0, False, "")
            continue
        in_content = open_.content() > 0
        dropped, content, names = _kind(tag, m[3], in_content)
        if block or dropped:
            if not block and parts and seen:
                flush()
            open_.push(tag, dropped, content, in_content and tag == "header", names)
    if last < len(page) and open_.seen():
        parts.append(page[last:])
    flush()
    return out


def sort_blocks(blocks: list[tuple[int, str, str]], part_of: set[str]) -> tuple[list[str], list[str], list[str]]:
    """Texts of blocks in the article, in neither article nor frame (where there is no article), and in the frame; part_of has the names of _MAYBE that don't make a frame here."""
    best = max((k for k, _, _ in blocks), default=0)
    framed = lambda k, names: k < best or k < 0 or bool(names) and names not in part_of
    chosen = [t for k, names, t in blocks if not framed(k, names)]
    frame = [t for k, names, t in blocks if framed(k, names)]
    return (chosen, [], frame) if best > 0 else ([], chosen, frame)


def page_blocks(page: str) -> tuple[list[str], list[str], list[str]]:
    """Blocks of text of a page by its structure alone: in its article, in neither article nor frame (where there is no article), and in its frame."""
    return sort_blocks(blocks_of(page), set())


def host_of(url: str | None) -> str:
    """What stands between the first :// and the next /, ? or #, A-Z as a-z; empty without ://."""
    _, found, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].translate({c: c + 32 for c in range(65, 91)}) if found else ""


def hash_text(text: str) -> int:
    """64-bit hash of a text, the same in every process."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


@lru_cache(1024)
def _seed(host: str, kind: int) -> np.uint64:
    return combine([np.array([hash_text(f"{kind} {host}")], np.uint64)])[0]


def text_keys(texts: list[str], host: str, kind: int) -> np.ndarray:
    """A key for each whole text."""
    return mix(np.array([hash_text(t) for t in texts], np.uint64) ^ _seed(host, kind))


def window_keys(blocks: list[str], host: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key of the DEPTH words from each word on, not beyond its block (0 where fewer are left, but for a short block's first); block of each word; hash of each word."""
    raw = [b.encode() for b in blocks]
    w = split_words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), NONSPACE)
    h, size = w.hashes, np.diff(w.ptr)
    owner = np.repeat(np.arange(len(blocks)), size)
    keys = np.zeros(len(h), np.uint64)
    if len(h) >= DEPTH:
        m = len(h) - DEPTH + 1
        whole = owner[:m] == owner[DEPTH - 1 :]
        keys[:m][whole] = mix(combine([h[k : k + m] for k in range(DEPTH)])[whole] ^ _seed(host, WINDOW))
    for b in np.flatnonzero((size > 0) & (size < DEPTH)):
        own = h[w.ptr[b] : w.ptr[b + 1]]
        keys[w.ptr[b]] = mix(combine([own[k : k + 1] for k in range(len(own))]) ^ _seed(host, WINDOW))[0]
    return keys, owner, h


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the tokens in order, and the longest common prefix of each with the one before it (0 for the first); by prefix doubling."""
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    ranks, step = [rank.astype(np.int32)], 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        pair = rank.astype(np.int64) * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        new = np.ones(n, np.int64)
        new[1:] = pair[order[1:]] != pair[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if n == 0 or rank[order[-1]] == n - 1:
            break
        ranks.append(rank.astype(np.int32))
        step *= 2
    # Two suffixes of one rank at a level have that level's 2**level tokens in common.
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[ranks[level][a[inside]] == ranks[level][b[inside]]]
        for x in (a, b):
            x[same] += 1 << level
        common[same + 1] += 1 << level
    return order, common


def suffix_runs(tokens: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of suffixes whose longest common prefixes have DEPTH tokens or more: (first suffix, distinct pages) of each."""
    order, common = suffix_array(tokens)
    if not len(order):
        return order, np.zeros(0, np.int64)
    run = np.cumsum(common < DEPTH) - 1
    pairs = np.unique(run * (int(page.max()) + 1) + page[order])
    return order[common < DEPTH], np.bincount(pairs // (int(page.max()) + 1), minlength=run[-1] + 1)


EVIDENCE = {"host": pa.string(), "key": pa.int64(), "kind": pa.int32(), "pages": pa.int64()}


def _found(host: str, pages: list[tuple[np.ndarray, ...]]) -> list[pa.RecordBatch]:
    """The evidence of some pages of a host: for each its stream's window keys and tokens, and the keys of short blocks, of articles' blocks and of names."""
    stream, window = np.concatenate([p[1] for p in pages]), np.concatenate([p[0] for p in pages])
    first, n = suffix_runs(stream, np.repeat(np.arange(len(pages)), [len(p[1]) for p in pages]))
    real = (window[first] != 0) & ~np.isin(window[first], np.concatenate([p[2] for p in pages]))
    out = [(window[first][real], n[real], WINDOW)]
    for at, kind in ((2, WINDOW), (3, BLOCK), (4, NAME)):
        out.append((*np.unique(np.concatenate([np.unique(p[at]) for p in pages]), return_counts=True), kind))
    rows = [(pa.array([host] * len(k), pa.string()), k.view(np.int64), pa.array([kind] * len(k), pa.int32()), n.astype(np.int64)) for k, n, kind in out if len(k)]
    return [pa.record_batch(list(r), names=list(EVIDENCE)) for r in rows]


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, key, kind, pages) of what stands on how many pages, by suffix arrays over blocks of pages."""
    held: dict[str, list] = defaultdict(list)
    size = 0
    for batch in batches:
        for url, page in zip(batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
            blocks, host = blocks_of(page or ""), host_of(url)
            article, loose, frame = sort_blocks(blocks, set())
            keys, owner, words = window_keys(frame + loose, host)
            # Between blocks stands a mark; the last one is the page's own, so that no repeat goes beyond a page.
            ends = np.searchsorted(owner, np.arange(len(frame) + len(loose)), side="right")
            marks = np.arange(len(ends), dtype=np.uint64) + np.uint64(size)
            names = sorted({x for _, x, _ in blocks if x})
            short = keys[(keys != 0) & (np.bincount(owner, minlength=1)[owner] < DEPTH)] if len(owner) else keys
            held[host].append((np.insert(keys, ends, 0), np.insert(words, ends, marks), short, text_keys(article, host, BLOCK), text_keys(names, host, NAME)))
            size += len(words) + len(ends) + len(article) + 1
            if size >= ARRAY_TOKENS:
                for host, pages in held.items():
                    yield from _found(host, pages)
                held, size = defaultdict(list), 0
    for host, pages in held.items():
        yield from _found(host, pages)


def unique_runs(blocks: list[str], host: str, repeated: np.ndarray) -> list[str]:
    """What of the blocks no repeated run of the host covers; all of them where nothing else is left, as on copies of a page."""
    if not blocks or not len(repeated):
        return blocks
    keys, owner, _ = window_keys(blocks, host)
    size = np.bincount(owner, minlength=len(blocks))
    hit = np.flatnonzero((keys != 0) & np.isin(keys, repeated))
    if not len(hit):
        return blocks
    edge = np.zeros(len(keys) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + np.minimum(size[owner[hit]], DEPTH), -1)
    inside, at, out = np.cumsum(edge) > 0, 0, []
    for block, n in zip(blocks, size.tolist(), strict=True):
        own = inside[at : at + n]
        at += n
        kept = " ".join(t for t, x in zip(block.split(" "), own.tolist(), strict=True) if not x) if own.any() else block
        if kept:
            out.append(kept)
    return out or blocks


def own_blocks(blocks: list[str], host: str, repeated: np.ndarray) -> list[str]:
    """An article's blocks without those that repeat on its host, unless these make up MOST_COVERED of its words: then it is one of several copies."""
    if not blocks or not len(repeated):
        return blocks
    hit = np.isin(text_keys(blocks, host, BLOCK), repeated)
    words = np.array([b.count(" ") + 1 for b in blocks])
    return [b for b, x in zip(blocks, hit, strict=True) if not x] if hit.any() and words[hit].sum() < MOST_COVERED * words.sum() else blocks


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for url, page, keys in zip(batch["url"].to_pylist(), batch["html"].to_pylist(), batch["keys"].to_pylist(), strict=True):
            blocks, host, known = blocks_of(page or ""), host_of(url), np.array(keys or [], np.int64).view(np.uint64)
            names = sorted({x for _, x, _ in blocks if x})
            part_of = {x for x, k in zip(names, text_keys(names, host, NAME), strict=True) if (known == k).any()} if names else set()
            article, loose, _ = sort_blocks(blocks, part_of)
            out.append("\n".join(own_blocks(article, host, known) or unique_runs(loose, host, known)))
        yield pa.record_batch([batch["page_id"].cast(pa.int64()), batch["url"], pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text and n_chars for every row of pages.

    Elements that are menus, headers, footers, sidebars, notices, adverts, forms or
    comments by tag, role or names go. A page's article (or main) element, or else
    one whose names say so, is then its text. What repeats on the host decides the
    rest, on every page: elements of the names of _MAYBE stay where they stand on
    less than least_pages pages of a host that has as many, and else go; blocks of an
    article go that stand on BLOCK_SHARE of the host's pages, and least_pages at
    least, unless they are most of it; where a page has no article, runs of DEPTH or
    more words go that stand on least_pages pages and on least_share of the host's.

    A null or empty page gives '' and 0; a null url has the host '' and stays null;
    malformed and cut pages are read as far as they go, in a time in proportion to
    their length, however deep. Repeated rows give a row each and count as pages of
    their own; other columns are not read. A hot host is spread: each task counts its
    own pages, and counts are combined by key.
    """
    src = small_batches(pages).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    totals = src.groupBy(host.alias("host")).agg(F.count("*").alias("total"))
    found = src.select("url", "html").mapInArrow(_evidence, "host string, key long, kind int, pages long").groupBy("host", "key", "kind").agg(F.sum("pages").alias("pages"))
    found = found.where((F.col("pages") >= least_pages) | (F.col("kind") == NAME))
    share = F.when(F.col("kind") == WINDOW, F.lit(least_share)).otherwise(F.lit(BLOCK_SHARE))
    rare = (F.col("pages") < least_pages) & (F.col("total") >= least_pages)
    often = settle(found.join(totals, "host").where(F.when(F.col("kind") == NAME, rare).otherwise(F.col("pages") >= F.col("total") * share)).select("host", "key"))
    keys = often.groupBy("host").agg(F.collect_set("key").alias("keys"))
    placed = src.withColumn("host", host).join(F.broadcast(keys) if often.count() <= BROADCAST_KEYS else keys, "host", "left")
    return placed.select("page_id", "url", "html", "keys").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
