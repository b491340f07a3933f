"""Field-based search: query strategies, a parser of the query language, and its compilation to columns."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Fields = dict[str, list[str]]
MUST = ("publicationDate", "host.volume")


def _clause(field: str, tokens: list[str]) -> str:
    return f"{field}:{tokens[0]}" if len(tokens) == 1 else f"{field}:({' '.join(tokens)})"


def _wild(field: str, tokens: list[str], parity: bool) -> list[str]:
    """Journal tokens as prefixes, and j for journal; with parity, any token that begins with j."""
    if field != "host.title" or len(tokens) >= 8:
        return tokens
    one = re.compile(r"j|J|\]\.?") if parity else re.compile(r"(?:j|J|\])\.?$")
    return ["journal" if one.match(t) else (t[:-1] if t.endswith(".") else t) + "*" for t in tokens]


def _token_clauses(tokens: Fields, wild: bool = False, parity: bool = True) -> list[tuple[str, str]]:
    out = []
    for field, own in tokens.items():
        if field == "_NULL_":
            out += [(field, t) for t in own]
        else:
            out.append((field, _clause(field, _wild(field, own, parity) if wild and field not in MUST else own)))
    return out


def _quoted(values: Fields) -> list[str]:
    return [(f'"{v}"' if f == "_NULL_" else f'{f}:"{v}"') for f, vs in values.items() for v in vs]


def _must_should(clauses: list[tuple[str, str]]) -> str | None:
    must = [c for f, c in clauses if f in MUST]
    return f"({' AND '.join(must)}) AND ({' '.join(c for f, c in clauses if f not in MUST)})" if must else None


#: Strategies by name: functions of the whole values and the tokens of a reference, by field.
STRATEGIES = {
    "bag_of_words": lambda values, tokens: " ".join(v for vs in values.values() for v in vs if v),
    "all_quoted": lambda values, tokens: " AND ".join(_quoted(values)),
    "any_quoted": lambda values, tokens: " ".join(_quoted(values)),
    "any_token": lambda values, tokens: " ".join(c for _, c in _token_clauses(tokens)),
    "must_should": lambda values, tokens: _must_should(_token_clauses(tokens)),
    "must_should_wild": lambda values, tokens: _must_should(_token_clauses(tokens, wild=True)),
    "all_tokens": lambda values, tokens: " AND ".join(c for _, c in _token_clauses(tokens)),
    "all_tokens_wild": lambda values, tokens: " AND ".join(c for _, c in _token_clauses(tokens, wild=True)),
    "production": lambda values, tokens: " ".join([c for f, c in _token_clauses(tokens) if f == "_NULL_"] + [c for f, c in _token_clauses(tokens, wild=True) if f != "_NULL_"]),
}
METHODS = tuple(STRATEGIES)[:8]


@dataclass(frozen=True)
class Node:
    """kind: term, phrase, range, exists, all, not, and, or, should."""

    kind: str
    field: str | None = None
    value: str = ""
    parts: tuple["Node", ...] = ()


_TOKEN = re.compile(r'\s*(?:(\()|(\))|(\[[^\]]*\])|"((?:[^"\\]|\\.)*)"|((?:\\.|[^\s()":\[\]\\])+):(?=\S)|((?:\\.|[^\s()"\\])+))')


def parse(query: str) -> Node:
    """The query as a tree: fields, groups, phrases, ranges, AND, OR, NOT, and juxtaposition."""
    items = [m.groups() for m in _TOKEN.finditer(query)]
    at = 0

    def group(field: str | None) -> Node:
        nonlocal at
        parts, joins, negate = [], set(), False
        while at < len(items):
            opened, closed, span, phrase, name, word = items[at]
            if closed:
                break
            at += 1
            if word in ("AND", "OR"):
                joins.add(word)
                continue
            if word == "NOT":
                negate = True
                continue
            own = field
            if name:
                own = re.sub(r"\\(.)", r"\1", name)
                opened, closed, span, phrase, name, word = items[at]
                at += 1
            if opened:
                node = group(own)
                at += 1
            elif span:
                low, _, high = span[1:-1].partition(" TO ")
                node = Node("range", own, f"{low}\t{high}")
            elif phrase is not None:
                node = Node("phrase", own, phrase)
            else:
                term = re.sub(r"\\(.)", r"\1", word or "")
                node = Node("all") if term == "*" and own is None else Node("exists", own) if term == "*" else Node("term", own, term)
            if node.kind != "should" or node.parts:  # an empty group is no condition
                parts.append(Node("not", parts=(node,)) if negate else node)
            negate = False
        if len(parts) == 1:
            return parts[0]
        return Node("and" if joins == {"AND"} else "or" if joins else "should", parts=tuple(parts))

    return group(None)


def _tokens_of(fields: dict[str, Column], field: str | None) -> list[Column]:
    own = fields.values() if field is None else [fields[field]] if field in fields else []
    return [F.regexp_extract_all(F.lower(c.cast("string")), F.lit(r"([\p{L}\p{N}_]+)"), 1) for c in own]


def score(node: Node, fields: dict[str, Column]) -> Column:
    """How many terms of the query a row matches; 0 if it doesn't match. fields has the indexed columns."""
    hit = lambda tests: reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests], F.lit(False)).cast("int")
    if node.kind == "all":
        return F.lit(1)
    if node.kind == "term":
        term = node.value.lower()
        if "*" in term or "?" in term:
            pattern = "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in term) + "$"
            return hit(F.exists(t, lambda x: x.rlike(pattern)) for t in _tokens_of(fields, node.field))
        return hit(F.array_contains(t, term) for t in _tokens_of(fields, node.field))
    if node.kind == "phrase":
        wanted = " ".join(re.findall(r"\w+", node.value.lower()))
        return hit(F.contains(F.concat(F.lit(" "), F.array_join(t, " "), F.lit(" ")), F.lit(f" {wanted} ")) for t in _tokens_of(fields, node.field)) if wanted else hit([])
    if node.kind == "exists":
        return hit([fields[node.field].isNotNull()] if node.field in fields else [])
    if node.kind == "range":
        low, high = node.value.split("\t")
        c = fields.get(node.field, F.lit(None))
        return hit([(F.lit(True) if low == "*" else c >= low) & (F.lit(True) if high == "*" else c <= high) & c.isNotNull()])
    own = [score(p, fields) for p in node.parts]
    if node.kind == "not":
        return (own[0] == 0).cast("int")
    total = reduce(lambda a, b: a + b, own, F.lit(0))
    if node.kind == "and":
        return F.when(reduce(lambda a, b: a & b, [o > 0 for o in own], F.lit(True)), total).otherwise(0)
    return total


def search(docs: DataFrame, query: str, fields: dict[str, str], limit: int | None = None, key: str = "id") -> DataFrame:
    """Rows that match, with their score, best first; ties by key."""
    rows = docs.withColumn("score", score(parse(query), {f: F.col(c) for f, c in fields.items()})).where("score > 0")
    return rows if limit is None else rows.orderBy(F.desc("score"), key).limit(limit)


def page(docs: DataFrame, query: str, fields: dict[str, str], start: int = 0, size: int = 100, output: list[str] | None = None, key: str = "id") -> DataFrame:
    """The hits from place start on, size of them, best first and ties by key, with the columns of output."""
    rows = search(docs, query, fields, key=key).orderBy(F.desc("score"), key).offset(start).limit(size)
    return rows if output is None else rows.select(*output)


def count(docs: DataFrame, query: str, fields: dict[str, str]) -> int:
    """How many rows match."""
    return search(docs, query, fields).count()


def facet(docs: DataFrame, field: str, query: str, fields: dict[str, str]) -> DataFrame:
    """Values of a field and how many matching rows have each."""
    return search(docs, query, fields).groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"))


def corpora_constraint(corpora: list[str], native: str = "refBibsNative") -> str:
    """A query for documents of the corpora that have references of their own."""
    return f"{native}:true AND ({' OR '.join(f'corpusName:{c}' for c in corpora)})"


def both(stratum: str, constraint: str | None) -> str:
    """A stratum's query, within a constraint if there is one."""
    return f"({stratum}) AND ({constraint})" if constraint else stratum


def unknown_fields(names: list[str], known: list[str]) -> list[str]:
    """Those of names that aren't known."""
    return [n for n in names if n not in known]


#: Tokens of all queries that are broadcast at most, to drop others from the documents before the shuffle.
BROADCAST_TOKENS = 200_000


def match_any_token(queries: DataFrame, docs: DataFrame, q_key: str, q_text: str, d_key: str, d_text: str, least: int = 4) -> DataFrame:
    """q_key, d_key and the number of distinct tokens that both have, by an equi-join on tokens.

    Where the queries' tokens are few, others are dropped from the documents before
    the shuffle; a token of very many documents is split by the adaptive skew join,
    which another shuffle follows; partial counts come before that.
    """
    token = lambda df, key, text: df.select(F.col(key), F.explode(F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), 1), lambda t: F.length(t) >= least))).alias("token"))
    q, d = token(queries, q_key, q_text), token(docs, d_key, d_text)
    asked = q.select("token").distinct()
    if asked.count() <= BROADCAST_TOKENS:
        d = d.join(F.broadcast(asked), "token", "left_semi")
    return q.join(d, "token").groupBy(q_key, d_key).agg(F.count("*").alias("score"))


def top_hit(scores: DataFrame, q_key: str, d_key: str) -> DataFrame:
    """The best document of each query, ties to the least key."""
    rank = F.row_number().over(W.partitionBy(q_key).orderBy(F.desc("score"), d_key))
    return scores.withColumn("__r", rank).where("__r = 1").drop("__r")


def build_queries(fields: DataFrame, strategy: str = "production") -> DataFrame:
    """doc_key, bib_id and query of each reference, from its maps values and tokens by field."""
    make = STRATEGIES[strategy]

    @F.pandas_udf("string")
    def run(pairs):
        return pairs.map(lambda p: make(*json.loads(p)))

    both = F.concat(F.lit("["), F.to_json("values"), F.lit(","), F.to_json("tokens"), F.lit("]"))
    return fields.select("doc_key", "bib_id", run(both).alias("query"))
