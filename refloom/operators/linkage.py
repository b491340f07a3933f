"""Record linkage: alignment rules, greedy one-to-one assignment, validated lookup and field diagnosis."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions import text as tx
from refloom.functions.layout import spread

RULES = ("strict:ti+date", "strict:au+date", "strict:j+vol+p", "heuri:ti+autres")
FIELDS = ("tit", "date", "j", "vol", "iss", "fpg", "lpg", "psher")


def align_documents(gold: DataFrame, todo: DataFrame, key: str = "doc_key") -> tuple[DataFrame, DataFrame]:
    """Keys that both have, and keys of todo without gold."""
    g, t = gold.select(key).distinct(), todo.select(key).distinct()
    return t.join(g, key), t.join(g, key, "left_anti")


def keyed(refs: DataFrame) -> DataFrame:
    """refs with what the rules compare: match keys of title, names and journal, and the bare title; once a row, not once a pair."""
    names = F.array_join("names", " ")
    return refs.withColumns({
        "__names": names, "__first": F.try_element_at("names", F.lit(1)), "__k_tit": tx.match_key(F.col("tit")), "__k_names": tx.match_key(names), "__k_j": tx.match_key(F.col("j")),
        "__poor": F.regexp_replace(F.lower("tit"), "[^a-z0-9]+", ""),
    })


def rule_number(g: Callable[[str], Column], t: Callable[[str], Column], compare_dates: bool = False) -> Column:
    """The first of RULES that a gold and an extracted reference, both keyed, satisfy, from 1; null if none.

    The second rule asks for dates on both sides only; compare_dates makes it compare them.
    """
    same = lambda f, k: tx.clean_equal(g(f), t(f), keys=(g(k), t(k)))
    same_date = g("date") == t("date")
    title = same_date & same("tit", "__k_tit")
    author = (same_date if compare_dates else g("date").isNotNull() & t("date").isNotNull()) & same("__names", "__k_names")
    place = (g("vol") == t("vol")) & (g("fpg") == t("fpg")) & same("j", "__k_j")
    within = same_date & (F.length(g("__poor")) > 6) & F.contains(t("__poor"), g("__poor")) & (F.coalesce(g("__first") == t("__first"), F.lit(False)) | F.coalesce(g("fpg") == t("fpg"), F.lit(False)))
    return F.when(title, 1).when(author, 2).when(place, 3).when(within, 4)


def candidates(gold: DataFrame, todo: DataFrame, key: str = "doc_key", compare_dates: bool = False) -> DataFrame:
    """key, g, t and rule of all pairs of a document that satisfy a rule."""
    # Dealt by document first, so that keys are made before the join and on all cores.
    pairs = keyed(spread(gold, key)).alias("g").join(keyed(spread(todo, key)).alias("t"), key)
    rule = rule_number(lambda c: F.col(f"g.{c}"), lambda c: F.col(f"t.{c}"), compare_dates)
    return pairs.select(key, "g.g", "t.t", rule.alias("rule")).where("rule is not null")


PAIRS = "array<struct<g:bigint,t:bigint,rule:int>>"


def _ordered(pairs: DataFrame, key: str) -> DataFrame:
    """key and __all, its candidates by gold, then extracted reference."""
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("g").cast("long").alias("g"), F.col("t").cast("long").alias("t"), F.col("rule").cast("int").alias("rule")))).alias("__all"))


def _fold(every: Column) -> Column:
    """Of ordered candidates those that neither side of has been taken before."""
    taken = lambda acc, x, f: F.exists(acc, lambda y: y[f] == x[f])
    return F.aggregate(every, F.array().cast(PAIRS), lambda acc, x: F.when(taken(acc, x, "g") | taken(acc, x, "t"), acc).otherwise(F.concat(acc, F.array(x))))


def greedy(pairs: DataFrame, key: str = "doc_key") -> DataFrame:
    """One-to-one pairs: each gold reference in order takes the first free extracted one that it may match."""
    return _ordered(pairs, key).select(key, F.inline(_fold(F.col("__all"))))


def _whole_documents(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of all rows of one or more documents, from batches in which a document's rows follow each other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_pylist()
        start = len(keys)
        while start and keys[start - 1] == keys[-1]:
            start -= 1
        if start or (held and keys[-1] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


#: What the rules compare of a reference.
COMPARED = ("tit", "date", "j", "vol", "fpg", "names")


class _Reference:
    """What the rules compare of a reference; keys are (length, match key), and the bare title is made when it is first asked for."""

    __slots__ = ("place", "id", "tit", "date", "j", "vol", "fpg", "first", "names", "k_tit", "k_j", "k_names", "_poor")

    def __init__(self, place, id_, tit, date, j, vol, fpg, first, names):
        self.place, self.id, self.tit, self.date, self.j, self.vol, self.fpg, self.first, self.names, self._poor = place, id_, tit, date, j, vol, fpg, first, names, None

    @property
    def poor(self) -> str:
        if self._poor is None:
            self._poor = "" if self.tit is None else re.sub("[^a-z0-9]+", "", self.tit.lower())
        return self._poor


Sides = tuple[list[_Reference], list[_Reference]]


def _set_keys(documents: list[Sides]) -> None:
    """Match keys of all references of documents, made at once. A journal is left out where the other side has no reference of its volume and page: no rule asks for it."""
    met = []
    for gold, todo in documents:
        places = {(r.vol, r.fpg) for r in gold} & {(r.vol, r.fpg) for r in todo}
        met += [(r, r.j if (r.vol, r.fpg) in places else None) for side in (gold, todo) for r in side]
    texts = {x for r, j in met for x in (r.tit, r.names, j)}
    texts.discard(None)
    keyed = {x: (len(x), k) for x, k in zip(texts, tx.match_keys(list(texts)), strict=True)}
    keyed[None] = (0, "")
    for r, j in met:
        r.k_tit, r.k_names, r.k_j = keyed[r.tit], keyed[r.names], keyed[j]


def _soft(g: tuple[int, str], t: tuple[int, str]) -> bool:
    """text.clean_equal of two (length, match key)."""
    (la, ka), (lb, kb) = g, t
    if not la or not lb or la > 2 * lb or lb > 2 * la:
        return False
    return ka == kb or (la > 5 and lb > 5 and 0.7 < la / lb < 1.3 and (kb in ka if len(ka) >= len(kb) else ka in kb))


def _rule_of(g: _Reference, t: _Reference, compare_dates: bool) -> int | None:
    """rule_number of two references."""
    dated = g.date is not None and t.date is not None
    same_date = dated and g.date == t.date
    if same_date and _soft(g.k_tit, t.k_tit):
        return 1
    if (same_date if compare_dates else dated) and _soft(g.k_names, t.k_names):
        return 2
    same_page = g.fpg is not None and g.fpg == t.fpg
    if same_page and g.vol is not None and g.vol == t.vol and _soft(g.k_j, t.k_j):
        return 3
    if same_date and (same_page or (g.first is not None and g.first == t.first)) and len(g.poor) > 6 and g.poor in t.poor:
        return 4
    return None


def _by_id(refs: list[_Reference]) -> list[list[_Reference]]:
    """References of one id together, in the order of ids."""
    return [list(x) for _, x in itertools.groupby(refs, lambda r: r.id)]


def _pairs_of(gold: list[_Reference], todo: list[_Reference], compare_dates: bool) -> list[tuple[_Reference, _Reference, int]]:
    """Each gold reference in order with the first free extracted one that it may match; rows of one id are one reference, which the least rule of any of them matches."""
    free, pairs = _by_id(todo), []
    for same in _by_id(gold):
        for k, other in enumerate(free):
            if len(same) == len(other) == 1:
                rule = _rule_of(same[0], other[0], compare_dates)
                found = rule and (rule, same[0], other[0])
            else:
                found = min(((rule, g, t) for g in same for t in other if (rule := _rule_of(g, t, compare_dates))), key=lambda x: x[0], default=None)
            if found:
                pairs.append((found[1], found[2], found[0]))
                del free[k]
                break
    return pairs


Row = tuple[_Reference | None, _Reference | None, str, int | None]


def _rows_of(gold: list[_Reference], todo: list[_Reference], compare_dates: bool, alone: bool) -> list[Row]:
    """References of either side, alignment and rule of a document's pairs, and with alone of the references left over; none unless it has both sides."""
    if not gold or not todo:
        return []
    gold, todo = (sorted((r for r in x if r.id is not None), key=lambda r: r.id) for x in (gold, todo))
    pairs = _pairs_of(gold, todo, compare_dates)
    rows: list[Row] = [(g, t, "ali", rule) for g, t, rule in pairs]
    if alone:
        paired = {g.id for g, _, _ in pairs}, {t.id for _, t, _ in pairs}
        rows += [(r, None, "silence", None) for r in gold if r.id not in paired[0]]
        rows += [(None, r, "noise", None) for r in todo if r.id not in paired[1]]
    return rows


def _columns_of(rows: list[Row]) -> list[pa.Array]:
    """The columns g, t, alignment and rule."""
    ids = [pa.array([r[k] and r[k].id for r in rows], pa.int64()) for k in (0, 1)]
    return [*ids, pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.int32())]


def _names(key: str, fields: tuple[str, ...]) -> list[str]:
    return [key, "g", "t", "alignment", "rule", *(f"{k}_{f}" for k in "gt" for f in fields)]


def _meet(key: str, compare_dates: bool, fields: tuple[str, ...], alone: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over both sides' references, a document's together and in order: its pairs, and with alone the references left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_documents(batches, key):
            col = {c: table[c].to_pylist() for c in (key, "__todo", "__id", "tit", "date", "j", "vol", "fpg", "__first", "__names")}
            refs = list(map(_Reference, range(table.num_rows), *(col[c] for c in ("__id", "tit", "date", "j", "vol", "fpg", "__first", "__names"))))
            documents = []
            for _, rows in itertools.groupby(range(table.num_rows), col[key].__getitem__):
                rows = list(rows)
                documents.append(tuple([refs[k] for k in rows if col["__todo"][k] is side] for side in (False, True)))
            _set_keys(documents)
            rows = [r for gold, todo in documents for r in _rows_of(gold, todo, compare_dates, alone)]
            out = [table[key].take(pa.array([(g or t).place for g, t, _, _ in rows], pa.int64())), *_columns_of(rows)]
            out += [table[f].take(pa.array([r[k] and r[k].place for r in rows], pa.int64())) for k in (0, 1) for f in fields]
            yield from pa.table(out, names=_names(key, fields)).combine_chunks().to_batches()

    return run


References = Callable[..., tuple[list[tuple], list[tuple]]]
#: Documents that are met at once have about so many characters.
PORTION = 1 << 22


def _meet_within(key: str, columns: list[str], references: References, compare_dates: bool, fields: tuple[str, ...], alone: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """_meet over documents, the rows of one together, whose references are made here."""

    def made(place: int, id_, tit, date, j, vol, fpg, names) -> _Reference:
        first = names[0] if names else None
        joined = first if first is not None and len(names) == 1 else None if names is None else " ".join([x for x in names if x is not None])
        return _Reference(place, id_, tit, date, j, vol, fpg, first, joined)

    def met(keys: pa.ChunkedArray, documents: list[Sides]) -> Iterator[pa.RecordBatch]:
        _set_keys(documents)
        rows = [r for gold, todo in documents for r in _rows_of(gold, todo, compare_dates, alone)]
        out = [keys.take(pa.array([(g or t).place for g, t, _, _ in rows], pa.int64())), *_columns_of(rows)]
        out += [pa.array([r[k] and getattr(r[k], f) for r in rows], pa.string()) for k in (0, 1) for f in fields]
        yield from pa.table(out, names=_names(key, fields)).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_documents(batches, key):
            held, size = [], 0
            for _, rows in itertools.groupby(zip(table[key].to_pylist(), range(table.num_rows), *(table[c].to_pylist() for c in columns), strict=True), lambda x: x[0]):
                gold, todo = [], []
                for _, place, *values in rows:
                    size += sum(len(x) for x in values if isinstance(x, str))
                    for side, found in zip((gold, todo), references(*values), strict=True):
                        side += [made(place, *x) for x in found]
                held.append((gold, todo))
                if size >= PORTION:
                    yield from met(table[key], held)
                    held, size = [], 0
            if held:
                yield from met(table[key], held)

    return run


def _met(gold: DataFrame, todo: DataFrame, key: str, compare_dates: bool, fields: tuple[str, ...], alone: bool) -> DataFrame:
    """key, g, t, alignment, rule, and fields of either side as g_ and t_ columns.

    Both sides are dealt and sorted by document once. Python meets a document's
    references there: the match keys of a batch are made at once, and a gold reference
    is compared only up to the extracted one that it takes.
    """
    mine = ["date", "vol", "fpg", "tit", "j", *[f for f in fields if f not in ("date", "vol", "fpg", "tit", "j")]]
    side = lambda df, c, is_todo: df.where(F.col(key).isNotNull()).select(key, F.lit(is_todo).alias("__todo"), F.col(c).cast("long").alias("__id"), F.array_join("names", " ").alias("__names"), F.try_element_at("names", F.lit(1)).alias("__first"), *mine)
    both = side(gold, "g", False).unionByName(side(todo, "t", True))
    kinds = {f.name: f.dataType.simpleString() for f in both.schema}
    schema = f"`{key}` {kinds[key]}, g bigint, t bigint, alignment string, rule int" + "".join(f", `{k}_{f}` {kinds[f]}" for k in "gt" for f in fields)
    return spread(both, key).sortWithinPartitions(key, "__todo", "__id").mapInArrow(_meet(key, compare_dates, fields, alone), schema)


def paired(gold: DataFrame, todo: DataFrame, key: str = "doc_key", compare_dates: bool = False, fields: tuple[str, ...] = ()) -> DataFrame:
    """key, g, t and rule of greedy's pairs of candidates, which aren't all made; with fields, those of both sides too, as g_ and t_ columns."""
    return _met(gold, todo, key, compare_dates, fields, False).drop("alignment")


def align(gold: DataFrame, todo: DataFrame, key: str = "doc_key", compare_dates: bool = False) -> DataFrame:
    """key, g, t, alignment (ali, silence or noise) and rule of every reference of documents that both sides have.

    Rows without an id can't be named and take no part. A document's references meet
    once; what is silence or noise is told there, so nothing is joined again.
    """
    return _met(gold, todo, key, compare_dates, (), True)


def align_within(docs: DataFrame, key: str, columns: list[str], references: References, compare_dates: bool = False, alone: bool = True, fields: tuple[str, ...] = ()) -> DataFrame:
    """align, or without alone the pairs only, where both sides are made of the documents' own columns; with fields, those of COMPARED but names of both sides too, as g_ and t_ columns.

    references gives the gold and the extracted references of a row, from its values of
    columns, each as a tuple of its id and COMPARED. Rows of one key are one document.
    The documents are dealt and sorted by key as they are, and references are made
    where they meet: a text travels once, not with each field of each side.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, g bigint, t bigint, alignment string, rule int" + "".join(f", `{k}_{f}` string" for k in "gt" for f in fields)
    dealt = spread(docs.select(key, *columns).where(F.col(key).isNotNull()), key).sortWithinPartitions(key, *columns)
    return dealt.mapInArrow(_meet_within(key, columns, references, compare_dates, fields, alone), schema)


def validate_hit(bib: Callable[[str], Column], hit: Callable[[str], Column], issn: Column) -> Column:
    """Which rule shows that a hit is the reference: 1a journal by ISSN, 1b journal by name, 2 title and author; null if none."""
    date = bib("date") == hit("publicationDate")
    place = date & (bib("volume") == hit("host.volume")) & (bib("first_page") == hit("host.pages.first")) & hit("host.issn").isNotNull()
    author = F.element_at(F.split(F.try_element_at(hit("author"), F.lit(1))["name"], " "), -1)
    ok = lambda x: F.coalesce(x, F.lit(False))
    return (
        F.when(ok(place & F.array_contains(hit("host.issn"), issn)), "1a").when(ok(place & tx.soft_equal(bib("host_title"), hit("host.title"))), "1b")
        .when(ok(date & tx.soft_equal(bib("title"), hit("title")) & tx.soft_equal(bib("author"), author)), "2")
    )


def with_issn(bibs: DataFrame, abbreviations: DataFrame, title: str = "host_title", trim: bool = True) -> DataFrame:
    """bibs with the ISSN of their abbreviated journal title; a small dictionary is broadcast by the optimizer."""
    from refloom.sources.tables import abbreviation_key

    keyed = bibs.withColumn("__key", abbreviation_key(F.col(title), trim))
    one = abbreviations.groupBy(F.col("key").alias("__key")).agg(F.min("issn").alias("issn"))
    return keyed.join(one, "__key", "left").drop("__key")


def any_cell(rows: DataFrame, value: str, table: DataFrame, cells: list[str], result: str) -> DataFrame:
    """rows with the result column of the table's row that has the value in any of its cells (the least of several); null where none has."""
    known = table.select(F.explode(F.array_distinct(F.array(*[F.trim(c) for c in cells]))).alias("__cell"), F.col(result)).where("__cell is not null and __cell <> ''")
    one = known.groupBy("__cell").agg(F.min(result).alias(result))
    return rows.withColumn("__cell", F.trim(value)).join(one, "__cell", "left").drop("__cell")


def names_aligned(gold: Column, todo: Column) -> Column:
    """How many gold names find a free extracted name that is softly equal, in order."""
    start = F.array().cast("array<int>")
    places = lambda g: F.filter(F.sequence(F.lit(1), F.size(todo)), lambda k: tx.clean_equal(g, F.element_at(todo, k)))
    step = lambda acc, g: F.concat(acc, F.slice(F.array_except(places(g), acc), 1, 1))
    return F.when((F.size(gold) > 0) & (F.size(todo) > 0), F.size(F.aggregate(gold, start, step))).otherwise(0)


def _both(step: Callable[[str], str]) -> Callable[[str, str], tuple[bool, str, str]]:
    def run(g: str, t: str) -> tuple[bool, str, str]:
        g, t = step(g), step(t)
        return g == t, g, t

    return run


def _hyphen(pattern: str, by: str, needs: str) -> Callable[[str, str], tuple[bool, str, str]]:
    compiled = re.compile(pattern)
    return _both(lambda x: compiled.sub(by, x) if needs in x else x)


def _longer(g: str, t: str) -> tuple[bool, str, str]:
    return len(g) > 5 and len(t) <= len(g) + len(g) // 5 and g in t, g, t


def _shorter(g: str, t: str) -> tuple[bool, str, str]:
    return len(t) > 5 and len(g) <= len(t) + len(t) // 5 and t in g, g, t


#: Comparers in their order, by the stamp each leaves; the last two come last.
COMPARERS: dict[str, Callable[[str, str], tuple[bool, str, str]]] = {
    "rmhyph.": _hyphen(r"(?<=\w)- ?(?=\w)", "", "-"),
    "joinhyph.": _hyphen(r"(?<=\w)- ", "-", "- "),
    "norpun.": _both(tx.even_punctuation_text),
    "norspa.": _both(tx.even_spaces_text),
    "punct.": _both(tx.simple_punctuation_text),
    "OCeeRs.": _both(tx.ocr_eval_text),
    "allongé.": _longer,
    "raccourci.": _shorter,
}


def diagnosis(gold: str | None, todo: str | None, field: str = "", substring_info: bool = False) -> str | None:
    """How an extracted field compares with gold: the smallest, then earliest, combination of comparers that makes them equal."""
    if gold is None:
        return None if todo is None else "NON_bruit"
    if todo is None:
        return "NON_silence"
    if not todo:
        return "NON_silence_vide"
    if gold == todo:
        return "OUI"
    sizes = lambda a, b, sign: f"({a}{sign}{b - a if sign == '+' else a - b})" if substring_info else ""
    if field == "tit" and "http" in todo and len(gold) > 7 and gold in todo:
        return "NON_+long_tit_http" + sizes(len(gold), len(todo), "+")
    # Combinations of one size follow each other in order; what a shorter one left is where longer ones go on.
    # A state that an earlier combination reached, with no fewer comparers still ahead, can't end sooner: it is not followed.
    names = list(COMPARERS)
    level, reached = [(-1, gold, todo, "")], {(gold, todo): -1}
    while level:
        longer = []
        for last, g, t, trace in level:
            for k in range(last + 1, len(names)):
                ok, g2, t2 = COMPARERS[names[k]](g, t)
                stamp = {"allongé.": f"allongé{sizes(len(g), len(t), '+')}.", "raccourci.": f"raccourci{sizes(len(g), len(t), '-')}."}.get(names[k], names[k])
                if ok:
                    return f"OUI_avec:{trace}{stamp}OK"
                if reached.get((g2, t2), len(names)) > k:
                    reached[g2, t2] = k
                    longer.append((k, g2, t2, trace + stamp))
        level = longer
    return "NON_diff"


def diagnose(pairs: DataFrame, keep: list[str], fields: tuple[str, ...] = FIELDS, dealt: bool = False) -> DataFrame:
    """keep and a diagnosis column for each field, from columns g_field and t_field; Arrow batches. Unless they are dealt over all cores already, rows are dealt by keep."""

    @F.pandas_udf(", ".join(f"`{f}` string" for f in fields))
    def run(*columns: pd.Series) -> pd.DataFrame:
        clean = lambda x: x if isinstance(x, str) else None
        # Only a title's address depends on the field: equal pairs of other fields are told once for all of them.
        known, out = {}, {}
        for k, f in enumerate(fields):
            said = []
            for g, t in zip(columns[2 * k], columns[2 * k + 1], strict=True):
                g, t = clean(g), clean(t)
                told = (g, t, f == "tit" and t is not None and "http" in t)
                if told not in known:
                    known[told] = diagnosis(g, t, f)
                said.append(known[told])
            out[f] = pd.Series(said, dtype=object)
        return pd.DataFrame(out)

    rows = pairs if dealt else spread(pairs, *keep)
    said = run(*[F.col(f"{k}_{f}") for f in fields for k in "gt"])
    return rows.select(*keep, said.alias("__said")).select(*keep, *[F.col(f"__said.{f}").alias(f) for f in fields])


def unmatched(rows: DataFrame, keep: list[str], silence: bool, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Diagnoses of references without a partner: each defined field is lost with them."""
    value = F.lit("NON_silence_captif" if silence else "NON_bruit_captif")
    return rows.select(*keep, *[F.when(F.col(f).isNotNull(), value).alias(f) for f in fields])


def defined_fields(row: Callable[[str], Column], fields: tuple[str, ...] = FIELDS) -> Column:
    """How many of the fields are defined, and one for the list of names."""
    return sum((row(f).isNotNull().cast("int") for f in fields), F.lit(1))
