"""Dates, languages, organisations, names and identifiers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")

# The periods, and the labels for years outside of them, as they are written in results.
PERIODS = (("*", 1979), (1980, 1999), (2000, "*"))
NO_PERIOD, OUT_OF_RANGE = "UNKOWN_PERIOD", "YEAR_OUT_OF_RANGE"

LEAST_YEAR, MOST_YEAR = 0, 2100

# What tells the level of an organisation anywhere in its name, and at its start.
ORG_LEVELS = {"institution": ("Universi", "Academy", "Pasteur"), "department": ("Depart", "Dept", "Dipart", "Départ", "School", "Facul"), "laboratory": ("Unit", "Labo", "Servic")}
ORG_STARTS = {"institution": ("Inserm",), "department": ("Insti",), "laboratory": ()}

# Language codes that are rewritten; all others stay.
LANGUAGES = {"EN": "en", "En": "en", "--": "en", "DE": "de", "De": "de", "FR": "fr", "Fr": "fr"}


def month_number(value: Column) -> Column:
    """Two digits for a number or a text that holds an English month name; '' for another long text."""
    out = F.when(F.length(value) > 2, F.lit("")).otherwise(F.lpad(value, 2, "0"))
    for k, name in enumerate(MONTHS, 1):
        out = F.when(F.lower(value).contains(name[:3].lower()), F.lit(f"{k:02d}")).otherwise(out)
    return out


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """year[-month[-day]]; what is missing ends the date, and no year gives null."""
    m, d = F.nullif(month_number(month), F.lit("")), F.when(day != "", F.lpad(day, 2, "0"))
    return F.when(year != "", F.concat_ws("-", year, m, F.when(m.isNotNull(), d)))


def year_prefix(date: Column) -> Column:
    """The first four characters; '' and '0' count as missing."""
    y = F.substring(date, 1, 4)
    return F.when(~y.isin("", "0"), y)


def period(date: Column, parity: bool = False) -> Column:
    """The label of the period of a date, by its first four characters; years before LEAST_YEAR and after MOST_YEAR are out of range.

    With parity a period's last year falls into the next one.
    """
    year = F.expr("null").cast("int") if date is None else F.substring(date, 1, 4).try_cast("int")
    out = F.lit(OUT_OF_RANGE)
    for a, b in reversed(PERIODS):
        low = F.lit(True) if a == "*" else year >= (a - 1 if parity else a)
        high = F.lit(True) if b == "*" else (year < b if parity else year <= b)
        out = F.when(low & high, F.lit(f"[{a} TO {b}]")).otherwise(out)
    return F.when(year.isNull(), F.lit(NO_PERIOD)).when((year < LEAST_YEAR) | (year > MOST_YEAR), F.lit(OUT_OF_RANGE)).otherwise(out)


def language_code(value: Column) -> Column:
    """The ISO 639 code of a publisher's code by LANGUAGES; others stay as they are."""
    table = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(table[value], value)


def org_level(value: Column) -> Column:
    """institution, department or laboratory by what the name has or starts with, in that order; else null."""
    out = F.lit(None).cast("string")
    for level, keys in reversed(ORG_LEVELS.items()):
        hit = F.lit(False)
        for k in keys:
            hit = hit | value.contains(k)
        for k in ORG_STARTS[level]:
            hit = hit | value.startswith(k)
        out = F.when(hit, F.lit(level)).otherwise(out)
    return out


def affiliation_parts(value: Column) -> Column:
    """Struct of org, address and country: comma parts up to the first of no known level, those after, and the last."""
    parts = F.transform(F.split(value, ","), lambda x: F.trim(x))
    level = F.transform(parts, lambda x: org_level(x))
    stop = F.coalesce(F.array_position(F.transform(level, lambda x: x.isNull()), True), F.lit(0))
    cut = F.when(stop == 0, F.size(parts)).otherwise(stop - 1).cast("int")
    many = F.size(parts) > 1
    return F.struct(
        F.array_join(F.slice(parts, F.lit(1), cut), ", ").alias("org"),
        F.array_join(F.slice(parts, cut + 1, F.greatest(F.size(parts) - cut - F.when(many, 1).otherwise(0), F.lit(0)).cast("int")), ", ").alias("address"),
        F.when(many & (cut < F.size(parts)), F.element_at(parts, -1)).alias("country"),
    )


def split_name(value: Column) -> Column:
    """Struct of forename (all words but the last) and surname."""
    parts = F.split(F.trim(value), " ")
    return F.struct(F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), " ").alias("forename"), F.element_at(parts, -1).alias("surname"))


def bare_doi(value: Column) -> Column:
    """A DOI without its URL or doi: prefix."""
    return F.regexp_replace(F.trim(value), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")


def is_isbn(value: Column) -> Column:
    return F.regexp_replace(value, "[- ]", "").rlike("^(?:97[89])?[0-9]{9}[0-9Xx]$")


def page_suffixes(last: Column, first: Column) -> Column:
    """Ways to write a last page: whole, and shortened by as many characters as it has in common, place by place, with a first page of its length; else all its endings."""
    n = F.length(last)
    places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    common = F.size(F.filter(places, lambda k: F.substring(last, k, F.lit(1)) == F.substring(first, k, F.lit(1))))
    endings = F.filter(F.transform(places, lambda k: F.when(k < n, F.substring(last, n - k + 1, k))), lambda x: x.isNotNull())
    same_length = F.coalesce(F.length(first) == n, F.lit(False)) & (n > 0)
    return F.when(last == first, F.array(last, last)).when(same_length & (common > 0), F.array(last, F.substring(last, common + 1, n))).when(same_length, F.array(last)).otherwise(F.concat(F.array(last), endings))


def duration(seconds: Column) -> Column:
    """A rounded duration for people."""
    return F.when(seconds < 60, F.concat(F.bround(seconds).cast("int"), F.lit(" s"))).when(seconds < 3600, F.concat(F.bround(seconds / 60).cast("int"), F.lit(" min"))).otherwise(F.concat(F.bround(seconds / 3600, 1), F.lit(" h")))


def id_parts(value: Column) -> Column:
    """The ids of a list written with spaces."""
    return F.filter(F.split(F.trim(value), " +"), lambda x: x != "")


def cover_date(value: Column) -> Column:
    """Struct of year, month and day of a cover date of digits (YYYYMMDD, YYYYMM, YYYY) or of parts between spaces, dashes or slashes; null where they are missing."""
    parts = F.split(F.trim(value), "[ /-]+")
    digits = F.trim(value).rlike("^[0-9]{6}([0-9]{2})?$")
    part = lambda a, n, k: F.nullif(F.when(digits, F.substring(F.trim(value), a, n)).otherwise(F.try_element_at(parts, F.lit(k))), F.lit(""))
    return F.struct(part(1, 4, 1).alias("year"), part(5, 2, 2).alias("month"), part(7, 2, 3).alias("day"))


def id_kind(value: Column) -> Column:
    """doi, isbn, patent or other, by the form of an identifier."""
    return F.when(bare_doi(value).rlike(r"^10\.[0-9]{4,}/"), "doi").when(is_isbn(value), "isbn").when(F.trim(value).startswith("PAT"), "patent").otherwise("other")


def seconds_needed(n: Column, cpus: Column, rate: float = 1.025) -> Column:
    """Seconds that n documents take on so many CPUs at a rate a CPU and second."""
    return F.try_divide(n.cast("double"), cpus * F.lit(rate))
