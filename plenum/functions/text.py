"""Column functions over text: emptiness, classification, similarity, cleaning and paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for no value.
NULL_LIKE = ("none", "n/a", "null", "", "-")
BLANKS = " \t\n\r\v\f"


def stripped(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.trim(c, F.lit(BLANKS))


def is_empty(c: Column) -> Column:
    """Null, or a text that stands for no value."""
    return c.isNull() | F.lower(stripped(c)).isin(*NULL_LIKE)


def sanitized(c: Column, kind: str = "string") -> Column:
    """Text without outer white space; null is empty. kind: the column's type; of a boolean the text is True or False."""
    return F.coalesce(F.initcap(c.cast("string")) if kind == "boolean" else stripped(c.cast("string")), F.lit(""))


def capitalized(c: Column) -> Column:
    """First letter upper, all others lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def has_prefix(c: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.lower(c).startswith(p) for p in prefixes])


def hamming(a: Column, b: Column) -> Column:
    """Positions at which two texts of equal length agree; 0 for different lengths."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(same, F.lit(0), lambda s, x: s + x)).otherwise(0).cast("long")


def clean_lines(c: Column) -> Column:
    """Lines without outer white space and without empty ones, joined by a blank."""
    lines = F.transform(F.split(c, "\n"), lambda x: stripped(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def list_items(c: Column) -> Column:
    """The items of a comma list, trimmed, without those that stand for no value."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, ";", ","), ","), lambda x: F.trim(x)), lambda x: ~F.lower(x).isin(*NULL_LIKE))


def translated(c: Column, names: Column) -> Column:
    """A comma list with each item replaced by what a map has for it, if anything."""
    return F.array_join(F.transform(F.split(c, ","), lambda x: F.coalesce(F.try_element_at(names, F.trim(x)), F.trim(x))), ", ")


def shortened(c: Column, most: int = 3) -> Column:
    """The first items of an array, and a note of how many more there are."""
    note = F.array(F.concat(F.lit("... ("), (F.size(c) - most).cast("string"), F.lit(" more)")))
    return F.when(F.size(c) > most, F.concat(F.slice(c, 1, most), note)).otherwise(c)


def quoted_path(c: Column) -> Column:
    return F.regexp_extract(c, r"'([^']*)'", 1)


def list_index(c: Column) -> Column:
    return F.try_to_number(F.regexp_extract(c, r"\[(\d+)\]", 1), F.lit("999999999")).cast("long")
