"""Text, JSON and XML expressions built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# runs of word characters in any script, without and with apostrophes (fixed values)
WORD = r"(?U)\w+"
WORD_OR_APOSTROPHE = r"(?U)[\w']+"


def words(line: Column, apostrophes: bool = False) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD_OR_APOSTROPHE if apostrophes else WORD), F.lit(0))


def strip_margin(text: Column) -> Column:
    """Remove the leading blanks and bar that indent continued lines."""
    return F.regexp_replace(text, r"\n[ \t]*\|", "\n")


def blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s", " ")) == ""


def word_line(word: Column, n: Column) -> Column:
    return F.format_string("%s: %d", word, n)


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def empty_list_if_null(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{kind}>"))


def rounded_int(c: Column) -> Column:
    """Number to integer with halves away from zero."""
    return F.round(c).cast("bigint")
