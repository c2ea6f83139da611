"""Locale-formatted text to values, as column expressions (no Python per row).

Texts that stand for "missing" (N/A, nan, None, a dash, nothing) need no list here: they are no numbers, and
whatever is no number becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crivo.columns import to_number

# Texts that are no ticker (compared in upper case).
BLANK_TICKER = ("", "NAN", "NONE", "NULL", "<NA>")

EXPONENT = r"^[+-]?[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]+$"
ZERO_WIDTH_SPACE = "\u200b"


def _without(value: Column, *marks: str) -> Column:
    for mark in marks:
        value = F.replace(value, F.lit(mark), F.lit(""))
    return value


def _decimal_comma(value: Column) -> Column:
    return F.replace(_without(value, "."), F.lit(","), F.lit("."))


def percent(value: Column) -> Column:
    """`1.234,56%` to 12.3456."""
    return to_number(_decimal_comma(_without(value, ZERO_WIDTH_SPACE, "%"))) / F.lit(100.0)


def money(value: Column) -> Column:
    """`R$ 1.234,56` to 1234.56."""
    return to_number(_decimal_comma(_without(value, ZERO_WIDTH_SPACE, "R$")))


def plain_float(value: Column) -> Column:
    """`1,05` to 1.05. A dot stays a decimal point here."""
    return to_number(F.replace(value, F.lit(","), F.lit(".")))


def integer(value: Column) -> Column:
    """`30.949` to 30949: dots and commas only separate thousands."""
    return to_number(_without(value, ".", ",")).try_cast("bigint")


def any_number(value: Column) -> Column:
    """Number written in an unknown locale.

    Brackets make it negative. When both marks occur the later one is the decimal mark; a lone comma is
    decimal; of several dots only the last is decimal. Every step is a rewrite of the text before it, so
    the expression stays small; texts without digits end as null. A number with an exponent, as doubles and JSON
    numbers write themselves, is that number.
    """
    written = F.trim(value.cast("string"))
    exact = F.regexp_extract(written, EXPONENT, 0).try_cast("double")
    text = written
    text = F.regexp_replace(text, r"^\(([^0-9-]*)-(.*)\)$", "$1$2")
    text = F.regexp_replace(text, r"^\([^0-9+.,]*\+?(.*)\)$", "-$1")
    text = F.regexp_replace(text, r"[^0-9,.+\-]", "")
    marks = F.regexp_replace(text, r"\.(?=.*,[^.]*$)", "")
    marks = F.regexp_replace(marks, r",(?=.*\.[^,]*$)", "")
    marks = F.replace(marks, F.lit(","), F.lit("."))
    dots_only = F.regexp_replace(text, r"\.(?=.*\.)", "")
    return F.coalesce(exact, to_number(F.when(F.contains(text, F.lit(",")), marks).otherwise(dots_only)))


def ticker(value: Column) -> Column:
    """Upper-case ticker, or null where the text only says that there is none."""
    text = F.upper(F.trim(value.cast("string")))
    return F.when(~text.isin(*BLANK_TICKER), text)


def iso_date(value: Column) -> Column:
    """Date from a date, a timestamp or ISO text; null when it is none of these."""
    return F.substring(value.cast("string"), 1, 10).try_cast("date")


def br_date(value: Column) -> Column:
    """Date written `dd/MM/yyyy`; null otherwise."""
    return F.try_to_timestamp(value, F.lit("dd/MM/yyyy")).cast("date")
