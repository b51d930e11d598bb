"""Tolerant text parsing and display formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number_value(text: Column) -> Column:
    """Number of a text with thousands commas; anything else is 0."""
    plain = F.trim(F.replace(text.cast("string"), F.lit(","), F.lit("")))
    value = F.when(plain.rlike(PLAIN_NUMBER), plain.try_cast("double"))
    return F.coalesce(F.when(F.abs(value) < float("inf"), value), F.lit(0.0))


def duration_minutes(text: Column) -> Column:
    """Minutes of a plain number, ``H:MM:SS`` or ``M:SS``; null for anything else."""
    text = F.trim(text.cast("string"))
    clock = r"^(\d{1,3}):(\d{2})(?::(\d{2}))?$"
    part = [F.regexp_extract(text, clock, group).try_cast("double") for group in (1, 2, 3)]
    return (F.when(text.rlike(r"^\d+(?:\.\d+)?$"), text.try_cast("double"))
            .when(part[2].isNotNull(), part[0] * 60 + part[1] + part[2] / 60)
            .when(part[0].isNotNull(), part[0] + part[1] / 60))


def first_minutes(df: DataFrame, names: Sequence[str]) -> Column:
    """Minutes in the first non-blank of those of ``names`` that ``df`` has.

    A number is taken as it is, if finite; text is read as :func:`duration_minutes` does.
    """
    types, options = dict(df.dtypes), []
    for name in [name for name in names if name in types]:
        column = F.col(name)
        number = types[name].startswith(("int", "bigint", "smallint", "tinyint", "float", "double",
                                         "decimal"))
        value = (F.when(F.abs(column) < float("inf"), column.cast("double")) if number
                 else duration_minutes(column))
        filled = F.nullif(column.cast("string"), F.lit("")).isNotNull()
        options.append(F.when(filled, F.struct(value.alias("minutes"))))
    return F.coalesce(*options)["minutes"] if options else F.lit(None).cast("double")


def first_filled(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-blank text among those of ``names`` that ``df`` has; blank if none."""
    present = [name for name in names if name in df.columns]
    return F.coalesce(*[F.nullif(F.col(name).cast("string"), F.lit("")) for name in present],
                      F.lit(""))


def hms(seconds: Column) -> Column:
    """Duration as ``HH:MM:SS.ss``."""
    rest = seconds - F.floor(seconds / 60) * 60
    minutes = F.floor(seconds / 60)
    return F.format_string("%02d:%02d:%05.2f", F.floor(minutes / 60), minutes % 60,
                           rest.cast("double"))


def grouped(number: Column, decimals: int = 0) -> Column:
    """Thousands grouping for display."""
    return F.format_number(number, decimals)


def percent_text(share: Column) -> Column:
    """Percentage for display: thousands grouping, one decimal, halves up."""
    return F.concat(F.format_number(F.round(share, 1), 1), F.lit("%"))
