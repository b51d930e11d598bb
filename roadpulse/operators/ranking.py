"""Shares, numbered top lists and peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, total: Column) -> Column:
    """Share in percent, one decimal, 0 for a zero total."""
    return F.round(F.coalesce(part / F.nullif(total, F.lit(0)) * 100, F.lit(0.0)), 1)


def share_of(grouped: DataFrame, column: str, share: str = "share") -> DataFrame:
    """Each row's share of the column's total.

    The total is a scalar subquery on the same grouping; its exchange is the one
    of the grouping itself, so the facts are read once.
    """
    total = grouped.agg(F.sum(column).alias("total")).scalar()
    return grouped.withColumn(share, percent(F.col(column), total))


def numbered_top(grouped: DataFrame, order: Sequence[Column], top: int) -> DataFrame:
    """The first ``top`` rows with their rank; only those rows meet in one task."""
    kept = grouped.orderBy(*order).limit(top)
    return kept.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def peak_of(grouped: DataFrame, key: str, value: str) -> DataFrame:
    """Key of the largest value, smallest key on ties."""
    return grouped.agg(F.min_by(key, F.struct(-F.col(value), F.col(key))).alias(key),
                       F.max(value).alias(value))
