"""Attach one-row aggregates to rows as uncorrelated scalar subqueries (computed once; no join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def scalar(one_row: DataFrame, column: str) -> Column:
    """Value of ``column`` of a single-row frame, usable in any expression."""
    return one_row.select(column).scalar()


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` plus every column of the single-row frame ``one_row`` (Spark merges the subqueries
    of one aggregate into a single evaluation)."""
    return df.select("*", *[scalar(one_row, c).alias(c) for c in one_row.columns])


def scalar_row(*frames: DataFrame) -> DataFrame:
    """Combine single-row frames side by side into one single-row frame."""
    first, rest = frames[0], frames[1:]
    cols = [scalar(first, c).alias(c) for c in first.columns]
    for f in rest:
        cols += [scalar(f, c).alias(c) for c in f.columns]
    return first.sparkSession.range(1).select(*cols)
