"""Joins that stay even when one key holds a large share of all rows.

Keys with more than ``SLICE_ROWS`` rows are hot and cut into slices of about that many rows. The matching
rows of the other side are repeated once per slice and the join runs on (key, slice): every pair still meets
exactly once, so the list and the number of slices only spread the work and never change a result.

The list of hot keys is what is broadcast here. It is bounded by the data itself: a key on it stands for
more than ``SLICE_ROWS`` rows, so 10^12 rows have a million of them at most, some 20 MB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000
SLICE = "_slice"


def hot_keys(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """From (key, n): the hot keys with the number of slices each is cut into."""
    slices = F.ceil(F.col("n") / SLICE_ROWS).cast("int")
    return counts.where(F.col("n") > SLICE_ROWS).select(*key, slices.alias("_slices"))


def _with_slice(df: DataFrame, hot: DataFrame, key: Sequence[str], slice_of) -> DataFrame:
    extra = [c for c in hot.columns if c not in key]
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    return df.join(F.broadcast(hot), list(key), "left").withColumn(SLICE, slice_of(slices)).drop(*extra)


def _own_slice(spread: Sequence[str], slices: Column) -> Column:
    """By hash of the row, so that a task that runs again repeats it."""
    return F.pmod(F.xxhash64(*spread), slices).cast("int")


def _all_slices(slices: Column) -> Column:
    return F.sequence(F.lit(0), slices - 1)


def slice_rows(df: DataFrame, hot: DataFrame, key: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Give each row of a hot key one slice."""
    return _with_slice(df, hot, key, lambda slices: _own_slice(spread, slices))


def repeat_rows(df: DataFrame, hot: DataFrame, key: Sequence[str]) -> DataFrame:
    """Repeat each row of a hot key once per slice."""
    return _with_slice(df, hot, key, lambda slices: F.explode(_all_slices(slices)))


def grid_cells(counts: DataFrame, key: Sequence[str], left: str, right: str, cell: int) -> DataFrame:
    """From (key, left, right), the rows of both sides of a product: the keys whose product is above
    ``cell * cell``, with the number of parts each side is cut into so that no cell of the grid is."""
    parts = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / cell)).cast("int")
    large = F.col(left) * F.col(right) > cell * cell
    return counts.where(large).select(*key, parts(left).alias("_rows"), parts(right).alias("_cols"))


def on_grid(df: DataFrame, grid: DataFrame, key: Sequence[str], spread: Sequence[str], own: str | None) -> DataFrame:
    """Put rows on the grid's cells: in one row (or column, as ``own`` says) by hash and in all of the other;
    with ``own`` none in all cells."""

    def places(column: str) -> Column:
        n = F.coalesce(F.col(column), F.lit(1))
        return F.array(_own_slice(spread, n)) if own == column else _all_slices(n)

    joined = df.join(F.broadcast(grid), list(key), "left")
    placed = joined.withColumn("_row", F.explode(places("_rows"))).withColumn("_col", F.explode(places("_cols")))
    return placed.drop("_rows", "_cols")


def sliced_join(
    many: DataFrame,
    few: DataFrame,
    key: Sequence[str],
    spread: Sequence[str],
    counts: DataFrame,
    how: str = "inner",
) -> DataFrame:
    """Join a large table to one with few rows per key.

    ``counts`` is (key, n): how often a key occurs in ``many``, or in something cheaper to count that
    follows it.
    """
    key = list(key)
    hot = hot_keys(counts, key)
    left = slice_rows(many, hot, key, spread)
    return left.join(repeat_rows(few, hot, key), [*key, SLICE], how).drop(SLICE)
