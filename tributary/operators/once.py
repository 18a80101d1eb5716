"""Expressions that are worked out once per row.

Catalyst pulls the expressions of a projection into whatever reads its columns: a parse, or an array built by
higher-order functions, is then repeated for every filter, every field and, inside lambdas, every element. A
generator is a barrier to that. Its output are columns like any other, its own input is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def built_once(df: DataFrame, *columns: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns, each worked out once, after those of ``df`` named in ``keep``."""
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def let(value: Column, body) -> Column:
    """``body`` of a value that it uses several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
