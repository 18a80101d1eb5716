"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.plans.scratch import scratch_folder

#: Word bytes end at these characters (fixed values: space and U+0009 to U+000D).
SPACE = " \t\n\x0b\x0c\r"
BUCKET_ROWS = 2000
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it: cuts lineage, and survives lost executors. ``rows``,
    where the table's number of rows or a bound is known, keeps a small one from becoming a file per shuffle partition."""
    path = scratch_folder(df.sparkSession, name) + "/table"
    if rows is not None:
        df = df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(docs: DataFrame) -> Column:
    """A row as one struct ``doc``, so that an operator's own columns never clash with the table's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def row_columns(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``doc``, some of them changed."""
    return [changed[c].alias(c) if c in changed else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]


def n_words(text: str | Column) -> Column:
    """Words of a text, none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, buckets: int) -> DataFrame:
    """Add ``name``: a gapless number from 0 within ``keys``, by hash of ``order`` and then ``order``.

    Two levels, so that no task sorts a whole group: rows are numbered inside (keys, hash bucket), and
    the buckets' counts, a table of keys x ``buckets`` rows at most, give each bucket its first number.
    Rows that agree in all of ``order`` share a bucket and get their numbers in any order.
    """
    hashed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = hashed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = hashed.withColumn("_inside", F.row_number().over(inside) - 1)
    return rows.join(first, [*keys, "_bucket"]).withColumn(
        name, (F.col("_first") + F.col("_inside")).cast("long")
    ).drop("_bucket", "_first", "_inside")


def bucket_count(rows: int, groups: int = 1) -> int:
    """Hash buckets that leave about ``BUCKET_ROWS`` rows in each when ``rows`` are in ``groups`` groups."""
    return max(1, -(-rows // (BUCKET_ROWS * groups)))
