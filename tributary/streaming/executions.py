"""SQL execution starts and ends as streams.

The state is bounded: a start is kept for ``bound`` after its time, and an end that comes later counts
as one without start. An end without start comes out once both watermarks have passed it; at close,
a closing row on each side pushes them past everything that is still waiting.

A record older than the newest of an earlier batch by more than ``delay`` is late, and Spark drops it: the
caller has to say how far records may be out of order. ``missing_pairs`` finds what was dropped all the same
in the stored records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.executions import pair_executions


def closing_row(spark: SparkSession, close: str, execution_id: int, app_id: object = None) -> DataFrame:
    """The record that ends a side, later than all others; its id is used by no execution. Where records
    have an ``app_id`` it needs one too: Spark filters null keys below the watermark."""
    row = spark.range(1).select(
        F.lit(execution_id).cast("bigint").alias("execution_id"), F.lit(close).cast("timestamp").alias("ts")
    )
    return row if app_id is None else row.withColumn("app_id", F.lit(app_id))


def pair_execution_streams(
    starts: DataFrame, ends: DataFrame, bound: str, close: str, delay: str
) -> DataFrame:
    app = [c for c in ("app_id",) if c in ends.columns]
    left = ends.select(*app, "execution_id", F.col("ts").alias("end_ts")).withWatermark("end_ts", delay)
    right = starts.select(
        *[F.col(c).alias("start_" + c) for c in app], F.col("execution_id").alias("start_id"), F.col("ts").alias("start_ts")
    ).withWatermark("start_ts", delay)
    in_time = (F.col("start_ts") <= F.col("end_ts")) & (
        F.col("end_ts") <= F.col("start_ts") + F.expr(f"INTERVAL {bound}")
    )
    same = F.col("execution_id") == F.col("start_id")
    for c in app:
        same = same & (F.col(c) == F.col("start_" + c))
    return (
        left.join(right, same & in_time, "left_outer")
        # By time, not by id: a filter on the id would move below the watermarks, and closing rows with it.
        .where(F.col("end_ts") < F.lit(close).cast("timestamp"))
        .select(
            *app, "execution_id", "start_ts", "end_ts", F.col("start_id").isNotNull().alias("had_start")
        )
    )


def missing_pairs(pairs: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Pairs of the ends that the stream has not brought out, from the stored records: a batch to append
    (and to count) after the stream has been closed."""
    key = [c for c in ("app_id", "execution_id") if c in ends.columns]
    return pair_executions(starts, ends.join(pairs.select(*key), key, "left_anti"))
