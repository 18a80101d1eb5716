"""Mixing sources to target weights by entropy balancing.

Sources, in code point order with null last, have the weights 5, 2, 1, repeating, and share 1.5 times all
words; a target stops at twice its source's words and the excess is shared anew by weight.

A document of z mean sizes gets the rate exp(lambda z), cut at 2: the solution of the entropy-balancing
problem with one token constraint per source. The convex dual is one number per source, found for all
sources at once by Newton steps that stay inside a bracket; each step is an aggregation of a histogram of
(source, size), which is exact because a rate depends on the size only. Rates become copies by error
diffusion inside hash buckets of a source, large documents first: each document takes the copies, at most one
beyond those next to its rate, that keep the bucket's running total nearest, so a bucket ends within about its
smallest documents.

DataFrame functions only. No window or list holds a whole source: lists have one bucket of about
``BUCKET_ROWS`` documents.

Defined results: a null text has size 0; empty documents have one copy and take no words; a source without
words has target 0; an empty table gives no rows; repeated rows (one doc_id many times) are documents of
their own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import n_words, row_columns, stored, whole_row

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 500
STEPS = 60
NEAR = 1e-7


def ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number rows from 0 in the order of ``column``, null last: range partitions first, then inside each."""
    parts = stored(
        df.repartitionByRange(F.asc_nulls_last(column)).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")  # a row per partition
    )
    inside = Window.partitionBy("_part").orderBy(F.asc_nulls_last(column))
    return parts.withColumn("_inside", F.row_number().over(inside) - 1).join(first, "_part").withColumn(
        name, F.col("_first") + F.col("_inside")
    ).drop("_part", "_first", "_inside")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, n_docs, source_size, weight, target) from (source, size)."""
    per_source = sizes.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("size").alias("source_size")
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(ranked(per_source, "source", "rank").withColumn("weight", weight), "sources")
    cap = most * F.col("source_size")
    total = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total[0] or 0)
    level = wanted / total[1] if total[1] else 0.0  # words for each unit of weight
    while True:  # the level only rises, and each turn caps a source more
        over = F.col("weight") * level > cap
        capped, left = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        risen = (wanted - capped) / left if left else level
        if risen <= level * (1 + 1e-15):
            break
        level = risen
    return sources.withColumn("target", F.least(cap, F.col("weight") * level)).drop("rank")


def tilts(sizes: DataFrame, sources: DataFrame, most: float = MOST) -> DataFrame:
    """Add ``tilt`` (lambda) to ``sources``: the words at rate min(most, exp(tilt * size / mean)) meet the target."""
    histogram = stored(
        sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "histogram"
    )
    mean = F.when(F.col("source_size") > 0, F.col("source_size") / F.col("n_docs")).otherwise(F.lit(1.0))
    full = mean * math.log(most)  # here even a document of one word has the full rate
    more = F.col("target") > F.col("source_size")
    whole = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = sources.withColumn("mean", mean).withColumn(
        "low", F.when(more, F.lit(0.0)).otherwise(F.lit(float("-inf")))
    ).withColumn("high", F.when(more, full).otherwise(F.lit(0.0))).withColumn(
        "tilt", F.when(whole, full).otherwise(F.lit(0.0))
    ).withColumn("met", whole | (F.col("target") == F.col("source_size")))
    state = stored(state, "tilts")
    for _ in range(STEPS):
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(most), F.exp(F.col("tilt") * z))
        sums = histogram.join(state.where("NOT met").select(F.col("source").alias("_source"), "mean", "tilt"),
                              F.col("source").eqNullSafe(F.col("_source"))).groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("words"),
            F.sum(F.when(rate < most, F.col("n") * F.col("size") * z * rate).otherwise(F.lit(0.0))).alias("slope"),
        ).select(F.col("source").alias("_source"), "words", "slope")
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        gap = F.col("target") - F.col("words")
        met = F.col("met") | F.coalesce(F.abs(gap) <= NEAR * F.col("target"), F.lit(False))
        low = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") + gap / F.col("slope"))
        half = F.when(F.col("low") > float("-inf"), (F.col("low") + F.col("high")) / 2).otherwise(
            2 * F.col("tilt") - 1
        )
        stepped = joined.withColumn("met", met).withColumn("low", low).withColumn("high", high).withColumn(
            "tilt",
            F.when(F.col("met") | F.col("words").isNull(), F.col("tilt"))
            .when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(half),
        ).drop("words", "slope")
        state = stored(stepped, "tilts")
        if state.where("NOT met AND source_size > 0").isEmpty():
            break
    return state.select("source", "n_docs", "source_size", "target", "mean", "tilt")


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) for every document."""
    sizes = stored(docs.select("doc_id", "source", n_words("text").alias("size")), "sizes")
    sources = tilts(sizes, targets(sizes, weights, share, most), most).select(
        F.col("source").alias("_source"), "n_docs", "source_size", "target", "mean", "tilt"
    )
    rate = F.when(F.col("size") > 0, F.least(F.lit(most), F.exp(F.col("tilt") * F.col("size") / F.col("mean"))))
    rated = sizes.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "source_size", "target", "size", "doc_id", F.coalesce(rate, F.lit(1.0)).alias("rate"),
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n_docs") / BUCKET_ROWS)).alias("bucket"),
    )
    listed = rated.groupBy("source", "source_size", "target", "bucket").agg(
        F.sort_array(
            F.collect_list(F.struct((-F.col("size")).alias("order"), "doc_id", "size", "rate"))
        ).alias("docs")
    )

    def take(acc, doc):
        wanted = acc["debt"] + doc["rate"] * doc["size"]
        nearest = F.when(doc["size"] > 0, F.round(wanted / doc["size"])).otherwise(F.lit(1.0))
        low = F.greatest(F.lit(0), F.floor(doc["rate"]) - 1)
        high = F.least(F.lit(math.floor(most)), F.ceil(doc["rate"]) + 1)
        taken = F.greatest(low, F.least(high, nearest.cast("long"))).cast("int")
        return F.struct(
            (wanted - taken * doc["size"]).alias("debt"), F.concat(acc["copies"], F.array(taken)).alias("copies")
        )

    start = F.struct(F.lit(0.0).alias("debt"), F.array().cast("array<int>").alias("copies"))
    taken = listed.withColumn("copies", F.aggregate("docs", start, take, lambda acc: acc["copies"]))
    return taken.select(
        "source", "source_size", "target", F.explode(F.arrays_zip("docs", "copies")).alias("x")
    ).select(
        "x.docs.doc_id", "source", "x.docs.size", "source_size", "target", "x.docs.rate", "x.copies",
        (F.col("x.copies") * F.col("x.docs.size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The documents themselves, each row as many times as it has copies, with the input's columns."""
    taken = copies(docs, **parameters).groupBy("doc_id", "source", "size").agg(
        F.sum("copies").alias("sum"), F.count("*").alias("rows")
    )
    keyed = docs.select(whole_row(docs), n_words("text").alias("words"))
    joined = keyed.join(
        taken,
        F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & F.col("doc.source").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size")),
    )
    # rows that repeat one doc_id share its copies evenly, rounded up: a single row gets its own
    each = F.ceil(F.col("sum") / F.col("rows")).cast("int")
    return joined.select("doc", F.explode(F.array_repeat(F.lit(0), each)).alias("copy")).select(row_columns(docs))
