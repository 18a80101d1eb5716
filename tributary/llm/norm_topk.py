"""Exact top-k by inner product, pruned by lengths.

Vectors are turned into whole numbers, sorted by descending length and packed into blocks; queries are packed
likewise. Each query block meets the blocks of vectors in an equi-join on block numbers, in two waves: the
longest vectors first, which give every query a k-th best score to beat, then only those blocks whose longest
vector can still reach it (Cauchy-Schwarz). Inside a pair of blocks the vectors are rotated by the singular
vectors of a bounded sample, so that a few leading coordinates hold most of the product; a candidate whose
partial sum plus the product of the residual lengths stays below the score to beat is never multiplied out.
What remains is scored exactly in integers, and the k best of each pair of blocks meet in a ranking that
keeps k per query in the map tasks already.

Defined results: rows with a null id, or a vector that is null or holds a null or non-finite component, take
no part; rows that repeat an id take part each, as queries too, but are no candidates of that id; vectors of
different lengths are compared over the coordinates both have; ties go to the smaller id; fewer candidates give
fewer rows; other columns are not read. Scores are 64-bit integers: a table whose longest vector has a square of
2^63 or more, so that a score might not fit, is refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import stored

K = 5
SCALE = 256
QUERY_STEP = 50
BLOCK, QUERY_BLOCK = 2048, 512
LEADING = 16
SAMPLE = 10_000
SLACK = 1e-6  # relative error left to the bounds, which are floats


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v array<long>, norm) of the rows that take part, numbered by ``row``."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    valid = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    square = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.pow(c * scale, F.lit(2.0)))
    return valid.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), F.sqrt(square).alias("norm"))


def _packed(rows: DataFrame, size: int, dims: int, partitions: int, kind: type) -> DataFrame:
    """(block, top, rows, ids, matrix): ``size`` rows each at most, longest first, blocks numbered from 0."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column("v")
                matrix = np.zeros((len(lists), dims), dtype=np.int64)
                for i, v in enumerate(lists):
                    values = v.values.to_numpy(zero_copy_only=False)
                    matrix[i, :len(values)] = values
                yield pa.RecordBatch.from_arrays(
                    [part.column("part").slice(0, 1), pa.array([seq], pa.int32()), part.column("norm").slice(0, 1),
                     *[pa.array([part.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in ("row", "vec_id")],
                     pa.array([matrix.astype(kind).tobytes()], pa.binary())],
                    names=["part", "seq", "top", "rows", "ids", "matrix"],
                )
                seq += 1

    ordered = rows.repartitionByRange(partitions, F.desc("norm"), F.asc("vec_id")).sortWithinPartitions(F.desc("norm"), F.asc("vec_id"))
    blocks = stored(
        ordered.withColumn("part", F.spark_partition_id()).mapInArrow(
            pack, "part int, seq int, top double, rows binary, ids binary, matrix binary"),
        "vector-blocks",
    )
    # numbers for the blocks: one row per block, without the vectors
    number = F.row_number().over(Window.orderBy("part", "seq")) - 1
    numbers = blocks.select("part", "seq").withColumn("block", number)
    return stored(blocks.join(numbers, ["part", "seq"]).drop("part", "seq"), "numbered-blocks")


def rotation(rows: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, the strongest first."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    matrix = np.zeros((len(sample), dims))
    for i, v in enumerate(sample):
        matrix[i, :len(v)] = v
    _, right = np.linalg.eigh(matrix.T @ matrix)  # a matrix of dims x dims, whatever the sample
    return right[:, ::-1]


def block_best(q_ids, q, v_ids, v, beat, turn, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, vector ids, scores): each query's k best of a block that reach what it has to beat."""
    lead = min(LEADING, turn.shape[1])
    qr, vr = q @ turn, v @ turn
    q_rest = np.sqrt((qr[:, lead:] ** 2).sum(axis=1))
    v_rest = np.sqrt((vr[:, lead:] ** 2).sum(axis=1))
    bound = qr[:, :lead] @ vr[:, :lead].T + np.outer(q_rest, v_rest)
    slack = SLACK * (1 + np.outer(np.sqrt((qr**2).sum(axis=1)), np.sqrt((vr**2).sum(axis=1))))
    alive = (bound + slack >= beat[:, None]) & (q_ids[:, None] != v_ids[None, :])
    for i in range(len(q)):
        at = np.flatnonzero(alive[i])
        if not len(at):
            continue
        scores = v[at] @ q[i]
        if len(at) > k:
            low = np.partition(scores, len(at) - k)[len(at) - k]
            keep = scores >= low
            at, scores = at[keep], scores[keep]
        order = np.lexsort((v_ids[at], -scores))[:k]
        yield i, v_ids[at][order], scores[order]


def _score(pairs: DataFrame, turn: np.ndarray, dims: int, k: int, kind: type) -> DataFrame:
    """(query_row, query_id, vec_id, score) from rows (q_rows, q_ids, q_matrix, beat, ids, matrix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {n: batch.column(n)[i].as_buffer() for n in ("q_rows", "q_ids", "q_matrix", "ids", "matrix")}
                q_rows, q_ids, v_ids = (np.frombuffer(raw[n], dtype=np.int64) for n in ("q_rows", "q_ids", "ids"))
                q, v = (np.frombuffer(raw[n], dtype=kind).reshape(-1, dims).astype(np.int64) for n in ("q_matrix", "matrix"))
                beat = np.array([float("-inf") if b is None else b for b in batch.column("beat")[i].as_py()], dtype=float)
                found = list(block_best(q_ids, q, v_ids, v, beat, turn, k))
                if found:
                    at = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_rows[at], pa.int64()), pa.array(q_ids[at], pa.int64()),
                         pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                         pa.array(np.concatenate([f[2] for f in found]), pa.int64())],
                        names=["query_row", "query_id", "vec_id", "score"],
                    )

    return pairs.select("q_rows", "q_ids", "q_matrix", "beat", "ids", "matrix").mapInArrow(
        run, "query_row long, query_id long, vec_id long, score long")


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, query_step: int = QUERY_STEP, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors of every query, a row whose id ``query_step`` divides.
    Components beyond 32 bits make the blocks twice as wide."""
    spark = vectors.sparkSession
    rows = stored(integers(vectors, scale), "integers")
    isq = F.col("vec_id") % query_step == 0
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.count_if(isq).alias("queries"), F.max("norm").alias("top")).first()
    if not shape.queries or not shape.dims:
        none = "query_id long, rank int, vec_id long, score long"
        return spark.createDataFrame([], none)
    if shape.top**2 * (1 + SLACK) >= 2**63:
        raise ValueError(f"a vector of length {shape.top:.3g}: its inner products may not fit 64 bits")
    kind = np.int32 if shape.top < 2**31 - 1 else np.int64
    turn = rotation(rows, shape.dims)
    spread = spark.sparkContext.defaultParallelism
    blocks = _packed(rows, BLOCK, shape.dims, max(spread, -(-shape.n // (16 * BLOCK))), kind)
    queries = _packed(rows.where(isq), QUERY_BLOCK, shape.dims, -(-shape.queries // QUERY_BLOCK), kind).select(
        F.col("block").alias("q_block"), F.col("top").alias("q_top"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"),
        F.col("matrix").alias("q_matrix"),
    )
    n_queries = queries.count()
    # every vector block is named once per query block and meets it by an equi-join
    named = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q_block"))

    nothing = F.array_repeat(F.lit(None).cast("double"), (F.octet_length("q_ids") / 8).cast("int"))
    start = queries.withColumn("beat", nothing)
    seeds = stored(_ranked(_score(named.where("block = 0").join(start, "q_block"), turn, shape.dims, k, kind), k), "first-wave")
    beaten = seeds.where(F.col("rank") == k).select("query_row", "score")

    places = _query_places(queries, kind)
    per_block = places.join(beaten, "query_row", "left").groupBy("q_block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "score", "norm"))), lambda x: x["score"].cast("double")).alias("beat"),
        # the shortest vector that can reach some query of the block; one without a score above 0 meets all
        F.min(F.when(F.col("score") > 0, F.col("score") / F.col("norm")).otherwise(F.lit(0.0))).alias("reach"),
    )
    armed = queries.join(per_block.withColumn("reach", F.col("reach") * (1 - SLACK)), "q_block")
    rest = named.where("block > 0").join(armed.select("q_block", "reach"), "q_block").where(F.col("top") >= F.col("reach"))
    second = _score(rest.drop("reach").join(armed, "q_block"), turn, shape.dims, k, kind)
    found = _ranked(seeds.select("query_row", "query_id", "vec_id", "score").unionAll(second), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _query_places(queries: DataFrame, kind: type) -> DataFrame:
    """(q_block, place, query_row, norm) of every packed query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("q_rows")[i].as_buffer(), dtype=np.int64)
                matrix = np.frombuffer(batch.column("q_matrix")[i].as_buffer(), dtype=kind).reshape(len(ids), -1)
                norms = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
                block = batch.column("q_block")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(ids), pa.int32()), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids, pa.int64()), pa.array(norms, pa.float64())],
                    names=["q_block", "place", "query_row", "norm"],
                )

    return queries.select("q_block", "q_rows", "q_matrix").mapInArrow(run, "q_block int, place int, query_row long, norm double")
