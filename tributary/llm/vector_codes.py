"""Vectors compressed to one code per part, with per-dimension value dictionaries.

Components become whole numbers, and rows are packed into blocks that keep, for every dimension, the sorted
distinct numbers of the block and each row's place among them. Codebooks are fitted by Lloyd rounds in
whole numbers. To assign a block, the squared difference of every distinct number to all entries is tabulated
once per dimension; a part's distances are then gathers from these tables by the rows' places, added up over
the part's dimensions. A round sends back sums and counts per entry, which Spark adds up: what reaches the
driver is the codebooks, ``ENTRIES`` vectors, whatever the number of rows.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped; null ids come
last among the first vectors, rows of one id by their vectors; a vector shorter than the longest counts as
zero beyond its end, as does what is missing to a multiple of the parts; ties go to the lower index; entries
without parts stay; fewer rows than entries give smaller codebooks; an empty table gives no rows. Repeated
rows are rows of their own. Other columns are not read. Components so large that a distance might leave
64 bits are refused with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored
from tributary.operators.skew import sliced_join

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK = 4096  # rows; places fit 16 bits
LONGEST = 2**63 - 1


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, x) of the rows that take part, components times ``scale`` and not yet cut to whole numbers:
    a double holds the product exactly."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & good).select("vec_id", "label", x.alias("x")).withColumn(
        "x", F.transform("x", lambda c: c * float(scale)))


def _checked(rows: DataFrame) -> tuple[int, int]:
    """Rows, and dimensions; refuses components whose distances might not fit."""
    largest = F.max(F.array_max(F.transform("x", lambda c: F.abs(c))))
    n, dims, top = rows.agg(F.count("*"), F.max(F.size("x")), largest).first()
    dims = dims or 0
    if top and dims * (2 * (int(top) + 1)) ** 2 > LONGEST:
        raise ValueError(f"components up to {top:.3g} in {dims} dimensions: distances do not fit 64 bits")
    return n, dims


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of floor(x), zero beyond a vector's end."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
    if (lengths == dims).all():
        return values.reshape(-1, dims)
    matrix = np.zeros((len(lists), dims), dtype=np.int64)
    matrix[np.arange(dims) < lengths[:, None]] = values
    return matrix


def dictionary_blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(vec_ids, labels, sizes, values, places): blocks of rows by dictionary, dimension by dimension."""
    ids, labels = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                matrix = _matrix(part.column("x"), dims)
                found = [np.unique(column, return_inverse=True) for column in matrix.T]
                sizes = np.array([len(v) for v, _ in found], dtype=np.int64)
                values = np.concatenate([v for v, _ in found]) if dims else np.zeros(0, dtype=np.int64)
                places = np.array([p for _, p in found], dtype=np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("vec_id").to_pylist()], pa.list_(part.column("vec_id").type)),
                     pa.array([part.column("label").to_pylist()], pa.list_(part.column("label").type)),
                     *[pa.array([a.tobytes()], pa.binary()) for a in (sizes, values, places)]],
                    names=["vec_ids", "labels", "sizes", "values", "places"])

    schema = f"vec_ids array<{ids}>, labels array<{labels}>, sizes binary, values binary, places binary"
    return stored(rows.select("vec_id", "label", "x").mapInArrow(pack, schema), "dictionary-blocks")


def _assign(batch: pa.RecordBatch, i: int, books: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, list]:
    """(rows, codes, distances, dictionaries) of one block; ``books`` is (parts, entries, width)."""
    parts, entries, width = books.shape
    sizes, values = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.int64) for c in ("sizes", "values"))
    n = len(batch.column("vec_ids")[i])
    places = np.frombuffer(batch.column("places")[i].as_buffer(), dtype=np.uint16).reshape(len(sizes), n)
    ends = np.cumsum(sizes)
    dictionaries = [(values[e - s:e], places[d]) for d, (s, e) in enumerate(zip(sizes, ends, strict=True))]
    codes = np.empty((parts, n), dtype=np.int64)
    distances = np.zeros((parts, n), dtype=np.int64)
    for part in range(parts):
        total = np.zeros((n, entries), dtype=np.int64)
        for j in range(width):
            d = part * width + j
            known, place = dictionaries[d] if d < len(dictionaries) else (np.zeros(1, dtype=np.int64), np.zeros(n, dtype=np.uint16))
            table = (known[:, None] - books[part, :, j][None, :]) ** 2
            total += table[place]
        codes[part] = total.argmin(axis=1)  # the first of equal ones
        distances[part] = total[np.arange(n), codes[part]]
    return n, codes, distances, dictionaries


def _sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, sums) of every entry that has parts."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=object)  # whole numbers of any size
        for batch in batches:
            for i in range(batch.num_rows):
                _, codes, _, dictionaries = _assign(batch, i, books)
                for part in range(parts):
                    count[part] += np.bincount(codes[part], minlength=entries)
                    for j in range(width):
                        d = part * width + j
                        if d < len(dictionaries):
                            known, place = dictionaries[d]
                            # rows by (entry, place in the dictionary), weighed by the dictionary's numbers
                            met = np.bincount(codes[part] * len(known) + place, minlength=entries * len(known))
                            total[part, :, j] += (met.reshape(entries, -1) * known).sum(axis=1)
        used = np.argwhere(count > 0)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(count[tuple(used.T)], pa.int64()),
                 pa.array([[str(x) for x in total[p, e]] for p, e in used], pa.list_(pa.string()))],
                names=["part", "entry", "n", "sums"])

    return blocks.mapInArrow(run, "part int, entry int, n long, sums array<string>")


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; ``parts`` x ``entries`` rows reach the driver."""
    width = books.shape[2]
    sums = [F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
    moved = books.copy()
    for row in _sums(blocks, books).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        moved[row.part, row.entry] = [int(row[f"s{j}"]) // row.n for j in range(width)]
    return moved


def fit(rows: DataFrame, blocks: DataFrame, n: int, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width): the first vectors' parts, moved by Lloyd rounds."""
    width = max(1, -(-dims // parts))
    whole = F.transform("x", lambda c: F.floor(c))
    first = rows.select("vec_id", whole.alias("v")).orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    books = np.zeros((len(first), parts * width), dtype=np.int64)
    for i, row in enumerate(first):
        books[i, :len(row.v)] = row.v
    books = np.ascontiguousarray(books.reshape(len(first), parts, width).transpose(1, 0, 2))
    for _ in range(rounds if n else 0):
        books = _round(blocks, books)
    return books


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits a part, and the squared distances added up."""
    kinds = [blocks.schema[c].dataType.elementType for c in ("vec_ids", "labels")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, codes, distances, _ = _assign(batch, i, books)
                text = np.ascontiguousarray(codes.T.astype(np.uint8)).tobytes().hex()
                size = 2 * len(codes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids").slice(i, 1).flatten(), batch.column("labels").slice(i, 1).flatten(),
                     pa.array([text[k:k + size] for k in range(0, n * size, size)], pa.string()), pa.array(distances.sum(axis=0), pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id {kinds[0].simpleString()}, label {kinds[1].simpleString()}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with the whole numbers that its ``code`` stands for, as ``approximate``."""
    flat = F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for part in books for entry in part])
    parts, entries, _ = books.shape
    digit = lambda p: F.conv(F.substr("code", p * 2 + 1, F.lit(2)), 16, 10).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.get(flat, p * entries + digit(p)))
    return codes.withColumn("approximate", F.flatten(places))


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """The table (vec_id, label, code, error) of ``vectors``, and its codebooks."""
    rows = integers(vectors, scale)
    n, dims = _checked(rows)
    blocks = dictionary_blocks(rows, dims)
    books = fit(rows, blocks, n, dims, parts, entries, rounds)
    return stored(encode(blocks, books), "vector-codes"), books


def report(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part."""
    codes, books = compress(vectors)
    key = ["none", "kind"]  # nulls are one label
    zero = F.lit(0).cast(codes.schema["label"].dataType)
    keyed = codes.select("vec_id", "code", "error", F.col("label").isNull().alias("none"), F.coalesce("label", zero).alias("kind"))
    totals = keyed.groupBy(*key).agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    joined = sliced_join(keyed, totals.drop("n"), key, ["vec_id", "code"], totals.drop("label_error"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
