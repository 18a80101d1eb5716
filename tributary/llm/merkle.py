"""A Merkle manifest of a table by time-forward processing: digests travel up the trees, proofs travel down.

Every row is a leaf. The leaves of a source, by doc_id, form a tree of runs of ``FAN`` nodes; the roots of
the sources' trees form one more tree. A node's label is (tree, level, place). Forward sweep: in each task a
priority queue ordered by label holds digests for nodes that are still to come; a node's children leave the
queue together, and its own digest goes in for its parent. A task has blocks of ``FAN ** LEVELS`` neighbouring nodes,
whose parents up to ``LEVELS`` above are all its own; what a block ends in is written to the shared folder by
label, the queue's external part, and the next sweep reads it from there. So a sweep is one shuffle, the trees
of 10^12 leaves take three, and no task holds more than a block. Reversed sweep: every node hands its
children the suffix of their proofs, the siblings from its own level up to the root. It crosses blocks as one
message per block, sorted before the block's nodes, so that long proofs are never shuffled per leaf.

Defined results: a null in any column is a leaf's ``-``; null sources and null doc_ids come first; rows of equal
source and doc_id are leaves of their own, by digest; a lone leaf is its tree's root, and one source's root is
the table's; an empty table gives no rows. Very long texts are hashed in the row they stand in. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tributary.llm.common import stored
from tributary.operators.skew import sliced_join

FAN = 3
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields, each with its length, some of them changed."""
    texts = [(changed.get(f, F.col(f))).cast("string") for f in FIELDS]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def placed(rows: DataFrame, tree: list[str], order: list[Column], extra: list[str]) -> DataFrame:
    """Rows (tree, extra) with ``idx``, their place from 0 in their tree, and ``n``, the tree's rows. Sorted by
    range partitions; a place is the row's number in its partition and what earlier partitions hold."""
    ranged = rows.repartitionByRange(*[F.col(t).asc_nulls_first() for t in tree], *order)
    by = [F.col(t).asc_nulls_first() for t in tree] + order
    numbered = stored(
        ranged.sortWithinPartitions(*by).select(*tree, *extra, F.monotonically_increasing_id().alias("_id")), "placed")
    part = F.shiftright("_id", 33).alias("_part")
    counts = numbered.groupBy(*tree, part).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    in_tree = Window.partitionBy(*tree)  # a row per partition at most
    earlier = in_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(t).alias("_" + t) for t in tree], F.col("_part").alias("_of"), "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(in_tree).alias("n"))
    same = F.shiftright(numbered["_id"], 33) == F.col("_of")
    for t in tree:
        same = same & numbered[t].eqNullSafe(F.col("_" + t))
    return numbered.join(offsets, same).select(
        *tree, *extra, (F.col("_id") - F.col("_first") + F.col("_before")).alias("idx"), "n")


def heights(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``: how often a third, rounded up, is taken until one is left."""
    powers = F.array(*[F.lit(FAN**k) for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(first: int, digests: list[str], levels: int) -> list[list[str]]:
    """Digests of a block's nodes level by level, the given ones included. ``first`` is the place of the first;
    a queue ordered by (level, place) brings children to their parent."""
    rows = [digests]
    queue = [(1, (first + i) // FAN, i, d) for i, d in enumerate(digests)] if levels else []  # in order: a heap
    while queue:
        level, node = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, node):
            children.append(heapq.heappop(queue)[3])
        if len(rows) == level:
            rows.append([])
        digest = _digest(children)
        rows[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, node // FAN, node, digest))
    return rows


def descend(rows: list[list[str]], suffix: list[dict]) -> list[list[dict]]:
    """The proofs of a block's lowest nodes, given that of its highest: per level the siblings to the left and
    to the right as one text each."""
    proofs = [suffix]
    for level in reversed(rows[:-1]):
        below = []
        for i, _ in enumerate(level):
            run = i - i % FAN
            siblings = {"left": "".join(level[run:i]), "right": "".join(level[i + 1:run + FAN])}
            below.append([siblings, *proofs[i // FAN]])
        proofs = below
    return proofs


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _in_blocks(nodes: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """(tree, block, idx, ...) rows in tasks by block, each block's rows together and in order."""
    rows = nodes if messages is None else nodes.unionByName(messages, allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / FAN**levels).cast("long"))


def _sweep_up(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, idx, height, digest) of what blocks of nodes end in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (tree, block), rows in groupby(_columns(batches), key=lambda r: r[:2]):
            rows = list(rows)
            first, height = rows[0][2:4]
            up = min(levels, height)
            out.append((tree, block, height - up, climb(first, [r[4] for r in rows], up)[-1][0]))
            if len(out) >= 1000:
                yield _rows(out, ("tree", "idx", "height", "digest"), types)
                out = []
        if out:
            yield _rows(out, ("tree", "idx", "height", "digest"), types)

    types = (pa.int64(), pa.int64(), pa.int32(), pa.string())
    ordered = _in_blocks(_with_block(nodes, levels)).select("tree", "block", "idx", "height", "digest")
    return ordered.mapInArrow(run, "tree long, idx long, height int, digest string")


def _rows(rows: list[tuple], names: tuple, types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _sweep_down(nodes: DataFrame, messages: DataFrame, keep: list[str], levels: int) -> DataFrame:
    """(tree, idx, path, root, keep) of every node. ``messages`` is (tree, block, path, root): the proof of what
    each block ends in. They carry place -1 and so are met before the block's nodes."""
    kept = [nodes.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, rows in groupby(_columns(batches), key=lambda r: r[:2]):
            message, *rows = rows
            path, root = message[5:7]
            digests = climb(rows[0][2], [r[4] for r in rows], min(levels, rows[0][3]))
            for r, proof in zip(rows, descend(digests, path), strict=True):
                out.append((r[0], r[2], proof, root, *r[7:]))
                if len(out) >= 1000:
                    yield _rows(out, names, types)
                    out = []
        if out:
            yield _rows(out, names, types)

    names = ("tree", "idx", "path", "root", *keep)
    types = (pa.int64(), pa.int64(), PATH_TYPE, pa.string(), *[to_arrow_type(f.dataType) for f in kept])
    sent = messages.select("tree", "block", F.lit(-1).cast("long").alias("idx"), "path", "root")
    empty = _with_block(nodes, levels).withColumn("path", F.lit(None).cast(PATH)).withColumn("root", F.lit(None).cast("string"))
    schema = f"tree long, idx long, path {PATH}, root string" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept)
    ordered = _in_blocks(empty, sent).select("tree", "block", "idx", "height", "digest", "path", "root", *keep)
    return ordered.mapInArrow(run, schema)


def sweep(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The external queue of trees of ``nodes`` (tree, idx, height, digest, ...): the nodes themselves, then what
    each round of blocks ended in, a stored table a round, until every tree is down to its root."""
    tables = [nodes]
    rounds = -(-(nodes.agg(F.max("height")).first()[0] or 0) // levels)
    for _ in range(rounds):
        tables.append(stored(_sweep_up(tables[-1].where("height > 0"), levels), "node-queue"))
    return tables


def roots(tables: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    return reduce(DataFrame.unionAll, [t.where("height = 0").select("tree", "digest") for t in tables])


def paths(tables: list[DataFrame], above: DataFrame, keep: list[str], levels: int) -> DataFrame:
    """(tree, idx, path, root, keep) of the nodes that ``sweep`` was given; ``above`` is (tree, path, root): what
    lies beyond each tree's root, and the root."""
    nodes, messages = tables[0], None
    for table in reversed(tables[1:]):
        ended = table.where("height = 0").select("tree", F.col("idx").alias("block")).join(above, "tree")
        if messages is not None:
            passed = _sweep_down(table.where("height > 0"), messages, [], levels)
            ended = ended.unionByName(passed.withColumnRenamed("idx", "block"))
        messages = stored(ended, "proof-suffixes")
    lone = nodes.where("height = 0").join(above, "tree").select("tree", "idx", "path", "root", *keep)
    if messages is None:
        return lone
    return _sweep_down(nodes.where("height > 0"), messages, keep, levels).unionByName(lone)


def _by_source(rows: DataFrame) -> DataFrame:
    """With a key of the source that is never null."""
    return rows.withColumn("_none", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit("")))


def manifest(docs: DataFrame, levels: int = LEVELS, **checked: Column) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path) of every row, ``path`` the siblings from the leaf to the root; a
    leaf computed from changed rows, named in ``checked``, goes with its row."""
    leaves = stored(docs.select("doc_id", "source", leaf_digest().alias("leaf"), *[c.alias(n) for n, c in checked.items()]), "leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    rows = stored(placed(leaves, ["source"], order, ["doc_id", "leaf", *checked]), "placed-leaves")
    sources = rows.where("idx = 0").select(F.lit(0).cast("long").alias("top"), "source", F.col("n").alias("rows"))
    numbers = placed(sources, ["top"], [F.col("source").asc_nulls_first()], ["source", "rows"])
    trees = stored(_by_source(numbers.select("source", "rows", F.col("idx").alias("tree"), heights(F.col("n")).alias("top_height"))), "trees")
    key = ["_none", "_source"]
    joined = sliced_join(_by_source(rows), trees.select(*key, "tree"), key, ["idx"], trees.select(*key, F.col("rows").alias("n")))
    nodes = stored(joined.select("tree", "idx", heights(F.col("n")).alias("height"), F.col("leaf").alias("digest"), "source", "doc_id", *checked), "leaf-nodes")
    swept = sweep(nodes, levels)
    top = stored(roots(swept).join(trees.select("tree", "top_height"), "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("top_height").alias("height"), "digest"), "source-nodes")
    ended = sweep(top, levels)
    last = roots(ended).withColumnRenamed("digest", "root").withColumn("path", F.array().cast(PATH))
    above = paths(ended, last, ["digest"], levels).select(F.col("idx").alias("tree"), "path", F.concat("digest", "root").alias("root"))
    above = stored(above, "source-proofs")  # both roots as one text
    return paths(swept, above, ["digest", "source", "doc_id", *checked], levels).select(
        "doc_id", "source", F.col("digest").alias("leaf"), F.left("root", F.lit(64)).alias("subroot"), F.right("root", F.lit(64)).alias("root"),
        "path", *checked)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; every second row by
    the checksum of its id is tampered with: its line ends are gone."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = manifest(docs, tampered=leaf_digest(text=text))
    folded = rows.withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
