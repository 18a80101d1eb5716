"""Near-duplicates by SimHash, linked with the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``distance`` or fewer differing bits. The bits are cut into parts, correlated
bits together (measured on a bounded sample of the fingerprints), and each part gets a radius of its own: if
the radii plus one add up to more than ``distance``, two linked fingerprints agree within the radius in at
least one part. How many parts, and which radii, is chosen by dynamic programming over the cost of probing
and the candidates expected from the sample, a probe at the cost of its shuffle; a part may be left out (radius
-1). With many fingerprints the keys are the pairs of ``distance + 2`` parts, two of which no linked ones differ in:
six keys of 32 bits, the most there are for any number of fingerprints below 10^10. Fingerprints are then
probed part by part and candidates verified by their differing bits.

The work is on distinct fingerprints, whatever the number of copies. A bucket of more than ``HOT`` of them
is never paired: its fingerprints meet at the 65 values within one bit of each, which two fingerprints share
exactly if they differ in two bits at most; that is linear in the bucket and as exact.
Distances above two are refused.

``keep_one`` leaves one document of each component: the row of the smallest doc_id, null last.

Defined results: a text without words, null included, has fingerprint zero and links like any other; null
doc_ids are never the smallest of a component that has another; repeated rows stay in ``near_duplicates``. Of
several rows with a component's smallest doc_id ``keep_one`` leaves that of the least text digest, and of rows
that agree in both one, whichever it is. Columns of any name are handed on. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import graph
from tributary.llm.common import row_columns, stored, whole_row
from tributary.llm.shingles import hashes, simhash

BITS = 64
WORDS = 3
DISTANCE = 2
SAMPLE = 20_000  # fingerprints that partition and radii are fitted to
HOT = 256
PARTS = (2, 3, 4)
MAX_RADIUS = 1
PROBE = 50  # what a key that is shuffled costs, in compared pairs


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The other columns of ``docs`` with ``fp``, the fingerprint of ``text``, for every row."""
    others = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(hashes(x.as_py(), words)) for x in batch.column("text")]
            kept = [batch.column(f.name) for f in others]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fps, pa.int64())], names=[*[f.name for f in others], "fp"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return docs.mapInArrow(run, kinds + "fp long")


# Fitting the parts


def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into parts of nearly equal size, each grown by the bit most correlated with it."""
    centred = bits - bits.mean(axis=0, keepdims=True) if len(bits) else np.zeros((1, BITS))
    spread = np.sqrt((centred**2).sum(axis=0))
    related = np.abs(centred.T @ centred) / np.maximum(np.outer(spread, spread), 1e-9)
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        first = max(free, key=lambda b: (related[b, sorted(free)].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            nearest = max(free, key=lambda b: (related[b, group].sum(), -b))
            group.append(nearest)
            free.remove(nearest)
        groups.append(sorted(group))
    return groups


def _keys(bits: np.ndarray, group: list[int]) -> np.ndarray:
    return bits[:, group].astype(np.uint64) @ (np.uint64(1) << np.arange(len(group), dtype=np.uint64))


def _cost(keys: np.ndarray, width: int, radius: int, rows: int) -> float:
    """Probes and candidates of a part at a radius, carried from the sample to ``rows`` fingerprints."""
    if radius < 0:
        return 0.0
    values, counts = np.unique(keys, return_counts=True)
    meets = float((counts * (counts - 1)).sum())
    probes = 1
    if radius == 1:
        probes += width
        for j in range(width):
            near = values ^ np.uint64(1 << j)
            at = np.minimum(np.searchsorted(values, near), len(values) - 1)
            meets += float((counts * np.where(values[at] == near, counts[at], 0)).sum())
    pairs = max(len(keys) * (len(keys) - 1), 1)
    # below what the sample can show, keys count as even
    share = max(meets / pairs, probes / 2.0**width)
    return PROBE * rows * probes + rows * rows * share


def choose_parts(fps: np.ndarray, rows: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """The (bits, radius) of every part to probe, of least expected cost."""
    bits = _bit_matrix(fps)
    best: tuple[float, list] = (float("inf"), [])
    for parts in sorted({*PARTS, distance + 1}):
        groups = group_bits(bits, parts)
        # plans[n]: the cheapest radii so far that account for n differing bits
        plans: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            keys, grown = _keys(bits, group), {}
            for radius in range(-1, min(distance, MAX_RADIUS) + 1):
                cost = _cost(keys, len(group), radius, rows)
                for n, (spent, radii) in plans.items():
                    reached = min(n + radius + 1, distance + 1)
                    plan = (spent + cost, [*radii, radius])
                    if reached not in grown or plan < grown[reached]:
                        grown[reached] = plan
            plans = grown
        if distance + 1 in plans and plans[distance + 1][0] < best[0]:
            cost, radii = plans[distance + 1]
            best = (cost, [(g, r) for g, r in zip(groups, radii, strict=True) if r >= 0])
    # parts taken together: of two parts more than bits that differ, two at least are untouched
    pairs = [sorted(a + b) for a, b in combinations(group_bits(bits, distance + 2), 2)]
    cost = sum(_cost(_keys(bits, pair), len(pair), 0, rows) for pair in pairs)
    return best[1] if best[0] <= cost else [(pair, 0) for pair in pairs]


# Probing


def _key(group: list[int]) -> Column:
    taken = [F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), j) for j, b in enumerate(group)]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def _within(distance: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance


def _hot_links(hot: DataFrame, distance: int) -> DataFrame:
    """Links among the fingerprints of hot buckets: all that share a value within one bit are at most two
    apart, and all at most two apart share one."""
    one = F.lit(1).cast("long")
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda j: F.call_function("shiftleft", one, j))
    near = F.concat(F.array("fp"), F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m)))
    balls = hot.select(F.col("fp").alias("b"), F.explode(near).alias("value"))
    met = balls.groupBy("value").agg(F.array_sort(F.collect_list("b")).alias("all")).where(F.size("all") > 1)  # 65 at most
    links = met.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, BITS + 1)).alias("b"))
    return links.where(_within(distance)) if distance < 2 else links


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) pairs of distinct fingerprints whose components are those of all links at ``distance``."""
    if distance > 2:
        raise ValueError("hot buckets are linked exactly up to a distance of 2")
    rows = fps.count()
    sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64)
    if rows < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    parts = choose_parts(sample, rows, distance)
    index = reduce(
        DataFrame.unionAll,
        [fps.select(F.lit(n).alias("part"), _key(g).alias("key"), F.col("fp").alias("b")) for n, (g, _) in enumerate(parts)],
    )
    probes = reduce(
        DataFrame.unionAll,
        [
            fps.select(
                F.lit(n).alias("part"), F.col("fp").alias("a"),
                F.explode(
                    F.array(_key(g), *[_key(g).bitwiseXOR(F.lit(1 << j).cast("long")) for j in range(len(g) if r else 0)])
                ).alias("key"),
            )
            for n, (g, r) in enumerate(parts)
        ],
    )
    # a hot bucket stands for more than HOT index rows, so this list is small beside them
    sizes = index.groupBy("part", "key").agg(F.count("*").alias("n"))
    hot = stored(sizes.where(F.col("n") > HOT).drop("n"), "hot-buckets", rows * len(parts) // HOT)
    some_hot = not hot.isEmpty()
    cold = index.join(hot, ["part", "key"], "left_anti") if some_hot else index
    paired = (
        probes.join(cold, ["part", "key"])
        .where((F.col("a") != F.col("b")) & _within(distance)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    if not some_hot:
        return paired
    members = probes.join(hot, ["part", "key"]).select(F.col("a").alias("fp")).unionAll(
        index.join(hot, ["part", "key"]).select(F.col("b").alias("fp"))
    ).distinct()
    return paired.unionAll(_hot_links(members, distance))


def classes(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, class) of every distinct fingerprint in ``fps``: a class is what links connect."""
    roots = graph.components(links(fps, distance))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("class")
    )


def _components(printed: DataFrame, distance: int) -> DataFrame:
    """(fp, class, component_id) of every distinct fingerprint in ``printed`` (doc_id, fp)."""
    rows = printed.count()
    distinct = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints", rows)
    classed = stored(distinct.join(classes(distinct.select("fp"), distance), "fp"), "fingerprint-classes", rows)
    smallest = classed.groupBy("class").agg(F.min("least").alias("component_id"))
    return classed.join(smallest, "class").select("fp", "class", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: 16 hex digits, and the smallest doc_id reachable."""
    printed = stored(fingerprints(docs.select("doc_id", "text"), words), "fingerprints")
    found = _components(printed, distance).drop("class")
    return printed.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def keep_one(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component."""
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    printed = stored(fingerprints(keyed, words), "fingerprints")
    # rows with the smallest doc_id of their component; many only where no row of a component has a doc_id
    first = printed.join(_components(printed, distance), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    texts = first.groupBy("class", "key").agg(F.first("doc_id").alias("id"), F.count("*").alias("rows"))
    least = texts.groupBy("class").agg(F.min(F.struct("key", "id", "rows")).alias("x"))
    kept = stored(least.select("x.key", "x.id", "x.rows"), "kept")
    rows = docs.select(whole_row(docs), text_key(F.col("text")).alias("text_key"))
    stay = rows.join(kept, (F.col("text_key") == F.col("key")) & F.col("doc.doc_id").eqNullSafe(F.col("id")))
    once = stay.where("rows = 1").select("doc")
    if not kept.where("rows > 1").isEmpty():
        once = once.unionAll(stay.where("rows > 1").dropDuplicates(["key", "id"]).select("doc"))
    return once.select(row_columns(docs))
