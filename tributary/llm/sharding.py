"""Sharding by balanced label propagation.

Linked documents (equal texts) should lie in one shard, and shards should hold equally many documents: the
law is ``rows``, counts at most one apart. A group of more documents than a shard holds fills whole shards first,
and what is left of it is a community as any smaller group. Documents start dealt out evenly; how many each shard
got is its quota. In each round every community that is not placed yet votes: it wants the shard with most of its
documents among those that still have room for all of it, or, where none has, another one, drawn in proportion to
the room. A shard takes the largest of those that want it, one after another, until one does not fit. That one
wants another shard in the next round, so the rounds end: every shard that is wanted takes something, and what it
refuses never fits it again. What is left then is larger than any room, and as rooms and documents left are equally
many, it is fewer communities than shards: only they are cut. Documents without links fill what is free.

DataFrame functions only. Links are never listed as pairs: a group votes by its counts per shard. Numbers
inside a shard come from two levels (hash buckets), so no task sorts a shard. What the driver sees is a number
per shard.

Defined results: a null text is an empty one; repeated rows are documents of their own; null doc_ids stay;
an empty table gives no rows; with fewer documents than shards some shards are empty. Texts of any length count by
their digest. Equal votes are decided by hash, and of communities of one size those of the lesser hash bucket, then
name, are taken first. Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import bucket_count, numbered, stored
from tributary.operators.skew import sliced_join

SHARDS = 40
EXTRA_BYTES = 16


def _start(docs: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """Documents with their first shard, the community they should stay with (null without links), and whether that
    is a part that fills its shard."""
    text = F.coalesce("text", F.lit(""))
    base = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + EXTRA_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("group"),
        ),
        "shard-documents",
    )
    rows = base.count()
    whole, more = divmod(rows, shards)
    # what one shard can hold; parts of one document less fit all shards, so they can be placed at once
    most = max(1, whole + (more > 0))
    part_size = whole if whole > 1 else most
    groups = base.groupBy("group").agg(F.count("*").alias("members")).where("members > 1")
    linked = base.join(groups, "group", "left")
    large = stored(groups.where(F.col("members") > most), "large-groups")
    split = linked.where("members IS NULL OR members <= " + str(most)).withColumn("part", F.lit(None).cast("long"))
    if not large.isEmpty():
        cut = numbered(linked.where(F.col("members") > most), ["group"], ["doc_id"], "_in_group", bucket_count(rows))
        split = split.unionByName(cut.withColumn("part", F.expr(f"_in_group div {part_size}")).drop("_in_group"))
    # at most as many full parts as shards
    full = large.select("group", F.explode(F.expr(f"sequence(0, members div {part_size} - 1)")).alias("part")) if whole > 1 else None
    community = F.when(F.col("members").isNotNull(), F.concat_ws(":", "group", "part"))
    named = split.withColumn("community", community).drop("members")
    columns = ["doc_id", "size", "text_crc32", "group", "community"]
    order, buckets = ["doc_id", "group"], bucket_count(rows)
    if full is None or large.isEmpty():
        dealt = numbered(named, [], order, "_number", buckets)
        shard = (F.col("_number") % shards).cast("int")
        return stored(dealt.select(*columns, shard.alias("shard"), F.lit(False).alias("fixed")), "shards"), rows
    ranked = full.withColumn("_shard", (F.row_number().over(Window.orderBy("group", "part")) - 1).cast("int"))  # a row per shard
    placed = stored(named.join(ranked, ["group", "part"], "left"), "placed-parts")
    n = full.count()
    others = numbered(placed.where("_shard IS NULL"), [], order, "_number", buckets)
    rest = whole * (shards - n)
    # the shards left get ``whole`` each; after that one document more for ``more`` of all shards
    even = F.col("_number") % F.lit(max(1, shards - n)) + n
    shard = F.when(F.col("_number") < rest, even).otherwise(shards - 1 - (F.col("_number") - rest)).cast("int")
    filled = placed.where("_shard IS NOT NULL").select(*columns, F.col("_shard").alias("shard"), F.lit(True).alias("fixed"))
    return stored(filled.unionAll(others.select(*columns, shard.alias("shard"), F.lit(False).alias("fixed"))), "shards"), rows


def _communities(state: DataFrame) -> DataFrame:
    """(community, members, votes): how many documents of a community are in which shard, at most one entry a shard."""
    votes = state.where("community IS NOT NULL AND NOT fixed").groupBy("community", "shard").agg(F.count("*").alias("n"))
    return votes.groupBy("community").agg(
        F.sum("n").alias("members"), F.collect_list(F.struct("n", "shard")).alias("votes")
    )


def _wish(room: Sequence[int], turn: int) -> Column:
    """The shard a community wants: of those that have room for all of it the one with most of its documents,
    or, where none of them has, another one, drawn in proportion to the room. Null if it fits nowhere."""
    rooms = F.array(*[F.lit(r).cast("long") for r in room])
    fits = lambda shard: F.get(rooms, shard) >= F.col("members")
    draw = lambda shard: F.xxhash64("community", shard, F.lit(turn))
    voted = F.transform(
        F.filter("votes", lambda v: fits(v["shard"])),
        lambda v: F.struct(v["n"].alias("n"), draw(v["shard"]).alias("tie"), v["shard"].alias("shard")),
    )
    # the least of exponential draws, each at the rate of its room
    wait = lambda shard: -F.log((F.pmod(draw(shard), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)) / F.get(rooms, shard)
    others = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(len(room) - 1)), fits),
        lambda shard: F.struct(wait(shard).alias("wait"), shard.alias("shard")),
    )
    return F.coalesce(F.array_max(voted)["shard"], F.array_min(others)["shard"])


def _round(left: DataFrame, room: Sequence[int], turn: int, buckets: int) -> DataFrame:
    """``left`` with each community's ``wish`` and whether it is ``granted``: a shard takes the largest communities
    that wish it, as many as have room in it one after another.

    Communities of one size and one hash bucket are a cell; cells, far fewer than communities, are summed up
    per shard, so that no task sorts all that wish one shard.
    """
    wishing = left.withColumn("wish", _wish(room, turn)).withColumn("cell", F.pmod(F.xxhash64("community"), F.lit(buckets)))
    cells = wishing.where("wish IS NOT NULL").groupBy("wish", "members", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("wish").orderBy(F.desc("members"), "cell").rowsBetween(Window.unboundedPreceding, -1)
    first = cells.withColumn("taken", F.coalesce(F.sum(F.col("n") * F.col("members")).over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("wish", "members", "cell").orderBy("community"))
    rooms = F.array(*[F.lit(r).cast("long") for r in room])
    granted = F.col("taken") + F.col("inside") * F.col("members") <= F.get(rooms, F.col("wish"))
    return wishing.withColumn("inside", inside).join(first, ["wish", "members", "cell"], "left").select(
        *left.columns, "wish", F.coalesce(granted, F.lit(False)).alias("granted")
    )


def _room(state: DataFrame, shards: int) -> list[int]:
    """Places of each shard that are not held by a part of a larger group: ``shards`` numbers."""
    counts = {r["shard"]: r["n"] for r in state.where("NOT fixed").groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return [counts.get(s, 0) for s in range(shards)]


def _filled(docs: DataFrame, room: Sequence[int], at: Column) -> DataFrame:
    """``docs`` with ``shard``, from their numbers ``at``: shards are filled one after another."""
    ends = F.array(*[F.lit(e).cast("long") for e in accumulate(room)])
    return docs.withColumn("shard", F.size(F.filter(ends, lambda end: end <= at)).cast("int"))


def propagate(state: DataFrame, rows: int, shards: int, rounds: int | None = None) -> DataFrame:
    """``state`` with new shards: communities where most of their documents were, as the room allows."""
    room, turn, placed = _room(state, shards), 0, []
    left = stored(_communities(state), "communities")
    while not left.isEmpty() and turn != rounds:
        judged = stored(_round(left, room, turn, bucket_count(rows, shards)), "wishes")
        taken = judged.where("granted").groupBy("wish").agg(F.sum("members").alias("n")).collect()  # a row per shard
        if not taken:
            break
        for r in taken:
            room[r["wish"]] -= r["n"]
        placed.append(judged.where("granted").select("community", F.col("wish").alias("to")))
        left, turn = judged.where("NOT granted").select(*left.columns), turn + 1
    homes = reduce(DataFrame.unionAll, placed) if placed else None
    columns = state.columns
    linked, free = state.where("community IS NOT NULL AND NOT fixed"), state.where("community IS NULL")
    parts = [state.where("fixed")]
    if homes is not None:
        counts = linked.groupBy("community").agg(F.count("*").alias("n"))
        moved = sliced_join(linked, homes, ["community"], ["doc_id", "group"], counts)
        parts.append(moved.withColumn("shard", F.col("to").cast("int")).select(columns))
    # after the last round what is left is larger than any room: fewer communities than shards
    start = Window.orderBy(F.desc("members"), "community").rowsBetween(Window.unboundedPreceding, -1)
    cut = stored(left.withColumn("first", F.coalesce(F.sum("members").over(start), F.lit(0))).select("community", "first", "members"), "cut-communities")
    held = cut.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    if held:
        rest = numbered(linked.join(cut, "community"), ["community"], ["doc_id", "group"], "_n", bucket_count(rows))
        parts.append(_filled(rest, room, F.col("first") + F.col("_n")).select(columns))
    dealt = numbered(free, [], ["doc_id", "group"], "_n", bucket_count(rows))
    parts.append(_filled(dealt, room, F.col("_n") + held).select(columns))
    return stored(reduce(DataFrame.unionAll, parts), "shards")


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, community) for every document."""
    state, rows = _start(docs, shards)
    state = propagate(state, rows, shards, rounds)
    placed = numbered(state, ["shard"], ["doc_id", "group"], "slot", bucket_count(rows, shards))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "community",
    )
