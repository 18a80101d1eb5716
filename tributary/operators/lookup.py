"""Catalog lookups: names to entities.

A table name stands for every table whose FQN ends with it, a container path for the container at
exactly that path. ``fqn.endswith(name)`` has no join key; but a name ends an FQN exactly if it is
one of the FQN's suffixes, so the catalog is turned into (index, key) rows, one per suffix or path,
and every lookup is an equi-join on them. That costs catalog rows x FQN length, whatever the number
of events. Popular suffixes collapse before the shuffle, in the partial aggregates and the partial
top-k, so no key is hot where only the best entries or a count are asked for.

Within a service the FQN must start with the service and a dot, and the name must end what is left:
the suffixes are then those of the rest.

Where the names are known, suffixes that no name asks for are dropped in the map tasks that make them
(``wanted``), so that what is shuffled follows the names and not the catalog.

One small file of a catalog makes very many suffixes, so its entries are dealt out to tasks by the number of
suffixes before they come apart (``suffix_tasks``, ``dealt``): neither the files nor the bytes of the catalog,
nor the session's number of partitions, say how many one task makes and sorts.

Spark's estimates do not know that suffixes multiply rows and would broadcast a whole index for the size of the
catalog's file; joins with what is as large as the catalog are therefore asked to be sort-merge joins (``_whole``).

Services may be data: every application has its own list, and one index keyed by (scope, name) serves them all.

First hit: order of services, then the shortest FQN, then FQN, then id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.names import CONTAINER_INDEX, TABLE_INDEX, lookup_index_of
from tributary.operators.skew import sliced_join

PAGE_SIZE = 10  # candidates a lookup asks for
WORDS = 1 << 19  # 64-bit words of the filter of wanted names: a broadcast of 8 MB at most
SUFFIXES = 1_000_000  # that one task makes and sorts: some 250 MB
BUCKETS = 16  # buckets of entries a task
AT = "_at"

# What each index holds.
ENTITY_TYPES = {TABLE_INDEX: "table", CONTAINER_INDEX: "container"}


def suffix_tasks(catalog: DataFrame, each: Column | int = 1) -> int:
    """How many tasks make the suffixes of a catalog, ``each`` times those of an FQN. One look at its FQNs."""
    found = catalog.where(F.col("entity_type") == ENTITY_TYPES[TABLE_INDEX]).agg(F.sum((F.length("fqn") + 1).cast("bigint") * each)).first()[0]
    return -(-max(1, found or 0) // SUFFIXES)


def dealt(entries: DataFrame, tasks: int) -> DataFrame:
    """Entries spread over ``tasks`` tasks in buckets of the column ``AT``, copies of one entry too."""
    bucket = F.pmod(F.monotonically_increasing_id(), F.lit(tasks * BUCKETS))
    return entries.withColumn(AT, bucket).repartition(tasks, AT) if tasks > 1 else entries.withColumn(AT, F.lit(0).cast("bigint"))


def _least(tables: DataFrame, paths: DataFrame, on: Sequence[str], order: Column, tasks: int) -> DataFrame:
    """The least ``order`` of every key, as ``best``. Of more than one task, suffixes shrink by bucket where they
    are made, and then meet in as many tasks again."""
    least = F.min(order).alias("best")
    if tasks == 1:
        return tables.drop(AT).unionByName(paths).groupBy(*on).agg(least)
    shrunk = tables.groupBy(AT, *on).agg(least).drop(AT).unionByName(paths.select(*on, order.alias("best")))
    return shrunk.repartition(tasks, *on).groupBy(*on).agg(F.min("best").alias("best"))


def _tails(tables: DataFrame, services: Sequence[str]) -> DataFrame:
    """What a name has to end: the whole FQN, or its rest below each service."""
    if not services:
        return tables.select(AT, "id", "fqn", F.lit(0).alias("rank"), F.col("fqn").alias("tail"))
    prefixes = [service + "." for service in services]
    scopes = F.array(
        *[F.struct(F.lit(rank).alias("rank"), F.lit(p).alias("prefix")) for rank, p in enumerate(prefixes)]
    )
    return tables.select(AT, "id", "fqn", F.inline(F.filter(scopes, lambda s: F.startswith(F.col("fqn"), s["prefix"])))).select(
        AT, "id", "fqn", "rank", F.substr("fqn", F.length("prefix") + 1).alias("tail")
    )


def table_keys(catalog: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    return _table_keys(catalog, services, suffix_tasks(catalog)).drop(AT)


def _table_keys(catalog: DataFrame, services: Sequence[str], tasks: int) -> DataFrame:
    tables = catalog.where((F.col("entity_type") == ENTITY_TYPES[TABLE_INDEX]) & F.col("fqn").isNotNull())
    if services:
        tables = tables.where(reduce(or_, [F.col("fqn").startswith(service + ".") for service in services]))
    starts = F.sequence(F.lit(1), F.length("tail") + 1)
    return _tails(dealt(tables.select("id", "fqn"), tasks), services).select(
        AT, F.lit(TABLE_INDEX).alias("index"),
        F.explode(F.transform(starts, lambda i: F.substr("tail", i))).alias("key"),
        "rank", "fqn", "id",
    )


def container_keys(catalog: DataFrame) -> DataFrame:
    return catalog.where(
        (F.col("entity_type") == ENTITY_TYPES[CONTAINER_INDEX]) & F.col("full_path").isNotNull()
    ).select(
        F.lit(CONTAINER_INDEX).alias("index"), F.col("full_path").alias("key"),
        F.lit(0).alias("rank"), "fqn", "id",
    )


def search_keys(catalog: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    """Every key an entity answers to, of one row per entity. Services scope tables only."""
    entities = unique_entities(catalog, "fqn", "full_path")
    tables = _table_keys(entities, services, suffix_tasks(catalog)).drop(AT)
    return tables.unionByName(container_keys(entities))


def _bits(*key: str) -> tuple[Column, Column]:
    """Place of a key in the filter: the word, and two bits of it."""
    h = F.xxhash64(*key)
    one = lambda shift: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, shift).bitwiseAND(63).cast("int"))
    return F.pmod(h, F.lit(WORDS)).alias("_word"), one(20).bitwiseOR(one(40)).alias("_mask")


def wanted(keys: DataFrame, names: DataFrame, on: Sequence[str] = ("index", "key")) -> DataFrame:
    """``keys`` without nearly all that no row of ``names`` (``on``) asks for; what is asked for stays.

    A Bloom filter made of plain rows: a word per row, ``WORDS`` of them at most, whatever the number of names.
    That bound is why it is broadcast, so keys meet it in the task that makes them, before any exchange. With
    very many names it fills up and drops less, never more."""
    word, mask = _bits(*on)
    filled = names.select(word, mask).groupBy("_word").agg(F.bit_or("_mask").alias("_filled"))
    hit = F.col("_filled").bitwiseAND(F.col("_mask")) == F.col("_mask")
    return keys.select("*", word, mask).join(F.broadcast(filled), "_word").where(hit).drop("_word", "_mask", "_filled")


def lookup_index(catalog: DataFrame, services: Sequence[str] = (), names: DataFrame | None = None) -> DataFrame:
    """The first hit of every key that has one, or of those that ``names`` (table_name) ask for. Without names it
    is worth writing out where the catalog is reused."""
    order = F.struct("rank", F.length("fqn").alias("len"), "fqn", "id")
    tasks = suffix_tasks(catalog)
    asked = (lambda keys: keys) if names is None else (lambda keys: wanted(keys, _keyed(names)))
    tables, paths = asked(_table_keys(catalog, services, tasks)), asked(container_keys(catalog))
    return _least(tables, paths, ["index", "key"], order, tasks).select(
        "index", "key",
        F.when(F.col("index") == TABLE_INDEX, ENTITY_TYPES[TABLE_INDEX])
        .otherwise(ENTITY_TYPES[CONTAINER_INDEX])
        .alias("entity_type"),
        F.col("best.id").alias("id"),
        F.col("best.fqn").alias("fqn"),
    )


def first_service(services: Sequence[str]) -> list[str]:
    """Observed rule: with a list of services only the first is ever asked."""
    return list(services[:1])


def _keyed(names: DataFrame) -> DataFrame:
    """Index and key come out of a generator: what Spark infers about them from the catalog is then
    tested here, once per name, and not on every reference below."""
    index = lookup_index_of(F.col("table_name"))
    key = F.struct(index.alias("index"), F.col("table_name").alias("key"))
    return names.select("*", F.inline(F.array(key)))


def _whole(rows: DataFrame) -> DataFrame:
    """Rows that follow the catalog: shuffled and sorted, never broadcast, whatever size is guessed for them."""
    return rows.hint("merge")


def first_hits(names: DataFrame, index: DataFrame) -> DataFrame:
    """``names`` has each table_name once. Misses drop out."""
    return _keyed(names).join(_whole(index), ["index", "key"]).drop("index", "key")


def hits(names: DataFrame, keys: DataFrame) -> DataFrame:
    """Every catalog entry a name matches. A key may be hot in the catalog, hence the sliced join."""
    asked = _keyed(names)
    keys = wanted(keys, asked)
    counts = keys.groupBy("index", "key").agg(F.count(F.lit(1)).alias("n"))
    return sliced_join(keys, asked, ["index", "key"], ["id", "fqn"], counts).drop("index", "key")


def hit_counts(names: DataFrame, keys: DataFrame) -> DataFrame:
    asked = _keyed(names)
    counts = wanted(keys, asked).groupBy("index", "key").agg(F.count(F.lit(1)).alias("found"))
    return (
        asked
        .join(counts, ["index", "key"], "left")
        .select("table_name", F.coalesce("found", F.lit(0)).cast("bigint").alias("hits"))
    )


def candidates(names: DataFrame, keys: DataFrame, page: int = PAGE_SIZE) -> DataFrame:
    """The first page of hits per name. Ranking by key comes first: Spark then cuts every
    key to a page in each map task, before the shuffle."""
    order = Window.partitionBy("index", "key").orderBy("rank", F.length("fqn"), "fqn", "id")
    asked = _keyed(names)
    pages = wanted(keys, asked).withColumn("place", F.row_number().over(order)).where(F.col("place") <= page)
    return asked.join(pages, ["index", "key"]).drop("index", "key", "rank")


def unresolved(names: DataFrame, index: DataFrame) -> DataFrame:
    """Names without a hit, with whatever ``names`` counts for them."""
    keys = index.select("index", "key")
    return _keyed(names).join(_whole(keys), ["index", "key"], "left_anti").drop("index", "key")


def unique_entities(catalog: DataFrame, *columns: str) -> DataFrame:
    """One row per entity: replies of a catalog may repeat one. Of several rows the greatest stays."""
    last = F.max(F.struct(*(columns or ("fqn", "full_path", "column_names")))).alias("last")
    return catalog.groupBy("id", "entity_type").agg(last).select("id", "entity_type", "last.*")


# Services as data


def scopes(services: Column, first_only: bool = True) -> Column:
    """What an application's lookups are limited to, in order: for each of its services the prefix of an FQN; one
    empty prefix without services. Observed rule: only the first service is ever asked."""
    asked = F.slice(services, 1, 1) if first_only else services
    return F.when(F.size(services) > 0, F.transform(asked, lambda s: F.concat(s, F.lit(".")))).otherwise(F.array(F.lit("")))


def _beginnings(fqn: str) -> Column:
    """The scopes an FQN is below: the empty one, and its beginnings up to a dot."""
    dots = F.filter(F.sequence(F.lit(1), F.length(fqn)), lambda i: F.substr(fqn, i, F.lit(1)) == ".")
    starts = F.when(F.length(fqn) > 0, dots).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(F.array(F.lit("")), F.transform(starts, lambda i: F.substr(fqn, F.lit(1), i))))


def _scoped_tables(catalog: DataFrame, asked: DataFrame, tasks: int) -> DataFrame:
    """Suffixes below nearly no scope but those that are asked, which the filter of bounded size lets through: a
    few scopes hold most of a catalog, and a join on them would be a few tasks'."""
    tables = catalog.where((F.col("entity_type") == ENTITY_TYPES[TABLE_INDEX]) & F.col("fqn").isNotNull()).select("id", "fqn")
    below = wanted(tables.select("id", "fqn", F.explode(_beginnings("fqn")).alias("scope")), asked.select("scope").distinct(), ["scope"])
    tail = F.substr("fqn", F.length("scope") + 1)
    ends = F.sequence(F.lit(1), F.length("fqn") - F.length("scope") + 1)
    return dealt(below, tasks).select(
        AT, F.lit(TABLE_INDEX).alias("index"), "scope", F.explode(F.transform(ends, lambda i: F.substr(tail, i))).alias("key"), "fqn", "id"
    )


def _scoped_paths(catalog: DataFrame) -> DataFrame:
    return container_keys(catalog).select("index", F.lit("").alias("scope"), "key", "fqn", "id")


def scoped_keys(catalog: DataFrame, asked: DataFrame) -> DataFrame:
    """(index, scope, key, fqn, id) of every scope in ``asked`` (scope). A scope ends in a dot, so it starts an FQN
    exactly if it is one of the FQN's beginnings up to a dot: one row for each of these, and an equi-join. Only the
    FQNs below scopes that are asked come apart into suffixes. Containers have the empty scope."""
    tables = _scoped_tables(catalog, asked, suffix_tasks(catalog, F.size(_beginnings("fqn")))).drop(AT)
    return tables.join(asked.select("scope").distinct(), "scope", "left_semi").unionByName(_scoped_paths(catalog))


def _limits(services: DataFrame, first_only: bool) -> DataFrame:
    """(app_id, limits): the scopes of an application with their ranks; of one listed several times, all of them."""
    ranked = F.transform(scopes(F.col("services"), first_only), lambda scope, rank: F.struct(rank.alias("rank"), scope.alias("scope")))
    all_ranked = F.flatten(F.collect_list(ranked))
    return services.groupBy("app_id").agg(F.array_sort(F.array_distinct(all_ranked)).alias("limits"))


def resolve_per_application(names: DataFrame, services: DataFrame, catalog: DataFrame, first_only: bool = True) -> DataFrame:
    """(app_id, table_name, entity_type, id, fqn): the first hit of each distinct name of ``names`` (app_id, table_name)
    within its application's services (app_id, services); applications that list none are not limited. Misses drop out.

    Each name is looked up once per list of scopes, in one index of (scope, name), however many applications share
    the list; applications then meet the first hits by list and name."""
    is_table = lookup_index_of(F.col("table_name")) == TABLE_INDEX
    unlimited = F.array(F.struct(F.lit(0).alias("rank"), F.lit("").alias("scope")))
    limits = F.when(is_table & F.col("limits").isNotNull(), F.col("limits")).otherwise(unlimited)
    listed = names.select("app_id", "table_name").distinct().join(_limits(services, first_only), "app_id", "left")
    limited = listed.select("app_id", "table_name", limits.alias("limits"))
    lists = limited.select("limits", "table_name").distinct()
    asked = _keyed(lists.select("limits", "table_name", F.inline("limits")))
    distinct = asked.select("index", "scope", "key").distinct()
    on = ["index", "scope", "key"]
    order = F.struct(F.length("fqn").alias("len"), "fqn", "id")
    tasks = suffix_tasks(catalog, F.size(_beginnings("fqn")))
    tables, paths = wanted(_scoped_tables(catalog, distinct, tasks), distinct, on), wanted(_scoped_paths(catalog), distinct, on)
    best = _least(tables, paths, on, order, tasks)
    hits = asked.join(_whole(best), on).groupBy("limits", "table_name").agg(F.min(F.struct("rank", "index", "best")).alias("hit"))
    kind = F.when(F.col("hit.index") == TABLE_INDEX, ENTITY_TYPES[TABLE_INDEX]).otherwise(ENTITY_TYPES[CONTAINER_INDEX])
    found = hits.select("limits", "table_name", kind.alias("entity_type"), "hit.best.id", "hit.best.fqn")
    return limited.join(_whole(found), ["limits", "table_name"]).select("app_id", "table_name", "entity_type", "id", "fqn")


def with_columns(resolved: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add the entity's column names, of the greatest row where the catalog repeats an entity. They are joined
    to the resolved names only, so the arrays never travel with the suffixes. Both sides are as small as the
    catalog; Spark splits skew by itself."""
    columns = catalog.groupBy("id", "entity_type").agg(F.max("column_names").alias("column_names"))
    return resolved.join(_whole(columns), ["id", "entity_type"])
