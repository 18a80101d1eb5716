"""The registered queries: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import documents, names, settings
from tributary.functions.names import service_list
from tributary.operators import edges, events, executions, jobs, lookup
from tributary.operators import settings as conf
from tributary.plans import fixtures
from tributary.plans.scratch import scratch_folder
from tributary.sources import catalog as catalog_source
from tributary.sources import edge_table, execution_log, run_events
from tributary.sources.edge_store import compact_edges, read_edges
from tributary.streaming.edges import start_edges, start_rejects, start_table_edges
from tributary.streaming.executions import closing_row, pair_execution_streams

SERVICES = "svc0,svc1"
BOUND = "20 years"  # wider than the test data
CLOSE = "2200-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _naive(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


def _refs(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.dataset_refs(spark, sf)


def _named(spark: SparkSession, sf: str) -> DataFrame:
    return events.named(_refs(spark, sf))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return events.name_counts(_named(spark, sf))


def _gated(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a kept type; pairing them with both sides does the rest of the gate."""
    return fixtures.run_events(spark, sf).where(events.kept_type())


def _index(spark: SparkSession, sf: str) -> edges.Index:
    """Of the names that are asked, and no others."""
    return lambda asked: lookup.lookup_index(fixtures.catalog(spark, sf), names=asked)


# Sources


@query
def run_events_long(spark: SparkSession, sf: str) -> DataFrame:
    link = F.get("symlinks", F.lit(0))
    return events.to_long(fixtures.nested_events(spark, sf)).select(
        "event_id", "event_type", "side", "pos", "namespace", "name",
        link["namespace"].alias("sym_namespace"), link["name"].alias("sym_name"),
    )


@query
def run_events_from_json(spark: SparkSession, sf: str) -> DataFrame:
    """Producers' documents through to column pairs, by the run that each event stands for."""
    found = run_events.from_documents(fixtures.event_documents(spark, sf))
    by_run = found.withColumn("event_id", F.substr("run_key", F.lit(5)).cast("bigint")).drop("run_key")
    links = edges.column_edges(by_run, _index(spark, sf), fixtures.catalog(spark, sf))
    return edges.column_rows(links, ["event_id", "in_pos", "out_pos", "from_id", "to_id"])


@query
def catalog_from_search_json(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog_source.catalog_from_replies(fixtures.search_replies(spark, sf))
    return found.select(
        "reply_id", "id", "entity_type", "fqn", F.array_join("column_names", ",").alias("column_names")
    )


@query
def execution_records_from_log(spark: SparkSession, sf: str) -> DataFrame:
    """All record types in one frame, out of one pass."""
    found = execution_log.all_records(execution_log.records(fixtures.event_log_lines(spark, sf)))
    stages = F.array_join(F.col("stage_ids").cast("array<string>"), ",")
    return found.select("app_id", "record", "id", "execution_id", _naive("ts"), stages.alias("stages"), "records", "bytes")


@query
def conf_from_log(spark: SparkSession, sf: str) -> DataFrame:
    """The settings of the applications, as their logs have them."""
    found = execution_log.settings(execution_log.records(fixtures.event_log_lines(spark, sf)))
    return found.where(F.col("key").startswith(conf.PREFIX))


# Filters


@query
def event_gate(spark: SparkSession, sf: str) -> DataFrame:
    return events.gate_long(fixtures.run_events(spark, sf), _refs(spark, sf))


@query
def rejected_events(spark: SparkSession, sf: str) -> DataFrame:
    return events.rejected_events(fixtures.nested_events(spark, sf)).select(
        "event_id", "event_type", "reason"
    )


@query
def named_datasets(spark: SparkSession, sf: str) -> DataFrame:
    return _named(spark, sf).select("event_id", "side", "table_name")


@query
def sent_references(spark: SparkSession, sf: str) -> DataFrame:
    """References of the long form that are reached before a broken symlink."""
    refs = events.to_long(fixtures.nested_events(spark, sf)).where("pos IS NOT NULL")
    return events.with_names(events.sent_refs(refs)).select("event_id", "side", "pos", "table_name")


@query
def containers_and_tables(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(names.is_object_store(F.col("table_name")), "container").otherwise("table")
    return _named(spark, sf).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query
def conf_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return conf.section_settings(fixtures.conf(spark, sf))


# Scalar functions, over the distinct values with their number of references


def _distinct(df: DataFrame, *columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_refs"))


@query
def object_store_uris(spark: SparkSession, sf: str) -> DataFrame:
    stored = _refs(spark, sf).where(names.is_object_store(F.col("namespace")))
    uri = names.object_store_uri(F.col("namespace"), F.col("name"))
    return _distinct(stored, "namespace", "name").withColumn("uri", uri)


@query
def db_name_from_url(spark: SparkSession, sf: str) -> DataFrame:
    return _distinct(_refs(spark, sf), "namespace").withColumn(
        "database", names.database_from_url(F.col("namespace"))
    )


@query
def symlink_names(spark: SparkSession, sf: str) -> DataFrame:
    links = _refs(spark, sf).where(F.col("symlinks").isNotNull())
    return _distinct(links, names.symlink_name(F.col("symlinks")).alias("table_name"))


@query
def names_from_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return _distinct(_refs(spark, sf), "namespace", "name").withColumn(
        "table_name", names.name_from_dataset(F.col("namespace"), F.col("name"))
    )


@query
def dataset_names(spark: SparkSession, sf: str) -> DataFrame:
    return _distinct(events.with_names(_refs(spark, sf)), "namespace", "name", "table_name")


@query
def lookup_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = names.lookup_key(F.col("table_name"))
    scoped = names.lookup_key(F.col("table_name"), F.lit(service_list(SERVICES)[0]))
    return _names(spark, sf).select(
        "table_name", key["index"].alias("index_name"), key["field"].alias("field"),
        key["value"].alias("value"), scoped["value"].alias("scoped_value"),
    )


@query
def service_lists(spark: SparkSession, sf: str) -> DataFrame:
    services = names.split_services(F.col("value"))
    return (
        fixtures.conf(spark, sf)
        .where(F.col("key").endswith("databaseServiceNames"))
        .select("app_id", "value", F.array_join(services, "|").alias("services"),
                F.size(services).cast("bigint").alias("n_services"))
    )


@query
def edge_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Current edges of the nested events, stamped with the job of their run."""
    found = edges.column_edges(
        fixtures.nested_events(spark, sf), _index(spark, sf), fixtures.catalog(spark, sf)
    ).withColumn("columns", edges.column_set(F.col("column_pairs")))
    current = edges.upsert(found.drop("column_pairs", "from_name", "to_name"))
    keyed = current.withColumn("job_key", F.col("run_id") % 997)
    return jobs.edge_documents(jobs.stamp_jobs(keyed, fixtures.job_entities(spark, sf)))


@query
def job_entity_documents(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.job_documents(fixtures.job_entities(spark, sf))


@query
def service_documents(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.service_documents(fixtures.job_entities(spark, sf))


@query
def jobs_from_settings(spark: SparkSession, sf: str) -> DataFrame:
    """The job that each application's settings name, its document, and its id where the catalog lists it."""
    rows = conf.jobs(fixtures.pipeline_conf(spark, sf))
    known = jobs.with_ids(rows, fixtures.job_entities(spark, sf))
    return known.select("app_id", "name", "service", "job_id", jobs.document_of().alias("document"))


@query
def services_from_settings(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.service_documents(conf.jobs(fixtures.pipeline_conf(spark, sf)))


@query
def edges_of_applications(spark: SparkSession, sf: str) -> DataFrame:
    """Current edges with the job that their application's settings name."""
    app = F.floor(F.col("run_id") / 8).cast("bigint").alias("job_key")
    gated = _gated(spark, sf).select("event_id", "event_time", app)
    current = edges.upsert(edges.table_edges(gated, _refs(spark, sf), _index(spark, sf)).drop("n_pairs"))
    known = jobs.with_ids(conf.jobs(fixtures.pipeline_conf(spark, sf)), fixtures.job_entities(spark, sf))
    return jobs.stamp_jobs(current, known.withColumnRenamed("app_id", "job_key")).select(
        "from_type", "from_id", "to_type", "to_id", "job_key", "job_id")


@query
def conf_paths(spark: SparkSession, sf: str) -> DataFrame:
    path = settings.setting_path(F.col("key"))
    return conf.section_settings(fixtures.conf(spark, sf)).select(
        "app_id", "key", F.array_join(path, "/").alias("path"), F.size(path).cast("bigint").alias("depth")
    )


@query
def conf_list_values(spark: SparkSession, sf: str) -> DataFrame:
    items = settings.list_items(F.col("key"), F.col("value"))
    return (
        conf.section_settings(conf.with_defaults(fixtures.conf(spark, sf)))
        .where(items.isNotNull())
        .select("app_id", "key", F.array_join(items, "|").alias("items"),
                F.size(items).cast("bigint").alias("n_items"))
    )


# Pairs, lookups and edges of the long form


@query
def input_output_pairs(spark: SparkSession, sf: str) -> DataFrame:
    sides = events.collapse(_named(spark, sf))
    pairs = events.pair_sides(_gated(spark, sf).select("event_id"), sides)
    return pairs.select(
        "event_id", F.col("in_table_name").alias("in_name"), F.col("out_table_name").alias("out_name"),
        "n_pairs",
    )


@query
def table_lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return edges.table_edges(
        _gated(spark, sf).select("event_id"), _refs(spark, sf), _index(spark, sf)
    ).select(
        "event_id", "from_type", "from_id", "from_name", "to_type", "to_id", "to_name", "n_pairs",
        F.lit(documents.EDGE_SOURCE).alias("source"),
    )


@query
def edges_upserted(spark: SparkSession, sf: str) -> DataFrame:
    found = edges.table_edges(
        _gated(spark, sf).select("event_id", "event_time"), _refs(spark, sf), _index(spark, sf)
    )
    return edges.upsert(found.drop("n_pairs"))


@query
def resolve_by_suffix(spark: SparkSession, sf: str) -> DataFrame:
    keys = lookup.table_keys(fixtures.catalog(spark, sf))
    return lookup.hits(_names(spark, sf).select("table_name"), keys).select("table_name", "id", "fqn")


@query
def resolve_in_service(spark: SparkSession, sf: str) -> DataFrame:
    keys = lookup.table_keys(fixtures.catalog(spark, sf), service_list(SERVICES)[:1])
    return lookup.hits(_names(spark, sf).select("table_name"), keys).select("table_name", "id", "fqn")


@query
def resolve_containers(spark: SparkSession, sf: str) -> DataFrame:
    keys = lookup.container_keys(fixtures.catalog(spark, sf))
    return lookup.hits(_names(spark, sf).select("table_name"), keys).select("table_name", "id", "fqn")


def _resolved(spark: SparkSession, sf: str, services: list[str]) -> DataFrame:
    asked = _names(spark, sf)
    found = lookup.first_hits(asked, lookup.lookup_index(fixtures.catalog(spark, sf), services, asked))
    return found.select("table_name", "entity_type", "id", "fqn")


@query
def resolve_first_service(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf, lookup.first_service(service_list(SERVICES)))


@query
def resolve_service_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf, service_list(SERVICES))


@query
def resolve_per_application(spark: SparkSession, sf: str) -> DataFrame:
    """Every application's names within its own list of services, the next ones asked after a miss."""
    app = F.floor(F.col("run_id") / 8).cast("bigint").alias("app_id")
    apps = fixtures.run_events(spark, sf).select("event_id", app)
    asked = _named(spark, sf).select("event_id", "table_name").join(apps, "event_id").select("app_id", "table_name").distinct()
    listed = conf.service_lists(fixtures.conf(spark, sf))
    return lookup.resolve_per_application(asked, listed, fixtures.catalog(spark, sf), first_only=False)


@query
def unresolved_datasets(spark: SparkSession, sf: str) -> DataFrame:
    asked = _names(spark, sf)
    return lookup.unresolved(asked, lookup.lookup_index(fixtures.catalog(spark, sf), names=asked)).select(
        "table_name", F.col("n").alias("n_refs")
    )


@query
def lookup_hit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.hit_counts(_names(spark, sf), lookup.search_keys(fixtures.catalog(spark, sf)))


@query
def lookup_candidates(spark: SparkSession, sf: str) -> DataFrame:
    found = lookup.candidates(_names(spark, sf), lookup.search_keys(fixtures.catalog(spark, sf)))
    return found.select("table_name", F.col("place").cast("bigint").alias("place"), "id", "fqn")


@query
def lookup_candidate_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of names that end a tenth of the catalog: the number of a referred part, by its last digit."""
    last = F.right(F.regexp_extract("table_name", "[0-9]+$", 0), F.lit(1))
    asked = _named(spark, sf).select(last.alias("table_name")).distinct()
    found = lookup.candidates(asked, lookup.search_keys(fixtures.catalog(spark, sf)))
    return found.select("table_name", F.col("place").cast("bigint").alias("place"), "id", "fqn")


@query
def lookup_first_hit(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf, [])


# Columns, over the nested events


def _column_edges(spark: SparkSession, sf: str) -> DataFrame:
    return edges.column_edges(
        fixtures.nested_events(spark, sf), _index(spark, sf), fixtures.catalog(spark, sf)
    )


@query
def column_lineage_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return edges.column_rows(_column_edges(spark, sf), ["event_id", "in_pos", "out_pos", "from_id", "to_id"])


@query
def column_lineage_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return edges.column_rows(_column_edges(spark, sf), ["from_id", "to_id"]).distinct()


def column_text(columns: Column) -> Column:
    return F.array_join(
        F.transform(columns, lambda p: F.concat(p["fromColumns"][0], F.lit("->"), p["toColumn"])), ","
    )


@query
def columns_per_edge(spark: SparkSession, sf: str) -> DataFrame:
    columns = edges.column_set(F.col("column_pairs"))
    return _column_edges(spark, sf).select(
        "event_id", "in_pos", "out_pos", "from_id", "to_id",
        column_text(columns).alias("columns"), F.size(columns).cast("bigint").alias("n_columns"),
    )


# Execution records


@query
def sql_execution_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return executions.pair_executions(fixtures.sql_starts(spark, sf), fixtures.sql_ends(spark, sf))


@query
def job_context(spark: SparkSession, sf: str) -> DataFrame:
    return executions.job_context(fixtures.job_starts(spark, sf))


@query
def metrics_per_job(spark: SparkSession, sf: str) -> DataFrame:
    return executions.metrics_per_job(fixtures.job_starts(spark, sf), fixtures.task_ends(spark, sf))


@query
def metrics_per_execution(spark: SparkSession, sf: str) -> DataFrame:
    return executions.metrics_per_execution(fixtures.job_starts(spark, sf), fixtures.task_ends(spark, sf))


@query
def job_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return executions.pair_jobs(fixtures.job_starts(spark, sf), fixtures.job_ends(spark, sf))


# Settings


@query
def conf_with_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return conf.with_defaults(fixtures.conf(spark, sf))


@query
def conf_overrides(spark: SparkSession, sf: str) -> DataFrame:
    return conf.overrides(fixtures.conf(spark, sf))


@query
def conf_tree(spark: SparkSession, sf: str) -> DataFrame:
    return conf.tree(fixtures.conf(spark, sf)).select(
        "app_id", F.array_join("path", "/").alias("path"), "value",
        F.array_join("items", "|").alias("items"), "conflict",
    )


# Streams: each runs over all input there is and stops


def _run_edge_stream(spark: SparkSession, sf: str) -> str:
    base = scratch_folder(spark, "edge-stream")
    lookup.lookup_index(fixtures.catalog(spark, sf)).write.parquet(f"{base}/index")
    fixtures.catalog(spark, sf).write.parquet(f"{base}/catalog")
    start_edges(
        fixtures.nested_event_stream(spark, sf),
        spark.read.parquet(f"{base}/index"),
        spark.read.parquet(f"{base}/catalog"),
        f"{base}/edges", f"{base}/rejects", f"{base}/checkpoint",
    ).awaitTermination()
    return base


@query
def stream_edges(spark: SparkSession, sf: str) -> DataFrame:
    base = _run_edge_stream(spark, sf)
    compact_edges(spark, f"{base}/current", f"{base}/edges")
    return read_edges(spark, f"{base}/current").select(
        "from_type", "from_id", "to_type", "to_id", _naive("event_time"), "event_id", "in_pos", "out_pos",
        column_text(F.col("columns")).alias("columns"),
    )


@query
def stream_edge_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same edges in a table under a manifest, each batch resolved with the newest catalog there is."""
    base = scratch_folder(spark, "edge-table")
    edge_table.publish_catalog(fixtures.catalog(spark, sf), f"{base}/catalog")
    start_table_edges(
        fixtures.nested_event_stream(spark, sf), f"{base}/catalog", f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", "first"
    ).awaitTermination()
    edge_table.compact_table(spark, f"{base}/table")
    return edge_table.current_table(spark, f"{base}/table").select(
        "from_type", "from_id", "to_type", "to_id", _naive("event_time"), "event_id", "in_pos", "out_pos",
        column_text(F.col("columns")).alias("columns"),
    )


@query
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_folder(spark, "reject-stream")
    start_rejects(
        fixtures.nested_event_stream(spark, sf), f"{base}/rejects", f"{base}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/rejects").select("event_id", "event_type", "reason")


@query
def stream_execution_pairs(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_folder(spark, "execution-stream")
    sides = {
        "starts": (fixtures.sql_starts(spark, sf), -1),
        "ends": (fixtures.sql_ends(spark, sf), -2),
    }
    streams = {}
    for side, (records, closing_id) in sides.items():
        records = records.select("app_id", "execution_id", F.col("ts").cast("timestamp").alias("ts"))
        records.unionByName(closing_row(spark, CLOSE, closing_id, app_id=-1)).write.parquet(f"{base}/{side}")
        streams[side] = spark.readStream.schema(records.schema).parquet(f"{base}/{side}")
    pairs = pair_execution_streams(streams["starts"], streams["ends"], BOUND, CLOSE, delay="0 seconds")
    pairs.writeStream.format("parquet").option("path", f"{base}/pairs").option(
        "checkpointLocation", f"{base}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/pairs").select(
        "app_id", "execution_id", _naive("start_ts"), _naive("end_ts"), "had_start"
    )
