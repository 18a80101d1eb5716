"""Lineage inputs derived from the star schema by fixed arithmetic.

Orders are run events, line items are dataset references, parts are catalogued tables and containers,
customers are settings, suppliers are the jobs that catalogs list. Each derivation is row by row
except where it says so. The texts are portable SQL used by both engines; only the nested forms are
written twice, as arrays here and as plain rows in the SQL.

``part % 6`` picks the naming case: 0 bare name and a database in the URL, 1 dotted name, 2 object
store, 3 bare name and a URL without match, 4 symlink to a table, 5 symlink to an object store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.settings import PREFIX

EVENT_COLUMNS = {
    "event_id": "o_orderkey",
    "event_type": (
        "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderstatus = 'O' THEN 'START'"
        " WHEN o_orderkey % 3 = 0 THEN 'FAIL' WHEN o_orderkey % 3 = 1 THEN 'RUNNING' END"
    ),
    "event_time": "o_orderdate",
    "run_id": "o_custkey",
}


def dataset_columns(part: str, source: str) -> dict[str, str]:
    """SQL of the four text columns of a dataset, given the SQL of its two numbers."""
    return {
        "namespace": (
            f"CASE {part} % 6 WHEN 0 THEN 'mysql://db' || {source} % 4 || '.example:3306/sales?useSSL=false'"
            f" WHEN 1 THEN 'redshift://db' || {source} % 4 || '.example:5439/warehouse'"
            f" WHEN 2 THEN 's3a://bucket'"
            f" WHEN 3 THEN 'jdbc:mysql://db' || {source} % 4 || '.example:3306/crm'"
            f" ELSE 'file' END"
        ),
        "name": (
            f"CASE WHEN {source} % 50 = 7 AND {part} % 6 < 4 THEN NULL"
            f" WHEN {part} % 6 IN (0, 3) THEN 'part_' || {part}"
            f" WHEN {part} % 6 = 1 THEN 'public.part_' || {part}"
            f" WHEN {part} % 6 = 2 THEN '/part/' || {part}"
            f" ELSE '/warehouse/part_' || {part} END"
        ),
        "sym_namespace": f"CASE {part} % 6 WHEN 4 THEN 'hive://metastore:9083' WHEN 5 THEN 's3a://lake' END",
        "sym_name": (
            f"CASE {part} % 6 WHEN 4 THEN 'sales.part_' || {part} WHEN 5 THEN '/part/' || {part} END"
        ),
    }


REF_COLUMNS = {
    "event_id": "l_orderkey",
    "side": "CASE WHEN l_linenumber % 3 = 0 THEN 'output' ELSE 'input' END",
    "pos": "CAST(l_linenumber AS BIGINT)",
    **dataset_columns("l_partkey", "l_suppkey"),
}

# A part is in up to two services; s is the service's number.
CATALOG_COLUMNS = {
    "id": "'e' || p_partkey || '_' || s",
    "entity_type": "CASE WHEN p_partkey % 6 IN (2, 5) THEN 'container' ELSE 'table' END",
    "fqn": (
        "CASE p_partkey % 6"
        " WHEN 0 THEN 'svc' || s || '.default.sales.part_' || p_partkey"
        " WHEN 1 THEN 'svc' || s || '.warehouse.public.part_' || p_partkey"
        " WHEN 2 THEN 'obj' || s || '.bucket.part_' || p_partkey"
        " WHEN 3 THEN 'svc' || s || '.default.crm.' || CASE WHEN p_partkey % 4 = 3 THEN 'old_' ELSE '' END"
        " || 'part_' || p_partkey"
        " WHEN 4 THEN 'svc' || s || '.default.sales.part_' || p_partkey"
        " ELSE 'obj' || s || '.lake.part_' || p_partkey END"
    ),
    "full_path": (
        "CASE p_partkey % 6 WHEN 2 THEN 's3://bucket/part/' || p_partkey"
        " WHEN 5 THEN 's3://lake/part/' || p_partkey END"
    ),
}
CATALOG_FILTER = (
    "p_partkey % 11 <> 0 AND ((s = 0 AND p_partkey % 7 <> 3) OR (s = 1 AND p_partkey % 5 = 0))"
)

CONF_COLUMNS = {
    "app_id": "CAST(floor(c_custkey / 8) AS BIGINT)",
    "key": (
        f"CASE c_custkey % 8 WHEN 0 THEN '{PREFIX}transport.type'"
        f" WHEN 1 THEN '{PREFIX}transport.pipelineName'"
        f" WHEN 2 THEN '{PREFIX}facets.disabled'"
        f" WHEN 3 THEN '{PREFIX}transport.headers.x.y'"
        f" WHEN 4 THEN '{PREFIX}namespace'"
        f" WHEN 5 THEN '{PREFIX}appName'"
        f" WHEN 6 THEN '{PREFIX}transport.databaseServiceNames'"
        f" ELSE CASE WHEN c_custkey % 3 = 0 THEN '{PREFIX}transport.type.x' ELSE '{PREFIX}facets.x.list' END END"
    ),
    "value": (
        "CASE c_custkey % 8"
        " WHEN 1 THEN CASE WHEN c_custkey % 16 = 1 THEN ' ' ELSE c_name END"
        " WHEN 2 THEN CASE WHEN c_custkey % 16 = 2 THEN '[spark_unknown]'"
        " ELSE '[spark_unknown;spark.logicalPlan]' END"
        " WHEN 5 THEN CASE WHEN c_custkey % 16 = 5 THEN '' ELSE c_name END"
        " WHEN 6 THEN 'svc0,svc' || c_custkey % 3 || ','"
        " WHEN 7 THEN '[a;;b]' ELSE c_mktsegment END"
    ),
}
CONF_FILTER = "c_custkey % 5 <> 0"

# Settings that name an application's job: four keys per application, from its first customer.
PIPELINE_CONF = {
    "pipelineName": "CASE WHEN c_custkey % 48 <> 16 THEN 'Supplier#' || lpad(CAST(CAST(floor(c_custkey / 8) AS BIGINT) AS STRING), 9, '0') END",
    "pipelineServiceName": "CASE WHEN c_custkey % 56 <> 0 THEN 'spark_' || c_nationkey END",
    "pipelineSourceUrl": "CASE WHEN c_custkey % 24 <> 0 THEN 'http://runs.example/' || c_custkey END",
    "pipelineDescription": "CASE c_custkey % 32 WHEN 0 THEN c_name WHEN 8 THEN ' ' END",
}
PIPELINE_CONF_FILTER = "c_custkey % 8 = 0 AND c_custkey % 5 <> 0"

# Three applications with the same ids of jobs, stages and executions.
APPS = 3
TASK_COLUMNS = {
    "app_id": f"l_orderkey % {APPS}",
    "stage_id": f"CAST(floor(l_orderkey / {APPS}) AS BIGINT) * 8 + l_linenumber",
    "records": "CAST(l_quantity AS BIGINT)",
}
JOB_APP, JOB_ID = f"o_orderkey % {APPS}", f"CAST(floor(o_orderkey / {APPS}) AS BIGINT)"
EXECUTION_APP, EXECUTION_ID = f"o_custkey % {APPS}", f"CAST(floor(o_custkey / {APPS}) AS BIGINT)"
STAGES = [f"{JOB_ID} * 8 + {i}" for i in range(1, 7)]

JOB_ENTITY_COLUMNS = {
    "name": "s_name",
    "source_url": "CASE WHEN s_suppkey % 3 <> 0 THEN 'http://runs.example/' || s_suppkey END",
    "description": "CASE s_suppkey % 4 WHEN 0 THEN 'nightly ' || s_suppkey WHEN 1 THEN '' END",
    "service": "'spark_' || s_nationkey",
}

# Numbers of the nested events: datasets per side and the part and source each stands for.
INPUT_COUNT = "o_orderkey % 4"
OUTPUT_COUNT = "o_orderkey % 3"
INPUT_PART = "(o_custkey + CASE WHEN {k} = 2 AND o_orderkey % 5 = 0 THEN 0 ELSE 11 * {k} END)"
OUTPUT_PART = "(o_custkey + 3 + 5 * {k})"
NESTED_SOURCE = "(o_orderkey % 100)"
NO_INPUT_LIST = "o_orderkey % 41 = 0"
NO_OUTPUT_LIST = "o_orderkey % 43 = 0"
BROKEN_SYMLINK = "o_orderkey % 13 = 0 AND {part} % 6 = 4"
HAS_FACET = "(o_orderkey + {k}) % 2 = 0 AND o_orderkey % 4 > 0"


def _columns(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def _built_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project inside a generator: filters and names computed from the columns then read them, instead
    of pulling their long texts down and evaluating them again."""
    return df.selectExpr(f"inline(array(struct({', '.join(columns)})))")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def run_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*_columns(EVENT_COLUMNS))


def dataset_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Long form of the datasets of ``run_events``."""
    flat = _built_once(table(spark, sf, "lineitem"), _columns(REF_COLUMNS))
    link = F.struct(F.col("sym_namespace").alias("namespace"), F.col("sym_name").alias("name"))
    return flat.withColumn("symlinks", F.when(F.col("sym_namespace").isNotNull(), F.array(link))).drop(
        "sym_namespace", "sym_name"
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part")
        .select("p_partkey", "p_size", F.explode(F.array(F.lit(0), F.lit(1))).alias("s"))
        .where(CATALOG_FILTER)
        .selectExpr(*_columns(CATALOG_COLUMNS), "array('k', 'v', 'c' || p_size % 5) AS column_names")
    )


def search_replies(spark: SparkSession, sf: str) -> DataFrame:
    source = F.struct(
        "id",
        F.col("entity_type").alias("entityType"),
        F.col("fqn").alias("fullyQualifiedName"),
        F.array(F.lit("k"), F.lit("v")).alias("columnNames"),
    )
    found = F.struct(F.lit(1).alias("value"))
    hit = F.struct(source.alias("_source"))
    body = F.struct(F.struct(found.alias("total"), F.array(hit).alias("hits")).alias("hits"))
    return catalog(spark, sf).select(
        F.col("id").alias("reply_id"),
        F.when(F.col("id").like("%3\\_0"), "")
        .when(F.col("id").like("%4\\_0"), '{"hits":{"total":{"value":0},"hits":[]}}')
        .otherwise(F.to_json(body))
        .alias("body"),
    )


def conf(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").where(CONF_FILTER).selectExpr(*_columns(CONF_COLUMNS))


def pipeline_conf(spark: SparkSession, sf: str) -> DataFrame:
    """The settings of ``conf``'s applications that name their jobs, null where one is left out."""
    pairs = ", ".join(f"named_struct('key', '{PREFIX}transport.{key}', 'value', {text})" for key, text in PIPELINE_CONF.items())
    rows = table(spark, sf, "customer").where(PIPELINE_CONF_FILTER)
    found = rows.selectExpr("CAST(floor(c_custkey / 8) AS BIGINT) AS app_id", f"inline(array({pairs}))")
    return found.where("value IS NOT NULL")


def job_starts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        f"{JOB_APP} AS app_id",
        f"{JOB_ID} AS job_id",
        f"CASE WHEN o_orderstatus = 'F' THEN {EXECUTION_ID} END AS execution_id",
        f"array({', '.join(STAGES)}) AS stage_ids",
        "o_orderdate AS ts",
    )


def job_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs end a day after their start; some have no end, and some ends no start."""
    return table(spark, sf, "orders").where("o_orderkey % 11 <> 0").selectExpr(
        f"{JOB_APP} AS app_id",
        f"CASE WHEN o_orderkey % 13 = 0 THEN -1 - {JOB_ID} ELSE {JOB_ID} END AS job_id",
        "o_orderdate + INTERVAL 1 DAY AS ts",
    )


def sql_starts(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregated: first order of a customer."""
    orders = table(spark, sf, "orders").where("o_custkey % 7 <> 0")
    return orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("ts")).selectExpr(
        f"{EXECUTION_APP} AS app_id", f"{EXECUTION_ID} AS execution_id", "ts"
    )


def sql_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregated: last order of a customer."""
    orders = table(spark, sf, "orders").where("o_custkey % 5 <> 0")
    return orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("ts")).selectExpr(
        f"{EXECUTION_APP} AS app_id", f"{EXECUTION_ID} AS execution_id", "ts"
    )


def task_ends(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*_columns(TASK_COLUMNS))


def job_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs as the catalog lists them; ``run_id % 997`` of an event picks its job, if there is one."""
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS job_key", "'j' || s_suppkey AS job_id", *_columns(JOB_ENTITY_COLUMNS)
    )


def event_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Event log text with the application of each line: SQL executions and jobs from orders, tasks from line
    items, settings from customers, and lines of no use."""
    ui = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
    millis = "unix_millis(CAST(o_orderdate AS TIMESTAMP))"
    sql = "to_json(named_struct('Event', '{ui}{what}', 'executionId', o_orderkey, 'time', {millis}))"
    job = (
        f"to_json(named_struct('Event', 'SparkListenerJobStart', 'Job ID', {JOB_ID}, 'Submission Time', {millis},"
        f" 'Stage IDs', array({', '.join(STAGES)}), 'Properties', CASE WHEN o_orderstatus = 'F'"
        f" THEN map('spark.sql.execution.id', CAST({EXECUTION_ID} AS STRING), 'spark.job.id', 'x')"
        " ELSE map('spark.job.id', 'x') END))"
    )
    job_end = f"to_json(named_struct('Event', 'SparkListenerJobEnd', 'Job ID', {JOB_ID}, 'Completion Time', {millis} + 1000))"
    start = sql.format(ui=ui, what="Start", millis=millis)
    end = sql.format(ui=ui, what="End", millis=millis)
    of_orders = (
        f"array(CASE WHEN o_custkey % 7 <> 0 THEN {start} END, CASE WHEN o_custkey % 5 <> 0 THEN {end} END,"
        f" {job}, {job_end}, CASE WHEN o_orderkey % 100 = 0 THEN 'cut off {{' END)"
    )
    task = (
        f"to_json(named_struct('Event', 'SparkListenerTaskEnd', 'Stage ID', {TASK_COLUMNS['stage_id']},"
        " 'Task Metrics', named_struct('Executor Run Time', l_linenumber,"
        " 'Input Metrics', named_struct('Bytes Read', l_partkey, 'Records Read', CAST(l_quantity AS BIGINT)))))"
    )
    environment = "to_json(named_struct('Event', 'SparkListenerEnvironmentUpdate', 'Spark Properties', map(key, value)))"
    orders = table(spark, sf, "orders").selectExpr(f"CAST({JOB_APP} AS STRING) AS app_id", f"explode({of_orders}) AS value")
    tasks = _built_once(table(spark, sf, "lineitem"), [f"CAST({TASK_COLUMNS['app_id']} AS STRING) AS app_id", f"{task} AS value"])
    settings = _built_once(conf(spark, sf), ["CAST(app_id AS STRING) AS app_id", f"{environment} AS value"])
    return orders.where("value IS NOT NULL").unionByName(tasks).unionByName(settings)


def _nested_dataset(part: str, facet: str) -> str:
    c = dataset_columns(part, NESTED_SOURCE)
    link_namespace = f"CASE WHEN {BROKEN_SYMLINK.format(part=part)} THEN NULL ELSE {c['sym_namespace']} END"
    links = (
        f"CASE WHEN {part} % 6 IN (4, 5) THEN array("
        f"named_struct('namespace', {link_namespace}, 'name', {c['sym_name']}),"
        f" named_struct('namespace', 's3://other', 'name', '/not/used')) END"
    )
    return (
        f"named_struct('namespace', {c['namespace']}, 'name', {c['name']}, 'symlinks', {links},"
        f" 'column_lineage', {facet})"
    )


def _facet(k: str) -> str:
    """Column facet of output ``k``: draws on the first and the last input."""

    def field(which: str, column: str) -> str:
        return f"named_struct('namespace', {which}.namespace, 'name', {which}.name, 'field', '{column}')"

    return (
        f"CASE WHEN {HAS_FACET.format(k=k)} THEN map("
        f"'k', array({field('first', 'k')}, {field('last', 'c0')}, {field('first', 'k')}),"
        f" 'v', array({field('first', 'c0')}), 'zz', array({field('first', 'k')})) END"
    )


def _documents(orders: DataFrame) -> DataFrame:
    """Run events from orders alone, whole documents built in their own row."""
    no_facet = "CAST(NULL AS MAP<STRING, ARRAY<STRUCT<namespace: STRING, name: STRING, field: STRING>>>)"

    def side(count: str, part: str, missing: str, facet: str) -> str:
        numbers = f"slice(array(0, 1, 2), 1, CAST({count} AS INT))"
        datasets = f"transform({numbers}, k -> {_nested_dataset(part.format(k='k'), facet)})"
        return f"CASE WHEN {missing} THEN NULL ELSE {datasets} END"

    columns = {
        **EVENT_COLUMNS,
        "event_time": "CAST(o_orderdate AS TIMESTAMP)",
        "inputs": side(INPUT_COUNT, INPUT_PART, NO_INPUT_LIST, no_facet),
        "outputs": side(OUTPUT_COUNT, OUTPUT_PART, NO_OUTPUT_LIST, _facet("k")),
    }
    ends = {"first": INPUT_PART.format(k="0"), "last": INPUT_PART.format(k=f"({INPUT_COUNT} - 1)")}
    named = [
        f"named_struct('namespace', {c['namespace']}, 'name', {c['name']}) AS {end}"
        for end, part in ends.items()
        for c in [dataset_columns(part, NESTED_SOURCE)]
    ]
    return _built_once(orders.selectExpr("*", *named), _columns(columns))


def nested_events(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(table(spark, sf, "orders"))


def event_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The nested events as texts in the producers' own form."""
    events = nested_events(spark, sf)

    def written(side: str) -> Column:
        return F.transform(side, lambda d: F.struct(
            d["namespace"].alias("namespace"), d["name"].alias("name"),
            F.struct(
                F.when(d["symlinks"].isNotNull(), F.struct(d["symlinks"].alias("identifiers"))).alias("symlinks"),
                F.when(d["column_lineage"].isNotNull(), F.struct(
                    F.transform_values(d["column_lineage"], lambda _, f: F.struct(f.alias("inputFields"))).alias("fields")
                )).alias("columnLineage"),
            ).alias("facets"),
        ))

    document = F.struct(
        F.col("event_type").alias("eventType"), F.col("event_time").alias("eventTime"), F.lit("producer").alias("producer"),
        F.struct(F.concat(F.lit("run-"), F.col("event_id")).alias("runId")).alias("run"),
        written("inputs").alias("inputs"), written("outputs").alias("outputs"),
    )
    return events.select(F.to_json(document).alias("value"))


def nested_event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same documents, read as a stream of order files. The path is a pattern because a stream
    takes a single file only that way; it matches a folder of files just as well."""
    schema = table(spark, sf, "orders").schema
    orders = spark.readStream.schema(schema).parquet(f"{sf}/{{orders}}.parquet")
    return _documents(orders)
