"""The same results in plain SQL on the same tables, written without the library's rewrites: suffix
lookups compare every name with every entry, and the long form is paired by a plain join."""

from __future__ import annotations

from tributary.functions.names import DATABASE_IN_URL
from tributary.operators.settings import PREFIX
from tributary.plans import fixtures as fx


def _select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {source}"


def _is_store(column: str) -> str:
    return f"(starts_with({column}, 's3a://') OR starts_with({column}, 's3://'))"


def _uri(namespace: str, name: str) -> str:
    return f"replace({namespace}, 's3a://', 's3://') || {name}"


DATABASE = f"nullif(regexp_extract(namespace, '{DATABASE_IN_URL}', 1), '')"
SYMLINK_NAME = (
    f"CASE WHEN {_is_store('sym_namespace')} THEN {_uri('sym_namespace', 'sym_name')} ELSE sym_name END"
)
DATASET_ONLY_NAME = (
    f"CASE WHEN namespace IS NULL OR name IS NULL THEN NULL"
    f" WHEN {_is_store('namespace')} THEN {_uri('namespace', 'name')}"
    f" WHEN NOT contains(name, '.') AND {DATABASE} IS NOT NULL THEN {DATABASE} || '.' || name"
    f" ELSE name END"
)
TABLE_NAME = f"coalesce({SYMLINK_NAME}, {DATASET_ONLY_NAME})"

NOT_BLANK = r"regexp_matches({}, '\S')"


def _nested_side(side: str, count: str, part: str, missing: str) -> str:
    """Rows of one side of the nested events, by position; ``k`` counts from 0."""
    p = part.format(k="k")
    c = fx.dataset_columns(p, fx.NESTED_SOURCE)
    broken = fx.BROKEN_SYMLINK.format(part=p)
    return (
        f"SELECT o_orderkey AS event_id, '{side}' AS side, k + 1 AS pos, k,"
        f" {c['namespace']} AS namespace, {c['name']} AS name,"
        f" CASE WHEN {broken} THEN NULL ELSE {c['sym_namespace']} END AS sym_namespace,"
        f" {c['sym_name']} AS sym_name, {p} % 6 IN (4, 5) AS has_link"
        f" FROM orders JOIN (VALUES (CAST(0 AS BIGINT)), (1), (2)) t(k) ON k < {count} AND NOT ({missing})"
    )


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "run_event": ((), _select(fx.EVENT_COLUMNS, "orders")),
    "ref": ((), _select(fx.REF_COLUMNS, "lineitem")),
    "named": (("ref",), f"SELECT * FROM (SELECT *, {TABLE_NAME} AS table_name FROM ref) WHERE table_name IS NOT NULL"),
    "names": (("named",), "SELECT table_name, count(*) AS n FROM named GROUP BY table_name"),
    "catalog": (
        (),
        _select(
            {**fx.CATALOG_COLUMNS, "column_names": "list_value('k', 'v', 'c' || p_size % 5)"},
            f"part, (VALUES (0), (1)) t(s) WHERE {fx.CATALOG_FILTER}",
        ),
    ),
    "conf": ((), _select(fx.CONF_COLUMNS, f"customer WHERE {fx.CONF_FILTER}")),
    "conf_all": (
        ("conf",),
        "SELECT * FROM conf UNION ALL"
        " SELECT app_id, d.key, d.value FROM (SELECT DISTINCT app_id FROM conf) a,"
        f" (VALUES ('{PREFIX}facets.disabled', '[spark_unknown;spark.logicalPlan]'),"
        f" ('{PREFIX}transport.type', 'console')) d(key, value)"
        " WHERE NOT EXISTS (SELECT 1 FROM conf c WHERE c.app_id = a.app_id AND c.key = d.key)",
    ),
    # Every hit of every name; containers by path, tables by the end of their FQN.
    "hit": (
        ("names", "catalog"),
        "SELECT n.table_name, c.entity_type, c.id, c.fqn FROM names n JOIN catalog c ON"
        f" CASE WHEN {_is_store('n.table_name')} THEN c.entity_type = 'container' AND c.full_path = n.table_name"
        " ELSE c.entity_type = 'table' AND ends_with(c.fqn, n.table_name) END",
    ),
    "ranked": (
        ("hit",),
        "SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY length(fqn), fqn, id) AS place FROM hit",
    ),
    "resolved": (("ranked",), "SELECT table_name, entity_type, id, fqn FROM ranked WHERE place = 1"),
    "gated": (("run_event",), "SELECT * FROM run_event WHERE event_type IN ('COMPLETE', 'START')"),
    "pair": (
        ("gated", "named"),
        "SELECT g.event_id, g.event_time, i.table_name AS from_name, i.pos AS in_pos,"
        " o.table_name AS to_name, o.pos AS out_pos"
        " FROM gated g JOIN named i ON i.event_id = g.event_id AND i.side = 'input'"
        " JOIN named o ON o.event_id = g.event_id AND o.side = 'output'",
    ),
    "edge": (
        ("pair", "resolved"),
        "SELECT p.*, f.entity_type AS from_type, f.id AS from_id, t.entity_type AS to_type, t.id AS to_id"
        " FROM pair p JOIN resolved f ON f.table_name = p.from_name JOIN resolved t ON t.table_name = p.to_name",
    ),
    "nested": (
        (),
        _nested_side("input", fx.INPUT_COUNT, fx.INPUT_PART, fx.NO_INPUT_LIST)
        + " UNION ALL "
        + _nested_side("output", fx.OUTPUT_COUNT, fx.OUTPUT_PART, fx.NO_OUTPUT_LIST),
    ),
    "nested_named": (("nested",), f"SELECT *, {TABLE_NAME} AS table_name FROM nested"),
    "nested_reason": (
        ("run_event", "nested_named"),
        "SELECT e.*, CASE WHEN event_type IS NULL THEN 'null_type'"
        f" WHEN {fx.NO_INPUT_LIST.replace('o_orderkey', 'e.event_id')} THEN 'null_inputs'"
        f" WHEN {fx.NO_OUTPUT_LIST.replace('o_orderkey', 'e.event_id')} THEN 'null_outputs'"
        " WHEN event_type IN ('COMPLETE', 'START') AND n_in > 0 AND n_out > 0"
        " AND (bad_in OR (bad_out AND any_name)) THEN 'null_symlink_namespace' END AS reason,"
        " coalesce(event_type IN ('COMPLETE', 'START') AND n_in > 0 AND n_out > 0, false) AS kept"
        " FROM run_event e LEFT JOIN (SELECT event_id,"
        " count(*) FILTER (side = 'input') AS n_in, count(*) FILTER (side = 'output') AS n_out,"
        " bool_or(side = 'input' AND has_link AND sym_namespace IS NULL) AS bad_in,"
        " bool_or(side = 'output' AND has_link AND sym_namespace IS NULL) AS bad_out,"
        " bool_or(side = 'input' AND table_name IS NOT NULL) AS any_name"
        " FROM nested_named GROUP BY event_id) d ON d.event_id = e.event_id",
    ),
    "nested_pair": (
        ("nested_named", "nested_reason"),
        "SELECT e.event_id, e.event_time, e.run_id, i.pos AS in_pos, o.pos AS out_pos, o.k AS out_k,"
        " i.name AS in_raw, i.table_name AS from_name, o.table_name AS to_name"
        " FROM nested_reason e"
        " JOIN nested_named i ON i.event_id = e.event_id AND i.side = 'input' AND i.table_name IS NOT NULL"
        " JOIN nested_named o ON o.event_id = e.event_id AND o.side = 'output' AND o.table_name IS NOT NULL"
        # Row by row: a pair is sent if no broken dataset was met before it.
        " WHERE e.kept AND NOT EXISTS (SELECT 1 FROM nested_named b WHERE b.event_id = e.event_id"
        " AND b.side = 'input' AND b.has_link AND b.sym_namespace IS NULL AND b.pos <= i.pos)"
        " AND NOT EXISTS (SELECT 1 FROM nested_named b WHERE b.event_id = e.event_id"
        " AND b.side = 'output' AND b.has_link AND b.sym_namespace IS NULL AND (b.pos <= o.pos"
        " OR EXISTS (SELECT 1 FROM nested_named f WHERE f.event_id = e.event_id AND f.side = 'input'"
        " AND f.table_name IS NOT NULL AND f.pos < i.pos)))",
    ),
    "nested_hit": (
        ("nested_pair", "catalog"),
        "SELECT n.table_name, c.*, row_number() OVER (PARTITION BY n.table_name"
        " ORDER BY length(c.fqn), c.fqn, c.id) AS place"
        " FROM (SELECT from_name AS table_name FROM nested_pair UNION SELECT to_name FROM nested_pair) n"
        " JOIN catalog c ON"
        f" CASE WHEN {_is_store('n.table_name')} THEN c.entity_type = 'container' AND c.full_path = n.table_name"
        " ELSE c.entity_type = 'table' AND ends_with(c.fqn, n.table_name) END",
    ),
    "nested_edge": (
        ("nested_pair", "nested_hit"),
        "SELECT p.*, f.entity_type AS from_type, f.id AS from_id, f.fqn AS from_fqn, f.column_names AS from_columns,"
        " t.entity_type AS to_type, t.id AS to_id, t.fqn AS to_fqn, t.column_names AS to_columns"
        " FROM nested_pair p JOIN nested_hit f ON f.table_name = p.from_name AND f.place = 1"
        " JOIN nested_hit t ON t.table_name = p.to_name AND t.place = 1",
    ),
    # Facet rows: output column k draws on first.k (twice) and last.c0, v on first.c0, zz on first.k.
    "facet": (
        ("nested",),
        "SELECT o.event_id, o.k AS out_k, m.out_column, i.name AS in_name, m.in_field"
        " FROM nested o JOIN (VALUES ('k', 'first', 'k'), ('k', 'last', 'c0'), ('k', 'first', 'k'),"
        " ('v', 'first', 'c0'), ('zz', 'first', 'k')) m(out_column, which, in_field) ON true"
        " JOIN nested i ON i.event_id = o.event_id AND i.side = 'input'"
        f" AND i.k = CASE m.which WHEN 'first' THEN 0 ELSE {fx.INPUT_COUNT.replace('o_orderkey', 'o.event_id')} - 1 END"
        f" WHERE o.side = 'output' AND {fx.HAS_FACET.format(k='o.k').replace('o_orderkey', 'o.event_id')}",
    ),
    "column_pair": (
        ("nested_edge", "facet"),
        "SELECT e.event_id, e.in_pos, e.out_pos, e.from_id, e.to_id,"
        " e.from_fqn || '.' || f.in_field AS from_column, e.to_fqn || '.' || f.out_column AS to_column"
        " FROM nested_edge e JOIN facet f ON f.event_id = e.event_id AND f.out_k = e.out_k"
        " AND f.in_name = e.in_raw"
        " WHERE list_contains(e.from_columns, f.in_field) AND list_contains(e.to_columns, f.out_column)",
    ),
    "column_text": (
        ("column_pair",),
        "SELECT event_id, in_pos, out_pos, count(*) AS n_columns,"
        " string_agg(from_column || '->' || to_column, ',' ORDER BY from_column, to_column) AS columns,"
        " string_agg('{\"fromColumns\":[\"' || from_column || '\"],\"toColumn\":\"' || to_column || '\"}', ','"
        " ORDER BY from_column, to_column) AS documents"
        " FROM (SELECT DISTINCT event_id, in_pos, out_pos, from_column, to_column FROM column_pair)"
        " GROUP BY event_id, in_pos, out_pos",
    ),
    "nested_current": (
        ("nested_edge", "column_text"),
        "SELECT * FROM (SELECT e.*, coalesce(c.columns, '') AS columns, coalesce(c.documents, '') AS documents,"
        " row_number() OVER (PARTITION BY from_type, from_id, to_type, to_id"
        " ORDER BY event_time DESC, e.event_id DESC, e.in_pos DESC, e.out_pos DESC) AS place"
        " FROM nested_edge e LEFT JOIN column_text c ON c.event_id = e.event_id AND c.in_pos = e.in_pos"
        " AND c.out_pos = e.out_pos) WHERE place = 1",
    ),
    "job_start": (
        (),
        "SELECT o_orderkey % 3 AS app_id, o_orderkey // 3 AS job_id, o_orderdate AS ts,"
        " CASE WHEN o_orderstatus = 'F' THEN o_custkey // 3 END AS execution_id,"
        f" list_value({', '.join(f'o_orderkey // 3 * 8 + {i}' for i in range(1, 7))}) AS stage_ids FROM orders",
    ),
    "sql_start": (
        (),
        "SELECT o_custkey % 3 AS app_id, o_custkey // 3 AS execution_id, min(o_orderdate) AS ts FROM orders WHERE o_custkey % 7 <> 0"
        " GROUP BY o_custkey",
    ),
    "sql_end": (
        (),
        "SELECT o_custkey % 3 AS app_id, o_custkey // 3 AS execution_id, max(o_orderdate) AS ts FROM orders WHERE o_custkey % 5 <> 0"
        " GROUP BY o_custkey",
    ),
    "task_end": (
        (),
        "SELECT l_orderkey % 3 AS app_id, l_orderkey // 3 * 8 + l_linenumber AS stage_id,"
        " CAST(l_quantity AS BIGINT) AS records FROM lineitem",
    ),
    "job_metrics": (
        ("job_start", "task_end"),
        "SELECT j.app_id, j.job_id, j.execution_id, CAST(sum(t.records) AS BIGINT) AS records FROM"
        " (SELECT DISTINCT app_id, job_id, execution_id, unnest(stage_ids) AS stage_id FROM job_start) j"
        " JOIN task_end t ON t.app_id = j.app_id AND t.stage_id = j.stage_id GROUP BY j.app_id, j.job_id, j.execution_id",
    ),
    "job_entity": ((), _select({"job_key": "s_suppkey", "job_id": "'j' || s_suppkey", **fx.JOB_ENTITY_COLUMNS}, "supplier")),
    "app_name": (
        ("named",),
        "SELECT DISTINCT o_custkey // 8 AS app_id, table_name FROM named JOIN orders ON o_orderkey = event_id",
    ),
    # Trailing empty items go; an application that lists nothing else has no service.
    "app_service": (
        ("conf",),
        "SELECT app_id, pos AS rank, service FROM (SELECT app_id, list AS all_services, unnest(list) AS service,"
        " generate_subscripts(list, 1) AS pos FROM (SELECT app_id, string_split(rtrim(value, ','), ',') AS list FROM conf"
        " WHERE ends_with(key, 'transport.databaseServiceNames')))",
    ),
    "app_setting": (
        (),
        " UNION ALL ".join(
            f"SELECT c_custkey // 8 AS app_id, '{key}' AS key, {text} AS value FROM customer WHERE {fx.PIPELINE_CONF_FILTER}"
            for key, text in fx.PIPELINE_CONF.items()
        ),
    ),
    "app_job": (
        ("app_setting", "job_entity"),
        "SELECT a.*, (SELECT min(job_id) FROM job_entity j WHERE j.name = a.name) AS job_id FROM (SELECT app_id,"
        " max(value) FILTER (key = 'pipelineName') AS name, max(value) FILTER (key = 'pipelineSourceUrl') AS source_url,"
        " max(value) FILTER (key = 'pipelineDescription' AND trim(value) <> '') AS description,"
        " max(value) FILTER (key = 'pipelineServiceName') AS service FROM app_setting GROUP BY app_id) a WHERE name IS NOT NULL",
    ),
    # Settings of the two sections, prefix gone.
    "setting": (
        ("conf",),
        f"SELECT app_id, substr(key, {len(PREFIX) + 1}) AS key, value FROM conf WHERE {NOT_BLANK.format('value')}"
        f" AND (starts_with(key, '{PREFIX}transport') OR starts_with(key, '{PREFIX}facets'))",
    ),
    "setting_all": (
        ("conf_all",),
        f"SELECT app_id, substr(key, {len(PREFIX) + 1}) AS key, value FROM conf_all WHERE {NOT_BLANK.format('value')}"
        f" AND (starts_with(key, '{PREFIX}transport') OR starts_with(key, '{PREFIX}facets'))",
    ),
}


def _ordered(name: str, seen: list[str]) -> list[str]:
    for need in CTES[name][0]:
        _ordered(need, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _sql(body: str, *needs: str) -> str:
    seen: list[str] = []
    for need in needs:
        _ordered(need, seen)
    ctes = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in seen)
    return f"WITH {ctes}\n{body}" if ctes else body


# The rest of the key is one leaf below these; elsewhere every dot cuts.
PATH = (
    "CASE WHEN regexp_matches(key, '^transport[.](properties|urlParams|headers)[.]')"
    " THEN regexp_replace(key, '^transport[.](properties|urlParams|headers)[.]', 'transport/\\1/')"
    " ELSE replace(regexp_replace(key, '[.]+$', ''), '.', '/') END"
)
IS_LIST = "(starts_with(value, '[') AND ends_with(value, ']') AND contains(value, ';'))"
ITEMS = (
    f"CASE WHEN {IS_LIST} OR key = 'facets.disabled' THEN"
    f" list_filter(string_split(CASE WHEN {IS_LIST} THEN value[2:-2] ELSE value END, ';'),"
    " lambda x: regexp_matches(x, '\\S')) END"
)
UPSERT_ORDER = "event_time DESC, event_id DESC, in_pos DESC, out_pos DESC, from_name DESC, to_name DESC"


def _in_services(services: str) -> str:
    """First hits with the tables of these services only, in list order."""
    return (
        "SELECT table_name, entity_type, id, fqn FROM (SELECT *, row_number() OVER (PARTITION BY table_name"
        " ORDER BY rank, length(fqn), fqn, id) AS place FROM ("
        "SELECT n.table_name, c.entity_type, c.id, c.fqn, s.rank FROM names n JOIN catalog c ON c.entity_type = 'table'"
        f" JOIN (VALUES {services}) s(rank, service) ON starts_with(c.fqn, s.service || '.')"
        " AND ends_with(c.fqn, n.table_name)"
        " AND length(c.fqn) >= length(s.service) + 1 + length(n.table_name)"
        f" WHERE NOT {_is_store('n.table_name')} UNION ALL"
        " SELECT n.table_name, c.entity_type, c.id, c.fqn, 0 FROM names n JOIN catalog c"
        f" ON c.entity_type = 'container' AND c.full_path = n.table_name WHERE {_is_store('n.table_name')}"
        ")) WHERE place = 1"
    )


ORACLE_SQL: dict[str, str] = {
    "run_events_long": _sql(
        "SELECT e.event_id, e.event_type, s.side, d.pos, d.namespace, d.name, d.sym_namespace, d.sym_name"
        " FROM run_event e JOIN (VALUES ('input'), ('output')) s(side) ON true"
        " LEFT JOIN nested d ON d.event_id = e.event_id AND d.side = s.side",
        "run_event", "nested",
    ),
    "catalog_from_search_json": _sql(
        "SELECT id AS reply_id, id, entity_type, fqn, 'k,v' AS column_names FROM catalog"
        " WHERE NOT (ends_with(id, '3_0') OR ends_with(id, '4_0'))",
        "catalog",
    ),
    "execution_records_from_log": _sql(
        "SELECT CAST(o_orderkey % 3 AS VARCHAR) AS app_id, 'sql_start' AS record, o_orderkey AS id,"
        " CAST(NULL AS BIGINT) AS execution_id, o_orderdate AS ts,"
        " CAST(NULL AS VARCHAR) AS stages, CAST(NULL AS BIGINT) AS records, CAST(NULL AS BIGINT) AS bytes"
        " FROM orders WHERE o_custkey % 7 <> 0"
        " UNION ALL SELECT CAST(o_orderkey % 3 AS VARCHAR), 'sql_end', o_orderkey, NULL, o_orderdate, NULL, NULL, NULL"
        " FROM orders WHERE o_custkey % 5 <> 0"
        " UNION ALL SELECT CAST(app_id AS VARCHAR), 'job_start', job_id, execution_id, ts, array_to_string(stage_ids, ','),"
        " NULL, NULL FROM job_start"
        " UNION ALL SELECT CAST(app_id AS VARCHAR), 'job_end', job_id, NULL, ts + INTERVAL 1 SECOND, NULL, NULL, NULL FROM job_start"
        " UNION ALL SELECT CAST(l_orderkey % 3 AS VARCHAR), 'task_end', l_orderkey // 3 * 8 + l_linenumber, NULL, NULL, NULL,"
        " CAST(l_quantity AS BIGINT), l_partkey FROM lineitem",
        "job_start",
    ),
    "event_gate": _sql(
        "SELECT * FROM gated g WHERE EXISTS (SELECT 1 FROM ref r WHERE r.event_id = g.event_id AND r.side = 'input')"
        " AND EXISTS (SELECT 1 FROM ref r WHERE r.event_id = g.event_id AND r.side = 'output')",
        "gated", "ref",
    ),
    "rejected_events": _sql(
        "SELECT event_id, event_type, reason FROM nested_reason WHERE reason IS NOT NULL", "nested_reason"
    ),
    "named_datasets": _sql("SELECT event_id, side, table_name FROM named", "named"),
    # A reference is reached if no broken one of its side was met before it, and with a broken output only the
    # first named input is.
    "sent_references": _sql(
        "SELECT r.event_id, r.side, r.pos, r.table_name FROM nested_named r WHERE"
        " NOT EXISTS (SELECT 1 FROM nested_named b WHERE b.event_id = r.event_id AND b.side = r.side AND b.has_link"
        " AND b.sym_namespace IS NULL AND b.pos <= r.pos)"
        " AND (r.side = 'output' OR NOT EXISTS (SELECT 1 FROM nested_named b WHERE b.event_id = r.event_id AND b.side = 'output'"
        " AND b.has_link AND b.sym_namespace IS NULL) OR (r.table_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nested_named f"
        " WHERE f.event_id = r.event_id AND f.side = 'input' AND f.table_name IS NOT NULL AND f.pos < r.pos)))",
        "nested_named",
    ),
    "containers_and_tables": _sql(
        f"SELECT CASE WHEN {_is_store('table_name')} THEN 'container' ELSE 'table' END AS kind, count(*) AS n"
        " FROM named GROUP BY 1",
        "named",
    ),
    "conf_filtered": _sql("SELECT * FROM setting", "setting"),
    "object_store_uris": _sql(
        f"SELECT namespace, name, {_uri('namespace', 'name')} AS uri, count(*) AS n_refs FROM ref"
        f" WHERE {_is_store('namespace')} GROUP BY namespace, name",
        "ref",
    ),
    "db_name_from_url": _sql(
        f"SELECT namespace, {DATABASE} AS database, count(*) AS n_refs FROM ref GROUP BY namespace", "ref"
    ),
    "symlink_names": _sql(
        f"SELECT {SYMLINK_NAME} AS table_name, count(*) AS n_refs FROM ref WHERE sym_namespace IS NOT NULL GROUP BY 1",
        "ref",
    ),
    "names_from_dataset": _sql(
        f"SELECT namespace, name, {DATASET_ONLY_NAME} AS table_name, count(*) AS n_refs FROM ref"
        " GROUP BY namespace, name",
        "ref",
    ),
    "dataset_names": _sql(
        f"SELECT namespace, name, {TABLE_NAME} AS table_name, count(*) AS n_refs FROM ref GROUP BY 1, 2, 3", "ref"
    ),
    "lookup_keys": _sql(
        "SELECT table_name,"
        " CASE WHEN store THEN 'container_search_index' ELSE 'table_search_index' END AS index_name,"
        " CASE WHEN store THEN 'fullPath' ELSE 'fullyQualifiedName' END AS field,"
        " CASE WHEN store THEN table_name ELSE '*' || table_name END AS value,"
        " CASE WHEN store THEN table_name ELSE 'svc0.*' || table_name END AS scoped_value"
        f" FROM (SELECT table_name, {_is_store('table_name')} AS store FROM names)",
        "names",
    ),
    "service_lists": _sql(
        "SELECT app_id, value, array_to_string(services, '|') AS services, len(services) AS n_services"
        " FROM (SELECT app_id, value, string_split(regexp_replace(value, ',+$', ''), ',') AS services FROM conf"
        f" WHERE key = '{PREFIX}transport.databaseServiceNames')",
        "conf",
    ),
    "edge_documents": _sql(
        "SELECT from_id, to_id, '{\"edge\":{\"fromEntity\":{\"type\":\"' || from_type || '\",\"id\":\"' || from_id"
        " || '\"},\"toEntity\":{\"type\":\"' || to_type || '\",\"id\":\"' || to_id"
        " || '\"},\"lineageDetails\":{' || coalesce('\"pipeline\":{\"type\":\"pipeline\",\"id\":\"' || j.job_id || '\"},', '')"
        " || '\"source\":\"SparkLineage\",\"columnsLineage\":[' || documents || ']}}}' AS document"
        " FROM nested_current c LEFT JOIN job_entity j ON j.job_key = c.run_id % 997",
        "nested_current", "job_entity",
    ),
    "job_entity_documents": _sql(
        "SELECT name, '{\"name\":\"' || name || '\",\"sourceUrl\":'"
        " || coalesce('\"' || source_url || '\"', 'null')"
        " || CASE WHEN coalesce(description, '') <> '' THEN ',\"description\":\"' || description || '\"' ELSE '' END"
        " || ',\"service\":\"' || service || '\"}' AS document FROM job_entity",
        "job_entity",
    ),
    "service_documents": _sql(
        "SELECT DISTINCT service, '{\"name\":\"' || service || '\",\"serviceType\":\"Spark\","
        "\"connection\":{\"config\":{\"type\":\"Spark\"}}}' AS document FROM job_entity",
        "job_entity",
    ),
    "conf_paths": _sql(
        f"SELECT app_id, key, {PATH} AS path, len(string_split({PATH}, '/')) AS depth FROM setting", "setting"
    ),
    "conf_list_values": _sql(
        "SELECT app_id, key, array_to_string(items, '|') AS items, len(items) AS n_items"
        f" FROM (SELECT app_id, key, {ITEMS} AS items FROM setting_all) WHERE items IS NOT NULL",
        "setting_all",
    ),
    "input_output_pairs": _sql(
        "SELECT event_id, from_name AS in_name, to_name AS out_name, count(*) AS n_pairs FROM pair GROUP BY 1, 2, 3",
        "pair",
    ),
    "table_lineage_edges": _sql(
        "SELECT event_id, from_type, from_id, from_name, to_type, to_id, to_name, count(*) AS n_pairs,"
        " 'SparkLineage' AS source FROM edge GROUP BY ALL",
        "edge",
    ),
    "edges_upserted": _sql(
        "SELECT from_type, from_id, to_type, to_id, event_time, event_id, in_pos, out_pos, from_name, to_name"
        " FROM (SELECT *, row_number() OVER (PARTITION BY from_type, from_id, to_type, to_id"
        f" ORDER BY {UPSERT_ORDER}) AS place FROM edge) WHERE place = 1",
        "edge",
    ),
    "resolve_by_suffix": _sql("SELECT table_name, id, fqn FROM hit WHERE entity_type = 'table'", "hit"),
    "resolve_in_service": _sql(
        "SELECT n.table_name, c.id, c.fqn FROM names n JOIN catalog c ON c.entity_type = 'table'"
        " AND starts_with(c.fqn, 'svc0.') AND ends_with(c.fqn, n.table_name)"
        f" AND length(c.fqn) >= 5 + length(n.table_name) WHERE NOT {_is_store('n.table_name')}",
        "names", "catalog",
    ),
    # Every application's names against the services it lists, in order; without a list against all tables.
    "resolve_per_application": _sql(
        "SELECT app_id, table_name, entity_type, id, fqn FROM (SELECT *, row_number() OVER (PARTITION BY app_id, table_name"
        " ORDER BY rank, length(fqn), fqn, id) AS place FROM ("
        "SELECT a.app_id, a.table_name, h.entity_type, h.id, h.fqn, s.rank FROM app_name a JOIN app_service s ON s.app_id = a.app_id"
        " JOIN hit h ON h.table_name = a.table_name AND h.entity_type = 'table' AND starts_with(h.fqn, s.service || '.')"
        " AND length(h.fqn) >= length(s.service) + 1 + length(a.table_name)"
        " UNION ALL SELECT a.app_id, a.table_name, h.entity_type, h.id, h.fqn, 0 FROM app_name a JOIN hit h ON h.table_name = a.table_name"
        " WHERE h.entity_type = 'container' OR a.app_id NOT IN (SELECT app_id FROM app_service))) WHERE place = 1",
        "app_name", "app_service", "hit",
    ),
    "jobs_from_settings": _sql(
        "SELECT app_id, name, service, job_id, '{\"name\":\"' || name || '\",\"sourceUrl\":'"
        " || coalesce('\"' || source_url || '\"', 'null') || coalesce(',\"description\":\"' || description || '\"', '')"
        " || ',\"service\":' || coalesce('\"' || service || '\"', 'null') || '}' AS document FROM app_job",
        "app_job",
    ),
    "services_from_settings": _sql(
        "SELECT DISTINCT service, '{\"name\":\"' || service || '\",\"serviceType\":\"Spark\",\"connection\":{\"config\":{\"type\":\"Spark\"}}}'"
        " AS document FROM app_job WHERE service IS NOT NULL",
        "app_job",
    ),
    "edges_of_applications": _sql(
        "SELECT e.from_type, e.from_id, e.to_type, e.to_id, e.job_key, j.job_id FROM (SELECT from_type, from_id, to_type, to_id,"
        " o_custkey // 8 AS job_key, row_number() OVER (PARTITION BY from_type, from_id, to_type, to_id ORDER BY event_time DESC,"
        " event_id DESC, in_pos DESC, out_pos DESC, from_name DESC, to_name DESC) AS place FROM edge JOIN orders ON o_orderkey = event_id) e"
        " LEFT JOIN app_job j ON j.app_id = e.job_key WHERE place = 1",
        "edge", "app_job",
    ),
    "resolve_containers": _sql("SELECT table_name, id, fqn FROM hit WHERE entity_type = 'container'", "hit"),
    "resolve_first_service": _sql(_in_services("(0, 'svc0')"), "names", "catalog"),
    "resolve_service_fallback": _sql(_in_services("(0, 'svc0'), (1, 'svc1')"), "names", "catalog"),
    "unresolved_datasets": _sql(
        "SELECT table_name, n AS n_refs FROM names WHERE table_name NOT IN (SELECT table_name FROM hit)", "names", "hit"
    ),
    "lookup_hit_counts": _sql(
        "SELECT n.table_name, count(h.id) AS hits FROM names n LEFT JOIN hit h ON h.table_name = n.table_name"
        " GROUP BY n.table_name",
        "names", "hit",
    ),
    "lookup_candidates": _sql("SELECT table_name, place, id, fqn FROM ranked WHERE place <= 10", "ranked"),
    "lookup_candidate_pages": _sql(
        "SELECT table_name, place, id, fqn FROM (SELECT n.table_name, c.id, c.fqn, row_number() OVER (PARTITION BY n.table_name"
        " ORDER BY length(c.fqn), c.fqn, c.id) AS place FROM (SELECT DISTINCT right(regexp_extract(table_name, '[0-9]+$'), 1) AS table_name"
        " FROM named) n JOIN catalog c ON c.entity_type = 'table' AND ends_with(c.fqn, n.table_name)) WHERE place <= 10",
        "named", "catalog",
    ),
    "lookup_first_hit": _sql("SELECT * FROM resolved", "resolved"),
    "column_lineage_pairs": _sql("SELECT * FROM column_pair", "column_pair"),
    "run_events_from_json": _sql("SELECT * FROM column_pair", "column_pair"),
    "column_lineage_distinct": _sql(
        "SELECT DISTINCT from_id, to_id, from_column, to_column FROM column_pair", "column_pair"
    ),
    "columns_per_edge": _sql(
        "SELECT e.event_id, e.in_pos, e.out_pos, from_id, to_id, coalesce(c.columns, '') AS columns,"
        " coalesce(c.n_columns, 0) AS n_columns FROM nested_edge e LEFT JOIN column_text c"
        " ON c.event_id = e.event_id AND c.in_pos = e.in_pos AND c.out_pos = e.out_pos",
        "nested_edge", "column_text",
    ),
    "sql_execution_pairs": _sql(
        "SELECT e.app_id, e.execution_id, s.ts AS start_ts, e.ts AS end_ts, s.execution_id IS NOT NULL AS had_start"
        " FROM sql_end e LEFT JOIN sql_start s ON s.app_id = e.app_id AND s.execution_id = e.execution_id",
        "sql_end", "sql_start",
    ),
    "job_context": _sql(
        "SELECT app_id, job_id, execution_id, CASE WHEN execution_id IS NULL THEN 'rdd' ELSE 'sql' END AS kind,"
        " coalesce(execution_id, job_id) AS context_id FROM job_start",
        "job_start",
    ),
    "metrics_per_job": _sql("SELECT app_id, job_id, records FROM job_metrics", "job_metrics"),
    "metrics_per_execution": _sql(
        "SELECT app_id, execution_id, CAST(sum(records) AS BIGINT) AS records FROM job_metrics"
        " WHERE execution_id IS NOT NULL GROUP BY app_id, execution_id",
        "job_metrics",
    ),
    "job_pairs": _sql(
        "SELECT e.app_id, e.job_id, s.ts AS start_ts, e.ts AS end_ts, s.job_id IS NOT NULL AS had_start,"
        " CASE WHEN s.job_id IS NULL THEN NULL WHEN s.execution_id IS NULL THEN 'rdd' ELSE 'sql' END AS kind,"
        " coalesce(s.execution_id, s.job_id) AS context_id FROM (SELECT o_orderkey % 3 AS app_id,"
        " CASE WHEN o_orderkey % 13 = 0 THEN -1 - o_orderkey // 3 ELSE o_orderkey // 3 END AS job_id,"
        " o_orderdate + INTERVAL 1 DAY AS ts FROM orders WHERE o_orderkey % 11 <> 0) e"
        " LEFT JOIN job_start s ON s.app_id = e.app_id AND s.job_id = e.job_id",
        "job_start",
    ),
    "conf_from_log": _sql(
        f"SELECT CAST(app_id AS VARCHAR) AS app_id, key, value FROM conf WHERE starts_with(key, '{PREFIX}')", "conf"
    ),
    "conf_with_defaults": _sql("SELECT app_id, key, value FROM conf_all", "conf_all"),
    "conf_overrides": _sql(
        "SELECT app_id, "
        + ", ".join(
            f"max(value) FILTER (key = '{PREFIX}{key}'{extra}) AS {column}"
            for key, column, extra in (
                ("appName", "app_name", " AND value <> ''"),
                ("namespace", "namespace", ""),
                ("parentJobName", "parent_job_name", ""),
                ("parentJobNamespace", "parent_job_namespace", ""),
                ("parentRunId", "parent_run_id", ""),
            )
        )
        + " FROM conf GROUP BY app_id",
        "conf",
    ),
    "conf_tree": _sql(
        "SELECT * FROM (WITH leaf AS ("
        f"SELECT app_id, {PATH} AS path, value, {ITEMS} AS items FROM setting_all)"
        " SELECT app_id, path, CASE WHEN items IS NULL THEN value END AS value, array_to_string(items, '|') AS items,"
        " EXISTS (SELECT 1 FROM leaf o WHERE o.app_id = l.app_id AND starts_with(o.path, l.path || '/')) AS conflict"
        " FROM leaf l)",
        "setting_all",
    ),
    "stream_edges": _sql(
        "SELECT from_type, from_id, to_type, to_id, event_time, event_id, in_pos, out_pos, columns FROM nested_current",
        "nested_current",
    ),
    "stream_edge_table": _sql(
        "SELECT from_type, from_id, to_type, to_id, event_time, event_id, in_pos, out_pos, columns FROM nested_current",
        "nested_current",
    ),
    "stream_rejects": _sql(
        "SELECT event_id, event_type, reason FROM nested_reason WHERE reason IS NOT NULL", "nested_reason"
    ),
    "stream_execution_pairs": _sql(
        "SELECT e.app_id, e.execution_id, s.ts AS start_ts, e.ts AS end_ts, s.execution_id IS NOT NULL AS had_start"
        " FROM sql_end e LEFT JOIN sql_start s ON s.app_id = e.app_id AND s.execution_id = e.execution_id",
        "sql_end", "sql_start",
    ),
}
