"""Nested run events, written as JSON documents, through to column-level edges."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import edges, events, jobs
from tributary.operators.lookup import lookup_index, unique_entities
from tributary.schemas import CATALOG, RUN_EVENT
from tributary.sources.catalog import catalog_from_replies
from tributary.sources.edge_store import compact_edges, current_edges, read_edges, write_batch, write_edges
from tributary.sources.run_events import read_event_documents, read_run_events
from tributary.streaming.edges import current_batch_edges


def dataset(name, namespace="hive://m", symlinks=None, columns=None):
    return {"namespace": namespace, "name": name, "symlinks": symlinks, "column_lineage": columns}


def field(name, column):
    return {"namespace": "any", "name": name, "field": column}


def event(event_id, kind="COMPLETE", inputs=(), outputs=(), time="2024-01-01T00:00:00Z"):
    lists = {k: None if v is None else list(v) for k, v in (("inputs", inputs), ("outputs", outputs))}
    return {"event_id": event_id, "event_type": kind, "event_time": time, "run_id": 1, **lists}


CATALOG_ROWS = [
    ("a", "table", "svc.db.a", None, ["k", "v"]),
    ("b", "table", "svc.db.b", None, ["k", "w"]),
    ("c", "container", "obj.c", "s3://bucket/c", ["k"]),
    ("n", "table", "svc.db.nocolumns", None, None),
]
LINEAGE = {
    "k": [field("db.a", "k"), field("db.a", "k"), field("db.a", "missing"), field(None, "k"), field("other", "k")],
    "w": [field("db.a", "v")],
    "absent": [field("db.a", "k")],
}


@pytest.fixture
def read(spark, tmp_path):
    def write(documents, name="events"):
        path = tmp_path / f"{name}.json"
        path.write_text("\n".join(json.dumps(d) for d in documents))
        return read_run_events(spark, str(path))

    return write


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(CATALOG_ROWS, CATALOG)


def column_edges(documents, catalog):
    return edges.column_edges(documents, lookup_index(catalog), catalog)


def test_gate_and_rejects(read):
    broken = [{"namespace": None, "name": "x"}]
    good, named_less = dataset("db.a"), dataset(None)
    frame = read([
        event(1, inputs=[good], outputs=[good]),
        event(2, "START", inputs=[good], outputs=[good]),
        event(3, "FAIL", inputs=[good], outputs=[good]),
        event(4, None, inputs=[good], outputs=[good]),
        event(5, "FAIL", inputs=None, outputs=[good]),
        event(6, inputs=[good], outputs=None),
        event(7, inputs=[], outputs=[good]),
        event(8, inputs=[dataset("x", symlinks=broken)], outputs=[good]),
        event(9, inputs=[named_less], outputs=[dataset("x", symlinks=broken)]),
        event(10, inputs=[named_less, good], outputs=[dataset("x", symlinks=broken)]),
        event(11, "FAIL", inputs=[dataset("x", symlinks=broken)], outputs=[good]),
        event(12, inputs=[dataset("x", symlinks=[])], outputs=[good]),
    ])
    reasons = {r.event_id: r.reason for r in events.rejected_events(frame).collect()}
    assert reasons == {
        4: "null_type", 5: "null_inputs", 6: "null_outputs", 8: "null_symlink_namespace",
        10: "null_symlink_namespace",
    }
    assert {r.event_id for r in events.accepted_events(frame).collect()} == {1, 2, 9, 12}


BROKEN = dataset("x", symlinks=[{"namespace": None, "name": "x"}])


@pytest.mark.parametrize(
    ("inputs", "outputs", "expected"),
    [
        ([dataset("db.a"), BROKEN], [dataset("db.b")], {("a", "b")}),
        ([dataset("db.a")], [dataset("db.b"), BROKEN], {("a", "b")}),
        ([BROKEN, dataset("db.a")], [dataset("db.b")], set()),
        ([dataset(None), dataset("db.a"), dataset("db.b")], [dataset("db.b"), BROKEN, dataset("db.a")], {("a", "b")}),
        ([dataset("db.a"), dataset("db.b"), BROKEN, dataset("db.a")], [dataset("db.b"), dataset("db.a")],
         {("a", "b"), ("a", "a"), ("b", "b"), ("b", "a")}),
        ([dataset(None), BROKEN], [BROKEN], set()),
    ],
)
def test_edges_before_a_broken_dataset_stay(read, catalog, inputs, outputs, expected):
    frame = read([event(1, inputs=inputs, outputs=outputs)])
    assert {(r.from_id, r.to_id) for r in column_edges(frame, catalog).collect()} == expected
    refs = events.sent_refs(events.to_long(frame).where("namespace IS NOT NULL OR name IS NOT NULL"))
    long = edges.table_edges(frame.select("event_id"), refs, lookup_index(catalog))
    assert {(r.from_id, r.to_id) for r in long.collect()} == expected
    assert {r.reason for r in events.rejected_events(frame).collect()} == {"null_symlink_namespace"}


def test_a_large_event_is_cut_into_cells(spark, read, catalog):
    """The product of a large event comes in the cells of a grid, over several tasks, with the same pairs."""
    many = [dataset(f"db.x{i}") for i in range(30)]
    fields = {"k": [field(f"db.x{i}", "k") for i in range(30)], "w": [field("db.x3", "v")]}
    frame = read([event(1, inputs=many, outputs=[dataset(f"db.y{i}", columns=fields) for i in range(23)]),
                  event(2, inputs=[dataset("db.a")], outputs=[dataset("db.b")])])
    whole = events.dataset_pairs(events.named_sides(frame)).collect()
    sides = events.named_sides(frame, cell=10)
    assert sides.where("event_id = 1").count() == 9 and sides.where("event_id = 2").count() == 1
    assert sides.select(F.max(F.size("ins") * F.size("outs"))).first()[0] <= 100
    cut = events.dataset_pairs(sides).collect()
    assert sorted(map(str, cut)) == sorted(map(str, whole)) and len(cut) == 30 * 23 + 1
    assert sum(len(r.links) for r in cut) == 23 * 31
    names = {r.table_name: r.n for r in events.side_names(sides).collect()}
    assert names["db.x0"] == 23 and names["db.y0"] == 30 and names["db.a"] == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which puts tiny partitions together
    try:
        tasks = events.dataset_pairs(sides.where("event_id = 1")).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1


def test_events_without_an_id_are_rejected_with_a_reason(read, catalog):
    frame = read([event(None, inputs=[dataset("db.a")], outputs=[dataset("db.b")])])
    assert [r.reason for r in events.rejected_events(frame).collect()] == ["null_event_id"]
    assert column_edges(frame, catalog).count() == 0
    refs = events.to_long(frame)
    assert edges.table_edges(frame.select("event_id"), refs, lookup_index(catalog)).count() == 0


def test_column_pairs_bag_and_set(read, catalog):
    frame = read([event(1, inputs=[dataset("db.a"), dataset("/c", "s3a://bucket")], outputs=[dataset("db.b", columns=LINEAGE)])])
    got = {(r.from_id, r.to_id): r for r in column_edges(frame, catalog).withColumn("set", edges.column_set(F.col("column_pairs"))).collect()}
    assert got.keys() == {("a", "b"), ("c", "b")}
    pairs = sorted((p.fromColumns[0], p.toColumn) for p in got["a", "b"].column_pairs)
    assert pairs == [("svc.db.a.k", "svc.db.b.k")] * 2 + [("svc.db.a.v", "svc.db.b.w")]
    assert [p.toColumn for p in got["a", "b"].set] == ["svc.db.b.k", "svc.db.b.w"]
    assert got["c", "b"].column_pairs == []


def test_a_repeated_entity_makes_no_further_edges(read, catalog):
    frame = read([event(1, inputs=[dataset("db.a")], outputs=[dataset("db.b", columns=LINEAGE)])])
    once, twice = column_edges(frame, catalog).collect(), column_edges(frame, catalog.unionAll(catalog)).collect()
    assert once == twice and len(once) == 1
    assert unique_entities(catalog.unionAll(catalog)).count() == catalog.count()


def test_edge_stays_without_columns(read, catalog):
    lineage = {"k": [field("db.nocolumns", "k")]}
    frame = read([event(1, inputs=[dataset("db.nocolumns")], outputs=[dataset("db.b", columns=lineage), dataset("db.nocolumns")])])
    got = {(r.from_id, r.to_id): r.column_pairs or [] for r in column_edges(frame, catalog).collect()}
    assert got == {("n", "b"): [], ("n", "n"): []}


def test_one_event_one_edge_per_pair_of_positions(read, catalog):
    frame = read([event(1, inputs=[dataset("db.a"), dataset("db.a"), dataset("unknown")], outputs=[dataset("db.b"), dataset("db.a")])])
    got = sorted((r.from_id, r.to_id, r.in_pos, r.out_pos) for r in column_edges(frame, catalog).collect())
    assert got == [("a", "a", 1, 2), ("a", "a", 2, 2), ("a", "b", 1, 1), ("a", "b", 2, 1)]


def test_last_arrival_replaces_details(read, catalog):
    documents = [
        event(2, "COMPLETE", [dataset("db.a")], [dataset("db.b")], "2024-01-02T00:00:00Z"),
        event(1, "START", [dataset("db.a")], [dataset("db.b", columns=LINEAGE)], "2024-01-01T00:00:00Z"),
    ]
    for documents in (documents, documents[::-1]):
        (edge,) = current_batch_edges(read(documents), lookup_index(catalog), catalog).collect()
        assert (edge.event_id, edge.columns) == (2, [])


def test_long_form_gives_the_same_edges(read, catalog):
    documents = [
        event(i, inputs=[dataset("db.a"), dataset("db.a"), dataset("/c", "s3a://bucket")][: i % 4],
              outputs=[dataset("db.b"), dataset("db.a"), dataset(None)][: i % 3])
        for i in range(12)
    ]
    frame = read(documents)
    long = events.to_long(frame)
    gated = events.gate_long(frame.select("event_id", "event_type", "event_time"), long.where("pos IS NOT NULL"))
    found = edges.table_edges(gated.select("event_id"), long, lookup_index(catalog))
    by_pair = {(r.event_id, r.from_id, r.to_id): r.n_pairs for r in found.collect()}
    nested = column_edges(frame, catalog).groupBy("event_id", "from_id", "to_id").count()
    assert by_pair == {(r.event_id, r.from_id, r.to_id): r["count"] for r in nested.collect()}


def test_long_form_keeps_events_without_datasets(read):
    rows = events.to_long(read([event(1, inputs=None, outputs=[dataset("x")])])).collect()
    assert {(r.side, r.pos, r.name) for r in rows} == {("input", None, None), ("output", 1, "x")}


def test_edge_store(spark, read, catalog, tmp_path):
    index = lookup_index(catalog)
    first = current_batch_edges(read([event(1, inputs=[dataset("db.a")], outputs=[dataset("db.b", columns=LINEAGE)])], "e1"), index, catalog)
    second = current_batch_edges(
        read([event(2, inputs=[dataset("db.a")], outputs=[dataset("db.b"), dataset("/c", "s3://bucket")])], "e2"), index, catalog
    )
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    for batch in (first, second, second):  # the second is replayed
        write_batch(batch, log, 0 if batch is first else 1)
    ends = {(r.from_id, r.to_id): r.event_id for r in current_edges(spark, log).collect()}
    assert ends == {("a", "b"): 2, ("a", "c"): 2}
    compact_edges(spark, table, log)
    assert (tmp_path / "table" / "from_type=table" / "to_type=container").is_dir()
    assert read_edges(spark, table).count() == 2
    assert current_edges(spark, table, log).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        write_edges(first, table)


def test_search_replies(spark):
    bodies = {
        "1": '{"hits":{"total":{"value":2},"hits":[{"_source":{"id":"a","entityType":"table","fullyQualifiedName":"s.a","columnNames":["k"],"more":1}},{"_source":{"id":"c","fullPath":"s3://c"}}]}}',
        "2": '{"hits":{"total":{"value":0},"hits":[{"_source":{"id":"x"}}]}}',
        "3": "",
        "4": "not json",
        "5": None,
    }
    replies = spark.createDataFrame(list(bodies.items()), "reply_id string, body string")
    rows = {tuple(r)[:5] for r in catalog_from_replies(replies).drop("column_names").collect()}
    assert rows == {("1", "a", "table", "s.a", None), ("1", "c", None, None, "s3://c")}


def test_schema_of_documents(read):
    assert read([event(1)]).schema == RUN_EVENT


def test_jobs_by_name(spark):
    rows = [("j", "u", "", "s1"), ("j", "u2", "d", "s1"), ("k", None, None, "s2"), ("l", None, None, None)]
    frame = spark.createDataFrame(rows, "name string, source_url string, description string, service string")
    found = {r.name: json.loads(r.document) for r in jobs.job_documents(frame).collect()}
    assert found["j"] == {"name": "j", "sourceUrl": "u2", "description": "d", "service": "s1"}
    assert found["k"] == {"name": "k", "sourceUrl": None, "service": "s2"}
    assert found["l"] == {"name": "l", "sourceUrl": None, "service": None}
    services = {r.service: json.loads(r.document) for r in jobs.service_documents(frame).collect()}
    assert services.keys() == {"s1", "s2"}
    assert services["s1"] == {"name": "s1", "serviceType": "Spark", "connection": {"config": {"type": "Spark"}}}


def test_edges_of_unknown_jobs_stay(spark):
    frame = spark.createDataFrame([("table", "a", "table", "b", k) for k in (1, 2, None)], "from_type string, from_id string, to_type string, to_id string, job_key bigint")
    known = spark.createDataFrame([(1, "j1")], "job_key bigint, job_id string")
    stamped = jobs.stamp_jobs(frame.withColumn("columns", F.array().cast("array<struct<toColumn:string>>")), known)
    documents = [json.loads(r.document)["edge"]["lineageDetails"] for r in jobs.edge_documents(stamped).collect()]
    assert sorted("pipeline" in d for d in documents) == [False, False, True]


def test_documents_as_producers_write_them(spark, catalog, tmp_path):
    out = {"namespace": "hive://m", "name": "x", "facets": {
        "symlinks": {"identifiers": [{"namespace": "hive://m", "name": "db.b", "type": "TABLE"}]},
        "schema": {"fields": [{"name": "k"}]},
        "columnLineage": {"fields": {"k": {"inputFields": [{"namespace": "n", "name": "db.a", "field": "k"}], "transformationType": "IDENTITY"}}},
    }}
    document = {"eventType": "COMPLETE", "eventTime": "2024-01-01T00:00:00.000Z", "run": {"runId": "0190-uuid", "facets": {}},
                "job": {"namespace": "n", "name": "j"}, "inputs": [{"namespace": "hive://m", "name": "db.a"}], "outputs": [out]}
    path = tmp_path / "documents.json"
    path.write_text("\n".join([json.dumps(document), "", "not json", json.dumps(document)]))
    found = read_event_documents(spark, str(path))
    ids = [r.event_id for r in found.where("run_key = '0190-uuid'").collect()]
    assert len(ids) == 2 and len(set(ids)) == 1
    (edge,) = current_batch_edges(found, lookup_index(catalog), catalog).collect()
    assert (edge.from_id, edge.to_id, [c.toColumn for c in edge.columns]) == ("a", "b", ["svc.db.b.k"])
    assert [r.reason for r in events.rejected_events(found).collect()] == ["null_type"]
