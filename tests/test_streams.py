"""Streams against the batch results, in several micro-batches and with a replay."""

import os
import re

import pytest
from compare import spark_bag
from pyspark.sql import functions as F

from tributary.operators.events import rejected_events
from tributary.operators.executions import pair_executions
from tributary.operators.lookup import lookup_index
from tributary.plans import fixtures
from tributary.plans.scratch import scratch_folder
from tributary.schemas import RUN_EVENT
from tributary.sources.edge_store import current_edges
from tributary.sources.run_events import stream_run_events
from tributary.sources import edge_table, manifest
from tributary.streaming import edges as edge_streams
from tributary.streaming.edges import current_batch_edges, start_edges, start_table_edges
from tributary.streaming.executions import closing_row, missing_pairs, pair_execution_streams


@pytest.fixture
def documents(spark, sf, tmp_path):
    """Run events as JSON files, in arrival order within and across files by event id."""
    path = str(tmp_path / "events")
    fixtures.nested_events(spark, sf).where("event_id < 600").repartitionByRange(4, "event_id").write.json(path)
    return path


def flat(df):
    return spark_bag(df.withColumn("columns", F.to_json("columns")))


def test_edge_stream_equals_batch(spark, sf, tmp_path, documents):
    base = str(tmp_path)
    catalog = fixtures.catalog(spark, sf)
    index = lookup_index(catalog)
    events = stream_run_events(spark, documents)
    # Two runs from the same checkpoint; the second finds nothing new.
    for _ in range(2):
        start_edges(events, index, catalog, f"{base}/edges", f"{base}/rejects", f"{base}/cp").awaitTermination()
    batch = fixtures.nested_events(spark, sf).where("event_id < 600")
    expected = flat(current_batch_edges(batch, index, catalog))
    assert expected and flat(current_edges(spark, f"{base}/edges")) == expected
    rejects = spark.read.parquet(f"{base}/rejects").select("event_id", "reason")
    assert spark_bag(rejects) == spark_bag(rejected_events(batch).select("event_id", "reason"))


@pytest.mark.parametrize("table", [False, True])
def test_a_batch_deals_its_sides_out_once(spark, sf, tmp_path, documents, monkeypatch, table):
    base, plans = str(tmp_path), []

    def watched(events, index, catalog):
        found = current_batch_edges(events, index, catalog)
        found.collect()
        plans.append(found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return found

    monkeypatch.setattr(edge_streams, "current_batch_edges", watched)
    events, catalog = stream_run_events(spark, documents), fixtures.catalog(spark, sf)
    if table:
        edge_table.publish_catalog(catalog, f"{base}/catalog")
        start_table_edges(events, f"{base}/catalog", f"{base}/table", f"{base}/rejects", f"{base}/cp", "first").awaitTermination()
    else:
        lookup_index(catalog).write.parquet(f"{base}/index")
        index = spark.read.parquet(f"{base}/index")
        start_edges(events, index, catalog, f"{base}/edges", f"{base}/rejects", f"{base}/cp").awaitTermination()
    dealt = re.findall(r"(?<!Reused)Exchange hashpartitioning\(_at#", plans[0])
    assert len(plans) == 1 and len(dealt) == 1, plans[0]


def test_many_batches_and_a_replay(spark, sf, tmp_path, documents):
    base = str(tmp_path)
    catalog = fixtures.catalog(spark, sf)
    index = lookup_index(catalog)
    events = spark.readStream.schema(RUN_EVENT).option("maxFilesPerTrigger", 1).json(documents)
    # Without its checkpoint the stream starts over and rewrites the folders of all batches.
    for attempt in range(2):
        start_edges(events, index, catalog, f"{base}/edges", f"{base}/rejects", f"{base}/cp{attempt}").awaitTermination()
    assert len([d for d in os.listdir(f"{base}/edges") if d.startswith("batch_id=")]) == 4
    expected = flat(current_batch_edges(fixtures.nested_events(spark, sf).where("event_id < 600"), index, catalog))
    assert flat(current_edges(spark, f"{base}/edges")) == expected


def edge_keys(df):
    return {(r.from_id, r.to_id) for r in df.collect()}


def start_table(spark, base, documents, run, files=1):
    events = spark.readStream.schema(RUN_EVENT).option("maxFilesPerTrigger", files).json(documents)
    return start_table_edges(events, f"{base}/catalog", f"{base}/table", f"{base}/rejects", f"{base}/cp-{run}", run)


def test_table_stream_equals_batch_and_compacts(spark, sf, tmp_path, documents):
    base = str(tmp_path)
    catalog = fixtures.catalog(spark, sf)
    assert edge_table.publish_catalog(catalog, f"{base}/catalog") == 0
    for _ in range(2):  # the second finds nothing new
        start_table(spark, base, documents, "first").awaitTermination()
    _, rows = manifest.live(spark, f"{base}/table")
    assert [(r.run, r.batch, r.version) for r in rows] == [("first", b, 0) for b in range(4)]
    batch = fixtures.nested_events(spark, sf).where("event_id < 600")
    expected = flat(current_batch_edges(batch, lookup_index(catalog), catalog))
    assert expected and flat(edge_table.current_table(spark, f"{base}/table")) == expected
    edge_table.compact_table(spark, f"{base}/table")
    read = edge_table.read_table(spark, f"{base}/table")
    assert flat(read) == expected and all("/compacted/" in f for f in read.inputFiles())
    assert len(edge_table.retired(spark, f"{base}/table")) == 4
    # another run from the start, of larger and so fewer batches: its first batch retires the run before it
    start_table(spark, base, documents, "second", files=3).awaitTermination()
    _, rows = manifest.live(spark, f"{base}/table")
    assert [(r.run, r.batch) for r in rows] == [("second", 0), ("second", 1)]
    assert flat(edge_table.current_table(spark, f"{base}/table")) == expected


def test_a_run_that_starts_over_leaves_no_stale_edge(spark, sf, tmp_path):
    base, table = str(tmp_path), str(tmp_path / "table")
    edges = current_batch_edges(fixtures.nested_events(spark, sf).where("event_id < 300"), lookup_index(fixtures.catalog(spark, sf)), fixtures.catalog(spark, sf))
    edges.write.parquet(f"{base}/edges")
    stored = spark.read.parquet(f"{base}/edges")
    first, second = stored.where("event_id % 2 = 0"), stored.where("event_id % 2 = 1")
    edge_table.add_batch(first, table, "a", 0)
    edge_table.add_batch(second, table, "a", 1)
    edge_table.add_batch(second, table, "a", 1)  # runs again
    assert edge_keys(edge_table.read_table(spark, table)) == edge_keys(stored)
    edge_table.compact_table(spark, table)
    edge_table.add_batch(first, table, "b", 0)
    assert edge_keys(edge_table.read_table(spark, table)) == edge_keys(first)
    edge_table.add_batch(second, table, "c", 0, replaces=False)
    assert edge_keys(edge_table.read_table(spark, table)) == edge_keys(stored)
    edge_table.compact_table(spark, table)
    assert len(manifest.live(spark, table)[1]) == 2  # one folder a run
    with pytest.raises(Exception, match="already exists"):  # another change came first
        manifest.publish(spark, table, manifest.newest(spark, table) - 1, [])
    assert edge_table.read_table(spark, f"{base}/none").collect() == []


def test_an_entry_that_arrives_between_batches(spark, sf, tmp_path, documents):
    """The catalog knows nothing at first; the entries come before the third file."""
    base = str(tmp_path)
    catalog = fixtures.catalog(spark, sf)
    edge_table.publish_catalog(catalog.limit(0), f"{base}/catalog")
    os.makedirs(f"{base}/in")
    files = sorted(f for f in os.listdir(documents) if f.startswith("part-"))

    def arrive(some):
        for name in some:
            os.link(f"{documents}/{name}", f"{base}/in/{name}")
        start_table(spark, base, f"{base}/in", "only").awaitTermination()

    arrive(files[:2])
    assert edge_table.read_table(spark, f"{base}/table").collect() == []
    assert edge_table.publish_catalog(catalog, f"{base}/catalog") == 1
    arrive(files[2:])
    late = spark.read.schema(RUN_EVENT).json([f"{documents}/{f}" for f in files[2:]])
    assert flat(edge_table.current_table(spark, f"{base}/table")) == flat(current_batch_edges(late, lookup_index(catalog), catalog))
    assert [r.version for r in manifest.live(spark, f"{base}/table")[1]] == [0, 0, 1, 1]
    # a batch that was written uses its own version again
    assert edge_table.batch_version(spark, f"{base}/table", "only", 1) == 0
    with pytest.raises(ValueError, match="no catalog"):
        edge_table.read_catalog_version(spark, f"{base}/nowhere")


def run_pairs(spark, base, starts, ends, bound, delay="0 seconds"):
    streams = []
    for name, rows, closing_id in (("starts", starts, -1), ("ends", ends, -2)):
        frame = spark.createDataFrame(rows, "execution_id bigint, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
        frame.unionByName(closing_row(spark, "2200-01-01", closing_id)).write.parquet(f"{base}/{name}")
        streams.append(spark.readStream.schema(frame.schema).parquet(f"{base}/{name}"))
    pairs = pair_execution_streams(*streams, bound, "2200-01-01", delay)
    query = pairs.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
    query.trigger(availableNow=True).start().awaitTermination()
    return {(r.execution_id, r.had_start) for r in spark.read.parquet(f"{base}/out").collect()}


def test_execution_stream(spark, tmp_path):
    starts = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (4, "2024-01-01 00:00:00")]
    ends = [(1, "2024-01-01 00:10:00"), (2, "2024-01-01 05:00:00"), (3, "2024-01-01 00:20:00")]
    got = run_pairs(spark, str(tmp_path), starts, ends, "1 hour")
    assert got == {(1, True), (2, False), (3, False)}  # 2 ends after the bound, 4 never ends


@pytest.mark.parametrize(("delay", "dropped"), [("0 seconds", {2}), ("10 days", set())])
def test_records_out_of_order(spark, tmp_path, delay, dropped):
    """The fourth batch is older than the others: within the delay both come out, beyond it the repair finds the rest."""
    schema = "execution_id bigint, ts timestamp"
    days = [[(1, "2024-01-05")], [(3, "2024-01-06")], [(4, "2024-01-07")], [(2, "2024-01-01")], [(-1, "2200-01-01")]]
    streams, stored = [], []
    for name in ("starts", "ends"):
        for i, rows in enumerate(days):
            frame = spark.createDataFrame([(k, d) for k, d in rows], "execution_id bigint, ts string").selectExpr("execution_id", "cast(ts AS timestamp) AS ts")
            frame.coalesce(1).write.parquet(f"{tmp_path}/{name}/batch={i}")
        os.utime(f"{tmp_path}/{name}")
        stored.append(spark.read.schema(schema).parquet(*[f"{tmp_path}/{name}/batch={i}" for i in range(4)]))
        streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}/*"))
    pairs = pair_execution_streams(*streams, "1 hour", "2200-01-01", delay)
    query = pairs.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
    query.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(pairs.schema).parquet(f"{tmp_path}/out")
    assert {r.execution_id for r in out.collect()} == {1, 2, 3, 4} - dropped
    assert {(r.execution_id, r.had_start) for r in missing_pairs(out, *stored).collect()} == {(i, True) for i in dropped}


def test_execution_batch(spark):
    starts = spark.createDataFrame([(1, "s"), (4, "s")], "execution_id bigint, ts string")
    ends = spark.createDataFrame([(1, "e"), (3, "e")], "execution_id bigint, ts string")
    got = {tuple(r) for r in pair_executions(starts, ends).collect()}
    assert got == {(1, "s", "e", True), (3, None, "e", False)}


def test_scratch_is_below_the_shared_folder():
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://shared/cp/"}

    first, second = scratch_folder(Session, "x"), scratch_folder(Session, "x")
    assert first.startswith("hdfs://shared/cp/x-") and first != second
