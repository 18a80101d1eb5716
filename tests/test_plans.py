"""What must not be in a plan, and what must."""

import os
import re

import pytest

from tributary.operators import lookup
from tributary.plans import fixtures
from tributary.plans.queries import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_and_no_python(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["table_lineage_edges", "edges_upserted", "input_output_pairs"])
def test_references_are_scanned_once(spark, sf, name):
    plan = final_plan(QUERIES[name](spark, sf))
    scans = re.findall(r"FileScan parquet[^\n]*lineitem\.parquet", plan)
    assert len(scans) == 1, plan


def test_event_type_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(QUERIES["table_lineage_edges"](spark, sf))
    (schema,) = set(re.findall(r"lineitem\.parquet\].*?ReadSchema: struct<([^>]*)>", plan))
    assert schema == "l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int"


@pytest.fixture(scope="module")
def stored_catalog(spark, sf, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("stored")), "catalog")
    fixtures.catalog(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def test_lookups_push_filters(spark, stored_catalog):
    plan = plan_of(lookup.table_keys(stored_catalog, ["svc0"]))
    assert "EqualTo(entity_type,table)" in plan and "StringStartsWith(fqn,svc0.)" in plan
    assert "column_names" not in re.search(r"ReadSchema: ([^\n]*)", plan).group(1)
    plan = plan_of(lookup.container_keys(stored_catalog))
    assert "EqualTo(entity_type,container)" in plan and "IsNotNull(full_path)" in plan


def test_first_hits_aggregate_before_the_shuffle(spark, stored_catalog):
    plan = plan_of(lookup.lookup_index(stored_catalog))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(index")
    assert plan.count("Exchange") == 1


def test_suffixes_meet_the_wanted_names_before_the_shuffle(spark, stored_catalog):
    """Lines of a plan run from the result down: between the rows made and the exchange of keys stands the filter."""
    names = spark.createDataFrame([("db.t",)], "table_name string")
    plan = plan_of(lookup.lookup_index(stored_catalog, names=names)).splitlines()
    exchange = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(index" in line)
    join = next(i for i, line in enumerate(plan) if "BroadcastHashJoin [_word" in line)
    suffixes = next(i for i, line in enumerate(plan) if "Generate explode(transform(sequence(1" in line)
    assert exchange < join < suffixes


@pytest.mark.parametrize("name", ["run_events_from_json", "execution_records_from_log", "conf_from_log"])
def test_documents_are_parsed_once(spark, sf, name):
    """The columns, and all that reads them, are taken from one parse per line."""
    assert len(re.findall(r"from_json\(", final_plan(QUERIES[name](spark, sf)))) == 1


@pytest.mark.parametrize("name", ["column_lineage_pairs", "columns_per_edge", "run_events_from_json"])
def test_events_are_scanned_once(spark, sf, name):
    plan = final_plan(QUERIES[name](spark, sf))
    assert len(re.findall(r"FileScan parquet[^\n]*orders\.parquet", plan)) == 1, plan


@pytest.mark.parametrize("name", ["table_lineage_edges", "column_lineage_pairs", "lookup_first_hit", "resolve_per_application"])
def test_plans_without_broadcasts_by_size(spark, sf, name):
    """With both thresholds off only what has a bound of its own is broadcast, and the rows are the same."""
    expected = sorted(map(str, QUERIES[name](spark, sf).collect()))
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for key in thresholds:
            spark.conf.set(key, "-1")
        df = QUERIES[name](spark, sf)
        assert sorted(map(str, df.collect())) == expected
        plan = plan_of(df)
        for node in ("BroadcastNestedLoopJoin", "CartesianProduct"):
            assert node not in plan
    finally:
        for key in thresholds:
            spark.conf.unset(key)


def test_log_is_read_in_one_pass(spark, sf):
    plan = plan_of(QUERIES["execution_records_from_log"](spark, sf))
    for name in ("orders", "lineitem"):
        assert len(re.findall(rf"FileScan parquet[^\n]*{name}\.parquet", plan)) == 1
