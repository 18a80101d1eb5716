"""Catalogs come apart in many tasks, whatever their files, and are never broadcast whole."""

import pytest

from tributary.operators import edges, lookup
from tributary.streaming.edges import current_batch_edges

ENTRIES = [(f"e{i % 37}", "table" if i % 5 else "container", f"s{i % 3}.db.{'x' * (i % 4)}t_{i % 50}", f"s3://b/t_{i % 50}", ["k", "v"]) for i in range(60)]
NAMES = ["t_1", "db.t_7", "xt_9", "1", "", "s3://b/t_5", "s3://b/none", "none", "s1.db.xt_1"]


@pytest.fixture
def catalog(spark):
    schema = "id string, entity_type string, fqn string, full_path string, column_names array<string>"
    return spark.createDataFrame(ENTRIES, schema).coalesce(1)


@pytest.fixture
def names(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "table_name string")


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_suffixes_of_one_file_are_dealt_out(spark, catalog, names, monkeypatch):
    makes = (
        lambda: lookup.lookup_index(catalog),
        lambda: lookup.lookup_index(catalog, ["s1", "s0"], names),
        lambda: lookup.table_keys(catalog),
        lambda: lookup.search_keys(catalog, ["s0"]),
        lambda: lookup.scoped_keys(catalog, spark.createDataFrame([("",), ("s1.",), ("s1.",)], "scope string")),
    )
    expected = [rows(make()) for make in makes]
    monkeypatch.setattr(lookup, "SUFFIXES", 60)
    tasks = lookup.suffix_tasks(catalog)
    assert tasks > 5 and lookup.table_keys(catalog).rdd.getNumPartitions() == tasks
    assert [rows(make()) for make in makes] == expected
    plan = plan_of(lookup.lookup_index(catalog))
    assert plan.index("Exchange hashpartitioning(index") < plan.rindex("partial_min") < plan.index("Exchange hashpartitioning(_at")


@pytest.mark.parametrize("most", [60, 1_000_000])
def test_lists_and_names_that_come_twice(spark, catalog, monkeypatch, most):
    """An application listed several times is asked with all its lists, and gets each name once."""
    monkeypatch.setattr(lookup, "SUFFIXES", most)
    asked = [(app, n) for app in (1, 2, 3, None) for n in [*NAMES, NAMES[0], None]]
    lists = [(1, ["s1"]), (1, ["s0", "s2"]), (2, ["s2", None]), (None, ["s0"]), (3, None)]
    got = lookup.resolve_per_application(
        spark.createDataFrame(asked, "app_id bigint, table_name string"),
        spark.createDataFrame(lists, "app_id bigint, services array<string>"), catalog, first_only=False,
    )
    expected = set()
    for app, name in set(asked):
        scopes = sorted({(i, s + ".") for a, own in lists if a == app and app is not None and own for i, s in enumerate(own) if s is not None})
        if name is None:
            continue
        if name.startswith("s3://"):
            found = [(0, len(e[2]), e[2], e[0], e[1]) for e in ENTRIES if e[1] == "container" and e[3] == name]
        else:
            found = [(r, len(e[2]), e[2], e[0], e[1]) for r, s in scopes or [(0, "")] for e in ENTRIES
                     if e[1] == "table" and e[2].startswith(s) and e[2][len(s):].endswith(name)]
        if found:
            _, _, fqn, entity, kind = min(found)
            expected.add((app, name, kind, entity, fqn))
    assert len(got.collect()) == len(expected) > 10 and {tuple(r) for r in got.collect()} == expected


def test_what_follows_the_catalog_is_not_broadcast(catalog, names):
    found = lookup.with_columns(lookup.first_hits(names, lookup.lookup_index(catalog)), catalog)
    assert "BroadcastHashJoin" not in plan_of(found) and plan_of(found).count("SortMergeJoin") == 2
    assert "BroadcastHashJoin" not in plan_of(lookup.unresolved(names, lookup.lookup_index(catalog)))


def test_scopes_and_lists_are_not_a_join_of_few_keys(spark, catalog):
    got = lookup.resolve_per_application(
        spark.createDataFrame([(1, "t_1")], "app_id bigint, table_name string"),
        spark.createDataFrame([(1, ["s0"])], "app_id bigint, services array<string>"), catalog,
    )
    assert "Join [scope" not in plan_of(got)


def test_an_index_of_the_asked_names_gives_the_same_edges(spark, catalog):
    side = lambda *names: [("db", n, None, None) for n in names]
    schema = "event_id bigint, event_type string, event_time timestamp, run_id bigint, inputs array<{0}>, outputs array<{0}>".format(
        "struct<namespace:string,name:string,symlinks:array<struct<namespace:string,name:string>>,"
        "column_lineage:map<string,array<struct<namespace:string,name:string,field:string>>>>")
    events = spark.createDataFrame([(i, "START", None, i, side("t_7", "none"), side(f"db.t_{i}", "db.xt_9")) for i in range(9)], schema)
    whole = lookup.lookup_index(catalog)
    asked = lambda names: lookup.lookup_index(catalog, names=names)
    assert rows(edges.column_edges(events, asked, catalog)) == rows(edges.column_edges(events, whole, catalog)) != []
    assert rows(current_batch_edges(events, asked, catalog)) == rows(current_batch_edges(events, whole, catalog))
