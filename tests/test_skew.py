"""Sliced joins: same rows as plain ones, with hot keys forced."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tributary.operators import edges, events, skew
from tributary.operators.lookup import lookup_index
from tributary.schemas import CATALOG


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 5)
    monkeypatch.setattr(events, "CELL", 3)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_is_a_join(spark, small_slices, how):
    many = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("bigint").alias("k"), F.col("id").alias("v")
    )
    few = spark.createDataFrame([(k, f"n{k}{c}") for k in range(0, 30) for c in "ab"], "k bigint, name string")
    counts = many.groupBy("k").agg(F.count("*").alias("n"))
    got = skew.sliced_join(many, few, ["k"], ["v"], counts, how)
    assert rows(got.select("k", "v", "name")) == rows(many.join(few, "k", how).select("k", "v", "name"))


def test_every_hot_key_is_cut(spark, monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 10)
    counts = spark.createDataFrame([(k, n) for k, n in enumerate([5, 10, 11, 25, 1000, 12])], "k int, n bigint")
    assert {tuple(r) for r in skew.hot_keys(counts, ["k"]).collect()} == {(2, 2), (4, 100), (3, 3), (5, 2)}


def test_slices_of_a_hot_key_are_spread(spark, small_slices):
    many = spark.range(1000).select(F.lit(1).alias("k"), "id")
    hot = skew.hot_keys(many.groupBy("k").agg(F.count("*").alias("n")), ["k"])
    sizes = [r["count"] for r in skew.slice_rows(many, hot, ["k"], ["id"]).groupBy("_slice").count().collect()]
    assert len(sizes) > 150 and max(sizes) < 25


@pytest.fixture(scope="module")
def skewed(spark):
    """One event holds a third of all references, and one name a third of all names, with repeats."""
    refs = []
    for i in range(900):
        event = 1 if i % 3 == 0 else i
        name = "db.hot" if i % 7 < 2 else f"db.t{i % 37}"
        refs.append((event, "output" if i % 2 else "input", i, "hive://m", name, None))
        if event != 1:
            refs.append((event, "input" if i % 2 else "output", i, "hive://m", f"db.t{i % 11}", None))
    schema = "event_id bigint, side string, pos bigint, namespace string, name string, symlinks array<struct<namespace:string,name:string>>"
    names = sorted({r[4] for r in refs})
    catalog = [(f"e{n}", "table", f"svc.{n}", None, ["k"]) for n in names if not n.endswith("5")]
    event_rows = [(e,) for e in sorted({r[0] for r in refs})]
    return (
        refs, names,
        spark.createDataFrame(refs, schema),
        spark.createDataFrame(event_rows, "event_id bigint"),
        spark.createDataFrame(catalog, CATALOG),
    )


def expected_pairs(refs):
    pairs = Counter()
    by_event = {}
    for event, side, _, _, name, _ in refs:
        by_event.setdefault(event, {"input": [], "output": []})[side].append(name)
    for event, sides in by_event.items():
        for i in sides["input"]:
            for o in sides["output"]:
                pairs[(event, i, o)] += 1
    return pairs


def test_pairs_of_a_hot_event(skewed, small_slices):
    refs, _, frame, event_frame, _ = skewed
    sides = events.collapse(events.named(frame))
    got = events.pair_sides(event_frame, sides).select("event_id", "in_table_name", "out_table_name", "n_pairs")
    assert {tuple(r)[:3]: r.n_pairs for r in got.collect()} == dict(expected_pairs(refs))


@pytest.mark.parametrize("big", ["input", "output"])
def test_one_large_side_is_cut(spark, small_slices, big):
    small = "output" if big == "input" else "input"
    refs = [(1, big, i, "hive://m", f"db.t{i}", None) for i in range(60)]
    refs += [(1, small, 0, "hive://m", "db.x", None), (2, big, 0, "hive://m", "db.a", None)]
    schema = "event_id bigint, side string, pos bigint, namespace string, name string, symlinks array<struct<namespace:string,name:string>>"
    sides = events.collapse(events.named(spark.createDataFrame(refs, schema)))
    pairs = events.pair_sides(spark.createDataFrame([(1,), (2,)], "event_id bigint"), sides).collect()
    assert {r.in_table_name if big == "input" else r.out_table_name for r in pairs} == {f"db.t{i}" for i in range(60)}
    assert len(pairs) == 60 and all(r.n_pairs == 1 for r in pairs)


def test_edges_of_a_hot_event(skewed, small_slices):
    refs, names, frame, event_frame, catalog = skewed
    found = edges.table_edges(event_frame, frame, lookup_index(catalog))
    # Some names end others (db.t1 does not end db.t11, but every FQN is svc.<name>), so ids follow names.
    ids = {n: f"e{n}" for n in names if not n.endswith("5")}
    expected = {
        (e, ids[i], ids[o]): n for (e, i, o), n in expected_pairs(refs).items() if i in ids and o in ids
    }
    assert {(r.event_id, r.from_id, r.to_id): r.n_pairs for r in found.collect()} == expected


def test_products_of_large_events_are_bounded(spark, monkeypatch):
    """Both sides large: every pair once, and no cell with more pairs than its bound allows by hash."""
    monkeypatch.setattr(events, "CELL", 20)
    names = [("input", f"i{k}") for k in range(300)] + [("output", f"o{k}") for k in range(200)]
    sides = spark.createDataFrame([(1, s, n, 1) for s, n in names] + [(2, "input", "a", 2), (2, "output", "b", 3)],
                                  "event_id bigint, side string, table_name string, n bigint")
    every = spark.createDataFrame([(1,), (2,)], "event_id bigint")
    pairs = events.pair_sides(every, sides).collect()
    assert len(pairs) == len({(r.event_id, r.in_table_name, r.out_table_name) for r in pairs}) == 300 * 200 + 1
    assert {r.n_pairs for r in pairs if r.event_id == 2} == {6}
    counts = sides.groupBy("event_id").agg(F.count(F.when(F.col("side") == "input", 1)).alias("input"), F.count(F.when(F.col("side") == "output", 1)).alias("output"))
    grid = skew.grid_cells(counts, ["event_id"], "input", "output", 20)
    assert [tuple(r) for r in grid.collect()] == [(1, 15, 10)]
    ins = skew.on_grid(sides.where("side = 'input'"), grid, ["event_id"], ["table_name"], "_rows").groupBy("event_id", "_row", "_col").count()
    assert ins.agg(F.max("count")).first()[0] <= 45
