"""Lookups against the plain comparison they stand for."""

import random

import pytest

from tributary.operators import lookup
from tributary.schemas import CATALOG

PARTS = ["a", "b", "ab", "ba", "old_a", "", "a1"]


def random_name(rng, most):
    return ".".join(rng.choice(PARTS) for _ in range(rng.randint(1, most)))


@pytest.fixture(scope="module")
def world(spark):
    """Names and entries with dots, empty parts, shared suffixes, and paths on both sides."""
    rng = random.Random(7)
    entries = []
    for i in range(120):
        container = i % 5 == 0
        path = f"s3://{rng.choice(PARTS)}/{rng.choice(PARTS)}" if i % 3 else None
        service = rng.choice(["s0", "s1", "s0.x"])
        entries.append((f"e{i}", "container" if container else "table", f"{service}.{random_name(rng, 4)}", path, ["k"]))
    entries.append(("nofqn", "table", None, None, None))
    names = sorted({random_name(rng, 3) for _ in range(80)} | {e[3] for e in entries if e[3]} | {"", "s3://", "s0.a"})
    catalog = spark.createDataFrame(entries, CATALOG)
    return names, entries, spark.createDataFrame([(n,) for n in names], "table_name string"), catalog


def matches(name, entry, service=None):
    _, kind, fqn, path, _ = entry
    if name.startswith(("s3://", "s3a://")):
        return kind == "container" and path == name
    if kind != "table" or fqn is None:
        return False
    if service is None:
        return fqn.endswith(name)
    prefix = service + "."
    return fqn.startswith(prefix) and fqn.endswith(name) and len(fqn) >= len(prefix) + len(name)


def order(entry):
    return len(entry[2]), entry[2], entry[0]


def test_hits(world):
    names, entries, frame, catalog = world
    got = {(r.table_name, r.id) for r in lookup.hits(frame, lookup.search_keys(catalog)).collect()}
    assert got == {(n, e[0]) for n in names for e in entries if matches(n, e)}


@pytest.mark.parametrize("services", [[], ["s0"], ["s1", "s0"], ["s0.x", "nowhere"], ["s0", "s0.x"], [""]])
def test_first_hits(world, services):
    names, entries, frame, catalog = world
    got = {r.table_name: r.id for r in lookup.first_hits(frame, lookup.lookup_index(catalog, services)).collect()}
    expected = {}
    for n in names:
        for service in services or [None]:
            found = sorted((e for e in entries if matches(n, e, service)), key=order)
            if found:
                expected[n] = found[0][0]
                break
    assert got == expected


def test_wanted_keeps_what_is_asked(world):
    names, entries, frame, catalog = world
    some = frame.where("length(table_name) > 3")
    keys = lookup.search_keys(catalog)
    kept = lookup.wanted(keys, lookup._keyed(some))
    asked = {r.table_name for r in some.collect()}
    rows = kept.collect()
    assert sorted(r for r in rows if r.key in asked) == sorted(r for r in keys.collect() if r.key in asked)
    assert len(rows) < keys.count() / 2
    assert lookup.wanted(keys, lookup._keyed(some).limit(0)).collect() == []


def test_repeated_entities_count_once(world):
    names, entries, frame, catalog = world
    twice = lookup.search_keys(catalog.unionAll(catalog))
    assert bag(lookup.hits(frame, twice)) == bag(lookup.hits(frame, lookup.search_keys(catalog)))
    assert bag(lookup.hit_counts(frame, twice)) == bag(lookup.hit_counts(frame, lookup.search_keys(catalog)))


def bag(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("first_only", [True, False])
def test_services_per_application(spark, world, first_only):
    names, entries, frame, catalog = world
    lists = {1: ["s0"], 2: ["s1", "s0"], 3: ["s0.x", "nowhere", "s1"], 4: [], 5: [""], 7: ["nowhere", "s0"]}
    asked = [(app, n) for app in range(1, 9) for n in names]
    got = lookup.resolve_per_application(
        spark.createDataFrame(asked, "app_id bigint, table_name string"),
        spark.createDataFrame(list(lists.items()), "app_id bigint, services array<string>"), catalog, first_only,
    ).collect()
    expected = {}
    for app, n in asked:
        services = lists.get(app) or [None]
        for service in services[:1] if first_only else services:
            found = sorted((e for e in entries if matches(n, e, service)), key=order)
            if found:
                expected[app, n] = (found[0][1], found[0][0], found[0][2])
                break
    assert {(r.app_id, r.table_name): (r.entity_type, r.id, r.fqn) for r in got} == expected
    assert len(got) == len(expected) > 100


def test_only_the_first_service_is_asked():
    assert lookup.first_service(["a", "b"]) == ["a"]
    assert lookup.first_service([]) == []


def test_counts_pages_and_misses(world):
    names, entries, frame, catalog = world
    keys = lookup.search_keys(catalog)
    found = {n: sorted((e for e in entries if matches(n, e)), key=order) for n in names}
    counts = {r.table_name: r.hits for r in lookup.hit_counts(frame, keys).collect()}
    assert counts == {n: len(f) for n, f in found.items()}
    pages = {(r.table_name, r.place, r.id) for r in lookup.candidates(frame, keys).collect()}
    assert pages == {(n, i + 1, e[0]) for n, f in found.items() for i, e in enumerate(f[:10])}
    assert any(len(f) > 10 for f in found.values())
    missed = {r.table_name for r in lookup.unresolved(frame, lookup.lookup_index(catalog)).collect()}
    assert missed == {n for n, f in found.items() if not f}


def test_page_is_cut_before_the_shuffle(world):
    _, _, frame, catalog = world
    plan = lookup.candidates(frame, lookup.search_keys(catalog))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
