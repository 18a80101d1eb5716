"""Every registered query against its SQL, and the row counts known for the small scale."""

import pytest
from compare import duck, duck_bag, spark_bag

import __spark_entry__ as contract
from tributary.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert QUERIES.keys() <= contract.oracle_sql().keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    expected, columns, _ = duck_bag(con, contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(columns)
    assert spark_bag(df) == expected
    assert expected


@pytest.mark.parametrize(
    ("name", "column", "total"),
    [
        ("event_gate", None, 650),
        ("input_output_pairs", "n_pairs", 2896),
        ("table_lineage_edges", "n_pairs", 1872),
        ("edges_upserted", None, 1796),
        ("lookup_first_hit", None, 160),
        ("lookup_candidates", None, 190),
        ("unresolved_datasets", None, 40),
    ],
)
def test_known_totals(spark, sf, name, column, total):
    df = QUERIES[name](spark, sf)
    assert (df.agg({column: "sum"}).first()[0] if column else df.count()) == total


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "event_id"
