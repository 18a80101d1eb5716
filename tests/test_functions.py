"""Name, document and settings expressions on small tables of cases."""

import json

import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import documents, names, settings

IDENTIFIERS = "array<struct<namespace:string,name:string>>"


def column(spark, values, expression, schema="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {schema}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_database_from_url(spark):
    cases = {
        "redshift://localhost:5439/warehouse": "warehouse",
        "mysql://localhost:3306/experiments?serverTimezone=UTC": "experiments",
        "jdbc:mysql://h:3306/db": None,
        "mysql://h/db": None,
        "pg://h:1/db/s?x": "db/s",
        "pg://h:1/": None,
        "": None,
        None: None,
    }
    assert column(spark, list(cases), names.database_from_url) == list(cases.values())


def test_object_store(spark):
    cases = {"s3a://b": True, "s3://b": True, "s3n://b": False, "S3://b": False, "x/s3://b": False, "": False}
    assert column(spark, list(cases), names.is_object_store) == list(cases.values())


def test_symlink_name_takes_the_first_only(spark):
    cases = [
        (None, None),
        ([], None),
        ([("hive://m", "db.t"), ("s3://b", "/x")], "db.t"),
        ([("s3a://b", "/x")], "s3://b/x"),
        ([("s3a://b/s3a://c", "x")], "s3://b/s3://cx"),
        ([("s3a://b", None)], None),
        ([("hive://m", None), ("hive://m", "t")], None),
    ]
    got = column(spark, [c for c, _ in cases], names.symlink_name, IDENTIFIERS)
    assert got == [e for _, e in cases]


def test_dataset_name(spark):
    cases = [
        (("mysql://h:3306/sales?x=1", "orders", None), "sales.orders"),
        (("mysql://h:3306/sales", "public.orders", None), "public.orders"),
        (("s3a://bucket", "path", None), "s3://bucketpath"),
        (("file", "/tmp/x", None), "/tmp/x"),
        ((None, "x", None), None),
        (("file", None, None), None),
        (("file", "/tmp/x", [("hive://m", "db.t")]), "db.t"),
        (("s3://b", "/x", [("s3a://l", None)]), "s3://b/x"),
        ((None, None, [("hive://m", "t")]), "t"),
        (("file", "", None), ""),
    ]
    df = spark.createDataFrame(
        [(i, *c) for i, (c, _) in enumerate(cases)], f"i int, namespace string, name string, symlinks {IDENTIFIERS}"
    )
    dataset = [F.col("namespace"), F.col("name"), F.col("symlinks")]
    rows = df.orderBy("i").select(names.dataset_name(*dataset), names.has_dataset_name(*dataset)).collect()
    assert [r[0] for r in rows] == [e for _, e in cases]
    assert [r[1] for r in rows] == [e is not None for _, e in cases]


SERVICE_CASES = {
    "a,b": ["a", "b"],
    "a,,b,,": ["a", "", "b"],
    ",a": ["", "a"],
    " a , b": [" a ", " b"],
    "": [""],
    ",,": [],
    None: [],
    "a,\n": ["a", "\n"],
}


def test_service_lists(spark):
    assert column(spark, list(SERVICE_CASES), names.split_services) == list(SERVICE_CASES.values())
    assert [names.service_list(v) for v in SERVICE_CASES] == list(SERVICE_CASES.values())


@hypothesis_settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab, ", max_size=6), min_size=20, max_size=40))
def test_service_lists_agree(spark, values):
    assert column(spark, values, names.split_services) == [names.service_list(v) for v in values]


def test_lookup_key(spark):
    plain = column(spark, ["db.t", "s3://b/x"], names.lookup_key)
    assert [tuple(k) for k in plain] == [
        ("table_search_index", "fullyQualifiedName", "*db.t"),
        ("container_search_index", "fullPath", "s3://b/x"),
    ]
    scoped = column(spark, ["db.t", "s3://b/x"], lambda v: names.lookup_key(v, F.lit("svc")))
    assert [k["value"] for k in scoped] == ["svc.*db.t", "s3://b/x"]


def test_job_document_keeps_null_url_and_drops_empty_description(spark):
    cases = [
        (("n", "u", "d", "s"), {"name": "n", "sourceUrl": "u", "description": "d", "service": "s"}),
        (("n", None, "", "s"), {"name": "n", "sourceUrl": None, "service": "s"}),
        (("n", None, None, "s"), {"name": "n", "sourceUrl": None, "service": "s"}),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, n string, u string, d string, s string")
    document = documents.job_document(*[F.col(c) for c in "nuds"])
    assert [json.loads(r[0]) for r in df.orderBy("i").select(document).collect()] == [e for _, e in cases]


def test_edge_document(spark):
    df = spark.sql(
        "SELECT 'table' ft, 'a' fi, 'container' tt, 'b' ti, 'j' j,"
        " array(named_struct('fromColumns', array('x.k'), 'toColumn', 'y.\"k')) c"
    )
    text = df.select(documents.edge_document(*[F.col(c) for c in df.columns])).first()[0]
    assert json.loads(text) == {
        "edge": {
            "fromEntity": {"type": "table", "id": "a"},
            "toEntity": {"type": "container", "id": "b"},
            "lineageDetails": {
                "pipeline": {"type": "pipeline", "id": "j"},
                "source": "SparkLineage",
                "columnsLineage": [{"fromColumns": ["x.k"], "toColumn": 'y."k'}],
            },
        }
    }


def test_setting_path(spark):
    cases = {
        "transport.type": ["transport", "type"],
        "transport.headers.x.y": ["transport", "headers", "x.y"],
        "transport.urlParams.": ["transport", "urlParams", ""],
        "transport.properties.transport.properties.a": ["transport", "properties", "transport.properties.a"],
        "facets.a..b": ["facets", "a", "", "b"],
        "facets.a..": ["facets", "a"],
        "transport": ["transport"],
    }
    assert column(spark, list(cases), settings.setting_path) == list(cases.values())


@pytest.mark.parametrize(
    ("key", "value", "items"),
    [
        ("facets.x", "[a;;b]", ["a", "b"]),
        ("facets.x", "[a; ;b ]", ["a", "b "]),
        ("facets.x", "[a]", None),
        ("facets.x", "a;b", None),
        ("facets.disabled", "[x]", ["[x]"]),
        ("facets.disabled", "x;y", ["x", "y"]),
        ("facets.disabled", "[x;y]", ["x", "y"]),
        ("facets.x", "[;]", []),
    ],
)
def test_list_items(spark, key, value, items):
    df = spark.createDataFrame([(key, value)], "k string, v string")
    assert df.select(settings.list_items(F.col("k"), F.col("v"))).first()[0] == items


def test_blank(spark):
    cases = {"": True, " \t\n": True, "\u2003": True, "\u001f": True, "\u00a0": False, "a ": False, None: True}
    assert column(spark, list(cases), settings.is_blank) == list(cases.values())
