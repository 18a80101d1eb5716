from tributary.operators import jobs, settings


def frame(spark, rows):
    return spark.createDataFrame(rows, "app_id bigint, key string, value string")


def test_defaults_only_where_missing(spark):
    conf = frame(spark, [(1, "spark.lineage.transport.type", "http"), (2, "spark.lineage.facets.disabled", "[a;b]")])
    rows = {(r.app_id, r.key, r.value) for r in settings.with_defaults(conf).collect()}
    assert rows == {
        (1, "spark.lineage.transport.type", "http"),
        (1, "spark.lineage.facets.disabled", "[spark_unknown;spark.logicalPlan]"),
        (2, "spark.lineage.facets.disabled", "[a;b]"),
        (2, "spark.lineage.transport.type", "console"),
    }


def test_sections_and_prefix(spark):
    conf = frame(spark, [
        (1, "spark.my.transport.url", "u"), (1, "spark.my.transportX", "x"), (1, "spark.my.namespace", "n"),
        (1, "spark.lineage.transport.url", "other"), (1, "spark.my.facets.a", " \t"), (1, "spark.my.facets.b", None),
    ])
    rows = {(r.key, r.value) for r in settings.section_settings(conf, "spark.my.").collect()}
    assert rows == {("transport.url", "u"), ("transportX", "x")}


def test_overrides(spark):
    conf = frame(spark, [
        (1, "spark.lineage.appName", ""), (1, "spark.lineage.namespace", ""), (1, "spark.lineage.parentRunId", "r"),
        (2, "spark.lineage.appName", "a"), (3, "spark.other", "x"),
    ])
    rows = {r.app_id: (r.app_name, r.namespace, r.parent_run_id) for r in settings.overrides(conf).collect()}
    assert rows == {1: (None, "", "r"), 2: ("a", None, None), 3: (None, None, None)}


def test_tree_reports_conflicts(spark):
    conf = frame(spark, [
        (1, "spark.lineage.transport.type", "http"), (1, "spark.lineage.transport.type.x", "y"),
        (1, "spark.lineage.transport.headers.a.b", "h"), (2, "spark.lineage.transport.type", "http"),
        (2, "spark.lineage.facets.disabled", "[x]"),
    ])
    rows = {(r.app_id, tuple(r.path)): (r.value, r["items"], r.conflict) for r in settings.tree(conf).collect()}
    default = (None, ["spark_unknown", "spark.logicalPlan"], False)
    assert rows == {
        (1, ("transport", "type")): ("http", None, True),
        (1, ("transport", "type", "x")): ("y", None, False),
        (1, ("transport", "headers", "a.b")): ("h", None, False),
        (1, ("facets", "disabled")): default,
        (2, ("transport", "type")): ("http", None, False),
        (2, ("facets", "disabled")): (None, ["[x]"], False),
    }


def test_jobs_and_services_of_applications(spark):
    p = settings.PREFIX + "transport."
    rows = [(1, p + "pipelineName", "nightly"), (1, p + "pipelineServiceName", "spark"), (1, p + "pipelineDescription", " "),
            (2, p + "pipelineServiceName", "spark"), (3, p + "pipelineName", "other"), (3, p + "databaseServiceNames", "a,,b,,"),
            (4, p + "databaseServiceNames", ","), (5, p + "databaseServiceNames", "")]
    found = frame(spark, rows)
    assert {tuple(r) for r in settings.jobs(found).collect()} == {(1, "nightly", None, None, "spark"), (3, "other", None, None, None)}
    assert {r.app_id: r.services for r in settings.service_lists(found).collect()} == {3: ["a", "", "b"], 4: [], 5: [""]}
    listed = spark.createDataFrame([("nightly", "j2"), ("nightly", "j1")], "name string, job_id string")
    assert {(r.app_id, r.job_id) for r in jobs.with_ids(settings.jobs(found), listed).collect()} == {(1, "j1"), (3, None)}
