import subprocess
import sys

import pytest

from tributary.operators import executions
from tributary.sources import execution_log

JOBS = "job_id bigint, execution_id bigint, stage_ids array<bigint>"


def test_job_context(spark):
    jobs = spark.createDataFrame([(1, 10, [1]), (2, None, [2]), (3, None, [3])], JOBS)
    alone = {tuple(r) for r in executions.job_context(jobs).collect()}
    assert alone == {(1, 10, "sql", 10), (2, None, "rdd", 2), (3, None, "rdd", 3)}
    active = spark.createDataFrame([(1, 99), (2, 20)], "job_id bigint, execution_id bigint")
    linked = {tuple(r) for r in executions.job_context(jobs, active).collect()}
    assert linked == {(1, 10, "sql", 10), (2, 20, "sql", 20), (3, None, "rdd", 3)}


def test_metrics(spark):
    jobs = spark.createDataFrame([(1, 10, [1, 1, 2]), (2, 10, [2]), (3, None, [3]), (4, 11, [9])], JOBS)
    tasks = spark.createDataFrame(
        [(1, 5, 0.5, "x"), (1, 6, 0.5, "x"), (2, 7, 1.0, "x"), (3, 8, 1.0, "x"), (5, 100, 1.0, "x")],
        "stage_id bigint, records bigint, seconds double, host string",
    )
    per_job = {tuple(r) for r in executions.metrics_per_job(jobs, tasks).collect()}
    assert per_job == {(1, 18, 2.0), (2, 7, 1.0), (3, 8, 1.0)}
    per_execution = {tuple(r) for r in executions.metrics_per_execution(jobs, tasks).collect()}
    assert per_execution == {(10, 25, 3.0)}


APP = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.eventLog.compress", sys.argv[3])
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.read.parquet(sys.argv[2] + "/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()
spark.sparkContext.parallelize(range(4), 2).count()
spark.stop()
"""


@pytest.fixture(scope="module", params=["false", "true"])
def lines(spark, sf, tmp_path_factory, request):
    folder = tmp_path_factory.mktemp("log")
    subprocess.run([sys.executable, "-c", APP, str(folder), sf, request.param], check=True, capture_output=True, timeout=300)
    return execution_log.records(execution_log.read_event_log(spark, str(folder)))


def test_real_event_log(lines):
    assert lines.select("app_id").distinct().count() == 1
    ended = executions.pair_jobs(execution_log.job_starts(lines), execution_log.job_ends(lines)).collect()
    assert ended and all(r.had_start and r.start_ts <= r.end_ts and r.kind for r in ended)
    settings = {r.key: r.value for r in execution_log.settings(lines).collect()}
    assert "spark.eventLog.compress" in settings
    starts, ends = execution_log.sql_starts(lines), execution_log.sql_ends(lines)
    pairs = executions.pair_executions(starts, ends).collect()
    assert pairs and all(r.had_start and r.start_ts <= r.end_ts for r in pairs)
    jobs, tasks = execution_log.job_starts(lines), execution_log.task_ends(lines)
    kinds = {r.kind for r in executions.job_context(jobs).collect()}
    assert kinds == {"sql", "rdd"}
    read = executions.metrics_per_execution(jobs, tasks).agg({"records_read": "sum"}).first()[0]
    assert read == 1500


def test_applications_are_kept_apart(spark):
    jobs = spark.createDataFrame([("a", 0, 0, [0]), ("b", 0, 0, [0])], "app_id string, " + JOBS)
    tasks = spark.createDataFrame([("a", 0, 1)] * 5 + [("b", 0, 1)] * 7, "app_id string, stage_id bigint, records bigint")
    for found in (executions.metrics_per_job(jobs, tasks), executions.metrics_per_execution(jobs, tasks)):
        assert sorted((r.app_id, r.records) for r in found.collect()) == [("a", 5), ("b", 7)]
    ends = spark.createDataFrame([("a", 0, "e"), ("b", 1, "e")], "app_id string, execution_id bigint, ts string")
    starts = spark.createDataFrame([("b", 0, "s")], "app_id string, execution_id bigint, ts string")
    assert sorted((r.app_id, r.had_start) for r in executions.pair_executions(starts, ends).collect()) == [("a", False), ("b", False)]


@pytest.mark.parametrize("name", ["app-1.lzf", "eventlog_v2_app-2/events_1_app-2.lz4", "app-3.zstd.inprogress"])
def test_compressed_logs_are_refused(spark, tmp_path, name):
    path = tmp_path / name
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(b"packed")
    with pytest.raises(ValueError, match="compressed event log"):
        execution_log.read_event_log(spark, str(tmp_path))


def test_names_of_applications(spark, tmp_path):
    for name in ("app-1", "app-2.inprogress", "eventlog_v2_app-3/events_1_app-3"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("{}")
    assert {r.app_id for r in execution_log.read_event_log(spark, str(tmp_path)).collect()} == {"app-1", "app-2", "app-3"}


def test_a_compacted_rolling_log_counts_once(spark, tmp_path):
    line = '{"Event":"SparkListenerJobEnd","Job ID":%d,"Completion Time":0}\n'
    files = {
        "logs of one/eventlog_v2_app-1/events_1_app-1": [1, 2], "logs of one/eventlog_v2_app-1/events_2_app-1": [3], "logs of one/eventlog_v2_app-1/events_1_app-1.compact": [9],
        "logs of one/eventlog_v2_app-1/events_2_app-1.compact": [1, 3], "logs of one/eventlog_v2_app-1/events_3_app-1": [4], "logs of one/eventlog_v2_app-1/events_10_app-1": [5],
        "eventlog_v2_app-2/events_1_app-2": [7], "app-3": [8],
    }
    for name, ids in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("".join(line % i for i in ids))
    found = execution_log.job_ends(execution_log.records(execution_log.read_event_log(spark, str(tmp_path)))).collect()
    assert sorted((r.app_id, r.job_id) for r in found) == [("app-1", 1), ("app-1", 3), ("app-1", 4), ("app-1", 5), ("app-2", 7), ("app-3", 8)]


def test_packed_compacted_logs_are_refused(spark, tmp_path):
    (tmp_path / "eventlog_v2_app-1").mkdir()
    (tmp_path / "eventlog_v2_app-1" / "events_1_app-1.zstd.compact").write_text("x")
    with pytest.raises(ValueError, match="unpack it first"):
        execution_log.read_event_log(spark, str(tmp_path))
