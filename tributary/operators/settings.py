"""Application settings as a table (app_id, key, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.names import split_services
from tributary.functions.settings import is_blank, list_items, setting_path

# The agent's namespace of keys; pass the one your applications use.
PREFIX = "spark.lineage."

# Fixed values.
DEFAULTS = {
    "facets.disabled": "[spark_unknown;spark.logicalPlan]",
    "transport.type": "console",
}
SECTIONS = ("transport", "facets")
OVERRIDES = {
    "appName": "app_name",
    "namespace": "namespace",
    "parentJobName": "parent_job_name",
    "parentJobNamespace": "parent_job_namespace",
    "parentRunId": "parent_run_id",
}
SERVICES_KEY = "transport.databaseServiceNames"
JOB_KEYS = {
    "transport.pipelineName": "name",
    "transport.pipelineSourceUrl": "source_url",
    "transport.pipelineDescription": "description",
    "transport.pipelineServiceName": "service",
}


def with_defaults(conf: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Add the defaults an application does not set: one small aggregate per application, no join."""
    keys = {prefix + key: value for key, value in DEFAULTS.items()}
    present = [F.max(F.col("key") == key).alias(f"has_{i}") for i, key in enumerate(keys)]
    candidates = F.array(
        *[
            F.struct(F.col(f"has_{i}").alias("present"), F.lit(key).alias("key"), F.lit(value).alias("value"))
            for i, (key, value) in enumerate(keys.items())
        ]
    )
    missing = (
        conf.groupBy("app_id")
        .agg(*present)
        .select("app_id", F.inline(F.filter(candidates, lambda c: ~F.coalesce(c["present"], F.lit(False)))))
        .drop("present")
    )
    return conf.select("app_id", "key", "value").unionByName(missing)


def section_settings(conf: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Settings of the two sections, without the prefix and without blank values."""
    first, second = SECTIONS
    key = F.substring("key", len(prefix) + 1, 2**31 - 1)
    return (
        conf.where(F.col("key").startswith(prefix + first) | F.col("key").startswith(prefix + second))
        .where(~is_blank(F.col("value")))
        .select("app_id", key.alias("key"), "value")
    )


def overrides(conf: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Named overrides, one row per application; an empty application name does not count."""

    def of(key: str):
        wanted = F.col("key") == prefix + key
        if key == "appName":
            wanted = wanted & (F.col("value") != "")
        return F.max(F.when(wanted, F.col("value")))

    return conf.groupBy("app_id").agg(*[of(key).alias(column) for key, column in OVERRIDES.items()])


def service_lists(conf: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(app_id, services): the database services that each application lists; those that list none have no row."""
    listed = conf.where(F.col("key") == prefix + SERVICES_KEY).groupBy("app_id").agg(F.max("value").alias("value"))
    return listed.select("app_id", split_services(F.col("value")).alias("services"))


def jobs(conf: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(app_id, name, source_url, description, service): the job that each application's settings name. One small
    aggregate per application; an application without a name has no job, and blank settings do not count."""
    of = lambda key: F.max(F.when(F.col("key") == key, F.col("value")))
    rows = section_settings(conf, prefix).groupBy("app_id").agg(*[of(key).alias(column) for key, column in JOB_KEYS.items()])
    return rows.where(F.col("name").isNotNull())


def tree(conf: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """The settings tree, one row per leaf: its path, and a plain value or a list of items.

    ``conflict`` marks a leaf that some other key of the application uses as a parent. Leaves are
    not gathered per application: no group has to fit anywhere.
    """
    leaves = section_settings(with_defaults(conf, prefix), prefix).select(
        "app_id",
        setting_path(F.col("key")).alias("path"),
        "value",
        list_items(F.col("key"), F.col("value")).alias("items"),
    )
    lengths = F.sequence(F.lit(1), F.size("path") - 1)
    parents = (
        leaves.where(F.size("path") > 1)
        .select("app_id", F.explode(F.transform(lengths, lambda n: F.slice("path", F.lit(1), n))).alias("path"))
        .distinct()
        .withColumn("conflict", F.lit(True))
    )
    return leaves.join(parents, ["app_id", "path"], "left").select(
        "app_id",
        "path",
        F.when(F.col("items").isNull(), F.col("value")).alias("value"),
        "items",
        F.coalesce("conflict", F.lit(False)).alias("conflict"),
    )
