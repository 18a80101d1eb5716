"""Catalog entries from tables or from search replies."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.schemas import CATALOG, SEARCH_REPLY


def read_catalog(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(CATALOG).format(file_format).load(path)


def catalog_from_replies(replies: DataFrame) -> DataFrame:
    """Documents found in (reply_id, body); an empty body or a total of 0 gives none."""
    reply = F.from_json("body", SEARCH_REPLY)
    return (
        replies.select("reply_id", reply.alias("reply"))
        .where(F.col("reply.hits.total.value") != 0)
        .select("reply_id", F.explode("reply.hits.hits").alias("hit"))
        .select("reply_id", "hit._source.*")
        .select(
            "reply_id",
            "id",
            F.col("entityType").alias("entity_type"),
            F.col("fullyQualifiedName").alias("fqn"),
            F.col("fullPath").alias("full_path"),
            F.col("columnNames").alias("column_names"),
        )
    )
