"""Dataset names, catalog lookup keys and column names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal what producers and the catalog use.
OBJECT_STORE_PREFIXES = ("s3a://", "s3://")
DATABASE_IN_URL = r"^[^:]+://[^/]+:[0-9]+/([^?]+)"
TABLE_INDEX = "table_search_index"
TABLE_FIELD = "fullyQualifiedName"
CONTAINER_INDEX = "container_search_index"
CONTAINER_FIELD = "fullPath"


def is_object_store(name: Column) -> Column:
    first, second = OBJECT_STORE_PREFIXES
    return name.startswith(first) | name.startswith(second)


def object_store_uri(namespace: Column, name: Column) -> Column:
    """Bucket and path glued as they are: no slash is added between them."""
    return F.concat(F.replace(namespace, F.lit("s3a://"), F.lit("s3://")), name)


def database_from_url(url: Column) -> Column:
    """Null without a match; the pattern is anchored, so there is at most one."""
    return F.get(F.regexp_extract_all(url, F.lit(DATABASE_IN_URL), F.lit(1)), F.lit(0))


def symlink_name(symlinks: Column) -> Column:
    """Name by the first symlink; the others do not count."""
    first = F.get(symlinks, F.lit(0))
    return F.when(
        is_object_store(first["namespace"]), object_store_uri(first["namespace"], first["name"])
    ).otherwise(first["name"])


def name_from_dataset(namespace: Column, name: Column) -> Column:
    qualified = F.concat(database_from_url(namespace), F.lit("."), name)
    return F.when(
        namespace.isNotNull() & name.isNotNull(),
        F.when(is_object_store(namespace), object_store_uri(namespace, name))
        .when(~name.contains("."), F.coalesce(qualified, name))
        .otherwise(name),
    )


def dataset_name(namespace: Column, name: Column, symlinks: Column) -> Column:
    return F.coalesce(symlink_name(symlinks), name_from_dataset(namespace, name))


def has_dataset_name(namespace: Column, name: Column, symlinks: Column) -> Column:
    """Whether ``dataset_name`` is not null, without computing it."""
    return F.get(symlinks, F.lit(0))["name"].isNotNull() | (namespace.isNotNull() & name.isNotNull())


def known_name(namespace: Column, name: Column, symlinks: Column) -> Column:
    """``dataset_name`` of a dataset that has one. Not nullable, so joins on it add no null test, which
    would compute the name a second time."""
    return F.coalesce(dataset_name(namespace, name, symlinks), F.lit(""))


def lookup_index_of(table_name: Column) -> Column:
    return F.when(is_object_store(table_name), F.lit(CONTAINER_INDEX)).otherwise(F.lit(TABLE_INDEX))


def lookup_key(table_name: Column, service: Column | None = None) -> Column:
    """The search a name stands for: index, field and value (``*`` is the search wildcard)."""
    scope = F.lit("") if service is None else F.coalesce(F.concat(service, F.lit(".")), F.lit(""))
    store = is_object_store(table_name)
    return F.struct(
        lookup_index_of(table_name).alias("index"),
        F.when(store, F.lit(CONTAINER_FIELD)).otherwise(F.lit(TABLE_FIELD)).alias("field"),
        F.when(store, table_name)
        .otherwise(F.concat(scope, F.lit("*"), table_name))
        .alias("value"),
    )


def split_services(services: Column) -> Column:
    """Comma list: trailing empty items go, others stay, nothing is trimmed, '' is one empty item."""
    kept = F.regexp_replace(services, r",+\z", "")
    none = F.array().cast("array<string>")
    return (
        F.when(services.isNull(), none)
        .when(services == "", F.array(F.lit("")))
        .when(kept == "", none)
        .otherwise(F.split(kept, ","))
    )


def service_list(services: str | None) -> list[str]:
    """The same rule for one configured value."""
    if services is None:
        return []
    kept = services.rstrip(",")
    return kept.split(",") if kept or not services else []


def column_fqn(fqn: Column, column: Column) -> Column:
    return F.concat(fqn, F.lit("."), column)
