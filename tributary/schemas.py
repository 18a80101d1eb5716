"""Fixed schemas; nothing in the library infers one."""

from pyspark.sql import types as T

IDENTIFIER = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("name", T.StringType()),
])

INPUT_FIELD = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("field", T.StringType()),
])

DATASET = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("symlinks", T.ArrayType(IDENTIFIER)),
    T.StructField("column_lineage", T.MapType(T.StringType(), T.ArrayType(INPUT_FIELD))),
])

RUN_EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("run_id", T.LongType()),
    T.StructField("inputs", T.ArrayType(DATASET)),
    T.StructField("outputs", T.ArrayType(DATASET)),
])

# Run events as producers write them, with datasets' facets nested; the field names are fixed values.
_FACETS = T.StructType([
    T.StructField("symlinks", T.StructType([T.StructField("identifiers", T.ArrayType(IDENTIFIER))])),
    T.StructField("columnLineage", T.StructType([
        T.StructField("fields", T.MapType(
            T.StringType(), T.StructType([T.StructField("inputFields", T.ArrayType(INPUT_FIELD))])
        )),
    ])),
])
_WRITTEN_DATASET = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("facets", _FACETS),
])
WRITTEN_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("eventTime", T.TimestampType()),
    T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
    T.StructField("inputs", T.ArrayType(_WRITTEN_DATASET)),
    T.StructField("outputs", T.ArrayType(_WRITTEN_DATASET)),
])

CATALOG = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("fqn", T.StringType()),
    T.StructField("full_path", T.StringType()),
    T.StructField("column_names", T.ArrayType(T.StringType())),
])

# Search replies as the catalog's search endpoint writes them; the field names are fixed values.
SEARCH_REPLY = T.StructType([
    T.StructField("hits", T.StructType([
        T.StructField("total", T.StructType([T.StructField("value", T.LongType())])),
        T.StructField("hits", T.ArrayType(T.StructType([
            T.StructField("_source", T.StructType([
                T.StructField("id", T.StringType()),
                T.StructField("entityType", T.StringType()),
                T.StructField("fullyQualifiedName", T.StringType()),
                T.StructField("fullPath", T.StringType()),
                T.StructField("columnNames", T.ArrayType(T.StringType())),
            ])),
        ]))),
    ])),
])

COLUMN_PAIR = T.StructType([
    T.StructField("fromColumns", T.ArrayType(T.StringType())),
    T.StructField("toColumn", T.StringType()),
])

# One upsert: who, when, and the details that replace the older ones as a whole.
EDGE = T.StructType([
    T.StructField("from_type", T.StringType()),
    T.StructField("from_id", T.StringType()),
    T.StructField("to_type", T.StringType()),
    T.StructField("to_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("in_pos", T.LongType()),
    T.StructField("out_pos", T.LongType()),
    T.StructField("columns", T.ArrayType(COLUMN_PAIR)),
])
