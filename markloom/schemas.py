"""Fixed schemas of the two persisted tables and of stored API responses."""

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType(
    [
        T.StructField("pageid", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("revid", T.LongType()),
        T.StructField("articletype", T.StringType()),
        T.StructField("wikitext", T.StringType()),
    ]
)

OUT_SCHEMA = T.StructType(
    [
        T.StructField("pageid", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("revid", T.LongType()),
        T.StructField("description", T.StringType(), True),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("markdown", T.StringType()),
    ]
)

QUERY_RESPONSE = (
    "query struct<pages: map<string, struct<pageid: bigint, revisions: array<struct<"
    "revid: bigint, slots: struct<main: struct<`*`: string>>>>>>>"
)

PROPS_SCHEMA = T.StructType(
    [
        T.StructField("pageid", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("revid", T.LongType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("unsupported_tags", T.MapType(T.StringType(), T.LongType())),
        T.StructField("unsupported_templates", T.MapType(T.StringType(), T.LongType())),
    ]
)
