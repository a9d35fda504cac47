"""Layouts of the values of messages."""

from __future__ import annotations

from pyspark.sql import types as T

# Value of a message on the term update topic.
TERM_UPDATE_MESSAGE = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("terms", T.MapType(T.StringType(), T.LongType())),
    ]
)

# Value of a message on the document topic.
DOCUMENT_MESSAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("shard_id", T.IntegerType()),
    ]
)

# The same with nested metadata.
NESTED_DOCUMENT_MESSAGE = T.StructType(
    [T.StructField(f.name, T.VariantType()) if f.name == "metadata" else f for f in DOCUMENT_MESSAGE.fields]
)
