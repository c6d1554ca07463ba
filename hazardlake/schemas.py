"""Fixed schemas. Jobs never infer a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Landed event feed (GeoJSON FeatureCollection, one document per file).
FEATURE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("place", T.StringType()),
        T.StructField("mag", T.DoubleType()),
        T.StructField("time", T.LongType()),
        T.StructField("felt", T.IntegerType()),
        T.StructField("cdi", T.DoubleType()),
        T.StructField("mmi", T.DoubleType()),
        T.StructField("alert", T.StringType()),
        T.StructField("url", T.StringType()),
    ])),
    T.StructField("geometry", T.StructType([
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])
FEATURE_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])

# The event log: one row per event revision.
LOG = T.StructType([
    T.StructField("place", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("magnitude", T.DoubleType()),
    T.StructField("rupture_time", T.TimestampNTZType()),
    T.StructField("felt", T.IntegerType()),
    T.StructField("cdi", T.DoubleType()),
    T.StructField("mmi", T.DoubleType()),
    T.StructField("alert", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("depth", T.DoubleType()),
    T.StructField("url", T.StringType()),
    T.StructField("collect_data", T.BooleanType()),
    T.StructField("ingest_seq", T.LongType()),
])
LOG_KEYS = ["place", "country", "magnitude", "rupture_time"]

# Landed social posts and news articles.
POST = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    T.StructField("content", T.StringType()),
    T.StructField("is_retweet", T.BooleanType()),
])
ARTICLE = T.StructType([
    T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("language", T.StringType()),
])

# Detected text boxes of an impact chart (``chart`` is fatality | loss).
BOX = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("chart", T.StringType()),
    T.StructField("box_order", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

# Classified sentences as stored by the reference run (unnamed index column).
PREDICTIONS_CSV = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("sentence", T.StringType()),
    T.StructField("label", T.StringType()),
])
