"""Event feed and event log sources.

The feed is read from landed GeoJSON files (the HTTP pull that produced
them is out of scope); the scan filters are ordinary ``where`` clauses so
Catalyst pushes them as far as the source allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types

from hazardlake import schemas
from hazardlake.functions import text as T
from hazardlake.functions import timefmt as TF


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Landed FeatureCollection files -> one row per feature (nested)."""
    return (spark.read.schema(schemas.FEATURE_COLLECTION).option("multiLine", True).json(path)
            .select(F.inline("features")))


def flatten_features(features: DataFrame, collect: Column | bool = True,
                     seq: Column | None = None) -> DataFrame:
    """Nested features -> the log columns, in log order; ``seq`` is the ingest order."""
    p, xyz = F.col("properties"), F.col("geometry.coordinates")
    return features.select(
        p["place"].alias("place"),
        T.country_of(p["place"]).alias("country"),
        p["mag"].alias("magnitude"),
        TF.epoch_ms_to_ts(p["time"]).alias("rupture_time"),
        p["felt"].alias("felt"), p["cdi"].alias("cdi"), p["mmi"].alias("mmi"),
        p["alert"].alias("alert"),
        F.try_element_at(xyz, F.lit(1)).alias("longitude"),
        F.try_element_at(xyz, F.lit(2)).alias("latitude"),
        F.try_element_at(xyz, F.lit(3)).alias("depth"),
        p["url"].alias("url"),
        (collect if isinstance(collect, Column) else F.lit(bool(collect))).alias("collect_data"),
        *([seq.cast("long").alias("ingest_seq")] if seq is not None else []),
    )


def filter_feed(log: DataFrame, min_magnitude: float, levels: list[str] | str,
                since: str, mag="magnitude", alert="alert", time="rupture_time") -> DataFrame:
    """Events at or above ``min_magnitude``, at one of ``levels``, since a date.

    One scan with ``isin`` replaces one query per level: the levels are
    disjoint, so the result equals the union of the per-level results.
    """
    levels = [levels] if isinstance(levels, str) else list(levels)
    cond = (F.col(mag) >= F.lit(min_magnitude)) & (F.col(time) >= F.lit(since).cast("timestamp_ntz"))
    cond = cond & (F.col(alert) == levels[0] if len(levels) == 1 else F.col(alert).isin(levels))
    return log.where(cond)


def event_id_of(url: Column) -> Column:
    """The event id is the last path part of the event URL."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def read_event_log(spark: SparkSession, path: str, text_time: bool = False) -> DataFrame:
    """Event log CSV with the fixed schema (no inference).

    With ``text_time`` the rupture time may be written with dashes or
    slashes; a time that is none reads as null.
    """
    if not text_time:
        return (spark.read.schema(schemas.LOG).option("header", True)
                .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    raw = types.StructType([types.StructField(f.name, types.StringType()) if f.name == "rupture_time" else f
                            for f in schemas.LOG.fields])
    return (spark.read.schema(raw).option("header", True).csv(path)
            .withColumn("rupture_time", TF.parse_log_time(F.col("rupture_time"))))


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.LOG)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stored (sentence, label) CSVs: quoted multi-line values, labels trimmed."""
    df = (spark.read.schema(schemas.PREDICTIONS_CSV).option("header", True)
          .option("multiLine", True).option("escape", '"').csv(path))
    return df.withColumn("label", F.trim("label"))
