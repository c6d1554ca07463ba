"""Event narratives: place, time and coordinates decoded into one sentence.

One projection over all events at once; the zone of each event comes from
a range join (``operators.geo.assign_zone``), not a per-event lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import geo as G
from hazardlake.functions import text as T
from hazardlake.functions import timefmt as TF


def place_sentence(place: Column) -> Column:
    """``12 km North-Northeast of X, Y`` or, unparsable, the place itself."""
    parts = T.place_parts(place)
    word = T.compass_word(parts["direction"])
    parsed = F.concat(parts["distance_km"].cast("string"), F.lit(" km "),
                      F.coalesce(word, parts["direction"]), F.lit(" of "), parts["city"])
    return F.coalesce(parsed, place)


def narrative(local_ts: Column, magnitude: Column, depth: Column, place: Column,
              lat: Column, lon: Column, clock_name: Column | None = None) -> Column:
    clock_name = F.lit("local time") if clock_name is None else clock_name
    return F.concat(
        F.lit("On "), TF.narrative_date(local_ts), F.lit(", at approximately "),
        TF.clock(local_ts), F.lit(" "), clock_name, F.lit(", a magnitude "),
        magnitude.try_cast("decimal(4,1)").cast("string"),
        F.lit(" earthquake, with a depth of "), depth.try_cast("decimal(8,2)").cast("string"),
        F.lit(" km, struck "), place_sentence(place), F.lit(". "),
        F.lit("The coordinate of epicenter of the earthquake was "),
        G.coordinate_text(lat, lon), F.lit("."))


def event_narratives(events: DataFrame, key: str = "event_id", zone_col: str = "tz",
                     time_col: str = "rupture_time", magnitude: str = "magnitude",
                     depth: str = "depth", place: str = "place", lat: str = "latitude",
                     lon: str = "longitude", default_zone: str = "UTC",
                     carry: list[str] | None = None) -> DataFrame:
    """(key, local_time, narrative, carry...) for every event; an event
    without a zone is told in UTC and says so."""
    zone = F.coalesce(F.col(zone_col), F.lit(default_zone))
    local = TF.local_time(F.col(time_col), zone)
    return events.select(
        key, *(carry or []), local.alias("local_time"),
        narrative(local, F.col(magnitude), F.col(depth), F.col(place), F.col(lat),
                  F.col(lon), F.when(F.col(zone_col).isNull(), F.lit(default_zone)).otherwise(
                      F.lit("local time"))).alias("narrative"))
