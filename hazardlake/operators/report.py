"""One report row per event: title, narrative, sections, impact text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions.lookups import SECTION_LABELS
from hazardlake.operators.common import checkpoint


def report_title(country, rupture_date):
    return F.concat(F.lit("Earthquake Report for "), country, F.lit(" on "),
                    F.date_format(rupture_date, "yyyy-MM-dd"))


def _wide(sections: DataFrame, on: list[str]) -> DataFrame:
    """One row per ``on``, one column per section of the fixed list."""
    return sections.groupBy(*on).agg(*[
        F.max(F.when(F.col("section") == s, F.col("section_text"))).alias(f"_{s}") for s, _ in SECTION_LABELS])


def _held(events: DataFrame, key: str, wide: DataFrame, on: list[str]) -> DataFrame:
    """(key, _at, _on): the section keys of each event that has sections, no texts."""
    return checkpoint(events.select(key, *on).join(wide.select(*on), on).groupBy(key)
                      .agg(F.array_sort(F.collect_set(F.struct(*on))).alias("_on")).withColumn("_at", F.to_json("_on")))


def _texts(held: DataFrame, wide: DataFrame, on: list[str]) -> DataFrame:
    """(_at, one column per section): the texts of each set of section keys."""
    sets = held.select("_at", "_on").distinct().select("_at", F.explode("_on").alias("_k")).select(
        "_at", *[F.col("_k")[c].alias(c) for c in on])
    return sets.join(wide, on).groupBy("_at").agg(*[F.max(f"_{s}").alias(f"_{s}") for s, _ in SECTION_LABELS])


def assemble_reports(events: DataFrame, key: str, narratives: DataFrame | None = None,
                     sections: DataFrame | None = None, impact: DataFrame | None = None,
                     country_col: str = "country", time_col: str = "rupture_time",
                     region_col: str | None = None, picture_cols: list[str] | None = None,
                     section_keys: list[str] | None = None, places: DataFrame | None = None) -> DataFrame:
    """Left-join the per-event parts on ``key`` (each part has one row per key).

    When ``events`` already carries a ``narrative`` column (computed in the
    same projection), pass ``narratives=None`` and it is kept as is.

    ``sections`` is long (key, section, section_text) and is pivoted here on
    the fixed section list; the Resilience section gets the loss text of the
    impact part appended after a blank line. With ``region_col`` (a column of
    ``events``) the hazard text is the narrative, a blank line and the region
    text; ``picture_cols`` are carried along.

    Texts shared by many events come last and do not move with the events: with ``section_keys`` (columns of
    ``events``) ``sections`` is keyed by these instead of ``key``, and an event's sections are those of all
    its rows; ``places`` has (country_col, region_col, picture_cols).
    """
    has_narr = narratives is not None or "narrative" in events.columns
    shared = [*([region_col] if region_col else []), *(picture_cols or [])]
    out = events.select(key, country_col, time_col, *(["narrative"] if narratives is None and has_narr else []),
                        *(shared if places is None else []))
    if narratives is not None:
        out = out.join(narratives.select(key, "narrative"), key, "left")
    if impact is not None:
        out = out.join(impact.select(key, "fatality_text", "loss_text"), key, "left")
    if sections is not None and section_keys:
        wide = _wide(sections, section_keys)
        held = _held(events, key, wide, section_keys)
        # Events without sections keep a key of their own, so that they do not meet in one task.
        own = F.coalesce("_at", F.concat(F.lit("#"), F.col(key).cast("string")), F.lit("#"))
        out = (out.join(held.select(key, "_at"), key, "left").withColumn("_at", own)
               .join(_texts(held, wide, section_keys), "_at", "left").drop("_at"))
    elif sections is not None:
        out = out.join(_wide(sections, [key]), key, "left")
    if places is not None:
        out = out.join(places.select(country_col, *shared), country_col, "left")
    out = out.withColumn("title", report_title(F.col(country_col), F.col(time_col)))
    cols = [key, "title"]
    if has_narr:
        cols.append("narrative")
    if has_narr and region_col:
        out = out.withColumn("hazard_text", F.concat_ws("\n\n", "narrative", F.nullif(F.col(region_col), F.lit(""))))
        cols.append("hazard_text")
    cols += picture_cols or []
    loss = F.coalesce(F.col("loss_text"), F.lit("")) if impact is not None else F.lit("")
    if sections is not None:
        for s, _ in SECTION_LABELS:
            txt = F.coalesce(F.col(f"_{s}"), F.lit(""))
            if s == "Resilience":
                txt = F.concat(txt, F.lit("\n\n"), loss)
            out = out.withColumn(f"{s.lower()}_text", txt)
            cols.append(f"{s.lower()}_text")
    if impact is not None:
        cols += ["fatality_text", "loss_text"]
    return out.select(*cols)
