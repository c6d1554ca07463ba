"""Impact-chart Column expressions: box filters, x bins, probability text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake.functions.lookups import (
    FATALITY_PREFIX, FATALITY_RANGES, IMPACT_MAX_BOX_H, IMPACT_MAX_BOX_W,
    IMPACT_X_THRESHOLDS, LOSS_PREFIX, LOSS_RANGES, PROBABILITY_PHRASE)

N_BINS = len(IMPACT_X_THRESHOLDS) + 1
PERCENT_RE = r"^\s*(\d+)\s*%"


def is_label_box(w: Column, h: Column) -> Column:
    return (w < IMPACT_MAX_BOX_W) & (h < IMPACT_MAX_BOX_H)


def percent_value(text: Column) -> Column:
    """Integer before the first ``%``; null when the text holds none."""
    ok = F.instr(text, "%") > 0
    return F.when(ok, F.regexp_extract(text, PERCENT_RE, 1)).try_cast("int")


def x_bin(x: Column) -> Column:
    """Bin index 0..6 with strict ``>`` thresholds (so not Bucketizer)."""
    expr = F.lit(0)
    for i, t in enumerate(IMPACT_X_THRESHOLDS, start=1):
        expr = F.when(x > t, F.lit(i)).otherwise(expr)
    return expr


def _join_with_and(parts: Column) -> Column:
    """a / a, and b / a, b, and c  -- built from the array, never by comma search."""
    n = F.size(parts)
    head = F.array_join(F.slice(parts, 1, F.greatest(n - 1, F.lit(1))), ", ")
    return F.when(n == 1, F.element_at(parts, 1)).otherwise(
        F.concat(head, F.lit(", and "), F.element_at(parts, -1)))


def probability_sentence(bins: Column, kind: str) -> Column:
    """Sentence for a 7-int bin array; empty string when all bins are 0."""
    prefix, ranges = ((FATALITY_PREFIX, FATALITY_RANGES) if kind == "fatality"
                      else (LOSS_PREFIX, LOSS_RANGES))
    names = F.array(*[F.lit(r) for r in ranges])
    labelled = F.transform(bins, lambda v, i: F.struct(
        F.element_at(names, i + 1).alias("r"), v.alias("v")))
    kept = F.filter(labelled, lambda e: F.coalesce(e["v"], F.lit(0)) != 0)
    before, after = PROBABILITY_PHRASE.split("{}")
    phrases = F.transform(kept, lambda e: F.concat(
        e["r"], F.lit(before), e["v"].cast("string"), F.lit(after)))
    total = F.aggregate(bins, F.lit(0), lambda acc, v: acc + F.coalesce(v, F.lit(0)))
    return F.when((total == 0) | (F.size(kept) == 0), F.lit("")).otherwise(
        F.concat(F.lit(prefix + " "), _join_with_and(phrases), F.lit(".")))
