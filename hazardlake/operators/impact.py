"""Impact charts: detected label boxes -> 7 probability bins -> sentences.

Boxes arrive as a table (event_id, chart, box_order, x, y, w, h, text); the
image processing that produced them is out of scope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import impact as I


def _labelled(boxes: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Small boxes whose text holds ``N%``, with their bin and value."""
    return (boxes.where(I.is_label_box(F.col("w"), F.col("h")))
            .select(*keys, order_col, I.x_bin(F.col("x")).alias("_bin"),
                    I.percent_value(F.col("text")).alias("_v"))
            .where(F.col("_v").isNotNull()))


def _bins(order_col: str, cond=None):
    """Seven conditional ``max_by``s: per bin, the value of the last box.

    The ordering is (box order, value): boxes sharing an order position are
    resolved by their value, so the result never depends on row order. The
    value is a non-negative int, so ``order * 2^32 + value`` is the same
    order in one exact decimal -- a fixed-width buffer keeps the aggregate a
    hash aggregate (a struct ordering would force a sort-based one) and holds
    any bigint order.
    """
    out = []
    last = (F.col(order_col).cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)")
            + F.col("_v").cast("decimal(10,0)"))
    for b in range(I.N_BINS):
        hit = F.col("_bin") == b
        if cond is not None:
            hit = hit & cond
        out.append(F.coalesce(F.max_by(F.when(hit, F.col("_v")), F.when(hit, last)), F.lit(0)))
    return F.array(*out)


def box_bins(boxes: DataFrame, keys: list[str], order_col: str = "box_order") -> DataFrame:
    """(keys..., bins: array<int> of 7) -- the chart histogram.

    Boxes are binned by x with strict thresholds; within a bin the box with
    the largest ``order_col`` wins. One grouped aggregation (partial on the
    map side), no pivot pass.
    """
    return _labelled(boxes, keys, order_col).groupBy(*keys).agg(_bins(order_col).alias("bins"))


def impact_sentences(boxes: DataFrame, keys: list[str], chart_col: str = "chart",
                     order_col: str = "box_order") -> DataFrame:
    """(keys..., fatality_bins, loss_bins, fatality_text, loss_text).

    Both charts of an event are binned in the same single aggregation.
    """
    lab = _labelled(boxes, keys + [chart_col], order_col)
    wide = lab.groupBy(*keys).agg(
        _bins(order_col, F.col(chart_col) == "fatality").alias("fatality_bins"),
        _bins(order_col, F.col(chart_col) == "loss").alias("loss_bins"))
    return wide.select(*keys, "fatality_bins", "loss_bins",
                       I.probability_sentence(F.col("fatality_bins"), "fatality").alias("fatality_text"),
                       I.probability_sentence(F.col("loss_bins"), "loss").alias("loss_text"))
