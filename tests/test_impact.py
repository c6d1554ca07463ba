from pyspark.sql import functions as F

from hazardlake.functions import impact as I
from hazardlake.operators import impact as IM

COLS = "event_id string, chart string, box_order int, x int, y int, w int, h int, text string"


def test_bins_strict_thresholds_last_box_wins_and_filters(spark):
    boxes = spark.createDataFrame([
        ("e", "fatality", 1, 220, 0, 10, 10, "5%"),     # x == 220 -> bin 0 (strict >)
        ("e", "fatality", 2, 221, 0, 10, 10, "7%"),     # bin 1
        ("e", "fatality", 3, 221, 0, 10, 10, "9 %"),    # bin 1, later box wins
        ("e", "fatality", 4, 600, 0, 60, 10, "50%"),    # too wide
        ("e", "fatality", 5, 600, 0, 10, 20, "50%"),    # too tall
        ("e", "fatality", 6, 566, 0, 10, 10, "abc"),    # no percent
        ("e", "fatality", 7, 566, 0, 10, 10, "33%"),    # bin 6
    ], COLS)
    b = IM.box_bins(boxes, ["event_id", "chart"]).first().bins
    assert list(b) == [5, 9, 0, 0, 0, 0, 33]


def test_bins_cover_the_x_axis_once(spark):
    df = spark.range(0, 700).select(F.col("id").cast("int").alias("x"))
    got = {r.x: r.b for r in df.select("x", I.x_bin(F.col("x")).alias("b")).collect()}
    assert all(0 <= v <= 6 for v in got.values())
    assert [got[x] for x in (0, 220, 221, 289, 290, 565, 566, 699)] == [0, 0, 1, 1, 2, 5, 6, 6]


def test_sentence_joins_with_and_keeps_thousands(spark):
    df = spark.createDataFrame([("a", [0, 0, 0, 35, 0, 0, 0]), ("b", [1, 0, 0, 0, 0, 2, 3]),
                                ("c", [0] * 7), ("d", [4, 5, 0, 0, 0, 0, 0])], "k string, bins array<int>")
    got = {r.k: (r.f, r.l) for r in df.select(
        "k", I.probability_sentence(F.col("bins"), "fatality").alias("f"),
        I.probability_sentence(F.col("bins"), "loss").alias("l")).collect()}
    assert got["a"][0] == ("USGS PAGER tool estimated the fatalities to be between 100 and 1,000 "
                           "with a probability of 35%.")
    assert got["b"][1] == ("Economic losses were expected to be smaller than $1 million with a probability "
                           "of 1%, between $10,000 million and $100,000 million with a probability of 2%, "
                           "and larger than $100,000 million with a probability of 3%.")
    assert got["c"] == ("", "")
    assert got["d"][0].endswith("smaller than 1 with a probability of 4%, and between 1 and 10 with a probability of 5%.")


def test_impact_sentences_per_event(spark):
    boxes = spark.createDataFrame([("e", "fatality", 1, 10, 0, 10, 10, "65%"),
                                   ("e", "loss", 1, 300, 0, 10, 10, "20%")], COLS)
    r = IM.impact_sentences(boxes, ["event_id"]).first()
    assert r.fatality_text.endswith("smaller than 1 with a probability of 65%.")
    assert r.loss_text.endswith("between $10 million and $100 million with a probability of 20%.")
