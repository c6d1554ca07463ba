"""Stored predictions come back as they were written."""

import tempfile

from hazardlake.operators import sinks as SK
from hazardlake.sources import feed as FD

ROWS = [("a", 2, 'He said "stop".', "buildings"), ("a", 0, "two\nlines, with comma", "other"), ("a", 1, " spaces ", "infrastructure "),
        ("b", 5, "back\\slash", "resilience"), ("b", 9, "'single'", "other"), ("c", 1, "é😀;", "other")]


def back(spark, path):
    return sorted((r.grp, r.idx, r.sentence, r.label) for r in FD.read_predictions_csv(spark, path).collect())


def test_round_trip_and_rerun(spark):
    path = tempfile.mkdtemp(dir="/tmp") + "/predictions"
    df = spark.createDataFrame(ROWS, "grp string, pos int, sentence string, label string")
    SK.write_predictions(df.repartition(3), path, ["grp"], ["pos"])
    want = [("a", 0, "two\nlines, with comma", "other"), ("a", 1, " spaces ", "infrastructure"), ("a", 2, 'He said "stop".', "buildings"),
            ("b", 0, "back\\slash", "resilience"), ("b", 1, "'single'", "other"), ("c", 0, "é😀;", "other")]
    assert back(spark, path) == want
    SK.write_predictions(df.where("grp = 'b' and pos = 9"), path, ["grp"], ["pos"])
    assert back(spark, path) == [w for w in want if w[0] != "b"][:3] + [("b", 0, "'single'", "other"), want[-1]]
