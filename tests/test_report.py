import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from hazardlake.operators import report as RP


def test_report_row_per_event_title_sections_and_resilience_tail(spark):
    ev = spark.createDataFrame([("e1", "Westmark", "2030-03-05 21:04:59", "On March 5 ..."),
                                ("e2", "Ostland", "2030-12-31 06:09:00", "On December 31 ...")],
                               "event_id string, country string, t string, narrative string") \
        .withColumn("rupture_time", F.col("t").cast("timestamp_ntz"))
    secs = spark.createDataFrame([("e1", "Buildings", "Walls fell."), ("e1", "Resilience", "Power back.")],
                                 "event_id string, section string, section_text string")
    imp = spark.createDataFrame([("e1", "F text.", "L text.")], "event_id string, fatality_text string, loss_text string")
    got = {r.event_id: r for r in RP.assemble_reports(ev, "event_id", None, secs, imp).collect()}
    assert got["e1"].title == "Earthquake Report for Westmark on 2030-03-05"      # date only
    assert got["e1"].narrative == "On March 5 ..."
    assert got["e1"].buildings_text == "Walls fell." and got["e1"].infrastructure_text == ""
    assert got["e1"].resilience_text == "Power back.\n\nL text."
    assert got["e2"].fatality_text is None and got["e2"].resilience_text == "\n\n"


def test_report_hazard_text_and_pictures(spark):
    ev = spark.createDataFrame([(1, "A", "2030-03-05 21:04:59", "N.", "Region.", "p.png"), (2, "B", "2030-03-05 21:04:59", "N.", "", None)],
                               "event_id int, country string, t string, narrative string, region string, pic string") \
        .withColumn("rupture_time", F.col("t").cast("timestamp_ntz"))
    got = {r.event_id: r for r in RP.assemble_reports(ev, "event_id", region_col="region", picture_cols=["pic"]).collect()}
    assert got[1].hazard_text == "N.\n\nRegion." and got[2].hazard_text == "N." and got[1].pic == "p.png"


def test_region_pages_follow_the_nation_keys(spark, tmp_path):
    """A nation with a key beyond 24 has its region text too."""
    for name in os.listdir(SF_SMALL):
        key = {"nation.parquet": "n_nationkey", "customer.parquet": "c_nationkey", "pages.parquet": "page_id"}.get(name)
        if key is None:
            os.symlink(f"{SF_SMALL}/{name}", tmp_path / name)
            continue
        t = spark.read.parquet(f"{SF_SMALL}/{name}")
        moved = F.when(F.col(key) == 24, 1_000_030).otherwise(F.col(key)).cast(t.schema[key].dataType)
        t.withColumn(key, moved).write.parquet(str(tmp_path / name))
    from hazardlake.plans.catalog import report_assemble
    got, want = (report_assemble(spark, sf).where("region_text is null").count() for sf in (str(tmp_path), SF_SMALL))
    assert got == want


def test_shared_texts_equal_those_given_per_event(spark):
    """Sections by (day, place) and region texts by place: same rows as per event, also for repeated and null ids."""
    ev = spark.createDataFrame([(1, "A", "d1"), (2, "A", "d1"), (2, "B", "d2"), (2, "A", "d1"), (3, "B", None), (None, "A", "d1"), (4, "C", "d9")],
                               "event_id int, country string, day string") \
        .withColumn("rupture_time", F.lit("2030-03-05 21:04:59").cast("timestamp_ntz")).withColumn("narrative", F.concat("country", F.lit(".")))
    secs = spark.createDataFrame([("d1", "A", "Buildings", "Walls fell."), ("d1", "A", "Resilience", "Power back."), ("d2", "B", "Buildings", "All stood."),
                                  ("d9", "A", "Buildings", "None.")], "day string, country string, section string, section_text string")
    imp = spark.createDataFrame([(2, "F text.", "L text.")], "event_id int, fatality_text string, loss_text string")
    place = spark.createDataFrame([("A", "Region A.", "a.png"), ("B", None, "b.png")], "country string, region string, pic string")
    more = {"region_col": "region", "picture_cols": ["pic"]}
    want = RP.assemble_reports(ev.join(place, "country", "left"), "event_id", None, ev.join(secs, ["day", "country"]), imp, **more)
    got = RP.assemble_reports(ev, "event_id", None, secs, imp, section_keys=["day", "country"], places=place, **more)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    both = {r.buildings_text for r in got.where("event_id = 2").collect()}
    assert both == {"Walls fell."} and got.where("event_id is null").first().buildings_text == ""


def test_section_summaries_of_a_report_take_no_jobs_per_step(spark):
    """Reports over summarized sections: as many Spark jobs as tables are made, however many steps the scores take."""
    from hazardlake.operators import summarize as SM
    sents = [" ".join(f"w{(i * k) % 11}" for k in range(1, 3 + i % 5)) for i in range(40)]
    rows = [(d, "A", i, s, lab) for d in ("d1", "d2", None) for i, s in enumerate(sents) for lab in ("buildings", "resilience ")]
    labelled = spark.createDataFrame(rows, "day string, country string, pos int, sentence string, label string")
    ev = spark.createDataFrame([(1, "A", "d1"), (2, "A", "d9")], "event_id int, country string, day string") \
        .withColumn("rupture_time", F.lit("2030-03-05 21:04:59").cast("timestamp_ntz"))
    sc = spark.sparkContext
    sc.setJobGroup("report-jobs", "jobs of one report")
    try:
        secs = SM.label_sections(labelled, ["day", "country"], ["pos"])
        got = {r.event_id: r for r in RP.assemble_reports(ev, "event_id", None, secs, section_keys=["day", "country"]).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert got[1].buildings_text and got[1].resilience_text.startswith(got[1].buildings_text) and got[2].buildings_text == ""
    assert len(sc.statusTracker().getJobIdsForGroup("report-jobs")) <= 60
