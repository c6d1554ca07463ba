import json
import os
import tempfile

from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.sources import landed as L


def _write(rows):
    d = tempfile.mkdtemp(dir="/tmp")
    with open(os.path.join(d, "x.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return d


def test_search_posts_filters_retweets_dates_and_terms(spark):
    posts = L.read_posts(spark, _write([
        {"post_id": "1", "user": "a", "date": "2021-08-15T10:00:00", "content": "Haiti earthquake now", "is_retweet": False},
        {"post_id": "2", "user": "b", "date": "2021-08-15T11:00:00", "content": "RT Haiti earthquake", "is_retweet": True},
        {"post_id": "3", "user": "c", "date": "2021-08-10T11:00:00", "content": "old Haiti earthquake", "is_retweet": False},
        {"post_id": "4", "user": "d", "date": "2021-08-16T09:00:00", "content": "earthquake felt in haiti!", "is_retweet": False},
        {"post_id": "5", "user": "e", "date": "2021-08-16T09:30:00", "content": "Chile news", "is_retweet": False},
    ]))
    events = spark.createDataFrame([("ev1", "Haiti")], "event_id string, country string") \
        .withColumn("terms", L.event_terms(F.col("country")))
    got = [(r.rank, r.post_id) for r in L.search_posts(posts, events, "event_id", "terms", "2021-08-14")
           .orderBy("rank").collect()]
    assert got == [(1, "4"), (2, "1")]          # newest first, retweet and old post excluded


def test_search_posts_within_a_radius(spark):
    posts = L.read_posts(spark, _write([
        {"post_id": str(i), "date": "2030-01-05T10:00:00", "content": "quake here", "coordinates": c}
        for i, c in enumerate([[10.0, 45.0], [10.5, 45.0], [40.0, 45.0], None, []])]))
    ev = spark.createDataFrame([(1, ["quake"], 45.0, 10.0)], "e int, terms array<string>, latitude double, longitude double")
    got = L.search_posts(posts, ev, "e", "terms", "2030-01-01", radius_km=100.0)
    assert sorted(r.post_id for r in got.collect()) == ["0", "1"]
    assert L.search_posts(posts, ev, "e", "terms", "2030-01-01").count() == 5


def test_news_articles_projection(spark):
    arts = L.read_articles(spark, _write([
        {"source": {"name": "Wire"}, "title": "Strong earthquake hits Haiti", "url": "u1",
         "publishedAt": "2021-08-14T12:00:00Z", "content": "c", "language": "en"},
        {"source": {"name": "Wire"}, "title": "Markets today", "url": "u2",
         "publishedAt": "2021-08-14T12:00:00Z", "content": "c", "language": "en"},
        {"source": {"name": "Diario"}, "title": "earthquake en Haiti", "url": "u3",
         "publishedAt": "2021-08-14T12:00:00Z", "content": "c", "language": "es"},
    ]))
    got = L.news_articles(arts, "en", "2021-08-01", ["quake", "earthquake", "tremors"]).collect()
    assert [(r.source_name, r.url, r.date) for r in got] == [("Wire", "u1", "2021-08-14")]


def test_search_news_phrase_language_date_and_page(spark):
    def art(i, text, lang="en", day="05"):
        return {"source": {"name": "S"}, "title": f"t{i}", "url": f"u{i}", "publishedAt": f"2030-01-{day}T00:00:00Z",
                "content": text, "language": lang}
    arts = L.read_articles(spark, _write([
        art(1, "Red Fox jumps. red fox again, red fox"), art(2, "a red fox"), art(3, "fox red"), art(4, "red fox", "fr"),
        art(5, "red fox", day="01"), art(6, "nothing")])).withColumn("article_id", F.col("url"))
    ev = spark.createDataFrame([(1, "red fox", ["red", "fox"]), (2, "blue", ["blue"])], "e int, phrase string, terms array<string>")
    got = [(r.e, r["rank"], r.url) for r in L.search_news(arts, ev, "e", "phrase", "terms", "en", "2030-01-02", 1, 1).collect()]
    assert got == [(1, 1, "u1")]
    second = [r.url for r in L.search_news(arts, ev, "e", "phrase", "terms", "en", "2030-01-02", 2, 1).collect()]
    assert second == ["u2"]


def test_query_strings(spark):
    df = spark.createDataFrame([("yellow", "2021-08-14", "Haiti")], "alert string, d string, c string")
    r = df.select(T.query_string("https://feed.example/query?format=geojson&",
                                 {"minmagnitude": 3, "alertlevel": F.col("alert"), "starttime": F.col("d")}).alias("u"),
                  T.phrase_query(F.col("c")).alias("p")).first()
    assert r.u == "https://feed.example/query?format=geojson&minmagnitude=3&alertlevel=yellow&starttime=2021-08-14"
    assert r.p == '+("earthquake" AND "Haiti")'
