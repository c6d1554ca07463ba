"""Landed social posts and news articles (the API clients are out of scope).

Both arrive as JSON lines written by whatever pulled them; they are read
with fixed schemas and searched with DataFrame predicates, once for all
events instead of one API call per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake import schemas
from hazardlake.functions import text as T
from hazardlake.operators import geo as GO
from hazardlake.operators import match as M

POST_COLS = ["user", "location", "date", "coordinates", "content"]
ARTICLE_COLS = ["source_name", "title", "url", "date", "content"]


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.POST).json(path)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ARTICLE).json(path)


def search_posts(posts: DataFrame, events: DataFrame, event_key: str, terms_col: str,
                 since: str, n: int = 10, post_key: str = "post_id", radius_km: float | None = None) -> DataFrame:
    """Per event: the first ``n`` original posts since ``since`` holding all
    of the event's search terms (retweets excluded), newest first. With
    ``radius_km`` only posts whose coordinates (lon, lat) lie that near to
    the event's ``latitude`` and ``longitude``."""
    recent = posts.where((F.col("date") >= F.lit(since).cast("timestamp_ntz"))
                         & ~F.coalesce(F.col("is_retweet"), F.lit(False)))
    hits = M.all_terms_match(events, recent, event_key, terms_col, post_key, "content")
    if radius_km is not None:
        placed = (recent.join(hits.select(post_key).distinct(), post_key, "left_semi")
                  .select(post_key, F.try_element_at("coordinates", F.lit(2)).alias("latitude"),
                          F.try_element_at("coordinates", F.lit(1)).alias("longitude"))
                  .where("latitude is not null and longitude is not null"))
        near = GO.within_radius(events, placed, radius_km, event_key, post_key)
        hits = hits.join(near.select(event_key, post_key), [event_key, post_key], "left_semi")
    ranked = M.first_n_posts(hits.join(recent.select(post_key, "date"), post_key), event_key,
                             [F.desc("date"), F.asc(post_key)], n)
    return ranked.drop("date").join(recent.select(post_key, *POST_COLS), post_key).select(
        event_key, "rank", post_key, *POST_COLS)


def news_articles(articles: DataFrame, language: str, since: str,
                  keywords: list[str], case_sensitive: bool = False) -> DataFrame:
    """Articles in ``language`` published since ``since`` whose title has a
    keyword token, projected to (source_name, title, url, date, content);
    ``date`` is the first ten characters of the publish time."""
    a = articles.where((F.col("language") == language)
                       & (F.substring("publishedAt", 1, 10) >= F.lit(since)))
    a = M.keyword_filter(a, F.col("title"), keywords, case_sensitive)
    return a.select(F.col("source.name").alias("source_name"), "title", "url",
                    F.substring("publishedAt", 1, 10).alias("date"), "content")


def search_news(articles: DataFrame, events: DataFrame, event_key: str, phrase_col: str, terms_col: str,
                language: str, since: str, page: int = 1, page_size: int = 20,
                key: str = "article_id") -> DataFrame:
    """Per event one page of articles in ``language`` since a date that hold the
    event's phrase (any case), by tf-idf relevance of its terms among them.

    (event_key, rank, score, source_name, title, url, date): candidates come
    from the inverted index of the phrase's terms; the phrase itself is checked on them.
    """
    a = articles.where((F.col("language") == language) & (F.substring("publishedAt", 1, 10) >= F.lit(since)))
    cands = M.all_terms_match(events, a, event_key, terms_col, key, "content")
    texts = a.select(key, F.lower("content").alias("_text"))
    phrases = events.select(event_key, F.lower(phrase_col).alias("_phrase"))
    hits = (cands.join(texts, key).join(phrases, event_key).where(F.contains("_text", F.col("_phrase")))
            .select(event_key, key))
    scores = M.tfidf_scores(a, events, key, "content", event_key, terms_col, only=hits)
    ranked = M.relevance_page(scores, event_key, key, page, page_size)
    fields = a.select(key, F.col("source.name").alias("source_name"), "title", "url",
                      F.substring("publishedAt", 1, 10).alias("date"))
    return ranked.join(fields, key).select(event_key, "rank", "score", "source_name", "title", "url", "date")


def event_terms(country: Column, extra: str = "earthquake") -> Column:
    """An event's search terms: its country's tokens plus ``extra``."""
    return F.array_distinct(F.concat(T.tokens(country), F.array(F.lit(extra))))
