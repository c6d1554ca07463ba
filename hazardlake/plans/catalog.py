"""Registered queries: the operators applied to the shared test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. The test tables stand in
for the pipeline's feeds (see README, "Test-table mapping"); every query
reads whole tables and derives its inputs from them with Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake import schemas
from hazardlake.functions import geo as G
from hazardlake.functions import html as H
from hazardlake.functions import text as TX
from hazardlake.functions import timefmt as TF
from hazardlake.functions.lookups import CLASS_NAMES
from hazardlake.operators import activity as AC
from hazardlake.operators import classify as CL
from hazardlake.operators import dedupe as D
from hazardlake.operators import geo as GO
from hazardlake.operators import impact as IM
from hazardlake.operators import match as M
from hazardlake.operators import narrate as N
from hazardlake.operators import report as RP
from hazardlake.operators import retention as R
from hazardlake.operators import sentences as S
from hazardlake.operators import summarize as SM
from hazardlake.operators import sinks as SK
from hazardlake.operators.common import checkpoint, spread
from hazardlake.plans.tables import load
from hazardlake.sources import feed as FD
from hazardlake.sources import landed as LD
from hazardlake.streaming import ingest as SI
from hazardlake.streaming import windows as SW


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries (shared with the oracle SQL).
BOILERPLATE_MIN_PAGES = 3


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- pages -> paragraphs -> sentences --------------------------------------

@query
def page_paragraphs(spark, sf):
    """Every non-empty <p> paragraph of every page."""
    return S.page_paragraphs(load(spark, sf, "pages", "page_id", "html"))


@query
def page_sentences(spark, sf):
    """Sentences of the page paragraphs, at least two words."""
    return S.page_sentences(load(spark, sf, "pages", "page_id", "html"))


@query
def boilerplate_filter(spark, sf):
    """Page sentences minus those seen on >= 3 pages."""
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "html"))
    return S.boilerplate_filter(sents, "page_id", "sentence", BOILERPLATE_MIN_PAGES)


@query
def page_text_concat(spark, sf):
    """All paragraphs of a page joined without separator."""
    return S.page_text_concat(load(spark, sf, "pages", "page_id", "html"))


def article_sentences_per_page(spark, sf):
    """The flagship: article sentences per page after boilerplate removal."""
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "html"))
    kept = S.boilerplate_filter(sents, "page_id", "sentence", BOILERPLATE_MIN_PAGES)
    return kept.groupBy("page_id").agg(F.count("*").alias("n_sentences"))


# --- event feed and event log (events table) -------------------------------
# events: value = magnitude, event_type = alert level, ts = event time,
# props JSON {"k": n} = a nested feed property.


FEED_MIN_MAG = 50.0
FEED_SINCE = "2024-01-10"
FEED_LEVEL = "error"
FEED_LEVELS = ["click", "error", "purchase"]
LOG_SPLIT = "2024-01-20"        # stored log: events before this time
BATCH_START = "2024-01-15"      # incoming batch: events from this time (overlap)
RETENTION_ASOF = "2001-09-01 00:00:00"
RETENTION_DAYS = 400
QUERY_DAYS = 67                 # the feed is asked for the days before the as-of date


def _features(spark, sf, since=None):
    """events as nested feed features (properties + geometry); ``since`` bounds the
    raw time, so that it reaches the scan."""
    ev = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    if since is not None:
        ev = ev.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    k = F.from_json("props", "k BIGINT")["k"]
    return ev.select(
        "event_id",
        F.struct(
            F.concat(F.lit("Site "), F.col("user_id").cast("string"), F.lit(", Region "),
                     k.cast("string")).alias("place"),
            F.col("value").alias("mag"),
            TF.ts_to_epoch_ms(F.col("ts")).alias("time"),
            F.lit(None).cast("int").alias("felt"), F.lit(None).cast("double").alias("cdi"),
            F.lit(None).cast("double").alias("mmi"),
            F.col("event_type").alias("alert"),
            F.concat(F.lit("https://feed.example/event/"), F.col("event_id").cast("string")).alias("url"),
        ).alias("properties"),
        F.struct(F.array(k.cast("double"), (F.col("user_id") / 10.0).cast("double"),
                         F.col("value")).alias("coordinates")).alias("geometry"))


def _flat(spark, sf, since=None):
    f = _features(spark, sf, since)
    return FD.flatten_features(f, seq=F.col("event_id")).withColumn("event_id", FD.event_id_of(F.col("url")).cast("bigint"))


FLAT_COLS = ["event_id", "place", "country", "magnitude", "rupture_time", "alert",
             "longitude", "latitude", "depth"]


@query
def feature_flatten(spark, sf):
    """Nested features -> flat log columns (country, epoch ms -> time)."""
    return _flat(spark, sf).select(*FLAT_COLS)


@query
def feed_filter(spark, sf):
    """Magnitude, alert level and start-time predicates on the feed."""
    return FD.filter_feed(_flat(spark, sf, FEED_SINCE), FEED_MIN_MAG, FEED_LEVEL, FEED_SINCE).select(*FLAT_COLS)


@query
def feed_union_levels(spark, sf):
    """Several alert levels in one scan (= union of per-level scans)."""
    return FD.filter_feed(_flat(spark, sf, FEED_SINCE), FEED_MIN_MAG, FEED_LEVELS, FEED_SINCE).select(*FLAT_COLS)


@query
def count_by_level(spark, sf):
    """A1: events per alert level."""
    f = FD.filter_feed(_flat(spark, sf, FEED_SINCE), FEED_MIN_MAG, FEED_LEVELS, FEED_SINCE)
    return f.groupBy("alert").agg(F.count("*").alias("n"))


def _log(spark, sf):
    ev = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ev.withColumn("day", TF.day_key(F.col("ts")).cast("string"))


LOG_KEYS = ["user_id", "event_type", "day"]


@query
def dedupe_keep_first(spark, sf):
    """First event per (user, type, day) by ingest sequence."""
    return D.keep_first(_log(spark, sf), LOG_KEYS, "event_id")


def _log_and_batch(spark, sf):
    log = _log(spark, sf)
    stored = log.where(F.col("ts") < F.lit(LOG_SPLIT).cast("timestamp_ntz"))
    batch = log.where(F.col("ts") >= F.lit(BATCH_START).cast("timestamp_ntz"))
    return stored, batch


@query
def upsert_latest(spark, sf):
    """Stored log + overlapping batch, latest revision per key."""
    stored, batch = _log_and_batch(spark, sf)
    return D.upsert_latest(stored, batch, LOG_KEYS, "event_id")


@query
def append_new_only(spark, sf):
    """Batch rows whose key is not stored yet."""
    stored, batch = _log_and_batch(spark, sf)
    return D.new_rows_only(stored, batch, ["event_id"])


def _orders_log(spark, sf):
    return load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")


@query
def retention_flag(spark, sf):
    """Collect flag false for events older than the retention window."""
    o = _orders_log(spark, sf).select("o_orderkey", "o_orderdate")
    return R.retention_flag(o, RETENTION_ASOF, RETENTION_DAYS, time_col="o_orderdate")


@query
def active_events(spark, sf):
    """Events inside the retention window (pushed-down range predicate)."""
    return R.active_events(_orders_log(spark, sf), RETENTION_ASOF, RETENTION_DAYS,
                           time_col="o_orderdate")


@query
def event_day_key(spark, sf):
    """Rupture date key and path-safe time."""
    o = _orders_log(spark, sf)
    return o.select("o_orderkey", TF.day_key(F.col("o_orderdate")).cast("string").alias("rupture_date"),
                    TF.path_time(F.col("o_orderdate")).alias("path_time"))


# --- places, coordinates, zones ---------------------------------------------
# Place strings are derived from supplier/customer names and nations:
# "<key % 90> km <compass[key % 16]> of <name>, <nation>", every 10th key
# left as "<name>, <nation>" (the unparsable form).


# Fixed zone boxes (zone, lat_min, lat_max, lon_min, lon_max) for the tests.
ZONES = [
    ("America/Port-au-Prince", 17.0, 20.5, -75.0, -71.5),
    ("America/Mexico_City", 14.0, 33.0, -118.0, -86.0),
    ("America/New_York", 24.0, 48.0, -90.0, -67.0),
    ("America/Santiago", -56.0, -17.0, -76.0, -66.0),
    ("Europe/London", 49.0, 61.0, -8.0, 2.0),
    ("Europe/Athens", 34.0, 42.0, 19.0, 30.0),
    ("Asia/Karachi", 23.0, 37.0, 60.0, 78.0),
    ("Asia/Kolkata", 6.0, 36.0, 68.0, 97.0),
    ("Asia/Shanghai", 18.0, 54.0, 73.0, 135.0),
    ("Asia/Tokyo", 24.0, 46.0, 122.0, 146.0),
    ("Australia/Melbourne", -39.5, -34.0, 140.0, 150.0),
    ("Pacific/Auckland", -47.5, -34.0, 166.0, 179.0),
    ("Pacific/Fiji", -21.0, -12.0, 176.0, -178.0),
]


def zones_df(spark):
    return spark.createDataFrame(ZONES, "zone string, lat_min double, lat_max double, "
                                        "lon_min double, lon_max double")


def derived_place(key, name, nation):
    dir_ = F.element_at(TX.compass_abbrevs(), (key % 16 + 1).cast("int"))
    full = F.concat((key % 90).cast("string"), F.lit(" km "), dir_, F.lit(" of "), name,
                    F.lit(", "), nation)
    return F.when(key % 10 == 0, F.concat(name, F.lit(", "), nation)).otherwise(full)


def derived_lat(key):
    return ((key * 37) % 18001).cast("double") / 100.0 - 90.0


def derived_lon(key):
    return ((key * 53) % 36001).cast("double") / 100.0 - 180.0


def _nation(spark, sf):
    return load(spark, sf, "nation", "n_nationkey", "n_name")


def _supplier_places(spark, sf):
    s = load(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    s = s.join(_nation(spark, sf), s.s_nationkey == F.col("n_nationkey"))
    return s.select("s_suppkey", derived_place(F.col("s_suppkey"), F.col("s_name"),
                                               F.col("n_name")).alias("place"))


@query
def country_extract(spark, sf):
    """country = last ', ' part of the place."""
    p = _supplier_places(spark, sf)
    return p.select("s_suppkey", "place", TX.country_of(F.col("place")).alias("country"))


@query
def place_parse(spark, sf):
    """Distance, compass direction and city from the place."""
    p = _supplier_places(spark, sf).select("s_suppkey", TX.place_parts(F.col("place")).alias("p"))
    return p.select("s_suppkey", "p.distance_km", "p.direction", "p.city")


@query
def compass_decode(spark, sf):
    """Compass abbreviation -> word."""
    p = _supplier_places(spark, sf).select(
        "s_suppkey", TX.place_parts(F.col("place"))["direction"].alias("direction"))
    return p.select("s_suppkey", "direction", TX.compass_word(F.col("direction")).alias("direction_name"))


def _customer_points(spark, sf):
    c = load(spark, sf, "customer", "c_custkey")
    return c.select("c_custkey", derived_lat(F.col("c_custkey")).alias("latitude"),
                    derived_lon(F.col("c_custkey")).alias("longitude"))


@query
def hemisphere_format(spark, sf):
    """Coordinates as fixed-format degrees with hemispheres."""
    c = _customer_points(spark, sf)
    return c.select("c_custkey", G.coordinate_text(F.col("latitude"), F.col("longitude")).alias("coordinates"))


@query
def tz_range_join(spark, sf):
    """Point -> smallest zone box holding it, else the 15-degree zone of its longitude."""
    z = GO.assign_zone(_customer_points(spark, sf), zones_df(spark), "c_custkey", nautical=True)
    return z.select("c_custkey", "tz")


def _order_events(spark, sf):
    """orders as events: place/coordinates from the customer, zone by box."""
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    c = c.join(_nation(spark, sf), c.c_nationkey == F.col("n_nationkey"))
    pts = c.select("c_custkey", "c_name", F.col("n_name").alias("country"),
                   derived_lat(F.col("c_custkey")).alias("latitude"),
                   derived_lon(F.col("c_custkey")).alias("longitude"))
    pts = GO.assign_zone(pts, zones_df(spark), "c_custkey", nautical=True)
    ev = o.join(pts, o.o_custkey == pts.c_custkey)
    return ev.select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("rupture_time"),
        derived_place(F.col("o_orderkey"), F.col("c_name"), F.col("country")).alias("place"),
        "country", "latitude", "longitude", "tz",
        ((F.col("o_orderkey") % 91).cast("double") / 10.0).alias("magnitude"),
        ((F.col("o_orderkey") % 7001).cast("double") / 100.0).alias("depth"))


@query
def local_time(spark, sf):
    """UTC rupture time -> local wall clock of the event's zone."""
    ev = _order_events(spark, sf)
    return ev.select(F.col("event_id").alias("o_orderkey"), "tz",
                     TF.local_time(F.col("rupture_time"), F.coalesce("tz", F.lit("UTC"))).alias("local_time"))


@query
def event_narrative(spark, sf):
    """One narrative sentence per event."""
    return N.event_narratives(_order_events(spark, sf), key="event_id")


@query
def url_derive(spark, sf):
    """Derived page URLs, search strings and the feed's query string."""
    since = F.date_format(R.query_start(RETENTION_ASOF, QUERY_DAYS), "yyyy-MM-dd")
    p = load(spark, sf, "pages", "page_id", "url")
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return p.select(
        "page_id",
        F.concat("url", F.lit("/shakemap/intensity")).alias("intensity_url"),
        F.concat("url", F.lit("/region-info")).alias("region_url"),
        F.concat("url", F.lit("/pager")).alias("pager_url"),
        F.concat(host, F.lit("+earthquake")).alias("post_query"),
        TX.phrase_query(host).alias("news_query"),
        TX.query_string("https://feed.example/query?", {
            "format": "geojson", "starttime": since, "minmagnitude": FEED_MIN_MAG,
            "alertlevel": FEED_LEVEL, "page": F.col("page_id")}).alias("feed_query"))


# --- documents: lines, sentences, keywords ---------------------------------


TITLE_KEYWORDS = ["der", "of", "de"]
LINE_MARKER = "La "
LINK_SUFFIX = "."


def _docs(spark, sf, *cols):
    return load(spark, sf, "documents", "doc_id", *cols)


def _doc_sentences(spark, sf):
    return S.split_sentences(spread(_docs(spark, sf, "text")), "text", ["doc_id"], by_line=True)


@query
def doc_lines(spark, sf):
    """Document text split into lines."""
    return S.doc_lines(_docs(spark, sf, "text"))


@query
def lines_after_marker(spark, sf):
    """Lines from the first marker line on."""
    return S.lines_after_marker(_docs(spark, sf, "text"), LINE_MARKER)


@query
def sentence_min_words(spark, sf):
    """Sentences per document, and how many have >= 2 words."""
    s = _doc_sentences(spark, sf)
    return s.groupBy("doc_id").agg(
        F.count("*").alias("n_sentences"),
        F.count_if(TX.has_min_words(F.col("sentence"))).alias("n_kept"))


@query
def sentence_distinct(spark, sf):
    """Distinct sentences per document at their first position."""
    return S.first_occurrences(_doc_sentences(spark, sf), ["doc_id"])


@query
def keyword_filter(spark, sf):
    """Documents whose title has a keyword token."""
    d = _docs(spark, sf, "text").select("doc_id", TX.first_line(F.col("text")).alias("title"))
    return M.keyword_filter(d, F.col("title"), TITLE_KEYWORDS)


def _illustrated(spark, sf):
    """Pages with a gallery behind their content: 0 to 3 .png pictures and a .jpg by page_id."""
    p = load(spark, sf, "pages", "page_id", "url", "html")
    pics = [F.when(F.col("page_id") % 4 > i, F.concat(
        F.lit('<img alt="" src="'), F.col("url"), F.lit(f'/map{i}.png">'))).otherwise("") for i in range(3)]
    return p.withColumn("html", F.concat(
        F.col("html"), F.lit('<img src="/logo.jpg"><!-- <img src="/old.png"> -->'), *pics))


@query
def link_extract(spark, sf):
    """First and second link with a suffix, and the first two pictures, per page."""
    p = _illustrated(spark, sf)
    hits = H.links_with_suffix(F.col("html"), LINK_SUFFIX)
    pics = H.images_with_suffix(F.col("html"), ".png")
    return p.select("page_id",
                    F.try_element_at(pics, F.lit(1)).alias("picture_1"),
                    F.try_element_at(pics, F.lit(2)).alias("picture_2"),
                    F.try_element_at(hits, F.lit(1)).alias("link_1"),
                    F.try_element_at(hits, F.lit(2)).alias("link_2"),
                    F.size(H.links(F.col("html"))).alias("n_links"))


def _reference_lines(spark, sf):
    """A references section per page whose URL is broken across lines:
    whole on one line, split in two, or split with a stray space."""
    p = load(spark, sf, "pages", "page_id", "url")
    n = F.length("url")
    cut = (n / 2).cast("int")
    head, tail = F.substring("url", 1, cut), F.substr("url", cut + 1)
    variant = n % 3
    body = (F.when(variant == 2, F.concat(F.lit("See "), F.col("url"), F.lit("\nAccessed.")))
            .when(variant == 1, F.concat(F.lit("See "), head, F.lit("\n"), tail))
            .otherwise(F.concat(F.lit("See "), head, F.lit("\n "), tail)))
    return p.select(F.col("page_id").alias("doc_id"),
                    F.concat(F.lit("References\n"), body).alias("text"))


@query
def url_line_stitch(spark, sf):
    """URLs broken across lines, recovered against known pages."""
    known = load(spark, sf, "pages", "url")
    return S.url_line_stitch(_reference_lines(spark, sf), known)


@query
def reference_harvest(spark, sf):
    """Marker -> stitched URLs -> known pages -> their sentences."""
    known = load(spark, sf, "pages", "url")
    found = S.url_line_stitch(_reference_lines(spark, sf), known, marker="References")
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "url", "html"), carry=["url"])
    return found.join(sents, "url").select("doc_id", "line_no", "page_id", "para_pos", "sent_pos", "sentence")


# --- events <-> articles, posts, pages --------------------------------------

POSTS_PER_EVENT = 10
ARTICLES_PER_PAGE = 20
RELEVANCE_PAGE = 1
RADIUS_KM = 500.0


def _order_keys(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, sf, "customer", "c_custkey", "c_nationkey")
    c = c.join(_nation(spark, sf), c.c_nationkey == F.col("n_nationkey")).select("c_custkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", TF.day_key(F.col("o_orderdate")).alias("rupture_date"),
        F.col("n_name").alias("country"))


def _articles(spark, sf):
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
              "l_extendedprice")
    s = load(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    s = s.join(_nation(spark, sf), s.s_nationkey == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("article_id"),
        TF.day_key(F.col("l_shipdate")).alias("rupture_date"), F.col("n_name").alias("country"),
        F.col("l_extendedprice").alias("relevance"))


@query
def event_article_join(spark, sf):
    """Events x one page of 20 articles per (date, country)."""
    arts = M.top_n_per_key_articles(_articles(spark, sf), ["rupture_date", "country"],
                                    [F.desc("relevance"), F.asc("article_id")], ARTICLES_PER_PAGE)
    return (_order_keys(spark, sf).join(arts, ["rupture_date", "country"])
            .select("o_orderkey", "article_id", "rank"))


def _page_articles(spark, sf):
    """One article per page, on a (date, country) by page_id; every tenth
    points to an address that is no page."""
    p = load(spark, sf, "pages", "page_id", "url")
    n = _nation(spark, sf)
    day = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("page_id") * 37 % 2400).cast("int"))
    url = F.when(F.col("page_id") % 10 == 9, F.concat("url", F.lit("/gone"))).otherwise(F.col("url"))
    a = p.select(F.col("page_id").alias("article_id"), url.alias("url"), day.alias("rupture_date"),
                 (F.col("page_id") % 25).alias("_nation"), (F.col("page_id") % 97).alias("relevance"))
    return (a.join(n, F.col("_nation") == F.col("n_nationkey"))
            .select("article_id", "url", "rupture_date", F.col("n_name").alias("country"), "relevance"))


@query
def article_page_join(spark, sf):
    """Article list -> page content by URL (left join: some addresses are no page)."""
    pages = load(spark, sf, "pages", "url", "html").select("url", F.length("html").alias("n_html"))
    return (_page_articles(spark, sf).join(pages, "url", "left")
            .select("article_id", "url", "n_html", F.col("n_html").isNotNull().alias("has_page")))


def _event_sentences(spark, sf):
    """Sentences, boilerplate removed, of one page of articles per (date, country)
    that has an event: (rupture_date, country, article_id, para_pos, sent_pos, sentence)."""
    keys = ["rupture_date", "country"]
    top = M.top_n_per_key_articles(_page_articles(spark, sf), keys, [F.desc("relevance"), F.asc("article_id")],
                                   ARTICLES_PER_PAGE)
    top = top.join(_order_keys(spark, sf).select(*keys).distinct(), keys, "left_semi")
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "url", "html"), carry=["url"])
    sents = S.boilerplate_filter(sents, "page_id", "sentence", BOILERPLATE_MIN_PAGES)
    return top.join(sents, "url").select(*keys, "article_id", "para_pos", "sent_pos", "sentence")


@query
def event_page_sentences(spark, sf):
    """Event -> articles -> pages by URL -> article sentences."""
    return _event_sentences(spark, sf).withColumn("rupture_date", F.col("rupture_date").cast("string"))


def _bench_terms(spark, sf):
    """Benchmark items as events: all distinct tokens of the whole text are search terms."""
    b = load(spark, sf, "benchmark", "item_id", "text")
    return b.select("item_id", F.array_distinct(TX.tokens(F.col("text"))).alias("terms"))


POSTS_SINCE = "2024-01-10"
NEWS_SINCE = "2024-01-05"
NEWS_LANG = "en"


def _posts(spark, sf):
    """documents as landed posts: user, location, date, coordinates, content, retweet mark."""
    d = _docs(spark, sf, "text", "lang", "source")
    return d.select(F.col("doc_id").alias("post_id"), F.col("source").alias("user"), F.col("lang").alias("location"),
                    _doc_date().alias("date"),
                    F.array(derived_lon(F.col("doc_id")), derived_lat(F.col("doc_id"))).alias("coordinates"),
                    F.col("text").alias("content"), (F.col("doc_id") % 7 == 0).alias("is_retweet"))


def _doc_date():
    return F.timestamp_add("HOUR", F.col("doc_id") % 720, F.lit("2024-01-01").cast("timestamp_ntz"))


@query
def event_post_match(spark, sf):
    """Posts holding all of an event's terms, counted per event (0 without a hit)."""
    terms = _bench_terms(spark, sf)
    m = M.all_terms_match(terms, _posts(spark, sf), "item_id", "terms", "post_id", "content")
    n = m.groupBy("item_id").agg(F.count("*").alias("n_posts"))
    return terms.select("item_id").join(n, "item_id", "left").select("item_id", F.coalesce("n_posts", F.lit(0)).alias("n_posts"))


@query
def post_search(spark, sf):
    """Per event the newest 10 original posts since a date holding all terms, five fields."""
    hits = LD.search_posts(_posts(spark, sf), _bench_terms(spark, sf), "item_id", "terms", POSTS_SINCE, POSTS_PER_EVENT)
    return hits.select("item_id", "rank", "post_id", "user", "location", "date",
                       F.element_at("coordinates", 1).alias("longitude"),
                       F.element_at("coordinates", 2).alias("latitude"), "content")


def _phrases(spark, sf):
    """The first sentence of a benchmark item is its news phrase."""
    b = load(spark, sf, "benchmark", "item_id", "text")
    phrase = F.try_element_at(TX.line_sentences(F.col("text")), F.lit(1))
    return b.select("item_id", phrase.alias("phrase"), F.array_distinct(TX.tokens(phrase)).alias("terms"))


def _news(spark, sf):
    """documents as landed articles."""
    d = _docs(spark, sf, "text", "lang", "source")
    return d.select(F.col("doc_id").alias("article_id"), F.struct(F.col("source").alias("name")).alias("source"),
                    TX.first_line(F.col("text")).alias("title"),
                    F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
                    F.date_format(_doc_date(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
                    F.col("text").alias("content"), F.col("lang").alias("language"))


@query
def news_search(spark, sf):
    """Per event one result page of articles in a language since a date
    that hold the event's phrase, by tf-idf relevance."""
    return LD.search_news(_news(spark, sf), _phrases(spark, sf), "item_id", "phrase", "terms", NEWS_LANG,
                          NEWS_SINCE, RELEVANCE_PAGE, ARTICLES_PER_PAGE)


@query
def relevance_page(spark, sf):
    """K1: one tf-idf-ranked result page per query."""
    return M.relevance_page_bounded(_docs(spark, sf, "text"), _bench_terms(spark, sf), "doc_id", "text",
                                    "item_id", "terms", RELEVANCE_PAGE, ARTICLES_PER_PAGE)


@query
def geo_radius_join(spark, sf):
    """Posts within 500 km of each event."""
    s = load(spark, sf, "supplier", "s_suppkey").select(
        "s_suppkey", derived_lat(F.col("s_suppkey") * 7 + 3).alias("latitude"),
        derived_lon(F.col("s_suppkey") * 11 + 5).alias("longitude"))
    pairs = GO.within_radius(s, _customer_points(spark, sf), RADIUS_KM, "s_suppkey", "c_custkey")
    return pairs.withColumn("dist_km", F.round("dist_km", 3))


# --- impact charts ------------------------------------------------------------
# Detected label boxes derived from lineitem: event = order, chart by line
# status, x from the part key, w from quantity, h from line number, text =
# "<discount in percent>%", box order = line number.


def _boxes(spark, sf):
    li = load(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
              "l_discount", "l_linestatus")
    return li.select(
        F.col("l_orderkey").alias("event_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("fatality")).otherwise(F.lit("loss")).alias("chart"),
        F.col("l_linenumber").alias("box_order"),
        (F.col("l_partkey") % 640).cast("int").alias("x"), F.lit(0).alias("y"),
        (F.col("l_quantity") * 2).cast("int").alias("w"),
        (F.col("l_linenumber") * 4).alias("h"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")).alias("text"))


@query
def box_bucket(spark, sf):
    """Impact boxes -> 7 bins per event and chart."""
    b = IM.box_bins(_boxes(spark, sf), ["event_id", "chart"])
    return b.select("event_id", "chart", *[F.col("bins")[i].alias(f"b{i}") for i in range(7)])


@query
def impact_sentence(spark, sf):
    """Fatality and loss probability sentences."""
    return IM.impact_sentences(_boxes(spark, sf), ["event_id"]).select(
        "event_id", "fatality_text", "loss_text")


# --- classification, votes, sections, summaries ------------------------------


@query
def argmax_label(spark, sf):
    """First-max class of a score vector."""
    e = load(spark, sf, "embeddings", "vec_id", "embedding")
    logits = F.slice("embedding", 1, len(CLASS_NAMES))
    return e.select("vec_id", CL.argmax(logits).alias("pred_idx"),
                    CL.class_name(CL.argmax(logits)).alias("label"),
                    CL.argmax(F.col("embedding")).alias("argmax_all"))


LANG_CLASS = {"de": "buildings", "es": "infrastructure", "en": "other", "fr": "resilience"}


def _doc_votes(spark, sf):
    """Three rule classifiers per document, one vote row per (doc, model)."""
    d = _docs(spark, sf, "text", "lang")
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    by_words = F.element_at(names, (TX.word_count(F.col("text")) % 4 + 1).cast("int"))
    by_lang = F.try_element_at(F.create_map(*[F.lit(x) for kv in LANG_CLASS.items() for x in kv]), F.col("lang"))
    periods = F.length("text") - F.length(F.replace(F.col("text"), F.lit("."), F.lit("")))
    by_punct = F.element_at(names, (periods % 4 + 1).cast("int"))
    return d.select("doc_id", F.explode(F.array(by_words, by_lang, by_punct)).alias("label"))


@query
def majority_vote(spark, sf):
    """Most-voted class of three rule classifiers, with the label where there is one."""
    v = CL.majority_vote(_doc_votes(spark, sf), "doc_id")
    lab = load(spark, sf, "labels", "doc_id", "quality")
    return v.join(lab, "doc_id", "left")


#: Labels (16 bytes each) that go to the documents; with more, texts and labels meet by a shuffle.
SENT_LABELS = 1_000_000


def _sentence_model(spark, sf):
    """Naive Bayes over all labelled documents; class = 2 * quality + toxic."""
    lab = load(spark, sf, "labels", "doc_id", "quality", "toxic")
    lab = F.broadcast(lab) if lab.count() <= SENT_LABELS else lab
    rows = _docs(spark, sf, "text").join(lab, "doc_id").select(
        "text", (F.col("quality") * 2 + F.col("toxic")).alias("class"))
    return CL.fit_naive_bayes(rows, "text", "class")


@query
def sentence_classify(spark, sf):
    """Four-class Naive Bayes fitted on all labelled documents, applied to every page sentence."""
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "html"))
    keys = ["page_id", "para_pos", "sent_pos"]
    return CL.classify_sentences(_sentence_model(spark, sf), sents, keys).select(*keys, "pred_idx", "label")


SUMMARY_RATIO = 0.2
_POS = ["article_id", "para_pos", "sent_pos"]


def _sections(spark, sf):
    """Section summaries per (date, country): classified article sentences, top 20 % by TextRank."""
    keys = ["rupture_date", "country"]
    sents = CL.classify_sentences(_sentence_model(spark, sf), _event_sentences(spark, sf), [*keys, *_POS])
    return SM.label_sections(sents, keys, _POS, ratio=SUMMARY_RATIO)


@query
def label_sections(spark, sf):
    """Report sections per event key from classified, summarized article sentences."""
    return _sections(spark, sf).withColumn("rupture_date", F.col("rupture_date").cast("string"))


@query
def textrank_summary(spark, sf):
    """Top 20% sentences per language by TextRank."""
    p = load(spark, sf, "pages", "page_id", "url", "html")
    p = p.withColumn("lang", F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1))
    return SM.summarize(S.page_sentences(p, carry=["lang"]), ["lang"], ["page_id", "para_pos", "sent_pos"],
                        "sentence", ratio=SUMMARY_RATIO).withColumn("score", F.round("score", 6))


# --- activity over time, streaming, sinks ------------------------------------


HIT_TYPE = "error"
RUPTURE = "2024-01-10 00:00:00"
SESSION_GAP = "30 minutes"


def _hits(spark, sf):
    ev = load(spark, sf, "events", "ts", "user_id", "event_type")
    return ev.where(F.col("event_type") == HIT_TYPE)


@query
def tumbling_counts(spark, sf):
    """M3: hourly counts of hits."""
    return AC.window_counts(_hits(spark, sf), "ts", "1 hour")


@query
def sliding_counts(spark, sf):
    """M3: one-hour windows sliding by 15 minutes."""
    return AC.window_counts(_hits(spark, sf), "ts", "1 hour", "15 minutes")


@query
def session_bursts(spark, sf):
    """M4: bursts of hits per user split by 30 quiet minutes."""
    return AC.session_counts(_hits(spark, sf), "ts", SESSION_GAP, ["user_id"])


@query
def resilience_curve(spark, sf):
    """Baseline, t0, t1 and recovery per keyword curve."""
    ev = load(spark, sf, "events", "ts", "event_type")
    return AC.resilience_curve(ev, "ts", ["event_type"], RUPTURE)


@query
def stream_ingest_dedupe(spark, sf):
    """events replayed as a file stream, de-duplicated per (user, type,
    minute) within a watermark, written once by an availableNow run."""
    schema = load(spark, sf, "events").schema
    stream = (SI.read_landed(spark, sf, schema, glob="events.parquet")
              .select("user_id", "event_type", "ts")
              .withColumn("minute", F.date_trunc("minute", F.col("ts"))))
    dedup = SI.dedupe_stream(stream, "ts", ["user_id", "event_type", "minute"], "1 hour")
    out, ckpt = SI.scratch_path(spark, "stream-out"), SI.scratch_path(spark, "stream-ckpt")
    SI.run_available_now(dedup.select("user_id", "event_type", "minute"), out, ckpt)
    return spark.read.parquet(out).select(
        "user_id", "event_type", F.col("minute").cast("timestamp_ntz").alias("minute"))


STREAM_WATERMARK = "1 hour"


@query
def stream_window_counts(spark, sf):
    """M3: hourly error counts from a file-stream replay of events: watermarked
    windows in update mode, upserted by window, so the windows inside the
    watermark are counted too."""
    schema = load(spark, sf, "events").schema
    stream = (SI.read_landed(spark, sf, schema, glob="events.parquet")
              .where(F.col("event_type") == HIT_TYPE).select("ts"))
    agg = SW.windowed_counts(stream, "ts", "1 hour", watermark=STREAM_WATERMARK)
    agg = agg.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    out, ckpt = SI.scratch_path(spark, "stream-windows"), SI.scratch_path(spark, "stream-windows-ckpt")
    SI.upsert_batches(agg, out, ckpt, ["window_start"], "n", "day", output_mode="update")
    return spark.read.parquet(out).select("window_start", "window_end", "n")


@query
def stream_upsert(spark, sf):
    """Events replayed as a file stream into a latest-revision table per (user, type, day)."""
    schema = load(spark, sf, "events").schema
    stream = (SI.read_landed(spark, sf, schema, glob="events.parquet")
              .select("event_id", "ts", "user_id", "event_type", "value")
              .withColumn("day", F.date_format("ts", "yyyy-MM-dd")))
    out, ckpt = SI.scratch_path(spark, "stream-upsert"), SI.scratch_path(spark, "stream-upsert-ckpt")
    SI.upsert_batches(stream, out, ckpt, LOG_KEYS, "event_id", "day")
    back = spark.read.schema(stream.schema).option("basePath", out).parquet(out)
    return back.select("event_id", "ts", "user_id", "event_type", "value", "day")


@query
def log_merge(spark, sf):
    """The daily update as one job. A stored log (CSV, times as text) and a
    feed batch are merged partition by partition into the log, first row per
    log key; then the retention flag."""
    log = schemas.LOG
    flat = _flat(spark, sf).withColumn("rupture_time", F.date_trunc("second", F.col("rupture_time")).cast("timestamp_ntz"))
    stored = flat.where(F.col("rupture_time") < F.lit(LOG_SPLIT).cast("timestamp_ntz"))
    text_time = F.translate(TF.path_time(F.col("rupture_time")), "-_", "/ ")
    csv = SI.scratch_path(spark, "log-csv")
    stored.select(*[text_time.alias(c) if c == "rupture_time" else F.col(c) for c in log.names]).write.option(
        "header", True).csv(csv)
    old = FD.empty_log(spark).unionByName(FD.read_event_log(spark, csv, text_time=True))
    batch = flat.where(F.col("rupture_time") >= F.date_sub(F.lit(LOG_SPLIT).cast("date"), 5).cast("timestamp_ntz"))
    path, day = SI.scratch_path(spark, "log"), F.date_format("rupture_time", "yyyy-MM-dd")
    for rows in (old, batch.select(*log.names)):
        SK.merge_partitions(spark, path, rows.withColumn("day", day), schemas.LOG_KEYS, "ingest_seq", "day")
    merged = spark.read.schema(log).parquet(path)
    flagged = R.retention_flag(merged, LOG_ASOF, LOG_DAYS)
    return flagged.select("ingest_seq", "place", "country", "magnitude", "rupture_time", "alert", "collect_data")


LOG_ASOF, LOG_DAYS = "2024-01-25 00:00:00", 10


@query
def partitioned_sink(spark, sf):
    """Partitioned write (day, type) and read back."""
    ev = load(spark, sf, "events", "event_id", "ts", "event_type", "value")
    ev = ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    path = SI.scratch_path(spark, "by-day")
    SK.write_partitioned(ev.select("event_id", "value", "day", "event_type"), path, ["day", "event_type"])
    back = spark.read.option("basePath", path).parquet(path)
    return back.select("event_id", F.col("day").cast("string").alias("day"), "event_type", "value")


@query
def text_sink(spark, sf):
    """One sentence per line, in order, one folder per page group; one group is written twice."""
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "html"))
    rows = sents.withColumn("grp", F.col("page_id") % 8)
    path = SI.scratch_path(spark, "text-lines")
    order = ["page_id", "para_pos", "sent_pos"]
    SK.write_text_lines(rows, path, "sentence", ["grp"], order)
    SK.write_text_lines(rows.where("grp = 3"), path, "sentence", ["grp"], order)
    back = spark.read.option("basePath", path).text(path)
    return back.groupBy(F.col("grp").cast("long").alias("grp"), F.col("value").alias("sentence")).agg(
        F.count("*").alias("n"))


@query
def report_assemble(spark, sf):
    """One report row per event: narrative and region text, section summaries
    of its articles, impact text, picture links."""
    ev = N.event_narratives(_order_events(spark, sf), key="event_id", carry=["country", "rupture_time"])
    # The region page of a country: the page whose id is the nation's key.
    nation = _nation(spark, sf)
    keyed = _illustrated(spark, sf).join(nation, F.col("page_id") == F.col("n_nationkey"), "left_semi")
    region = S.page_text_concat(keyed)
    pics = H.images_with_suffix(F.col("html"), ".png")
    shown = keyed.select(
        "page_id", F.try_element_at(pics, F.lit(1)).alias("picture_1"),
        F.try_element_at(pics, F.lit(2)).alias("picture_2"))
    place = (nation.join(region, F.col("n_nationkey") == F.col("page_id"))
             .join(shown, "page_id").select(F.col("n_name").alias("country"), F.col("text").alias("region_text"),
                                            "picture_1", "picture_2"))
    ev = ev.withColumn("rupture_date", TF.day_key(F.col("rupture_time")))
    impact = IM.impact_sentences(_boxes(spark, sf), ["event_id"])
    return RP.assemble_reports(ev, "event_id", None, checkpoint(_sections(spark, sf)), impact, region_col="region_text",
                               picture_cols=["picture_1", "picture_2"], section_keys=["rupture_date", "country"], places=place)
