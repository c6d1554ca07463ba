"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark plans; only the fixed values
and regex strings are shared, since both engines must use the same ones.
"""

from __future__ import annotations

from hazardlake.functions import html as H
from hazardlake.functions import text as T
from hazardlake.functions.lookups import HTML_ENTITIES
from hazardlake.operators import summarize as SM
from hazardlake.plans import catalog as C

ORACLE: dict[str, str] = {}


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def unescape(expr: str) -> str:
    for entity, char in HTML_ENTITIES:
        expr = f"replace({expr}, {q(entity)}, {q(char)})"
    return expr


def clean_fragment(expr: str) -> str:
    body = rx(expr, H.P_END_RE, "")
    body = rx(body, H.TAG_RE, " ")
    body = f"trim({rx(body, H.SPACE_RE, ' ')})"
    return unescape(body)


def pieces(html: str) -> str:
    return f"string_split_regex({rx(html, H.NOISE_RE, ' ')}, {q(H.P_OPEN_RE)})[2:]"


def sentences(expr: str) -> str:
    raw = f"regexp_extract_all({expr}, {q(T.SENTENCE_RE)}, 0)"
    stripped = f"list_transform({raw}, lambda s: {rx('s', T.STRIP_RE, '')})"
    return f"list_filter({stripped}, lambda s: s <> '')"


def line_sentences(expr: str) -> str:
    return f"flatten(list_transform(string_split({expr}, chr(10)), lambda l: {sentences('l')}))"


def min_words(expr: str, n: int = 2) -> str:
    return f"len(string_split({expr}, ' ')) >= {n}"


PARAGRAPHS = f"""
  SELECT page_id, para_pos, paragraph FROM (
    SELECT page_id, para_pos, {clean_fragment('piece')} AS paragraph FROM (
      SELECT page_id, CAST(unnest(range(0, len(ps))) AS INTEGER) AS para_pos, unnest(ps) AS piece
      FROM (SELECT page_id, {pieces('html')} AS ps FROM pages)))
  WHERE paragraph <> ''"""

PAGE_SENTENCES = f"""
  SELECT page_id, para_pos, sent_pos, sentence FROM (
    SELECT page_id, para_pos, CAST(unnest(range(0, len(ss))) AS INTEGER) AS sent_pos, unnest(ss) AS sentence
    FROM (SELECT page_id, para_pos, {sentences('paragraph')} AS ss FROM ({PARAGRAPHS})))
  WHERE {min_words('sentence')}"""

ORACLE["page_paragraphs"] = PARAGRAPHS
ORACLE["page_sentences"] = PAGE_SENTENCES

BOILERPLATE = f"""
  WITH s AS (SELECT *, lower(trim(regexp_replace(sentence, '\\s+', ' ', 'g'))) AS norm
             FROM ({PAGE_SENTENCES})),
  common AS (SELECT norm FROM s GROUP BY norm
             HAVING count(DISTINCT page_id) >= {C.BOILERPLATE_MIN_PAGES})
  SELECT page_id, para_pos, sent_pos, sentence FROM s
  WHERE norm NOT IN (SELECT norm FROM common)"""
ORACLE["boilerplate_filter"] = BOILERPLATE

ORACLE["page_text_concat"] = f"""
  SELECT page_id, array_to_string(list_transform({pieces('html')}, lambda p: {clean_fragment('p')}), '') AS text
  FROM pages"""


# --- event feed and event log ----------------------------------------------

FLAT = """
  SELECT event_id, place, string_split(place, ', ')[-1] AS country, value AS magnitude,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS rupture_time, event_type AS alert,
         CAST(k AS DOUBLE) AS longitude, CAST(user_id AS DOUBLE) / 10.0 AS latitude,
         value AS depth
  FROM (SELECT *, 'Site ' || CAST(user_id AS VARCHAR) || ', Region ' || CAST(k AS VARCHAR) AS place
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))"""
FLAT_COLS = ("event_id, place, country, magnitude, rupture_time, alert, longitude, "
             "latitude, depth")

ORACLE["feature_flatten"] = f"SELECT {FLAT_COLS} FROM ({FLAT})"
ORACLE["feed_filter"] = f"""
  SELECT {FLAT_COLS} FROM ({FLAT})
  WHERE magnitude >= {C.FEED_MIN_MAG} AND alert = {q(C.FEED_LEVEL)}
    AND rupture_time >= TIMESTAMP '{C.FEED_SINCE}'"""
LEVELS = ", ".join(q(x) for x in C.FEED_LEVELS)
ORACLE["feed_union_levels"] = f"""
  SELECT {FLAT_COLS} FROM ({FLAT})
  WHERE magnitude >= {C.FEED_MIN_MAG} AND alert IN ({LEVELS})
    AND rupture_time >= TIMESTAMP '{C.FEED_SINCE}'"""
ORACLE["count_by_level"] = f"""
  SELECT alert, count(*) AS n FROM ({FLAT})
  WHERE magnitude >= {C.FEED_MIN_MAG} AND alert IN ({LEVELS})
    AND rupture_time >= TIMESTAMP '{C.FEED_SINCE}'
  GROUP BY alert"""

LOG = "SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events"
ORACLE["dedupe_keep_first"] = f"""
  SELECT * FROM ({LOG})
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY event_id) = 1"""
STORED = f"SELECT * FROM ({LOG}) WHERE ts < TIMESTAMP '{C.LOG_SPLIT}'"
BATCH = f"SELECT * FROM ({LOG}) WHERE ts >= TIMESTAMP '{C.BATCH_START}'"
ORACLE["upsert_latest"] = f"""
  SELECT event_id, ts, user_id, event_type, value, day FROM (
    SELECT *, 0 AS src FROM ({STORED}) UNION ALL SELECT *, 1 AS src FROM ({BATCH}))
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day
                             ORDER BY event_id DESC, src DESC) = 1"""
ORACLE["append_new_only"] = f"""
  SELECT * FROM ({BATCH}) b WHERE NOT EXISTS (SELECT 1 FROM ({STORED}) s WHERE s.event_id = b.event_id)"""

BOUND = f"(TIMESTAMP '{C.RETENTION_ASOF}' - INTERVAL {C.RETENTION_DAYS} DAY)"
ORACLE["retention_flag"] = f"""
  SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate < {BOUND} THEN false ELSE true END AS collect_data
  FROM orders"""
ORACLE["active_events"] = f"""
  SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE NOT (o_orderdate < {BOUND})"""
ORACLE["event_day_key"] = """
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS rupture_date,
         strftime(o_orderdate, '%Y-%m-%d_%H:%M:%S') AS path_time
  FROM orders"""


# --- places, coordinates, zones ---------------------------------------------

from hazardlake.functions.lookups import COMPASS_WORDS  # noqa: E402

ABBREVS = "[" + ", ".join(q(k) for k in COMPASS_WORDS) + "]"


def place_expr(key: str, name: str, nation: str) -> str:
    return (f"CASE WHEN {key} % 10 = 0 THEN {name} || ', ' || {nation} "
            f"ELSE CAST({key} % 90 AS VARCHAR) || ' km ' || {ABBREVS}[{key} % 16 + 1] || ' of ' "
            f"|| {name} || ', ' || {nation} END")


def compass_case(expr: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in COMPASS_WORDS.items())
    return f"CASE {expr} {whens} END"


def lat_expr(key: str) -> str:
    return f"(CAST(({key} * 37) % 18001 AS DOUBLE) / 100.0 - 90.0)"


def lon_expr(key: str) -> str:
    return f"(CAST(({key} * 53) % 36001 AS DOUBLE) / 100.0 - 180.0)"


def deg(expr: str) -> str:
    return f"CAST(CAST(abs({expr}) AS DECIMAL(10,4)) AS VARCHAR)"


def coords(lat: str, lon: str) -> str:
    return (f"{deg(lat)} || '°' || CASE WHEN {lat} > 0 THEN 'N' ELSE 'S' END || ', ' || "
            f"{deg(lon)} || '°' || CASE WHEN {lon} > 0 THEN 'E' ELSE 'W' END")


PR = q(T.PLACE_RE)
SUPPLIER_PLACES = f"""
  SELECT s_suppkey, {place_expr('s_suppkey', 's_name', 'n_name')} AS place
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
ORACLE["country_extract"] = f"""
  SELECT s_suppkey, place, string_split(place, ', ')[-1] AS country FROM ({SUPPLIER_PLACES})"""
ORACLE["place_parse"] = f"""
  SELECT s_suppkey,
         CASE WHEN regexp_matches(place, {PR}) THEN CAST(regexp_extract(place, {PR}, 1) AS INTEGER) END AS distance_km,
         CASE WHEN regexp_matches(place, {PR}) THEN regexp_extract(place, {PR}, 2) END AS direction,
         CASE WHEN regexp_matches(place, {PR}) THEN regexp_extract(place, {PR}, 3) END AS city
  FROM ({SUPPLIER_PLACES})"""
ORACLE["compass_decode"] = f"""
  SELECT s_suppkey, direction, {compass_case('direction')} AS direction_name FROM (
    SELECT s_suppkey, CASE WHEN regexp_matches(place, {PR}) THEN regexp_extract(place, {PR}, 2) END AS direction
    FROM ({SUPPLIER_PLACES}))"""
ORACLE["hemisphere_format"] = f"""
  SELECT c_custkey, {coords('lat', 'lon')} AS coordinates
  FROM (SELECT c_custkey, {lat_expr('c_custkey')} AS lat, {lon_expr('c_custkey')} AS lon FROM customer)"""

ZONES_SQL = "(VALUES " + ", ".join(
    f"({q(z)}, {a}, {b}, {c}, {d})" for z, a, b, c, d in C.ZONES) + ") AS z(zone, lat_min, lat_max, lon_min, lon_max)"


def nautical(lon: str) -> str:
    h = f"CAST(round({lon} / 15) AS INTEGER)"
    return (f"CASE WHEN {h} = 0 THEN 'Etc/GMT' WHEN {h} > 0 THEN 'Etc/GMT-' || CAST({h} AS VARCHAR) "
            f"ELSE 'Etc/GMT+' || CAST(-{h} AS VARCHAR) END")


def zone_of(lat: str, lon: str) -> str:
    inside = (f"CASE WHEN lon_min <= lon_max THEN {lon} BETWEEN lon_min AND lon_max "
              f"ELSE {lon} >= lon_min OR {lon} <= lon_max END")
    width = "(lon_max - lon_min + CASE WHEN lon_min > lon_max THEN 360.0 ELSE 0.0 END)"
    return (f"coalesce((SELECT zone FROM {ZONES_SQL} WHERE {lat} BETWEEN lat_min AND lat_max AND {inside} "
            f"ORDER BY (lat_max - lat_min) * {width}, zone LIMIT 1), {nautical(lon)})")


CUST_POINTS = f"""
  SELECT c_custkey, c_name, c_nationkey, lat, lon, {zone_of('lat', 'lon')} AS tz FROM (
    SELECT c_custkey, c_name, c_nationkey, {lat_expr('c_custkey')} AS lat, {lon_expr('c_custkey')} AS lon
    FROM customer)"""
ORACLE["tz_range_join"] = f"SELECT c_custkey, tz FROM ({CUST_POINTS})"

ORDER_EVENTS = f"""
  SELECT o_orderkey AS event_id, o_orderdate AS rupture_time,
         {place_expr('o_orderkey', 'c_name', 'n_name')} AS place, n_name AS country, lat, lon, tz,
         CAST(o_orderkey % 91 AS DOUBLE) / 10.0 AS magnitude,
         CAST(o_orderkey % 7001 AS DOUBLE) / 100.0 AS depth
  FROM orders JOIN ({CUST_POINTS}) cp ON o_custkey = cp.c_custkey
  JOIN nation ON cp.c_nationkey = n_nationkey"""


def local_ts(ts: str, tz: str) -> str:
    return f"timezone(coalesce({tz}, 'UTC'), timezone('UTC', {ts}))"


ORACLE["local_time"] = f"""
  SELECT event_id AS o_orderkey, tz, {local_ts('rupture_time', 'tz')} AS local_time FROM ({ORDER_EVENTS})"""


def place_sentence(p: str) -> str:
    d = f"regexp_extract({p}, {PR}, 2)"
    return (f"CASE WHEN regexp_matches({p}, {PR}) THEN "
            f"CAST(CAST(regexp_extract({p}, {PR}, 1) AS INTEGER) AS VARCHAR) || ' km ' || "
            f"coalesce({compass_case(d)}, {d}) || ' of ' || regexp_extract({p}, {PR}, 3) ELSE {p} END")


ORACLE["event_narrative"] = f"""
  SELECT event_id, lt AS local_time,
    'On ' || strftime(lt, '%B %-d, %Y') || ', at approximately ' || strftime(lt, '%H:%M')
    || ' local time, a magnitude ' || CAST(CAST(magnitude AS DECIMAL(4,1)) AS VARCHAR)
    || ' earthquake, with a depth of ' || CAST(CAST(depth AS DECIMAL(8,2)) AS VARCHAR)
    || ' km, struck ' || {place_sentence('place')} || '. '
    || 'The coordinate of epicenter of the earthquake was ' || {coords('lat', 'lon')} || '.' AS narrative
  FROM (SELECT *, {local_ts('rupture_time', 'tz')} AS lt FROM ({ORDER_EVENTS}))"""

HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
ORACLE["url_derive"] = f"""
  SELECT page_id, url || '/shakemap/intensity' AS intensity_url, url || '/region-info' AS region_url,
         url || '/pager' AS pager_url, {HOST} || '+earthquake' AS post_query,
         '+("earthquake" AND "' || {HOST} || '")' AS news_query,
         'https://feed.example/query?format=geojson&starttime='
         || strftime(CAST(TIMESTAMP '{C.RETENTION_ASOF}' AS DATE) - {C.QUERY_DAYS}, '%Y-%m-%d')
         || '&minmagnitude={C.FEED_MIN_MAG}&alertlevel={C.FEED_LEVEL}&page=' || CAST(page_id AS VARCHAR) AS feed_query
  FROM pages"""


# --- documents: lines, sentences, keywords ---------------------------------

def positions(lst: str) -> str:
    return f"CAST(unnest(range(0, len({lst}))) AS INTEGER)"


DOC_LINES = f"""
  SELECT doc_id, {positions('ls')} AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)"""
ORACLE["doc_lines"] = DOC_LINES
ORACLE["lines_after_marker"] = f"""
  SELECT doc_id, line_no, line FROM (
    SELECT doc_id, {positions('ls')} AS line_no, unnest(ls) AS line, f FROM (
      SELECT doc_id, ls, list_position(list_transform(ls, lambda l: instr(l, {q(C.LINE_MARKER)}) > 0), true) AS f
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))
  WHERE f IS NOT NULL AND f > 0 AND line_no >= f - 1"""

DOC_SENTENCES = f"""
  SELECT doc_id, {positions('ss')} AS sent_pos, unnest(ss) AS sentence
  FROM (SELECT doc_id, {line_sentences('text')} AS ss FROM documents)"""
ORACLE["sentence_min_words"] = f"""
  SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (WHERE {min_words('sentence')}) AS n_kept
  FROM ({DOC_SENTENCES}) GROUP BY doc_id"""
ORACLE["sentence_distinct"] = f"""
  SELECT doc_id, min(sent_pos) AS sent_pos, sentence FROM ({DOC_SENTENCES}) GROUP BY doc_id, sentence"""

KW = "[" + ", ".join(q(k) for k in C.TITLE_KEYWORDS) + "]"


def title_hit(title: str) -> str:
    return f"list_has_any(string_split_regex(lower({title}), '\\s+'), {KW})"


ORACLE["keyword_filter"] = f"""
  SELECT doc_id, title FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents)
  WHERE {title_hit('title')}"""
ILLUSTRATED = """
  SELECT page_id, url, html || '<img src="/logo.jpg"><!-- <img src="/old.png"> -->' || """ + " || ".join(
    f"CASE WHEN page_id % 4 > {i} THEN '<img alt=\"\" src=\"' || url || '/map{i}.png\">' ELSE '' END" for i in range(3)) + """
    AS html FROM pages"""
PICS = (f"list_filter(regexp_extract_all({rx('html', H.NOISE_RE, ' ')}, {q(H.SRC_RE)}, 1), "
        f"lambda x: ends_with(x, '.png'))")
ORACLE["link_extract"] = f"""
  SELECT page_id, pics[1] AS picture_1, pics[2] AS picture_2, hits[1] AS link_1, hits[2] AS link_2,
         CAST(len(ls) AS INTEGER) AS n_links FROM (
    SELECT page_id, ls, pics, list_filter(ls, lambda x: ends_with(x, {q(C.LINK_SUFFIX)})) AS hits FROM (
      SELECT page_id, regexp_extract_all({rx('html', H.NOISE_RE, ' ')}, {q(H.HREF_RE)}, 1) AS ls, {PICS} AS pics
      FROM ({ILLUSTRATED})))"""

REF_DOCS = """
  SELECT page_id AS doc_id, 'References' || chr(10) || CASE
      WHEN n % 3 = 2 THEN 'See ' || url || chr(10) || 'Accessed.'
      WHEN n % 3 = 1 THEN 'See ' || substring(url, 1, cut) || chr(10) || substring(url, cut + 1)
      ELSE 'See ' || substring(url, 1, cut) || chr(10) || ' ' || substring(url, cut + 1) END AS text
  FROM (SELECT page_id, url, length(url) AS n, length(url) // 2 AS cut FROM pages)"""
ORACLE["url_line_stitch"] = f"""
  WITH l AS (SELECT doc_id, {positions('ls')} AS line_no, unnest(ls) AS line, ls
             FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM ({REF_DOCS}))),
  t AS (SELECT doc_id, line_no, substring(line, instr(line, 'http')) AS tail,
               substring(line, instr(line, 'http')) || coalesce(ls[line_no + 2], '') AS joined
        FROM l WHERE instr(line, 'http') > 0),
  c AS (SELECT doc_id, line_no, CAST(unnest(range(0, 6)) AS INTEGER) AS cand_no,
               unnest([tail, joined, replace(tail, ' ', ''), replace(joined, ' ', ''),
                       replace(tail, ' ', '.'), replace(joined, ' ', '.')]) AS url FROM t)
  SELECT doc_id, line_no, min(cand_no) AS cand_no, arg_min(url, cand_no) AS url
  FROM c WHERE url IN (SELECT url FROM pages) GROUP BY doc_id, line_no"""
ORACLE["reference_harvest"] = f"""
  SELECT f.doc_id, f.line_no, s.page_id, s.para_pos, s.sent_pos, s.sentence
  FROM ({ORACLE['url_line_stitch']}) f JOIN pages p ON p.url = f.url JOIN ({PAGE_SENTENCES}) s ON s.page_id = p.page_id"""


# --- events <-> articles, posts, pages --------------------------------------

ORACLE["event_article_join"] = f"""
  WITH ev AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS rupture_date, n_name AS country
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  ar AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS article_id,
                CAST(l_shipdate AS DATE) AS rupture_date, n_name AS country, l_extendedprice AS relevance
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
  top AS (SELECT *, row_number() OVER (PARTITION BY rupture_date, country
                                       ORDER BY relevance DESC, article_id) AS rk FROM ar QUALIFY rk <= {C.ARTICLES_PER_PAGE})
  SELECT o_orderkey, article_id, CAST(rk AS INTEGER) AS rank FROM ev JOIN top USING (rupture_date, country)"""
ARTICLES = """
  SELECT page_id AS article_id, CASE WHEN page_id % 10 = 9 THEN url || '/gone' ELSE url END AS url,
         DATE '1992-01-01' + CAST(page_id * 37 % 2400 AS INTEGER) AS rupture_date, n_name AS country,
         page_id % 97 AS relevance
  FROM pages JOIN nation ON page_id % 25 = n_nationkey"""
ORACLE["article_page_join"] = f"""
  SELECT article_id, a.url, CAST(length(html) AS INTEGER) AS n_html, html IS NOT NULL AS has_page
  FROM ({ARTICLES}) a LEFT JOIN pages p ON a.url = p.url"""
EVENT_SENTENCES = f"""
  WITH ev AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rupture_date, n_name AS country
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  top AS (SELECT * FROM ({ARTICLES})
          QUALIFY row_number() OVER (PARTITION BY rupture_date, country ORDER BY relevance DESC, article_id)
                  <= {C.ARTICLES_PER_PAGE}),
  sn AS ({BOILERPLATE})
  SELECT rupture_date, country, article_id, para_pos, sent_pos, sentence
  FROM top JOIN ev USING (rupture_date, country) JOIN pages ON pages.url = top.url
  JOIN sn ON sn.page_id = pages.page_id"""
ORACLE["event_page_sentences"] = f"""
  SELECT * REPLACE (strftime(rupture_date, '%Y-%m-%d') AS rupture_date) FROM ({EVENT_SENTENCES})"""

TOKENS = f"regexp_extract_all(lower(text), {q(T.TOKEN_RE)}, 0)"
BENCH_TERMS = f"SELECT item_id, list_distinct({TOKENS}) AS terms FROM benchmark"
DOC_DATE = "TIMESTAMP '2024-01-01' + (doc_id % 720) * INTERVAL 1 HOUR"
POSTS = f"SELECT doc_id AS post_id, source, lang, {DOC_DATE} AS date, text, list_distinct({TOKENS}) AS ptoks FROM documents"
MATCHES = f"""
  SELECT item_id, ps.* FROM ({BENCH_TERMS}) bt, ({POSTS}) ps
  WHERE len(terms) > 0 AND list_has_all(ptoks, terms)"""
ORACLE["event_post_match"] = f"""
  SELECT item_id, coalesce(n, 0) AS n_posts FROM benchmark
  LEFT JOIN (SELECT item_id, count(*) AS n FROM ({MATCHES}) GROUP BY item_id) USING (item_id)"""
ORACLE["post_search"] = f"""
  SELECT item_id, CAST(rk AS INTEGER) AS rank, post_id, source AS "user", lang AS location, date,
         {lon_expr('post_id')} AS longitude, {lat_expr('post_id')} AS latitude, text AS content FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY date DESC, post_id) AS rk FROM ({MATCHES})
    WHERE date >= TIMESTAMP '{C.POSTS_SINCE}' AND post_id % 7 <> 0)
  WHERE rk <= {C.POSTS_PER_EVENT}"""
RELEVANCE = f"""
  toks AS (SELECT doc_id, unnest({TOKENS}) AS token FROM d),
  tf AS (SELECT doc_id, token, count(*) AS tf FROM toks WHERE token IN (SELECT token FROM qt) GROUP BY ALL),
  dfreq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
  n AS (SELECT count(*) AS n FROM d),
  w AS (SELECT doc_id, token, tf * ln(n.n / df) AS w FROM tf JOIN dfreq USING (token), n)"""
PAGE = f"rk > {(C.RELEVANCE_PAGE - 1) * C.ARTICLES_PER_PAGE} AND rk <= {C.RELEVANCE_PAGE * C.ARTICLES_PER_PAGE}"
ORACLE["news_search"] = f"""
  WITH b AS (SELECT item_id, {line_sentences('text')}[1] AS phrase FROM benchmark),
  bt AS (SELECT item_id, phrase, list_distinct(regexp_extract_all(lower(phrase), {q(T.TOKEN_RE)}, 0)) AS terms FROM b),
  qt AS (SELECT DISTINCT item_id, unnest(terms) AS token FROM bt),
  d AS (SELECT *, list_distinct({TOKENS}) AS dtoks, strftime({DOC_DATE}, '%Y-%m-%d') AS date FROM documents
        WHERE lang = {q(C.NEWS_LANG)} AND strftime({DOC_DATE}, '%Y-%m-%d') >= {q(C.NEWS_SINCE)}),
  hits AS (SELECT item_id, doc_id FROM bt, d WHERE len(terms) > 0 AND list_has_all(dtoks, terms)
           AND contains(lower(text), lower(phrase))),
  {RELEVANCE},
  s AS (SELECT item_id, doc_id, round(sum(w), 6) AS score FROM hits JOIN qt USING (item_id) JOIN w USING (doc_id, token)
        GROUP BY ALL)
  SELECT item_id, CAST(rk AS INTEGER) AS rank, score, source AS source_name, split_part(text, chr(10), 1) AS title,
         'https://news.example/' || CAST(doc_id AS VARCHAR) AS url, date
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM s) JOIN d USING (doc_id)
  WHERE {PAGE}"""
ORACLE["relevance_page"] = f"""
  WITH qt AS (SELECT DISTINCT item_id, unnest(terms) AS token FROM ({BENCH_TERMS})),
  d AS (SELECT doc_id, text FROM documents), {RELEVANCE},
  s AS (SELECT item_id, doc_id, round(sum(w), 6) AS score FROM qt JOIN w USING (token) GROUP BY ALL)
  SELECT item_id, doc_id, score, CAST(rk AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM s)
  WHERE {PAGE}"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    from hazardlake.functions.geo import EARTH_RADIUS_KM
    return (f"({2 * EARTH_RADIUS_KM} * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")


ORACLE["geo_radius_join"] = f"""
  SELECT s_suppkey, c_custkey, round(d, 3) AS dist_km FROM (
    SELECT s_suppkey, c_custkey, {haversine('elat', 'elon', 'plat', 'plon')} AS d FROM
      (SELECT s_suppkey, {lat_expr('(s_suppkey * 7 + 3)')} AS elat, {lon_expr('(s_suppkey * 11 + 5)')} AS elon FROM supplier),
      (SELECT c_custkey, {lat_expr('c_custkey')} AS plat, {lon_expr('c_custkey')} AS plon FROM customer))
  WHERE d <= {C.RADIUS_KM}"""


# --- impact charts ------------------------------------------------------------

from hazardlake.functions import impact as I  # noqa: E402
from hazardlake.functions.lookups import (  # noqa: E402
    CLASS_NAMES, FATALITY_PREFIX, FATALITY_RANGES, IMPACT_X_THRESHOLDS, LOSS_PREFIX,
    LOSS_RANGES, PROBABILITY_PHRASE, SECTION_LABELS)

BOXES = """
  SELECT l_orderkey AS event_id, CASE WHEN l_linestatus = 'O' THEN 'fatality' ELSE 'loss' END AS chart,
         l_linenumber AS box_order, CAST(l_partkey % 640 AS INTEGER) AS x,
         CAST(l_quantity * 2 AS INTEGER) AS w, l_linenumber * 4 AS h,
         CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS text
  FROM lineitem"""
BIN = "CASE " + " ".join(f"WHEN x > {t} THEN {i}" for i, t in reversed(list(enumerate(IMPACT_X_THRESHOLDS, 1)))) + " ELSE 0 END"
LABELLED = f"""
  SELECT * FROM (
    SELECT event_id, chart, box_order, {BIN} AS bin,
           CASE WHEN instr(text, '%') > 0 THEN TRY_CAST(regexp_extract(text, {q(I.PERCENT_RE)}, 1) AS INTEGER) END AS v
    FROM ({BOXES}) WHERE w < 60 AND h < 20)
  WHERE v IS NOT NULL"""


def bin_value(b: int, extra: str = "") -> str:
    return f"coalesce(arg_max(v, row(box_order, v)) FILTER (WHERE bin = {b}{extra}), 0)"


ORACLE["box_bucket"] = f"""
  SELECT event_id, chart, {', '.join(f'{bin_value(b)} AS b{b}' for b in range(7))}
  FROM ({LABELLED}) GROUP BY event_id, chart"""


def sentence_sql(arr: str, prefix: str, ranges: list[str]) -> str:
    rl = "[" + ", ".join(q(r) for r in ranges) + "]"
    before, after = PROBABILITY_PHRASE.split("{}")
    ph = (f"list_filter(list_transform(range(1, 8), lambda i: CASE WHEN {arr}[i] <> 0 THEN "
          f"{rl}[i] || {q(before)} || CAST({arr}[i] AS VARCHAR) || {q(after)} END), lambda p: p IS NOT NULL)")
    return (f"CASE WHEN list_sum({arr}) = 0 OR len({ph}) = 0 THEN '' "
            f"WHEN len({ph}) = 1 THEN {q(prefix + ' ')} || {ph}[1] || '.' "
            f"ELSE {q(prefix + ' ')} || array_to_string({ph}[1:len({ph}) - 1], ', ') || ', and ' || {ph}[-1] || '.' END")


IMPACT = f"""
  SELECT event_id, {sentence_sql('fb', FATALITY_PREFIX, FATALITY_RANGES)} AS fatality_text,
         {sentence_sql('lb', LOSS_PREFIX, LOSS_RANGES)} AS loss_text FROM (
    SELECT event_id,
      [{', '.join(bin_value(b, " AND chart = 'fatality'") for b in range(7))}] AS fb,
      [{', '.join(bin_value(b, " AND chart = 'loss'") for b in range(7))}] AS lb
    FROM ({LABELLED}) GROUP BY event_id)"""
ORACLE["impact_sentence"] = IMPACT


# --- classification, votes, sections ----------------------------------------

NAMES = "[" + ", ".join(q(n) for n in CLASS_NAMES) + "]"
ORACLE["argmax_label"] = f"""
  SELECT vec_id, CAST(list_position(l, list_max(l)) - 1 AS BIGINT) AS pred_idx,
         {NAMES}[list_position(l, list_max(l))] AS label,
         CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax_all
  FROM (SELECT vec_id, embedding, embedding[1:{len(CLASS_NAMES)}] AS l FROM embeddings)"""

LANG_CASE = "CASE lang " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.LANG_CLASS.items()) + " END"
ORACLE["majority_vote"] = f"""
  WITH v AS (SELECT doc_id, unnest([{NAMES}[len(string_split(text, ' ')) % 4 + 1], {LANG_CASE},
                                    {NAMES}[(length(text) - length(replace(text, '.', ''))) % 4 + 1]]) AS label
             FROM documents),
  c AS (SELECT doc_id, label, count(*) AS votes FROM v GROUP BY ALL),
  best AS (SELECT doc_id, label, votes FROM c
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, list_position({NAMES}, label)) = 1)
  SELECT best.doc_id, label, votes, quality FROM best LEFT JOIN labels USING (doc_id)"""

SECTION_CASE = "CASE trim(label) " + " ".join(f"WHEN {q(lab)} THEN {q(sec)}" for sec, lab in SECTION_LABELS) + " END"


def classified(sents: str, keys: str) -> str:
    """Rows of ``sents`` with pred_idx and label: multinomial Naive Bayes over all labelled documents."""
    n = len(CLASS_NAMES)
    count = ", ".join(f"count(*) FILTER (WHERE c = {i}) AS c{i}" for i in range(n))
    total = ", ".join(f"sum(c{i}) AS t{i}" for i in range(n))
    each = ", ".join(f"sum(ln(coalesce(c{i}, 0) + 1.0)) AS s{i}" for i in range(n))
    score = ", ".join(f"CASE WHEN d{i} > 0 THEN round(ln(d{i} / d) + coalesce(s{i}, 0.0) - coalesce(n, 0) * "
                      f"ln(CAST(t{i} + v AS DOUBLE)), 6) ELSE CAST('-inf' AS DOUBLE) END" for i in range(n))
    return f"""
      WITH sn AS MATERIALIZED ({sents}),
      lab AS (SELECT quality * 2 + toxic AS c, text FROM labels JOIN documents USING (doc_id)),
      cnt AS MATERIALIZED (SELECT token, {count} FROM (SELECT c, unnest({TOKENS}) AS token FROM lab) GROUP BY token),
      tot AS (SELECT count(*) AS v, {total} FROM cnt),
      dc AS (SELECT CAST(count(*) AS DOUBLE) AS d, {", ".join(f"count(*) FILTER (WHERE c = {i}) AS d{i}" for i in range(n))} FROM lab),
      sc AS (SELECT {keys}, count(*) AS n, {each} FROM (
               SELECT {keys}, unnest(regexp_extract_all(lower(sentence), {q(T.TOKEN_RE)}, 0)) AS token FROM sn)
             LEFT JOIN cnt USING (token) GROUP BY {keys})
      SELECT sn.*, CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS pred_idx, {NAMES}[list_position(l, list_max(l))] AS label
      FROM (SELECT {keys}, [{score}] AS l FROM sn LEFT JOIN sc USING ({keys}), tot, dc) JOIN sn USING ({keys})"""


KEYS = "page_id, para_pos, sent_pos"
ORACLE["sentence_classify"] = f"SELECT {KEYS}, pred_idx, label FROM ({classified(PAGE_SENTENCES, KEYS)})"


def textrank(sents: str, keys: str, pos: str, ratio: float, iterations: int = SM.STEPS, damping: float = 0.85) -> str:
    """(keys, pos, sentence, score) of the top ratio of distinct sentences per group: PageRank over
    all sentence pairs, unrolled; a step after the change has become small changes nothing."""
    first = f"""
      SELECT row_number() OVER () AS nid, * FROM (
        SELECT * FROM ({sents}) QUALIFY row_number() OVER (PARTITION BY {keys}, sentence ORDER BY {pos}) = 1)"""
    toks = f"list_distinct(regexp_extract_all(lower(sentence), {q(T.TOKEN_RE)}, 0))"
    same = " AND ".join(f"a.{k.strip()} IS NOT DISTINCT FROM b.{k.strip()}" for k in keys.split(","))
    ctes = [
        f"s AS MATERIALIZED ({first})",
        f"inc AS MATERIALIZED (SELECT {keys}, nid, len(tk) AS n, unnest(tk) AS t "
        f"FROM (SELECT {keys}, nid, {toks} AS tk FROM s) WHERE len(tk) > 0)",
        f"p AS MATERIALIZED (SELECT a.nid AS i, b.nid AS j, count(*) / (ln(first(a.n)) + ln(first(b.n))) AS w "
        f"FROM inc a JOIN inc b ON a.t = b.t AND {same} WHERE a.nid <> b.nid AND a.n * b.n > 1 GROUP BY a.nid, b.nid)",
        "o AS MATERIALIZED (SELECT i, sum(w) AS w FROM p GROUP BY i)",
        "r0 AS MATERIALIZED (SELECT DISTINCT nid, 1.0 AS r FROM inc)",
        "d0 AS (SELECT 1.0 AS d)",
    ]
    for k in range(iterations):
        ctes += [
            f"u{k} AS MATERIALIZED (SELECT j AS nid, sum(p.w / o.w * r) AS su FROM p JOIN o USING (i) JOIN r{k} ON nid = i GROUP BY j)",
            f"r{k + 1} AS MATERIALIZED (SELECT nid, CASE WHEN (SELECT d FROM d{k}) <= {SM.TOLERANCE} THEN r ELSE {1 - damping} + "
            f"{damping} * coalesce(su, 0.0) END AS r FROM r{k} LEFT JOIN u{k} USING (nid))",
            f"d{k + 1} AS MATERIALIZED (SELECT avg(abs(a.r - b.r)) AS d FROM r{k} a JOIN r{k + 1} b USING (nid))",
        ]
    return "WITH " + ",\n".join(ctes) + f""",
      scored AS (SELECT s.*, coalesce(r, {1 - damping}) AS score, count(*) OVER (PARTITION BY {keys}) AS n
                 FROM s LEFT JOIN r{iterations} USING (nid))
      SELECT {keys}, {pos}, sentence, score FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY round(score, 9) DESC, {pos}) AS rk FROM scored)
      WHERE rk <= ceil(n * {ratio})"""


LANG_SENTENCES = f"""
  SELECT regexp_extract(p.url, '^https?://[^/]+/([a-z]{{2}})/', 1) AS lang, s.*
  FROM ({PAGE_SENTENCES}) s JOIN pages p ON p.page_id = s.page_id"""
ORACLE["textrank_summary"] = f"""
  SELECT lang, {KEYS}, sentence, round(score, 6) AS score
  FROM ({textrank(LANG_SENTENCES, 'lang', KEYS, C.SUMMARY_RATIO)})"""

EVENT_KEYS, EVENT_POS = "rupture_date, country", "article_id, para_pos, sent_pos"
LABELLED_SENTENCES = f"""
  SELECT * FROM (SELECT *, {SECTION_CASE} AS section
                 FROM ({classified(EVENT_SENTENCES, EVENT_KEYS + ', ' + EVENT_POS)}))
  WHERE section IS NOT NULL"""
SECTIONS = f"""
  SELECT {EVENT_KEYS}, section, count(*) AS n_sentences, string_agg(sentence, ' ' ORDER BY {EVENT_POS}) AS section_text
  FROM ({textrank(LABELLED_SENTENCES, EVENT_KEYS + ', section', EVENT_POS, C.SUMMARY_RATIO)})
  GROUP BY {EVENT_KEYS}, section"""
ORACLE["label_sections"] = f"SELECT * REPLACE (strftime(rupture_date, '%Y-%m-%d') AS rupture_date) FROM ({SECTIONS})"


# --- activity over time, streaming, sinks ------------------------------------

HITS = f"SELECT user_id, ts FROM events WHERE event_type = {q(C.HIT_TYPE)}"
ORACLE["tumbling_counts"] = f"""
  SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, count(*) AS n
  FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws FROM ({HITS})) GROUP BY ws"""
ORACLE["sliding_counts"] = f"""
  SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, count(*) AS n FROM (
    SELECT ts, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS ws
    FROM ({HITS}), range(0, 4) AS r(k))
  WHERE ws <= ts AND ts < ws + INTERVAL 1 HOUR GROUP BY ws"""
ORACLE["session_bursts"] = f"""
  WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL
                                       OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
             FROM ({HITS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
  FROM s GROUP BY user_id, sid"""
ORACLE["resilience_curve"] = f"""
  WITH hh AS (SELECT event_type, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '{C.RUPTURE}')) / 3600000000.0) AS INTEGER) AS h
              FROM events),
  spine AS (SELECT event_type, CAST(unnest(range(-72, last + 7)) AS INTEGER) AS h
            FROM (SELECT event_type, greatest(max(h), 0) AS last FROM hh GROUP BY event_type)),
  cnt AS (SELECT event_type, h, count(*) AS y FROM hh WHERE h >= -72 GROUP BY ALL),
  curve AS (SELECT s.event_type, s.h, CAST(coalesce(y, 0) AS DOUBLE) AS y FROM spine s LEFT JOIN cnt USING (event_type, h)),
  base AS (SELECT event_type, avg(y) AS m, stddev_pop(y) AS sd FROM curve WHERE h < 0 GROUP BY event_type),
  c AS (SELECT curve.*, m, sd, avg(y) OVER (PARTITION BY event_type ORDER BY h ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS trail
        FROM curve JOIN base USING (event_type)),
  t0 AS (SELECT event_type, min(h) AS t0 FROM c WHERE h >= 0 AND y > m + 2.0 * sd GROUP BY event_type),
  t1 AS (SELECT c.event_type, min(h) AS t1 FROM c JOIN t0 USING (event_type) WHERE h > t0 AND trail <= m GROUP BY c.event_type)
  SELECT base.event_type, round(m, 6) AS baseline_mean, round(sd, 6) AS baseline_sd, t0, t1, t1 - t0 AS recovery_h
  FROM base LEFT JOIN t0 USING (event_type) LEFT JOIN t1 USING (event_type)"""
ORACLE["stream_ingest_dedupe"] = """
  SELECT DISTINCT user_id, event_type, date_trunc('minute', ts) AS minute FROM events"""
ORACLE["stream_window_counts"] = ORACLE["tumbling_counts"]
ORACLE["stream_upsert"] = f"""
  SELECT event_id, ts, user_id, event_type, value, day FROM ({LOG})
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY event_id DESC) = 1"""
ORACLE["log_merge"] = f"""
  SELECT event_id AS ingest_seq, place, country, magnitude, rt AS rupture_time, alert,
         NOT (rt < TIMESTAMP '{C.LOG_ASOF}' - INTERVAL {C.LOG_DAYS} DAY) AS collect_data
  FROM (SELECT *, date_trunc('second', rupture_time) AS rt FROM ({FLAT}))
  QUALIFY row_number() OVER (PARTITION BY place, country, magnitude, rt ORDER BY event_id) = 1"""
ORACLE["partitioned_sink"] = """
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, event_type, value FROM events"""
ORACLE["text_sink"] = f"SELECT page_id % 8 AS grp, sentence, count(*) AS n FROM ({PAGE_SENTENCES}) GROUP BY ALL"

REGION = f"""
  SELECT n_name AS country, array_to_string(list_transform({pieces('html')}, lambda p: {clean_fragment('p')}), '') AS region_text,
         {PICS}[1] AS picture_1, {PICS}[2] AS picture_2
  FROM nation JOIN ({ILLUSTRATED}) ON n_nationkey = page_id"""
ORACLE["report_assemble"] = f"""
  WITH ev AS ({ORDER_EVENTS}), narr AS ({ORACLE['event_narrative']}), imp AS ({IMPACT}), reg AS ({REGION}),
  sec AS MATERIALIZED ({SECTIONS})
  SELECT ev.event_id, 'Earthquake Report for ' || ev.country || ' on ' || strftime(ev.rupture_time, '%Y-%m-%d') AS title,
         narr.narrative, concat_ws(chr(10) || chr(10), narr.narrative, nullif(reg.region_text, '')) AS hazard_text,
         reg.picture_1, reg.picture_2, coalesce(b.section_text, '') AS buildings_text,
         coalesce(i.section_text, '') AS infrastructure_text,
         coalesce(r.section_text, '') || chr(10) || chr(10) || coalesce(imp.loss_text, '') AS resilience_text,
         imp.fatality_text, imp.loss_text
  FROM ev LEFT JOIN narr ON narr.event_id = ev.event_id
  LEFT JOIN imp ON imp.event_id = ev.event_id LEFT JOIN reg ON reg.country = ev.country
  LEFT JOIN sec b ON b.country = ev.country AND b.rupture_date = CAST(ev.rupture_time AS DATE) AND b.section = 'Buildings'
  LEFT JOIN sec i ON i.country = ev.country AND i.rupture_date = CAST(ev.rupture_time AS DATE) AND i.section = 'Infrastructure'
  LEFT JOIN sec r ON r.country = ev.country AND r.rupture_date = CAST(ev.rupture_time AS DATE) AND r.section = 'Resilience'"""
