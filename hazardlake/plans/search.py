"""Phrase search and per-event resilience over posts, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.functions import text as TX
from hazardlake.operators import activity as AC
from hazardlake.operators import phrases as PH
from hazardlake.plans import catalog as C
from hazardlake.plans.oracle import DOC_DATE, TOKENS, line_sentences
from hazardlake.plans.tables import load


def phrase_search(spark, sf):
    """Documents that hold the first sentence of a benchmark item as consecutive words, with places."""
    docs = load(spark, sf, "documents", "doc_id", "text")
    return PH.phrase_search(docs, C._phrases(spark, sf), "doc_id", "text", "item_id", "phrase").select(
        "item_id", "doc_id", "n_hits", F.col("first_pos").cast("long").alias("first_pos"))


# A benchmark item as an event: its own time by item_id, and its first distinct words of five letters or more as keywords.
FIRST_HOUR, HOURS, EVENT_MINUTE = 24, 600, 30
KEYWORDS, KEYWORD_LETTERS = 3, 5
BEFORE_H, AFTER_H = 72, 120


def event_resilience(spark, sf):
    """Baseline, t0, t1 and recovery of every event from the posts with any of its keywords around its own time."""
    b = load(spark, sf, "benchmark", "item_id", "text")
    words = F.filter(F.array_distinct(TX.tokens(F.col("text"))), lambda w: F.length(w) >= KEYWORD_LETTERS)
    hour = F.col("item_id") * 37 % HOURS + FIRST_HOUR
    when = F.timestamp_add("MINUTE", hour * 60 + EVENT_MINUTE, F.lit("2024-01-01").cast("timestamp_ntz"))
    events = b.select("item_id", when.alias("rupture"), F.slice(words, 1, KEYWORDS).alias("keywords"))
    return AC.event_resilience(events, C._posts(spark, sf), "item_id", "rupture", "keywords", "post_id", "date", "content",
                               BEFORE_H, AFTER_H)


QUERIES = {"phrase_search": phrase_search, "event_resilience": event_resilience}
ORACLE = {
    "phrase_search": f"""
  WITH b AS (SELECT item_id, {line_sentences('text')}[1] AS text FROM benchmark),
  p AS (SELECT item_id, {TOKENS} AS words FROM b), d AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
  hit AS (SELECT item_id, doc_id, unnest(list_filter(range(1, len(toks) - len(words) + 2),
                                                      lambda i: toks[i:i + len(words) - 1] = words)) - 1 AS pos
          FROM p JOIN d ON len(words) > 0 AND list_has_all(toks, words))
  SELECT item_id, doc_id, count(*) AS n_hits, min(pos) AS first_pos FROM hit GROUP BY item_id, doc_id""",
    "event_resilience": f"""
  WITH ev AS (SELECT item_id, TIMESTAMP '2024-01-01' + ((item_id * 37 % {HOURS} + {FIRST_HOUR}) * 60 + {EVENT_MINUTE}) * INTERVAL 1 MINUTE AS t,
                     list_filter(list_distinct_kept, lambda w: length(w) >= {KEYWORD_LETTERS})[1:{KEYWORDS}] AS words
              FROM (SELECT item_id, list_transform(list_filter(list_zip(tk, range(1, len(tk) + 1)), lambda z: list_position(tk, z[1]) = z[2]),
                                                   lambda z: z[1]) AS list_distinct_kept
                    FROM (SELECT item_id, {TOKENS} AS tk FROM benchmark))),
  posts AS (SELECT doc_id, {DOC_DATE} AS made, list_distinct({TOKENS}) AS toks FROM documents),
  hits AS (SELECT item_id, CAST(floor((epoch_us(made) - epoch_us(t)) / 3600000000.0) AS INTEGER) AS h FROM ev JOIN posts
           ON made >= t - {BEFORE_H} * INTERVAL 1 HOUR AND made < t + {AFTER_H} * INTERVAL 1 HOUR AND list_has_any(toks, words)),
  spine AS (SELECT item_id, CAST(unnest(range(-{BEFORE_H}, {AFTER_H})) AS INTEGER) AS h FROM ev),
  cnt AS (SELECT item_id, h, count(*) AS y FROM hits GROUP BY ALL),
  curve AS (SELECT s.item_id, s.h, CAST(coalesce(y, 0) AS DOUBLE) AS y FROM spine s LEFT JOIN cnt USING (item_id, h)),
  base AS (SELECT item_id, avg(y) FILTER (WHERE h < 0) AS m, stddev_pop(y) FILTER (WHERE h < 0) AS sd, CAST(sum(y) AS BIGINT) AS n
           FROM curve GROUP BY item_id),
  c AS (SELECT curve.*, m, sd, avg(y) OVER (PARTITION BY item_id ORDER BY h ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS trail
        FROM curve JOIN base USING (item_id)),
  t0 AS (SELECT item_id, min(h) AS t0 FROM c WHERE h >= 0 AND y > m + 2.0 * sd GROUP BY item_id),
  t1 AS (SELECT c.item_id, min(h) AS t1 FROM c JOIN t0 USING (item_id) WHERE h > t0 AND trail <= m GROUP BY c.item_id)
  SELECT item_id, n AS n_hits, round(m, 6) AS baseline_mean, round(sd, 6) AS baseline_sd, t0, t1, t1 - t0 AS recovery_h
  FROM base LEFT JOIN t0 USING (item_id) LEFT JOIN t1 USING (item_id)""",
}
