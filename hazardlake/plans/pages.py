"""Paragraphs of the first ``div`` of a page and stored predictions, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.functions import html as H
from hazardlake.operators import classify as CL
from hazardlake.operators import sentences as S
from hazardlake.operators import sinks as SK
from hazardlake.plans import catalog as C
from hazardlake.plans.oracle import KEYS, PAGE_SENTENCES, classified, clean_fragment, pieces, q, rx
from hazardlake.plans.tables import load
from hazardlake.sources import feed as FD
from hazardlake.streaming import ingest as SI


def _nested(spark, sf):
    """Pages as they are, wrapped in nested divs with text around them, or inside a div that never closes, by page_id."""
    p = load(spark, sf, "pages", "page_id", "html")
    kind = F.col("page_id") % 3
    wrapped = F.concat(F.lit('</div><p>Before.</p><DIV class="a"><div><p>Lead</div><divider><p>Second.'), F.col("html"),
                       F.lit("</div><p>After.</p><div><p>Other.</p></div>"))
    open_ = F.concat(F.lit("<div\nid=x><p>Open <b>start</b>"), F.col("html"))
    return p.select("page_id", F.when(kind == 1, wrapped).when(kind == 2, open_).otherwise(F.col("html")).alias("html"))


def first_div_paragraphs(spark, sf):
    """Non-empty paragraphs inside the first div of every page, nested divs included."""
    inner = _nested(spark, sf).select("page_id", H.first_element(F.col("html")).alias("html")).where("html is not null")
    return S.page_paragraphs(inner)


PREDICTION_GROUPS = 8


def predictions_sink(spark, sf):
    """Classified page sentences written as quoted CSV, one folder per page group, and read back."""
    keys = ["page_id", "para_pos", "sent_pos"]
    sents = S.page_sentences(load(spark, sf, "pages", "page_id", "html"))
    rows = CL.classify_sentences(C._sentence_model(spark, sf), sents, keys).withColumn("grp", F.col("page_id") % PREDICTION_GROUPS)
    path = SI.scratch_path(spark, "predictions")
    SK.write_predictions(rows, path, ["grp"], keys)
    return FD.read_predictions_csv(spark, path).select(F.col("grp").cast("long").alias("grp"), "idx", "sentence", "label")


QUERIES = {"first_div_paragraphs": first_div_paragraphs, "predictions_sink": predictions_sink}
ORACLE = {"first_div_paragraphs": f"""
  WITH pg AS (SELECT page_id, CASE page_id % 3
      WHEN 1 THEN '</div><p>Before.</p><DIV class="a"><div><p>Lead</div><divider><p>Second.' || html || '</div><p>After.</p><div><p>Other.</p></div>'
      WHEN 2 THEN '<div' || chr(10) || 'id=x><p>Open <b>start</b>' || html ELSE html END AS html FROM pages),
  cl AS (SELECT page_id, {rx('html', H.NOISE_RE, ' ')} AS html FROM pg),
  sp AS (SELECT page_id, regexp_extract_all(html, {q(H.element_tag_re('div'))}, 0) AS tags,
                string_split_regex(html, {q(H.element_tag_re('div'))}) AS parts FROM cl),
  tg AS (SELECT page_id, unnest(range(1, len(tags) + 1)) AS i, unnest(tags) AS tag FROM sp),
  fi AS (SELECT page_id, min(i) AS first FROM tg WHERE tag NOT LIKE '</%' GROUP BY page_id),
  dp AS (SELECT page_id, i, first, sum(CASE WHEN tag LIKE '</%' THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth
         FROM tg JOIN fi USING (page_id) WHERE i >= first),
  st AS (SELECT page_id, min(i) FILTER (WHERE depth = 0) AS stop FROM dp GROUP BY page_id),
  inn AS (SELECT page_id, array_to_string(list_transform(range(first + 1, coalesce(stop, len(tags) + 1) + 1), lambda j: parts[j] ||
                 CASE WHEN j < coalesce(stop, len(tags) + 1) THEN coalesce(tags[j], '') ELSE '' END), '') AS html
          FROM sp JOIN fi USING (page_id) JOIN st USING (page_id))
  SELECT page_id, para_pos, paragraph FROM (
    SELECT page_id, para_pos, {clean_fragment('piece')} AS paragraph FROM (
      SELECT page_id, CAST(unnest(range(0, len(ps))) AS INTEGER) AS para_pos, unnest(ps) AS piece
      FROM (SELECT page_id, {pieces('html')} AS ps FROM inn)))
  WHERE paragraph <> ''""",
          "predictions_sink": f"""
  SELECT page_id % {PREDICTION_GROUPS} AS grp, CAST(row_number() OVER (PARTITION BY page_id % {PREDICTION_GROUPS} ORDER BY {KEYS}) - 1 AS INTEGER) AS idx,
         sentence, trim(label) AS label
  FROM ({classified(PAGE_SENTENCES, KEYS)})"""}
