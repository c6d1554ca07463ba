"""Models of language: sentence borders learned from the texts, votes of trained classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.operators import borders as B
from hazardlake.operators import voters as V
from hazardlake.plans import catalog as C
from hazardlake.plans.oracle import q
from hazardlake.plans.tables import load


def sentence_split_trained(spark, sf):
    """Sentences of all documents, whose commas became an abbreviation and one word an initial and a name."""
    text = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit(" ca. ")), F.lit(" of "), F.lit(" J. Ofer "))
    docs = load(spark, sf, "documents", "doc_id", "text").select("doc_id", text.alias("text"))
    return B.split_trained(B.train_borders(docs), docs, ["doc_id"])


def model_vote(spark, sf):
    """Classes of all documents by three classifiers trained on all labelled documents, and the most-voted class."""
    lab = load(spark, sf, "labels", "doc_id", "quality", "toxic")
    docs = C._docs(spark, sf, "text")
    rows = docs.join(lab, "doc_id").select("text", (F.col("quality") * 2 + F.col("toxic")).alias("class"))
    return V.vote(V.fit_voters(rows, "text", "class"), docs, "doc_id")


def _type(word: str) -> str:
    return f"regexp_replace(lower(regexp_extract({word}, {q(B.CORE_RE)}, 0)), '[0-9]+', '0', 'g')"


def _has(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, {q(pattern)})"


def _fit(k: str, n: str, p: str) -> str:
    return f"(CASE WHEN {k} > 0 THEN ({k}) * ln({p}) ELSE 0.0 END + CASE WHEN ({n}) - ({k}) > 0 THEN (({n}) - ({k})) * ln(1 - ({p})) ELSE 0.0 END)"


QUERIES = {"sentence_split_trained": sentence_split_trained, "model_vote": model_vote}
#: ``model_vote`` is trained by iteration and has no SQL.
ORACLE = {"sentence_split_trained": f"""
  WITH d AS (SELECT doc_id, replace(replace(text, ', ', ' ca. '), ' of ', ' J. Ofer ') AS text FROM documents),
  w0 AS (SELECT doc_id, regexp_extract_all(text, {q(B.WORD_RE)}, 0) AS ws FROM d),
  w1 AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM w0),
  w2 AS (SELECT doc_id, i, {_type('w')} AS type, {_has('w', B.DOT_RE)} AS dot, {_has('w', B.STOP_RE)} AS stop,
                {_has('w', B.UPPER_RE)} AS up, {_has('w', B.LOWER_RE)} AS low FROM w1),
  w3 AS (SELECT *, CASE WHEN i = 1 THEN '' ELSE lag(CASE WHEN dot THEN type WHEN stop THEN '' END) OVER (PARTITION BY doc_id ORDER BY i) END AS prev FROM w2),
  seen AS (SELECT type, dot, up, low, prev, count(*) AS n FROM w3 WHERE type <> '' GROUP BY ALL),
  tot AS (SELECT CAST(sum(n) AS DOUBLE) AS words, CAST(coalesce(sum(n) FILTER (WHERE dot), 0) AS DOUBLE) AS dots FROM seen),
  ty AS (SELECT type, CAST(sum(n) AS DOUBLE) AS c, CAST(coalesce(sum(n) FILTER (WHERE dot), 0) AS DOUBLE) AS d,
                coalesce(sum(n) FILTER (WHERE low), 0) AS nlow, coalesce(sum(n) FILTER (WHERE up AND prev IS NULL), 0) AS inner_up,
                CAST(length(replace(type, '.', '')) AS DOUBLE) AS letters FROM seen GROUP BY type),
  ab AS (SELECT type, {_has('type', B.INITIAL_RE)} AS initial FROM ty, tot WHERE d > 0 AND
         round(2 * ({_fit('d', 'c', str(B.STOP_CHANCE))} - {_fit('d', 'c', 'dots / words')}) * (length(type) - letters + 1)
               * exp(-letters - (c - d) * ln(letters)), {B.DIGITS}) >= {B.ABBREVIATION_SCORE}),
  op AS (SELECT type, CAST(sum(n) AS DOUBLE) AS k FROM seen WHERE prev IS NOT NULL AND prev NOT IN (SELECT type FROM ab) GROUP BY type),
  nb AS (SELECT sum(k) AS b FROM op),
  st AS (SELECT type FROM (SELECT type, k, c, b, words, k / b AS near, CASE WHEN words > b THEN (c - k) / (words - b) ELSE 0.0 END AS far
                           FROM op JOIN ty USING (type), nb, tot)
         WHERE near > far AND round(2 * ({_fit('k', 'b', 'near')} + {_fit('c - k', 'words - b', 'far')} - {_fit('k', 'b', 'c / words')}
                                       - {_fit('c - k', 'words - b', 'c / words')}), {B.DIGITS}) >= {B.STARTER_RATIO}),
  p0 AS (SELECT doc_id, regexp_extract_all(text, {q(B.PIECE_RE)}, 0) AS ps FROM d),
  p1 AS (SELECT doc_id, unnest(range(1, len(ps) + 1)) AS i, unnest(ps) AS p FROM p0),
  p2 AS (SELECT doc_id, i, p, regexp_extract_all(lag(p) OVER (PARTITION BY doc_id ORDER BY i), {q(B.WORD_RE)}, 0)[-1] AS last,
                regexp_extract(p, {q(B.WORD_RE)}, 0) AS nxt FROM p1),
  p3 AS (SELECT doc_id, i, p, CASE WHEN last IS NOT NULL AND nxt <> '' AND {_has('last', B.DOT_RE)} AND ab.type IS NOT NULL
                  AND NOT ({_has('nxt', B.UPPER_RE)} AND (st.type IS NOT NULL OR (NOT ab.initial AND ty.nlow > 0 AND ty.inner_up = 0))) THEN 0 ELSE 1 END AS cut
         FROM p2 LEFT JOIN ab ON ab.type = {_type('last')} LEFT JOIN st ON st.type = {_type('nxt')} LEFT JOIN ty ON ty.type = {_type('nxt')}),
  p4 AS (SELECT doc_id, i, p, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM p3),
  p5 AS (SELECT doc_id, s, regexp_extract(string_agg(p, '' ORDER BY i), {q(B.TRIMMED_RE)}, 0) AS sentence FROM p4 GROUP BY doc_id, s)
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS sent_pos, sentence
  FROM p5 WHERE sentence <> ''"""}
