"""Pages and documents -> paragraphs, sentences, lines.

A page or document is one row, so everything *inside* it (paragraphs,
sentences, lines, "rows after the first marker line", "this line plus the
next") is array work on that row: no shuffle, no sort, no window. Shuffles
appear only where rows of different documents meet (boilerplate counting,
de-duplication, semi-joins against known URLs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import html as H
from hazardlake.functions import text as T
from hazardlake.operators.common import checkpoint, spread


def page_paragraphs(pages: DataFrame, key: str = "page_id", html_col: str = "html",
                    keep_empty: bool = False, carry: list[str] | None = None) -> DataFrame:
    """(key, para_pos, paragraph) for every ``<p>`` of every page.

    ``para_pos`` is the index of the ``<p>`` piece. Empty paragraphs are
    dropped inside the array (one evaluation of the cleaning regexes per
    piece; a row filter on the cleaned column would be pushed below the
    projection and evaluate them twice).
    """
    carry = list(carry or [])
    src = spread(pages.select(key, *carry, html_col))
    if keep_empty:
        return (src.select(key, *carry, F.posexplode(H.paragraph_pieces(F.col(html_col))).alias("para_pos", "piece"))
                .select(key, *carry, "para_pos", H.clean_fragment(F.col("piece")).alias("paragraph")))
    cleaned = F.transform(H.paragraph_pieces(F.col(html_col)),
                          lambda x, i: F.struct(i.alias("para_pos"), H.clean_fragment(x).alias("paragraph")))
    kept = F.filter(cleaned, lambda e: e["paragraph"] != "")
    return src.select(key, *carry, F.inline(kept))


def split_sentences(df: DataFrame, text_col: str, keys: list[str],
                    pos_col: str = "sent_pos", by_line: bool = False) -> DataFrame:
    """One row per sentence of ``text_col``; ``pos_col`` is 0-based.

    Narrow (no shuffle). Spread a source table before calling this when it
    arrives in too few splits (``common.spread``).
    """
    arr = T.line_sentences(F.col(text_col)) if by_line else T.sentences(F.col(text_col))
    return df.select(*keys, F.posexplode(arr).alias(pos_col, "sentence"))


def min_words(df: DataFrame, col: str = "sentence", n: int = 2) -> DataFrame:
    """Keep sentences with at least ``n`` space-separated pieces."""
    return df.where(T.has_min_words(F.col(col), n))


def page_sentences(pages: DataFrame, key: str = "page_id", html_col: str = "html",
                   min_word_count: int = 2, carry: list[str] | None = None) -> DataFrame:
    """(key, carry..., para_pos, sent_pos, sentence): the article text of each page."""
    # Empty paragraphs yield no sentences, so they need no separate filter.
    carry = list(carry or [])
    paras = page_paragraphs(pages, key, html_col, keep_empty=True, carry=carry)
    return min_words(split_sentences(paras, "paragraph", [key, *carry, "para_pos"]), "sentence",
                     min_word_count)


def normalized(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def boilerplate_filter(sentences: DataFrame, page_col: str = "page_id",
                       text_col: str = "sentence", min_pages: int = 3) -> DataFrame:
    """Drop sentences whose normalized text occurs on >= ``min_pages`` pages.

    Two partial aggregations (distinct (norm, page), then count per norm)
    keep a hot boilerplate line cheap: each map task ships one row per
    distinct (norm, page) it saw. The anti-join is skew-split by AQE.
    """
    # Extracted once: the written table is read by both sides of the join.
    with_norm = checkpoint(sentences.withColumn("_norm", normalized(F.col(text_col))))
    common = (with_norm.select("_norm", page_col).distinct()
              .groupBy("_norm").agg(F.count("*").alias("_pages"))
              .where(F.col("_pages") >= min_pages).select("_norm"))
    return with_norm.join(common, "_norm", "left_anti").drop("_norm")


def page_text_concat(pages: DataFrame, key: str = "page_id", html_col: str = "html",
                     sep: str = "") -> DataFrame:
    """(key, text): all paragraph texts of a page joined, in order."""
    return spread(pages).select(key, H.page_text(F.col(html_col), sep).alias("text"))


def first_occurrences(sentences: DataFrame, keys: list[str], pos_col: str = "sent_pos",
                      text_col: str = "sentence") -> DataFrame:
    """Distinct sentences per group, each at its first position."""
    return (sentences.groupBy(*keys, text_col).agg(F.min(pos_col).alias(pos_col))
            .select(*keys, pos_col, text_col))


def doc_lines(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, line_no, line): a text split into lines, 0-based."""
    return spread(docs).select(key, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))


def lines_after_marker(docs: DataFrame, marker: str, key: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Lines from the first line containing ``marker`` (inclusive) to the end.

    The running "seen the marker yet" flag is the 1-based index of the
    first matching line within the row's own line array.
    """
    lines = F.split(F.col(text_col), "\n")
    first = F.array_position(F.transform(lines, lambda l: F.instr(l, marker) > 0), True)
    return (spread(docs).select(key, lines.alias("_lines"), first.alias("_first"))
            .where(F.col("_first") > 0)
            .select(key, F.posexplode("_lines").alias("line_no", "line"), "_first")
            .where(F.col("line_no") >= F.col("_first") - 1)
            .drop("_first"))


def url_candidates(line: Column, next_line: Column) -> Column:
    """The six URL spellings tried for a line holding ``http``, in order:
    the tail, tail + next line, both without spaces, both with spaces as
    dots. (The intended rewrite; the source discarded its replace results.)
    """
    idx = F.instr(line, "http")
    tail = F.substr(line, idx)
    joined = F.concat(tail, F.coalesce(next_line, F.lit("")))
    return F.array(tail, joined,
                   F.replace(tail, F.lit(" "), F.lit("")), F.replace(joined, F.lit(" "), F.lit("")),
                   F.replace(tail, F.lit(" "), F.lit(".")), F.replace(joined, F.lit(" "), F.lit(".")))


def url_line_stitch(docs: DataFrame, known_urls: DataFrame, key: str = "doc_id",
                    text_col: str = "text", url_col: str = "url", marker: str | None = None) -> DataFrame:
    """Recover URLs broken across lines: (key, line_no, cand_no, url).

    Each line holding ``http`` yields six candidates built with its next
    line (array ``lead``); candidates are semi-joined against the known URL
    table (an equi-join, hash-partitioned on the URL) and the first
    candidate that exists wins per line (``min_by`` with partial
    aggregation). With ``marker`` only the lines from the first line that
    holds it count; a text without it has none.
    """
    lines = F.split(F.col(text_col), "\n")
    start = F.lit(1)
    if marker is not None:
        start = F.array_position(F.transform(lines, lambda l: F.contains(l, F.lit(marker))), True).cast("int")
    # (line, next line) pairs are built and filtered inside the row.
    pairs = F.zip_with("_lines", F.slice("_lines", F.lit(2), F.size("_lines")),
                       lambda x, y: F.struct(x.alias("line"), y.alias("next")))
    pairs = F.filter(F.transform(pairs, lambda p, i: F.struct(
        i.alias("line_no"), p["line"].alias("line"), p["next"].alias("next"))), lambda p: F.contains(p["line"], F.lit("http"))
        & (p["line_no"] >= F.col("_start") - 1))
    cands = (docs.select(key, lines.alias("_lines"), start.alias("_start")).where("_start > 0")
             .select(key, F.inline(pairs))
             .select(key, "line_no", F.posexplode(url_candidates(F.col("line"), F.col("next")))
                     .alias("cand_no", url_col)))
    known = known_urls.select(url_col).distinct()
    hits = cands.join(known, url_col, "left_semi")
    return (hits.groupBy(key, "line_no")
            .agg(F.min_by(F.struct("cand_no", url_col), "cand_no").alias("_m"))
            .select(key, "line_no", "_m.cand_no", F.col("_m." + url_col).alias(url_col)))
