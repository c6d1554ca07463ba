"""Matching events to posts and articles.

Text predicates that would be a non-equi join ("post contains every search
term of the event") run as an inverted-index equi-join: posts are exploded
to distinct (post, token) rows and joined on the token. Each event drives
the join with its *rarest* term, so a very common term ("the") never
multiplies the intermediate result; the remaining terms are counted on the
candidate pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.operators.common import bucketed_copy, checkpoint, drop_table, joined_in_place, spread, top_n_per_key

#: Impact blocks of a token, depth of the first round, and room for rounding in comparisons of bounds and scores.
BLOCKS, FIRST_DEPTH, SLACK = 24, 3, 1e-5

#: Rows of a table of queries or tokens that is broadcast.
SMALL = 100_000

def keyword_filter(df: DataFrame, text: Column, keywords: list[str],
                   case_sensitive: bool = False) -> DataFrame:
    """Rows whose whitespace tokens (punctuation attached) hit a keyword."""
    kws = keywords if case_sensitive else [k.lower() for k in keywords]
    toks = T.whitespace_tokens(text, lowercase=not case_sensitive)
    return df.where(F.arrays_overlap(toks, F.array(*[F.lit(k) for k in kws])))


def all_terms_match(events: DataFrame, posts: DataFrame, event_key: str, terms_col: str,
                    post_key: str, text_col: str) -> DataFrame:
    """(event_key, post_key) for every post holding all of the event's terms.

    ``terms_col`` is an array of lower-case tokens; an event without terms
    matches nothing. Posts are tokenised once: only tokens that occur in some
    event are kept, and written, as the inverted index. The rarest term of an
    event finds its candidates; a candidate holds all terms if the index has
    as many of them as the event.
    """
    terms = events.select(event_key, F.array_distinct(terms_col).alias("_terms")).where(F.size("_terms") > 0)
    asked = terms.select(event_key, F.size("_terms").alias("_want"), F.explode("_terms").alias("token"))
    idx = checkpoint(spread(posts.select(post_key, text_col))
                     .select(post_key, F.explode(F.array_distinct(T.tokens(F.col(text_col)))).alias("token"))
                     .join(asked.select("token").distinct(), "token", "left_semi"))
    term_df = idx.groupBy("token").agg(F.count("*").alias("_df"))
    driver = top_n_per_key(asked.join(term_df, "token", "left"), [event_key],
                           [F.coalesce("_df", F.lit(0)).asc(), F.asc("token")], 1).select(event_key, "token")
    cands = driver.join(idx, "token").select(event_key, post_key)
    held = cands.join(asked, event_key).join(idx, [post_key, "token"], "left_semi")
    return (held.groupBy(event_key, post_key).agg(F.count("*").alias("_have"), F.first("_want").alias("_want"))
            .where("_have = _want").select(event_key, post_key))


def first_n_posts(matches: DataFrame, event_key: str, order: list, n: int = 10) -> DataFrame:
    """The first ``n`` posts per event (the search API's page size)."""
    return top_n_per_key(matches, [event_key], order, n, rank_col="rank")


def _term_counts(docs: DataFrame, queries: DataFrame, doc_key: str, text_col: str,
                 query_key: str, terms_col: str):
    """(query, token) pairs and (doc, token, count) of the tokens that occur in some query."""
    q_terms = (queries.select(query_key, F.explode(F.array_distinct(terms_col)).alias("token"))
               .distinct())
    vocab = q_terms.select("token").distinct()
    toks = (spread(docs).select(doc_key, F.explode(T.tokens(F.col(text_col))).alias("token"))
            .join(vocab, "token", "left_semi"))
    return q_terms, toks.groupBy(doc_key, "token").agg(F.count("*").alias("_tf"))


def _postings(docs: DataFrame, queries: DataFrame, doc_key: str, text_col: str,
              query_key: str, terms_col: str):
    """(query, token) pairs and (token, doc, contribution) postings."""
    q_terms, counts = _term_counts(docs, queries, doc_key, text_col, query_key, terms_col)
    tf = checkpoint(counts)
    n_docs = docs.select(F.count("*").alias("_n"))
    dfreq = tf.groupBy("token").agg(F.count("*").alias("_df"))
    idf = dfreq.select("token", F.ln(n_docs.scalar() / F.col("_df")).alias("_idf"))
    post = tf.join(idf, "token").select("token", doc_key, (F.col("_tf") * F.col("_idf")).alias("_c"))
    return q_terms, post


def tfidf_scores(docs: DataFrame, queries: DataFrame, doc_key: str, text_col: str,
                 query_key: str, terms_col: str, only: DataFrame | None = None) -> DataFrame:
    """(query_key, doc_key, score) with score = sum tf(t, d) * ln(N / df(t)).

    With ``only`` (query_key, doc_key) just these pairs are scored.

    Only tokens that occur in some query survive the first (semi-)join, so
    the per-token work is bounded by the query vocabulary; N enters as a
    scalar subquery.
    """
    q_terms, post = _postings(docs, queries, doc_key, text_col, query_key, terms_col)
    scored = (q_terms.join(post, "token") if only is None
              else only.join(q_terms, query_key).join(post, [doc_key, "token"]))
    return scored.groupBy(query_key, doc_key).agg(F.sum("_c").alias("score"))


def relevance_page(scores: DataFrame, query_key: str, doc_key: str, page: int,
                   page_size: int = 20, digits: int = 6) -> DataFrame:
    """Page ``page`` (1-based) of each query's results by descending score.

    Scores are rounded before ranking so that float noise cannot reorder
    equal scores; ties go to the smaller document key.
    """
    s = scores.withColumn("score", F.round("score", digits))
    return top_n_per_key(s, [query_key], [F.desc("score"), F.asc(doc_key)], page_size,
                         rank_col="rank", offset=(page - 1) * page_size)


def top_n_per_key_articles(articles: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """One result page of articles per (date, country) search key."""
    return top_n_per_key(articles, keys, order, n, rank_col="rank")


def _small(df: DataFrame) -> DataFrame:
    """``df``, computed once, and broadcast where it has few rows."""
    df = checkpoint(df)
    return F.broadcast(df) if df.count() <= SMALL else df


def _impact_blocks(tf: DataFrame, n_docs: DataFrame, doc_key: str) -> tuple[DataFrame, DataFrame]:
    """Postings in impact-ordered blocks, and the largest contribution below each block.

    Block i of a token holds contributions within ``2^(-(i+1)/2)`` and ``2^(-i/2)`` of the token's largest one; the
    last one holds all smaller ones, zeros have a block of their own. The second table (token, block, next) has at
    most tokens x BLOCKS rows; a token without it has nothing left below the block. Contributions and
    blocks are computed from the counts at each reading; the postings stay where ``tf`` lies.
    """
    idf = F.ln(n_docs.scalar() / F.col("_df"))
    tops = _small(tf.groupBy("token").agg(F.count("*").alias("_df"), F.max("_tf").alias("_most"))
                  .select("token", idf.alias("_idf"), (F.col("_most") * idf).alias("_top")))
    block = F.when(F.col("_c") > 0, F.least(F.floor(2 * F.log2(F.col("_top") / F.col("_c"))), F.lit(BLOCKS - 1)))
    blocks = (tf.join(tops, "token").withColumn("_c", F.col("_tf") * F.col("_idf")).select("token", doc_key, "_c", F.coalesce(
        block, F.lit(BLOCKS)).cast("int").alias("_block")))
    best = blocks.groupBy("token", "_block").agg(F.max("_c").alias("_m")).where("_block > 0")
    below = (best.select("token", "_m", F.explode(F.sequence(F.lit(0), F.col("_block") - 1)).alias("_block"))
             .groupBy("token", "_block").agg(F.max("_m").alias("_next")))
    return blocks, below


def relevance_page_bounded(docs: DataFrame, queries: DataFrame, doc_key: str, text_col: str,
                           query_key: str, terms_col: str, page: int, page_size: int = 20,
                           digits: int = 6, trace: list | None = None) -> DataFrame:
    """Exactly ``relevance_page(tfidf_scores(...))`` by block-max pruning.

    Postings lie in impact-ordered blocks with a known maximum. Round by round every open query reads
    its tokens' blocks down to a depth. A document met there is scored in full only if what was read of it
    plus the maxima of the unread blocks of its other tokens can reach the query's k-th score so far. A document in
    no block read scores at most the sum of all next maxima: once that is below the k-th score, the
    query's page is proven and the query leaves. Otherwise the next depth is the least one whose sum is
    below the k-th score found. At the last depth everything has been read, so the result is whole in any case.
    Counts of terms lie bucketed by document, and queries come to them: reading, pruning and scoring move
    no posting and no pair, only each task's best k per query.
    ``trace`` collects the number of (query, document) pairs scored per round.
    """
    k = page * page_size
    spark = docs.sparkSession
    q_terms, counts = _term_counts(docs, queries, doc_key, text_col, query_key, terms_col)
    tf, table = bucketed_copy(counts, [doc_key], int(spark.conf.get("spark.sql.shuffle.partitions")), "counts_by_document")
    try:
        post, below = _impact_blocks(tf, docs.select(F.count("*").alias("_n")), doc_key)
        below = checkpoint(below)
        q_terms = checkpoint(q_terms.join(tf.select("token").distinct(), "token", "left_semi"))
        bounds = checkpoint(q_terms.join(below, "token").groupBy(query_key, "_block").agg(F.sum("_next").alias("_bound")))
        open_ = checkpoint(q_terms.select(query_key).distinct()
                           .select(query_key, F.lit(FIRST_DEPTH).alias("_depth"), F.lit(0.0).alias("_tau")))
        pages = None
        while not open_.isEmpty():
            asked = _small(q_terms.join(open_, query_key)
                           .join(below.withColumnRenamed("_block", "_depth"), ["token", "_depth"], "left")
                           .join(bounds.withColumnRenamed("_block", "_depth"), [query_key, "_depth"], "left")
                           .select(query_key, "token", "_depth", "_tau", F.coalesce("_next", F.lit(0.0)).alias("_next"),
                                   F.coalesce("_bound", F.lit(0.0)).alias("_bound")))
            read = (post.join(asked, "token").where("_block <= _depth").groupBy(query_key, doc_key)
                    .agg(F.sum("_c").alias("_have"), F.sum("_next").alias("_seen"), F.first("_bound").alias("_bound"),
                         F.first("_tau").alias("_tau")))
            able = (read.where(F.col("_have") + F.col("_bound") - F.col("_seen") >= F.col("_tau") - SLACK)
                    .select(query_key, doc_key))
            if trace is not None:
                able = checkpoint(able)
                trace.append(able.count())
            scored = (post.join(asked, "token").select(query_key, doc_key, "_c")
                      .join(able.hint("shuffle_hash"), [query_key, doc_key], "left_semi")
                      .groupBy(query_key, doc_key).agg(F.round(F.sum("_c"), digits).alias("score")))
            with joined_in_place(spark):
                top = checkpoint(top_n_per_key(scored, [query_key], [F.desc("score"), F.asc(doc_key)], k, rank_col="rank"))
            kth = top.where(F.col("rank") == k).select(query_key, F.col("score").alias("_kth"))
            state = open_.join(kth, query_key, "left")
            rest = (state.join(bounds, query_key, "left")
                    .groupBy(query_key, "_depth", "_kth")
                    .agg(F.max(F.expr("if(_block = _depth, _bound, null)")).alias("_now"),
                         F.max(F.expr(f"if(_bound >= _kth - {SLACK}, _block, null)")).alias("_last")))
            proven = (F.col("_depth") >= BLOCKS) | (F.coalesce("_now", F.lit(0.0)) < F.col("_kth") - SLACK)
            deeper = F.when(F.col("_kth").isNull(), F.col("_depth") + FIRST_DEPTH).otherwise(
                F.greatest(F.col("_last"), F.col("_depth")) + 1)
            rest = checkpoint(rest.select(query_key, F.least(deeper, F.lit(BLOCKS)).alias("_depth"),
                                          F.coalesce("_kth", F.lit(0.0)).alias("_tau"), F.coalesce(proven, F.lit(False)).alias("_proven")))
            done = top.join(rest.where("_proven").select(query_key), query_key, "left_semi")
            pages = done if pages is None else pages.unionByName(done)
            open_ = rest.where("not _proven").select(query_key, "_depth", "_tau")
    finally:
        drop_table(spark, table)
    if pages is None:
        return relevance_page(tfidf_scores(docs, queries, doc_key, text_col, query_key, terms_col), query_key, doc_key,
                              page, page_size, digits)
    return pages.where(F.col("rank") > (page - 1) * page_size).select(query_key, doc_key, "score", "rank")
