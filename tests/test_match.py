import math
import re

from pyspark.sql import functions as F

from hazardlake.operators import match as M
from hazardlake.operators.common import rank_within_groups, top_n_per_key


def test_keyword_filter_case_and_attached_punctuation(spark):
    df = spark.createDataFrame([(1, "Earthquake hits town"), (2, "quake, then calm"), (3, "tremors felt")],
                               "id int, title string")
    kw = ["quake", "earthquake", "tremors"]
    assert sorted(r.id for r in M.keyword_filter(df, F.col("title"), kw).collect()) == [1, 3]
    assert sorted(r.id for r in M.keyword_filter(df, F.col("title"), kw, case_sensitive=True).collect()) == [3]


POSTS = ["Haiti earthquake today", "earthquake in Chile", "Haiti news", "the the the",
         "Quake? earthquake! HAITI", "nothing"]


def _tok(s):
    return set(re.findall(r"[^\W_]+", s.lower()))


def test_all_terms_match_equals_brute_force(spark):
    ev = spark.createDataFrame([(1, ["haiti", "earthquake"]), (2, ["the"]), (3, ["chile", "nope"])],
                               "eid int, terms array<string>")
    posts = spark.createDataFrame(list(enumerate(POSTS)), "pid int, text string")
    got = sorted(tuple(r) for r in M.all_terms_match(ev, posts, "eid", "terms", "pid", "text").collect())
    want = sorted((e, p) for e, terms in [(1, ["haiti", "earthquake"]), (2, ["the"]), (3, ["chile", "nope"])]
                  for p, t in enumerate(POSTS) if set(terms) <= _tok(t))
    assert got == want == [(1, 0), (1, 4), (2, 3)]


def test_tfidf_scores_equal_brute_force(spark):
    docs = list(enumerate(POSTS))
    q = [(1, ["haiti", "earthquake"]), (2, ["the"])]
    d = spark.createDataFrame(docs, "doc_id int, text string")
    qs = spark.createDataFrame(q, "qid int, terms array<string>")
    got = {(r.qid, r.doc_id): r.score for r in M.tfidf_scores(d, qs, "doc_id", "text", "qid", "terms").collect()}
    toks = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in docs}
    n = len(docs)
    want = {}
    for qid, terms in q:
        for i, tk in toks.items():
            s = sum(tk.count(t) * math.log(n / sum(1 for x in toks.values() if t in x))
                    for t in terms if t in tk)
            if any(t in tk for t in terms):
                want[(qid, i)] = s
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_relevance_page_offsets(spark):
    df = spark.createDataFrame([(1, i, float(100 - i)) for i in range(45)], "q int, d int, score double")
    p2 = M.relevance_page(df, "q", "d", page=2, page_size=20)
    assert sorted(r.d for r in p2.collect()) == list(range(20, 40))
    assert sorted(r.rank for r in p2.collect()) == list(range(21, 41))


def test_rank_within_groups_equals_window(spark):
    import random
    rnd = random.Random(3)
    data = [("hot" if i % 3 else f"g{i % 7}", i, rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, id int, s int").repartition(16)
    got = {(r.g, r.id): r._pos for r in rank_within_groups(df, ["g"], [F.desc("s"), F.asc("id")]).collect()}
    want = {}
    for g in {x[0] for x in data}:
        items = sorted([x for x in data if x[0] == g], key=lambda x: (-x[2], x[1]))
        for i, x in enumerate(items, 1):
            want[(g, x[1])] = i
    assert got == want


def test_top_n_per_key(spark):
    df = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 1)], "k string, v int")
    out = top_n_per_key(df, ["k"], [F.desc("v")], 3, rank_col="rank")
    assert sorted((r.k, r.v, r.rank) for r in out.collect()) == [("a", 27, 3), ("a", 28, 2), ("a", 29, 1), ("b", 1, 1)]


def test_bounded_relevance_page_equals_full(spark):
    import random
    rnd = random.Random(5)
    words = ["quake", "haiti", "chile", "power", "road", "the", "of", "rescue", "aid", "water"]
    docs = [(i, " ".join(rnd.choice(words[:5] if i % 4 else words) for _ in range(rnd.randint(1, 12))))
            for i in range(400)]
    qs = [(1, ["quake", "haiti"]), (2, ["the"]), (3, ["water", "aid", "road"]), (4, ["nothing"]), (5, ["of", "chile"])]
    d = spark.createDataFrame(docs, "doc_id int, text string")
    q = spark.createDataFrame(qs, "qid int, terms array<string>")
    for page, size in [(1, 5), (2, 5), (1, 50)]:
        full = M.relevance_page(M.tfidf_scores(d, q, "doc_id", "text", "qid", "terms"), "qid", "doc_id", page, size)
        fast = M.relevance_page_bounded(d, q, "doc_id", "text", "qid", "terms", page, size)
        cols = ["qid", "doc_id", "score", "rank"]
        assert sorted(tuple(r[c] for c in cols) for r in fast.collect()) == \
            sorted(tuple(r[c] for c in cols) for r in full.collect())


def test_block_max_pruning_scores_few_pairs(spark):
    import random
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(60)]
    weight = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rnd.choices(vocab, weight, k=int(rnd.paretovariate(0.7)) % 3000 + 1))) for i in range(1500)]
    qs = [(i, sorted(set(rnd.choices(vocab, weight, k=12)))) for i in range(12)] + [(99, ["absent"]), (98, [])]
    d = spark.createDataFrame(docs, "doc_id int, text string")
    q = spark.createDataFrame(qs, "qid int, terms array<string>")
    scores = M.tfidf_scores(d, q, "doc_id", "text", "qid", "terms")
    trace, cols = [], ["qid", "doc_id", "score", "rank"]
    fast = M.relevance_page_bounded(d, q, "doc_id", "text", "qid", "terms", 1, 20, trace=trace)
    full = M.relevance_page(scores, "qid", "doc_id", 1, 20)
    assert sorted(tuple(r[c] for c in cols) for r in fast.collect()) == sorted(tuple(r[c] for c in cols) for r in full.collect())
    assert sum(trace) < scores.count() / 5


def test_event_without_terms_and_posts_without_tokens(spark):
    ev = spark.createDataFrame([(1, []), (2, None), (3, ["the"])], "eid int, terms array<string>")
    posts = spark.createDataFrame([(0, None), (1, ""), (2, "the")], "pid int, text string")
    assert [tuple(r) for r in M.all_terms_match(ev, posts, "eid", "terms", "pid", "text").collect()] == [(3, 2)]


def test_bounded_relevance_page_moves_no_pairs(spark, monkeypatch):
    docs = [(i, " ".join(f"w{i % k}" for k in range(2, 9))) for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id int, text string")
    q = spark.createDataFrame([(1, ["w1", "w3"]), (2, ["w0", "w5", "w6"])], "qid int, terms array<string>")
    plans, write = [], M.checkpoint

    def planned(df):
        if "rank" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(M, "checkpoint", planned)
    cols = ["qid", "doc_id", "score", "rank"]
    fast = M.relevance_page_bounded(d, q, "doc_id", "text", "qid", "terms", 1, 20)
    full = M.relevance_page(M.tfidf_scores(d, q, "doc_id", "text", "qid", "terms"), "qid", "doc_id", 1, 20)
    assert sorted(tuple(r[c] for c in cols) for r in fast.collect()) == sorted(tuple(r[c] for c in cols) for r in full.collect())
    assert plans and not any(re.search(r"Exchange hashpartitioning\([^)]*doc_id", p) for p in plans)
