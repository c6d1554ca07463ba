import math
import re

from hazardlake.operators import classify as CL


def test_argmax_first_max_and_names(spark):
    df = spark.createDataFrame([(1, [0.1, 0.9, 0.9, 0.2]), (2, [3.0, 1.0, 2.0, 3.0])], "id int, s array<double>")
    got = {r.id: (r.pred_idx, r.label) for r in CL.label_scores(df, "s").collect()}
    assert got == {1: (1, "infrastructure"), 2: (0, "buildings")}


def test_majority_vote_ties_go_to_declared_order(spark):
    votes = spark.createDataFrame([(1, "other"), (1, "resilience"), (1, "other"),
                                   (2, "resilience"), (2, "buildings"), (3, "other")], "id int, label string")
    got = {r.id: (r.label, r.votes) for r in CL.majority_vote(votes, "id").collect()}
    assert got == {1: ("other", 2), 2: ("buildings", 1), 3: ("other", 1)}


def test_naive_bayes_equals_its_formula(spark):
    train = [("the roof and walls collapsed", 0), ("walls of the building cracked", 0), ("power and water restored", 1),
             ("people recover and rebuild", 3), ("left out", 9), (None, 1)]
    sents = [(1, "walls collapsed"), (2, "water restored now"), (3, "people rebuild"), (4, "unknown words only"), (5, "?!")]
    model = CL.fit_naive_bayes(spark.createDataFrame(train, "text string, c int"), "text", "c")
    out = CL.classify_sentences(model, spark.createDataFrame(sents, "id int, sentence string"), ["id"])
    got = {r.id: r.pred_idx for r in out.collect()}
    docs = [[t for x, c in train if c == k and x for t in x.split()] for k in range(4)]
    size = [sum(c == k for _, c in train) for k in range(4)]
    vocab = len({t for d in docs for t in d})

    def best(s):
        toks = re.findall(r"[^\W_]+", s.lower())
        score = [round(math.log(size[k] / sum(size)) + sum(math.log(docs[k].count(t) + 1) for t in toks)
                       - len(toks) * math.log(len(docs[k]) + vocab), 6) if size[k] else -math.inf for k in range(4)]
        return score.index(max(score))

    assert got == {i: best(s) for i, s in sents} and got[1] == 0 and got[2] == 1 and 2 not in got.values()


def test_majority_vote_unknown_label_ranks_last(spark):
    votes = spark.createDataFrame([(1, "mystery"), (1, "other"), (2, "mystery")], "id int, label string")
    got = {r.id: (r.label, r.votes) for r in CL.majority_vote(votes, "id").collect()}
    assert got == {1: ("other", 1), 2: (None, 1)}


def test_majority_vote_with_more_classes_than_any_packing(spark):
    names = [f"c{i}" for i in range(1500)]
    votes = spark.createDataFrame([(1, "c1400"), (1, "c1400"), (1, "c3"), (2, "c1499"), (2, "c1000")], "id int, label string")
    got = {r.id: (r.label, r.votes) for r in CL.majority_vote(votes, "id", names=names).collect()}
    assert got == {1: ("c1400", 2), 2: ("c1000", 1)}


def test_texts_of_labelled_documents_stay_where_they_lie(spark, tmp_path, monkeypatch):
    """Up to a number of labels these go to the documents, not the texts to them; the same rows either way, repeated and null ids included."""
    from hazardlake.plans import catalog
    spark.createDataFrame([(1, "a b"), (2, "c"), (2, "d"), (3, None), (None, "e")], "doc_id bigint, text string").selectExpr(
        "*", "'en' lang", "'s' source", "1L n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 1), (1, 1, 1), (2, 1, 0), (3, 0, 0), (None, 0, 0), (9, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(catalog.CL, "fit_naive_bayes", lambda rows, *_: rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for most, how in ((100, "BroadcastHashJoin"), (5, "SortMergeJoin")):
            monkeypatch.setattr(catalog, "SENT_LABELS", most)
            rows = catalog._sentence_model(spark, str(tmp_path))
            assert how in rows._jdf.queryExecution().executedPlan().toString()
            found.append(sorted(map(repr, rows.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == found[1] and len(found[0]) == 5
