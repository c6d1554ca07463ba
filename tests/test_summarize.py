import math
import re

import numpy as np

from hazardlake.operators import summarize as SM

SENTS = [
    "The quake damaged many buildings in the city.",
    "Buildings collapsed after the quake struck.",
    "Power lines and roads were damaged.",
    "Rescue teams searched the damaged buildings.",
    "Completely unrelated sentence here.",
    "Roads reopened after repairs to power lines.",
    "The city began to recover quickly.",
]


def _brute_textrank(sents, d=0.85, iters=20, tolerance=1e-3, alone=0):
    """Scores by all pairs; ``alone`` more sentences have groups of their own and count in the mean change."""
    toks = [set(re.findall(r"[^\W_]+", s.lower())) for s in sents]
    n = len(sents)
    w = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            if i != j and len(toks[i]) * len(toks[j]) > 1:
                w[i, j] = len(toks[i] & toks[j]) / (math.log(len(toks[i])) + math.log(len(toks[j])))
    out = w.sum(axis=1)
    r = np.ones(n)
    for k in range(iters):
        x = np.where(out > 1e-12, r / np.where(out > 0, out, 1), 0.0)
        before, r = r, (1 - d) + d * (w.T @ x)
        if (np.abs(r - before).sum() + (d * alone if k == 0 else 0)) / (n + alone) <= tolerance:
            break
    return r


def test_factorised_textrank_equals_pairwise_pagerank(spark):
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate(SENTS)] + [("h", 0, "Alone here."), (None, 0, "Null group.")],
                               "grp string, id int, sentence string")
    got = {(r.grp, r.id): r.score for r in SM.textrank_scores(df, ["grp"], ["id"], "sentence", salt_buckets=3).collect()}
    want = _brute_textrank(SENTS, alone=2)
    for i in range(len(SENTS)):
        assert abs(got[("g", i)] - want[i]) < 1e-9
    assert abs(got[("h", 0)] - 0.15) < 1e-12 and abs(got[(None, 0)] - 0.15) < 1e-12


def test_single_word_sentences_have_edges_to_longer_ones_only(spark):
    sents = ["Quake!", "quake", "The quake struck.", "Struck the coast, the quake.", "Coast."]
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate(sents)], "grp string, id int, sentence string")
    got = {r.id: r.score for r in SM.textrank_scores(df, ["grp"], ["id"], "sentence", salt_buckets=2).collect()}
    want = _brute_textrank(sents)
    assert all(abs(got[i] - want[i]) < 1e-9 for i in range(len(sents)))


def test_steps_end_by_change(spark):
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate(SENTS)], "grp string, id int, sentence string")
    nodes = SM._nodes(df, ["grp"])
    ids = {r._id: r.id for r in nodes.select("_id", "id").collect()}
    want = _brute_textrank(SENTS, tolerance=3e-2)
    got = SM._scores(nodes, "sentence", 0.85, 50, None, tolerance=3e-2).collect()
    assert all(abs(r.score - want[ids[r._id]]) < 1e-9 for r in got)
    assert np.abs(want - _brute_textrank(SENTS, tolerance=0)).max() > 1e-6


def test_summary_is_subset_with_ceil_ratio_size(spark):
    rows = [("g", i, s) for i, s in enumerate(SENTS)] + [("g", 99, SENTS[0])] + [("one", 0, "Only one sentence.")] \
        + [("g", 50, "!!! ???")]                   # no tokens: score 1-d, still counts toward n
    rows += [(None, 0, "Null group first."), (None, 1, "Null group second.")]
    df = spark.createDataFrame(rows, "grp string, id int, sentence string")
    out = SM.summarize(df, ["grp"], ["id"], "sentence", ratio=0.3).collect()
    g = [r for r in out if r.grp == "g"]
    assert len(g) == math.ceil(0.3 * (len(SENTS) + 1))    # 8 distinct sentences -> 3
    assert {r.sentence for r in g} <= set(SENTS)
    assert 99 not in {r.id for r in g}                      # duplicates keep first position
    assert [r.sentence for r in out if r.grp == "one"] == ["Only one sentence."]
    assert len([r for r in out if r.grp is None]) == 1
    whole = SM.summarize(df, ["grp"], ["id"], "sentence", ratio=1.0).collect()
    assert len([r for r in whole if r.grp is None]) == 2


def test_positions_are_columns_not_packed_numbers(spark):
    rows = [(1, 0, i, f"sentence number {i} about thing {i % 7}") for i in range(1004)] + [(1, 1, 0, "another paragraph here")]
    df = spark.createDataFrame(rows, "page int, para int, sent int, sentence string")
    out = SM.summarize(df, ["page"], ["para", "sent"], "sentence", ratio=1.0).collect()
    assert {(r.para, r.sent) for r in out} == {r[1:3] for r in rows}


def test_label_sections_summarize_per_label(spark):
    rows = [(1, 0, "A b.", "buildings"), (1, 2, "C d.", "infrastructure "), (1, 1, "E f.", "buildings"), (1, 3, "G h.", "other")]
    df = spark.createDataFrame(rows, "doc_id int, sent_pos int, sentence string, label string")
    got = {r.section: (r.n_sentences, r.section_text) for r in SM.label_sections(df, ["doc_id"], ["sent_pos"], ratio=1.0).collect()}
    assert got == {"Buildings": (2, "A b. E f."), "Infrastructure": (1, "C d.")}
    many = spark.createDataFrame([(None, i, s, "buildings") for i, s in enumerate(SENTS)], df.schema)
    r = SM.label_sections(many, ["doc_id"], ["sent_pos"]).first()
    w = _brute_textrank(SENTS)
    best = sorted(sorted(range(len(SENTS)), key=lambda i: -round(w[i], 9))[:math.ceil(0.2 * len(SENTS))])
    assert r.doc_id is None and r.section_text == " ".join(SENTS[i] for i in best)


def test_a_step_moves_sums_of_cells_not_incidences(spark, monkeypatch):
    sents = [" ".join(f"w{(i // 10 ** k) % 10}{k}" for k in range(4)) for i in range(900)]
    laid, lay = [], SM.bucketed_copy

    def counted(df, *args):
        out = lay(df, *args)
        laid.append(out[0].count())
        return out

    monkeypatch.setattr(SM, "bucketed_copy", counted)
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate(sents)], "grp string, id int, sentence string")
    got = {r.id: r.score for r in SM.textrank_scores(df, ["grp"], ["id"], "sentence", salt_buckets=4).collect()}
    want = _brute_textrank(sents)
    assert all(abs(got[i] - want[i]) < 1e-9 for i in range(len(sents)))
    assert laid[0] == 4 * len(sents) and laid[1] <= 4 * 40


def test_small_groups_are_scored_whole_and_end_with_the_large_ones(spark, monkeypatch):
    """Groups taken whole, cut into pieces, and both at once: the scores of all pairs, ended by the mean change of all."""
    sents = [" ".join(f"w{(i // 10 ** k) % 10}{k}" for k in range(i % 4 + 1)) for i in range(120)]
    rows = [("large", i, s) for i, s in enumerate(sents)] + [("small", i, s) for i, s in enumerate(SENTS)] + [(None, i, s) for i, s in enumerate(SENTS[:3])]
    nodes = SM._nodes(spark.createDataFrame(rows + [("none", 0, "!?")], "grp string, id int, sentence string"), ["grp"])
    ids = {r._id: (r.grp, r.id) for r in nodes.select("_id", "grp", "id").collect()}
    laid, lay = [], SM.bucketed_copy
    monkeypatch.setattr(SM, "bucketed_copy", lambda *a: laid.append(a) or lay(*a))
    monkeypatch.setattr(SM, "KEPT_PAIRS", 50)
    for whole, layouts in ((10 ** 6, 0), (100, 2), (0, 2)):
        monkeypatch.setattr(SM, "WHOLE", whole)
        laid.clear()
        for tolerance in (2e-2, 0):
            at = {}
            for k in range(13):
                want = {(g, i): w for g in ("large", "small", None) for i, w in enumerate(
                    _brute_textrank([s for h, _, s in rows if h == g], iters=k, tolerance=-1))}
                if at and sum(abs(want[key] - at[key]) for key in want) / len(want) <= tolerance:
                    break
                at = want
            got = {ids[r._id]: r.score for r in SM._scores(nodes, "sentence", 0.85, 12, None, tolerance=tolerance).collect()}
            assert got.pop(("none", 0)) == 1 - 0.85
            assert all(abs(got[key] - want[key]) < 1e-9 for key in want) and got.keys() == want.keys()
        assert len(laid) == 2 * layouts
