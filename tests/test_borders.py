import math
import re

import pytest

from conftest import rows
from hazardlake.operators import borders as B


def _learn_and_split(texts):
    """The same rule in plain Python: counts, two ratios, borders."""
    words = {k: re.findall(r"[^ \t-\r]+", t or "") for k, t in texts}

    def core(w):
        m = re.search(r"(?s)[^\W_](?:.*[^\W_])?", w)
        return re.sub("[0-9]+", "0", m.group().lower()) if m else ""

    def closes(w):
        return core(w) if re.search(r"""\.["')\]]*\Z""", w) else "" if re.search(r"""[.!?]["')\]]*\Z""", w) else None

    def first(w):
        c = next((x for x in w if x.isalnum()), "")
        return c

    seen = []
    for ws in words.values():
        for i, w in enumerate(ws):
            if core(w):
                seen.append((core(w), closes(w) is not None and bool(re.search(r"""\.["')\]]*\Z""", w)), first(w),
                             "" if i == 0 else closes(ws[i - 1])))
    total, dots = len(seen), sum(s[1] for s in seen)

    def ll(k, n, p):
        return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n - k else 0)

    types, abbr = {s[0] for s in seen}, set()
    for t in types:
        d, n = sum(s[1] for s in seen if s[0] == t), sum(s[0] == t for s in seen)
        size = len(t.replace(".", ""))
        if d and round(2 * (ll(d, n, 0.99) - ll(d, n, dots / total)) * (len(t) - size + 1)
                       * math.exp(-size - (n - d) * math.log(size)), 9) >= 0.3:
            abbr.add(t)
    opened = [s[0] for s in seen if s[3] is not None and s[3] not in abbr]
    starters = set()
    for t in set(opened):
        k, c, b = opened.count(t), sum(s[0] == t for s in seen), len(opened)
        p1, p2 = k / b, (c - k) / (total - b) if total > b else 0
        gain = 2 * (ll(k, b, p1) + ll(c - k, total - b, p2) - ll(k, b, c / total) - ll(c - k, total - b, c / total))
        if p1 > p2 and round(gain, 9) >= 30:
            starters.add(t)
    out = []
    for key, text in texts:
        parts, cur = [], ""
        pieces = re.findall(r"""(?s).+?(?:[.!?]+["')\]]*(?:[ \t-\r]+|\Z)|\Z)""", text or "")
        for i, p in enumerate(pieces):
            cur += p
            nxt = re.findall(r"[^ \t-\r]+", pieces[i + 1]) if i + 1 < len(pieces) else []
            last = re.findall(r"[^ \t-\r]+", p)
            hold = False
            if nxt and last and re.search(r"""\.["')\]]*\Z""", last[-1]) and core(last[-1]) in abbr:
                u, t = core(nxt[0]), core(last[-1])
                usual = (any(s[0] == u and s[2].islower() for s in seen)
                         and not any(s[0] == u and s[2].isupper() and s[3] is None for s in seen))
                hold = not (first(nxt[0]).isupper() and (u in starters or (usual and not (len(t) == 1 and t.isalpha()))))
            if not hold:
                parts.append(cur.strip(" \t\n\x0b\x0c\r"))
                cur = ""
        parts.append(cur.strip(" \t\n\x0b\x0c\r"))
        out += [(key, i, s) for i, s in enumerate(s for s in parts if s)]
    return out


STORY = ["The quake hit at 5 p.m. local time. The walls fell near St. Marc.", "He met Dr. Marin there. The road, e.g. the old one, was cut.",
         'She said "go." The men went!  The rest (approx. 20 men) stayed?', "We saw J. Peter and A. Marin. The sea rose ca. 2 m. It fell."]


@pytest.fixture(scope="module")
def texts():
    made = [(i, s + " " + STORY[(i * 7 + 1) % 4]) for i, s in enumerate(STORY * 12)]
    # Ordinary words also occur inside sentences, as in any larger text.
    made += [(50 + i, "There was time for the men over there and then they cut the stone and go on.") for i in range(20)]
    return made + [(100, ""), (101, None), (102, "..."), (103, " \n "), (104, "no mark at all\n"), (105, "Wait... what?! ca. it (etc.) "),
                   (106, "word " * 3000 + "ca. end. The"), (107, "42. 43. Über ca. Ende. the ca. 9")]


def test_split_equals_plain_python(spark, texts):
    df = spark.createDataFrame(texts, "id int, text string")
    model = B.train_borders(df)
    got = rows(B.split_trained(model, df, ["id"]), "id", "sent_pos", "sentence")
    assert got == sorted(_learn_and_split(texts))
    known = {r.type for r in model.abbreviations.collect()}
    assert {"ca", "p.m", "st", "dr", "j"} <= known and not {"there", "time", "the"} & known
    assert {r.type for r in model.openers.where("starter").collect()} >= {"the"}


def test_abbreviations_hold_and_starters_open(spark, texts):
    df = spark.createDataFrame(texts, "id int, text string")
    new = spark.createDataFrame([(1, "It rose ca. 5 m here. The dam broke at p.m. The end by J. Marin.")], "id int, text string")
    got = [r.sentence for r in B.split_trained(B.train_borders(df), new, ["id"]).orderBy("sent_pos").collect()]
    assert got == ["It rose ca. 5 m here.", "The dam broke at p.m.", "The end by J. Marin."]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "id int, text string")
    model = B.train_borders(empty)
    assert B.split_trained(model, empty, ["id"]).count() == 0
    one = spark.createDataFrame([(1, "A b. C d.")], "id int, text string")
    assert [r.sentence for r in B.split_trained(model, one, ["id"]).orderBy("sent_pos").collect()] == ["A b.", "C d."]


def test_words_are_counted_before_they_are_typed(spark):
    """Below the first count no word is lower-cased; null, empty and blank texts add nothing and give no sentence."""
    rows = [(1, "One. Two, e.g. two! 3 -- Two"), (2, None), (3, ""), (4, " \n\t "), (5, "One. Two?")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    found = B.word_contexts(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "lower(" not in plan[plan.rindex("Aggregate"):].split("\n", 1)[1]
    got = {(r["type"], r["dot"], r["upper"], r["lower"], r["prev"], r["n"]) for r in found.collect()}
    assert got == {("one", True, True, False, "", 2), ("two", False, True, False, "one", 2), ("e.g", True, False, True, None, 1),
                   ("two", False, False, True, "e.g", 1), ("0", False, False, False, "", 1), ("two", False, True, False, None, 1)}
    cut = B.split_trained(B.train_borders(df), df, ["doc_id"])
    assert {r.doc_id for r in cut.collect()} == {1, 5}
