"""Phrase search and per-event resilience against plain Python."""

import datetime as dt
import random
import re
import statistics

from hazardlake.operators import activity as AC
from hazardlake.operators import phrases as PH

TOKEN = re.compile(r"[^\W_]+")


def test_phrases_equal_plain_search(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["a", "b", "A,", "c.", "b!"]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "The  Quake-Haiti;quake haiti"), (None, "a b a b a")]
    asked = [(1, "a b"), (2, "A B A"), (3, "a"), (4, "quake haiti"), (5, ""), (6, None), (7, "c c c c"), (8, "missing a"), (9, "a a")]
    d = spark.createDataFrame(docs, "doc long, text string")
    p = spark.createDataFrame(asked, "k long, phrase string")
    got = sorted(((r.k, r.doc is None, r.doc or 0, r.n_hits, r.first_pos) for r in
                  PH.phrase_search(d, p, "doc", "text", "k", "phrase").where("doc is not null").collect()))
    want = []
    for k, phrase in asked:
        w = TOKEN.findall((phrase or "").lower())
        for i, text in docs:
            t = TOKEN.findall((text or "").lower())
            at = [j for j in range(len(t) - len(w) + 1) if w and t[j:j + len(w)] == w]
            if at and i is not None:
                want.append((k, False, i, len(at), at[0]))
    assert got == sorted(want)


def test_phrase_search_on_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc long, text string")
    p = spark.createDataFrame([(1, "a b")], "k long, phrase string")
    assert PH.phrase_search(d.limit(0), p, "doc", "text", "k", "phrase").collect() == []
    assert PH.phrase_search(d, p.limit(0), "doc", "text", "k", "phrase").collect() == []


def plain_curve(hours, before, after, k_sd=2.0, recover=6):
    y = [sum(h == k for h in hours) for k in range(-before, after)]
    m, sd = statistics.fmean(y[:before]), statistics.pstdev(y[:before])
    t0 = next((h for h in range(after) if y[before + h] > m + k_sd * sd), None)
    t1 = None if t0 is None else next((h for h in range(t0 + 1, after) if statistics.fmean(
        y[max(0, before + h - recover + 1):before + h + 1]) <= m), None)
    return (len(hours), round(m, 6), round(sd, 6), t0, t1, None if t1 is None else t1 - t0)


def test_event_resilience_equals_plain_curves(spark):
    rng = random.Random(4)
    base = dt.datetime(2024, 3, 1)
    posts = [(i, base + dt.timedelta(minutes=rng.randint(0, 20_000)), rng.choice(["power out", "road Power", "nothing", "road", "power power"]))
             for i in range(900)]
    posts += [(2000 + i, base + dt.timedelta(hours=100, minutes=i % 60), "power road") for i in range(120)]
    posts += [(3000, None, "power"), (3001, base + dt.timedelta(hours=50), None)]
    events = [(1, base + dt.timedelta(hours=99, minutes=59, seconds=30), ["power"]), (2, base + dt.timedelta(hours=60), ["road", "out", "road"]),
              (3, base + dt.timedelta(days=400), ["power"]), (4, base + dt.timedelta(hours=90), []), (5, None, ["power"]),
              (6, base + dt.timedelta(hours=90), ["absent"])]
    e = spark.createDataFrame(events, "k int, t timestamp_ntz, words array<string>")
    p = spark.createDataFrame(posts, "post int, at timestamp_ntz, body string")
    out = AC.event_resilience(e, p, "k", "t", "words", "post", "at", "body", before_h=48, after_h=60)
    got = {r.k: (r.n_hits, r.baseline_mean, r.baseline_sd, r.t0, r.t1, r.recovery_h) for r in out.collect()}
    want = {}
    for k, t, words in events:
        if t is not None:
            hours = [int((at - t) // dt.timedelta(hours=1)) for _, at, body in posts
                     if at is not None and set(TOKEN.findall((body or "").lower())) & set(words)]
            want[k] = plain_curve([h for h in hours if -48 <= h < 60], 48, 60)
    assert got == want
