"""Secret scan: fixed patterns plus character Markov models.

Fixed patterns give labelled samples: their values are random strings, all words
of all documents that overlap no match are ordinary identifiers, digits included. First-order character models of
both are counted, each smoothed towards the uniform distribution. A long token
outside all pattern matches is reported if its log-likelihood ratio per character
transition, random against ordinary, exceeds ``THRESHOLD``.

All work is built-in expressions. A text is searched inside its row; counts of
distinct words, summed map-side first, and transition counts are shuffled, and
at most 2 x 80 x 80 rows collected.

Positions are code points, end exclusive; a span is the whole match. A null text is empty. Where no
labelled random string exists, the random model is uniform.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in their order, pattern, group that holds the value, least length of the value.
PATTERNS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
#: Where a pattern has no prefix words, this equal but quicker test decides whether it is applied at all.
_QUICK = {"assign": PATTERNS[0][1], "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}
KINDS = [k for k, *_ in PATTERNS] + ["markov"]

MARKOV_CHARS = 20
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MARKOV_CHARS
#: Natural-log ratio per transition above which a token counts as random.
THRESHOLD = 0.35
#: Weight of the uniform prior, in transitions per character.
PRIOR = 40.0
_LOW, _SPAN = 43, 80   # code points '+' .. 'z'
SPAN_TYPE = "array<struct<start:long,rank:int,end:long>>"


def _running(items: Column, fields: dict[str, str], field: str, combine, backwards: bool = False) -> Column:
    """Structs of ``fields`` whose ``field`` becomes the combination of its own and all earlier (later) ones.

    By doubling: each pass combines with the element 1, 2, 4, ... places away, so n elements take log n passes.
    """
    kind = "struct<" + ",".join(f"{k}:{t}" for k, t in fields.items()) + ">"

    def double(a, shift):
        count = F.greatest(F.size(a) - shift, F.lit(0))
        if backwards:
            other = F.slice(a, shift + 1, count)
        else:
            other = F.concat(F.array_repeat(F.lit(None).cast(kind), shift), F.slice(a, F.lit(1), count))
        both = F.zip_with(a, other, lambda c, o: F.struct(*[
            (F.coalesce(combine(c[k], o[k]), c[k]) if k == field else c[k]).alias(k) for k in fields]))
        return F.when(shift < F.size(a), both).otherwise(a)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(31)]), items.cast(f"array<{kind}>"), double)


_STEP = {"at": "long", "m": "int", "v": "int", "token": "string"}
_MERGED = {"start": "long", "end": "long", "token": "string", "far": "long", "near": "long"}


def _found(text: Column, pattern: str, group: int) -> Column:
    """Per match: its end in the text, length, length of its ``group``, its text.

    The pieces between matches and the matches themselves, added up, give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    texts = F.zip_with(found, value, lambda m, v: F.struct(m.alias("token"), F.length(v).alias("v")))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(texts, gaps, lambda x, g: F.struct(
        (g + F.length(x["token"])).cast("long").alias("at"), F.length(x["token"]).alias("m"), x["v"].alias("v"),
        x["token"].alias("token")))
    return _running(F.filter(steps, lambda x: x["token"].isNotNull()), _STEP, "at", lambda a, b: a + b)


def _matches(text: Column, pattern: str, group: int, least: int, rank: int) -> Column:
    """Spans of all leftmost non-overlapping matches whose ``group`` has ``least`` characters."""
    return F.transform(F.filter(_found(text, pattern, group), lambda x: x["v"] >= least), lambda x: F.struct(
        (x["at"] - x["m"]).alias("start"), F.lit(rank).alias("rank"), x["at"].alias("end")))


def _free_tokens(text: Column, pattern: str, base: Column) -> Column:
    """(start, end, token, far, near) of the pattern's matches that overlap no span of ``base``.

    Matches and spans are merged by start; ``far`` is the largest end of the spans up to here, ``near`` the
    smallest start of those from here on.
    """
    none, never = F.lit(-1).cast("long"), F.lit((1 << 63) - 1)
    tokens = F.transform(_found(text, pattern, 0), lambda x: F.struct(
        (x["at"] - x["m"]).alias("start"), x["at"].alias("end"), x["token"].alias("token"), none.alias("far"), never.alias("near")))
    spans = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(None).cast("string").alias("token"),
                                                 s["end"].alias("far"), s["start"].alias("near")))
    merged = F.sort_array(F.concat(spans, tokens))
    known = _running(_running(merged, _MERGED, "far", F.greatest), _MERGED, "near", F.least, backwards=True)
    return F.filter(known, lambda x: x["token"].isNotNull() & (x["far"] <= x["start"]) & (x["near"] >= x["end"]))


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds one span array per fixed kind to documents (text never null)."""
    empty = F.array().cast(SPAN_TYPE)
    return docs.withColumns({
        kind: F.when(F.col("text").rlike(_QUICK[kind]), _matches(F.col("text"), pattern, group, least, rank))
        .otherwise(empty)
        for rank, (kind, pattern, group, least) in enumerate(PATTERNS)})


def ordinary_words(docs: DataFrame) -> DataFrame:
    """(token, n): the words of two or more characters that overlap no match of a fixed pattern, counted."""
    d = base_spans(docs).withColumn("base", F.sort_array(F.concat(*KINDS[:3])))
    words = F.when(F.size("base") == 0, F.split("text", r"[^A-Za-z0-9+/_=-]+")).otherwise(
        F.transform(_free_tokens(F.col("text"), r"[A-Za-z0-9+/_=-]+", F.col("base")), lambda t: t["token"]))
    return (d.select(F.explode(words).alias("token")).where(F.length("token") >= 2)
            .groupBy("token").agg(F.count("*").alias("n")))


def _transitions(tokens: DataFrame) -> DataFrame:
    """(a, b, n): counts of neighbouring characters over (token, n); others than '+'..'z' are left out."""
    chars = F.transform(F.split("token", ""), lambda c: F.ascii(c) - _LOW)
    pairs = tokens.select(chars.alias("c"), "n").select("n", F.explode(F.arrays_zip(
        F.slice("c", F.lit(1), F.size("c") - 1).alias("a"), F.slice("c", F.lit(2), F.size("c")).alias("b"))).alias("p"))
    return (pairs.select("p.a", "p.b", "n").where(f"a between 0 and {_SPAN - 1} and b between 0 and {_SPAN - 1}")
            .groupBy("a", "b").agg(F.sum("n").alias("n")))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios (random : ordinary) for each pair of characters, row by first character."""
    text = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    random = [text.where(F.col("text").rlike(_QUICK[kind]))
              .select(F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).alias("token"))
              .where(F.length("token") >= least) for kind, pattern, group, least in PATTERNS]
    values = random[0].unionByName(random[1]).unionByName(random[2]).withColumn("n", F.lit(1).cast("long"))
    counts = _transitions(values).withColumn("random", F.lit(1))
    counts = counts.unionByName(_transitions(ordinary_words(text)).withColumn("random", F.lit(0)))
    table = {(r.random, r.a, r.b): r.n for r in counts.collect()}   # at most 2 x 80 x 80 rows
    logs = counts_to_log(table)
    return logs


def counts_to_log(table: dict) -> list[float]:
    """Smoothed log ratios from {(random 0/1, a, b): count}."""
    import math
    out = []
    total = [[sum(table.get((k, a, b), 0) for b in range(_SPAN)) for a in range(_SPAN)] for k in (0, 1)]
    for a in range(_SPAN):
        for b in range(_SPAN):
            p, q = ((table.get((k, a, b), 0) + PRIOR / _SPAN) / (total[k][a] + PRIOR) for k in (1, 0))
            out.append(math.log(p / q))
    return out


def score(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of a token of the characters '+'..'z'."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratios)), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c) - _LOW)
    each = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes)),
                      lambda a, b: F.element_at(table, a * _SPAN + b + 1))
    total = F.aggregate(each, F.lit(0.0), lambda acc, x: acc + x)
    return total / (F.length(token) - 1)


def scan_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Per row of documents: n_assign, n_access, n_hex, n_markov, base (string) and spans (string).

    ``ratios``: a table from ``train``; trained on ``docs`` if not given.
    """
    ratios = ratios or train(docs)
    d = base_spans(docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")))
    d = d.withColumn("base", F.sort_array(F.concat(*KINDS[:3])))
    d = d.withColumn("free", F.when(F.col("text").rlike(TOKEN), _free_tokens(F.col("text"), TOKEN, F.col("base"))))
    random = F.transform(F.filter("free", lambda t: score(t["token"], ratios) > THRESHOLD), lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(PATTERNS)).alias("rank"), t["end"].alias("end")))
    d = d.withColumn("markov", F.when(F.size("free") > 0, random).otherwise(F.array().cast(SPAN_TYPE)))
    d = d.withColumn("all", F.sort_array(F.concat("base", "markov")))
    kinds = F.array(*map(F.lit, KINDS))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return d.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                    listed("base").alias("base"), listed("all").alias("spans"))
