"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import quality_rules as Q
from hazardlake.llm.conversation_repair import damaged_and_repaired
from hazardlake.llm.decontaminate import decontaminate
from hazardlake.llm.html_extract import extract_main_text
from hazardlake.llm.line_dedup import remove_repeated_lines
from hazardlake.llm.mixing import mix_plan
from hazardlake.llm.near_dedup import near_duplicates
from hazardlake.llm.secret_scan import scan_secrets
from hazardlake.llm.sharding import shard_documents
from hazardlake.llm.simhash import simhash_duplicates
from hazardlake.llm.substring_dedup import remove_repeats
from hazardlake.llm.token_files import encode_documents
from hazardlake.llm.whitening import whiten
from hazardlake.plans.tables import load


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality signals of all documents and the verdict of rules with certified cutoffs."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return Q.quality_rules(docs, load(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "failed_rules")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in each document (five-word shingles, containment 0.8)."""
    return decontaminate(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents left after deleting later copies of repeated runs of two or more lines."""
    kept = remove_repeated_lines(load(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: fixed patterns plus spans of the character Markov models."""
    found = scan_secrets(load(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"),
                        "spans", "n_markov")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by balanced label propagation over equal texts."""
    return shard_documents(load(spark, sf_dir, "documents", "doc_id", "text"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash near-duplicate classes of all documents: 2-word shingles, similarity 0.8."""
    return near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"), shingle=2, percent=80)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token-id files with 64-bit offsets, read back from the files."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    return encode_documents(load(spark, sf_dir, "documents", "doc_id", "text"), tokenizer)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by composite text density."""
    return extract_main_text(load(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, and its first training position."""
    plan = mix_plan(load(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", "taken",
                       F.array_min("positions").alias("first_position"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after removing 50-word windows met in a smaller document."""
    kept = remove_repeats(load(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened onto the first four components of their distinct integer vectors."""
    return whiten(load(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=4, scale=256)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, at most two differing bits."""
    return simhash_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"), words=3, distance=2)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage by checksum."""
    return damaged_and_repaired(load(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_decontaminate, op3_line_dedup, op4_secret_scan, op5_sharding,
                             op6_near_dedup, op7_token_files, op8_html_text, op9_mixing, op10_substring_dedup,
                             op11_whitening, op12_simhash, op13_conversation_repair)
}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text"



def _quality_sql() -> str:
    """Signals, exact binomial bounds and verdicts, written from the definition."""
    n, order = len(Q.RULES), list(Q.RULES)
    value = {r: re.sub(r"try_divide\((\w+), (\w+)\)", r"(\1 / \2)", v) for r, (v, _) in Q.RULES.items()}
    grid = ", ".join(f"('{r}', {j}, {c})" for r, (_, cuts) in Q.RULES.items() for j, c in enumerate(cuts))
    values = ", ".join(f"{{'rule': '{r}', 'v': {value[r]}}}" for r in order)
    p = Q.ALPHA / n
    term = f"exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({p!r}) + (n - k) * ln(1 - {p!r}))"
    return f"""
  WITH d AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
  g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i,
               unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d),
  rep AS (SELECT doc_id, count(DISTINCT i + o) AS r
          FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g), range(0, 5) AS x(o)
          WHERE c > 1 GROUP BY doc_id),
  sig AS (SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                 len(list_distinct(w)) AS n_distinct_words, coalesce(r, 0) AS n_repeat_words
          FROM (SELECT *, list_filter(string_split(t, chr(10)),
                                      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d)
          LEFT JOIN rep USING (doc_id)),
  b AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.REPEAT_PERCENT} * n_words AS base_failed FROM sig),
  v AS (SELECT doc_id, stratum, unnest([{values}], recursive := true) FROM b WHERE NOT base_failed),
  good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
  grid AS (SELECT * FROM (VALUES {grid}) AS c(rule, j, cutoff)),
  cnt AS (SELECT stratum, rule, j, cutoff, count(*) AS n, count(*) FILTER (WHERE v > cutoff) AS rejected
          FROM v JOIN grid USING (rule) WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY ALL),
  lev AS (SELECT {Q.DELTA} / greatest(1, {n} * count(*)) AS level FROM (SELECT DISTINCT stratum FROM cnt)),
  pk AS (SELECT n, k, sum({term}) OVER (PARTITION BY n ORDER BY k) AS cdf
         FROM (SELECT n, unnest(range(0, least(CAST(floor(n * {p!r}) AS BIGINT), n - 1) + 1)) AS k
               FROM (SELECT DISTINCT n FROM cnt))),
  ok AS (SELECT n, max(k) FILTER (WHERE cdf <= level) AS allowed FROM pk, lev GROUP BY n),
  cuts AS (SELECT stratum, rule, arg_max(cutoff, j) AS cutoff FROM cnt JOIN ok USING (n)
           WHERE rejected <= allowed GROUP BY stratum, rule),
  bad AS (SELECT v.doc_id, string_agg(v.rule, ',' ORDER BY list_position({order!r}, v.rule)) AS failed_rules
          FROM v JOIN cuts c ON c.rule = v.rule AND c.stratum IS NOT DISTINCT FROM v.stratum
          WHERE v.v > c.cutoff GROUP BY v.doc_id)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules
  FROM b LEFT JOIN bad USING (doc_id)"""


def _repair_sql() -> str:
    """Damage, faults and the repair as a backward recursion over rows; a state's value is (cost, letters, lines)."""
    bits = ("list_reduce(list_prepend(xor(a, c), range(8)), "
            "lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)")
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    crc = f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split({key}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, c: {bits}), 4294967295)"""
    to, given = (2, 2, 3, 2), ("user:", "user:", "assistant:", "user:")

    def edge(letter: str, cost: str, v: str, line: str = "") -> str:
        lines = f"list_prepend({line}, {v}.o)" if line else f"{v}.o"
        return f"{{'c': {v}.c + {cost}, 'a': '{letter}' || {v}.a, 'o': {lines}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def relaxed(before: str) -> str:
        def once(source: str) -> str:
            ins = [edge("I", "5", f"{source}{to[q]}", "'" + given[q] + "'") for q in range(4)]
            return ", ".join(f"{least(f'v{q}', ins[q])} AS w{q}" for q in range(4))
        one = once("v")
        two = once("w").replace(" AS w", " AS x")
        return (f"SELECT conv_id, i, x0 AS q0, x1 AS q1, x2 AS q2, x3 AS q3 FROM "
                f"(SELECT *, {two} FROM (SELECT *, {one} FROM ({before})))")

    def stepped(q: int) -> str:
        free = "fault NOT IN ('blank', 'duplicate')"
        late = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        role = given[q][:-1]
        keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[q]
        options = [edge("D", "2", f"q{q}")]
        options.append(f"CASE WHEN {free} THEN {edge('R', '1 + ' + late, f'q{to[q]}', chr(39) + role + ':' + chr(39) + ' || text')} END")
        options += [f"CASE WHEN {free} AND role[1] = '{c}' THEN {edge('K', late, f'q{t}', chr(39) * 2 + ' || role || ' + chr(39) + ':' + chr(39) + ' || text')} END"
                    for c, t in keeps.items()]
        return f"list_sort(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))[1] AS v{q}"

    end = {q: "{'c': %d, 'a': '', 'o': CAST([] AS VARCHAR[])}" % (0 if q in (0, 3) else 10 ** 12) for q in range(4)}
    base = f"SELECT conv_id, count(*) AS i, {', '.join(f'{end[q]} AS v{q}' for q in range(4))} FROM f GROUP BY conv_id"
    step = (f"SELECT dp.conv_id, dp.i - 1 AS i, {', '.join(map(stepped, range(4)))} FROM dp JOIN f "
            "ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i")
    return f"""
  WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind
                       FROM conversations),
  d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
  f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                       WHEN regexp_matches(text, '[^.!?\\x20\\x09-\\x0D][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
               coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), FALSE) AS odd
        FROM r),
  dp AS ({relaxed(base)} UNION ALL {relaxed(step)}),
  facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                   count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE odd) AS illegal
            FROM f GROUP BY conv_id)
  SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
         coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(q0.c, 0) AS cost,
         coalesce(q0.a, '') AS audit, sha256(coalesce(array_to_string(q0.o, chr(10)), '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
  LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM ids.conv_id AND dp.i = 0"""


#: DuckDB SQL for the queries that it can express, over whole tables.
ORACLE: dict[str, str] = {
    "op1_quality_rules": _quality_sql(),
    "op3_line_dedup": r"""
  WITH l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS p, unnest(ls) AS line
             FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
  s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k FROM l
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
  w AS (SELECT a.doc_id, a.k, row_number() OVER (PARTITION BY a.line, b.line ORDER BY a.doc_id, a.k) AS copy
        FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k = a.k + 1),
  cut AS (SELECT DISTINCT doc_id, k + o AS k FROM w, range(0, 2) AS r(o) WHERE copy > 1),
  t AS (SELECT l.doc_id, l.p, l.line, s.k, cut.k AS gone FROM l LEFT JOIN s USING (doc_id, p)
        LEFT JOIN cut ON cut.doc_id = l.doc_id AND cut.k = s.k)
  SELECT doc_id, count(k) AS n_lines, count(gone) AS n_removed,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
  FROM t GROUP BY doc_id""",
    "op6_near_dedup": f"""
  WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM (SELECT doc_id, {_LOWER} FROM documents)),
  sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE
           list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d),
  n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
  common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s)
             WHERE a.doc_id <> b.doc_id GROUP BY ALL),
  link AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
           WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
  reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON other = x)
  SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
  FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op10_substring_dedup": f"""
  WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
  win AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i,
                 unnest(list_transform(range(1, len(w) - 48), lambda i: array_to_string(w[i:i + 49], ' '))) AS text FROM d),
  hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM win) WHERE first < doc_id),
  cut AS (SELECT DISTINCT doc_id, i + o AS i FROM hit, range(0, 50) AS r(o)),
  t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
  k AS (SELECT t.doc_id, count(*) AS n_words, count(cut.i) AS n_removed,
               string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE cut.i IS NULL) AS kept
        FROM t LEFT JOIN cut ON cut.doc_id = t.doc_id AND cut.i = t.i GROUP BY t.doc_id)
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
         sha256(coalesce(kept, '')) AS kept_sha256
  FROM documents LEFT JOIN k USING (doc_id)""",
    "op13_conversation_repair": _repair_sql(),
}
