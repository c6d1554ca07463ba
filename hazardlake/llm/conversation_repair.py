"""Conversation structure repair as an integer-minimum DP over a DAG of edits.

A conversation's role initials must read ``(s?(ua)+)?``. Edits per row: Keep (0), Rerole to user or assistant
(1), Delete (2, the only one for blank and duplicate rows); Insert puts an empty user or assistant row anywhere
(5). A truncated row that is not deleted adds 5.

1. Narrow rows (conversation, turn, role, MD5 of the text, fault) are range-sorted and numbered; a row is a
   duplicate if its role and text came earlier. So a conversation of any size spreads over many tasks.
2. Each row becomes one symbol (role class and fault). Symbols are joined in chunks, then per conversation: one
   byte a row, the size of the audit that is asked for.
3. A path's weight is one integer: the cost in the high digits, then the edits' letters in
   fixed-width digits by position, zeros after the last. The minimum over all paths is the
   cheapest repair, and of equally cheap ones that with the ASCII-least letters. The DP runs backwards over
   (row, automaton state), at most two inserts between rows (a third would come back to a state at a
   cost). Blocks of ``BLOCK`` rows keep integers short: edges that leave one node have different
   letters, so paths from a node that cost the same differ inside the block where they part, and
   at a block's border only costs need to go on.
4. The audit goes before its conversation's rows in one sorted stream; repaired rows leave it one by one, so no
   task holds a conversation's texts.

Rows are taken by turn (nulls first), rows of one turn by role, then MD5 of the text. Null roles and texts count as
one space, a null conversation id as a conversation; a row whose role is empty can only be rerolled or deleted. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.staging import drop, stage

#: Cost of each edit and of a truncated row that stays; digit of each letter, in ASCII order.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {d: c for c, d in DIGIT.items()}
DIGIT_BITS = 3
#: Automaton of role initials: state -> {initial: next}; 0 start, 1 after s, 2 after u, 3 after a.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: State -> the only initial that Rerole or Insert can give there.
GIVEN = ("u", "u", "a", "u")
ROLE = {"u": "user", "a": "assistant"}
ACCEPTED = (True, False, False, True)
LEGAL = ("su", "ua", "au")
CLASSES, FAULTS = "sua-", ("", "truncated", "duplicate", "blank")
#: Rows of one block of the DP, rows of one chunk of symbols, rows of one Arrow batch that is returned.
BLOCK, CHUNK, OUT_ROWS = 64, 4096, 2000
_NEVER = 1 << 60
SOLID = r"[^\x20\x09-\x0D]"
#: The last solid character is no full stop, exclamation or question mark.
UNENDED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"


def symbol(initial: str, fault: str) -> str:
    """One letter for a row's role class and fault."""
    kind = initial if initial and initial in "sua" else "-"
    return chr(ord("A") + 4 * CLASSES.index(kind) + FAULTS.index(fault))


def _parse(code: str) -> tuple[str, str]:
    k = ord(code) - ord("A")
    return CLASSES[k // 4], FAULTS[k % 4]


def _solve_block(codes: str, after: list[int], first: bool) -> tuple[list[int], list[str]]:
    """(costs, letters) of the best path through the block from each state; ``after``: costs at its end."""
    digits = 3 * len(codes) + 4
    wide = DIGIT_BITS * digits
    rest = (1 << wide) - 1

    def step(letter: str, cost: int, v: int) -> int:
        audit = DIGIT[letter] << (wide - DIGIT_BITS) | (v & rest) >> DIGIT_BITS
        return ((v >> wide) + cost) << wide | audit

    def insert(v: list[int]) -> list[int]:
        to = [NEXT[q][GIVEN[q]] for q in range(4)]
        one = [min(v[q], step("I", INSERT, v[to[q]])) for q in range(4)]
        return [min(v[q], step("I", INSERT, one[to[q]])) for q in range(4)]

    v = [c << wide for c in after]
    for code in reversed(codes):
        v = insert(v)
        initial, fault = _parse(code)
        stays = TRUNCATED if fault == "truncated" else 0
        new = []
        for q in range(4):
            best = step("D", DELETE, v[q])
            if fault in ("", "truncated"):
                best = min(best, step("R", REROLE + stays, v[NEXT[q][GIVEN[q]]]))
                if initial in NEXT[q]:
                    best = min(best, step("K", KEEP + stays, v[NEXT[q][initial]]))
            new.append(best)
        v = new
    if first:
        v = insert(v)
    letters = []
    for x in v:
        audit, out = x & rest, []
        for k in range(digits - 1, -1, -1):
            d = audit >> (DIGIT_BITS * k) & 7
            if not d:
                break
            out.append(LETTER[d])
        letters.append("".join(out))
    return [x >> wide for x in v], letters


def walk(state: int, letter: str, initial: str) -> int:
    """State after an edit; ``initial`` is that of the row it keeps."""
    if letter == "D":
        return state
    return NEXT[state][initial if letter == "K" else GIVEN[state]]


def cheapest_repair(codes: str) -> tuple[int, str]:
    """(cost, audit letters) of a conversation's symbols."""
    costs, solved = [0 if ok else _NEVER for ok in ACCEPTED], []
    starts = range(0, len(codes), BLOCK)
    for s in reversed(starts):
        costs, letters = _solve_block(codes[s:s + BLOCK], costs, s == 0)
        solved.append(letters)
    state, audit = 0, []
    for s in starts:
        row, letters = s, solved.pop()[state]
        for c in letters:
            state = walk(state, c, "" if c == "I" else _parse(codes[row])[0])
            row += c != "I"
        audit.append(letters)
    return costs[0], "".join(audit)


def _facts(codes: str) -> tuple[int, ...]:
    """(blank, duplicate, truncated, illegal, cost, audit) of a conversation's symbols."""
    parsed = [_parse(c) for c in codes]
    faults = [f for _, f in parsed]
    illegal = sum(a + b not in LEGAL for (a, _), (b, _) in zip(parsed, parsed[1:]))
    return (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, *cheapest_repair(codes))


@lru_cache(maxsize=50_000)
def _short_facts(codes: str) -> tuple[int, ...]:
    return _facts(codes)


_REPORT = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _report_mapper(batches):
    for batch in batches:
        found = [_short_facts(c) if len(c) <= BLOCK else _facts(c) for c in batch.column(1).to_pylist()]
        cols = list(zip(*found)) or [()] * len(_REPORT)
        types = [pa.int64()] * 5 + [pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                         names=["conv_id", *_REPORT])


def _stream(batches):
    """Rows of several batches, one at a time."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["conv_id", "place", "role", "text", "edit"])


def _edited(rows):
    """Repaired rows from a stream that has each conversation's audit (place 0) before its rows."""
    conv, audit, at, state, place = None, "", 0, 0, 0

    def inserts():
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            yield conv, place, ROLE[GIVEN[state]], "", "Insert"
            state, at, place = walk(state, "I", ""), at + 1, place + 1

    for conv_id, first, role, text in rows:
        if first:
            yield from inserts()
            conv, audit, at, state, place = conv_id, text, 0, 0, 0
            continue
        yield from inserts()
        letter = audit[at]
        if letter != "D":
            given = role if letter == "K" else ROLE[GIVEN[state]]
            yield conv, place, given, text, "Keep" if letter == "K" else "Rerole"
            state, place = walk(state, letter, role[:1]), place + 1
        at += 1
    yield from inserts()


def _repair_mapper(batches):
    out = []
    for row in _edited(_stream(batches)):
        out.append(row)
        if len(out) == OUT_ROWS:
            yield _batch(out)
            out = []
    yield _batch(out)


def _digest_mapper(batches):
    """Rows (conv_id, place, role, text) in order -> SHA-256 of the conversation's ``role:text`` lines."""
    held = None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1].hexdigest()])],
                                          names=["conv_id", "sha256"])

    for conv_id, _, role, text, _ in _stream(batches):
        if held is None or held[0] != conv_id:
            if held:
                yield done()
            held = (conv_id, hashlib.sha256())
        else:
            held[1].update(b"\n")
        held[1].update(f"{role}:{text}".encode())
    if held:
        yield done()


def _rows(conversations: DataFrame) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)


def _joined(order: str, value: str) -> Column:
    """The group's strings ``value`` in ``order``, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), "")


def conversation_reports(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation."""
    fault = (F.when(~F.col("text").rlike(SOLID), FAULTS.index("blank"))
             .when(F.col("text").rlike(UNENDED), FAULTS.index("truncated")).otherwise(0))
    kind = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, F.lit(k)) for k, c in enumerate("sua")], F.lit(3))
    narrow = _rows(rows).select("conv_id", "turn", "role", F.md5("text").alias("hash"), kind.alias("kind"), fault.alias("fault"))
    placed = stage(narrow.orderBy("conv_id", "turn", "role", "hash").withColumn("at", F.monotonically_increasing_id()),
                   "placed")
    fresh = placed.groupBy("conv_id", "role", "hash").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("fresh"))
    seen = F.col("fresh").isNull() & (F.col("fault") != FAULTS.index("blank"))
    code = F.char(ord("A") + 4 * F.col("kind") + F.when(seen, FAULTS.index("duplicate")).otherwise(F.col("fault")))
    chunks = (placed.join(fresh, "at", "left").select("conv_id", "at", code.alias("code"))
              .groupBy("conv_id", F.expr(f"at div {CHUNK}").alias("chunk")).agg(_joined("at", "code").alias("codes")))
    codes = chunks.groupBy("conv_id").agg(_joined("chunk", "codes").alias("codes"))
    facts = codes.mapInArrow(_report_mapper, "conv_id long, " + ", ".join(f"{c} long" for c in _REPORT[:5]) + ", audit string")
    span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    gaps = placed.groupBy(F.col("conv_id").alias("_conv")).agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    out = facts.join(gaps, F.col("conv_id").eqNullSafe(F.col("_conv")))
    found = stage(out.select("conv_id", "gaps", *_REPORT), "reports")
    drop(placed)
    return found


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, repaired rows) of conversations (conv_id, turn, role, text, ...).

    Repaired rows are (conv_id, place from 0, role, text, edit); those of a conversation stand in order in one partition.
    """
    reports = conversation_reports(rows)
    blank = F.lit(None)
    audits = reports.select("conv_id", F.lit(True).alias("first"), blank.cast("long").alias("turn"),
                            blank.cast("string").alias("role"), F.col("audit").alias("text"), F.lit("").alias("hash"))
    texts = _rows(rows).select("conv_id", F.lit(False).alias("first"), "turn", "role", "text", F.md5("text").alias("hash"))
    stream = (audits.unionByName(texts).repartition("conv_id")
              .sortWithinPartitions("conv_id", F.desc("first"), "turn", "role", "hash").select("conv_id", "first", "role", "text"))
    repaired = stream.mapInArrow(_repair_mapper, "conv_id long, place long, role string, text string, edit string")
    return reports, repaired


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of repaired rows as ``repair_conversations`` returns them: ``role:text``, newline-joined."""
    return repaired.mapInArrow(_digest_mapper, "conv_id long, sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of (conversation, turn): dropped, emptied, stripped of end marks, repeated, given to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (conversations.where(kind != 0)
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
                    F.explode(copies).alias("_copy")).drop("_copy"))


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation, damaged first."""
    reports, repaired = repair_conversations(damage(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    digests = conversation_digests(repaired).withColumnRenamed("conv_id", "_conv")
    out = (ids.join(reports, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
           .join(digests, F.col("_id").eqNullSafe(F.col("_conv")), "left"))
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_REPORT[:5])]
    return out.select(F.col("_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
