"""Conversation repair against all edit sequences."""

import hashlib
import random
import re
import zlib

import pytest
from conftest import SF_SMALL

from hazardlake.llm import conversation_repair as C
from hazardlake.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, place string, edit string, audit string, at string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(rows, faults, i=0, roles="", left=2):
    """Every (cost, audit, lines) that gives a legal order of role initials, at most ``left`` inserts; an empty role is '-'."""
    if i == len(rows):
        if re.fullmatch("(s?(ua)+)?", roles):
            yield 0, "", []
    else:
        role, text = rows[i]
        for c, a, o in all_repairs(rows, faults, i + 1, roles, left):
            yield c + 2, "D" + a, o
        if faults[i] not in ("blank", "duplicate"):
            late = 5 * (faults[i] == "truncated")
            for letter, cost, given in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                if possible(roles + (given[:1] or "-")):
                    for c, a, o in all_repairs(rows, faults, i + 1, roles + (given[:1] or "-"), left):
                        yield c + cost + late, letter + a, [f"{given}:{text}", *o]
    if left:
        for given in ("user", "assistant"):
            if possible(roles + given[0]):
                for c, a, o in all_repairs(rows, faults, i, roles + given[0], left - 1):
                    yield c + 5, "I" + a, [f"{given}:", *o]


def possible(roles):
    return re.fullmatch("(s?(ua)*u?)?", roles) is not None


def plain_repair(rows):
    faults = plain_faults(rows)
    cost, audit, lines = min(all_repairs(rows, faults), key=lambda x: x[:2])
    return faults, cost, audit, lines


def facts(rows, turns):
    """The result columns after conv_id; rows in order."""
    faults, cost, audit, lines = plain_repair(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    """rows: (turn, role, text) of one conversation; null is one space."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        damaged = plain_damage([r for r in rows if r[0] == conv])
        row = facts([r[1:] for r in damaged], [r[0] for r in damaged])
        out.append((conv is None, conv or 0, *row))
    return sorted(out)


def got(out):
    return sorted((r.conv_id is None, r.conv_id or 0, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                   r.repaired_sha256) for r in out.collect())


def codes(rows):
    return "".join(C.symbol(role[:1], f) for (role, _), f in zip(rows, plain_faults(rows)))


def test_repairs_equal_all_edit_sequences():
    rng = random.Random(4)
    roles, texts = ["user", "assistant", "system", "tool", "", " "], ["Yes.", "No", "", " ", "Well?", "Hm!", "And.x"]
    for _ in range(400):
        rows = [(rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts)) for _ in range(rng.randint(0, 5))]
        _, cost, audit, _ = plain_repair(rows)
        assert C.cheapest_repair(codes(rows)) == (cost, audit), rows


def test_blocks_do_not_change_the_repair(monkeypatch):
    rng = random.Random(6)
    for _ in range(150):
        text = "".join(chr(65 + rng.choice([0, 4, 4, 4, 8, 8, 8, 12, 5, 9, 6, 7])) for _ in range(rng.randint(1, 40)))
        monkeypatch.setattr(C, "BLOCK", 1000)
        whole = C.cheapest_repair(text)
        for block in (1, 2, 7):
            monkeypatch.setattr(C, "BLOCK", block)
            assert C.cheapest_repair(text) == whole


def test_long_conversation_is_linear():
    cost, audit = C.cheapest_repair("EI" * 60_000 + "E")
    assert cost == 2 and audit == "D" + "K" * 120_000 or (cost, len(audit)) == (2, 120_001)


def odd_rows():
    rng = random.Random(8)
    rows = [(1, None, None, None), (2, 0, "user", "a."), (2, 0, "user", "a."), (2, 1, "assistant", "b."), (3, 5, "user", "Hi."),
            (3, 9, "assistant", "x" * 300_000), (None, 0, "user", "Yes."), (None, 1, "assistant", "No."), (4, None, "user", "q?"),
            (4, None, "assistant", "é😀!"), (4, 2, "tool", "t."), (5, -3, "", ".")]
    for conv in range(10, 70):
        for turn in range(rng.randint(1, 5)):
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(["user", "assistant", "system", None]),
                         rng.choice(["Yes.", "No", "", "So? \n", "A\nb.", None])))
    return rows


def test_query_rows_equal_all_edit_sequences(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(4)
    assert got(C.damaged_and_repaired(df)) == expected(rows)


def test_chunks_join_in_order(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 3)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(2)
    assert got(C.damaged_and_repaired(df)) == expected(rows)


def test_repaired_rows_are_legal_and_marked(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "More."), (2, 0, "user", "Cut"), (3, 0, "user", " ")]
    reports, repaired = C.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [(r.conv_id, r.cost, r.audit) for r in reports.orderBy("conv_id").collect()] == [(1, 1, "RK"), (2, 2, "D"), (3, 2, "D")]
    assert [tuple(r) for r in repaired.orderBy("conv_id", "place").collect()] == [
        (1, 0, "user", "Hello.", "Rerole"), (1, 1, "assistant", "More.", "Keep")]


def test_one_conversation_holds_most_rows(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Line {t % 500}.") for t in range(6000)] + [(2, 0, "user", "Alone.")]
    reports, repaired = C.repair_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    one = reports.where("conv_id = 1").first()
    assert (one.duplicate, one.truncated, one.cost) == (5500, 0, 11000)
    assert one.audit == "K" * 500 + "D" * 5500
    assert [r.text for r in repaired.where("conv_id = 1").collect()] == [f"Line {t}." for t in range(500)]


@pytest.mark.parametrize("rows", [[]])
def test_empty_table(spark, rows):
    assert C.damaged_and_repaired(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_registered_query_reads_all_conversations(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert op13_conversation_repair(spark, SF_SMALL).count() == df.select("conv_id").distinct().count()
