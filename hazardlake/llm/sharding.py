"""Balanced label propagation: linked documents move to their neighbours' shards.

Links are groups of documents (here: equal texts), held as (document, group) rows
and never as pairs. Documents start evenly dealt. In each round a document's
votes are the shards of its group's other members, counted per (group, shard);
it wants the shard with most votes, if that beats its own. Per pair of
shards, movers are admitted by gain: as many as want to go the other way, and
more while the target is below its quota (``SLACK`` above an even share). A
group too large for one shard fills shards one after the other.

At the end unlinked documents fill the shards, and the documents, ordered by (shard,
group), are cut into equal runs: counts are at most one apart, and only groups
at the cuts are split.

Null texts count as empty texts. Repeated rows are separate rows with equal
texts. An empty table gives an empty result; fewer rows than shards leave shards
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.prefix import running_total
from hazardlake.llm.staging import bounded, drop, stage

SHARDS, ROUNDS, SLACK = 40, 8, 0.05
OVERHEAD_BYTES = 16


def propagate(linked: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """Moves rows (node, group, shard) between shards; no shard grows beyond ``quota`` rows."""
    cur = stage(linked.select("node", "group", "shard"), "labels")
    nodes = cur.count()
    for turn in range(rounds if nodes else 0):
        load = {r["shard"]: r["n"] for r in cur.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = [max(0, quota - load.get(s, 0)) for s in range(shards)]
        votes = stage(cur.groupBy("group", "shard").agg(F.count("*").alias("n"))
                      .withColumn("tie", F.xxhash64("group", "shard")), "votes")
        # Every other round looks at shards with room only, so that no group waits for a full one.
        open_ = F.element_at(F.array(*map(F.lit, room)), F.col("shard") + 1) > 0
        best = (votes.where(open_ if turn % 2 else F.lit(True)).groupBy("group")
                .agg(F.max(F.struct("n", "tie", "shard")).alias("best")))
        offers = stage(votes.join(best, "group")
                       .where("best.shard <> shard and (best.n > n or (best.n = n and best.tie > tie))")
                       .select(F.col("group"), F.col("shard"), F.col("best.shard").alias("to"), F.col("n"),
                               (F.col("best.n") - F.col("n")).alias("gain")), "offers")
        wanted = {(r["shard"], r["to"]): r["n"] for r in
                  offers.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}   # shards^2 rows at most
        quotas = _admitted(wanted, room, shards)
        wish = cur.join(bounded(offers.drop("n"), 32), ["group", "shard"])
        ranked = running_total(wish, [F.col("gain").desc(), F.col("group"), F.col("node")], "place",
                               groups=["shard", "to"])
        limits = F.split(F.lit(",".join(map(str, quotas))), ",").cast("array<long>")
        moves = stage(ranked.where(F.col("place") < F.element_at(limits, F.col("shard") * shards + F.col("to") + 1))
                      .select("node", "to"), "moves")
        moved = moves.count()
        nxt = stage(cur.join(bounded(moves, 16, moved), "node", "left")
                    .select("node", "group", F.coalesce("to", "shard").alias("shard")), "labels")
        drop(cur, votes, offers, ranked, moves)
        cur = nxt
        if turn % 2 and moved * 1000 < nodes:
            break
    return cur


def _admitted(wanted: dict, room: list[int], shards: int) -> list[int]:
    """Movers let through from shard s to t, at s * shards + t: equal numbers both ways, and more while t has room."""
    room, out = list(room), [0] * (shards * shards)
    for (s, t), n in sorted(wanted.items()):
        swap = min(n, wanted.get((t, s), 0))
        more = min(n - swap, room[t])
        room[t] -= more
        out[s * shards + t] = swap + more
    return out


def balanced_shards(rows: DataFrame, group: list[str], order: list[str], shards: int = SHARDS,
                    rounds: int = ROUNDS) -> DataFrame:
    """Adds shard (int) and slot (long, gapless from 0 in each shard) to ``rows``.

    Rows equal in the ``group`` columns are linked; ``order`` makes reruns agree.
    """
    size = rows.groupBy(*group).agg(F.count("*").alias("_copies")).where("_copies > 1")
    size = stage(size.select(*[F.col(g).alias(f"_{g}") for g in group], "_copies"), "groups")
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    flagged = (rows.join(bounded(size, 48), same, "left")
               .withColumn("_linked", F.col("_copies").isNotNull()).select(*rows.columns, "_linked"))
    numbered = running_total(flagged, [F.col("_linked"), *[F.col(c) for c in order]], "_node")
    total, linked_count = numbered.agg(F.count("*"), F.sum(F.col("_linked").cast("long"))).first()
    linked_count = linked_count or 0
    free = total - linked_count
    links = numbered.where("_linked")
    ids = links.groupBy(*group).agg(F.min("_node").alias("group"))
    ids = stage(ids.select(*[F.col(g).alias(f"_{g}") for g in group], "group"), "group_ids")
    linked = links.join(bounded(ids, 48), same).select(
        F.col("_node").alias("node"), "group", F.pmod("_node", F.lit(shards)).cast("int").alias("shard"))
    quota = int(-(-total // shards) * (1 + SLACK)) + 1
    labels = propagate(linked, shards, quota, rounds)
    load = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # Unlinked rows (numbered from 0) fill what the linked ones leave of an even share.
    ends, at = [], 0
    for s in range(shards):
        at += max(0, (s + 1) * total // shards - s * total // shards - load.get(s, 0))
        ends.append(at)
    filled = F.least(F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("_node"))),
                     F.lit(shards - 1))
    spots = labels.select(F.col("node"), "group", F.col("shard").alias("label"))
    placed = numbered.join(bounded(spots, 24, linked_count), F.col("_node") == F.col("node"), "left")
    placed = placed.withColumn("label", F.coalesce("label", filled)).withColumn("group", F.coalesce("group", "_node"))
    final = running_total(placed.select(*rows.columns, "_node", "label", "group"),
                          [F.col("label"), F.col("group"), F.col("_node")], "_rank")
    # Whole-number form of floor(rank * shards / n): the first rank of shard s is ceil(s * n / shards).
    shard = F.expr(f"(_rank * {shards}) div {max(1, total)}")
    start = F.expr(f"((((_rank * {shards}) div {max(1, total)}) * {total} + {shards - 1}) div {shards})")
    return final.select(*rows.columns, shard.cast("int").alias("shard"), (F.col("_rank") - start).alias("slot"))


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, text_hash): what sharding needs of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of documents."""
    rows = stage(document_rows(docs), "rows")
    out = balanced_shards(rows, ["text_hash", "text_crc32", "size"], ["doc_id", "text_hash"], shards, rounds)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
