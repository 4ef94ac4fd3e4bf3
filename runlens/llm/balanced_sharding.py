"""Shards of documents by balanced label propagation.

Documents are linked if their texts are equal. Every document starts in the
shard its id hashes to. Then, a few rounds over:

* each group of linked documents votes: its members are counted by shard, and
  the shard with most of them is where the others want to go (ties go by a
  hash of group and shard);
* the wishes are counted by pair of shards (``shards`` squared numbers, the
  only thing the driver sees) and cut to quotas, so that no shard grows above
  its capacity;
* a document moves if a hash falls below its pair's quota: members of a
  small group share the hash and move together, those of a group that is
  large beside a shard move each on its own.

At the end the shards are made exactly even (law ``rows``: their counts are
at most one apart). Documents get slots within their shard, linked ones
first, group by group; the slots beyond a shard's final count, which hold
documents without links as long as there are any, go to the free slots of the
shards that have too few. Slots have no gaps.

Everything is DataFrame operations on a narrow table of ids, sizes and
hashes. Slots are counted within buckets of bounded size (by hash of text and
of id), so neither a shard nor a group of copies is ever sorted in one task.

Defined results: a null text is the empty text, of size 1. Rows that share
id and text are interchangeable; each gets its own slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows of one bucket within which slots are counted by sorting.
BUCKET_ROWS = 2000
#: Buckets that the members of one group are spread over in a shard.
SPREAD = 256
#: Steps of a quota; a quota is kept to one part in so many.
QUOTA_STEPS = 1 << 20
#: A group above this share of a shard's capacity moves member by member.
LARGE_GROUP = 1 / 64


def narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))


def quotas(wishes: dict[tuple[int, int], int], counts: list[int], capacity: float) -> dict[tuple[int, int], int]:
    """How many of each wished move may happen, so that no shard ends above ``capacity`` unless it began above.

    Moves into a shard that would overflow are cut in proportion; cutting keeps documents elsewhere, so it is
    repeated until nothing overflows. A shard that is above the capacity may still swap."""
    allowed = dict(wishes)
    for _ in range(1000):
        over = False
        for b in range(len(counts)):
            coming = sum(n for (_, to), n in allowed.items() if to == b)
            going = sum(n for (frm, _), n in allowed.items() if frm == b)
            room = max(int(capacity), counts[b]) - counts[b] + going
            if coming > room:
                over = True
                into = [p for p in allowed if p[1] == b]
                parts = {p: divmod(allowed[p] * room, coming) for p in into}
                spare = room - sum(whole for whole, _ in parts.values())
                for i, p in enumerate(sorted(into, key=lambda p: (-parts[p][1], p))):  # largest remainders first
                    allowed[p] = parts[p][0] + (i < spare)
        if not over:
            break
    return allowed


def propagate(rows: DataFrame, shards: int, rounds: int, slack: float) -> DataFrame:
    """``rows`` with ``shard`` and ``linked``: shards after balanced label propagation, not yet exactly even."""
    sizes = rows.groupBy("text_hash", "text_crc32").agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    state = stored(
        rows.join(sizes, ["text_hash", "text_crc32"], "left")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards)).cast("int")), "shard-state")
    total = state.count()
    mean = total / shards
    capacity = mean * (1 + slack) + 2 * mean**0.5  # a shard of few rows needs room for chance as well
    group = ["text_hash", "text_crc32"]
    for turn in range(rounds):
        votes = state.where("group_rows is not null").groupBy(*group, "shard").agg(F.count(F.lit(1)).alias("votes"))
        # shards with equally many members are told apart by a hash, so that wishes are spread over the shards
        wanted = votes.groupBy(*group).agg(
            F.max(F.struct("votes", F.xxhash64(*group, "shard"), "shard")).alias("top")
        ).select(*group, F.col("top.shard").alias("wanted"))
        moves = state.join(wanted, group, "left")
        asked = (votes.join(wanted, group).where("shard <> wanted").groupBy("shard", "wanted")
                 .agg(F.sum("votes").alias("n")).collect())  # shards squared rows at most
        if not asked:
            break
        counts = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        wishes = {(r["shard"], r["wanted"]): r["n"] for r in asked}
        allowed = quotas(wishes, [counts.get(s, 0) for s in range(shards)], capacity)
        steps = [QUOTA_STEPS * allowed.get((a, b), 0) // wishes.get((a, b), 1) for a in range(shards) for b in range(shards)]
        quota = F.element_at(F.array(*[F.lit(s) for s in steps]), F.col("shard") * shards + F.col("wanted") + 1)
        alone = F.col("group_rows") > F.lit(capacity * LARGE_GROUP)
        draw = F.pmod(F.xxhash64("text_hash", F.when(alone, F.col("doc_id")), F.lit(turn)), F.lit(QUOTA_STEPS))
        goes = F.col("wanted").isNotNull() & (F.col("wanted") != F.col("shard"))
        moves = moves.withColumn("shard", F.when(goes & (draw < quota), F.col("wanted")).otherwise(F.col("shard")))
        state = stored(moves.drop("wanted"), "shard-state")
    return state.withColumn("linked", F.col("group_rows").isNotNull()).drop("group_rows")


def even(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with final ``shard`` and ``slot``: counts at most one apart, as few rows moved as that takes."""
    counts = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    have = [counts.get(s, 0) for s in range(shards)]
    total = sum(have)
    buckets = max(1, total // (shards * BUCKET_ROWS))
    spread = min(SPREAD, buckets)
    place = ["shard", "single", "by_text", "by_id"]
    dealt = rows.withColumns({
        "single": (~F.col("linked")).cast("int"),
        "by_text": F.pmod(F.xxhash64("text_hash", F.lit(5)), F.lit(-(-buckets // spread))).cast("int"),
        "by_id": F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(spread)).cast("int")})
    before = Window.partitionBy("shard").orderBy("single", "by_text", "by_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    within = Window.partitionBy(*place).orderBy("text_hash", "text_crc32", "doc_id")
    slotted = dealt.join(offsets, place).withColumn(
        "slot", (F.col("_offset") + F.row_number().over(within) - 1).cast("long"))
    # the larger shards keep the one row that some shards have more
    order = sorted(range(shards), key=lambda s: (-have[s], s))
    goal = [0] * shards
    for i, s in enumerate(order):
        goal[s] = total // shards + (1 if i < total % shards else 0)
    surplus_from, free_from, surplus, free = [0] * shards, [], 0, 0
    for s in range(shards):
        surplus_from[s] = surplus
        surplus += max(0, have[s] - goal[s])
        if goal[s] > have[s]:
            free_from.append((free, s))
            free += goal[s] - have[s]
    pick = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)
    nth = pick(surplus_from) + F.col("slot") - pick(goal)  # of all rows that have to move, counted over the shards
    to_shard, to_slot = F.col("shard"), F.col("slot")
    for first, s in free_from:  # the last interval that begins at or before nth wins
        here = (F.col("_nth") >= first)
        to_shard = F.when(here, F.lit(s)).otherwise(to_shard)
        to_slot = F.when(here, F.col("_nth") - first + have[s]).otherwise(to_slot)
    moved = F.col("slot") >= pick(goal)
    return (slotted.withColumn("_nth", F.when(moved, nth))
            .withColumns({"_to": to_shard.cast("int"), "_at": to_slot.cast("long")})
            .withColumns({"shard": F.col("_to"), "slot": F.col("_at")})
            .drop("single", "by_text", "by_id", "_offset", "_nth", "_to", "_at"))


def shard_documents(docs: DataFrame, shards: int = 16, rounds: int = 6, slack: float = 0.1) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document of ``docs``."""
    rows = narrow(docs)
    settled = stored(propagate(rows, shards, rounds, slack), "shard-settled")
    return even(settled, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
