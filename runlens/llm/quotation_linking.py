"""Conversations rebuilt from quoted replies.

Parsing. A line's quote level is the number of ``>`` marks it begins with
(blanks between them allowed). Neighbouring lines of one level form a
passage; passages of level 0 are the message's own text.

Hashing. A passage is normalised (lower-cased, runs of white space made one
space, trimmed) and hashed. Own passages are indexed by (conversation,
hash), whole own texts and single lines as well, each hash with the earliest
turn that has it: that message is the original. So the index has one row per
key, and the join cannot multiply rows, however often a passage is repeated.

Linking. Each quoted passage looks up its original among earlier turns: as a
whole, or else by its lines (the latest original among them). A message
replies to the original of its least deeply quoted linked passage; among
several, to the latest turn.

Rebuilding. The root of each reply chain is found by pointer doubling over
the linked messages. Messages come out without quotes, ordered by
conversation, thread (its root's turn) and turn, which puts every message
after the one it replies to. The order is a range partitioning and a sort, so
a conversation of any length is spread over tasks.

All of this is DataFrame expressions; lines are taken apart within the row.

Defined results: null texts are empty messages; a null conversation is no
conversation, its messages link with nothing; messages without a turn link
with nothing and are their own thread. A repeated (conversation, turn) is one
message in the reply tree, each of its rows comes out. Blank passages are not
quotes of anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: The quote marks a line begins with, with one blank after the last.
MARKS = r"^((?:[ \t]*>)*)"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def lines_of(text: Column) -> Column:
    """Array of (level, content) of a text's lines."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 1)
        rest = F.substr(x, F.length(marks) + 1)
        level = F.length(F.regexp_replace(marks, "[ \t]", ""))
        return F.struct(level.alias("level"), F.when(level > 0, F.regexp_replace(rest, "^ ", "")).otherwise(rest)
                        .alias("content"))

    return F.transform(lines, line)


def passages_of(lines: str) -> Column:
    """Array of (level, lines) of the runs of lines of one level."""
    column = F.col(lines)
    at = lambda i: F.element_at(column, i + 1)
    starts = F.filter(F.sequence(F.lit(0), F.size(column) - 1),
                      lambda i: (i == 0) | (at(i)["level"] != F.element_at(column, F.greatest(i, F.lit(1)))["level"]))
    stops = F.concat(F.slice(starts, 2, F.size(column)), F.array(F.size(column)))
    return F.transform(
        F.arrays_zip(starts.alias("start"), stops.alias("stop")),
        lambda p: F.struct(at(p["start"])["level"].alias("level"),
                           F.transform(F.slice(column, p["start"] + 1, p["stop"] - p["start"]),
                                       lambda x: x["content"]).alias("lines")))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (own, without quotes) and passages of every message."""
    taken = messages.select("conv_id", "turn", "role", lines_of(F.col("text")).alias("_lines"))
    own = F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["content"])
    return taken.select(
        "conv_id", "turn", "role",
        F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "").alias("text"),
        F.when(F.exists("_lines", lambda x: x["level"] > 0), passages_of("_lines")).alias("passages"))


def _hash(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def quotes(messages: DataFrame) -> DataFrame:
    """One row per quoted passage of ``messages`` (parsed): conv_id, turn, place, level, lines, whole."""
    quoted = messages.where("passages is not null and conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.posexplode("passages").alias("place", "passage"))
    return (
        quoted.where("passage.level > 0")
        .select("conv_id", "turn", "place", F.col("passage.level").alias("level"), F.col("passage.lines").alias("lines"),
                normalised(F.array_join("passage.lines", "\n")).alias("whole"))
        .where("whole <> ''")
    )


def originals(messages: DataFrame) -> DataFrame:
    """(conv_id, hash, original): for every own text, passage and line the earliest turn that has it."""
    own_lines = F.split(F.col("text"), "\n")
    own_passages = F.transform(F.filter(F.coalesce("passages", F.array()), lambda p: p["level"] == 0),
                               lambda p: F.array_join(p["lines"], "\n"))
    pieces = F.concat(F.array("text"), own_lines, own_passages)
    said = messages.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode(F.array_distinct(F.transform(pieces, normalised))).alias("piece"))
    return said.where("piece <> ''").groupBy("conv_id", _hash(F.col("piece")).alias("hash")).agg(
        F.min("turn").alias("original"))


def reply_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, n_quotes, n_linked) for every message that quotes."""
    quoted = stored(quotes(messages), "quotes")
    index = originals(messages.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi"))
    keys = quoted.select("conv_id", "turn", "place", "level", F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("rank"), F.col("whole").alias("piece"))),
        F.transform("lines", lambda x: F.struct(F.lit(1).alias("rank"), normalised(x).alias("piece"))))).alias("key"))
    looked = keys.where("key.piece <> ''").select("conv_id", "turn", "place", "level", "key.rank",
                                                  _hash(F.col("key.piece")).alias("hash"))
    hit = F.when(F.col("original") < F.col("turn"), F.col("original"))
    by_passage = looked.join(index, ["conv_id", "hash"], "left").groupBy("conv_id", "turn", "place", "level").agg(
        F.max(F.when(F.col("rank") == 0, hit)).alias("as_whole"), F.max(F.when(F.col("rank") == 1, hit)).alias("by_line"))
    found = by_passage.select("conv_id", "turn", "place", "level", F.coalesce("as_whole", "by_line").alias("original"))
    best = F.min(F.when(F.col("original").isNotNull(), F.struct("level", (-F.col("original")).alias("less"))))
    return found.groupBy("conv_id", "turn").agg(
        best.alias("best"), F.count(F.lit(1)).alias("n_quotes"), F.count("original").alias("n_linked")
    ).select("conv_id", "turn", (-F.col("best.less")).alias("parent_turn"), "n_quotes", "n_linked")


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, depth) for every linked message: its chain's first turn and the steps to it."""
    up = stored(links.where("parent_turn is not null").select("conv_id", "turn", F.col("parent_turn").alias("top"),
                                                              F.lit(1).cast("long").alias("depth")), "climb")
    while True:
        above = up.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("higher"),
                          F.col("depth").alias("more"))
        joined = up.join(above, ["conv_id", "top"], "left")
        if joined.where("higher is not null").isEmpty():
            return up.withColumnRenamed("top", "thread_turn")
        up = stored(joined.select("conv_id", "turn", F.coalesce("higher", "top").alias("top"),
                                  (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "climb")


def rebuilt(messages: DataFrame) -> DataFrame:
    """(conv_id, thread_turn, turn, role, text, parent_turn, depth, n_quotes, n_linked): every message of
    ``messages`` (conv_id, turn, role, text) without its quotes, in reply order."""
    said = stored(parsed(messages), "messages")
    links = stored(reply_links(said), "reply-links")
    placed = links.join(threads(links), ["conv_id", "turn"], "left")
    out = said.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id", F.coalesce("thread_turn", "turn").alias("thread_turn"), "turn", "role", "text", "parent_turn",
        F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"))
    order = ["conv_id", "thread_turn", "turn", "role", "text"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
