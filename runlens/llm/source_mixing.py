"""Mixing sources to target weights by hash-threshold histograms.

Sizes. A document's size is its number of words; a source's target is its
share of the budget by weight, but at most ``most`` times its own size, the
excess shared among the others by weight until none is above its bound (water
filling, solved in closed form on the table of sources).

Choice. A source whose target is below its size takes a part of its
documents, one whose target is above takes all of them and a part of them
again. The part is a threshold on a hash of the document's id: a histogram of
words by source and leading hash digits gives the last digit below which all
fit; only the bucket in which the budget ends is counted again by its next
digits, until it holds one hash value. A row then knows from its hash and its
source's thresholds whether it is taken: a filter, without sorting rows. Smaller
budgets choose subsets of what larger ones choose.

What the threshold leaves over is less than the next document. It is filled
``fills`` times in the same way from the documents after the threshold that
are small enough to fit.

Defined results: null texts have size 0 and take nothing; null sources form
one source, the last. Documents with equal ids share one hash and are taken
together. If no source has words, targets are 0. Reruns agree: everything
depends on ids, sources and sizes alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bits of the hash, and of one digit of it: a histogram has 2**DIGIT buckets a source at most.
HASH_BITS = 60
DIGIT = 10
#: Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def source_key(source: Column) -> Column:
    """A key that is never null, different for the null source and any text."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key and hash of every document."""
    return docs.select("doc_id", "source", words(F.col("text")).alias("size"), source_key(F.col("source")).alias("key"),
                       id_hash(F.col("doc_id")).alias("hash"))


def targets(rows: DataFrame, weights: tuple[float, ...], budget: float, most: float) -> DataFrame:
    """key, source_size and target of every source.

    The windows run over one row per source, not over documents."""
    sources = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNotNull().desc(), "source")
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("bound", F.col("source_size") * F.lit(float(most)))
    # sources reach their bounds in the order of bound / weight; those before the first that does not are bounded
    rising = Window.orderBy(F.col("bound") / F.col("weight"), "key")
    earlier, later = (rising.rowsBetween(Window.unboundedPreceding, -1),
                      rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = ((F.sum("source_size").over(every) * F.lit(float(budget)) - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0)))
             / F.sum("weight").over(later))
    leveled = weighed.withColumn("level", level).withColumn("free", F.col("level") < F.col("bound") / F.col("weight"))
    # later levels are no higher than that of the first source below its bound; least() passes over a null level
    common = F.max(F.when(F.col("free"), F.col("level"))).over(every)
    return leveled.withColumn("target", F.least(common * F.col("weight"), F.col("bound"))).select("key", "source_size", "target")


def threshold(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """key, below, taken: for each source the hash below which its ``rows`` (key, hash, size) fit the budget (key,
    room), and the words of these rows."""
    room = budgets.select("key", "room", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("taken"))
    shift = HASH_BITS
    while shift:
        shift -= DIGIT
        begins = F.shiftright("hash", shift + DIGIT) if shift + DIGIT < HASH_BITS else F.lit(0).cast("long")
        histogram = (
            rows.select("key", "hash", "size", begins.alias("prefix"))
            .join(room.select("key", "prefix"), ["key", "prefix"])
            .groupBy("key", "prefix", F.shiftright("hash", shift).alias("next"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        )
        upto = Window.partitionBy("key").orderBy("next")  # at most 2**DIGIT rows a source
        counted = (
            histogram.withColumn("sum", F.sum("words").over(upto))
            .join(room.select("key", "room", "prefix", "taken"), ["key", "prefix"])
            .groupBy("key", "room", "prefix", "taken")
            .agg(F.min(F.when(F.col("taken") + F.col("sum") > F.col("room"), F.struct("next", "words", "sum", "n")))
                 .alias("over"), F.max("sum").alias("all"))
        )
        # a source that fits as a whole keeps the end of its prefix as its threshold
        end = (F.col("prefix") + 1) * F.lit(1 << DIGIT) if shift + DIGIT < HASH_BITS else F.lit(1 << DIGIT)
        bounds = counted.select(
            "key", "room", F.coalesce("over.next", end.cast("long")).alias("prefix"),
            (F.col("taken") + F.coalesce(F.col("over.sum") - F.col("over.words"), "all")).alias("taken"),
            F.coalesce("over.n", F.lit(0)).alias("n"))
        missing = room.join(bounds, "key", "left_anti").select(
            "key", "room", (F.col("prefix") * F.lit(1 << DIGIT)).alias("prefix"), "taken", F.lit(0).cast("long").alias("n"))
        room = stored(bounds.unionByName(missing), "mix-bounds")
        if room.agg(F.max("n")).first()[0] in (None, 0, 1):
            break
    return room.select("key", (F.col("prefix") * F.lit(1 << shift)).alias("below"), "taken")


class Mix:
    """What a mix takes of each document, as columns that depend on the row and its source alone."""

    def __init__(self, rows: DataFrame, weights: tuple[float, ...], budget: float, most: float, fills: int) -> None:
        """``rows``: doc_id, source, size, key and hash of all documents, stored."""
        goals = stored(targets(rows, weights, budget, most), "mix-targets")
        whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
        plan = goals.withColumn("copies", whole).withColumn("room", F.col("target") - F.col("copies") * F.col("source_size"))
        plan = plan.withColumns({"steps": F.array().cast("array<struct<from:long,below:long,most:double>>"),
                                 "start": F.lit(0).cast("long")})
        rest = rows.select("key", "hash", "size").where("size > 0")
        for i in range(1 + fills):
            found = threshold(rest, plan.select("key", "room"))
            fits = F.col("room") if i else F.lit(float("inf"))
            below = F.greatest("below", "start")
            plan = stored(
                plan.join(found, "key").select(
                    "key", "source_size", "target", "copies", (F.col("room") - F.col("taken")).alias("room"),
                    F.concat("steps", F.array(F.struct(F.col("start").alias("from"), below.alias("below"),
                                                       fits.alias("most")))).alias("steps"), below.alias("start")),
                "mix-plan")
            rest = (rows.select("key", "hash", "size").join(plan.select("key", "room", "start"), "key")
                    .where("size > 0 and hash >= start and size <= room").select("key", "hash", "size"))
        self.plan = plan.select("key", "source_size", "target", "copies", "steps")

    def times(self) -> Column:
        """How often the mix takes a row that is joined with the plan and has hash and size."""
        chosen = F.exists("steps", lambda s: (F.col("hash") >= s["from"]) & (F.col("hash") < s["below"])
                          & (F.col("size") <= s["most"]))
        return F.col("copies") + (chosen & (F.col("size") > 0)).cast("long")

    def taken(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with key, hash and size) with source_size, target and taken."""
        return rows.join(self.plan, "key").withColumn("taken", F.col("size") * self.times()).drop("copies", "steps")

    def repeated(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs``, each as often as the mix takes it; documents without words are not taken."""
        row = docs.select(F.struct("*").alias("doc"), source_key(F.col("source")).alias("key"),
                          words(F.col("text")).alias("size"), id_hash(F.col("doc_id")).alias("hash"))
        counted = row.where("size > 0").join(self.plan, "key").withColumn("times", self.times().cast("int"))
        return counted.where("times > 0").select("doc", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")
