"""Lines that many documents share are dropped everywhere.

A line's key is the line without white space at its ends and with A-Z lower
case, kept as a 128-bit hash. In how many documents a key is found is counted
with levelled sorted runs:

* documents come in batches. A batch is pre-aggregated to one row per key,
  sorted and stored, bucketed by key;
* the batch is merge-anti-joined with the runs' settled keys, those already
  found in ``min_docs`` documents: nothing more has to be counted for them, so
  boilerplate that an early batch settles never enters a run again;
* what is left becomes a run of its own. Two runs of a level are compacted, by
  a merge join that adds their counts, into one run of the next, so a key is
  written once per level and the number of runs stays logarithmic.

Runs are bucketed and sorted alike, so neither join shuffles or sorts a run. A
run has one row per key: however common a line is, it makes no bucket large.

The settled keys then meet the lines of all documents. A key that is found
very often in some batch is hot; there are at most ``HOT_KEYS`` of them for each
batch, whatever the size of the data, since the bound on their counts grows
with the batch. These are broadcast; all others, whose lines are few for any
one key, are joined by key. What a document loses comes back as places of
lines, and the lines that stay are picked by place from the text.

Defined results: a null or empty text is one empty line. Empty keys, as all
keys of fewer than ``min_chars`` code points, are never dropped. Repeated rows
are documents of their own; a line that one document repeats counts once there.
A document that loses all its lines keeps the empty text. An empty table gives
an empty one; extra columns are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, stored

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys of a batch that can be found in more documents than a join by key should bring together: pairs of document
#: and key divided by this is where a key becomes hot, so no more than so many can.
HOT_KEYS = 20_000
BATCHES = 4
KEY = ["h", "g"]


def key_of(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    # lower() changes other letters too, but is much faster than translate(); lines of one byte a character have no others
    return F.when(F.char_length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed(key: Column, min_chars: int) -> Column:
    """The key's hash of two longs; null for a key that is never dropped."""
    return F.when(F.char_length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")))


class Runs:
    """Levelled sorted runs (h, g, n): key hashes with the number of documents they were found in."""

    def __init__(self, spark, min_docs: int) -> None:
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        #: Run of each level, None where there is none.
        self.levels: list[DataFrame | None] = []

    def sorted_run(self, rows: DataFrame) -> DataFrame:
        """``rows`` stored in the shared folder, bucketed by key, each bucket sorted."""
        name = f"runlens_line_run_{uuid.uuid4().hex}"
        (rows.select(*KEY, "n").write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", f"{shared_dir(self.spark)}/runlens-llm/{name}").saveAsTable(name))
        return self.spark.table(name)

    def settled(self) -> list[DataFrame]:
        return [run.where(F.col("n") >= self.min_docs) for run in self.levels if run is not None]

    def merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.withColumnRenamed("n", "_a").join(b.withColumnRenamed("n", "_b").hint("merge"), KEY, "full_outer")
        zero = F.lit(0)
        return both.select(*KEY, (F.coalesce("_a", zero) + F.coalesce("_b", zero)).alias("n"))

    def add(self, batch: DataFrame) -> None:
        """One more batch, a stored run: what the runs have not settled becomes a run, and full levels are compacted."""
        new, written = batch, True
        for run in self.settled():
            new, written = new.join(run.select(*KEY).hint("merge"), KEY, "left_anti"), False
        level = 0
        while level < len(self.levels) and self.levels[level] is not None:
            new, written = self.sorted_run(self.merged(self.levels[level], new)), True
            self.levels[level] = None
            level += 1
        if level == len(self.levels):
            self.levels.append(None)
        self.levels[level] = new if written else self.sorted_run(new)

    def common(self) -> DataFrame:
        """(h, g): the keys found in ``min_docs`` documents at least, over all batches added."""
        runs = [run for run in self.levels if run is not None]
        while len(runs) > 1:
            a, b, *rest = runs
            runs = [self.sorted_run(self.merged(a, b)), *rest]
        return runs[0].where(F.col("n") >= self.min_docs).select(*KEY)


#: What tells a document from others: rows alike in these have equal texts.
WHO = ["doc_key", "text_key"]


def _who(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    hashed = F.xxhash64(text)
    return [F.coalesce(F.col(doc_id).cast("long"), hashed).alias("doc_key"), hashed.alias("text_key")]


def shared_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """(doc_key, text_key, lost): for every document of ``docs`` that loses lines the places of those, from 0."""
    spark = docs.sparkSession
    # one step after the other: inside one lambda a key would be made anew for each use of it
    keys = F.transform(F.transform(lines_of(F.col("text")), key_of), lambda key: _hashed(key, min_chars))
    held = stored(
        docs.select(*_who(), keys.alias("keys"), (F.spark_partition_id() % batches).alias("batch"))
        .where(F.exists("keys", lambda k: k.isNotNull())), "line-keys")
    once = F.array_distinct(F.filter("keys", lambda k: k.isNotNull()))
    pairs = {r["batch"]: r["n"] for r in held.groupBy("batch").agg(F.sum(F.size(once)).alias("n")).collect()}
    runs, hot = Runs(spark, min_docs), []
    for batch in sorted(pairs):
        found = held.where(F.col("batch") == batch).select(F.explode(once).alias("key")).select("key.*")
        run = runs.sorted_run(found.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")))
        hot.append(run.where(F.col("n") >= max(min_docs, -(-pairs[batch] // HOT_KEYS))).select(*KEY))
        runs.add(run)
    if not pairs:
        return held.select(*WHO, F.array(F.lit(0)).alias("lost"))  # no rows
    often = hot[0]
    for more in hot[1:]:
        often = often.union(more)
    often = F.broadcast(often.distinct())  # at most HOT_KEYS for each batch
    lines = held.select(*WHO, F.posexplode("keys").alias("place", "key")).where("key IS NOT NULL").select(*WHO, "place", "key.*")
    lost = lines.join(often, KEY, "left_semi").select(*WHO, "place").union(
        lines.join(often, KEY, "left_anti").join(runs.common(), KEY, "left_semi").select(*WHO, "place"))
    return lost.groupBy(*WHO).agg(F.collect_set("place").alias("lost"))


def without_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = BATCHES,
                         out: str = "kept") -> DataFrame:
    """``docs`` (doc_id, text) with a struct ``out``: the ``text`` without the lines whose key is found in ``min_docs``
    documents or more, ``n_lines`` before and ``n_dropped``."""
    lost = shared_lines(docs, min_docs, min_chars, batches)
    # whole rows travel as one struct, so no column of theirs clashes with one made here
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_who())
    # a column of its own: inside the lambda below the text would be split again for every line
    found = rows.join(lost, WHO, "left").select("row", "lost", lines_of(F.col("row.text")).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    text = F.when(F.col("lost").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    made = F.struct(text.alias("text"), F.size("lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"))
    return found.select("row", made.alias("made")).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c != out], F.col("made").alias(out))
