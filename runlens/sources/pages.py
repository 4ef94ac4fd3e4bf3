"""Is a listing complete? Landed pages as linked lists.

A listing of a window is a chain: the first page has no token, every page
that has more names the token of the next. A client that follows it knows
when it has reached the end; files do not, and a lost page file looks like a
shorter window. So the chains are followed over the landed pages by pointer
doubling: every page points to the next, and each round the pointers of all
pages jump twice as far. A chain of n pages takes log2(n) rounds, whatever
the number of windows; no window is gathered in one task.

Verdicts of a window, the first that applies:

* ``forked``    one token was landed with different continuations, none later than the others
* ``headless``  the first page is missing
* ``cyclic``    the chain comes back to a page it has left
* ``broken``    a page that has more names no token, or one no page was landed for
* ``complete``  the chain ends in a page that has no more

A page landed again with the same continuation counts once. Of landings that
differ the last one (``landed_at``) is followed, so a window that is listed
again replaces its broken listing. Pages without a request's window form one
window of their own (null bounds).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

WINDOW = ["start_time_from", "start_time_to"]
# The token of a first page: no API hands out an empty one.
FIRST = ""
COMPLETE = "complete"


def _distinct_pages(pages: DataFrame) -> DataFrame:
    """One row per (listing, token): how often it was landed, whether its landings differ, what it continues with."""
    more = F.coalesce(F.col("has_more"), F.lit(False))
    named = F.nullif("next_page_token", F.lit(FIRST))
    goes_on = F.struct(more.alias("more"), F.when(more, named).alias("next"))
    read = pages.select(
        # the window as one text key, so that pages without a window meet too
        F.to_json(F.struct(*WINDOW)).alias("listing"), *WINDOW, F.coalesce("page_token", F.lit(FIRST)).alias("token"),
        "landed_at", goes_on.alias("goes_on"), F.size(F.coalesce("runs", F.array())).alias("n_runs"))
    landings = read.groupBy("listing", *WINDOW, "token", "landed_at").agg(
        F.count(F.lit(1)).alias("n"), F.min("goes_on").alias("one"), F.max(F.struct("goes_on", "n_runs")).alias("other"))
    return landings.groupBy("listing", *WINDOW, "token").agg(
        F.sum("n").alias("n_landed"), F.max(F.struct("landed_at", "other", "one")).alias("last"),
    ).select("listing", *WINDOW, "token", "n_landed", (F.col("last.one") != F.col("last.other.goes_on")).alias("forked"),
             "last.other.goes_on.more", "last.other.goes_on.next", F.col("last.other.n_runs").cast("long").alias("n_runs"))


def _followed(pages: DataFrame) -> DataFrame:
    """(listing, token, at, steps, runs, open): the page that the chain from ``token`` comes to, how many steps and
    runs later; ``open`` where it comes to no end."""
    there = pages.select("listing", F.col("token").alias("next"), F.lit(True).alias("landed"))
    jumps = cut_lineage(
        pages.select("listing", "token", "next", "n_runs").join(there, ["listing", "next"], "left").select(
            "listing", "token", F.when(F.col("landed"), F.col("next")).otherwise(F.col("token")).alias("at"),
            F.when(F.col("landed"), 1).otherwise(0).cast("long").alias("steps"),
            F.when(F.col("landed"), F.col("n_runs")).otherwise(0).cast("long").alias("runs"),
            F.coalesce("landed", F.lit(False)).alias("open")))
    longest = jumps.groupBy("listing").count().agg(F.max("count")).first()[0] or 1
    for _ in range(math.ceil(math.log2(longest + 1))):
        if jumps.where("open").isEmpty():
            break
        far = jumps.select("listing", F.col("token").alias("at"), F.col("at").alias("on"), F.col("steps").alias("more_steps"),
                           F.col("runs").alias("more_runs"), F.col("open").alias("still"))
        # the page jumped to is always there; a closed one points to itself, at no cost
        jumps = cut_lineage(jumps.join(far, ["listing", "at"]).select(
            "listing", "token", F.col("on").alias("at"), (F.col("steps") + F.col("more_steps")).alias("steps"),
            (F.col("runs") + F.col("more_runs")).alias("runs"), "still").withColumnRenamed("still", "open"))
    return jumps


def page_chains(pages: DataFrame) -> DataFrame:
    """One row per listed window of ``pages`` (columns of RUN_PAGE): its bounds, ``n_landed`` page files, ``n_pages``
    distinct pages, ``n_followed`` pages and ``n_runs`` runs on the chain from the first page (null where it is cyclic),
    the ``verdict``, and ``missing_token``, for which no page was landed."""
    found = cut_lineage(_distinct_pages(pages))
    whole = found.groupBy("listing", *WINDOW).agg(
        F.sum("n_landed").alias("n_landed"), F.count(F.lit(1)).alias("n_pages"), F.max("forked").alias("forked"),
        F.max(F.col("token") == FIRST).alias("has_first"))
    ends = found.select("listing", F.col("token").alias("at"), F.col("more").alias("goes_on"), "next", "n_runs")
    first = _followed(found).where(F.col("token") == FIRST).join(ends, ["listing", "at"]).select(
        "listing", (F.col("steps") + 1).alias("steps"), (F.col("runs") + F.col("n_runs")).alias("n_runs"), "open", "goes_on",
        "next")
    known = F.col("has_first") & ~F.col("open")
    return whole.join(first, "listing", "left").select(
        *WINDOW, "n_landed", "n_pages",
        F.when(~F.col("has_first"), 0).when(known, F.col("steps")).cast("long").alias("n_followed"),
        F.when(~F.col("has_first"), 0).when(known, F.col("n_runs")).cast("long").alias("n_runs"),
        F.when(F.col("forked"), "forked").when(~F.col("has_first"), "headless").when(F.col("open"), "cyclic")
        .when(F.col("goes_on"), "broken").otherwise(COMPLETE).alias("verdict"),
        F.when(~F.col("has_first"), F.lit(FIRST)).when(known & F.col("goes_on"), F.col("next")).alias("missing_token"),
    )
