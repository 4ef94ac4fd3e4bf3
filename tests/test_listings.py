"""Page chains, covered intervals, and ingests that use them."""
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from runlens.functions.common import to_epoch_ms_strict
from runlens.sources import landed as S
from runlens.sources.pages import page_chains
from runlens.schemas import RUN_PAGE
from runlens.streaming import coverage as V
from runlens.streaming import ingest as I
from runlens.streaming import watermark as W
from test_pipeline import T0, H, land, run

DAY = 24 * H


def page(day, token, following, n=1, landed_at=None, more=None):
    return {"runs": [run(1000 * day + i, start=T0 + day * DAY + i) for i in range(n)], "has_more": following is not None if more is None else more,
            "next_page_token": following, "start_time_from": T0 + day * DAY, "start_time_to": T0 + (day + 1) * DAY,
            "page_token": token, "landed_at": landed_at}


def chains(spark, scratch, pages):
    land(f"{scratch}/chain/p.json", pages)
    found = page_chains(spark.read.schema(RUN_PAGE).json(f"{scratch}/chain"))
    rows = found.orderBy("start_time_from").collect()
    return [tuple(r)[2:] for r in rows]


def test_chains(spark, scratch):
    long = [page(9, f"t{i}" if i else None, f"t{i + 1}" if i < 40 else None, n=2) for i in range(41)]
    random.Random(1).shuffle(long)
    pages = [
        page(0, None, "a"), page(0, "a", "b", n=3), page(0, "b", None),          # whole
        page(1, None, "a"), page(1, "b", None),                                  # page 'a' lost
        page(2, "a", "b"), page(2, "b", None),                                   # first page lost
        page(3, None, "a"), page(3, "a", "b"), page(3, "b", "a"),                # comes back
        page(4, None, "a"), page(4, None, "a"), page(4, "a", None),              # landed twice
        page(5, None, "a"), page(5, None, "x"), page(5, "a", None), page(5, "x", None),  # two continuations
        page(6, None, "a", landed_at=1), page(6, None, "b", landed_at=2), page(6, "b", None, landed_at=2),  # listed again
        page(7, None, None, more=True),                                          # more, but no token
        page(8, None, None, n=0),                                                # nothing listed
        page(10, None, "", more=True),                                           # an empty token is none
        page(11, "a", "a"), page(11, None, "a"),                                 # points to itself
        *long]
    assert chains(spark, scratch, pages) == [
        (3, 3, 3, 5, "complete", None), (2, 2, 1, 1, "broken", "a"), (2, 2, 0, 0, "headless", ""),
        (3, 3, None, None, "cyclic", None), (3, 2, 2, 2, "complete", None), (4, 3, 2, 2, "forked", None),
        (3, 2, 2, 2, "complete", None), (1, 1, 1, 1, "broken", None), (1, 1, 1, 0, "complete", None),
        (41, 41, 41, 82, "complete", None), (1, 1, 1, 1, "broken", None), (2, 2, None, None, "cyclic", None)]


def test_pages_without_a_window_and_none(spark, scratch):
    land(f"{scratch}/a/p.json", [{"runs": [run(1)], "has_more": True, "next_page_token": "t"}, {"has_more": False, "page_token": "t"}])
    assert [tuple(r) for r in page_chains(spark.read.schema(RUN_PAGE).json(f"{scratch}/a")).collect()] == [
        (None, None, 2, 2, 2, 1, "complete", None)]
    land(f"{scratch}/b/p.json", [])
    assert page_chains(spark.read.schema(RUN_PAGE).json(f"{scratch}/b")).collect() == []


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, start_ms long, end_ms long")


def test_intervals(spark):
    rows = [("a", 0, 5), ("a", 5, 7), ("a", 20, 30), ("a", 22, 25), ("a", 20, 21), ("a", 9, 9), ("a", 12, 11), ("a", None, 5),
            ("b", 3, 4), (None, 1, 2)]
    merged = sorted((tuple(r) for r in V.merged_intervals(frame(spark, rows)).collect()), key=str)
    assert merged == [("a", 0, 7), ("a", 20, 30), ("b", 3, 4), (None, 1, 2)]
    horizons = spark.createDataFrame([("a", 2, 40), ("b", 0, 3), ("c", 1, 9), ("d", 5, 5)], "id string, from_ms long, to_ms long")
    gaps = sorted(tuple(r) for r in V.uncovered_windows(frame(spark, rows), horizons).collect())
    assert gaps == [("a", 7, 20), ("a", 30, 40), ("b", 0, 3), ("c", 1, 9)]


def test_gaps_against_points(spark):
    rng = random.Random(4)
    rows = [(str(k), s, s + rng.randrange(0, 9)) for k in range(6) for s in (rng.randrange(0, 60) for _ in range(rng.randrange(0, 9)))]
    horizons = [(str(k), rng.randrange(0, 20), rng.randrange(30, 70)) for k in range(6)]
    found = V.uncovered_windows(frame(spark, rows), spark.createDataFrame(horizons, "id string, from_ms long, to_ms long")).collect()
    for k, lo, hi in horizons:
        free = {t for t in range(lo, hi) if not any(i == k and s <= t < e for i, s, e in rows)}
        mine = sorted((r.start_ms, r.end_ms) for r in found if r.id == k)
        assert {t for s, e in mine for t in range(s, e)} == free
        assert all(a[1] < b[0] for a, b in zip(mine, mine[1:]))  # the largest windows


def iso(ms):
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc).isoformat()


def test_a_failed_window_is_taken_up_again(spark):
    spark.sql("DROP TABLE IF EXISTS t_cov")
    at = datetime.fromtimestamp((T0 + 10 * DAY) / 1000, tz=timezone.utc)
    windows = lambda **kw: [(w.start_ms - T0, w.end_ms - T0) for w in V.resolve_windows(spark, "t_cov", now=at, **kw)]
    assert windows() == [(9 * DAY, 10 * DAY)]  # nothing known: the last day
    V.write_covered(spark, "t_cov", [W.Window(T0, T0 + 2 * DAY), W.Window(T0 + 3 * DAY, T0 + 5 * DAY)], "x")
    V.write_covered(spark, "t_cov", [W.Window(T0 + 7 * DAY, T0 + 8 * DAY)], "y", state_id="other")
    assert windows() == [(2 * DAY, 3 * DAY), (5 * DAY, 10 * DAY)]  # the failed middle, and what is new
    assert windows(start=iso(T0 - DAY), end=iso(T0 + 3 * DAY)) == [(-DAY, 0), (2 * DAY, 3 * DAY)]  # backfill
    assert windows(lookback=timedelta(days=1)) == [(2 * DAY, 3 * DAY), (4 * DAY, 10 * DAY)]
    V.write_covered(spark, "t_cov", [W.Window(T0 + 2 * DAY, T0 + 3 * DAY)], "z")
    assert windows() == [(5 * DAY, 10 * DAY)] and windows(end=iso(T0 + 4 * DAY)) == []
    with pytest.raises(ValueError):
        windows(start=iso(T0 + DAY), end=iso(T0))
    spark.sql("DROP TABLE IF EXISTS t_cov2")
    V.compact_covered(spark, "t_cov", "t_cov2", "c")
    assert spark.table("t_cov2").count() == 2


def test_ingest_stops_before_a_broken_listing(spark, scratch):
    for t in ("t_chain", "t_chain_state", "t_gaps", "t_gaps_cov"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    land(f"{scratch}/pages/p.json", [page(0, None, None), page(1, None, "a"), page(2, None, None)])
    land(f"{scratch}/outputs/o.json", [])
    land(f"{scratch}/details/d.json", [])
    read = lambda: (S.read_run_pages(spark, f"{scratch}/pages"), S.read_run_outputs(spark, f"{scratch}/outputs"),
                    S.read_run_details(spark, f"{scratch}/details"))
    listed = lambda: page_chains(spark.read.schema(RUN_PAGE).json(f"{scratch}/pages"))
    at = datetime.fromtimestamp((T0 + 3 * DAY) / 1000, tz=timezone.utc)
    end = I.ingest_batch(spark, *read(), log_table="t_chain", state_table="t_chain_state", start=iso(T0), now=at, chains=listed())
    assert end == T0 + DAY and W.read_watermark(spark, "t_chain_state", None) == T0 + DAY
    done = I.ingest_uncovered(spark, *read(), log_table="t_gaps", coverage_table="t_gaps_cov", chains=listed(), start=iso(T0), now=at)
    assert [(w.start_ms - T0, w.end_ms - T0) for w in done] == [(0, DAY), (2 * DAY, 3 * DAY)]
    assert spark.table("t_gaps").select("run_id").distinct().count() == 3  # what has landed of the broken day is logged
    land(f"{scratch}/pages/p2.json", [page(1, "a", None, n=2)])
    done = I.ingest_uncovered(spark, *read(), log_table="t_gaps", coverage_table="t_gaps_cov", chains=listed(), now=at)
    assert [(w.start_ms - T0, w.end_ms - T0) for w in done] == [(DAY, 2 * DAY)]
    assert I.ingest_uncovered(spark, *read(), log_table="t_gaps", coverage_table="t_gaps_cov", chains=listed(), now=at) == []


@pytest.mark.parametrize("text", ["2025-09-24Z", "2025-09-24", "20250924T0000", "2025-09-24 0:0:0", "2025-09-24T02+02:00", "2025-09-24T00:00:00,0Z"])
def test_window_bounds_of_every_shape(spark, text):
    w = W.resolve_window(spark, start=text, end="2025-09-25")
    assert w.start_ms == to_epoch_ms_strict("2025-09-24T00:00:00+00:00") and w.end_ms - w.start_ms == DAY
