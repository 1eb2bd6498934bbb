"""Whole orders, ranks and running values against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from rinkline.operators import ordering


@pytest.fixture(autouse=True)
def small_ranges_stay(spark):
    """Else the few rows of a test would lie in one range."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def _rows():
    draw = random.Random(4)
    rows = [(draw.choice(["hot"] * 6 + ["b", "c", None]), i, draw.choice([1, 2, 2, 3, None])) for i in range(2000)]
    draw.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "key string, id long, value long")


def test_row_numbers_are_the_whole_order(spark):
    rows = _rows()
    got = ordering.row_numbers(_frame(spark, rows), [F.col("value").desc_nulls_last(), F.col("id")]).collect()
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
    assert [(r.key, r.id, r.value) for r in sorted(got, key=lambda r: r.row_number)] == want
    assert sorted(r.row_number for r in got) == list(range(1, len(rows) + 1))
    assert ordering.row_numbers(_frame(spark, []), [F.col("id")]).count() == 0


def test_ranks_are_shared_by_ties(spark):
    rows = _rows()
    got = ordering.ranks(_frame(spark, rows), ["value"], [F.col("value").desc_nulls_last(), F.col("id")]).collect()
    place = lambda v: (v is None, -(v or 0))
    assert len(got) == len(rows) and all(r.rank == 1 + sum(place(x[2]) < place(r.value) for x in rows) for r in got[:200])
    assert {r.value: r.rank for r in got} == {v: 1 + sum(place(x[2]) < place(v) for x in rows) for v in (1, 2, 3, None)}


def test_running_values_on_a_key_in_many_ranges(spark):
    rows = _rows()
    frame = _frame(spark, rows)
    values = {"total": ("sum", F.col("value")), "most": ("max", F.col("value")), "least": ("min", F.col("id"))}
    laid = ordering.laid_out(frame, [F.col("key"), F.col("id")])
    assert laid.where("key = 'hot'").select(ordering._PART).distinct().count() > 1
    got = {(r.key, r.id): (r.total, r.most, r.least) for r in ordering.running(frame, ["key"], [F.col("id")], values).collect()}
    assert len(got) == len(rows)
    for key in ("hot", "b", "c", None):
        seen, ids = [], []
        for k, i, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            ids.append(i)
            if v is not None:
                seen.append(v)
            assert got[k, i] == (sum(seen) if seen else None, max(seen, default=None), min(ids))
    assert ordering.running(_frame(spark, []), ["key"], [F.col("id")], values).count() == 0


def test_islands_are_runs(spark):
    rows = _rows()
    got = ordering.islands(_frame(spark, rows), ["key"], "value", [F.col("id")]).groupBy("key", "value", "island").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    want, last = [], {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        if last.get(k, (object(),))[0] == v:
            want[last[k][1]][3] += 1
        else:
            last[k] = (v, len(want))
            want.append([k, v, i, 1])
    assert sorted(((r.key, r.value, r.first, r.n) for r in got), key=repr) == sorted(map(tuple, want), key=repr)


def test_no_window_over_all_rows(spark):
    """Every window of the plan over the rows themselves is parted by range and key; the others see a row or two per range."""
    plan = ordering.running(_frame(spark, _rows()), [], [F.col("id")], {"total": ("sum", F.col("value"))})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and sum("_rinkline_at" in w and "_rinkline_part" in w for w in windows) == 1
