"""The panel holds, at each date, what the single-date blocks hold, and reads its tables as often for many dates as for one."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import panel as pn
from tallyloom.plans import catalog, features  # noqa: F401  (registers the queries)
from tallyloom.plans.registry import PARTS
from tallyloom.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"
END = dt.date(1998, 12, 31)


def same(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6) if isinstance(a, float) else a == b


def test_panel_at_one_date_is_the_master_table(spark):
    """The end of the default period, with its 364 days; events and the future target have other dates there."""
    t = Tables(spark, FOLDER)
    master = PARTS["fb_master_at_date"][0](t)
    panel = features.panel_at(t, pn.Grid([END, END - dt.timedelta(days=40)], lookback=364)).where(F.col("ref_date") == F.lit(END))
    other = ("target_", "visits_", "installs_", "second_app_")
    names = {c: c for c in master.columns if not c.startswith(other)}
    names["price_asp_capped"] = "orders_asp_capped"
    want = {r["customer_id"]: r for r in master.collect()}
    got = {r["customer_id"]: r for r in panel.collect()}
    assert want.keys() == got.keys() and len(want) > 10
    wrong = {(k, c) for k in want for c in names if not same(want[k][c], got[k][names[c]])}
    assert not wrong


def _plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_scans_and_exchanges_do_not_grow_with_the_dates(spark):
    t = Tables(spark, FOLDER)
    counts = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in (1, 14):
            plan = _plan(features.panel_at(t, pn.Grid(features.PANEL_DATES[:n])))
            counts.append((len(re.findall(r"FileScan|Scan ExistingRDD", plan)), len(re.findall(r"Exchange hashpartitioning", plan))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert counts[0] == counts[1]


def test_population_is_whole_unless_a_sample_is_asked_for(spark):
    """More buyers than the default sample of a date had."""
    lines = spark.range(310_000).select(F.col("id").alias("buyer_id"), F.lit("1998-10-01").cast("date").alias("closed"))
    assert pn.population_at(lines, pn.Grid([END])).count() == 310_000


def test_population_is_drawn_for_each_date(spark):
    days = [END - dt.timedelta(days=i) for i in (0, 30)]
    lines = spark.range(4000).select(F.col("id").alias("buyer_id"), F.lit("1998-10-01").cast("date").alias("closed"))
    grid = pn.Grid(days)
    first = [tuple(r) for r in pn.population_at(lines, grid, 500).collect()]
    again = [tuple(r) for r in pn.population_at(lines.repartition(7), grid, 500).collect()]
    assert sorted(first) == sorted(again) and len(set(first)) == len(first)
    parts = [{c for c, d in first if d == day} for day in days]
    assert all(400 < len(p) < 600 for p in parts) and len(parts[0] & parts[1]) < 120
    assert pn.population_at(lines, grid, 5000).count() == 8000


def test_windows_include_both_ends_and_skip_nulls(spark):
    rows = spark.createDataFrame([(i, END - dt.timedelta(days=i)) for i in range(-3, 5)] + [(99, None)], "i int, day date")
    at = pn.listed(rows, pn.Grid([END, END - dt.timedelta(days=2)]), ("day", -1, 0))
    assert sorted((r["i"], (END - r["ref_date"]).days) for r in at.collect()) == [(0, 0), (1, 0), (2, 2), (3, 2)]
    open_ = pn.listed(rows, pn.Grid([END]), ("day", None, -2))
    assert sorted(r["i"] for r in open_.collect()) == [2, 3, 4]


@pytest.mark.parametrize("empty", ["1970-01-01"])
def test_no_buyer_at_any_date(spark, empty):
    t = Tables(spark, FOLDER)
    assert features.panel_at(t, pn.Grid([dt.date.fromisoformat(empty)])).isEmpty()
