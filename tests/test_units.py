"""Hand-worked cases."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import arrays, dates, stats, text
from tallyloom.operators import aggregates as ag
from tallyloom.operators import budget as bd
from tallyloom.operators import causal as ce
from tallyloom.operators import drift as dr
from tallyloom.operators import evaluate as ev
from tallyloom.operators import joins as jn
from tallyloom.operators import labels as lb
from tallyloom.operators import ltv
from tallyloom.operators import monitor as mn
from tallyloom.operators import orders as od
from tallyloom.operators import prepare as pp
from tallyloom.operators import ranking as rk
from tallyloom.operators import segments as sg
from tallyloom.sources import files, keyed


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def one(df):
    return df.first().asDict()


def test_quantile_segments_sizes(spark):
    eleven = rows(spark, [(i, float(i)) for i in range(11)], "id long, v double")
    sizes = dict(sg.quantile_segments(eleven, sg.SHARES_4, "v", "id").groupBy("segment").count().collect())
    assert sizes == {"q1": 1, "q2": 1, "q3": 2, "q4": 7}
    twenty = rows(spark, [(i, float(i)) for i in range(20)], "id long, v double")
    sizes = dict(sg.quantile_segments(twenty, sg.SHARES_6, "v", "id").groupBy("segment").count().collect())
    assert sizes == {"q1": 2, "q2": 2, "q3": 2, "q4": 2, "q5": 2, "q6": 10}


def test_ab_split_rest_goes_to_last(spark):
    eleven = rows(spark, [(i,) for i in range(11)], "id long")
    assert dict(sg.ab_split(eleven, "id", ["TG", "CG"], [0.5, 0.5]).groupBy("group").count().collect()) == {"TG": 5, "CG": 6}


def test_categorical_drift(spark):
    base = rows(spark, [("a",)] * 5 + [("b",)] * 5, "c string")
    current = rows(spark, [("a",)] * 7 + [("b",)] * 3, "c string")
    scores = dr.categorical_scores(dr.both_sets(base, current), ["c"])
    row = one(dr.flag_categorical(scores))
    assert row["weighted_difference"] == pytest.approx(0.2) and row["drifted"]


def test_categorical_drift_of_one_sided_category(spark):
    base = rows(spark, [("a",)] * 5 + [("b",)] * 5, "c string")
    current = rows(spark, [("a",)] * 5 + [("z",)] * 5, "c string")
    both = dr.both_sets(base, current)
    assert one(dr.categorical_scores(both, ["c"]))["weighted_difference"] == 0
    assert one(dr.categorical_scores(both, ["c"], one_sided=True))["weighted_difference"] == pytest.approx(0.25)


def test_weekly_summary(spark):
    day = dt.date(2024, 1, 1)
    data = [(1, day, 10.0), (1, day + dt.timedelta(2), 20.0), (1, day + dt.timedelta(15), 50.0)]
    out = one(ltv.weekly_summary(rows(spark, data, "customer_id long, day date, sales double"), F.lit(day + dt.timedelta(28))))
    assert (out["frequency"], out["recency"], out["age"], out["value"]) == (1, 2, 4, 50.0)


def test_ab_effects(spark):
    data = [("CG", 1, 0)] * 50 + [("CG", 0, 0)] * 950 + [("1D", 1, 1)] * 80 + [("1D", 0, 1)] * 520 + [("1D", 0, 0)] * 400
    effects = ce.ab_effects(rows(spark, data, "g string, y int, shown int"), "g", "CG", "y", "shown")
    row = ce.with_p_values(effects)[0]
    assert row["ate"] == pytest.approx(0.03) and row["incremental"] == pytest.approx(30) and row["cace"] == pytest.approx(0.05)
    assert row["z"] == pytest.approx(2.7211, abs=1e-4) and row["p_value"] == pytest.approx(0.00651, abs=1e-5)


def test_average_precision(spark):
    data = [(1, 0.9, 1), (2, 0.8, 0), (3, 0.7, 1)]
    assert one(ev.mean_average_precision(rows(spark, data, "id long, s double, y int"), "s", "y", "id"))["map"] == pytest.approx(5 / 6)


def test_pad_sequence(spark):
    df = rows(spark, [([1, 2, 3],), ([1, 2, 3, 4, 5, 6],)], "v array<long>")
    assert [r[0] for r in df.select(arrays.pad_left("v", 5)).collect()] == [[0, 0, 1, 2, 3], [2, 3, 4, 5, 6]]


def test_percent_rank_average(spark):
    df = rows(spark, [(1.0,), (1.0,), (2.0,), (None,)], "v double")
    assert sorted(r["pct_rank"] for r in rk.percent_rank_average(df, "v").collect()) == [0.375, 0.375, 0.75, 1.0]


def test_week_starts(spark):
    df = rows(spark, [(dt.date(2024, 1, 7),)], "d date")
    row = df.select(dates.week_start_sunday("d").alias("s"), dates.week_start_monday("d").alias("m")).first()
    assert (row["s"], row["m"]) == (dt.date(2024, 1, 7), dt.date(2024, 1, 1))


def test_max_number(spark):
    df = rows(spark, [("De R$ 1.200,50 a R$ 3.400,00",), ("none",)], "t string")
    assert [r[0] for r in df.select(text.max_number("t")).collect()] == [3400.0, None]


def test_clip_quantile(spark):
    df = rows(spark, [(float(i),) for i in range(101)], "v double")
    assert pp.clip_upper(df, ["v"], 0.95).agg(F.max("v")).first()[0] == 95.0


def test_greatest_label_first_wins(spark):
    df = rows(spark, [(2, 2, 0, 0)], "desktop int, web int, android int, ios int")
    assert df.select(ag.greatest_label(["desktop", "web", "android", "ios"])).first()[0] == "desktop"


def test_capped_price(spark):
    day = dt.date(2024, 1, 1)
    df = rows(spark, [(1, day, 1000.0, 2, 1)], "customer_id long, day date, sales double, items long, orders long")
    assert one(od.capped_price(df))["asp_capped"] == 700.0


def test_churn_half(spark):
    df = rows(spark, [(9, 3), (9, 4), (1, 0)], "past int, future int")
    assert [r[0] for r in df.select(lb.churn_half("past", "future")).collect()] == [1, 0, 0]


def test_daily_target(spark):
    spend = rows(spark, [("S", dt.date(2024, 1, 20), 40.0)], "site string, day date, amount double")
    full = bd.expand(spend, "2024-01-20", "2024-01-31")
    target = {r["day"]: r["target"] for r in bd.daily_target(full, {"S": 100.0}, "2024-01-31").collect()}
    assert target[dt.date(2024, 1, 21)] == pytest.approx(6.0) and target[dt.date(2024, 1, 31)] == pytest.approx(60.0)


def test_one_to_one_join_fails_on_duplicates(spark):
    left, right = rows(spark, [(1,)], "k int"), rows(spark, [(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(jn.KeyNotUnique):
        jn.join_one_to_one(left, right, ["k"])


def test_replace_keys(spark):
    target = rows(spark, [("A", 1, "old"), ("B", 1, "old")], "site string, day int, v string")
    batch = rows(spark, [("A", 1, "new")], "site string, day int, v string")
    out = {(r["site"], r["v"]) for r in keyed.replace_keys(target, batch, ["site", "day"]).collect()}
    assert out == {("A", "new"), ("B", "old")}


def test_update_by_key(spark):
    target = rows(spark, [(1, "x", "a"), (2, "y", "b")], "k int, other string, v string")
    batch = rows(spark, [(2, "B"), (3, "C")], "k int, v string")
    out = {tuple(r) for r in keyed.update_by_key(target, batch, ["k"], ["v"]).collect()}
    assert out == {(1, "x", "a"), (2, "y", "B"), (3, None, "C")}


def test_typed_load(spark):
    raw = rows(spark, [("7", "1.239", "2024-02-30", "x"), ("z", "q", "2024-02-29", None)], "`a b` string, d string, day string, s string")
    out = files.typed(raw, {"a b": "integer", "d": "decimal(2)", "day": "date", "s": "string"}).collect()
    assert [tuple(r) for r in out] == [(7, 1.24, None, "x"), (None, None, dt.date(2024, 2, 29), None)]


def test_bad_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id|v\n1|a\nnope|b\n3|c\n")
    out = files.read_delimited(spark, str(tmp_path / "x.csv"), "id int, v string", skip_bad_lines=True)
    assert [r["id"] for r in out.collect()] == [1, 3]
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "x.csv"), "id int, v string").collect()


def test_latest_complete(spark):
    paths = rows(spark, [("s/2024-01-01/a",), ("s/2024-01-01/b",), ("s/2024-02-01/a",)], "path string")
    assert files.latest_complete(paths, ["a", "b"]).first()[0] == dt.date(2024, 1, 1)


def test_orders_frequency_bins_share_borders(spark):
    today = dt.date(2024, 3, 31)
    data = [(1, today - dt.timedelta(d), 10.0, 1, 1) for d in (0, 30, 60, 90)]
    out = one(od.orders_frequency(rows(spark, data, "customer_id long, day date, sales double, items long, orders long"), F.lit(today)))
    assert (out["size_0"], out["size_1"], out["size_2"]) == (2, 2, 2)
    assert (out["recency_0"], out["recency_1"], out["recency_2"], out["freq_7d"]) == (0, 30, 60, 1)


def test_reference_dates():
    found = dates.reference_dates(dt.date(2024, 6, 1), seed=3)
    assert len(found) == len(set(found)) == 14
    assert sorted({d.weekday() for d in found}) == list(range(7))


def test_last_yearly_and_nearest(spark):
    d = F.lit(dt.date(2024, 6, 1))
    row = spark.range(1).select(dates.last_yearly(d, 12, 20).alias("a"), dates.nearest_date([dates.last_yearly(d, 12, 20), dates.last_yearly(d, 5, 28)], d).alias("b")).first()
    assert (row["a"], row["b"]) == (dt.date(2023, 12, 20), dt.date(2024, 5, 28))


def test_threshold_fails_when_nothing_is_precise(spark):
    sweep = rows(spark, [(0.1, 0.2, 1.0, 0.9)], "threshold double, precision double, recall double, reach double")
    with pytest.raises(ev.NoThreshold):
        ev.most_precise_threshold(sweep, 0.5)


def test_schedule_skips_other_weekdays(spark):
    jobs = rows(spark, [("S", "b", "i", "daily", "", "8", "30", "9", "0"), ("S", "b", "i", "monday", "LU", "8", "0", "9", "0")],
                "site string, bu string, initiative string, job string, weekday string, start_hour string, start_minute string, end_hour string, end_minute string")
    out = mn.schedule_of(jobs, F.lit(dt.date(2024, 1, 2))).collect()
    assert [r["job"] for r in out] == ["daily"] and out[0]["expected_start"] == dt.datetime(2024, 1, 2, 8, 30)


def test_special_functions():
    assert stats.t_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert stats.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert stats.ks_two_sample(0.1, 1000, 1000) == pytest.approx(0.0000916, abs=2e-5)
    x = np.array([0.1, 0.5, 1.0, 3.7, 20.0, 300.0])
    assert np.allclose(ltv.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-11)
    z = np.array([0.1, 0.5, 0.9])
    # F(1, 1; 2; z) = -log(1 - z) / z
    assert np.allclose(ltv.hyp2f1(np.ones(3), np.ones(3), 2 * np.ones(3), z), -np.log1p(-z) / z)
