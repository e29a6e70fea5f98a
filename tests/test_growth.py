"""Work and memory of a task that must not grow with the tables."""

import re

from pyspark.sql import functions as F
from test_scale import _shuffled

from tallyloom.operators import joins as jn
from tallyloom.operators import prepare as pp
from tallyloom.plans import catalog, metrics  # noqa: F401  (registers the queries)
from tallyloom.plans.registry import BUILDERS
from tallyloom.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_large_joins_get_more_parts(spark):
    """20,000 rows at 1,000 a task: 20 parts, not the session's 8; no row is lost, and a small join is left alone."""
    left, right = spark.range(20_000).select((F.col("id") % 5000).alias("a")), spark.range(4000).withColumnRenamed("id", "b")
    out = jn.spread_join(left, right, "a", "b", most=1000)
    assert re.search(r"hashpartitioning\(a#\d+L, 20\)", _plan(out)) and out.count() == 16_000
    small = jn.spread_join(left, right, "a", "b")
    assert "20)" not in _plan(small) and small.count() == 16_000


def test_both_sets_of_a_drift_report_come_from_one_join(spark):
    plan = _plan(metrics.both(Tables(spark, FOLDER)))
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_clipping_joins_the_lines_once(spark):
    """The passes for the quantiles and the result read a written table, not the join."""
    plan = _plan(BUILDERS["out_clip_quantile"](spark, FOLDER))
    assert "Join" not in plan and "lineitem" not in plan


def test_forest_rounds_do_not_join_the_rows(spark):
    """Only the last join moves rows; a join with the round before would move them twice more in each round."""
    v = F.xxhash64("id") % 1000
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 != 0, v.cast("double")).alias("a"), (v * 2 + F.col("id") % 3).cast("double").alias("b")).cache()
    before = _shuffled(spark)
    assert pp.forest_impute(df, ["a", "b"], "id", rounds=3, trees=1, depth=2).where("a is null").count() == 0
    assert _shuffled(spark) - before < 3 * 3000


def test_master_table_joins_the_lines_once(spark):
    """The blocks read the written valid lines; only payments, cards and the first sale, which take other lines, read the item lines."""
    plan = _plan(BUILDERS["fb_master_at_date"](spark, FOLDER))
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 3
