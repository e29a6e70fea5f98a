"""Known parameters are recovered from simulated data; models beat chance."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import causal as ce
from tallyloom.operators import evaluate as ev
from tallyloom.operators import ltv
from tallyloom.operators import models as ml
from tallyloom.operators import optimize
from tallyloom.operators import uplift as up
from tallyloom.operators.moments import collect_moments, ols


def simulate_purchases(n, r, alpha, a, b, seed=0):
    rng = np.random.default_rng(seed)
    age = rng.integers(20, 60, n).astype(float)
    rate, leave = rng.gamma(r, 1 / alpha, n), rng.beta(a, b, n)
    x, s = np.zeros(n), np.zeros(n)
    alive = rng.random(n) >= leave
    clock = np.zeros(n)
    active = alive.copy()
    while active.any():
        clock = np.where(active, clock + rng.exponential(1 / rate), clock)
        active &= clock <= age
        x, s = np.where(active, x + 1, x), np.where(active, clock, s)
        active &= rng.random(n) >= leave
    return pd.DataFrame({"frequency": x, "recency": s, "age": age})


def test_purchase_model_recovers_parameters(spark):
    pdf = simulate_purchases(20000, 1.5, 6.0, 2.5, 6.0)
    pdf["recency"] = pdf["recency"].round(1)
    model = ltv.fit_purchases(spark.createDataFrame(pdf), iterations=40)
    assert model.r == pytest.approx(1.5, rel=0.15) and model.alpha == pytest.approx(6.0, rel=0.15)
    assert model.a / (model.a + model.b) == pytest.approx(2.5 / 8.5, rel=0.1)
    for found, error, true in zip(model.fit.parameters, model.fit.errors, (1.5, 6.0, 2.5, 6.0), strict=True):
        assert 0 < error < true and abs(found - true) < 2 * error
    assert model.fit.customers == 20000 and model.fit.jobs <= 20


def test_predictions_match_simulation(spark):
    """Formulas for P(alive) and expected purchases against values simulated once from the model."""
    model = ltv.PurchaseModel(1.5, 6.0, 2.5, 3.0)
    data = spark.createDataFrame([(0, 0.0, 20.0)], "frequency long, recency double, age double")
    row = data.select(ltv.p_alive(model).alias("p"), ltv.expected_purchases(model, 15.0).alias("e")).first()
    assert row["p"] == pytest.approx(0.1174, abs=2e-4) and row["e"] == pytest.approx(0.0800, abs=2e-4)


def test_value_model_recovers_parameters(spark):
    rng = np.random.default_rng(1)
    n, p, q, v = 20000, 6.0, 4.0, 15.0
    nu = rng.gamma(q, 1 / v, n)
    x = rng.integers(1, 8, n)
    m = rng.gamma(p * x, 1 / nu) / x
    model = ltv.fit_values(spark.createDataFrame(pd.DataFrame({"frequency": x - 1, "value": m})))
    assert (model.p, model.q, model.v) == (pytest.approx(p, rel=0.2), pytest.approx(q, rel=0.2), pytest.approx(v, rel=0.35))
    for found, error, true in zip(model.fit.parameters, model.fit.errors, (p, q, v), strict=True):
        assert 0 < error < true and abs(found - true) < 2 * error
    assert model.fit.jobs <= 20


def test_curves_and_errors_of_a_known_likelihood(spark):
    """Exponential waiting times: the rate is 1 / mean, its standard error rate / sqrt(n)."""
    x = np.random.default_rng(12).exponential(2.0, 500)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "__n": 1}))
    fit = ltv.fit_likelihood(df, ["x"], lambda p, x: p[0] - np.exp(p[0]) * x, [5.0])
    assert fit.parameters[0] == pytest.approx(1 / x.mean(), rel=1e-6)
    assert fit.errors[0] == pytest.approx(1 / x.mean() / np.sqrt(500), rel=1e-4) and fit.customers == 500
    a = np.array([[2.0, 0.5], [0.5, 1.0]])
    found = optimize.curve([float(-0.5 * p @ a @ p + p[0]) for p in optimize.stencil(np.array([0.3, -0.2]))], 2)
    assert np.allclose(found.hessian, -a, atol=1e-6) and np.allclose(found.gradient, [1 - 0.5, 0.05], atol=1e-9)


@pytest.fixture(scope="module")
def observed(spark):
    """Treatment depends on x; the effect is 2."""
    rng = np.random.default_rng(7)
    n = 6000
    x, z = rng.normal(size=n), rng.normal(size=n)
    e = 1 / (1 + np.exp(-0.8 * x))
    w = (rng.random(n) < e).astype(int)
    y = 2.0 * w + 1.5 * x + 0.5 * z + rng.normal(size=n)
    pdf = pd.DataFrame({"id": range(n), "x": x, "z": z, "w": w, "y": y, "e": e})
    return spark.createDataFrame(pdf).persist(), pdf


def test_ols_matches_numpy(observed):
    df, pdf = observed
    fit = ols(collect_moments(df, ["w", "x", "z"], "y")[()], ["w", "x", "z"])
    design = np.column_stack([np.ones(len(pdf)), pdf.w, pdf.x, pdf.z])
    beta, rss, *_ = np.linalg.lstsq(design, pdf.y, rcond=None)
    se = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / (len(pdf) - 4))
    assert np.allclose([fit[k]["estimate"] for k in ("intercept", "w", "x", "z")], beta)
    assert np.allclose([fit[k]["std_error"] for k in ("intercept", "w", "x", "z")], se)


def test_estimators_recover_the_effect(observed):
    df, _ = observed
    effects = {r["method"]: r["effect"] for r in ce.compare(df, "y", "w", ["x", "z"], "e", "id").collect()}
    for name in ("linear", "s_learner", "t_learner", "x_learner", "r_learner"):
        assert effects[name] == pytest.approx(2.0, abs=0.12), name
    assert effects["ipw"] == pytest.approx(2.0, abs=0.3)
    assert effects["matching"] == pytest.approx(2.0, abs=0.35) and effects["stratification"] == pytest.approx(2.0, abs=0.25)
    assert effects["biased"] > 2.5


def test_refutations(observed):
    df, _ = observed
    plain = ce.s_learner(df, "y", "w", ["x", "z"])
    assert abs(ce.placebo(df, "id", "w", lambda d, w: ce.s_learner(d, "y", w, ["x", "z"]))) < 0.15
    assert ce.random_cause(df, "id", ["x", "z"], lambda d, xs: ce.s_learner(d, "y", "w", xs)) == pytest.approx(plain, abs=0.02)
    shifted = df.withColumn("y", F.abs("y"))
    assert abs(ce.dummy_outcome(shifted, "id", "y", lambda d, y: ce.s_learner(d, y, "w", ["x", "z"]))) < 0.2


def test_propensity_model(observed):
    df, _ = observed
    gap = ce.propensity(df, "w", ["x", "z"], "p").agg(F.avg(F.abs(F.col("p") - F.col("e")))).first()[0]
    assert gap < 0.03


def test_instrument(spark):
    rng = np.random.default_rng(2)
    n = 20000
    z, u = rng.integers(0, 2, n), rng.normal(size=n)
    c = ((z == 1) & (u > 0)).astype(int)
    y = 1.0 * c + u + rng.normal(size=n)
    row = ce.two_stage(spark.createDataFrame(pd.DataFrame({"z": z, "c": c, "y": y})), "y", "c", "z").first()
    assert row["estimate"] == pytest.approx(1.0, abs=4 * row["std_error"]) and row["std_error"] < 0.1


def test_series_impact(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2024-01-01", periods=120)
    x = rng.normal(100, 10, 120)
    y = 5 + 0.7 * x + rng.normal(0, 0.1, 120)
    y[90:] += 6
    df = spark.createDataFrame(pd.DataFrame({"day": days.date, "y": y, "x": x, "s": "a"}))
    cut = F.lit("2024-03-30").cast("date")
    one = ce.series_impact(df, "s", "day", "y", "x", cut, F.date_add(cut, 1)).orderBy(F.desc("day")).first()["cumulative"]
    many = ce.series_impact_many(df, "day", "y", ["x"], cut, F.date_add(cut, 1)).orderBy(F.desc("day")).first()["cumulative"]
    assert one == pytest.approx(180, abs=3) and many == pytest.approx(one)


def test_beta_draws(spark):
    row = ce.beta_draws(spark, 80.0, 920.0, 20000, "s").agg(F.avg("draw").alias("m"), F.stddev("draw").alias("s")).first()
    assert row["m"] == pytest.approx(0.08, abs=5e-4) and row["s"] == pytest.approx(0.00857, abs=3e-4)


def test_uplift_split_finds_the_effect(spark):
    rng = np.random.default_rng(5)
    n = 8000
    a, b, w = rng.random(n), rng.random(n), rng.integers(0, 2, n)
    y = (rng.random(n) < 0.2 + 0.5 * w * (a > 0.6)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "w": w, "y": y}))
    best = up.best_split(df, ["a", "b"], "y", "w").first()
    assert best["feature"] == "a" and best["cut"] == pytest.approx(0.6, abs=0.05)


def test_uplift_models_rank_the_responders(spark):
    rng = np.random.default_rng(6)
    n = 4000
    a, b, w = rng.random(n), rng.random(n), rng.integers(0, 2, n)
    y = (rng.random(n) < 0.1 + 0.6 * w * (a > 0.5)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": range(n), "a": a, "b": b, "w": w, "y": y})).persist()
    for build in (ml.uplift_solo, ml.uplift_class_transform, ml.uplift_x, lambda *x: ml.uplift_two_models(*x, chain="treated")):
        scored = build(df, "y", "w", ["a", "b"])
        high, low = (scored.where(c).agg(F.avg("uplift")).first()[0] for c in ("a > 0.6", "a < 0.4"))
        assert high - low > 0.3
    meta = ml.uplift_meta(df, "y", "w", ["a", "b"]).withColumn("responds", (F.col("a") > 0.5).cast("int")).persist()
    for letter in "stx":
        assert ev.auc_ks_accuracy(meta.withColumn("p", F.col(f"uplift_{letter}")), "p", "responds").first()["auc"] > 0.9, letter
    assert meta.count() == n and {r["w"] for r in meta.select("w").distinct().collect()} == {0, 1}
    assert ev.auc_ks_accuracy(scored, "uplift", "y").first()["auc"] > 0.5


def test_segment_regressors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": range(600), "s": np.where(np.arange(600) % 2 == 0, "u", "v"), "x": rng.random(600)})
    pdf["y"] = np.where(pdf.s == "u", 10 * pdf.x, -10 * pdf.x)
    df, seen = spark.createDataFrame(pdf), []
    fit = ml.fit
    monkeypatch.setattr(ml, "fit", lambda rows, *rest: seen.append(rows.count()) or fit(rows, *rest))
    models, errors = ml.segment_regressors(df, "s", "id", "y", ["x"], ["u", "v"])
    assert sum(seen) == ml.train_test(df, "id", 0.2, "segments", ["s"]).where("split = 'train'").count()
    assert set(models) == {"u", "v"} and all(r["mae"] < 2 for r in errors.collect())
