import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from levyline.ml import evaluation, families, training
from levyline.ml.features import FilingHistory, FilingHistoryModel

ROW = "application_id STRING, customer_id STRING, province STRING, taxable_income DOUBLE, employment_type STRING, employment_status STRING, filing_status STRING"


def rows(spark, *values):
    return spark.createDataFrame([(a, c, "GAUTENG", i, e, "FULL_TIME", "RETURNING") for a, c, i, e in values], ROW)


def by_id(df):
    return {r["application_id"]: r for r in df.collect()}


def test_ratio_and_ceiling(spark):
    df = rows(spark, ("a", "C1", 325_000.0, "EMPLOYED"), ("b", "C2", 60_000.0, "unemployed"))
    got = by_id(FilingHistory().fit(df).fitted_rows(df))
    assert (got["a"]["income_ratio"], got["a"]["above_ceiling"]) == (0.5, 0.0)
    assert (got["b"]["income_ratio"], got["b"]["above_ceiling"]) == (2.0, 1.0)
    assert got["b"]["log_income"] == pytest.approx(math.log1p(60_000))


def test_filings_include_the_row_itself(spark):
    df = rows(spark, ("a", "C1", 1.0, "X"), ("b", " C1", 1.0, "X"), ("c", "C1", 1.0, "X"), ("d", "C2", 1.0, "X"), ("e", " ", 1.0, "X"))
    got = by_id(FilingHistory().fit(df).fitted_rows(df))
    assert [got[i]["customer_filings"] for i in "abcde"] == [3, 3, 3, 1, 1]


def test_scoring_adds_unseen_rows_only_once(spark):
    seen = rows(spark, ("a", "C1", 1.0, "X"), ("b", "C1", 1.0, "X"))
    model = FilingHistory().fit(seen)
    new = rows(spark, ("n", "C1", 1.0, "X"), ("m", "C9", 1.0, "X"), ("a", "C1", 1.0, "X"))
    got = by_id(model.transform(new))
    assert [got[i]["customer_filings"] for i in ("n", "m", "a")] == [3, 1, 2]


def test_dirty_row(spark):
    df = spark.createDataFrame([(None, "abc", "freelancer")], "province STRING, taxable_income STRING, employment_type STRING")
    row = FilingHistory().fit(df).fitted_rows(df).first()
    assert (row["taxable_income"], row["customer_filings"], row["province"], row["employment_type"], row["income_ratio"]) == (
        0.0, 1.0, "UNKNOWN", "FREELANCER", 0.0)
    assert row["employment_status"] == "UNKNOWN"


def test_history_round_trip(spark, tmp_path):
    df = rows(spark, ("a", "C1", 1.0, "X"), ("b", "C1", 1.0, "X"))
    FilingHistory().fit(df).save(str(tmp_path / "h"))
    loaded = FilingHistoryModel.load(spark, str(tmp_path / "h"))
    assert by_id(loaded.transform(df))["a"]["customer_filings"] == 2


# fixed values: ten labels and scores with known metrics
Y = [0, 0, 0, 0, 0, 0, 1, 1, 1, 1]
P = [.05, .1, .15, .2, .3, .55, .5, .6, .8, .9]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(list(zip(P, Y)), "score DOUBLE, label INT")


def test_metrics_at_half(scored):
    m = evaluation.metrics_at(scored, 0.5).first()
    assert (m["recall"], m["precision"], m["accuracy"]) == (1.0, 0.8, 0.9)


def test_precision_objective(scored):
    pick = evaluation.pick_threshold(evaluation.pr_curve(scored), "precision", min_recall=0.5).first()
    assert pick["precision"] == 1.0 and pick["feasible"] and pick["threshold"] == 0.6


def test_infeasible_floor_falls_back_to_f1(scored):
    curve = evaluation.pr_curve(scored)
    free = evaluation.pick_threshold(curve, "f1").first()
    stuck = evaluation.pick_threshold(curve, "recall", min_precision=1.01).first()
    assert not stuck["feasible"] and stuck["threshold"] == free["threshold"]


def test_no_scores_give_one_half(spark):
    empty = spark.createDataFrame([], "score DOUBLE, label INT")
    assert evaluation.pick_threshold(evaluation.pr_curve(empty)).first().asDict() == {
        "threshold": 0.5, "precision": 0.0, "recall": 0.0, "f1": 0.0, "feasible": False}


def test_curve_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    p = np.round(rng.random(500), 2)
    y = (rng.random(500) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "score DOUBLE, label INT")
    curve = evaluation.pr_curve(df, n_ranges=5)
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in curve.collect()}
    assert set(got) == set(p)
    last, ap = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        flagged = p >= t
        want = (y[flagged].mean(), y[flagged].sum() / y.sum())
        assert got[t] == pytest.approx(want)
        ap += (want[1] - last) * want[0]
        last = want[1]
    assert evaluation.average_precision(curve).first()[0] == pytest.approx(ap)


def test_confusion_cells_and_class_report(scored):
    cells = {(r["label"], r["predicted"]): r["n"] for r in evaluation.confusion_matrix(scored, 0.5).collect()}
    assert cells == {(1, 1): 4, (0, 1): 1, (1, 0): 0, (0, 0): 5}
    report = {r["label"]: r for r in evaluation.class_report(scored, 2.0).collect()}
    assert report[1]["precision"] == 0.0 and report[1]["support"] == 4 and report[0]["recall"] == 1.0


def test_trial_scores_follow_the_objective(spark):
    trials = spark.createDataFrame(
        [("a", 0.2, 0.9, 0.4, 0.7, True), ("b", 0.8, 0.1, 0.3, 0.6, False), ("c", None, None, None, None, None)],
        "label STRING, cv_precision DOUBLE, cv_recall DOUBLE, cv_f1 DOUBLE, cv_average_precision DOUBLE, feasible BOOLEAN")
    want = {"f1": [0.4, 0.3, None], "average_precision": [0.7, 0.6, None], "recall": [0.9, 0.0, None], "precision": [0.2, 0.0, None]}
    for objective, scores in want.items():
        assert [r["score"] for r in evaluation.with_trial_score(trials, objective).orderBy("label").collect()] == scores


def test_ranges_draw_inside_and_reach_their_ends():
    rng = np.random.default_rng(0)
    assert {families.Ints(3, 5).draw(rng) for _ in range(100)} == {3, 4, 5}
    assert {families.OneOf(("x", None)).draw(rng) for _ in range(50)} == {"x", None}
    drawn = [families.Floats(0.001, 10.0, by_ratio=True).draw(rng) for _ in range(400)]
    assert all(0.001 <= x <= 10 for x in drawn) and 0.3 < np.mean(np.array(drawn) < 0.1) < 0.7
    assert all(2 <= families.Floats(2, 2.5).draw(rng) <= 2.5 for _ in range(50))


@pytest.mark.parametrize("make", [
    lambda: families.Ints(4, 3), lambda: families.Floats(2.0, 1.0), lambda: families.Floats(0.0, 1.0, by_ratio=True), lambda: families.OneOf(()),
])
def test_empty_ranges_cannot_be_made(make):
    with pytest.raises(ValueError):
        make()


@pytest.mark.parametrize("family,ranges", [
    ("svm", {}), ("gradient_boosting", {"l2_regularization": families.Floats(0, 1)}), ("logistic_regression", {"depth": families.Ints(1, 2)}),
    ("logistic_regression", {"C": 3.0}),
])
def test_settings_refuse_what_has_no_effect(family, ranges):
    with pytest.raises(ValueError, match="unknown model family|effective|range"):
        families.settings(family, ranges, 1, np.random.default_rng(0))


def test_settings_start_with_the_default():
    found = families.settings("random_forest", {"max_depth": families.Ints(2, 3)}, 3, np.random.default_rng(1))
    assert [s.label for s in found] == ["default", "trial 1", "trial 2", "trial 3"] and found[0].is_default
    assert all(s.params["max_depth"] in (2, 3) and s.params["n_estimators"] == 300 for s in found[1:])


def test_depth_above_the_limit_is_refused():
    with pytest.raises(ValueError, match="max_depth"):
        families.classifier("random_forest", {**families.DEFAULT_PARAMS["random_forest"], "max_depth": 31}, 1, 1.0)


@pytest.fixture(scope="module")
def labelled(spark):
    """Fraud when the income is far above the ceiling, plus some noise."""
    n = F.col("id")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("EMPLOYED", "SELF_EMPLOYED", "CONTRACTOR", "UNEMPLOYED")]), (n % 4 + 1).cast("int"))
    df = spark.range(1200).select(
        F.concat(F.lit("S"), n).alias("application_id"), F.concat(F.lit("C"), n % 300).alias("customer_id"),
        F.lit("GAUTENG").alias("province"), kind.alias("employment_type"), F.lit("FULL_TIME").alias("employment_status"),
        F.lit("AMENDED").alias("filing_status"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) * F.when(n % 11 == 0, 3.0).otherwise(0.6)).cast("double").alias("taxable_income"),
        (n % 11 == 0).alias("is_fraud"),
    )
    return df


@pytest.mark.parametrize("family,params", [
    ("random_forest", {"n_estimators": 10, "max_depth": 6}), ("gradient_boosting", {"max_iter": 5}), ("logistic_regression", {}),
])
def test_each_family_learns(spark, labelled, family, params):
    model = training.train(labelled, family, params, folds=2)
    scored = model.score(labelled)
    low, high = scored.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0 <= low < high <= 1
    assert set(scored.columns) == set(labelled.columns) | {"fraud_probability", "predicted_fraud"}
    assert model.metrics["f1_score"] > 0.3 and model.metrics["average_precision"] > 0.3


def test_model_round_trip(spark, labelled, tmp_path):
    model = training.train(labelled, "logistic_regression", folds=2)
    path = str(tmp_path / "model")
    model.save(path)
    again = training.FraudModel.load(spark, path)
    key = "application_id"
    before = {r[key]: r["fraud_probability"] for r in model.score(labelled).collect()}
    assert before == {r[key]: r["fraud_probability"] for r in again.score(labelled).collect()}
    assert again.threshold == model.threshold and json.dumps(again.pick) == json.dumps(model.pick)


def test_guards(spark, labelled):
    with pytest.raises(ValueError, match="not enough"):
        training.train(labelled.limit(20), "logistic_regression")
    with pytest.raises(ValueError, match="single class"):
        training.train(labelled.where("NOT is_fraud"), "logistic_regression")
    with pytest.raises(ValueError, match="objective"):
        training.train(labelled, "logistic_regression", objective="luck")
    with pytest.raises(ValueError, match="n_trials"):
        training.tune(labelled, ["logistic_regression"], n_trials=0)


def test_split_is_exact_per_class(labelled):
    split = training.with_split(training.labelled(labelled))
    got = {(r["label"], r["is_test"]): r["count"] for r in split.groupBy("label", "is_test").count().collect()}
    assert got == {(1, True): 22, (1, False): 88, (0, True): 218, (0, False): 872}


def test_one_failed_trial_does_not_stop_the_search(spark, labelled):
    space = {"random_forest": {"max_depth": families.Ints(31, 40), "n_estimators": families.Ints(3, 3)}}
    old = dict(families.DEFAULT_PARAMS["random_forest"])
    families.DEFAULT_PARAMS["random_forest"].update(n_estimators=3, max_depth=4)
    try:
        trials, best, default = training.tune(labelled, ["random_forest"], space, n_trials=1, folds=2)
    finally:
        families.DEFAULT_PARAMS["random_forest"].update(old)
    ranked = training.rank_trials(trials).orderBy("rank").collect()
    assert [r["label"] for r in ranked] == ["default", "trial 1"]
    assert "max_depth" in ranked[1]["error"] and ranked[1]["score"] is None
    assert best.metrics["threshold"] == best.threshold and default.family == "random_forest"
    assert training.best_per_family(trials).count() == 1 and training.default_per_family(trials).count() == 1
