"""Learned models: closed forms and invariants."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from tallyloom.operators import customers as K
from tallyloom.operators import regression as R
from tallyloom.operators import sentiment as S
from tallyloom.operators import text as X
from tallyloom.operators import topics as Z
from tallyloom.plans import inputs as I

FOLDER = "/root/testdata/sf0.001"


def test_ridge_matches_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = np.c_[rng.normal(5, 3, 300), rng.normal(0, 50, 300), np.ones(300)]  # the last one is constant
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 4, 300) + 11
    frame = spark.createDataFrame([(*map(float, row), float(t)) for row, t in zip(x, y)], "a double, b double, c double, y double")
    fit = R.ridge(frame.limit(240), frame, ["a", "b", "c"], "y", alpha=10.0)
    kept = np.array([tuple(r) for r in frame.limit(240).collect()])
    mean, dev = kept[:, :3].mean(0), kept[:, :3].std(0)
    dev[dev == 0] = 1
    z = np.c_[np.ones(len(kept)), (kept[:, :3] - mean) / dev]
    penalty = np.diag([0.0, 10.0, 10.0, 10.0])
    w = np.linalg.solve(z.T @ z + penalty, z.T @ kept[:, 3])
    assert fit.intercept == pytest.approx(w[0], abs=1e-6)
    assert list(fit.coefficients.values()) == pytest.approx(list(w[1:]), abs=1e-6)
    rows = fit.predictions.collect()
    expected = [w[0] + ((np.array([r["a"], r["b"], r["c"]]) - mean) / dev) @ w[1:] for r in rows]
    assert [r["predicted"] for r in rows] == pytest.approx(expected, abs=1e-6)
    cosines = {c: kept[:, i] @ kept[:, 3] / np.sqrt((kept[:, i] ** 2).sum() * (kept[:, 3] ** 2).sum()) for i, c in enumerate("abc")}
    cosines["intercept"] = cosines["c"]
    solved = {r["feature"]: r["cosine"] for r in R.normal_equations(fit, "y", ["a", "b", "c"]).collect()}
    assert solved == pytest.approx(cosines, abs=1e-9)
    unlike = R.normal_equations(replace(fit, alpha=0.0), "y", ["a", "b", "c"]).collect()
    assert abs({r["feature"]: r["cosine"] for r in unlike}["b"] - cosines["b"]) > 1e-3  # another penalty is noticed


def test_regression_metrics(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (-1.0, -1.0), (3.0, -1.0), (None, 1.0)], "y double, p double")
    found = {r["metric"]: r["value"] for r in R.regression_metrics(frame, "y", "p").collect()}
    assert found["test_orders"] == 3 and found["mae_profit"] == pytest.approx(5 / 3)
    assert found["rmse_profit"] == pytest.approx(np.sqrt(17 / 3)) and found["r2"] == pytest.approx(1 - 17 / 8)
    assert found["profitability_accuracy"] == pytest.approx(2 / 3)


def test_profit_regression_tests_the_last_orders(spark):
    orders = I.orders(spark, FOLDER)
    fit = R.profit_regression(orders)
    total = orders.count()
    assert fit.predictions.count() == total - int(total * 0.8)
    table = fit.coefficient_table().collect()
    sizes = [abs(r["coefficient"]) for r in table]
    assert sizes == sorted(sizes, reverse=True) and {"intercept", "Technology", "ship_mode_Same Day"} <= {r["feature"] for r in table}
    audit = R.prediction_audit(fit.predictions, 20).collect()
    errors = [r["absolute_error"] for r in audit]
    assert len(errors) == 20 and errors == sorted(errors, reverse=True)
    assert all(r["predicted_profitable"] == int(r["predicted_profit"] > 0) for r in audit)


def test_levels_beyond_any_table_width(spark):
    frame = spark.range(6000).selectExpr("concat('c', id % 1200) AS kind", "cast(id % 1200 % 7 AS double) AS y", "1.0D AS one")
    coded, names = R.encode_levels(frame, ["kind"], "levels")
    assert len(names) == 1199 and "kind_c0" not in names and coded.first()["levels"].size == 1199
    fit = R.ridge(coded, coded, ["one"], "y", 1e-9, "levels", names)
    assert fit.predictions.where("abs(predicted - y) > 1e-3").count() == 0


def test_noise_keeps_rows_without_a_value(spark):
    rows = [(float(x), float(y)) for x in range(3) for y in range(3)] * 4 + [(None, 1.0), (1.0, None)]
    found = K.kmeans_best(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], 2, [1, 2]).collect()
    assert len(found) == len(rows)
    assert [r["cluster_label"] is None for r in found] == [r["a"] is None or r["b"] is None for r in found]


def test_customers_are_in_their_nearest_cluster(spark):
    customers, model = K.customer_clusters(I.customers(spark, FOLDER))
    centres = np.array(model.clusterCenters())
    rows = customers.select("cluster", vector_to_array("features").alias("x")).collect()
    points = np.array([r["x"] for r in rows])
    distances = ((points[:, None, :] - centres[None]) ** 2).sum(2)
    assert all(distances[i, r["cluster"]] <= distances[i].min() + 1e-9 for i, r in enumerate(rows))
    assert np.abs(points.mean(0)).max() < 1e-9 and set(np.round(points.std(0), 6)) <= {0.0, 1.0}
    summary = K.cluster_summary(customers).collect()
    assert sum(r["customers"] for r in summary) == len(rows) == I.customers(spark, FOLDER).count()
    labelled = K.label_customers(customers, K.cluster_summary(customers))
    assert labelled.where("business_label is null").count() == 0


def test_noise_distance_is_to_the_nearest_centre(spark):
    rng = np.random.default_rng(2)
    points = np.r_[rng.normal(0, 1, (40, 2)), rng.normal(50, 1, (40, 2)), rng.normal((0, 90), 1, (40, 2))]
    frame = spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double")
    rows = K.kmeans_best(frame, ["a", "b"], 3, range(4)).collect()
    assert sorted(np.bincount([r["cluster_label"] for r in rows])) == [40, 40, 40]
    assert max(r["centre_distance"] for r in rows) < 6


def test_projection(spark):
    customers = I.customers(spark, FOLDER)
    rows = K.cluster_pca(customers).collect()
    axes = np.array([(r["pc1"], r["pc2"]) for r in rows])
    assert axes[:, 0].var() >= axes[:, 1].var() > 0 and abs(np.corrcoef(axes.T)[0, 1]) < 1e-6
    data = np.array([[float(r[c]) for c in K.PCA_FEATURES] for r in customers.orderBy("customer_name").collect()])
    deviation = data.std(0, ddof=1)
    z = (data - data.mean(0)) / np.where(deviation == 0, 1, deviation)
    strengths = np.linalg.svd(z, compute_uv=False)[:2] ** 2 / len(z)
    assert axes.var(0) == pytest.approx(strengths, rel=1e-6)
    with pytest.raises(ValueError):
        K.cluster_pca(customers, ["recency"])


def test_topics(spark):
    tokens = X.tokenise_reviews(I.reviews(spark, FOLDER), X.default_stop_words())
    model = Z.fit_topics(tokens, k=4, passes=3)
    words = Z.topic_words(model)
    assert words.count() == 4 * Z.TOP_WORDS
    assert sorted(r["place"] for r in words.where("topic_id = 0").collect()) == list(range(Z.TOP_WORDS))
    labels = words.select("topic_id", "label").distinct()
    assigned = Z.dominant_topic(model, labels)
    assert assigned.count() == tokens.count() and assigned.where("topic_label is null").count() == 0
    assert sum(r["reviews"] for r in Z.topic_counts(assigned, 4).collect()) == tokens.count()
    pivot = Z.topic_sentiment_pivot(assigned, ["positive", "neutral", "negative"]).collect()
    assert sum(r["positive"] + r["neutral"] + r["negative"] for r in pivot) == tokens.where("sentiment is not null").count()
    assert {r["dominant_topic"] for r in Z.topic_mean_rating(assigned).collect()} == {r["dominant_topic"] for r in pivot}
    assert {r["term"] for r in X.build_vocabulary(tokens).collect()} == {r["term"] for r in model.terms.collect()}


def test_topic_labels(spark):
    rows = [(0, "price"), (0, "bad"), (0, "cost"), (0, "app"), (0, "api"), (1, "refund"), (2, "worst"), (3, "nice")]
    labels = {r["topic_id"]: r["label"] for r in Z.topic_labels(spark.createDataFrame(rows, "topic_id int, keyword string")).collect()}
    assert labels == {0: "Competitor Pain [api, app, cost]", 1: "Competitor/Alt [refund]", 2: "Pain Point [worst]", 3: "General Feedback"}


def test_sentiment(spark):
    good, bad = "great product love it works well", "terrible broken awful waste of money"
    rows = [(n, (good if n % 2 else bad) + f" item {n % 7}", "Positive" if n % 2 else "Negative") for n in range(200)]
    frame = X.clean_reviews(spark.createDataFrame(rows, "review_id long, review_text string, sentiment string"))
    fit = S.sentiment_classifier(frame)
    assert fit.classes == ["negative", "positive"] and fit.accuracy == 1.0 and 0 <= fit.loss < 0.2
    assert fit.predictions.count() == 40
    report = {r["class"]: r for r in S.classification_report(fit.predictions, "sentiment", "predicted").collect()}
    assert report["negative"]["support"] == 20 and report["macro avg"]["f1"] == 1.0


def test_report_with_a_class_never_predicted(spark):
    frame = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    report = {r["class"]: r for r in S.classification_report(frame, "t", "p").collect()}
    assert (report["c"]["precision"], report["c"]["recall"], report["c"]["f1"], report["c"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert report["a"]["precision"] == 0.5 and report["b"]["recall"] == 1.0 and report["accuracy"]["f1"] == 0.5
    matrix = {r["actual"]: (r["a"], r["b"], r["c"]) for r in S.confusion_matrix(frame, "t", "p", "abc").collect()}
    assert matrix == {"a": (1, 1, 0), "b": (0, 1, 0), "c": (1, 0, 0)}
