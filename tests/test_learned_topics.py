"""The topic model against a plain version of its steps, and the order-aware sentiment model."""

from __future__ import annotations

import numpy as np
import pytest

from tallyloom.functions.gammas import digamma, log_gamma, trigamma
from tallyloom.functions.numbering import dense_ranks, numbered
from tallyloom.operators import sentiment as S
from tallyloom.operators import sequence_model as E
from tallyloom.operators import text as X
from tallyloom.operators import topic_model as T


def test_gammas():
    import math

    x = np.array([1e-3, 0.1, 0.5, 1, 2.5, 9.9, 10, 50, 1e6])
    assert log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)
    step = 1e-5
    for v in (0.3, 1.0, 4.0, 20.0):
        slope = (math.lgamma(v + step) - math.lgamma(v - step)) / (2 * step)
        assert digamma(np.array([v]))[0] == pytest.approx(slope, rel=1e-6)
        slope = (digamma(np.array([v + step])) - digamma(np.array([v - step])))[0] / (2 * step)
        assert trigamma(np.array([v]))[0] == pytest.approx(slope, rel=1e-5)


def test_numbers_follow_the_order(spark):
    frame = spark.range(20_000).selectExpr("(id * 7919) % 5003 AS k", "cast(id % 3 AS string) AS s")
    found = {(r["k"], r["s"]): r["n"] for r in dense_ranks(frame, ["s", "k"], "n", parts=7).collect()}
    expected = {key: i for i, key in enumerate(sorted(found, key=lambda x: (x[1], x[0])))}
    assert found == expected and len(found) > 10_000
    plan = numbered(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert numbered(frame.limit(0), ["k"], "n").columns == ["k", "s", "n"]
    nulls = spark.createDataFrame([(None,), (2,), (1,)], "k int")
    assert [(r["k"], r["n"]) for r in numbered(nulls, ["k"], "n", first=1).orderBy("n").collect()] == [(None, 1), (1, 2), (2, 3)]


def plain_topics(counts: np.ndarray, weights: np.ndarray, k: int, passes: int):
    """Word sums, prior of topics, prior of words and bounds by the textbook's steps, document by document."""
    documents, words = counts.shape
    alpha, eta = np.full(k, 1 / k), np.full(words, 1 / k)
    gamma = alpha + np.repeat(counts.sum(1)[:, None] / k, k, axis=1)
    bounds = []
    for turn in range(passes):
        logs = digamma(weights) - digamma(weights.sum(0))
        beta = np.exp(logs)  # words x topics
        sums, bound = np.zeros((words, k)), 0.0
        for _ in range(T.STEPS):
            before = gamma.copy()
            for d in range(documents):
                theta = np.exp(digamma(gamma[d]) - digamma(gamma[d].sum()))
                gamma[d] = alpha + theta * ((counts[d] / (beta @ theta)) @ beta)
            if np.abs(gamma - before).mean() < T.SETTLED:
                break
        expected = np.zeros(k)
        for d in range(documents):
            own = digamma(gamma[d]) - digamma(gamma[d].sum())
            expected += own
            theta = np.exp(own)
            norm = beta @ theta
            sums += beta * theta * (counts[d] / norm)[:, None]
            bound += (counts[d] * np.log(norm)).sum() + ((alpha - gamma[d]) * own + log_gamma(gamma[d]) - log_gamma(alpha)).sum()
            bound += (log_gamma(np.array([alpha.sum()])) - log_gamma(np.array([gamma[d].sum()])))[0]
        if turn:
            ends = log_gamma(weights).sum() - log_gamma(weights.sum(0)).sum()
            prior = k * (log_gamma(np.array([eta.sum()]))[0] - log_gamma(eta).sum())
            bounds.append(bound + ((eta[:, None] - weights) * logs).sum() + ends + prior)
        alpha = T.dirichlet_prior(alpha, expected, documents)
        weights = eta[:, None] + sums
        logs = (digamma(weights) - digamma(weights.sum(0))).sum(1)
        fit = lambda x: k * (log_gamma(np.array([x.sum()]))[0] - log_gamma(x).sum()) + x @ logs
        slope = k * (digamma(np.array([eta.sum()]))[0] - digamma(eta)) + logs
        own, shared = -k * trigamma(eta), k * trigamma(np.array([eta.sum()]))[0]
        step = (slope - (slope / own).sum() / (1 / shared + (1 / own).sum())) / own
        tried = [eta - 0.5**i * step for i in range(8)]
        tried = [x for x in tried if (x > 1e-9).all()]
        best = max(tried, key=fit, default=eta)
        eta = best if fit(best) > fit(eta) else eta
    return weights, alpha, eta, bounds


def test_topics_match_plain_steps(spark):
    random = np.random.default_rng(1)
    groups = [[f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)], [f"c{i}" for i in range(12)]]
    texts = []
    for d in range(90):
        own = groups[d % 3] if d % 10 else groups[0] + groups[1]
        texts.append([own[int(x)] for x in random.integers(0, len(own), int(random.integers(5, 40)))])
    texts += [[], ["unknown"], ["c1"] * 200]
    frame = spark.createDataFrame(list(enumerate(texts)), "review_id long, tokens array<string>").repartition(3)
    model = T.fit(frame, 3, passes=6, min_documents=2, max_share=0.9, block_terms=120)
    terms = {r["term_id"]: r["term"] for r in model.terms.collect()}
    assert sorted(terms) == list(range(len(terms))) and "unknown" not in terms.values()
    place = {t: i for i, t in terms.items()}
    counts = np.zeros((len(texts), len(terms)))
    for d, words in enumerate(texts):
        for w in words:
            if w in place:
                counts[d, place[w]] += 1
    first = {r["term_id"]: r["weights"] for r in T.first_topics(model.terms, 3, 42).collect()}
    weights, alpha, eta, bounds = plain_topics(counts, np.array([first[i] for i in range(len(terms))]), 3, 6)
    found = {r["term_id"]: r for r in model.topics.collect()}
    assert np.array([found[i]["weights"] for i in range(len(terms))]) == pytest.approx(weights, rel=0.02, abs=0.02)
    assert np.array([found[i]["eta"] for i in range(len(terms))]) == pytest.approx(eta, rel=0.05, abs=1e-3)
    assert model.alpha == pytest.approx(alpha, rel=0.02)
    assert model.bounds == pytest.approx(bounds, rel=1e-4)
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(model.bounds, model.bounds[1:]))
    assert abs(eta - 1 / 3).max() > 1e-3
    # A document's weights are the prior and its words; rows without known words have the prior.
    topics = {r["review_id"]: r["topics"] for r in T.document_topics(model).collect()}
    held = {r["review_id"]: sum(r["gamma"]) for r in model.documents.collect()}
    assert len(topics) == len(texts)
    assert [held[d] - model.alpha.sum() for d in range(len(texts))] == pytest.approx(list(counts.sum(1)), abs=1e-6)
    assert topics[90] == pytest.approx(list(model.alpha / model.alpha.sum()))
    assert model.documents.select("_block").distinct().count() > 3


def test_no_known_word_is_an_error(spark):
    with pytest.raises(ValueError):
        T.fit(spark.createDataFrame([(1, ["a"])], "review_id long, tokens array<string>"), 2)


# --- sentiment by order --------------------------------------------------------------------------------------------


def ordered_reviews(spark, n=1200):
    """Reviews of the same words, whose order alone tells the class."""
    random = np.random.default_rng(3)
    rows = []
    for i in range(n):
        words = [f"item{int(x)}" for x in random.integers(0, 40, 8)]
        first, second = ("good", "not") if i % 2 else ("not", "good")
        at = int(random.integers(0, 8))
        rows.append((i, " ".join([*words[:at], first, second, *words[at:]]), "Positive" if i % 2 else "Negative"))
    return X.clean_reviews(spark.createDataFrame(rows, "review_id long, review_text string, sentiment string"))


def test_order_is_learned_where_words_alone_tell_nothing(spark):
    reviews = ordered_reviews(spark)
    fit = E.sentiment_by_order(reviews, setting=E.Training(batch_rows=256, epochs=25))
    told = fit.metrics().first()
    assert told["test_rows"] == 240 and told["accuracy"] >= 0.97 and told["loss"] < 0.2
    report = {r["class"]: r for r in S.classification_report(fit.scored, "sentiment", "predicted").collect()}
    assert report["negative"]["support"] == 120 and report["macro avg"]["f1"] >= 0.97
    assert S.sentiment_classifier(reviews).accuracy < 0.7


def test_trainers_change_nothing(spark):
    encoded = X.sequence_encode(ordered_reviews(spark, 300), "review_id", 200, 12)
    marked = encoded.withColumn("sentiment", (encoded["review_id"] % 2).cast("string"))
    short = dict(batch_rows=64, epochs=4, size=4, filters=6)
    models = [E.fit(marked, "review_id", "sentiment", 200, E.Training(trainers=n, **short)) for n in (1, 4)]
    assert models[0].losses == pytest.approx(models[1].losses, rel=1e-6)
    for name, values in models[0].weights.items():
        assert values == pytest.approx(models[1].weights[name], abs=1e-6)
    assert (models[0].weights["embedding"][0] == 0).all()


def test_gradients_are_those_of_the_loss():
    random = np.random.default_rng(0)
    setting = E.Training(size=3, filters=4)
    w = E.start(9, 3, setting)
    ids = random.integers(0, 9, (5, 6))
    ids[0] = 0
    ids[1, 2:] = 0
    labels = np.array([0, 1, 2, 1, 0])
    slopes, loss = E.gradients(w, ids, labels)
    assert loss == pytest.approx(E._loss(w, ids, labels))
    for name, values in w.items():
        for at in list(np.ndindex(values.shape))[:: max(1, values.size // 25)]:
            if name == "embedding" and at[0] == 0:
                continue
            kept, ends = values[at], []
            for move in (1e-5, -1e-5):
                values[at] = kept + move
                ends.append(E._loss(w, ids, labels))
            values[at] = kept
            assert slopes[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-5)


def test_fit_ends_when_validation_no_longer_falls(spark):
    random = np.random.default_rng(1)
    rows = [(i, [int(x) for x in random.integers(2, 50, 6)], "ab"[int(random.integers(0, 2))]) for i in range(400)]
    frame = spark.createDataFrame(rows, "review_id long, sequence array<int>, sentiment string")
    model = E.fit(frame, "review_id", "sentiment", 50, E.Training(batch_rows=64, epochs=60, patience=3, rate=0.05))
    assert len(model.losses) < 60 and model.losses.index(min(model.losses)) >= len(model.losses) - 4
    with pytest.raises(ValueError):
        E.fit(frame.where("false"), "review_id", "sentiment", 50)
