"""Sentiment classification and its report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.prepare import stratified_split
from tallyloom.session import spread, stored

#: Tasks of a pass of the fit.  Each pass adds up their gradients, which are as long as classes times features, by a tree,
#: and the driver takes the last few: their number grows with the tasks, so more rows make longer tasks, not more.
FIT_TASKS = 8


@dataclass(frozen=True)
class SentimentFit:
    """Scored test rows and class names in order; accuracy and log loss are worked out when asked for."""

    scored: DataFrame
    classes: list[str]

    @property
    def predictions(self) -> DataFrame:
        return self.scored.drop("label", "prediction", "probability")

    @property
    def accuracy(self) -> float:
        return self._evaluate("accuracy")

    @property
    def loss(self) -> float:
        return self._evaluate("logLoss")

    def _evaluate(self, metric: str) -> float:
        return float(MulticlassClassificationEvaluator(metricName=metric).evaluate(self.scored))

    def metrics(self) -> DataFrame:
        """Test rows, accuracy and log loss as one row, from one pass over the scored rows."""
        own = F.element_at(vector_to_array("probability"), (F.col("label") + 1).cast("int"))
        return self.scored.agg(
            F.count("*").alias("test_rows"),
            F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
            F.avg(-F.log(F.greatest(own, F.lit(1e-15)))).alias("loss"),
        )


def sentiment_classifier(
    cleaned: DataFrame, key: str = "review_id", features: int = 1 << 18, test_share: float = 0.2, max_iter: int = 30
) -> SentimentFit:
    """Multinomial (or binary) logistic regression on weighted words, tested on a stratified part.

    Words are hashed to `features` places; words that share one add up, which the weights take as noise.
    """
    rows = cleaned.select(key, F.lower("sentiment").alias("sentiment"), F.split("clean_review", " ").alias("words"))
    rows = stored(spread(rows), "review_words")
    split = stored(stratified_split(rows, "sentiment", key, test_share), "review_split")
    indexer = StringIndexer(inputCol="sentiment", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    stages = [
        indexer,
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(maxIter=max_iter, regParam=0.01, family="auto"),
        IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels),
    ]
    model = Pipeline(stages=stages).fit(split.where("not is_test").coalesce(FIT_TASKS))
    scored = model.transform(split.where("is_test")).select(key, "sentiment", "predicted", "label", "prediction", "probability")
    return SentimentFit(stored(scored, "review_scores"), list(indexer.labels))


def confusion_matrix(predictions: DataFrame, actual: str, predicted: str, classes: Sequence[str]) -> DataFrame:
    """Actual classes as rows, predicted classes as columns."""
    counts = [F.count_if(F.col(predicted) == c).alias(c) for c in classes]
    return predictions.groupBy(F.col(actual).alias("actual")).agg(*counts)


def classification_report(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, plain and weighted means.

    Everything comes from the class by class counts, one pass over the predictions.
    """
    cells = predictions.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    either = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("class"), F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
                         F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("hit"),
                         F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed")),
            )
        )
    )
    sums = either.groupBy("class").agg(*[F.sum(c).cast("double").alias(c) for c in ("hit", "support", "claimed")])
    zero = lambda column: F.coalesce(column, F.lit(0.0))
    per_class = sums.select(
        "class",
        zero(F.try_divide("hit", "claimed")).alias("precision"),
        zero(F.try_divide("hit", "support")).alias("recall"),
        zero(F.try_divide(2 * F.col("hit"), F.col("claimed") + F.col("support"))).alias("f1"),
        "support",
        "hit",
    )
    measures = ("precision", "recall", "f1")
    share = F.try_divide(F.sum("hit"), F.sum("support"))
    weighted = [F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")) for m in measures]
    summary = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[share.alias(m) for m in measures], F.sum("support").alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support")),
            F.struct(F.lit("weighted avg").alias("class"), *[w.alias(m) for w, m in zip(weighted, measures)],
                     F.sum("support").alias("support")),
        ).alias("_s")
    ).select(F.inline("_s"))
    return per_class.drop("hit").unionByName(summary).withColumn("support", F.col("support").cast("long"))
