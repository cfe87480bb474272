"""Profit prediction: ridge regression, its metrics, coefficients and audit."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.prepare import chronological_split
from tallyloom.session import stored

# The model's inputs and penalty.
NUMERIC_FEATURES = (
    "sales",
    "quantity",
    "discount",
    "shipping_cost",
    "ship_days",
    "unique_products",
    "unique_sub_categories",
    "Furniture",
    "Office Supplies",
    "Technology",
)
CATEGORICAL_FEATURES = ("ship_mode", "segment", "market", "region", "order_priority")
RIDGE_ALPHA = 10.0


@dataclass(frozen=True)
class RidgeFit:
    """A fitted ridge: intercept and coefficients by feature name, the test and the training rows with their prediction, and
    the penalty."""

    intercept: float
    coefficients: dict[str, float]
    predictions: DataFrame
    fitted: DataFrame
    alpha: float

    def coefficient_table(self) -> DataFrame:
        """Coefficients by size; a few dozen model values."""
        rows = [("intercept", self.intercept, "baseline expected order profit")]
        rows += [
            (name, value, "positive raises predicted profit; negative lowers it")
            for name, value in self.coefficients.items()
        ]
        table = self.predictions.sparkSession.createDataFrame(
            rows, "feature string, coefficient double, interpretation string"
        )
        return table.orderBy(F.abs("coefficient").desc(), "feature")


#: Features up to which MLlib solves the normal equations; beyond, it descends by L-BFGS.
NORMAL_FEATURES = 4_096


def encode_levels(df: DataFrame, columns: Sequence[str], name: str) -> tuple[DataFrame, list[str]]:
    """Add one sparse 0/1 vector for all levels of categorical columns but the alphabetically first of each, and the
    names of its places.  The table gets one column however many levels there are."""
    places = [f"_place{i}" for i in range(len(columns))]
    indexer = StringIndexer(inputCols=list(columns), outputCols=places, stringOrderType="alphabetDesc").fit(df)
    placed = indexer.transform(df)
    hot = OneHotEncoder(inputCols=places, outputCols=[f"{p}_hot" for p in places], dropLast=True).fit(placed)
    joined = VectorAssembler(inputCols=[f"{p}_hot" for p in places], outputCol=name).transform(hot.transform(placed))
    names = [f"{c}_{level}" for c, levels in zip(columns, indexer.labelsArray) for level in levels[:-1]]
    return joined.select(*[f"`{c}`" for c in df.columns], name), names


def ridge(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, alpha: float, encoded: str | None = None,
    encoded_names: Sequence[str] = (),
) -> RidgeFit:
    """Ridge with an unpenalised intercept on features z-scored by the training part.

    The penalty is meant for features scaled by their population deviation, the scaler uses the sample deviation
    (larger by 1/c, c^2 = (n-1)/n), and the solver divides the squared error by n and by the label's deviation.  So
    its parameter is alpha * c^2 * deviation(label) / n, and its coefficients are multiplied by c.  Scaling takes one
    pass over the training rows and the normal equations another.  `encoded` is a vector column of further features.
    """
    names = [*features, *encoded_names]

    def shaped(part: DataFrame) -> DataFrame:
        numbers = [F.col(f"`{name}`").cast("double").alias(f"f{i}") for i, name in enumerate(features)]
        rows = part.select("*", *numbers, F.col(label).cast("double").alias("_y"))
        inputs = [*[f"f{i}" for i in range(len(features))], *([encoded] if encoded else [])]
        return VectorAssembler(inputCols=inputs, outputCol="raw").transform(rows)

    fit_rows = shaped(train)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(fit_rows)
    moments = fit_rows.agg(F.stddev_pop("_y").alias("dev"), F.count("*").alias("n")).first()
    shrink = (moments["n"] - 1) / moments["n"]
    model = LinearRegression(
        labelCol="_y",
        predictionCol="predicted",
        solver="normal" if len(names) <= NORMAL_FEATURES else "l-bfgs",
        elasticNetParam=0.0,
        standardization=False,
        regParam=alpha * shrink * (moments["dev"] or 1.0) / moments["n"],
    ).fit(scaler.transform(fit_rows))
    kept = [F.col(f"`{c}`") for c in test.columns if c != encoded]

    def predicted(part: DataFrame) -> DataFrame:
        return model.transform(scaler.transform(shaped(part))).select(*kept, "predicted")

    return RidgeFit(
        intercept=float(model.intercept),
        coefficients={name: float(w) * math.sqrt(shrink) for name, w in zip(names, model.coefficients)},
        predictions=predicted(test),
        fitted=predicted(train),
        alpha=alpha,
    )


def normal_equations(fit: RidgeFit, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """(feature, cosine): what the fit makes the cosine of each feature and the label in the training rows.

    A ridge is right exactly where each feature's product with the predictions, plus penalty * deviation * coefficient,
    is its product with the label; so the cosines are those of the data.  A level of a categorical column is the feature
    `column_level`, and the intercept is the feature that is always 1.
    """
    values = [(F.lit(name), F.col(f"`{name}`").cast("double")) for name in numeric]
    values += [(F.concat(F.lit(f"{c}_"), F.col(f"`{c}`")), F.lit(1.0)) for c in categorical] + [(F.lit("intercept"), F.lit(1.0))]
    long = F.inline(F.array(*[F.struct(name.alias("feature"), x.alias("x")) for name, x in values]))
    y = F.col(label).cast("double")
    told = fit.fitted.agg(F.count("*").alias("n"), F.sum(y * y).alias("square")).first()
    sums = fit.fitted.select("predicted", long).groupBy("feature")
    sums = sums.agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.sum(F.col("predicted") * F.col("x")).alias("p"))
    weights = [*fit.coefficients.items(), ("intercept", 0.0)]
    weights = fit.fitted.sparkSession.createDataFrame(weights, "feature string, w double")
    mean = F.col("s") / told["n"]
    penalty = fit.alpha * F.col("w") * F.sqrt(F.greatest(F.col("q") / told["n"] - mean * mean, F.lit(0.0)))
    cosine = F.try_divide(F.col("p") + penalty, F.sqrt(F.col("q") * (told["square"] or 0.0)))
    return sums.join(weights, "feature").select("feature", cosine.alias("cosine"))


def profit_regression(
    orders: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    alpha: float = RIDGE_ALPHA,
) -> RidgeFit:
    """Predict order profit, trained on the first 80 % of orders by date and tested on the rest."""
    wanted = ["order_id", "order_date", "profit", "profitable", *numeric, *categorical]
    split = chronological_split(orders.select(*[f"`{c}`" for c in wanted]).na.drop(), "order_date", "order_id")
    rows, names = encode_levels(stored(split, "regression_split"), categorical, "levels")
    rows = stored(rows, "regression_orders")
    return ridge(rows.where("is_train"), rows.where("not is_train"), numeric, "profit", alpha, "levels", names)


def prediction_audit(predictions: DataFrame, n: int | None = 200) -> DataFrame:
    """Test orders with prediction, predicted flag and absolute error; the worst first."""
    error = F.abs(F.col("profit").cast("double") - F.col("predicted"))
    table = predictions.select(
        "order_id",
        "order_date",
        "profit",
        "profitable",
        F.col("predicted").alias("predicted_profit"),
        (F.col("predicted") > 0).cast("int").alias("predicted_profitable"),
        error.alias("absolute_error"),
    )
    return table.orderBy(F.col("absolute_error").desc(), "order_id").limit(n) if n else table


def regression_metrics(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows, RMSE, MAE, R2 and sign accuracy, one row each.  R2 uses the mean of these rows."""
    y, p = F.col(actual).cast("double"), F.col(predicted)
    known = predictions.where(y.isNotNull() & p.isNotNull())
    sums = known.agg(
        F.count("*").alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("variance"),
        F.avg(((y > 0) == (p > 0)).cast("double")).alias("accuracy"),
    )
    metrics = {
        "test_orders": F.col("n").cast("double"),
        "rmse_profit": F.sqrt("mse"),
        "mae_profit": F.col("mae"),
        "r2": 1 - F.try_divide(F.col("mse"), F.col("variance")),
        "profitability_accuracy": F.col("accuracy"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in metrics.items()])
    return sums.select(F.inline(rows))
