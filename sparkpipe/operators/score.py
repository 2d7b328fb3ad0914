"""Rule labels, features, and logistic-regression scoring."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from sparkpipe.functions.scalars import hash_fraction
from sparkpipe.session import work_dir

# Label threshold, training rows, and model settings.
THRESHOLD = 500.0
TRAINING_ROWS = 10
SETTINGS = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}

OUTPUT = ("transaction_id", "amount", "category", "fraud_prediction", "fraud_probability")


def label(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return df.withColumn("label", F.coalesce((F.col("amount") > threshold).cast("int"), F.lit(0)))


def features(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add the label and ``feature_1``, a fraction that a rerun reproduces."""
    return label(df, threshold).withColumn("feature_1", hash_fraction(F.col("transaction_id")))


def training_subset(df: DataFrame, key: str, n: int = TRAINING_ROWS) -> DataFrame:
    """The n rows first in the order of the key's md5: arbitrary but replayable."""
    rest = [c for c in df.columns if c != key]
    return df.orderBy(F.md5(F.col(key).cast("string")), key, *rest).limit(n)


def stratified_subset(df: DataFrame, key: str, by: str, n: int = TRAINING_ROWS) -> DataFrame:
    """Of each value of ``by``, NULL included, the n rows that :func:`training_subset` takes.

    Each task passes on n rows per value at most, however many it has read.
    """
    rest = [c for c in df.columns if c != key]
    order = Window.partitionBy(by).orderBy(F.md5(F.col(key).cast("string")), key, *rest)
    return df.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n).drop("_place")


def fit(
    featured: DataFrame, n: int | None = TRAINING_ROWS, settings: dict | None = None
) -> PipelineModel | None:
    """Fit on n rows, or with ``n=None`` on all, as a distributed iterative job.

    None when there is nothing to tell apart: no rows, or labels all alike. The
    n rows are kept in memory, as each look at them would scan the table again.
    """
    rows = featured.select("transaction_id", "amount", "feature_1", "label")
    kept = rows if n is None else training_subset(rows, "transaction_id", n).persist()
    try:
        present = kept.filter(F.col("amount").isNotNull())
        low, high = present.agg(F.min("label"), F.max("label")).first()
        if low is None or low == high:
            return None
        assembler = VectorAssembler(inputCols=["amount", "feature_1"], outputCol="features")
        model = LogisticRegression(
            featuresCol="features", labelCol="label", **(SETTINGS if settings is None else settings)
        )
        return Pipeline(stages=[assembler, model]).fit(present)
    finally:
        if n is not None:
            kept.unpersist()


def fit_newton(
    featured: DataFrame,
    inputs: Sequence[str],
    rounds: int = 8,
    penalty: float = 0.1,
    label: str = "label",
) -> tuple[float, dict[str, float]] | None:
    """(intercept, weights) of a logistic regression, by Newton steps from zero.

    The objective is the mean log loss and half of ``penalty`` times the square of all
    coefficients, the intercept's too, so labels that the inputs tell apart without
    error do not send the weights to infinity. The columns needed are written once to the
    work folder, so that ``featured`` is not made again for every round. A round is one
    aggregate over all rows, whose sums (of a fixed number) reach the driver; rounds are
    fixed, so that the same rows give the same weights but for the order of sums. Rows that
    lack an input or the label are left out; None without rows or when all labels are alike.
    """
    names = list(inputs)
    columns = [F.col(c).cast("double") for c in names]
    rows = featured.select(*columns, F.col(label).cast("double").alias("_y")).dropna()
    spark, folder = featured.sparkSession, work_dir(featured.sparkSession, "fit")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    n, low, high = rows.agg(F.count("*"), F.min("_y"), F.max("_y")).first()
    if not n or low == high:
        return None
    terms = [F.lit(1.0), *[F.col(c) for c in names]]
    size = len(terms)
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    weights = np.zeros(size)
    for _ in range(rounds):
        total = F.lit(float(weights[0]))
        for name, weight in zip(names, weights[1:]):
            total = total + F.col(name) * float(weight)
        told = rows.withColumn("_p", 1 / (1 + F.exp(-total)))
        spread = F.col("_p") * (1 - F.col("_p"))
        sums = told.agg(
            *[F.sum((F.col("_p") - F.col("_y")) * t).alias(f"g{i}") for i, t in enumerate(terms)],
            *[F.sum(spread * terms[i] * terms[j]).alias(f"h{i}_{j}") for i, j in upper],
        ).first()
        gradient = np.array(sums[:size]) / n + penalty * weights
        curvature = np.zeros((size, size))
        for (i, j), value in zip(upper, sums[size:]):
            curvature[i, j] = curvature[j, i] = value / n
        weights = weights - np.linalg.solve(curvature + penalty * np.eye(size), gradient)
    return float(weights[0]), dict(zip(names, map(float, weights[1:])))


def score_linear(featured: DataFrame, intercept: float, weights: dict[str, float]) -> DataFrame:
    """Score with given coefficients: plain column arithmetic, a logistic of the sum.

    A row that lacks one of the weighted columns gets 0.0 and NULL.
    """
    total = F.lit(intercept)
    for name, weight in weights.items():
        total = total + F.col(name) * weight
    probability = 1 / (1 + F.exp(-total))
    positive = F.coalesce((probability > 0.5).cast("double"), F.lit(0.0))
    return featured.withColumns(
        {"fraud_prediction": positive, "fraud_probability": probability}
    ).select(*OUTPUT)


def score(featured: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Prediction and probability of the positive class for every row.

    Without a model, and for a row without an amount: 0.0 and NULL.
    """
    none = F.lit(None).cast("double")
    if model is None:
        scored = featured.withColumns(
            {"fraud_prediction": F.lit(0.0), "fraud_probability": none}
        )
        return scored.select(*OUTPUT)
    # A fitted model drags its training session into every task, which fails once that
    # session has observed a frame; its coefficients say all there is to say.
    assembler, logistic = model.stages[0], model.stages[-1]
    weights = zip(assembler.getInputCols(), logistic.coefficients.toArray().tolist())
    return score_linear(featured, float(logistic.intercept), dict(weights))
