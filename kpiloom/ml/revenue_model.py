"""Revenue regression: assemble → standardise → elastic-net linear regression, tuned by k-fold CV.

Scale notes. With three features ``LinearRegression`` (solver ``auto``)
uses the weighted-least-squares path: each fit is one distributed pass that
aggregates a 3×3 Gram matrix (a ``treeAggregate``), after which the
elastic-net problem is solved on that tiny matrix. Split and folds are taken
from a hash of the row's values, so they do not depend on files, partitions
or cores, another engine can compute them alike, and a lost executor changes
nothing; equal rows fall on one side. ``randomSplit`` remains as an option. The
labelled rows are written once to the shared folder. A fit and its RMSE depend on
count, means and covariances of the rows alone, so one pass over all training rows
takes these for every fold, and the grid search runs over a few weighted rows a fold
that have the same ones. The best combination is fitted on all training rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.schemas import (
    ML_ELASTIC_NET_PARAMS,
    ML_FEATURES,
    ML_FOLDS,
    ML_LABEL,
    ML_PREDICTION,
    ML_REG_PARAMS,
    ML_SEED,
    ML_SPLIT,
)
from kpiloom.session import materialize


def training_set(curated: DataFrame, features: list[str] = ML_FEATURES, label: str = ML_LABEL) -> DataFrame:
    """Features and label only; positive label; no NULL or NaN anywhere."""
    return (curated.select(*features, label)
                   .filter(F.col(label) > 0)
                   .na.drop(how="any"))


BUCKETS = 1000  # that the hash of a row falls into; the last digits cut the split, the rest the folds
SPLIT, FOLD = "split_bucket", "fold"


def keyed(data: DataFrame, features: list[str] = ML_FEATURES, label: str = ML_LABEL) -> DataFrame:
    """Adds the split bucket and the fold of every row: digits of the MD5 of its values in thousandths."""
    def thousandths(c: str) -> Column:
        whole = F.round(F.col(c).cast("double") * 1000)
        # A decimal only where 64 bits are too few: most numbers need none.
        return F.coalesce(whole.try_cast("bigint").cast("string"), whole.try_cast("decimal(38,0)").cast("string"))

    text = F.concat_ws("|", *[thousandths(c) for c in [*features, label]])
    digits = F.md5(text)
    number = lambda begin: F.conv(F.substring(digits, begin, 8), 16, 10).cast("bigint")
    return data.withColumns({SPLIT: (number(1) % BUCKETS).cast("int"), FOLD: (number(9) % ML_FOLDS).cast("int")})


def split(data: DataFrame, at_random: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, by the share in ML_SPLIT."""
    if at_random:
        return tuple(data.randomSplit(ML_SPLIT, seed=ML_SEED))
    cut = round(BUCKETS * ML_SPLIT[0])
    return data.where(F.col(SPLIT) < cut), data.where(F.col(SPLIT) >= cut)


def sided(data: DataFrame) -> DataFrame:
    """Both sides of the split in one pass: a column ``side`` instead of the bucket."""
    return data.withColumn("side", F.when(F.col(SPLIT) < round(BUCKETS * ML_SPLIT[0]), "train").otherwise("test")).drop(SPLIT)


def evaluator(metric: str = "rmse", label: str = ML_LABEL, **params: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=ML_PREDICTION, metricName=metric, **params)


def regression(features: list[str] = ML_FEATURES, label: str = ML_LABEL, **params: float | str) -> tuple[Pipeline, LinearRegression]:
    """Features side by side, standardised, into an elastic-net regression; the last stage on its own, too."""
    last = LinearRegression(featuresCol="scaled", labelCol=label, predictionCol=ML_PREDICTION, **params)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="assembled"),
                            StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True), last]), last


WEIGHT = "weight"


def condensed(data: DataFrame, features: list[str] = ML_FEATURES, label: str = ML_LABEL) -> DataFrame:
    """A few weighted rows a fold with the count, means and covariances that all rows of the fold have.

    From one aggregation of all rows. Around the mean, two rows lie on each principal axis of the fold's
    correlations, as far out as its variance asks; a column that is constant stays so.
    """
    columns = [*features, label]
    values = [F.col(c).cast("double") for c in columns]
    pairs = [(i, k) for i in range(len(columns)) for k in range(i + 1)]
    found = data.groupBy(FOLD).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
                                   *[F.covar_pop(values[i], values[k]).alias(f"c{i}_{k}") for i, k in pairs]).collect()
    rows = []
    for r in found:
        mean = np.array([r[f"m{i}"] for i in range(len(columns))])
        spread = np.zeros((len(columns),) * 2)
        for i, k in pairs:
            spread[i, k] = spread[k, i] = r[f"c{i}_{k}"]
        varied = np.flatnonzero(np.diag(spread) > 0)
        scale = np.sqrt(np.diag(spread)[varied])
        size, axes = np.linalg.eigh(spread[np.ix_(varied, varied)] / np.outer(scale, scale))
        out = np.zeros((max(len(varied), 1), len(columns)))  # without any spread, the mean alone
        out[:len(varied), varied] = (axes * np.sqrt(np.maximum(size, 0) * len(varied))).T * scale
        rows += [(*point, r[FOLD], r.n / (2 * len(out))) for side in (1, -1) for point in (mean + side * out).tolist()]
    schema = ", ".join([*[f"`{c}` double" for c in columns], f"{FOLD} int", f"{WEIGHT} double"])
    return data.sparkSession.createDataFrame(rows, schema).coalesce(1)


def searched(label: str = ML_LABEL, parallelism: int = 4, **weighted: str) -> CrossValidator:
    """The grid search: every combination on every fold, the folds being a column of the rows."""
    whole, last = regression(label=label, **weighted)
    grid = ParamGridBuilder()
    for param, values in ((last.regParam, ML_REG_PARAMS), (last.elasticNetParam, ML_ELASTIC_NET_PARAMS)):
        grid = grid.addGrid(param, values)
    return CrossValidator(estimator=whole, estimatorParamMaps=grid.build(), evaluator=evaluator(label=label, **weighted), numFolds=ML_FOLDS, foldCol=FOLD, parallelism=parallelism)


@dataclass
class TrainedModel:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    avg_rmse: list[float]


def train(data: DataFrame, checkpoint: bool = True, parallelism: int = 4, persist: bool = True, random_split: bool = False) -> TrainedModel:
    """Split 80/20, cross-validate the grid on the 80%, refit the best.

    The search passes over the training rows once, the refit twice. With ``persist``
    they are cached (memory, spilling to disk) for these passes; without it each
    re-reads the written table.
    """
    data = keyed(data)
    if checkpoint:
        data = materialize(data, "ml-training-set")
    train_df, test_df = split(data, random_split)
    if persist:
        train_df = train_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = searched(parallelism=parallelism, weightCol=WEIGHT).fit(condensed(train_df))
        best = found.bestModel.stages[-1]
        whole, _ = regression(regParam=best.getRegParam(), elasticNetParam=best.getElasticNetParam())
        model = whole.fit(train_df)
    finally:
        if persist:
            train_df.unpersist()
    return TrainedModel(model, train_df, test_df, list(found.avgMetrics))


def predictions(model: PipelineModel, df: DataFrame, label: str = ML_LABEL) -> DataFrame:
    return model.transform(df).select(label, ML_PREDICTION)


def metrics(scored: DataFrame, label: str = ML_LABEL) -> DataFrame:
    """RMSE and R² of scored rows, as a one-row table from one distributed aggregation.

    R² = 1 − SS_res / SS_tot with SS_tot = n·var_pop(label), the definition
    ``RegressionEvaluator`` uses (no weights).
    """
    err = F.col(label) - F.col(ML_PREDICTION)
    n = F.count(F.lit(1))
    ss_res = F.sum(err * err)
    ss_tot = F.var_pop(F.col(label)) * n
    return scored.agg(F.sqrt(ss_res / n).alias("rmse"), (F.lit(1.0) - ss_res / ss_tot).alias("r2"))


def coefficients(spark: SparkSession, model: PipelineModel, features: list[str] = ML_FEATURES) -> DataFrame:
    """One row per feature (on the standardised scale) plus the intercept."""
    lr_model = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, lr_model.coefficients.toArray())]
    rows.append(("intercept", float(lr_model.intercept)))
    best = (float(lr_model.getRegParam()), float(lr_model.getElasticNetParam()))
    return spark.createDataFrame([(n, v, *best) for n, v in rows],
                                 "term string, value double, reg_param double, elastic_net_param double")


def grid_scores(spark: SparkSession, avg_rmse: list[float]) -> DataFrame:
    """One row per combination of the grid, in the order of the search."""
    combinations = [(r, e) for r in ML_REG_PARAMS for e in ML_ELASTIC_NET_PARAMS]
    return spark.createDataFrame([(r, e, float(s)) for (r, e), s in zip(combinations, avg_rmse, strict=True)], "reg_param double, elastic_net_param double, avg_rmse double")


def digits(c: str | Column, n: int = 6) -> Column:
    """A number cut to so many significant digits: the solvers of two engines differ in the last ones of a double."""
    return F.format_string(f"%.{n - 1}e", F.col(c) if isinstance(c, str) else c).cast("double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
