"""Revenue model: training set rules, closed-form check, save/load."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from kpiloom.ml import revenue_model
from kpiloom.operators.clean import clean_market
from kpiloom.sources import testdata

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def data(spark):
    rows = revenue_model.training_set(clean_market(testdata.market_raw(spark, SF_SMALL))).cache()
    yield rows
    rows.unpersist()  # the plans of other modules' tests would read it


def test_training_set_rules(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 0.0, 5.0), (None, 1.0, 0.0, 5.0), (1, float("nan"), 0.0, 5.0), (1, 1.0, 0.0, -1.0),
         (1, 1.0, 0.0, 0.0)],
        "concurrent_players int, hype_score double, discount_pc double, estimated_revenue_usd double")
    assert revenue_model.training_set(df).count() == 1


def test_unregularised_single_feature_matches_closed_form(spark, data, tmp_dir):
    path = os.path.join(tmp_dir, "train.parquet")
    data.write.parquet(path)
    slope, intercept = duckdb.sql(
        f"SELECT regr_slope(estimated_revenue_usd, concurrent_players), "
        f"regr_intercept(estimated_revenue_usd, concurrent_players) FROM read_parquet('{path}/*.parquet')"
    ).fetchall()[0]
    model = Pipeline(stages=[
        VectorAssembler(inputCols=["concurrent_players"], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol="estimated_revenue_usd", regParam=0.0),
    ]).fit(data)
    lr = model.stages[-1]
    assert lr.coefficients[0] == pytest.approx(slope, rel=1e-6)
    assert lr.intercept == pytest.approx(intercept, rel=1e-6, abs=1e-3)


def test_cross_validated_fit_save_load(spark, data, tmp_dir):
    trained = revenue_model.train(data, checkpoint=True, parallelism=2)
    assert len(trained.avg_rmse) == 4
    assert trained.train.count() + trained.test.count() == data.count()
    scored = revenue_model.predictions(trained.model, trained.test)
    assert scored.columns == ["estimated_revenue_usd", "predicted_revenue"]
    scored_full = trained.model.transform(trained.test)
    m = revenue_model.metrics(scored_full).first()
    assert m.rmse == pytest.approx(revenue_model.evaluator("rmse").evaluate(scored_full), rel=1e-9)
    assert m.r2 == pytest.approx(revenue_model.evaluator("r2").evaluate(scored_full), rel=1e-9, abs=1e-12)
    coefs = revenue_model.coefficients(spark, trained.model).collect()
    assert [r.term for r in coefs] == ["concurrent_players", "hype_score", "discount_pc", "intercept"]
    path = os.path.join(tmp_dir, "model")
    revenue_model.save_model(trained.model, path)
    again = revenue_model.predictions(revenue_model.load_model(path), trained.test)
    a = sorted(r.predicted_revenue for r in scored.collect())
    b = sorted(r.predicted_revenue for r in again.collect())
    assert a == pytest.approx(b)


def test_split_and_folds_do_not_depend_on_partitions(spark, data):
    def sides(df):
        train, test = revenue_model.split(revenue_model.keyed(df))
        return sorted(map(tuple, train.collect())), sorted(map(tuple, test.collect()))

    one, other = sides(data.repartition(2)), sides(data.repartition(7, "hype_score"))
    assert one == other and 0.7 < len(one[0]) / data.count() < 0.9
    assert {r[-1] for r in one[0]} == {0, 1, 2}


def test_a_changed_table_is_trained_on_anew(spark, tmp_path):
    import shutil

    from kpiloom.plans.catalog import catalog

    for name in ("lineitem", "part"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = catalog()["ml_metrics"](spark, str(tmp_path)).first().rmse
    assert catalog()["ml_metrics"](spark, str(tmp_path)).first().rmse == first
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0").toPandas().to_parquet(tmp_path / "lineitem.parquet")
    assert catalog()["ml_metrics"](spark, str(tmp_path)).first().rmse != first
    assert catalog()["ml_training"](spark, str(tmp_path)).count() == 4


@pytest.mark.parametrize(("reg", "mix"), [(0.01, 0.5), (1e5, 0.0), (1e5, 1.0), (1e6, 0.5), (3e6, 1.0), (1e9, 1.0)])
def test_elastic_net_by_sign_patterns(spark, data, reg, mix):
    """The oracle's solution, held against Spark's solver also where the penalty sets coefficients to zero."""
    import oracle_queries as oracle
    from oracle_check import duck_conn

    sql = oracle.with_market(f"{oracle.elastic_net(f'({reg}, {mix})')}\nSELECT b1 * dy * s1 / d1, b2 * dy * s2 / d2, b3 * dy * s3 / d3, my FROM best")
    (*want, intercept), = duck_conn(SF_SMALL).execute(sql).fetchall()
    train, _ = revenue_model.split(revenue_model.keyed(data))
    pipeline, _ = revenue_model.regression(regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=1000)
    fitted = pipeline.fit(train).stages[-1]
    assert list(fitted.coefficients) == pytest.approx(want, rel=1e-5, abs=1e-3) and fitted.intercept == pytest.approx(intercept, rel=1e-9)
    assert (reg < 3e6) or 0.0 in want


def test_search_and_choice_against_the_oracle(spark, data):
    """The folds, the mean scores and the chosen combination."""
    import oracle_queries as oracle
    from oracle_check import duck_conn

    trained = revenue_model.train(data)
    con = duck_conn(SF_SMALL)
    scores = con.execute(oracle.with_market(f"{oracle.elastic_net()}\nSELECT avg_rmse FROM searched ORDER BY reg_param, elastic_net_param")).fetchall()
    assert trained.avg_rmse == pytest.approx([s for s, in scores], rel=1e-9)
    chosen = con.execute(oracle.with_market(f"{oracle.elastic_net()}\nSELECT reg_param, elastic_net_param FROM best")).fetchall()
    last = trained.model.stages[-1]
    assert chosen == [(last.getRegParam(), last.getElasticNetParam())]


def test_the_search_passes_over_a_few_rows_that_stand_for_all(spark, data, monkeypatch):
    from pyspark.ml.tuning import CrossValidator

    seen, fit = [], CrossValidator.fit
    monkeypatch.setattr(CrossValidator, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    trained = revenue_model.train(data)
    assert seen == [3 * 2 * 4]  # folds, sides, columns
    whole = revenue_model.searched().fit(revenue_model.split(revenue_model.keyed(data))[0])
    assert trained.avg_rmse == pytest.approx(whole.avgMetrics, rel=1e-13)
    (a, b) = (x.stages[-1] for x in (trained.model, whole.bestModel))
    assert (a.getRegParam(), a.getElasticNetParam()) == (b.getRegParam(), b.getElasticNetParam())
    assert list(a.coefficients) == pytest.approx(list(b.coefficients), rel=1e-9) and a.intercept == pytest.approx(b.intercept, rel=1e-12)


def test_search_on_constant_and_dependent_columns_and_small_folds(spark):
    rows = [(i * i % 17, 3.0, 2.0 * (i * i % 17), 10.0 * i + 7 * (i % 3), i % 2 if i else 2) for i in range(40)]  # fold 2 has one row
    df = spark.createDataFrame(rows, "concurrent_players int, hype_score double, discount_pc double, estimated_revenue_usd double, fold int")
    few = revenue_model.condensed(df)
    assert {r.hype_score for r in few.collect()} == {3.0} and few.where("fold = 2").agg({"weight": "sum"}).first()[0] == 1
    got = revenue_model.searched(weightCol=revenue_model.WEIGHT).fit(few).avgMetrics
    assert list(got) == pytest.approx(list(revenue_model.searched().fit(df).avgMetrics), rel=1e-9)
    with pytest.raises(ValueError, match="empty"):
        revenue_model.train(spark.createDataFrame([], "concurrent_players int, hype_score double, discount_pc double, estimated_revenue_usd double"))
