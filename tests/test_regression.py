from __future__ import annotations

import numpy as np
import pytest
from conftest import plan_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from fareloom.plans import regression as R

SMALL = R.FeatureSet(("x", "y"), ("code",))
PLAIN = R.FeatureSet(("x", "y"))


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """A written table, so every fit sees the same partitions."""
    path = str(tmp_path_factory.mktemp("data") / "rows")
    x, y = F.col("id") % 17, F.col("id") % 23
    spark.range(600).select(
        "id",
        x.cast("double").alias("x"),
        F.when(F.col("id") % 50 != 49, y.cast("double")).alias("y"),
        (F.col("id") % 4).cast("int").alias("code"),
        (3 + 2.0 * x - 0.5 * y + (F.col("id") % 4) * 4).alias("label"),
    ).repartition(3, "id").sortWithinPartitions("id").write.parquet(path)
    return spark.read.parquet(path)


def test_metrics_equal_the_evaluator(spark):
    rows = [(1.0, 1.5), (2.0, 1.0), (7.0, 6.0)]
    df = spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE")
    row = R.metrics(df, "label").head()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="label", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(df))
    assert row["rows"] == 3


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label DOUBLE, prediction DOUBLE")
    row = R.metrics(df, "label").head()
    assert (row.rmse, row.r2) == (1.0, None)


def test_linear_model_equals_the_normal_equations(data):
    model = R.fit(data, "linear", "label", PLAIN, regParam=0.0)
    rows = data.na.drop().select("x", "y", "label").collect()
    a = np.array([[r.x, r.y, 1.0] for r in rows])
    expected = np.linalg.lstsq(a, np.array([r.label for r in rows]), rcond=None)[0]
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients, fitted.intercept], expected, atol=1e-6)


def test_code_above_the_training_maximum(spark, data):
    schema = "x DOUBLE, y DOUBLE, code INT, label DOUBLE"
    unseen = spark.createDataFrame([(1.0, 1.0, 9, 5.0)], schema)
    model = R.fit(data, "linear", "label", SMALL)
    assert R.predict(model, unseen, SMALL, "label").head().prediction is not None
    strict = R.onehot(["code"], "error").fit(data)
    with pytest.raises((PySparkException, Py4JJavaError)):
        strict.transform(unseen).collect()


def test_onehot_positions(data):
    rows = R.onehot_positions(data.select("code").distinct(), ["code"]).collect()
    assert {(r.code, r.code_at, r.code_size) for r in rows} == {
        (0, 0, 3), (1, 1, 3), (2, 2, 3), (3, None, 3),
    }


def test_null_features_skip_or_stop(data):
    skipped = R.feature_stages(PLAIN)[0].transform(data)
    assert skipped.count() == data.filter("y IS NOT NULL").count() < data.count()
    with pytest.raises((PySparkException, Py4JJavaError)):
        R.feature_stages(PLAIN, "error")[0].transform(data).collect()


def test_scaled_features_have_unit_deviation(data):
    assembler, scaler = R.feature_stages(PLAIN, scale=True)
    assembled = assembler.transform(data)
    scaled = scaler.fit(assembled).transform(assembled)
    flat = scaled.select(*R.feature_columns(scaled, ["a", "b"]))
    mean, *deviations = flat.agg(F.avg("a"), F.stddev_samp("a"), F.stddev_samp("b")).head()
    assert mean == pytest.approx(0, abs=1e-9)
    assert deviations == pytest.approx([1, 1])


@pytest.mark.parametrize("kind, features", [("tree", SMALL), ("forest", PLAIN), ("boosted", PLAIN)])
def test_trees_learn_and_repeat(data, kind, features):
    def predictions():
        model = R.fit(data, kind, "label", features)
        return R.predict(model, data, features, "label")

    first, second = predictions(), predictions()
    assert R.metrics(first, "label").head().r2 > 0.5
    pairs = [sorted(df.select("id", "prediction").collect()) for df in (first, second)]
    assert pairs[0] == pairs[1]


def test_settings_of_the_estimators():
    forest = R.estimator("forest", "total_amount")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (15, 5, 42)
    linear = R.estimator("linear", "total_amount")
    assert (linear.getFamily(), linear.getLink(), linear.getMaxIter(), linear.getRegParam()) == (
        "gaussian", "identity", 10, 0.1,
    )
    assert R.estimator("boosted", "tip_amount").getMaxIter() == 10
    assert R.estimator("tree", "tip_amount").getMaxDepth() == 5
    assert len(R.GRIDS["forest"]["numTrees"]) * len(R.GRIDS["forest"]["maxDepth"]) == 9
    assert (R.FOLDS["forest"], R.FOLDS["boosted"]) == (3, 5)


@pytest.mark.parametrize("weights", [{"id": 1}, None])
def test_tuning_picks_the_best_point_and_survives_a_reload(spark, data, tmp_path, weights):
    grid = {"maxDepth": [1, 5], "numTrees": [3]}
    model = R.cross_validate(data, "forest", "label", PLAIN, weights, grid)
    scores = {r.params["maxDepth"]: r.avg_rmse for r in R.grid_scores(model, data).collect()}
    assert scores[5.0] < scores[1.0]
    assert model.bestModel.getMaxDepth() == 5
    path = str(tmp_path / "model")
    R.save_model(model, path)
    R.save_model(model, path)  # replaces
    test = R.feature_stages(PLAIN)[0].transform(data)
    after = R.load_tuned(path).transform(test).select("id", "prediction")
    before = model.transform(test).select("id", "prediction")
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, before.collect()))


def test_folds_by_key_equal_brute_force(data):
    """The mean RMSE of a tuned tree equals one computed fold by fold."""
    model = R.cross_validate(data, "tree", "label", PLAIN, {"id": 1}, {"maxDepth": [3]}, folds=3)
    assembled = R.feature_stages(PLAIN)[0].transform(data).withColumn(
        "fold", (F.floor(F.col("id") / 10) % 3).cast("int")
    )
    errors = []
    for fold in range(3):
        others = assembled.filter(F.col("fold") != fold)
        fitted = R.estimator("tree", "label", maxDepth=3).fit(others)
        held_out = fitted.transform(assembled.filter(F.col("fold") == fold))
        errors.append(R.metrics(held_out, "label").head().rmse)
    assert model.avgMetrics[0] == pytest.approx(np.mean(errors))


def test_top_predictions_with_ties(spark):
    rows = [(i, 5.0, float(i)) for i in range(150)]
    df = spark.createDataFrame(rows, "id INT, label DOUBLE, prediction DOUBLE")
    rows = R.top_predictions(df.repartition(4), "label", ["id"]).collect()
    assert [(r["index"], r.id) for r in rows] == [(i, i) for i in range(100)]


def test_models_do_not_follow_the_file_splits(spark, sf_dir, monkeypatch):
    """Core counts change how files are split; the training table undoes that."""
    from checks import queries as Q
    from checks.queries import KEY, parts

    seen = []
    monkeypatch.setattr(R.training_table, "__defaults__", (1000,))  # several buckets
    monkeypatch.setattr(Q, "once", lambda s, name, d, build: build())
    for splits in ("1", "7"):
        spark.conf.set("spark.sql.files.minPartitionNum", splits)
        try:
            train, test = parts(spark, sf_dir)
            model = R.fit(train, "forest", "trip_distance", R.DISTANCE)
            predictions = R.predict(model, test, R.DISTANCE, "trip_distance")
            seen.append({tuple(r)[:-1]: r.prediction for r in predictions.select(*KEY, "prediction").collect()})
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
    assert seen[0] == seen[1]


def test_rows_with_a_null_key_stay(spark):
    from fareloom.operators import assign_split, train_test

    df = spark.createDataFrame([(1, 2), (None, 3), (7, None)], "a long, b long")
    weights = {"a": 1, "b": 1}
    train, test = train_test(df, weights)
    assert train.count() + test.count() == 3
    assert assign_split(df, weights).filter("split = 'test'").count() == test.count()


def test_encoder_default_has_a_slot_less(spark):
    df = spark.createDataFrame([(float(i), i % 4, float(i % 4)) for i in range(40)], "x double, c int, y double")
    features = R.FeatureSet(("x",), ("c",))
    sizes = [
        R.fit(df, "tree", "y", features, on_new=how).stages[-1].numFeatures
        for how in ("keep", "error")
    ]
    assert sizes == [5, 4]


def test_training_table_grows_with_the_rows_and_not_with_the_cores(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    for rows, buckets in ((1000, 1), (300, 4), (100, 10)):
        table = R.training_table(df, ["id"], str(tmp_path / f"t{rows}"), rows)
        for setting in ("1", "7"):
            spark.conf.set("spark.sql.files.minPartitionNum", setting)
            try:
                read = table.select("*")  # planned anew
                assert read.rdd.getNumPartitions() == buckets
                assert table.select("v").rdd.getNumPartitions() == buckets
                held = read.withColumn("p", F.spark_partition_id()).collect()
            finally:
                spark.conf.unset("spark.sql.files.minPartitionNum")
            assert len(held) == 1000
            assert held == sorted(held, key=lambda r: (r.p, r.id))  # sorted within each
        assert "Exchange" not in plan_of(table)
    assert R.training_table(df.limit(0), ["id"], str(tmp_path / "none")).count() == 0


def test_registered_tuning_sees_all_training_rows(spark, sf_dir, monkeypatch):
    from checks import queries as Q

    seen = {}
    monkeypatch.setattr(Q.T, "tune", lambda rows, *a, **b: seen.setdefault("n", rows.count()))
    before, own = Q.once, {"cv_forest"}
    monkeypatch.setattr(
        Q, "once", lambda s, name, d, build: build() if name in own else before(s, name, d, build)
    )
    Q.tuned(spark, sf_dir, "cv_forest")
    _, label, features = Q.TUNED["cv_forest"]
    assert seen["n"] == Q.R.complete_rows(Q.parts(spark, sf_dir)[0], features, label).count() > 10


@pytest.mark.parametrize("kind, scale", [("tree", False), ("linear", True)])
def test_codes_that_do_not_occur_take_no_slot(spark, data, kind, scale):
    """Codes 0, 90, 180 and 270 took 271 numbers in every row of a forest's input."""
    coded = data.withColumn("code", F.col("code") * 90)
    model = R.fit(coded, kind, "label", SMALL, scale)
    assert model.stages[-1].numFeatures == 2 + 4
    wide = R.Pipeline(
        stages=[*R.feature_stages(SMALL, "error", scale), R.estimator(kind, "label")]
    ).fit(R.complete_rows(coded, SMALL, "label"))
    assert wide.stages[-1].numFeatures == 2 + 271
    test = coded.withColumn("code", F.when(F.col("id") % 9 == 0, 7).otherwise(F.col("code")))
    pairs = [
        [r.prediction for r in R.predict(m, test, SMALL, "label").orderBy("id").collect()]
        for m in (model, wide)
    ]
    assert pairs[0] == pytest.approx(pairs[1])


@pytest.mark.parametrize("parts", [3, 7])  # fewer and more than the session's
def test_the_join_shuffles_into_the_training_buckets(spark, sf_dir, tmp_path, parts):
    """Trips were shuffled and written again for the training table."""
    from fareloom.plans.views import TRIP_KEY, trips

    parted = trips(spark, sf_dir, parts)
    assert parted.rdd.getNumPartitions() == parts
    names = [*TRIP_KEY, "PULocationID", "DOLocationID", "total_amount"]
    rows = parted.select(*names).withColumn("half", F.col("l_linenumber") % 2)
    path = str(tmp_path / "table")
    table = R.training_table(rows, TRIP_KEY, path, partition_by=["half"], parted=(parts, "l_orderkey"))
    files = [f.name for f in (tmp_path / "table").rglob("part-*.parquet")]
    assert len(files) == 2 * parts
    half = table.filter("half = 1")
    assert half.rdd.getNumPartitions() == parts
    wanted = trips(spark, sf_dir).select(*names)
    assert sorted(table.select(*names).collect()) == sorted(wanted.collect())
    assert half.count() == wanted.filter("l_linenumber % 2 = 1").count()


def test_buckets_hold_as_many_rows_on_larger_tables(spark):
    assert [R.buckets_of(n) for n in (0, 1, 100_000, 100_001, 480_000, 28_800_000)] == [
        1, 1, 1, 2, 5, 288,
    ]
