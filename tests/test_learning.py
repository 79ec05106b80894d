import json

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.operators import learning
from foliospark.session import work_folder


def test_elastic_net_solves_the_stated_objective(spark):
    x = np.arange(20, dtype=float)
    y = 3 * x + np.where(np.arange(20) % 2 == 0, 1.0, -1.0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    model = learning.elastic_net(learning.features_and_label(df, "y"), alpha=0.5, l1_ratio=0.5)
    # One feature: soft-thresholded covariance over variance plus the ridge part.
    cov, var = np.mean((x - x.mean()) * (y - y.mean())), x.var()
    assert model.coefficients[0] == pytest.approx((cov - 0.25) / (var + 0.25), rel=1e-5)


def test_label_is_not_a_feature(spark):
    df = spark.createDataFrame([(1, 2.0, "t", 5)], "id long, a double, s string, quality int")
    row = learning.features_and_label(df, "quality", ["id"]).first()
    assert (row.id, list(row.features), row.label) == (1, [2.0], 5.0)


def test_models_learn_separable_classes(spark):
    rows = [(i, [float(i % 3 == c) for c in range(3)], i % 3) for i in range(90)]
    df = learning.with_folds(learning.vector_features(spark.createDataFrame(rows, "id long, v array<double>, y int"), "v", "y", ["id"]), "id")
    assert learning.accuracy().evaluate(learning.decision_tree(df).transform(df)) == 1.0
    assert learning.accuracy().evaluate(learning.dense_classifier(df, 3, 3, hidden=(8,), max_iter=200).transform(df)) == 1.0
    assert learning.cross_validated_accuracy(df, learning.forest(5, 3, 0.1)) > 0.9
    trials = learning.search(df, learning.search_space(2, seed=1, trees=(2, 4), depth=(2, 3), share=(0.1, 0.2)))
    assert trials.count() == 2 and trials.agg(F.max("accuracy")).first()[0] > 0.9


def test_missing_features_and_impossible_settings_are_errors(spark):
    with pytest.raises(Exception, match="(?i)null"):
        learning.features_and_label(spark.createDataFrame([(1.0, None, 1), (2.0, 3.0, 0)], "a double, b double, y int"), "y").collect()
    for depth, share in ((31, 0.1), (5, 1.0)):
        with pytest.raises(ValueError):
            learning.forest(5, depth, share)


def test_search_space_is_repeatable_and_in_range():
    space = learning.search_space(20, seed=3)
    assert space == learning.search_space(20, seed=3)
    assert all(50 <= c["n_estimators"] <= 200 and 2 <= c["max_depth"] <= learning.MAX_DEPTH and 0.1 <= c["min_samples_split"] <= 1 for c in space)


def test_json_scoring(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "x double, y double")
    assembler = VectorAssembler(inputCols=["x"], outputCol="features")
    folder = work_folder(spark, "test-model")
    model = learning.elastic_net(assembler.transform(df).select("features", F.col("y").alias("label")), alpha=0.0)
    learning.save_model([assembler, model], df.select("x"), folder)
    records = spark.createDataFrame([('{"id": 7, "x": 4.0}',)], "value string")
    (row,) = learning.score_json(records, folder, "id long").collect()
    got = json.loads(row.value)
    assert got["id"] == 7 and got["prediction"] == pytest.approx(8.0)
    assert "double" in spark.read.json(f"{folder}/signature").first().signature


def test_records_that_do_not_fit_are_refused(spark):
    wanted = StructType.fromDDL("x double NOT NULL, n int, s string")
    given = {'{"x": 1.5, "n": 2, "s": "t"}': [], '{"x": 1, "n": null, "s": null}': [], '{"x": 1.5, "n": 2}': ["missing: s"],
             '{"x": "1.5", "n": 2.5, "s": "t"}': ["type: n,x"], '{"x": null, "n": 2, "s": "t"}': ["null: x"],
             '{"x": 1, "n": 2, "s": "t", "z": 1, "a": {}}': ["extra: a,z"], '{"N": 1}': ["missing: n,s,x", "extra: N"], "": ["malformed"],
             "[1]": ["malformed"], "{": ["malformed"], None: ["malformed"], "{}": ["missing: n,s,x"]}
    rows = learning.checked_records(spark.createDataFrame([(v,) for v in given], "value string"), wanted).collect()
    assert {r.value: r.reasons for r in rows} == given


def test_registered_jobs_train_the_whole_models(spark, monkeypatch):
    from foliospark.plans import learning_queries as queries

    seen = {}
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(learning, "search", lambda rows, candidates: seen.update(candidates=candidates))
    queries.parameter_search(spark, folder)
    assert len(seen["candidates"]) == 20
    assert all(50 <= c["n_estimators"] <= 200 and c["min_samples_split"] >= 0.1 for c in seen["candidates"])
    assert max(c["max_depth"] for c in seen["candidates"]) > 8
    monkeypatch.setattr(learning, "MultilayerPerceptronClassifier", lambda **options: seen.update(options))
    with pytest.raises(AttributeError):
        queries.dense_classifier(spark, folder)
    assert seen["layers"] == [64, 512, 512, 10] and seen["maxIter"] == 100
    monkeypatch.setattr(learning, "cross_validated_accuracy", lambda rows, estimator: seen.update(forest=estimator) or 1.0)
    queries.cross_validation(spark, folder)
    assert seen["forest"].getNumTrees() >= 50 and seen["forest"].getMinWeightFractionPerNode() >= 0.05


def test_a_broken_model_misses_the_floor(spark):
    """The floor of the quality queries is three quarters of every label: a model of shuffled labels does not reach it."""
    from foliospark.plans import learning_queries as queries

    rows = queries._quality(spark, "/root/testdata/sf0.01")
    assert all(r.found for r in queries._found(learning.decision_tree(rows.where("split = 'train'")), rows).collect())
    broken = rows.withColumn("label", F.when(F.col("split") == "train", F.col("doc_id") % 2).otherwise(F.col("label")).cast("double"))
    assert not all(r.found for r in queries._found(learning.decision_tree(broken.where("split = 'train'")), broken).collect())


def test_a_record_is_parsed_once_for_its_reasons_and_fields(spark):
    records = spark.createDataFrame([('{"x": 1}',), ('{"x": "a"}',)], "value string")
    checked = learning.checked_records(records, StructType.fromDDL("x double, y double, z int"))
    for rows in (checked.where("size(reasons) > 0"), checked.where("size(reasons) = 0").select("parsed.*")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("from_json(") + plan.count("jsontostructs(") <= 2  # the fields, and the texts of values that are not there


def test_dense_classifier_uses_all_cores(spark, tmp_path, monkeypatch):
    """A table of one row group trains in as many tasks as its size allows, with every row."""
    noise = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.rand(3) + i * 0)
    rows = spark.range(0, 20_000, 1, 1).select("id", (F.col("id") % 2).alias("label"), noise.alias("v"))
    rows.write.parquet(str(tmp_path / "t"))
    seen = []
    monkeypatch.setattr(learning.MultilayerPerceptronClassifier, "fit", lambda self, df: seen.append((df.rdd.getNumPartitions(), df.count())))
    train = learning.vector_features(spark.read.parquet(str(tmp_path / "t")).coalesce(1), "v", "label")
    learning.dense_classifier(train, 64, 2)
    assert seen[0][0] >= spark.sparkContext.defaultParallelism and seen[0][1] == 20_000
