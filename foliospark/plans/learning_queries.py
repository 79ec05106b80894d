"""Named queries: model training, evaluation and batch scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import evaluation, learning, ordering
from ..session import materialise, table, work_folder
from .registry import query

_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _prices(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", *_FEATURES, "l_extendedprice")


@query("ml7_features_and_label", """
SELECT l_orderkey, l_extendedprice AS label, l_quantity || '|' || l_discount || '|' || l_tax || '|' || CAST(l_linenumber AS DOUBLE) AS features
FROM lineitem""")
def features_and_label(spark, sf):
    made = learning.features_and_label(_prices(spark, sf), "l_extendedprice", ["l_orderkey"])
    return made.select("l_orderkey", "label", F.array_join(vector_to_array("features").cast("array<string>"), "|").alias("features"))


def _split(df, key):
    return df.withColumn("split", ordering.split_by_hash(F.col(key), 40))


@query("ml1_elastic_net")
def elastic_net(spark, sf):
    rows = _split(learning.features_and_label(_prices(spark, sf), "l_extendedprice", ["l_orderkey"]), "l_orderkey")
    model = learning.elastic_net(rows.where("split = 'train'"))
    return evaluation.regression_metrics(model.transform(rows.where("split = 'test'")), "label", "prediction")


def _labelled(spark, sf):
    return _split(learning.vector_features(table(spark, sf, "embeddings"), "embedding", "label", ["vec_id"]), "vec_id")


def _report(model, test):
    scored = model.transform(test).select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
    return evaluation.class_report(scored, "label", "prediction")


@query("ml2_decision_tree")
def decision_tree(spark, sf):
    rows = _labelled(spark, sf)
    return _report(learning.decision_tree(rows.where("split = 'train'")), rows.where("split = 'test'"))


@query("ml3_random_forest")
def random_forest(spark, sf):
    rows = _labelled(spark, sf)
    return _report(learning.forest(50, 8, 0.1).fit(rows.where("split = 'train'")), rows.where("split = 'test'"))


@query("ml4_parameter_search")
def parameter_search(spark, sf):
    rows = learning.with_folds(_labelled(spark, sf), "vec_id")
    return learning.search(rows, learning.search_space(20, seed=23))


@query("ml5_dense_classifier")
def dense_classifier(spark, sf):
    rows = _labelled(spark, sf)
    model = learning.dense_classifier(rows.where("split = 'train'"), 64, 10)
    return _report(model, rows.where("split = 'test'"))


@query("ml6_batch_scoring")
def batch_scoring(spark, sf):
    folder, rows = work_folder(spark, "model"), _prices(spark, sf)
    assembler = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    train = assembler.transform(rows).select("features", F.col("l_extendedprice").alias("label"))
    learning.save_model([assembler, learning.elastic_net(train)], rows.select(*_FEATURES), folder)
    records = rows.select(F.to_json(F.struct("l_orderkey", *_FEATURES)).alias("value"))
    return learning.score_json(records, folder, "l_orderkey long, l_linenumber int")


@query("ml6_refused_records", """
SELECT CASE l_orderkey % 8 WHEN 0 THEN 'missing: l_tax' WHEN 1 THEN 'extra: note' WHEN 2 THEN 'type: l_quantity' WHEN 3 THEN 'malformed'
       WHEN 4 THEN 'missing: l_discount;extra: discount;type: l_linenumber' ELSE 'accepted' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1""")
def refused_records(spark, sf):
    """Records damaged by their order key: exact counts of accepted and refused ones."""
    folder, rows = work_folder(spark, "model"), _prices(spark, sf)
    assembler = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    train = assembler.transform(rows).select("features", F.col("l_extendedprice").alias("label"))
    learning.save_model([assembler, learning.elastic_net(train)], rows.select(*_FEATURES), folder)
    fault, plain = F.col("l_orderkey") % 8, ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_linenumber"]
    others = [c for c in plain if c not in ("l_discount", "l_linenumber")]
    damaged = F.when(fault == 0, F.to_json(F.struct(*[c for c in plain if c != "l_tax"]))).when(
        fault == 1, F.to_json(F.struct(*plain, F.lit("x").alias("note")))).when(
        fault == 2, F.to_json(F.struct(*[F.lit("many").alias(c) if c == "l_quantity" else F.col(c) for c in plain]))).when(
        fault == 3, F.concat(F.lit("["), F.to_json(F.struct(*plain)))).when(
        fault == 4, F.to_json(F.struct(*others, F.col("l_discount").alias("discount"), F.lit(1.5).alias("l_linenumber")))).otherwise(
        F.to_json(F.struct(*plain)))
    checked = materialise(learning.checked_for(rows.select(damaged.alias("value")), folder, "l_orderkey long"), "checked-records")
    refused = learning.refused_records(checked, folder, "l_orderkey long", checked=True).select(F.array_join("reasons", ";").alias("outcome"))
    accepted = learning.score_json(checked, folder, "l_orderkey long", checked=True).select(F.lit("accepted").alias("outcome"))
    return refused.unionByName(accepted).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_COLUMN_TYPES = {"l_quantity": "double", "l_discount": "double", "l_tax": "double", "l_linenumber": "integer"}


@query("ml8_model_signature", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS type, count({c}) AS n_values FROM lineitem" for c, kind in _COLUMN_TYPES.items()))
def model_signature(spark, sf):
    """The stored signature of a model beside the values the scored table has for each of its columns."""
    folder, rows = work_folder(spark, "model"), _prices(spark, sf)
    assembler = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    train = assembler.transform(rows).select("features", F.col("l_extendedprice").alias("label"))
    learning.save_model([assembler, learning.elastic_net(train)], rows.select(*_FEATURES), folder)
    stored = spark.read.json(f"{folder}/signature").select(F.from_json("signature", "fields array<struct<name:string,type:string>>").alias("s"))
    columns = stored.select(F.inline("s.fields")).select(F.col("name").alias("column_name"), "type")
    there = rows.select(*[F.count(c).alias(c) for c in _FEATURES]).unpivot([], _FEATURES, "column_name", "n_values")
    return columns.join(there, "column_name")


@query("ml1_one_feature", f"""
WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem
           WHERE CAST('0x' || substr(md5(l_orderkey || ':40'), 1, 8) AS BIGINT) % 100 >= 25),
s AS (SELECT covar_pop(x, y) AS c, var_pop(x) AS v, avg(x) AS mx, avg(y) AS my FROM t),
w AS (SELECT sign(c) * greatest(abs(c) - 0.25, 0) / (v + 0.25) AS slope, mx, my FROM s)
SELECT round(slope, 2) AS slope, round(my - slope * mx, 1) AS intercept FROM w""")
def one_feature(spark, sf):
    """One feature has a closed form: the soft-thresholded covariance over the variance plus the ridge part."""
    rows = learning.features_and_label(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice"),
                                       "l_extendedprice", ["l_orderkey"])
    model = learning.elastic_net(_split(rows, "l_orderkey").where("split = 'train'"))
    fitted = rows.limit(1).select(F.round(F.lit(float(model.coefficients[0])), 2).alias("slope"),
                                  F.round(F.lit(float(model.intercept)), 1).alias("intercept"))
    return fitted


@query("evl9_cross_validation")
def cross_validation(spark, sf):
    rows = learning.with_folds(_labelled(spark, sf), "vec_id")
    accuracy = learning.cross_validated_accuracy(rows, learning.forest(100, 8, 0.1))
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("mean_accuracy", F.lit(accuracy))


def _quality(spark, sf):
    """Labelled documents with three features of their text: shares of symbols, of capitals, of different words."""
    length, words = F.greatest(F.length("text"), F.lit(1)), tokens(F.col("text"))
    share = lambda pattern: F.length(F.regexp_replace("text", pattern, "")) / length
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").select(
        "doc_id", "quality", share("[^#*$%&|!]+").alias("symbols"), share("[^A-Z]+").alias("capitals"),
        F.coalesce(F.try_divide(F.size(F.array_distinct(words)), F.size(words)), F.lit(0.0)).alias("different"))
    return _split(learning.features_and_label(rows, "quality", ["doc_id"]), "doc_id")


_SQL_SUPPORT = """
SELECT quality AS label, count(*) AS support, true AS found FROM documents JOIN labels USING (doc_id)
WHERE CAST('0x' || substr(md5(doc_id || ':40'), 1, 8) AS BIGINT) % 100 < 25 GROUP BY 1"""


def _found(model, rows):
    """Per label of the test rows: how many there are, and whether the model finds three quarters of them."""
    report = _report(model, rows.where("split = 'test'"))
    return report.select("label", "support", (F.col("recall") >= 0.75).alias("found"))


@query("ml2_quality_tree", _SQL_SUPPORT)
def quality_tree(spark, sf):
    rows = _quality(spark, sf)
    return _found(learning.decision_tree(rows.where("split = 'train'")), rows)


@query("ml3_quality_forest", _SQL_SUPPORT)
def quality_forest(spark, sf):
    rows = _quality(spark, sf)
    return _found(learning.forest(50, 10, 0.02).fit(rows.where("split = 'train'")), rows)


@query("evl9_quality_folds", """
SELECT CAST(CAST('0x' || substr(md5(doc_id || ':0'), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold, count(*) AS n_rows, true AS accurate
FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def quality_folds(spark, sf):
    """Three folds of the labelled documents, and whether the mean accuracy reaches 0.9."""
    rows = learning.with_folds(_quality(spark, sf), "doc_id")
    accuracy = learning.cross_validated_accuracy(rows, learning.forest(50, 10, 0.02))
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("accurate", F.lit(accuracy >= 0.9))
