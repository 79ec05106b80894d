"""Tabular models and batch scoring with Spark ML."""

from __future__ import annotations

import json
import math
import random

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.generate import let
from ..functions.keys import stable_hash
from ..session import spread


def features_and_label(df: DataFrame, label: str, keep: list[str] = ()) -> DataFrame:
    """All numeric columns but the label as one vector, beside the label; a missing feature is an error."""
    numeric = [f.name for f in df.schema if f.name not in (label, *keep) and f.dataType.typeName() in
               ("byte", "short", "integer", "long", "float", "double")]
    made = VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="error").transform(df)
    return made.select(*keep, "features", F.col(label).cast("double").alias("label"))


def vector_features(df: DataFrame, vector: str, label: str, keep: list[str] = ()) -> DataFrame:
    return df.select(*keep, array_to_vector(F.col(vector)).alias("features"), F.col(label).cast("double").alias("label"))


def elastic_net(train: DataFrame, alpha: float = 0.5, l1_ratio: float = 0.5, max_iter: int = 1000) -> LinearRegressionModel:
    """Least squares / 2n + alpha * (l1_ratio * L1 + (1 - l1_ratio) / 2 * L2), on unscaled features.

    The solver scales the label to unit deviation, which divides the L2 part by that deviation; the two
    parameters handed over make up for it.
    """
    deviation = train.agg(F.stddev_pop("label")).first()[0] or 1.0
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * deviation
    return LinearRegression(regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2) if alpha else 0.0, standardization=False,
                            maxIter=max_iter, tol=1e-8).fit(train)


def decision_tree(train: DataFrame, max_depth: int = 5, seed: int = 42):
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed).fit(train)


MAX_DEPTH = 30  # of Spark's trees


def forest(n_estimators: int, max_depth: int, min_samples_split: float, seed: int = 42) -> RandomForestClassifier:
    """Random forest; the share a node needs to be split maps to half of it as the least share of either side."""
    if max_depth > MAX_DEPTH or not 0 <= min_samples_split < 1:
        raise ValueError(f"depth is at most {MAX_DEPTH} and the split share below 1")
    return RandomForestClassifier(numTrees=n_estimators, maxDepth=max_depth,
                                  minWeightFractionPerNode=min_samples_split / 2, seed=seed)


def dense_classifier(train: DataFrame, width: int, classes: int, hidden: tuple[int, ...] = (512, 512), max_iter: int = 100,
                     seed: int = 42):
    """Rows are dealt evenly over the cores first: every step is a pass over them, and a row group makes one task whatever its size."""
    return MultilayerPerceptronClassifier(layers=[width, *hidden, classes], maxIter=max_iter, seed=seed).fit(spread(train))


def accuracy() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy")


def with_folds(df: DataFrame, key: str, folds: int = 3, seed: int = 0) -> DataFrame:
    """Fold number by hash of the key: the same split in every run."""
    return df.withColumn("fold", (stable_hash(seed, F.col(key)) % folds).cast("int"))


def cross_validated_accuracy(folded: DataFrame, estimator, folds: int = 3, parallelism: int = 3) -> float:
    grid = ParamGridBuilder().build()
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=accuracy(), numFolds=folds,
                          foldCol="fold", parallelism=parallelism).fit(folded).avgMetrics[0]


def search_space(trials: int, seed: int, trees=(50, 200), depth=(2, MAX_DEPTH), share=(0.1, 0.99)) -> list[dict]:
    """Seeded random candidates, all of which the trees accept as they are; depth is drawn on a log scale."""
    draw = random.Random(seed)
    return [{"trial_no": i, "n_estimators": draw.randint(*trees),
             "max_depth": round(math.exp(draw.uniform(math.log(depth[0]), math.log(depth[1])))),
             "min_samples_split": round(draw.uniform(*share), 4)} for i in range(trials)]


def search(folded: DataFrame, candidates: list[dict], folds: int = 3, parallelism: int = 4) -> DataFrame:
    """Cross-validated accuracy of each candidate, one row per trial."""
    base = RandomForestClassifier(seed=42)
    for c in candidates:
        forest(c["n_estimators"], c["max_depth"], c["min_samples_split"])  # refuses what it could not use
    grid = [{base.numTrees: c["n_estimators"], base.maxDepth: c["max_depth"],
             base.minWeightFractionPerNode: c["min_samples_split"] / 2} for c in candidates]
    fitted = CrossValidator(estimator=base, estimatorParamMaps=grid, evaluator=accuracy(), numFolds=folds, foldCol="fold",
                            parallelism=parallelism).fit(folded)
    rows = [(c["trial_no"], c["n_estimators"], c["max_depth"], c["min_samples_split"], float(m))
            for c, m in zip(candidates, fitted.avgMetrics)]
    return folded.sparkSession.createDataFrame(
        rows, "trial_no long, n_estimators int, max_depth int, min_samples_split double, accuracy double")


def save_model(stages: list[Transformer], sample: DataFrame, folder: str) -> None:
    """Write fitted stages as one model with its input signature beside it."""
    PipelineModel(stages).write().overwrite().save(f"{folder}/model")
    sample.sparkSession.createDataFrame([(sample.schema.json(),)], "signature string").write.mode("overwrite").json(
        f"{folder}/signature")


def signature(df: DataFrame) -> DataFrame:
    """Column names and types a model reads, as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def stored_signature(spark, folder: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.json(f"{folder}/signature").first().signature))


def checked_records(records: DataFrame, wanted: StructType, value: str = "value") -> DataFrame:
    """JSON records with ``parsed`` fields and ``reasons``: why a record does not fit the signature, empty if it does.

    A record is refused when it is no JSON object, lacks a field or holds null in one that must have a value, has a field
    nobody asked for, or a value that is not of the field's type.
    """
    names = F.lit([f.name for f in wanted]) if len(wanted) else F.array().cast("array<string>")
    read = F.struct(F.from_json(value, wanted).alias("parsed"), F.json_object_keys(value).alias("keys"))
    text_of = F.from_json(value, "map<string,string>")

    def listed(label: str, found: Column) -> Column:
        return F.when(F.size(found) > 0, F.concat(F.lit(f"{label}: "), F.array_join(F.array_sort(found), ",")))

    def fields(test) -> Column:
        return F.filter(F.array(*[F.when(test(f), F.lit(f.name)) for f in wanted]) if len(wanted) else F.array().cast("array<string>"),
                        lambda x: x.isNotNull())

    def judged(record: Column) -> Column:
        parsed, keys = record["parsed"], record["keys"]
        missing, extra = F.array_except(names, keys), F.array_except(keys, names)

        def of_values(raw: Column) -> Column:
            wrong = fields(lambda f: F.try_element_at(raw, F.lit(f.name)).isNotNull() & parsed[f.name].isNull())
            empty = fields(lambda f: F.array_contains(keys, f.name) & F.try_element_at(raw, F.lit(f.name)).isNull() & F.lit(not f.nullable))
            return F.array(listed("type", wrong), listed("null", empty))

        whole = F.lit(all(f.nullable for f in wanted))  # values that are all there need no second look
        for f in wanted:
            whole = whole & parsed[f.name].isNotNull()
        values = F.when(whole, F.array().cast("array<string>")).otherwise(let(text_of, of_values))
        reasons = F.when(keys.isNull(), F.array(F.lit("malformed"))).otherwise(F.filter(F.concat(F.array(
            listed("missing", missing), listed("extra", extra)), values), lambda x: x.isNotNull()))
        return F.struct(parsed.alias("parsed"), reasons.alias("reasons"))

    # Bound and exploded in the outer form: a filter on the reasons is not pushed below with copies of the parsers.
    own = [c for c in records.columns if c not in ("parsed", "reasons")]
    return records.select(*own, F.explode_outer(F.array(let(read, judged))).alias("_checked")).select(*own, "_checked.parsed", "_checked.reasons")


def checked_for(records: DataFrame, folder: str, keep: str | StructType = "") -> DataFrame:
    """``checked_records`` by the signature stored with the model and the ``keep`` fields."""
    return checked_records(records, _with_kept(stored_signature(records.sparkSession, folder), keep))


def refused_records(records: DataFrame, folder: str, keep: str | StructType = "", *, checked: bool = False) -> DataFrame:
    """Reject table: records (value) that do not fit the model's stored signature and the ``keep`` fields, with their reasons.

    ``checked`` records are those of ``checked_for`` with the same ``keep`` fields; they are not parsed again.
    """
    rows = records if checked else checked_for(records, folder, keep)
    return rows.where(F.size("reasons") > 0).select("value", "reasons")


def _with_kept(wanted: StructType, keep: str | StructType) -> StructType:
    kept = StructType.fromDDL(keep) if isinstance(keep, str) and keep else keep or StructType()
    return StructType([*kept.fields, *[f for f in wanted if f.name not in kept.names]])


def score_json(records: DataFrame, folder: str, keep: str | StructType = "", *, checked: bool = False) -> DataFrame:
    """JSON records in, JSON records with the ``keep`` fields and a prediction out; refused records are left out.

    Fields are those of the signature stored with the model; it is loaded once by the driver. ``checked`` as in
    ``refused_records``.
    """
    model = PipelineModel.load(f"{folder}/model")
    good = (records if checked else checked_for(records, folder, keep)).where(F.size("reasons") == 0).select("parsed.*")
    names = _with_kept(StructType(), keep).names
    return model.transform(good).select(F.to_json(F.struct(*names, "prediction")).alias("value"))
