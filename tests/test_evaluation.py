import pytest
from pyspark.sql import functions as F

from foliospark.operators import evaluation


def test_retrieval_metrics(spark):
    truth = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], "question_id long, doc_id long")
    got = spark.createDataFrame([(1, 99, 1), (1, 11, 2), (1, 10, 3), (2, 20, 1), (4, 40, 1)], "question_id long, doc_id long, rank int")
    row = evaluation.retrieval_metrics(evaluation.first_relevant(got, truth)).first()
    assert (row.n_questions, row.hit_rate, row.mrr) == (3, round(2 / 3, 6), 0.5)


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 4.0)], "y double, f double")
    row = evaluation.regression_metrics(df, "y", "f").first()
    assert row.r2 is None and row.mae == 1.5


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "y int, p int")
    rows = {r.label: r for r in evaluation.class_report(df, "y", "p").collect()}
    assert (rows[1].precision, rows[1].recall, rows[1].f1, rows[1].support) == (0.0, 0.0, 0.0, 1)
    assert rows[0].recall == 1.0


def test_positive_class_is_one(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, p int")
    row = evaluation.binary_summary(df, "y", "p").first()
    assert (row.true_positive, row.true_negative, row.false_positive, row.false_negative) == (1, 2, 1, 1)
    assert (row.accuracy, row.precision) == (0.6, 0.5)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    assert evaluation.roc_auc(df, "y", "s").first().auc == 0.625
    last = evaluation.roc_points(df, "y", "s").orderBy("threshold").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)
    assert evaluation.roc_auc(df.where("y = 1"), "y", "s").first().auc is None


def test_best_trial_prefers_the_earliest(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9)], "trial_no long, accuracy double")
    assert evaluation.best_trial(df, "accuracy", "trial_no").first().trial_no == 2
    assert evaluation.best_trial(df, "accuracy", "trial_no", largest=False).first().trial_no == 1


def test_epoch_average_uses_real_counts(spark):
    df = spark.createDataFrame([(1, 1.0, True), (1, 2.0, False), (1, 3.0, True)], "e int, loss double, ok boolean")
    row = evaluation.epoch_averages(df, F.col("e"), "loss", F.col("ok")).first()
    assert (row.loss, row.accuracy) == (2.0, pytest.approx(66.666667))


def test_extraction_dates_are_inclusive(spark):
    log = spark.sql("""SELECT * FROM VALUES (1, 5, TIMESTAMP_NTZ'2025-01-01 00:00:00', 'positive'), (2, 5, TIMESTAMP_NTZ'2025-01-31 23:59:59', null),
        (3, 5, TIMESTAMP_NTZ'2025-02-01 00:00:00', 'positive'), (4, 6, TIMESTAMP_NTZ'2025-01-10 00:00:00', 'negative') AS t(event_id, user_id, ts, feedback)""")
    dates = {"date_start": "2025-01-01", "date_end": "2025-01-31"}
    ids = lambda **kw: sorted(r.event_id for r in evaluation.extract_ground_truth(log, **dates, **kw).collect())
    assert ids() == [1, 4]
    assert ids(extract_all=True) == [1, 2, 4]
    assert ids(extract_all=True, filter_user=5, no_of_rows=1) == [1]
    assert ids(developers=spark.createDataFrame([(6,)], "user_id int")) == [1]
