"""The pipeline: every stage against its operator, and what survives."""

import corpus_pipeline
import __spark_entry__ as entrypoint
from foliospark.llm.queries_models import op3, op9
from foliospark.llm.queries_native import op7

FOLDER = "/root/testdata/sf0.01"


SMALL = "/root/testdata/sf0.001"


def test_stages_keep_what_their_operators_keep(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    first = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert first.columns == docs.columns and ids(first) == ids(op7(spark, SMALL).where("kept"))
    second = corpus_pipeline.quality_classifier(spark, docs, SMALL)
    assert second.columns == docs.columns and ids(second) == ids(op9(spark, SMALL).where("kept"))
    third = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert third.columns == docs.columns and ids(third) == ids(op3(spark, SMALL).where("doc_id = component_id"))
    last = corpus_pipeline.packing(spark, docs, SMALL)
    assert ids(last) == ids(docs)


def test_stages_take_odd_rows_and_extra_columns(spark):
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(1, body, "en", "s", 5), (1, body, "en", "s", 5), (2, None, None, None, None), (None, body + " more", "en", "s", 1), (3, "", "de", "s", 0),
            (4, "x" * 200_000, "en", "s", 9), (5, body.upper(), "xx", None, 2)]
    docs = spark.createDataFrame([(*r, "own", 7, 1.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, "
                                 "kept string, n_words long, perplexity double")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, FOLDER)
            assert out.columns == docs.columns, name
            assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}, name
    assert corpus_pipeline.packing(spark, docs, FOLDER).agg({"length": "sum"}).first()[0] > 0
    assert corpus_pipeline.packing(spark, docs.limit(0), FOLDER).count() == 0


def test_run_packs_the_survivors(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "n-gram Jaccard join", "best-fit packing"]
    assert entrypoint.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entrypoint.oracle_sql()
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows}
    good = [i for i, r in labels.items() if r.quality and not r.toxic]
    bad = [i for i, r in labels.items() if not r.quality]
    assert kept < {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(i in kept for i in good) > 0.8 * len(good) and sum(i in kept for i in bad) < 0.25 * len(bad)
    texts = [r.text for r in docs.collect() if r.doc_id in kept]
    assert len(set(texts)) == len(texts)
