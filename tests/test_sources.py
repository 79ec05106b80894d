import json

import pytest
from pyspark.sql import functions as F

from foliospark.plans.ingest import chunk_documents, ingest_documents, ingest_report
from foliospark.plans.training import export_chunks, read_shards
from foliospark.session import work_folder
from foliospark.sources import corpora, datasets, files, loaders


def test_scraped_json(spark, tmp_path):
    folder = tmp_path / "VA" / "Broker" / "faq"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"url": "u1", "date": "February 02 24", "text": "Q? yes", "question": "Q?"}))
    (folder / "b.json").write_text(json.dumps({"url": "u2", "scraped_date": "March 01 24", "published_date": "2023-04-18", "text": " "}))
    (folder / "_c.json").write_text("{}")
    rows = files.with_categories(corpora.read_scraped(spark, str(tmp_path)), levels={"state_category": 4, "topic_category": 2},
                                 constants={"doc_source": "site"}).withColumn(
        "on", corpora.collected_on(F.col("date"), F.col("scraped_date"))).orderBy("url").collect()
    assert [(r.url, str(r.on), r.question, r.state_category, r.topic_category, r.doc_source) for r in rows] == [
        ("u1", "2024-02-02", "Q?", "VA", "faq", "site"), ("u2", "2024-03-01", None, "VA", "faq", "site")]


def test_directory_scan(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name in ("a.txt", "deep/b.pdf", ".hidden", "c.TXT"):
        (tmp_path / name).write_text(name)
    rows = files.with_file_metadata(files.text_content(files.scan_directory(spark, str(tmp_path)))).collect()
    assert {(r.file_name, r.page_label, r.text) for r in rows} == {("a.txt", "1", "a.txt"), ("b.pdf", None, "deep/b.pdf"), ("c.TXT", None, "c.TXT")}
    assert files.scan_directory(spark, str(tmp_path), pattern="*.pdf").count() == 1
    paths = spark.createDataFrame([("repo/tools/x.json",), ("repo/mytools/y.json",), ("tools/z.md",)], "path string")
    assert [r.path for r in files.include_only(paths, "path", directories=["tools"], extensions=[".json"]).collect()] == ["repo/tools/x.json"]


def test_link_map(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"a.pdf": "http://a", "b.pdf": "http://b"}))
    docs = spark.createDataFrame([("/x/a.pdf",), ("/x/c.pdf",)], "path string")
    got = corpora.attach_links(docs, corpora.read_link_map(spark, str(tmp_path / "map.json")))
    assert {r.file_name: r.url for r in got.collect()} == {"a.pdf": "http://a", "c.pdf": None}


def test_user_defined_loader(spark, tmp_path):
    @loaders.document_loader("upper", "one upper-case document per file")
    def upper(path):
        with open(path) as source:
            yield source.read().upper(), {"kind": "upper"}

    (tmp_path / "a.txt").write_text("hello")
    (tmp_path / ".skip").write_text("no")
    loaders.register_loaders(spark)
    (row,) = spark.read.format("loader_upper").load(str(tmp_path)).collect()
    assert (row.file_name, row.page_label, row.text, row.metadata) == ("a.txt", "1", "HELLO", {"kind": "upper"})
    assert loaders.LOADERS["upper"].description.startswith("one")


def test_broken_records_are_set_aside(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text('{"url":"u1","text":"t"}\n\n{"url":"u2"\n{"url":"u3","text":"x","more":1}\n')
    (tmp_path / "sub" / "b.json").write_text('no json\n{"url":"u4"}\n')
    good = corpora.read_scraped(spark, str(tmp_path), raise_on_error=False).where("url IS NOT NULL")
    assert sorted(r.url for r in good.collect()) == ["u1", "u3", "u4"]
    bad = corpora.broken_records(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[-1], r.record) for r in bad.collect()) == [("a.json", '{"url":"u2"'), ("b.json", "no json")]
    assert bad.count() == 2


def test_loader_filters_and_arguments(spark, tmp_path):
    @loaders.document_loader("only_a", "fails on any file but a.txt")
    def load(path, mark="?"):
        if not path.endswith("/a.txt"):
            raise ValueError(path)
        yield loaders.read_text(path) + mark, {"mark": mark}

    for name in ("a.txt", "b.txt", "deep/er/c.txt", ".hidden", "_x/d.txt", "deep/er/a.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    loaders.register_loaders(spark)
    read = spark.read.format("loader_only_a").option("mark", "!").load(str(tmp_path))
    for wanted in (F.col("file_name") == "a.txt", F.col("file_name").isin("a.txt", "none.txt") & (F.col("text") != "")):
        rows = read.where(wanted).collect()  # the filter reaches the reader, or the loader would fail
        assert sorted(r.text for r in rows) == ["a.txt!", "deep/er/a.txt!"] and rows[0].metadata == {"mark": "!"}
    for depth in (0, 1, 2, 5):
        names = spark.read.format("loader_whole").option("depth", depth).load(str(tmp_path)).select("text").collect()
        assert sorted(r.text for r in names) == ["a.txt", "b.txt", "deep/er/a.txt", "deep/er/c.txt"]


def test_loader_stream_reads_each_file_once(spark, tmp_path):
    source, progress, out = tmp_path / "in", str(tmp_path / "progress"), str(tmp_path / "out")
    source.mkdir()
    loaders.register_loaders(spark)

    def run():
        rows = spark.readStream.format("loader_lines").option("settle_ms", "0").load(str(source))
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(
            availableNow=True).start().awaitTermination()
        return sorted(r.text for r in spark.read.parquet(out).collect())

    (source / "a.txt").write_text("a1\na2\n")
    assert run() == ["a1", "a2"]
    (source / "sub").mkdir()
    (source / "sub" / "b.txt").write_text("b1")
    assert run() == ["a1", "a2", "b1"] == run()
    (source / "a.txt").write_text("a3")  # a changed file is read again
    assert run() == ["a1", "a2", "a3", "b1"]


def docs(spark, rows):
    return spark.createDataFrame(rows, "dataset string, dockey string, doc_id long, text string")


def test_ingest_twice_adds_nothing(spark):
    store = datasets.DatasetStore(spark, work_folder(spark, "test-store"))
    first = docs(spark, [("one", "k1", 1, "a b c"), ("one", "k2", 2, "d"), ("bad name", "k3", 3, "x")])
    ingest_documents(store, first, size=2)
    ingest_documents(store, first.unionByName(docs(spark, [("two", "k1", 4, "e")])), size=2)
    assert {r.class_name: r.n_objects for r in store.class_counts().collect()} == {
        "Donedocs": 2, "Donechunks": 3, "Dtwodocs": 1, "Dtwochunks": 1}
    assert [(r.dataset, r.dockey, r.doc_id) for r in store.refused().collect()] == [("bad name", "k3", 3)]
    assert "letters and digits" in store.refused().first().reason
    assert store.exists("one") and not store.exists("three")
    with pytest.raises(ValueError):
        store.exists("no spaces")


def test_an_append_that_died_is_completed(spark):
    store = datasets.DatasetStore(spark, work_folder(spark, "test-store"))
    frame = docs(spark, [("one", "k1", 1, "a b c"), ("one", "k2", 2, "d")])
    first = chunk_documents(frame.where("dockey = 'k1'"), size=2)
    first.write.mode("append").partitionBy("dataset").parquet(f"{store.root}/chunks")  # died before the documents were written
    for _ in range(2):
        ingest_documents(store, frame, size=2)
        assert store.chunks().count() == 3 and store.docs().count() == 2


def test_many_appends_stay_one_table(spark):
    store = datasets.DatasetStore(spark, work_folder(spark, "test-store"))
    for i in range(12):
        ingest_documents(store, docs(spark, [("one", f"k{i // 2}", i // 2, "a b c")]), size=2)
    assert store.docs().count() == 6 and store.chunks().count() == 12
    assert len(store.docs().inputFiles()) == 6


def test_chunk_ids_differ_between_data_sets(spark):
    store = datasets.DatasetStore(spark, work_folder(spark, "test-store"))
    ingest_documents(store, docs(spark, [("one", "k1", 1, "a b c"), ("two", "k1", 1, "a b c"), ("one", "k2", 10**15, "d")]), size=2)
    ids = [r.chunk_id for r in store.search_table().collect()]
    assert len(ids) == len(set(ids)) == 5 and all(0 <= i < 1 << 60 for i in ids)


def test_shard_numbers_keep_their_digits(one):
    for index, name in ((0, "0-000000"), (17, "0-000017"), (999_999, "0-999999"), (1_000_000, "0-1000000"), (12_345_678, "0-12345678")):
        assert one(datasets.shard_name(F.col("i")), i=index) == name


def test_class_names(spark):
    names = spark.createDataFrame([("Dmydocsdocs",), ("Dmychunks",), ("Other",)], "class_name string")
    got = [(r.dataset, r.class_type) for r in datasets.parse_class_name(names).collect()]
    assert got == [("mydocs", "Documents"), ("my", "Chunks"), ("Other", "unknown")]


def test_bad_documents_are_counted(spark):
    rows = spark.createDataFrame([("g", "x"), ("g", " \n"), ("g", None)], "g string, text string")
    row = ingest_report(rows, "text", ["g"]).first()
    assert (row.total, row.ingested, row.skipped) == (3, 1, 2)


def test_training_shards(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("chunk_id,x\n" + "".join(f"{i},y\n" for i in range(501)) + "9999,z\n")
    chunks = spark.range(501).select(F.col("id").alias("chunk_id"), F.when(F.col("id") != 3, F.concat(F.lit("c"), "id")).alias("chunk"))
    folder = work_folder(spark, "test-shards")
    misses = export_chunks(chunks, str(tmp_path / "ids.csv"), folder)
    assert [r.chunk_id for r in misses.collect()] == [9999]
    rows = read_shards(spark, folder).groupBy("shard").count().orderBy("shard").collect()
    assert [tuple(r) for r in rows] == [("0-000000", 500), ("0-000001", 1)]
    assert read_shards(spark, folder).where("chunk = ''").count() == 1


def test_metrics_table(spark):
    folder = work_folder(spark, "test-runs")
    for run in (1, 2):
        datasets.append_metrics(spark.createDataFrame([(run, 0.5, 3)], "run_id int, rmse double, n int"), ["run_id"], folder)
    assert spark.read.parquet(folder).where("metric = 'n'").count() == 2


def test_broken_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"url": "u", "text": "t"}\n{"url": \n')
    assert [r.url for r in corpora.read_scraped(spark, str(tmp_path), raise_on_error=False).select("url", "text").collect()] == ["u"]
    with pytest.raises(Exception, match="(?i)malformed"):
        corpora.read_scraped(spark, str(tmp_path)).select("url", "text").collect()
    (tmp_path / "a.json").write_text('{"url":\n "u",\n "text": "t"}')
    assert corpora.read_scraped(spark, str(tmp_path), multiline=True).first().url == "u"


def test_csv_with_separator_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;text\n1;"a;b\nc ""q"""\n2;d\n')
    rows = corpora.read_csv(spark, str(tmp_path / "a.csv"), sep=";", multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'a;b\nc "q"'), ("2", "d")]


def test_search_reads_stored_vectors_of_one_dataset(spark):
    from foliospark.functions.embedding import embed
    from foliospark.operators.retrieval import retrieve_chunks

    store = datasets.DatasetStore(spark, work_folder(spark, "test-store"))
    ingest_documents(store, docs(spark, [("one", "k1", 1, "alpha beta"), ("one", "k2", 2, "gamma"), ("two", "k3", 3, "alpha")]),
                     splitter="sentence", embedder=embed)
    asked = spark.createDataFrame([(1, "alpha")], "question_id long, question string")
    one = store.search_table("one")
    assert [r.chunk for r in one.join(retrieve_chunks(asked, one, 1, 0), "chunk_id").collect()] == ["alpha beta"]
    every = store.search_table()
    assert [r.chunk for r in every.join(retrieve_chunks(asked, every, 1, 0), "chunk_id").collect()] == ["alpha"]
