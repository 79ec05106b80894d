"""Named queries: scans, sinks and dataset tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import document_key
from ..operators import ordering
from ..session import spread, table, work_folder
from ..sources import corpora, datasets, files, loaders
from .ingest import ingest_documents
from .registry import query


_READERS = {".json": "json", ".txt": "lines"}


def _document_files(spark, sf) -> str:
    """Documents as JSON (even ids) and text files, several rows each, below language and source folders.

    Marker and checksum files lie beside them, and CSV files no reader is responsible for.
    """
    folder = work_folder(spark, "files")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.to_json(F.struct("doc_id", "text")).alias("value"))
    even = F.col("doc_id") % 2 == 0
    rows = table(spark, sf, "documents").where(even).select("doc_id", "lang", "source", "text")
    rows.write.partitionBy("lang", "source").option("maxRecordsPerFile", 50).json(f"{folder}/json")
    docs.where(~even).drop("doc_id").write.partitionBy("lang", "source").option("maxRecordsPerFile", 50).text(f"{folder}/text")
    table(spark, sf, "labels").write.csv(f"{folder}/other")
    return folder


def _documents_in(found):
    """Documents of scanned files by the reader their extension names."""
    path = F.col("path")
    routed = found.select("path", files.route_by_extension(path, _READERS, "none").alias("reader"), "content").where("reader <> 'none'")
    lines = files.text_content(routed).select("path", "reader", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return files.with_file_metadata(lines.withColumn("d", F.from_json("line", "doc_id long, text string"))).select(
        "d.doc_id", F.md5("d.text").alias("text_md5"), files.extension(path).alias("extension"), "page_label", "reader",
        files.path_part(path, 2).alias("source_level"), files.path_part(path, 3).alias("lang_level"))


@query("src1_directory_scan", """
SELECT doc_id, md5(text) AS text_md5, CASE WHEN doc_id % 2 = 0 THEN '.json' ELSE '.txt' END AS extension FROM documents""")
def directory_scan(spark, sf):
    return _documents_in(files.scan_directory(spark, _document_files(spark, sf))).select("doc_id", "text_md5", "extension")


@query("src2_extension_scan", "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 2 = 1")
def extension_scan(spark, sf):
    return _documents_in(files.scan_directory(spark, _document_files(spark, sf), pattern="*.txt")).select("doc_id", "text_md5")


def _scraped_folder(spark, sf) -> str:
    """Documents written as scraped JSON: every third with a question, two date layouts."""
    folder = work_folder(spark, "scraped")
    docs, day = table(spark, sf, "documents"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int"))
    docs.select(
        F.concat(F.lit("https://example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 2 == 0, F.date_format(day, "MMMM dd yy")).alias("date"),
        F.when(F.col("doc_id") % 2 == 1, F.date_format(day, "MMMM dd yy")).alias("scraped_date"),
        F.when(F.col("doc_id") % 2 == 1, F.date_format(day, "yyyy-MM-dd")).alias("published_date"),
        F.when(F.col("doc_id") % 3 == 0, F.split_part(F.col("text"), F.lit("."), F.lit(1))).alias("question"),
        F.col("text")).write.json(folder)
    return folder


@query("src3_json_documents", """
SELECT 'https://example.org/' || source || '/' || doc_id AS url,
       CAST(CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS DATE) AS VARCHAR) AS collected_on,
       CASE WHEN doc_id % 2 = 1 THEN CAST(CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS DATE) AS VARCHAR) END AS published_on,
       CASE WHEN doc_id % 3 = 0 THEN split_part(text, '.', 1) END AS question,
       md5(text) AS text_md5
FROM documents""")
def json_documents(spark, sf):
    docs = corpora.read_scraped(spark, _scraped_folder(spark, sf))
    return docs.select(
        "url", corpora.collected_on(F.col("date"), F.col("scraped_date")).cast("string").alias("collected_on"),
        corpora.mixed_date(F.col("published_date")).cast("string").alias("published_on"), "question",
        F.md5("text").alias("text_md5"))


@query("src3_broken_records", """
SELECT CASE WHEN doc_id % 7 = 0 THEN 'broken' ELSE 'read' END AS outcome, count(*) AS n FROM documents GROUP BY 1""")
def broken_records(spark, sf):
    """Every seventh record is cut off in its text: it is set aside, the others are read."""
    lines = spark.read.text(_scraped_folder(spark, sf))
    number = F.regexp_extract("value", r'"url":"https://example.org/[^"]*/([0-9]+)"', 1).cast("long")
    folder = work_folder(spark, "damaged")
    lines.select(F.when(number % 7 == 0, F.substring(F.col("value"), F.lit(1), F.length("value") - 2)).otherwise(F.col("value")).alias("value")).write.text(folder)
    good = corpora.read_scraped(spark, folder, raise_on_error=False).where("url IS NOT NULL").select(F.lit("read").alias("outcome"))
    bad = corpora.broken_records(spark, folder).select(F.lit("broken").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("src4_path_categories", r"""
SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS lang_level,
       split_part(url, '/', 5) AS leaf, 'web' AS doc_source
FROM pages""")
def path_categories(spark, sf):
    parts = F.split("url", "/")
    return files.with_categories(table(spark, sf, "pages"), "url", constants={"doc_source": "web"}).select(
        "page_id", F.get(parts, 2).alias("host"), F.get(parts, 3).alias("lang_level"),
        F.coalesce(F.get(parts, 4), F.lit("")).alias("leaf"), "doc_source")


@query("src5_include_filter", r"""
SELECT page_id, url FROM pages
WHERE (contains('/' || url, '/en/') OR contains('/' || url, '/de/')) AND regexp_extract(url, '[^/](\.[^./]+)$', 1) = '.html'
""")
def include_filter(spark, sf):
    return files.include_only(table(spark, sf, "pages"), "url", directories=["en", "de"],
                              extensions=[".html"]).select("page_id", "url")


@query("src6_csv_semicolon", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_semicolon(spark, sf):
    folder, part = work_folder(spark, "csv"), table(spark, sf, "part")
    part.write.option("sep", ";").option("header", "true").csv(folder)
    return corpora.read_csv(spark, folder, sep=";", schema=part.schema)


@query("src7_csv_column", "SELECT doc_id FROM labels")
def csv_column(spark, sf):
    folder = work_folder(spark, "csv")
    table(spark, sf, "labels").write.option("header", "true").csv(folder)
    return corpora.csv_column(spark, folder, "doc_id", "doc_id long, quality int, toxic int")


@query("src8_question_file", "SELECT item_id AS question_id, text AS question FROM benchmark")
def question_file(spark, sf):
    folder = work_folder(spark, "questions")
    table(spark, sf, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")).write.json(folder)
    return corpora.read_questions(spark, folder)


@query("src9_ground_truth", """
SELECT b.item_id AS question_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)""")
def ground_truth(spark, sf):
    from ..operators.containment import passages_in_texts

    folder = work_folder(spark, "truth")
    found = passages_in_texts(
        table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("passage")),
        spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id"), "question_id", "passage", "doc_id", "text")
    found.write.json(folder)
    return corpora.read_ground_truth(spark, folder)


@query("src10_bucket_scan", """
SELECT doc_id, md5(text) AS text_md5, '1' AS page_label, CASE WHEN doc_id % 2 = 0 THEN 'json' ELSE 'lines' END AS reader,
       'source=' || source AS source_level, 'lang=' || lang AS lang_level FROM documents""")
def bucket_scan(spark, sf):
    return _documents_in(files.scan_directory(spark, _document_files(spark, sf))).drop("extension")


@query("src11_document_loader", """
SELECT doc_id, source, md5(replace(replace(text, chr(10), ' '), chr(13), ' ')) AS text_md5 FROM documents""")
def document_loader(spark, sf):
    loaders.register_loaders(spark)
    folder = work_folder(spark, "loader")
    flat = F.translate("text", "\n\r", "  ")
    table(spark, sf, "documents").select(
        F.to_json(F.struct("doc_id", "source", flat.alias("text"))).alias("value")).repartition(8).write.text(folder)
    rows = spark.read.format("loader_lines").load(folder)
    return rows.select(F.from_json("text", "doc_id long, source string, text string").alias("d")).select(
        "d.doc_id", "d.source", F.md5("d.text").alias("text_md5"))


@query("src12_keyset_page", """
SELECT doc_id, source FROM documents WHERE doc_id > (SELECT max(doc_id) FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 10))
ORDER BY doc_id LIMIT 10""")
def keyset_page(spark, sf):
    """The second page: its cursor is the last key of the first."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    cursor = ordering.keyset_page(docs, "doc_id").agg(F.max("doc_id")).first()[0]
    return ordering.keyset_page(docs, "doc_id", cursor)


@query("src12_keyset_walk", """
SELECT CAST(floor((rn - 1) / 10) AS BIGINT) AS page_no, min(doc_id) AS first_key, max(doc_id) AS last_key,
       count(*) AS n_rows
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1""")
def keyset_walk(spark, sf):
    return ordering.page_bounds(table(spark, sf, "documents"), "doc_id", 10)


_CLASS_SQL = r"""
WITH toks AS (SELECT source, doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS n
              FROM documents),
     chunk_n AS (SELECT source, CAST(ceil(n / 256.0) AS BIGINT) AS c FROM toks)
SELECT 'D' || source || 'docs' AS class_name, count(*) AS n_objects FROM documents GROUP BY source
UNION ALL
SELECT 'D' || source || 'chunks', CAST(sum(c) AS BIGINT) FROM chunk_n GROUP BY source HAVING sum(c) > 0"""


def _stored_twice(spark, sf) -> datasets.DatasetStore:
    """The corpus ingested, then ingested again: the second run must add nothing."""
    store = datasets.DatasetStore(spark, work_folder(spark, "datasets"))
    docs = spread(table(spark, sf, "documents"), "doc_id").select(
        F.col("source").alias("dataset"), document_key(F.col("source"), F.col("doc_id").cast("string")).alias("dockey"),
        "doc_id", "text")
    for _ in range(2):
        ingest_documents(store, docs)
    return store


@query("src13_dataset_catalog", f"""
SELECT class_name, regexp_extract(class_name, '^D(.*)(docs|chunks)$', 1) AS dataset,
       CASE WHEN class_name LIKE '%docs' THEN 'Documents' ELSE 'Chunks' END AS class_type, n_objects
FROM ({_CLASS_SQL})""")
def dataset_catalog(spark, sf):
    return datasets.parse_class_name(_stored_twice(spark, sf).class_counts())


@query("src14_link_map", """
SELECT d.doc_id, p.url FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id""")
def link_map(spark, sf):
    mapping = table(spark, sf, "pages").select(
        F.concat(F.col("page_id").cast("string"), F.lit(".pdf")).alias("file_name"), "url")
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"))
    return corpora.attach_links(docs, mapping).select("doc_id", "url")


@query("snk1_dataset_append", _CLASS_SQL)
def dataset_append(spark, sf):
    return _stored_twice(spark, sf).class_counts()


@query("snk2_vector_store", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width, CAST(embedding[1] AS DOUBLE) AS first_value,
       CAST(embedding[64] AS DOUBLE) AS last_value FROM embeddings""")
def vector_store(spark, sf):
    folder = work_folder(spark, "vectors")
    datasets.write_vectors(table(spark, sf, "embeddings"), folder, "embedding")
    return spark.read.parquet(folder).select(
        "vec_id", F.size("embedding").alias("width"), F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.element_at("embedding", 64).cast("double").alias("last_value"))


@query("snk3_json_shards", """
SELECT printf('0-%06d', (rn - 1) // 500) AS shard, count(*) AS n_rows,
       min(doc_id) AS first_id, max(doc_id) AS last_id
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1""")
def json_shards(spark, sf):
    folder = work_folder(spark, "shards")
    docs = table(spark, sf, "documents").select("doc_id", F.to_json(F.struct("doc_id", "text")).alias("text"))
    datasets.write_shards(docs, folder, "doc_id", "text", 500)
    stored = spark.read.schema("chunks string, shard string").json(folder)
    doc_id = F.get_json_object("chunks", "$.doc_id").cast("long")
    return stored.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.min(doc_id).alias("first_id"),
                                       F.max(doc_id).alias("last_id"))


@query("snk5_run_metrics", """
WITH m AS (SELECT quality AS run_id, CAST(count(*) AS DOUBLE) AS n_docs, round(avg(toxic), 6) AS toxic_rate,
                  CAST(max(doc_id) AS DOUBLE) AS last_doc FROM labels GROUP BY quality)
SELECT run_id, metric, value FROM m UNPIVOT (value FOR metric IN (n_docs, toxic_rate, last_doc))""")
def run_metrics(spark, sf):
    folder = work_folder(spark, "runs")
    metrics = table(spark, sf, "labels").groupBy(F.col("quality").alias("run_id")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("toxic"), 6).alias("toxic_rate"), F.max("doc_id").alias("last_doc"))
    datasets.append_metrics(metrics, ["run_id"], folder)
    return spark.read.parquet(folder)
