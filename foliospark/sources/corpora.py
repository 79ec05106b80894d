"""Document, question and ground-truth files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import mixed_date
from .files import file_name

SCRAPED = T.StructType([T.StructField(n, T.StringType()) for n in
                        ("url", "date", "scraped_date", "published_date", "question", "text")])


def read_scraped(spark: SparkSession, folder: str, *, raise_on_error: bool = True, multiline: bool = False) -> DataFrame:
    """One JSON object per file (or per line); absent keys are null.

    Broken records fail the job, or are left out here and found by ``broken_records``. ``multiline`` reads objects that span lines. The schema is fixed, so there is no inference pass. Small files share a task: lower
    ``spark.sql.files.openCostInBytes`` to pack more of them, or compact the folder once.
    """
    df = (spark.read.schema(SCRAPED).option("recursiveFileLookup", "true").option("multiLine", str(multiline).lower())
          .option("mode", "FAILFAST" if raise_on_error else "DROPMALFORMED").json(folder))
    return df.withColumn("path", F.col("_metadata.file_path"))


def broken_records(spark: SparkSession, folder: str, *, multiline: bool = False) -> DataFrame:
    """Reject table of a scan: the path and text of every record that is no JSON object of the schema."""
    schema = T.StructType([*SCRAPED.fields, T.StructField("record", T.StringType())])
    lines = spark.read.option("recursiveFileLookup", "true").option("wholetext", str(multiline).lower()).text(folder)
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "record"})
    rows = lines.select(F.col("_metadata.file_path").alias("path"), "value", parsed.alias("parsed")).where(F.trim("value") != "")
    return rows.where(F.col("parsed.record").isNotNull()).select("path", F.col("value").alias("record"))


def collected_on(date: Column, scraped_date: Column) -> Column:
    return mixed_date(F.coalesce(date, scraped_date))


def read_csv(spark: SparkSession, path: str, *, sep: str = ",", schema: str | T.StructType | None = None,
             multiline: bool = False) -> DataFrame:
    """Headed CSV. Without a schema every column is a string; there is no inference pass.

    ``multiline`` allows line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("header", "true").option("sep", sep).option("escape", '"').option("multiLine", str(multiline).lower())
    return (reader.schema(schema) if schema else reader).csv(path)


def csv_column(spark: SparkSession, path: str, column: str, schema: str | None = None) -> DataFrame:
    """One column of a CSV file, kept distributed."""
    return read_csv(spark, path, schema=schema).select(column)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("question_id long, question string").json(path)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("question_id long, doc_id long").json(path)


def attach_links(docs: DataFrame, mapping: DataFrame, path: str = "path") -> DataFrame:
    """Link of each file from a (file_name, url) mapping; files without one keep a null link.

    Spark broadcasts the mapping when its measured size allows and shuffles otherwise.
    """
    return docs.withColumn("file_name", file_name(F.col(path))).join(mapping, "file_name", "left")


def read_link_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{file name: url}`` as a two-column table."""
    entries = spark.read.option("wholetext", "true").text(path).select(
        F.from_json("value", "map<string,string>").alias("m"))
    return entries.select(F.explode("m").alias("file_name", "url"))
