"""Directory, extension and object-store scans; path-derived columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Extensions whose files count as one page.
SINGLE_PAGE = (".txt", ".json", ".htm", ".html")


def scan_directory(spark: SparkSession, folder: str, *, recursive: bool = True, pattern: str | None = None,
                   raise_on_error: bool = True) -> DataFrame:
    """Files below a folder as (path, modificationTime, length, content).

    Hidden files (leading ``.`` or ``_``) are skipped by Spark itself. ``content`` is read only
    when a later step selects it. ``pattern`` is a glob on the file name such as ``*.pdf``.
    """
    reader = (spark.read.format("binaryFile")
              .option("recursiveFileLookup", str(recursive).lower())
              .option("ignoreCorruptFiles", str(not raise_on_error).lower()))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def extension(path: Column) -> Column:
    """Extension with its dot, case kept; a leading dot of the name is no extension."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def page_label(path: Column, single_page: Iterable[str] = SINGLE_PAGE) -> Column:
    return F.when(extension(path).isin(*single_page), F.lit("1"))


def with_file_metadata(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumns({"file_name": file_name(F.col(path)), "page_label": page_label(F.col(path))})


def path_part(path: Column, from_end: int) -> Column:
    """Directory level counted from the file name (1 = the file, 2 = its folder)."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def with_categories(df: DataFrame, path: str = "path", *, levels: dict[str, int] | None = None,
                    constants: dict[str, str] | None = None) -> DataFrame:
    """Category columns read from directory levels or given as constants."""
    columns = {name: path_part(F.col(path), level) for name, level in (levels or {}).items()}
    columns |= {name: F.lit(value) for name, value in (constants or {}).items()}
    return df.withColumns(columns)


def include_only(df: DataFrame, path: str, *, directories: Iterable[str] = (),
                 extensions: Iterable[str] = ()) -> DataFrame:
    """Keep files below one of the directories and with one of the extensions."""
    column = F.col(path)
    directories, extensions = list(directories), list(extensions)
    if directories:
        inside = F.lit(False)
        for directory in directories:
            inside = inside | F.concat(F.lit("/"), column).contains(f"/{directory.strip('/')}/")
        df = df.where(inside)
    return df.where(extension(column).isin(*extensions)) if extensions else df


def route_by_extension(path: Column, readers: dict[str, str], default: str = "text") -> Column:
    """Name of the reader responsible for a file."""
    route = F.lit(default)
    for suffix, reader in readers.items():
        route = F.when(extension(path) == suffix, F.lit(reader)).otherwise(route)
    return route


def text_content(df: DataFrame) -> DataFrame:
    """Bytes of a directory scan as UTF-8 text."""
    return df.withColumn("text", F.decode(F.col("content"), "UTF-8")).drop("content")
