"""Text splitters and neighbour context. Every splitter works inside one row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generate import inline_rows, let, posexplode_rows
from ..functions.packing import greedy_runs
from ..functions.text import tokens


def _check(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"need size >= 1 and 0 <= overlap < size, got {size}, {overlap}")


def token_windows(words: Column, size: int, overlap: int = 0) -> Column:
    """Chunk texts of a token array: a window every ``size - overlap`` tokens until the end is reached."""
    _check(size, overlap)

    def windows(w: Column) -> Column:
        last = F.greatest(F.size(w) - 1 - overlap, F.lit(0))
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), last, F.lit(size - overlap))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.array_join(F.slice(w, at + 1, size), " "))

    return let(words, windows)


def explode_chunks(df: DataFrame, chunks: str, *, adjacent: bool = True) -> DataFrame:
    """One row per chunk with its number and, if asked for, the chunk before and after it."""
    if not adjacent:
        return posexplode_rows(df, [c for c in df.columns if c != chunks], chunks, "chunk_no", "chunk")
    rows = let(F.col(chunks), lambda texts: F.transform(texts, lambda text, i: F.struct(
        i.alias("chunk_no"), text.alias("chunk"), F.when(i > 0, F.get(texts, i - 1)).alias("prev"),
        F.get(texts, i + 1).alias("next"))))
    return inline_rows(df, [c for c in df.columns if c != chunks], rows, "chunk_no")


def split_tokens(df: DataFrame, text: str, size: int = 256, overlap: int = 0, *, adjacent: bool = True) -> DataFrame:
    """Token splitter: whole text into windows of whitespace tokens."""
    chunks = token_windows(tokens(F.col(text)), size, overlap)
    return explode_chunks(df.withColumn("_chunks", chunks), "_chunks", adjacent=adjacent)


def sentences(text: Column) -> Column:
    """Sentences: cut behind ``.``, ``!`` or ``?`` with the white space that follows."""
    return F.array_remove(F.regexp_extract_all(
        text, F.lit(r"(?s)(.*?(?:[.!?][ \t\n\x0B\f\r]+|\z))"), F.lit(1)), "")


def split_sentences(df: DataFrame, text: str, size: int = 256, overlap: int = 0, *, adjacent: bool = True) -> DataFrame:
    """Sentence splitter: whole sentences up to ``size`` tokens; a longer sentence is cut into token windows."""
    _check(size, overlap)
    pieces = F.flatten(F.transform(sentences(F.col(text)), lambda s: token_windows(tokens(s), size)))
    chunks = let(pieces, lambda p: _joined_runs(p, lambda x: F.size(F.split(x, " ")), size, overlap, " "))
    return explode_chunks(df.withColumn("_chunks", chunks), "_chunks", adjacent=adjacent)


def _joined_runs(pieces: Column, measure, limit: int, overlap: int, separator: str) -> Column:
    runs = let(F.transform(pieces, measure), lambda sizes: greedy_runs(sizes, limit, overlap))
    return F.transform(runs, lambda r: F.array_join(F.slice(pieces, r["start"] + 1, r["stop"] - r["start"]), separator))


# Pieces that keep their separator at the end, so they concatenate to the text.
_PARAGRAPHS, _LINES, _WORDS = r"(?s)(.+?(?:\n\n|\z))", r"([^\n]*\n|[^\n]+)", r"([^ ]* |[^ ]+)"


def _hard_cut(text: Column, budget: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(budget)),
                       lambda at: F.substring(text, at, F.lit(budget)))


def split_characters(df: DataFrame, text: str, budget: int = 1024, *, adjacent: bool = True) -> DataFrame:
    """Character splitter: paragraphs, then lines, then words, then characters, merged up to ``budget``.

    Pieces keep their separators, so joining all chunks gives back the text without outer blanks.
    """
    def refine(pieces: Column, cut) -> Column:
        return F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) <= budget, F.array(p)).otherwise(cut(p))))

    pieces = F.regexp_extract_all(F.col(text), F.lit(_PARAGRAPHS), F.lit(1))
    for pattern in (_LINES, _WORDS):
        pieces = refine(pieces, lambda p, r=pattern: F.regexp_extract_all(p, F.lit(r), F.lit(1)))
    pieces = F.array_remove(refine(pieces, lambda p: _hard_cut(p, budget)), "")
    chunks = let(pieces, lambda p: _joined_runs(p, F.length, budget, 0, ""))
    return explode_chunks(df.withColumn("_chunks", chunks), "_chunks", adjacent=adjacent)


def neighbours_by_join(hits: DataFrame, chunks: DataFrame, doc: str = "doc", number: str = "chunk_no",
                       text: str = "chunk") -> DataFrame:
    """Previous and next chunk of each hit when they are not stored: a join on (doc, number)."""
    def side(shift: int, name: str) -> DataFrame:
        return chunks.select(F.col(doc), (F.col(number) + shift).alias(number), F.col(text).alias(name))

    return hits.join(side(1, "prev"), [doc, number], "left").join(side(-1, "next"), [doc, number], "left")

