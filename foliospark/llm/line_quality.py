"""Quality rules with cross-document line frequency, in column expressions only.

Lines are normalised (blanks collapsed, lower case) and hashed together with the document's host. A
line that stands in more *distinct* texts of its host than the limit allows is removed everywhere on
that host; a document that keeps too few of its words is depleted and rejected. The limit is
``max_share`` of the host's distinct texts at every size of host, and ``min_docs`` texts at least, so
exact copies of one text never make its lines frequent, however many there are. Texts of any number of
words are counted whole.

Shuffled are line hashes, never texts, and counts are combined in the map tasks first, so a frequent
line or a hot host is no hot task. Null texts have no words or lines. Null hosts form one host.
Repeated rows each get their verdict, equal texts of a host the same one. Input columns are kept;
columns of the same names as the results are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generate import let
from ..operators.sizes import at_most
from ..session import materialise
from .winnowing import BLANK_CHARS, BLANK_RUN, _spans, word_hashes

MIN_DOCS = 3
MAX_SHARE = 0.1
MIN_KEPT_WORDS = 0.2
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"
BROADCAST_TEXTS = 200_000  # texts with removed lines, about 100 bytes each
PACKED_WORDS = 1 << 16  # windows whose place is sorted inside the lower bits of their hash
_PLACE = (1 << 24) - 1


def bare(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK_CHARS))


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.length(bare(line)) > 0)


def normalised(line: Column) -> Column:
    return F.lower(F.regexp_replace(bare(line), BLANK_RUN, " "))


def line_hash(host: Column, line: Column) -> Column:
    return F.xxhash64(host, normalised(line))


def repeated_words(hashes: Column, width: int = REPEAT_WINDOW) -> Column:
    """Words covered by windows of ``width`` words that stand twice or more in the text, the first included."""

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))
        return F.aggregate(places, start, lambda acc, p: F.struct(
            (acc["total"] + p + width - F.greatest(p, acc["end"])).alias("total"), (p + width).alias("end")),
            lambda acc: acc["total"])

    def whole(windows: Column) -> Column:
        """Long texts: hash and place side by side, so that neither loses bits."""
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("p"))))
        marked = let(ordered, lambda keys: F.transform(keys, lambda key, j: F.when(
            (key["h"] == F.get(keys, j - 1)["h"]) | (key["h"] == F.get(keys, j + 1)["h"]), key["p"])))
        return covered(F.sort_array(F.filter(marked, lambda p: p.isNotNull())))

    def repeats(windows: Column) -> Column:
        keys = F.sort_array(F.transform(windows, lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long"))))
        places = F.transform(keys, lambda key: key.bitwiseAND(F.lit(_PLACE)))

        def marked(ordered: Column) -> Column:
            full = F.transform(ordered, lambda p: F.get(windows, p.cast("int")))
            return let(full, lambda h: F.transform(ordered, lambda p, j: F.when(
                (F.get(h, j) == F.get(h, j - 1)) | (F.get(h, j) == F.get(h, j + 1)), p)))

        return let(places, lambda ordered: covered(F.sort_array(F.filter(marked(ordered), lambda p: p.isNotNull()))))

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            F.when(F.size(windows) > PACKED_WORDS, whole(windows)).otherwise(repeats(windows)))

    def of_words(words: Column) -> Column:
        spans = _spans(words, width, lambda a, b: F.xxhash64(a, b), overlap=False)
        return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(
            let(F.slice(spans, 1, F.greatest(F.size(words) - width + 1, F.lit(1))), of_windows))

    return let(hashes, of_words)


def text_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the counts of one text and ``base_failed``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = word_hashes(text)
    lines = lines_of(text)
    counted = docs.withColumns({
        "_measured": let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                   repeated_words(w).alias("n_repeat_words"))),
        "word_chars": F.length(F.regexp_replace(text, BLANK_RUN, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))})
    n_words, n_repeat = F.col("_measured.n_words"), F.col("_measured.n_repeat_words")
    return counted.withColumns({
        "n_words": n_words, "n_repeat_words": n_repeat,
        "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED_PERCENT * n_words)}).drop("_measured")


def removed_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
                  max_share: float = MAX_SHARE) -> DataFrame:
    """Per (host, text) that has any: hashes of its removed lines and the words in them. Keys are hashes."""
    host, text = F.col(host_col), F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(host.alias("host"), F.xxhash64(host, text).alias("text_key"))
    copies = texts.groupBy("host", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    limits = copies.groupBy("host").agg(F.greatest(F.lit(float(min_docs)), F.count(F.lit(1)) * max_share).alias("limit"))
    lines = docs.select(host.alias("host"), F.xxhash64(host, text).alias("text_key"), F.explode_outer(F.transform(
        lines_of(text), lambda line: F.struct(line_hash(host, line).alias("line"),
                                              F.size(F.split(bare(line), BLANK_RUN)).alias("words")))).alias("found"))
    lines = (lines.where(F.col("found").isNotNull()).groupBy("host", "text_key", F.col("found.line").alias("line"))
             .agg(F.sum("found.words").alias("words")))  # of all copies together
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") > min_docs)
    frequent = (counts.join(limits, counts.host.eqNullSafe(limits.host)).where(F.col("texts") > F.col("limit"))
                .select("line"))
    found = lines.join(frequent, "line").groupBy("text_key").agg(
        F.sum("words").alias("words"), F.collect_set("line").alias("removed_lines"))
    one = copies.groupBy("text_key").agg(F.sum("copies").alias("copies"))
    return found.join(one, "text_key").select("text_key", (F.col("words") / F.col("copies")).cast("long").alias("removed_words"),
                                              "removed_lines")


def with_line_verdict(docs: DataFrame, host_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
                      max_share: float = MAX_SHARE, min_kept_words: float = MIN_KEPT_WORDS) -> DataFrame:
    """Adds the text rules, ``removed_words``, ``removed_lines``, ``cleaned_text`` and ``kept``.

    The texts with removed lines are written to the shared folder once and counted; up to
    ``BROADCAST_TEXTS`` of them are sent to all tasks, beyond that both sides are shuffled by key.
    """
    removed = materialise(removed_lines(docs, host_col, text_col, min_docs, max_share), "removed-lines")
    small = F.broadcast(removed) if at_most(removed, BROADCAST_TEXTS) else removed
    host, text = F.col(host_col), F.coalesce(F.col(text_col), F.lit(""))
    new = ("text_key", "removed_words", "removed_lines")
    rows = text_rules(docs.drop(*new), text_col).withColumn("text_key", F.xxhash64(host, text))
    judged = rows.join(small, "text_key", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    depleted = (F.col("removed_words") > 0) & (
        F.col("n_words") - F.col("removed_words") < min_kept_words * F.col("n_words"))
    stays = F.filter(F.split(F.col(text_col), "\n"), lambda line: (F.length(bare(line)) == 0) | ~F.array_contains(
        F.col("removed_lines"), line_hash(host, line)))
    cleaned = F.when(F.col("removed_lines").isNull(), F.col(text_col)).otherwise(F.array_join(stays, "\n"))
    return judged.withColumns({"cleaned_text": cleaned, "kept": ~F.col("base_failed") & ~depleted}).drop("text_key")
