"""Document fingerprints by winnowing, in column expressions only.

The units are words (runs without ASCII blanks). Every run of ``k`` words has a 64-bit hash, put
together from the hashes of two shorter runs; of every ``window`` consecutive hashes the smallest is
kept, the rightmost one where several are equal, with its position. Two texts that share a passage of
at least ``window + k - 1`` words share a kept hash. Minima compare the upper 40 bits, the kept value
is the whole hash; beyond 2^24 words a tie across a multiple of 2^24 goes to the left.

Null and empty texts have no fingerprint (an empty array); a text with fewer than ``k`` words has the
hash of all its words, one with fewer runs than a window the smallest of them. Equal texts have equal
fingerprints. Two empty fingerprints have likeness 1, an empty and another one 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.generate import let
from ..operators.ordering import order_bounds, with_segment

BLANK_RUN = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
POSITION_BITS = 24
SEGMENT_BYTES = 48 << 20


def word_hashes(text: Column) -> Column:
    """64-bit hash of every word."""
    bare = F.btrim(text, F.lit(BLANK_CHARS))
    words = F.when(F.length(bare) > 0, F.split(bare, BLANK_RUN)).otherwise(F.array().cast("array<string>"))
    return F.transform(words, lambda w: F.xxhash64(w))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values), F.lit(1)))


def _spans(values: Column, length: int, combine, overlap: bool) -> Column:
    """For every position the combination of ``length`` values from there on (fewer at the end)."""
    if length == 1:
        return values
    half = 1 << ((length - 1).bit_length() - 1)  # largest power of two below length

    def join(doubled: Column) -> Column:
        rest = doubled if overlap or length == 2 * half else None
        if rest is not None:
            return F.zip_with(doubled, _shifted(rest, length - half), combine)
        return F.zip_with(doubled, _shifted(_spans(values, length - half, combine, overlap), half), combine)

    return let(_spans(values, half, combine, overlap), join)


def fingerprint(text: Column, k: int = 4, window: int = 16) -> Column:
    """Kept (position, hash) pairs in order of position."""
    mask = (1 << POSITION_BITS) - 1

    def keyed(runs: Column) -> Column:
        back = lambda i: F.lit(mask) - i.bitwiseAND(mask)  # noqa: E731  larger positions first among equals
        return F.transform(runs, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(back(i).cast("long")))

    def chosen(runs: Column) -> Column:
        return let(_spans(keyed(runs), window, lambda a, b: F.least(a, b), overlap=True), lambda lowest: F.transform(
            F.slice(lowest, 1, F.greatest(F.size(runs) - window + 1, F.lit(1))),
            lambda key, i: i + F.pmod(F.lit(mask) - key.bitwiseAND(mask) - i, F.lit(mask + 1))))

    def kept(runs: Column) -> Column:
        places = F.array_distinct(chosen(runs))
        return F.transform(places, lambda p: F.struct(p.cast("int").alias("position"), F.get(runs, p.cast("int")).alias("hash")))

    def of_words(hashes: Column) -> Column:
        runs = _spans(hashes, k, lambda a, b: F.xxhash64(a, b), overlap=False)
        return let(F.slice(runs, 1, F.greatest(F.size(hashes) - k + 1, F.lit(1))), kept)

    return let(word_hashes(F.coalesce(text, F.lit(""))), of_words)


def fingerprint_text(prints: Column) -> Column:
    """A fingerprint as ``position:hash`` pairs."""
    return F.array_join(F.transform(prints, lambda p: F.concat(p["position"].cast("string"), F.lit(":"), F.hex(p["hash"]))), ",")


def hash_set(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda p: p["hash"]))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two hash sets."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either == 0, 1.0).otherwise(both.cast("double") / either)


def with_next(rows: DataFrame, key: str, carried: list[str], text_bytes: int, tie: str) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows in order of a whole-number key; after the last comes the first.

    Segments of the order are windows of their own, and the first row of each is copied to the end of
    the segment before it, so no window holds more than one segment. Null keys come first.
    """
    n_rows = rows.select(key).count()
    bounds = order_bounds(rows, key, max(1, n_rows * SEGMENT_BYTES // max(text_bytes, 1)))
    parts = with_segment(rows, key, bounds, "_segment")
    first = parts.groupBy("_segment").agg(F.min(F.struct(key, tie)).alias("_first"))
    order = Window.orderBy("_segment")  # one row per segment
    before = F.coalesce(F.lag("_segment").over(order), F.last("_segment").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = first.select(F.col("_segment").alias("_edge"), "_first", before.alias("_before"))
    found = parts.join(F.broadcast(edges), (F.col("_segment") == F.col("_edge"))  # one row per segment
                       & F.struct(key, tie).eqNullSafe(F.col("_first")), "left")
    copies = F.array(F.struct(F.col("_segment").alias("_piece"), F.lit(False).alias("_copy")),
                     F.struct(F.col("_before").alias("_piece"), F.lit(True).alias("_copy")))
    spread = found.select(*rows.columns, F.inline(F.filter(copies, lambda c: c["_piece"].isNotNull())))
    ordered = Window.partitionBy("_piece").orderBy("_copy", F.asc_nulls_first(key), tie)
    after = spread.select("*", *[F.lead(c).over(ordered).alias(f"next_{c}") for c in carried])
    return after.where(~F.col("_copy")).drop("_piece", "_copy")


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points replaced by the first as many of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
