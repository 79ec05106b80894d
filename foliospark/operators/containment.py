"""Which passages occur verbatim in which texts, without comparing every pair.

Every distinct passage is found by one anchor: a run of its bytes, of the largest power of two up to
``ANCHOR_BYTES`` that fits into it, and of several places the one found in the fewest texts. A text is
scanned once for all anchors with a rolling hash per anchor length (prefix sums of a polynomial). Where an
anchor stands, the hash of the whole passage around it comes out of the same sums, so what leaves the row
is a true pair but for a hash collision, with the bytes that matched; joining these with the passages makes
the result exact. Texts are neither exploded nor shuffled.

Anchors are sent to the tasks in rounds of at most ``ROUND_PASSAGES`` passages (24 bytes each), so a
passage table of any size costs more scans, not more memory. Passages share an anchor without harm: places
and lengths are tried once each. An empty passage is in every text; null passages and texts are in none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..session import materialise

ANCHOR_BYTES = 32
PLACES = 8  # places of a passage that are tried as its anchor
ROUND_PASSAGES = 1 << 20
SLICE = 1 << 19  # bytes of texts scanned together
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPREAD = np.uint64(0xBF58476D1CE4E5B9)
WINDOWS = "passage string, size int, key long, width int, place int, anchor long"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of any run of a byte string by prefix sums; equal runs have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, powers: np.ndarray, inverse: np.ndarray):
        self.inverse = inverse
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=self.sums[1:])

    def runs(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        plain = (self.sums[starts + sizes] - self.sums[starts]) * self.inverse[starts]
        return _mix(plain, np.asarray(sizes).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return _mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n], np.uint64(width)) if n > 0 else np.zeros(0, np.uint64)


def _mix(hashes: np.ndarray, size) -> np.ndarray:
    hashes = (hashes ^ (size * BASE)) * SPREAD
    return hashes ^ (hashes >> np.uint64(32))


@dataclass
class Anchors:
    """Anchors of one round: sorted hashes by width, the (place, size) pairs of each, and the hashes of whole passages."""

    by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # anchors, first pair, places, sizes
    keys: np.ndarray
    largest: int

    @classmethod
    def of(cls, rows: pa.Table) -> Anchors:
        width, place, size = (rows.column(c).to_numpy().astype(np.int64) for c in ("width", "place", "size"))
        anchor, key = (rows.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("anchor", "key"))
        by_width = {}
        for w in np.unique(width).tolist():
            mine = width == w
            order = np.lexsort((size[mine], place[mine], anchor[mine]))
            a, p, s = anchor[mine][order], place[mine][order], size[mine][order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1]) | (s[1:] != s[:-1])
            a, p, s = a[new], p[new], s[new]
            unique, first = np.unique(a, return_index=True)
            by_width[w] = (unique, np.append(first, len(a)), p, s)
        return cls(by_width, np.unique(key), int(size.max(initial=0)))


def _gate(anchors: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """A bitmap that most hashes without an anchor fail."""
    bits = max(10, min(27, int(np.ceil(np.log2(len(anchors) + 1))) + 4))
    shift = np.uint64(64 - bits)
    gate = np.zeros(1 << bits, bool)
    gate[(anchors >> shift).astype(np.int64)] = True
    return gate, shift


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``SLICE`` bytes; a longer text stands alone."""
    first = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > SLICE:
            yield first, i
            first, held = i, 0
        held += n
    if lengths:
        yield first, len(lengths)


def _scan(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of texts: their ids, and the row, anchor, start and size of every passage place to test, with its hash."""
    gates = {w: _gate(entry[0]) for w, entry in anchors.by_width.items()}
    powers, inverse = _powers(BASE, SLICE), _powers(INVERSE, SLICE)
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column(1)]
        for low, high in _slices([len(t) for t in texts]):
            data = b"".join(texts[low:high])
            if len(data) >= len(powers):
                powers, inverse = _powers(BASE, len(data)), _powers(INVERSE, len(data))
            ends = np.cumsum([len(t) for t in texts[low:high]])
            rolling = Rolling(np.frombuffer(data, np.uint8), powers, inverse)
            rows, found, starts, sizes = [], [], [], []
            for width, (unique, first, places, lengths) in anchors.by_width.items():
                hashes = rolling.windows(width)
                gate, shift = gates[width]
                at = np.flatnonzero(gate[(hashes >> shift).astype(np.int64)])
                where = np.searchsorted(unique, hashes[at])
                real = (where < len(unique)) & (unique[np.minimum(where, len(unique) - 1)] == hashes[at])
                at, where = at[real], where[real]
                tries = first[where + 1] - first[where]
                pair = np.repeat(first[where] - np.cumsum(tries) + tries, tries) + np.arange(int(tries.sum()))
                start, size = np.repeat(at, tries) - places[pair], lengths[pair]
                row = np.searchsorted(ends, np.repeat(at, tries), side="right")
                inside = (start >= np.where(row > 0, ends[np.maximum(row - 1, 0)], 0)) & (start + size <= ends[np.minimum(row, len(ends) - 1)])
                rows.append(row[inside])
                found.append(np.repeat(hashes[at], tries)[inside])
                starts.append(start[inside])
                sizes.append(size[inside])
            row, anchor, start, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, found, starts, sizes))
            yield batch.column(0).slice(low, high - low), row, anchor, rolling.runs(start, size), start, size, data


def _windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of each passage that may become its anchor."""
    for batch in batches:
        out = []
        for passage in batch.column(0).to_pylist():
            data = np.frombuffer(passage.encode(), np.uint8)
            width = min(ANCHOR_BYTES, 1 << (len(data).bit_length() - 1))
            places = np.unique(np.linspace(0, len(data) - width, PLACES).astype(np.int64))
            rolling = Rolling(data, _powers(BASE, len(data)), _powers(INVERSE, len(data)))
            key = int(rolling.runs(np.zeros(1, np.int64), np.array([len(data)])).view(np.int64)[0])
            anchors = rolling.runs(places, np.full(len(places), width)).view(np.int64)
            out += [(passage, len(data), key, width, int(p), int(a)) for p, a in zip(places, anchors, strict=True)]
        names = [field.split()[0] for field in WINDOWS.split(", ")]
        types = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)


def _in_rounds(anchored: DataFrame, run: Callable[[Anchors], DataFrame], schema: StructType, round_rows: int) -> DataFrame:
    """Union of a scan for every round of anchors; each round holds a bounded number of them."""
    spark = anchored.sparkSession
    n_rounds = -(-anchored.count() // round_rows)
    out = spark.createDataFrame([], schema)
    for number in range(n_rounds):
        mine = anchored.where(F.pmod(F.xxhash64("key"), F.lit(n_rounds)) == number)
        out = out.unionByName(run(Anchors.of(mine.select("anchor", "width", "place", "size", "key").toArrow())))
    return out


def anchored_passages(passages: DataFrame, texts: DataFrame, round_passages: int = ROUND_PASSAGES) -> DataFrame:
    """Distinct non-empty passages (passage) with the anchor that the fewest texts (id, text) hold."""
    tried = materialise(passages.mapInArrow(_windows_of, WINDOWS), "passage-windows")
    schema = StructType([StructField("anchor", LongType()), StructField("n_texts", LongType())])

    def count(anchors: Anchors) -> DataFrame:
        shared = texts.sparkSession.sparkContext.broadcast(anchors)

        def scan(batches):
            for _, row, anchor, _, _, _, _ in _scan(batches, shared.value):
                pairs = np.unique(np.stack([row.astype(np.int64), anchor.astype(np.uint64).view(np.int64)], axis=1), axis=0)
                found, n = np.unique(pairs[:, 1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["anchor", "n_texts"])

        return texts.mapInArrow(scan, schema)

    # The window alone is the passage here: places count although the passage around them differs.
    alone = tried.select("anchor", "width", F.lit(0).alias("place"), F.col("width").alias("size"), F.col("anchor").alias("key")).distinct()
    counts = _in_rounds(alone, count, schema, PLACES * round_passages).groupBy("anchor").agg(F.sum("n_texts").alias("n_texts"))
    rarest = F.min(F.struct(F.coalesce("n_texts", F.lit(0)).alias("n_texts"), "place", "anchor")).alias("best")
    chosen = tried.join(counts, "anchor", "left").groupBy("passage", "size", "key", "width").agg(rarest)
    return materialise(chosen.select("passage", "size", "key", "width", "best.place", "best.anchor", "best.n_texts"), "anchors")


def passage_hits(anchored: DataFrame, texts: DataFrame, round_passages: int = ROUND_PASSAGES) -> DataFrame:
    """(id, key, found): the bytes of texts (id, text) whose hash is that of a passage, once per text and passage."""
    schema = StructType([texts.schema["id"], StructField("key", LongType()), StructField("found", BinaryType())])

    def match(anchors: Anchors) -> DataFrame:
        shared = texts.sparkSession.sparkContext.broadcast(anchors)

        def scan(batches):
            for ids, row, _, whole, start, size, data in _scan(batches, shared.value):
                where = np.searchsorted(shared.value.keys, whole)
                real = np.flatnonzero(shared.value.keys[np.minimum(where, len(shared.value.keys) - 1)] == whole)
                first = np.unique(np.stack([row[real].astype(np.int64), whole[real].view(np.int64)], axis=1), axis=0, return_index=True)[1]
                at = real[first]
                found = [data[a:a + n] for a, n in zip(start[at].tolist(), size[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[at])), pa.array(whole[at].view(np.int64)), pa.array(found, pa.binary())],
                                                 names=["id", "key", "found"])

        return texts.mapInArrow(scan, schema)

    return _in_rounds(anchored.select("anchor", "width", "place", "size", "key"), match, schema, round_passages)


def passages_in_texts(passages: DataFrame, texts: DataFrame, passage_id: str, passage: str,
                      text_id: str, text: str, round_passages: int = ROUND_PASSAGES) -> DataFrame:
    """Exact pairs (passage_id, text_id) with the passage inside the text. Ids are unique per side."""
    asked = passages.select(F.col(passage_id).alias("asked"), F.col(passage).alias("passage")).where("passage IS NOT NULL")
    rows = texts.select(F.col(text_id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    anchored = anchored_passages(asked.where("passage <> ''").select("passage").distinct(), rows, round_passages)
    hits = passage_hits(anchored, rows, round_passages)
    found = hits.join(anchored.select("key", "passage"), "key").where(F.col("found") == F.col("passage").cast("binary")).select("id", "passage")
    if not asked.where("passage = ''").isEmpty():
        found = found.unionByName(rows.select("id", F.lit("").alias("passage")))
    return found.join(asked, "passage").select(F.col("asked").alias(passage_id), F.col("id").alias(text_id))
