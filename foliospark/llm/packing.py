"""Pattern packing of documents into sequences by non-negative least squares.

Documents become token ids plus an end id and are cut only where they are longer than a sequence. The
histogram of piece lengths (at most ``max_len`` numbers) is all the plan needs: lengths are grouped to
bins, patterns of a few bins that fill a sequence are enumerated, their repeat counts are fitted to the
binned histogram by non-negative least squares and rounded down; each pattern is realised with the
exact lengths at hand where they fill a sequence to the last token. Residual pieces go best-fit
decreasing into new sequences. All of this counts lengths, never pieces.

Pieces find their place by rank: pieces of one length are numbered in hash buckets, so a length that
a third of all rows share, or rows that are equal in all columns, are numbered by many tasks, and rank ranges map to (sequence, offset).

A null or empty text is one piece holding the end id. Repeated rows are packed once each. Extra columns
are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import materialise
from .blocks import parts_for
from .texts import library_tokenizer, releasing
from .word_codec import ragged, split_words

BINS = 64
MAX_PARTS = 3
BUCKET_ROWS = 200_000
# What word_bpe_49k.json splits by: a letter and the mark after it are never one piece.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARK = re.compile(r"[.,;:!?](?<=[a-z\xdf-\xf6\xf8-\xff][.,;:!?])(?=[\x20\x09-\x0d]|\Z)")  # one mark between a small letter and a blank
LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
JOINED_WORDS = 50  # encoded together
ENCODED_BYTES = 8 << 20  # text whose words are looked up together
CACHED_WORDS = 600_000  # words whose ids a worker remembers, about 200 bytes each


def little_endian(ids: list[int]) -> bytes:
    """32-bit numbers as bytes; an array is made faster than NumPy's for a few numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def latin(text: str) -> bool:
    """Whether all characters lie below U+0100, where no normal form and no neighbour changes a small letter."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordIds:
    """Ids of words as little-endian bytes; texts split at blanks, where the tokenizer splits and drops.

    Words are remembered in two generations over all tasks of a worker: of the older one only what is used again is kept.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = library_tokenizer(vocabulary)
        a, b = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a", " a\n\t a "))
        if b != a * 2:
            raise ValueError("this vocabulary does not split and drop at blanks")
        capitals = "".join(c for c in map(chr, range(256)) if c != c.lower())
        self.lowers = all(self.tokenizer.encode(c, add_special_tokens=False).ids == self.tokenizer.encode(c.lower(), add_special_tokens=False).ids
                          for c in (capitals, " ".join(capitals)))
        splits = json.loads(vocabulary).get("pre_tokenizer") or {}
        first = (splits.get("pretokenizers") or [splits])[0]
        self.marks_apart = first.get("type") == "Split" and first.get("pattern") == {"Regex": LETTERS_APART}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def spread(self, text: str) -> str:
        """A text with the same ids and fewer different words."""
        if self.lowers and latin(text) and "<" not in text:  # added tokens keep their letters
            text = text.lower()
        return MARK.sub(r" \g<0>", text) if self.marks_apart else text

    def learn(self, words: list[str]) -> None:
        if len(self.known) > CACHED_WORDS // 2:
            self.older, self.known = self.known, {}
        known, older, new = self.known, self.older, []
        for word in words:
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    new.append(word)
        plain = [w for w in new if LETTERS.fullmatch(w)] if self.marks_apart else []
        for at in range(0, len(plain), JOINED_WORDS):
            self._learn_joined(plain[at:at + JOINED_WORDS])
        self._learn_alone([w for w in new if w not in known])

    def _learn_joined(self, words: list[str]) -> None:
        """Words of letters only: each is one word of the tokenizer too, and together they take half the time."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        sizes = np.bincount(found.word_ids, minlength=len(words))
        if len(sizes) == len(words) and sizes.all():
            ids, ends = little_endian(found.ids), (4 * np.cumsum(sizes)).tolist()
            self.known.update(zip(words, (ids[a:b] for a, b in pairwise([0, *ends])), strict=True))

    def _learn_alone(self, words: list[str]) -> None:
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[word] = little_endian(found.ids)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; only distinct words are looked up, and tokens are positions."""
        owner, tokens = split_words(pa.array(map(self.spread, texts), pa.large_string()))
        coded = tokens.dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.learn(words)
        found = list(map(self.known.__getitem__, words))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
        for first, end in zip((ends - np.diff(ends, prepend=0)).tolist(), ends.tolist(), strict=True):
            own = codes[first:end]
            yield ids[ragged(starts[own], sizes[own])].tobytes()


@lru_cache(maxsize=2)
def word_ids(vocabulary: str) -> WordIds:
    return WordIds(vocabulary)


def token_pieces(docs: DataFrame, vocabulary: str, max_len: int, end_id: int = 0, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length`` and the CRC-32 of its ids as little-endian 32-bit numbers."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    end, width = np.array([end_id], "<u4").tobytes(), 4 * max_len

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_ids(vocabulary)
        for whole in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column("_text")), 0).to_numpy(), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(ends // ENCODED_BYTES)) + 1).tolist(), whole.num_rows]
            for batch in (whole.slice(a, b - a) for a, b in pairwise(cuts) if b > a):
                row, start, length, crc = [], [], [], []
                for i, ids in enumerate(codec.encode(batch.column("_text").to_pylist())):
                    ids += end
                    for a in range(0, len(ids), width):
                        part = ids[a:a + width]
                        row.append(i)
                        start.append(a // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                start = pa.array(start, pa.int64())
                piece = pa.array(np.asarray(start) // max_len, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(row, pa.int64())), piece, start, pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())], names=[id_col, "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(releasing(cut), StructType([
        StructField(id_col, rows.schema["_id"].dataType), StructField("piece", IntegerType()), StructField("start", LongType()),
        StructField("length", LongType()), StructField("ids_crc32", LongType())]))


def bin_patterns(n_bins: int, max_parts: int = MAX_PARTS) -> list[tuple[int, ...]]:
    """Multisets of two or more bins that about fill a sequence; a bin stands for its middle."""
    out: list[tuple[int, ...]] = []

    def grow(parts: tuple[int, ...], left: int, more: int) -> None:
        if more == 1:
            if 1 <= left <= parts[-1]:
                out.append((*parts, left))
            return
        for size in range(min(parts[-1] if parts else n_bins, left - more + 1), 0, -1):
            grow((*parts, size), left - size, more - 1)

    for n in range(2, max_parts + 1):
        grow((), n_bins + n // 2, n)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Non-negative least squares by an active set; few columns end up above zero."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    small = 1e-9 * max(1.0, np.abs(b).max(initial=0))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= small:
            break
        active[best] = True
        while True:
            cols = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[cols] = z
                break
            falling = z <= 0
            step = np.min(x[cols][falling] / np.maximum(x[cols][falling] - z[falling], 1e-300))
            x[cols] += step * (z - x[cols])
            active[cols[x[cols] <= small]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


class Plan:
    """Groups of equal sequences: (lengths, how many)."""

    def __init__(self, histogram: dict[int, int], max_len: int):
        self.max_len, self.bin = max_len, max(1, max_len // BINS)
        self.left = np.zeros(max_len + 1, np.int64)
        for length, count in histogram.items():
            self.left[length] = count
        self.done: list[tuple[list[int], int]] = [([max_len], int(self.left[max_len]))]
        self.left[max_len] = 0
        self.open: dict[int, list[tuple[list[int], int]]] = {}
        self.spaces: list[int] = []
        self._patterns()
        self._best_fit()
        self.groups = [g for g in self.done if g[1]] + [g for s in self.spaces for g in self.open[s]]

    def _put(self, parts: list[int], count: int) -> None:
        space = self.max_len - sum(parts)
        if space == 0:
            self.done.append((parts, count))
            return
        if space not in self.open:
            self.open[space] = []
            insort(self.spaces, space)
        self.open[space].append((parts, count))

    def _patterns(self) -> None:
        n_bins = -(-self.max_len // self.bin)
        lengths = np.arange(1, self.max_len + 1)
        binned = np.bincount((lengths - 1) // self.bin, self.left[1:], n_bins)
        patterns = bin_patterns(n_bins)
        if not patterns or not binned.any():
            return
        a = np.zeros((n_bins, len(patterns)))
        for j, pattern in enumerate(patterns):
            for part in pattern:
                if part <= n_bins:
                    a[part - 1, j] += 1
        weight = np.sqrt(np.arange(1, n_bins + 1))  # a long piece left over costs more than a short one
        repeats = np.floor(nnls(a * weight[:, None], binned * weight)).astype(np.int64)
        for j in sorted(np.flatnonzero(repeats), key=lambda j: patterns[j], reverse=True):
            self._realise(patterns[j], int(repeats[j]))

    def _realise(self, pattern: tuple[int, ...], repeats: int) -> None:
        """Fill up to ``repeats`` sequences to the last token with lengths of the pattern's bins."""
        skipped: set[int] = set()  # longest lengths that no others complete
        while repeats > 0:
            longest = next((n for n in self._at_hand(pattern[0]) if n not in skipped), 0)
            if not longest:
                return
            parts = self._completed([longest], pattern[1:])
            if parts is None:
                skipped.add(longest)
                continue
            need = {length: parts.count(length) for length in parts}
            times = min(repeats, *(int(self.left[length]) // n for length, n in need.items()))
            for length, n in need.items():
                self.left[length] -= times * n
            self._put(parts, times)
            repeats -= times

    def _at_hand(self, part: int) -> list[int]:
        """Lengths of a bin that are left, the longest first."""
        low = (part - 1) * self.bin + 1
        return (np.flatnonzero(self.left[low:part * self.bin + 1]) + low)[::-1].tolist()

    def _completed(self, parts: list[int], rest: tuple[int, ...]) -> list[int] | None:
        """``parts`` with one more length per bin of ``rest``, exactly full; the last one may lie in any bin."""
        space = self.max_len - sum(parts)
        if len(rest) == 1:
            whole = [*parts, space]
            return whole if space > 0 and self.left[space] >= whole.count(space) else None
        for length in self._at_hand(rest[0]):
            if length < space and self.left[length] > parts.count(length):
                whole = self._completed([*parts, length], rest[1:])
                if whole is not None:
                    return whole
        return None

    def _best_fit(self) -> None:
        for length in range(self.max_len - 1, 0, -1):
            count = int(self.left[length])
            while count:
                at = bisect_left(self.spaces, length)
                if at == len(self.spaces):
                    per = self.max_len // length
                    full, rest = divmod(count, per)
                    if full:
                        self._put([length] * per, full)
                    if rest:
                        self._put([length] * rest, 1)
                    count = 0
                    break
                space = self.spaces[at]
                parts, times = self.open[space].pop()
                if not self.open[space]:
                    del self.open[space], self.spaces[at]
                used = min(times, count)
                if times > used:
                    self._put(parts, times - used)
                self._put([*parts, length], used)
                count -= used
            self.left[length] = 0

    @property
    def n_sequences(self) -> int:
        return sum(count for _, count in self.groups)

    def ranges(self) -> dict[str, np.ndarray]:
        """Per length and rank range: first rank, first sequence and offset, ordered by (length, first rank)."""
        rank = np.zeros(self.max_len + 1, np.int64)
        rows, base = [], 0
        for parts, count in self.groups:
            offset = 0
            for length in parts:
                rows.append((length, rank[length], base, offset))
                rank[length] += count
                offset += length
            base += count
        rows.sort()
        return dict(zip(("length", "rank", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 4).T, strict=True))


def numbered_by_length(pieces: DataFrame, n_pieces: int) -> DataFrame:
    """Adds ``rank``, the 0-based number of a piece among those of its length; ``_deal`` is a written hash of piece and row."""
    parts = pieces.withColumn("_bucket", F.pmod("_deal", F.lit(parts_for(n_pieces, BUCKET_ROWS))).cast("int"))
    inside = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_deal", *pieces.drop("_deal").columns)) - 1
    counts = parts.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (parts.withColumn("_inside", inside).join(offsets, ["length", "_bucket"])
            .withColumn("rank", (F.col("_inside") + F.col("_before")).cast("long")).drop("_inside", "_before", "_bucket", "_deal"))


def place(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` by looking (length, rank) up in the plan's ranges."""
    ranges = plan.ranges()  # bounded by the sequence length, whatever the number of pieces
    names = pieces.drop("rank").columns
    key = np.stack([ranges["length"], ranges["rank"]])
    firsts = {int(n): i for n, i in zip(*np.unique(ranges["length"], return_index=True), strict=True)}

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own, first = length == n, firsts[int(n)]
                last = first + int((key[0] == n).sum())
                at[own] = first + np.searchsorted(key[1, first:last], rank[own], side="right") - 1
            sequence = ranges["sequence"][at] + rank - ranges["rank"][at]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(ranges["offset"][at])],
                                             names=[*names, "sequence_id", "offset"])

    out = StructType([*pieces.drop("rank").schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return pieces.mapInArrow(look_up, out)


def pack_documents(docs: DataFrame, vocabulary: str, max_len: int = 2048, end_id: int = 0, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and the offset they are packed at."""
    cut = token_pieces(docs, vocabulary, max_len, end_id, id_col=id_col, text_col=text_col)
    # Written with the pieces, so equal pieces differ in it and every reader sees the same.
    pieces = materialise(cut.withColumn("_deal", F.xxhash64(*cut.columns, F.monotonically_increasing_id())), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= max_len rows
    plan = Plan(histogram, max_len)
    return place(numbered_by_length(pieces, sum(histogram.values())), plan)
