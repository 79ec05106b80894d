"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

A batch's distinct pre-tokens lie end to end in one integer array. Each round looks up the rank of
every adjacent pair, takes the lowest rank of each pre-token and merges all its occurrences at once,
in all pre-tokens simultaneously, until none is left; what survives are the tokens. Documents never
move between tasks: the operator is one pass over the scan.

Null texts count as empty (0 tokens). Strings of added tokens inside a text count as one token each,
the library's default. Repeated rows each get their row. Extra columns are dropped; the id column may
have any name and type. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

NO_PAIR = np.int32(2**31 - 1)
SLICE_WORDS = 100_000  # pre-tokens merged together, which bounds a worker's memory
# Fixed value: the published split pattern of this family of tokenizers.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next one from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairTable:
    """Merge pairs in an open-addressing hash table that answers whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(4 * len(left)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_PAIR, np.int32)
        self.merged = merged.astype(np.int32)
        keys = (left.astype(np.int64) << 32) | right
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            place = slot[waiting]
            free = waiting[self.keys[place] == -1]
            self.keys[slot[free]] = keys[free]  # of several claimants one wins
            won = self.keys[slot[waiting]] == keys[waiting]
            self.ranks[slot[waiting[won]]] = waiting[won]
            waiting = waiting[~won]
            slot[waiting] = (slot[waiting] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_PAIR`` where it is no merge."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        found = np.full(len(keys), NO_PAIR, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return found


class RaggedBpe:
    """Counts symbols that survive the merges of a vocabulary."""

    def __init__(self, vocabulary: str):
        import regex

        spec = json.loads(vocabulary)
        model, pre = spec["model"], spec["pre_tokenizer"]
        known = (model["type"] == "BPE" and spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"]
                 and not pre["add_prefix_space"] and not model.get("end_of_word_suffix") and not model["ignore_merges"]
                 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]))
        if not known:
            raise ValueError("only byte-level BPE files without normalizer are counted here")
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.byte_ids = np.array([ids[c] for c in byte_letters()], np.int32)
        self.table = PairTable(np.array([ids[a] for a, _ in pairs], np.int64), np.array([ids[b] for _, b in pairs], np.int64),
                               np.array([ids[a + b] for a, b in pairs], np.int64))
        self.split = regex.compile(SPLIT_PATTERN)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how often added tokens stand in it."""
        if self.added is None or not self.added.search(text):
            return self.split.findall(text), 0
        parts = self.added.split(text)
        return [w for part in parts for w in self.split.findall(part)], len(parts) - 1

    def count(self, words: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        counts = np.zeros(len(words), np.int64)
        for at in range(0, len(words), SLICE_WORDS):
            counts[at:at + SLICE_WORDS] = self._merge([w.encode() for w in words[at:at + SLICE_WORDS]])
        return counts

    def _merge(self, words: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts, owner = lengths.copy(), np.flatnonzero(lengths > 1)  # a single byte is one token
        symbols = self.byte_ids[np.frombuffer(b"".join([words[i] for i in owner]), np.uint8)]
        lengths = lengths[owner]
        ranks = np.full(len(symbols), NO_PAIR, np.int32)
        ranks[:-1] = self.table.rank(symbols[:-1], symbols[1:])
        ranks[np.cumsum(lengths) - 1] = NO_PAIR  # no pair crosses two pre-tokens
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest != NO_PAIR
            if not going.all():  # finished pre-tokens leave the arrays
                counts[owner[~going]] = lengths[~going]
                stay = np.repeat(going, lengths)
                symbols, ranks = symbols[stay], ranks[stay]
                owner, lengths, lowest = owner[going], lengths[going], lowest[going]
                if not len(owner):
                    break
                starts = np.cumsum(lengths) - lengths
            at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            at = self._without_overlaps(at)
            symbols[at] = self.table.merged[ranks[at]]
            ranks[at] = ranks[at + 1]  # keeps the end mark of a pre-token
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            lengths = lengths - np.add.reduceat(~keep, starts, dtype=np.int64)
            symbols, ranks = symbols[keep], ranks[keep]
            last = np.zeros(len(symbols), bool)
            last[np.cumsum(lengths) - 1] = True
            merged = at - np.arange(len(at))  # where the merged symbols lie now
            changed = np.concatenate([merged, merged[merged > 0] - 1])
            changed = changed[~last[changed]]
            ranks[changed] = self.table.rank(symbols[changed], symbols[changed + 1])
        return counts

    @staticmethod
    def _without_overlaps(at: np.ndarray) -> np.ndarray:
        """Of pairs that share a symbol (a a a) every second one, from the left."""
        if not (np.diff(at) == 1).any():
            return at
        first = np.concatenate([[True], np.diff(at) != 1])
        run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - run_start) % 2 == 0]

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a pre-token that repeats within the batch is merged once."""
        index: dict[str, int] = {}
        totals = np.zeros(len(texts), np.int64)
        codes, sizes = [], []
        for row, text in enumerate(texts):
            words, totals[row] = self.pieces(text)
            codes.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
            sizes.append(len(words))
        counts = self.count(list(index))
        rows = np.repeat(np.arange(len(texts)), sizes)
        if len(rows):
            totals += np.bincount(rows, counts[np.concatenate(codes)], len(texts)).astype(np.int64)
        return totals


@lru_cache(maxsize=2)
def ragged_bpe(vocabulary: str) -> RaggedBpe:
    return RaggedBpe(vocabulary)


BATCH_CHARS = 16 << 20


def _runs(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` characters each."""
    start = held = 0
    for row, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield start, row + 1
            start, held = row + 1, 0
    if start < len(texts):
        yield start, len(texts)


def token_counts(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row; ``vocabulary`` is the file's content."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ragged_bpe(vocabulary)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            tokens = np.concatenate([np.zeros(0, np.int64), *(bpe.count_texts(texts[a:b]) for a, b in _runs(texts))])
            n_bytes = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n_bytes), pa.array(tokens)],
                                             names=[id_col, "n_bytes", "n_tokens"])

    kind = rows.schema["_id"].dataType
    out = StructType([StructField(id_col, kind), StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return rows.mapInArrow(count, out)
