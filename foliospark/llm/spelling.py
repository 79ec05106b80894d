"""Spelling variants: words one edit apart, found through Bloom-guided neighbourhoods.

Words are counted over all texts (maximal runs of letters, A-Z lower-cased) and kept from a least length
and count on. Two words are near if they differ by exactly one inserted, deleted or replaced code point.
A word's form is its most frequent near word where that is ``factor`` times as frequent; the root follows
forms to the last.

1. The vocabulary is written as a table. Each word sets eight bits of one 256-bit block of the filter of
   its length; blocks are combined by ``bit_or`` in Spark.
2. Filters are broadcast in rounds of at most ``round_bytes``, however large the vocabulary gets: small
   filters share a round, and the filter of a length that is larger than a round is cut into parts by a
   second hash. A round reads the words that have neighbours of its lengths.
3. A word generates its edits that are *smaller*: each letter replaced by smaller letters, and each
   deletion (of equal letters in a row the last). The other directions are the same pairs seen from the
   other word. Only hashes are generated, from prefix sums of a polynomial hash, and probed lane by lane.
4. Edits that a filter holds are spelled and joined exactly with the vocabulary, which removes false
   positives. Each pair is then read from both ends; a word has a bounded number of neighbours.
5. Roots: pointer doubling over the words that have a form. Counts grow by ``factor`` with every step,
   which bounds the rounds.

Null and empty texts have no words. A null id reads as the empty string in the hash that plants slips.
Repeated rows count again. Words of any length are whole: lengths from ``LONG`` on share one filter and
long words are probed in slices. Ties of counts go to the smaller word in code-point order. Extra columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .texts import releasing
from .word_codec import ragged

MIN_LETTERS, MIN_COUNT, FACTOR = 6, 5, 5
SLIP_RATE = 199
LONG = 64  # lengths from here on share a filter
ROUND_BYTES = 64 << 20
BLOCK_BYTES = 32
KEYS_PER_BLOCK = 9  # about 28 bits a word, one false positive in 10,000 probes
SLICE = 1 << 20  # edits probed at once
BASE, FIRST_MIX, SECOND_MIX = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
# The salts of split block Bloom filters, as the Parquet format publishes them.
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.int64)
RANK = np.searchsorted(LETTERS, np.arange(0x100))  # how many letters are smaller


def spelled(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
            slip_rate: int | None = SLIP_RATE) -> DataFrame:
    """One row per run of letters (``word``); where the hash of id and word is a multiple of ``slip_rate`` a letter is lost."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[A-Za-zÀ-ÿ]{{{min_letters},}}"), F.lit(0))
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    found = docs.select(key.alias("key"), F.explode_outer(runs).alias("run")).where("run IS NOT NULL")
    # Spark's lower() would change accented letters too.
    low = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(
        F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = found.select("key", low.alias("word"))
    if slip_rate is None:
        return words.select("word")
    hashed = words.select("word", F.crc32(F.concat("key", "word")).alias("hash"))
    place = (F.col("hash") % F.length("word")).cast("int")
    slipped = F.concat(F.substring(F.col("word"), F.lit(1), place), F.substring(F.col("word"), place + 2, F.length("word")))
    return hashed.select(F.when(F.col("hash") % slip_rate == 0, slipped).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(30))) * FIRST_MIX
    hashes = (hashes ^ (hashes >> np.uint64(27))) * SECOND_MIX
    return hashes ^ (hashes >> np.uint64(31))


@dataclass
class Letters:
    """Code points of many words end to end; the hash of a word is the sum of code point times BASE to the place."""

    codes: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    powers: np.ndarray
    terms: np.ndarray
    before: np.ndarray  # sum of the terms before each letter of its word

    @staticmethod
    def of(words: list[str]) -> Letters:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(codes)) - starts[owner]
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(lengths.max(initial=0)) + 1, BASE)]))
        terms = codes.astype(np.uint64) * powers[place]
        sums = np.concatenate([[np.uint64(0)], np.add.accumulate(terms)]) if len(codes) else np.zeros(1, np.uint64)
        return Letters(codes, lengths, starts, owner, place, powers, terms, sums[:-1] - sums[starts][owner])

    def hashes(self) -> np.ndarray:
        last = self.starts + self.lengths - 1
        return self.before[last] + self.terms[last]


@dataclass
class Layout:
    """Where the filters of one round lie: for every shard its parts in the round, blocks of a part, and first block."""

    parts: np.ndarray  # parts of the shard in all
    low: np.ndarray  # parts in this round, from and to
    high: np.ndarray
    blocks: np.ndarray  # blocks of a part
    first: np.ndarray
    total: int

    def places(self, shards: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each hash, and which hashes have one in this round."""
        parts = (mixed(hashes ^ BASE) % self.parts[shards].astype(np.uint64)).astype(np.int64)
        here = (parts >= self.low[shards]) & (parts < self.high[shards])
        block = ((hashes >> np.uint64(32)) * self.blocks[shards].astype(np.uint64)) >> np.uint64(32)
        return self.first[shards] + (parts - self.low[shards]) * self.blocks[shards] + block.astype(np.int64), here


def layouts(counts: dict[int, int], round_bytes: int) -> list[Layout]:
    """Rounds of at most about ``round_bytes`` for the words of each shard."""
    room = max(1, round_bytes // BLOCK_BYTES)
    rounds, used = [], room
    for shard in sorted(counts):
        blocks = -(-counts[shard] // KEYS_PER_BLOCK)
        parts = -(-blocks // room)
        for part in range(parts):
            size = -(-blocks // parts)
            if used + size > room:
                rounds.append(Layout(np.ones(LONG + 1, np.int64), *(np.zeros(LONG + 1, np.int64) for _ in range(4)), 0))
                used = 0
            now = rounds[-1]
            if now.high[shard] == 0:
                now.parts[shard], now.low[shard], now.blocks[shard], now.first[shard] = parts, part, size, now.total
            now.high[shard] = part + 1
            now.total += size
            used += size
    return rounds


def shard_of_length(length: Column) -> Column:
    return F.least(length, F.lit(LONG))


def lane_bits(hashes: np.ndarray) -> np.ndarray:
    """Bit of each of the eight lanes for every hash."""
    return (hashes.astype(np.uint32)[:, None] * SALTS) >> np.uint32(27)


def filter_blocks(words: DataFrame, rounds: list[Layout]) -> DataFrame:
    """(round, block, four longs) of all filters."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = Letters.of(batch.column(0).to_pylist())
            if not len(letters.lengths):
                continue
            hashes, shards = mixed(letters.hashes()), np.minimum(letters.lengths, LONG)
            lanes = (np.uint32(1) << lane_bits(hashes)).view(np.int64)
            for number, layout in enumerate(rounds):
                block, here = layout.places(shards, hashes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(here.sum(), number, np.int32)), pa.array(block[here]),
                                                  *[pa.array(lanes[here, i]) for i in range(4)]], names=FILTER)

    rows = words.select("word").mapInArrow(bits, "round int, block long, a long, b long, c long, d long")
    return rows.groupBy("round", "block").agg(*[F.bit_or(c).alias(c) for c in FILTER[2:]])


FILTER = ["round", "block", "a", "b", "c", "d"]


def filter_of(blocks: DataFrame, number: int, layout: Layout) -> np.ndarray:
    """Filter of one round (bounded by the round's bytes) as lanes of its blocks."""
    rows = blocks.where(F.col("round") == number).toArrow()
    lanes = np.zeros((layout.total, 4), np.int64)
    lanes[rows.column("block").to_numpy()] = np.stack([rows.column(c).to_numpy() for c in FILTER[2:]], axis=1)
    return lanes.view(np.uint32)


def held(lanes: np.ndarray, block: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the hashes that the filter holds, testing lane after lane."""
    left, keys = np.arange(len(hashes)), hashes.astype(np.uint32)
    for lane in range(8):
        bit = (keys[left] * SALTS[lane]) >> np.uint32(27)
        left = left[(lanes[block[left], lane] >> bit) & np.uint32(1) == 1]
    return left


def smaller_edits(words: list[str], lanes: np.ndarray, layout: Layout) -> Iterator[tuple[int, str]]:
    """(number of the word, edit) for the smaller edits that the round's filters hold."""
    letters = Letters.of(words)
    if not words:
        return
    whole = letters.hashes()

    def probe(raw, shards, spell):
        hashes = mixed(raw)
        block, here = layout.places(shards, hashes)
        at = np.flatnonzero(here)
        for i in at[held(lanes, block[at], hashes[at])].tolist():
            yield spell(i)

    # Deletions: terms after the lost letter move one place down.
    down = letters.codes.astype(np.uint64) * letters.powers[np.maximum(letters.place - 1, 0)]
    sums = np.concatenate([[np.uint64(0)], np.add.accumulate(down)])
    ends = (letters.starts + letters.lengths)[letters.owner]
    after = sums[ends] - sums[1:]
    is_last = np.append(letters.codes[1:] != letters.codes[:-1], True) | (np.arange(1, len(letters.codes) + 1) == ends)
    lost = np.flatnonzero(is_last)
    for at in range(0, len(lost), SLICE):
        part = lost[at:at + SLICE]
        owner, place = letters.owner[part], letters.place[part]
        yield from probe(letters.before[part] + after[part], np.minimum(letters.lengths[owner] - 1, LONG),
                         lambda i, o=owner, p=place: (int(o[i]), words[o[i]][:p[i]] + words[o[i]][p[i] + 1:]))
    # Replacements by every smaller letter.
    choices = RANK[np.minimum(letters.codes, 0xFF)]
    wanted = np.isin(np.minimum(letters.lengths, LONG), np.flatnonzero(layout.high))[letters.owner]
    choices = np.where(wanted, choices, 0)
    cuts = np.searchsorted(np.cumsum(choices), np.arange(SLICE, int(choices.sum()) + SLICE, SLICE), side="left") + 1
    for low, high in zip(np.concatenate([[0], cuts[:-1]]), cuts, strict=True):
        some = np.arange(low, min(high, len(choices)))
        letter = np.repeat(some, choices[some])
        new = LETTERS[ragged(np.zeros(len(some), np.int64), choices[some])]
        owner, place = letters.owner[letter], letters.place[letter]
        raw = whole[owner] + (new - letters.codes[letter]).astype(np.uint64) * letters.powers[place]
        yield from probe(raw, np.minimum(letters.lengths[owner], LONG),
                         lambda i, o=owner, p=place, c=new: (int(o[i]), words[o[i]][:p[i]] + chr(c[i]) + words[o[i]][p[i] + 1:]))


def near_pairs(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, other, other_n) for every pair of near words of a written (word, n) table, the larger word first."""
    spark = words.sparkSession
    shard = shard_of_length(F.length("word"))
    counts = {r.shard: r.n for r in words.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}  # LONG rows at most
    rounds = layouts(counts, round_bytes)
    blocks = materialise(filter_blocks(words, rounds), "filters")
    schema = "word string, n long, other string"
    found = []
    for number, layout in enumerate(rounds):
        shards = np.flatnonzero(layout.high).tolist()
        lanes = spark.sparkContext.broadcast(filter_of(blocks, number, layout))

        def probe(batches, layout=layout, lanes=lanes):
            for batch in batches:
                spellings = batch.column(0).to_pylist()
                edits = list(smaller_edits(spellings, lanes.value, layout))
                at = pa.array([i for i, _ in edits], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([e for _, e in edits], pa.string())],
                                                 names=["word", "n", "other"])

        touched = words.where(shard.isin(shards) | shard_of_length(F.length("word") - 1).isin(shards))
        found.append(materialise(touched.select("word", "n").mapInArrow(releasing(probe), schema), "edits"))
        lanes.destroy()
    edits = spark.createDataFrame([], schema)
    for part in found:
        edits = edits.unionByName(part)
    return edits.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def with_forms(words: DataFrame, pairs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n): near words counted and the most frequent taken where it is frequent enough."""
    own = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    rows = own.unionByName(pairs).unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("word"))))
    grouped = rows.groupBy("word").agg(F.first("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= factor * F.col("n")
    return grouped.select("word", "n", "n_near", F.when(enough, F.col("best.word")).alias("form"),
                          F.when(enough, -F.col("best.minus")).alias("form_n"))


def with_roots(forms: DataFrame, factor: int = FACTOR, min_count: int = MIN_COUNT) -> DataFrame:
    """Adds ``root``: the last word when forms are followed from a word."""
    edges = materialise(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    largest = forms.agg(F.max("n")).first()[0] or min_count
    steps = 1 + int(math.log(max(1, largest / min_count), factor))  # forms in a row, rounding included
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        beyond = edges.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        edges = materialise(edges.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "forms")
    return forms.join(edges, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slip_rate: int | None = None,
                      min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, factor: int = FACTOR,
                      round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary of ``docs``."""
    runs = spelled(docs, id_col=id_col, text_col=text_col, min_letters=min_letters, slip_rate=slip_rate)
    words = materialise(vocabulary(runs, min_letters, min_count), "vocabulary")
    forms = materialise(with_forms(words, near_pairs(words, round_bytes), factor), "near")
    return with_roots(forms, factor, min_count).select("word", "form", "root", "n", "n_near", "form_n")
