"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts every word from the word before it, or from the start of the text: discounted counts
of word pairs, interpolated with a byte model of the word. That one predicts the bytes of a word, and
the blank after it, from the ``ORDER - 1`` bytes before within the word; an n-gram is a whole number of
``8 * ORDER`` bits, so its keys are exact, while word pairs are compared by 48 bits of a hash. Pairs take
all occurrences; the byte model takes every word as often as different words stand before it, and its lower
orders the number of different bytes before. It is trained on
every trusted document but the fifth, by a hash of the id, that the thresholds are taken over. Counts, continuation counts, context totals and discounts are grouped sums and
joins of DataFrames. Scoring covers every document: blocks of documents send the distinct n-grams of
their distinct words and their distinct word pairs to shards, the shards' n-grams are joined with the
count tables order by order, pairs meet the pairs of the model that are dealt to their shard, and the
probabilities return to the blocks. Blocks are scored in ``TURNS``, so that the texts, requests and answers on disk are
those of one turn; nothing of the model passes through the driver. A document is kept when its perplexity is at most the
``QUANTILE`` of its language, taken over all trusted documents left out of the training, times
``MARGIN``; a language without such documents (or null) takes the quantile of all languages.

An id with a label of bad quality or of toxic text is not trusted, whatever other labels it has.
Null and wordless texts have no perplexity and are rejected. Without trusted documents the model is
uniform, no threshold exists and all documents with words are kept. Repeated rows each get their row,
and equal texts of a language one verdict. Extra columns are dropped by ``perplexities`` and kept by
``classified``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..operators.sizes import at_most, broadcast_when
from ..session import discard, materialise
from .blocks import BLOCK_BYTES, by_shard, pack_blocks, parts_for, text_bytes
from .pitman_yor import lists, one_row, sorted_codes
from .texts import releasing, releasing_group, releasing_pair
from .word_codec import BlockWords, split_words

ORDER = 5  # bytes; at most 6, so that a key is sent whole
COUNTED_ROWS = 1_000  # texts whose words a task counts together
CALIBRATION_SHARE = 5  # one trusted document of so many is left out of the training
QUANTILE = 0.995
MARGIN = 1.1
SCORED_BLOCK_BYTES = BLOCK_BYTES // 4  # a block also holds its words' n-grams and pairs, about 25 bytes a byte of text
SHARD_BYTES = 32 << 20
BROADCAST_KEYS = 200_000  # of at most 16 bytes
TURNS = 5  # parts of the documents that are scored one after another
KEY_BITS = (1 << 48) - 1
SYMBOLS = 256
GRAM, PAIR, CONTEXT = 0, 1, 2  # kinds of keys
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_events(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """N-gram keys of all predicted bytes of the words, end to end, and how many each word has."""
    pad = b" " * (order - 1)
    coded = [w.encode() for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    flat = np.frombuffer(pad + (b" " + pad).join(coded) + b" ", np.uint8).astype(np.int64) if coded else np.zeros(0, np.int64)
    keys = np.zeros(max(len(flat) - order + 1, 0), np.int64)
    for i in range(order):
        keys = (keys << 8) | flat[i:i + len(keys)]
    starts = np.cumsum(sizes + order - 1) - (sizes + order - 1)  # of each word's padding
    inside = np.ones(len(keys), bool)
    for i in range(1, order):  # windows that end in the padding of the next word
        inside[starts[1:] - i] = False
    return keys[inside], sizes


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all words of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in (whole.column("text").slice(at, COUNTED_ROWS) for whole in batches for at in range(0, whole.num_rows, COUNTED_ROWS)):
            found = split_words(texts)[1].value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(releasing(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int) -> DataFrame:
    """(gram, n) over words taken ``n`` times each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = word_events(batch.column(0).to_pylist(), order)
            grams, at = np.unique(keys, return_inverse=True)
            n = np.bincount(at, np.repeat(batch.column(1).to_numpy(), sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], names=["gram", "n"])

    return words.select("word", "n").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified discounts for counts one, two and more from the counts of counts; never 0, so no probability is."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.1), float(k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def word_hashes(words: list[str]) -> np.ndarray:
    """64 bits of every word, and 0, the start of a text, at the end."""
    return np.fromiter((*(xxhash.xxh3_64_intdigest(w.encode()) for w in words), 0), np.uint64, len(words) + 1)


def word_pairs(codes: np.ndarray, sizes: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word before, word) of texts end to end, and the pair of each word; ``n_words`` stands for the start."""
    keys = np.empty(len(codes), np.int64)
    keys[1:] = codes[:-1]
    keys[(np.cumsum(sizes) - sizes)[sizes > 0]] = n_words
    keys *= n_words + 1
    keys += codes
    pairs, at = np.unique(keys, return_inverse=True)
    return pairs // (n_words + 1), pairs % (n_words + 1), at.astype(np.int32)


def pair_keys(before: np.ndarray, word: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return (hashes[before] * _MIX + hashes[word]).view(np.int64)


def pair_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Word pairs of all texts, dealt by the word before: (context, pair, n) and, of the context, its total ``total`` and how
    many pairs occur once, twice and more often (``once``, ``twice``, ``more``); ``opens`` marks one pair of each context."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in (whole.column("text").slice(at, COUNTED_ROWS) for whole in batches for at in range(0, whole.num_rows, COUNTED_ROWS)):
            owner, tokens = split_words(texts)
            words, codes = sorted_codes(pa.chunked_array([tokens]))
            if len(words):
                hashes = word_hashes(words.to_pylist())
                before, word, at = word_pairs(codes, np.bincount(owner, minlength=len(texts)), len(words))
                yield pa.RecordBatch.from_arrays([pa.array(hashes[before].view(np.int64)), pa.array(pair_keys(before, word, hashes)),
                                                  pa.array(np.bincount(at, minlength=len(word)))], names=["context", "pair", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(releasing(count), "context long, pair long, n long")
    counted = found.repartition("context").groupBy("context", "pair").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("context")
    return counted.select("context", "pair", "n", F.sum("n").over(own).alias("total"), F.count_if(F.col("n") == 1).over(own).alias("once"),
                          F.count_if(F.col("n") == 2).over(own).alias("twice"), F.count_if(F.col("n") > 2).over(own).alias("more"),
                          (F.row_number().over(own.orderBy("pair")) == 1).alias("opens"))


def words_before(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(word, n): how many different words, or the start of a text, stand before each word. The pair's key holds the word's hash."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, pair = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
            found, n = np.unique((pair - context * _MIX).view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["hash", "n"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = word_hashes(batch.column(0).to_pylist())[:-1].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), batch.column(0)], names=["hash", "word"])

    counts = pairs.select("context", "pair").mapInArrow(hashed, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return words.select("word").mapInArrow(named, "hash long, word string").join(counts, "hash").select("word", "n")


@dataclass
class Model:
    """Per order: (gram, alpha) and (context, gamma); the probability is alpha plus gamma times the lower order's.

    ``words``, if given, holds the alphas of word pairs and the gammas of words before as (kind, key, p), read from the work
    table ``pairs``.
    """

    order: int
    alphas: list[DataFrame]
    gammas: list[DataFrame]
    words: DataFrame | None = None
    pairs: DataFrame | None = None


def fit_words(table: DataFrame) -> DataFrame:
    """(kind, key, p) of the word pairs and of the words before, from the written pair counts; nothing is shuffled."""
    d = discounts(*table.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first())
    cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    gamma = (d[0] * F.col("once") + d[1] * F.col("twice") + d[2] * F.col("more")) / F.col("total")
    of_pair = F.struct(F.lit(PAIR).alias("kind"), F.col("pair").alias("key"), ((F.col("n") - cut) / F.col("total")).alias("p"))
    of_context = F.struct(F.lit(CONTEXT).alias("kind"), F.col("context").alias("key"), gamma.alias("p"))
    return table.select(F.explode(F.when(F.col("opens"), F.array(of_pair, of_context)).otherwise(F.array(of_pair))).alias("row")).select("row.*")


def cut_of(table: DataFrame) -> Column:
    """The discount of each row by its count ``n``."""
    d = discounts(*table.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first())
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def fit(trusted: DataFrame, text_col: str = "text", order: int = ORDER, across: bool = False) -> Model:
    """The byte model of the words alone, or ``across`` words that of their continuations below the word pairs."""
    words, pairs = word_counts(trusted, text_col), None
    if across:
        pairs = materialise(pair_counts(trusted, text_col).sortWithinPartitions("context"), "pair-counts")
        words = words_before(pairs, words)
    table = materialise(gram_counts(words, order), "gram-counts")
    alphas, gammas = [], []
    for k in range(order, 0, -1):
        if k < order:  # how many different bytes precede
            table = materialise(table.groupBy(F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram")).agg(
                F.count(F.lit(1)).alias("n")), "gram-counts")
        cut = cut_of(table)
        rows = table.withColumn("context", F.shiftright("gram", 8))
        totals = rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("gamma"))
        alphas.append(materialise(rows.join(broadcast_when(totals, k <= 2), "context").select(  # at most 256 contexts
            "gram", ((F.col("n") - cut) / F.col("total")).alias("alpha")), "alphas"))
        gammas.append(materialise(totals.select("context", "gamma"), "gammas"))
    return Model(order, alphas[::-1], gammas[::-1], fit_words(pairs) if across else None, pairs)


def gram_probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """Adds ``p`` by joining each order's counts; unseen grams and contexts leave the lower order's probability."""
    out = grams.withColumn("p", F.lit(1.0 / SYMBOLS))
    for k, (alpha, gamma) in enumerate(zip(model.alphas, model.gammas, strict=True), 1):
        small = k <= 2  # at most 256 ** 2 rows
        out = out.withColumns({"_gram": F.col("gram").bitwiseAND((1 << 8 * k) - 1),
                               "_context": F.shiftright(F.col("gram").bitwiseAND((1 << 8 * k) - 1), 8)})
        out = out.join(broadcast_when(alpha.withColumnRenamed("gram", "_gram"), small), "_gram", "left")
        out = out.join(broadcast_when(gamma.withColumnRenamed("context", "_context"), small), "_context", "left")
        out = out.withColumn("p", F.coalesce("alpha", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("p")).drop(
            "alpha", "gamma", "_gram", "_context")
    return out


def _block_tokens(payloads: pa.ChunkedArray) -> tuple[pa.Table, np.ndarray, list[str], np.ndarray]:
    """Rows of a block without their texts, words per row, sorted words, and the word of each token."""
    block = BlockWords(payloads)
    return block.rows.drop_columns("text"), np.bincount(block.owner, minlength=block.rows.num_rows), block.words, block.codes


def _shards(grams: np.ndarray, n_shards: int) -> np.ndarray:
    mixed = grams.astype(np.uint64) * _MIX
    return ((mixed >> np.uint64(32)) % np.uint64(n_shards)).astype(np.int64)


def _keys(words: list[str], grams: np.ndarray, sizes: np.ndarray, codes: np.ndarray, across: bool):
    """Keys of each kind that a block needs, with the word before, the word and the tokens of the pairs."""
    none = np.zeros(0, np.int64)
    before, word, at = word_pairs(codes, sizes, len(words)) if across else (none, none, none)
    hashes = word_hashes(words) if across else none.view(np.uint64)
    return (grams, pair_keys(before, word, hashes), hashes.view(np.int64)), (before, word, at)


def _places(keys: tuple[np.ndarray, ...], n_shards: int) -> dict[int, dict[int, np.ndarray]]:
    """Per shard and kind the places of the keys, in the order in which they are sent."""
    out: dict[int, dict[int, np.ndarray]] = {}
    for kind, own in enumerate(keys):
        order = np.argsort(_sent(own), kind="stable")
        for shard, p in by_shard(_shards(own[order], n_shards)):
            out.setdefault(shard, {})[kind] = order[p]
    return out


def _sent(keys: np.ndarray) -> np.ndarray:
    """The 48 bits of a key that are sent; n-grams of up to six bytes are whole."""
    return keys & KEY_BITS


def _steps(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as differences, in four bytes where they fit."""
    steps = np.diff(keys, prepend=0)
    return steps.astype(np.uint32) if not len(steps) or steps.max() < 1 << 32 else steps


_NONE = np.zeros(0, np.int64)


def _ask(n_shards: int, order: int, across: bool):
    def ask(table: pa.Table) -> pa.Table:
        block, (_, sizes, words, codes) = table.column("block")[0].as_py(), _block_tokens(table.column("payload"))
        keys, _ = _keys(words, np.unique(word_events(words, order)[0]), sizes, codes, across)
        out = []
        for shard, places in sorted(_places(keys, n_shards).items()):
            sent = {f"k{kind}": _steps(_sent(own[places.get(kind, _NONE)])) for kind, own in enumerate(keys)}
            out.append((shard, block, one_row(k0=sent.pop("k0")), one_row(**sent)))
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["shard", "block", "grams", "pairs"])
    return ask


def _whole(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int64)


def _asked(table: pa.Table) -> pa.Table:
    grams = np.unique(np.concatenate([_whole(lists(p.as_buffer())["k0"]) for p in table.column("grams")]))
    return pa.table({"shard": pa.array(np.full(len(grams), table.column("shard")[0].as_py()), pa.int32()), "gram": grams})


PACKED_KEYS = 1 << 20  # keys of a task that are packed together


def _dealt(n_shards: int):
    """Keys with their probabilities, packed by shard: per kind the sent keys in order, and ``p``."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACKED_KEYS:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        kinds, keys, p = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("kind", "key", "p"))
        out = []
        for shard, at in by_shard(_shards(keys, n_shards)):
            own = {kind: at[kinds[at] == kind] for kind in (GRAM, PAIR, CONTEXT)}
            own = {kind: places[np.argsort(_sent(keys[places]), kind="stable")] for kind, places in own.items()}
            out.append((shard, one_row(**{f"k{kind}": _steps(_sent(keys[places])) for kind, places in own.items()},
                                       **{f"p{kind}": p[places].astype(np.float64 if kind == GRAM else np.float32) for kind, places in own.items()})))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.binary()))], names=["shard", "known"])
    return deal


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    parts = [lists(x.as_buffer()) for x in right.column("known")]
    known = []
    for kind in (GRAM, PAIR, CONTEXT):
        keys = np.concatenate([_NONE, *[_whole(x[f"k{kind}"]) for x in parts]])
        p = np.concatenate([np.zeros(0, np.float32), *[x[f"p{kind}"] for x in parts]])
        order = np.argsort(keys, kind="stable")
        known.append((keys[order], p[order]))
    del parts

    def found(kind: int, asked: np.ndarray, missing: float) -> np.ndarray:
        own, values = known[kind]
        at = np.searchsorted(own, asked)
        there = np.append(own, 0)[at] == asked
        return np.where(there & (at < len(own)), np.append(values, missing)[at], missing)

    payloads = []
    for own in zip(left.column("grams"), left.column("pairs"), strict=True):
        asked = {k: _whole(v) for x in own for k, v in lists(x.as_buffer()).items()}
        payloads.append(one_row(k0=np.log(found(GRAM, asked["k0"], 1.0)).astype(np.float32), k1=found(PAIR, asked["k1"], 0.0).astype(np.float32),
                                k2=found(CONTEXT, asked["k2"], 1.0).astype(np.float32)))
    return pa.table([left.column("block"), left.column("shard"), pa.array(payloads, pa.binary())], names=["block", "shard", "answer"])


def _score(n_shards: int, order: int, across: bool, out: pa.Schema):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, n_words, words, codes = _block_tokens(left.column("payload"))
        events, sizes = word_events(words, order)
        grams, at = np.unique(events, return_inverse=True)
        keys, (before, word, pair) = _keys(words, grams, n_words, codes, across)
        values = [np.zeros(len(keys[0])), np.zeros(len(keys[1])), np.ones(len(keys[2]))]  # what the model does not hold
        answers = dict(zip(right.column("shard").to_pylist(), right.column("answer"), strict=True))
        for shard, places in _places(keys, n_shards).items():
            given = lists(answers[shard].as_buffer())
            for kind, p in places.items():
                values[kind][p] = given[f"k{kind}"]
        logs, alpha, gamma = values
        word_log = np.add.reduceat(logs[at], np.cumsum(sizes) - sizes) if len(words) else np.zeros(0)
        if across:
            with np.errstate(divide="ignore"):  # a pair never seen has no mass of its own
                token_log = np.logaddexp(np.log(alpha), np.log(gamma[before]) + word_log[word])[pair]
        else:
            token_log = word_log[codes]
        row = np.repeat(np.arange(len(n_words)), n_words)
        n_events = np.bincount(row, sizes[codes], len(n_words)).astype(np.int64)
        return pa.Table.from_arrays([*[docs.column(c).cast(out.field(c).type) for c in ("id", "lang", "text_key", "text_check")], pa.array(n_words),
                                     pa.array(n_events), pa.array(np.bincount(row, token_log, len(n_words)))], schema=out)
    return score


def text_key(lang: Column, text: Column) -> Column:
    return F.xxhash64(lang, F.coalesce(text, F.lit("")))


def text_check(lang: Column, text: Column) -> Column:
    """A second hash, so that no text vanishes with another by a collision of the first."""
    return F.xxhash64(F.lit(101), F.coalesce(text, F.lit("")), lang)


def perplexities(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 block_bytes: int = SCORED_BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, spend_model: bool = False) -> DataFrame:
    """id, lang, text_key, text_check, n_words, n_events, log_prob (natural) and perplexity of every row.

    With ``spend_model`` the model's word pairs are removed as soon as they are dealt; it serves no second call then.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    total = text_bytes(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                       text_key(F.col(lang_col), F.col(text_col)).alias("text_key"), text_check(F.col(lang_col), F.col(text_col)).alias("text_check"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_shards, n_blocks = parts_for(total, shard_bytes), parts_for(total, block_bytes)
    across = model.words is not None
    turns = min(TURNS, n_blocks)
    kinds = StructType([*rows.drop("text").schema.fields, StructField("n_words", LongType()), StructField("n_events", LongType()),
                        StructField("log_prob", DoubleType())])
    packed = "shard int, known binary"
    words = materialise(model.words.mapInArrow(releasing(_dealt(n_shards)), packed), "known-words", "none") if across else None
    if across and spend_model:
        discard(model.pairs)
    done = []
    for turn in range(turns):
        own = rows.where(F.pmod(F.xxhash64("text_key", "id", F.lit(37)), F.lit(turns)) == turn)
        blocks = pack_blocks(own, parts_for(n_blocks, turns))
        requests = materialise(blocks.groupBy("block").applyInArrow(
            releasing_group(_ask(n_shards, model.order, across)), "shard int, block int, grams binary, pairs binary"), "requests", "none")
        asked = requests.select("shard", "grams").groupBy("shard").applyInArrow(releasing_group(_asked), "shard int, gram long")
        known = gram_probabilities(asked, model).select(F.lit(GRAM).alias("kind"), F.col("gram").alias("key"), "p")
        grams = materialise(known.mapInArrow(releasing(_dealt(n_shards)), packed), "known-grams", "none")
        answers = materialise(requests.groupBy("shard").cogroup((grams.unionByName(words) if across else grams).groupBy("shard")).applyInArrow(
            releasing_pair(_answer), "block int, shard int, answer binary"), "answers", "none")
        discard(requests, grams)
        scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            releasing_pair(_score(n_shards, model.order, across, to_arrow_schema(kinds))), kinds)
        if turn < turns - 1:  # the last turn's scores are worked out by whoever reads them
            done.append(materialise(scored, "scores"))
            discard(answers)
        elif across:
            discard(words)
    scored = reduce(DataFrame.unionByName, [*done, scored])
    return scored.withColumn("perplexity", F.when(F.col("n_events") > 0, F.exp(-F.col("log_prob") / F.col("n_events"))))


def trusted_split(labels: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All trusted ids, dealt into those for the training and those left out for the thresholds."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    trusted = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.bool_and(good).alias("_good")).where("_good").select("id")
    dealt = trusted.withColumn("_h", F.xxhash64("id", F.lit(29)))
    left_out = F.pmod(F.col("_h"), F.lit(CALIBRATION_SHARE)) == 0
    return dealt.where(~left_out).select("id"), dealt.where(left_out).select("id")


def scored_with_threshold(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                          lang_col: str = "lang", order: int = ORDER, quantile: float = QUANTILE, margin: float = MARGIN,
                          **sizes) -> DataFrame:
    """``perplexities`` of all rows with ``threshold`` and ``kept``, written to the shared folder."""
    training, left_out = trusted_split(labels, id_col)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = broadcast_when(training, at_most(training, BROADCAST_KEYS))
    model = fit(texts.join(own, "id", "left_semi"), "text", order, across=True)
    scores = materialise(perplexities(docs, model, id_col=id_col, text_col=text_col, lang_col=lang_col, spend_model=True, **sizes),
                         "perplexities")
    known = scores.join(left_out, "id", "left_semi").where("perplexity IS NOT NULL")
    cut = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)) * margin
    everywhere = known.agg(cut).first()[0]
    per_lang = materialise(known.groupBy("lang").agg(cut.alias("threshold")), "thresholds")
    named = per_lang.where("lang IS NOT NULL")
    judged = scores.join(broadcast_when(named, at_most(named, 10_000)), "lang", "left")
    threshold = F.coalesce("threshold", F.lit(everywhere).cast("double"))
    return judged.withColumn("threshold", threshold).withColumn(
        "kept", F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def classified(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged.

    Rejected keys are written and counted; up to ``BROADCAST_KEYS`` are sent to all tasks, beyond
    that both sides are shuffled by key.
    """
    judged = scored_with_threshold(docs, labels, text_col=text_col, lang_col=lang_col, **options)
    rejected = materialise(judged.where(~F.col("kept")).select(F.col("text_key").alias("_key"), F.col("text_check").alias("_check")).distinct(), "rejected")
    small = broadcast_when(rejected, at_most(rejected, BROADCAST_KEYS))
    lang, text = F.col(lang_col), F.col(text_col)
    keyed = docs.withColumns({"_key": text_key(lang, text), "_check": text_check(lang, text)})
    return keyed.join(small, ["_key", "_check"], "left_anti").select(*docs.columns)
