"""BPE encoding and decoding through a table of distinct words.

Texts are split at the six ASCII blanks, where the tokenizer splits in any case, and numbered by distinct
word inside Arrow. Blocks of documents send their distinct words to shards; a shard encodes each of its
words once, however many documents and blocks hold it. The answers return to the blocks, where words are
replaced by position, and the pieces of each distinct word are looked up in the id-to-piece table of the
vocabulary (bounded by the vocabulary's size).

Null and empty texts have no ids and decode to the empty string. Repeated rows each get their row, and are
dealt to the blocks in turn. Extra columns are dropped. An empty table gives an empty result. A word of any
length is one word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .blocks import BLOCK_BYTES, by_shard, pack, pack_blocks, parts_for, shard_of, text_bytes, unpack, unpack_all
from .texts import library_tokenizer, releasing_pair

WORD_BLOCK_BYTES = BLOCK_BYTES // 2  # a block also holds its ids and its decoded text
SHARD_BYTES = 32 << 20  # text per shard of the word table; its distinct words are a fraction of that
ENCODE_SLICE = 20_000
WORDS = StructType([StructField("shard", IntegerType()), StructField("block", IntegerType()), StructField("words", BinaryType())])
CODES = StructType([StructField("block", IntegerType()), StructField("shard", IntegerType()), StructField("codes", BinaryType())])


def check_word_vocabulary(vocabulary: str) -> None:
    """Words between blanks can be encoded alone only where the tokenizer drops blanks."""
    alone, together = ((library_tokenizer(vocabulary).encode(t, add_special_tokens=False).ids) for t in ("a", " a\n\t a "))
    if together != alone * 2:
        raise ValueError("this vocabulary does not split and drop at blanks")


def encode_words(vocabulary: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words end to end, and how many each has."""
    tokenizer = library_tokenizer(vocabulary)
    ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
    for at in range(0, len(words), ENCODE_SLICE):
        found = [e.ids for e in tokenizer.encode_batch_fast(words[at:at + ENCODE_SLICE], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, found), np.int32, len(found)))
        ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
    return np.concatenate(ids), np.concatenate(sizes)


def piece_table(vocabulary: str) -> pa.Array:
    """Piece of every id, added tokens included."""
    tokenizer = library_tokenizer(vocabulary)
    return pa.array([tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))], pa.large_string())


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])), values)


def split_words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Words between the six ASCII blanks: the text each belongs to, and the words end to end. A null text has none."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # blanks at either end leave an empty word
    return pc.list_parent_indices(lists).to_numpy()[real.to_numpy(zero_copy_only=False)], words.filter(real)


class BlockWords:
    """Texts of a block as numbers of its distinct words, which stand in sorted order."""

    def __init__(self, payloads: pa.ChunkedArray):
        self.rows = pa.concat_tables(unpack_all(payloads)).combine_chunks()
        owner, words = split_words(self.rows.column("text"))
        self.owner = owner.astype(np.int32)
        coded = words.dictionary_encode()
        del owner, words
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.words = coded.dictionary.take(pa.array(order)).to_pylist()
        self.codes = rank[coded.indices.to_numpy()]

    def by_shard(self, n_shards: int) -> list[tuple[int, np.ndarray]]:
        """Numbers of the words of every shard that has any."""
        return by_shard(shard_of(self.words, n_shards))


def _distinct_words(n_shards: int):
    def distinct(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        known = BlockWords(table.column("payload"))
        out = [(shard, block, pack(pa.table({"word": pa.array([known.words[i] for i in at.tolist()], pa.string())})))
               for shard, at in known.by_shard(n_shards)]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))],
                        names=["shard", "block", "words"])
    return distinct


def _word_table(vocabulary: str):
    def encode(table: pa.Table) -> pa.Table:
        asked = [rows.column("word").to_pylist() for rows in unpack_all(table.column("words"))]
        distinct = sorted(set().union(*asked))
        ids, sizes = encode_words(vocabulary, distinct)
        ends = np.cumsum(sizes, dtype=np.int64)
        row = {word: i for i, word in enumerate(distinct)}
        payloads = []
        for words in asked:
            at = np.fromiter(map(row.__getitem__, words), np.int64, len(words))
            own = ids[ragged(ends[at] - sizes[at], sizes[at])]
            payloads.append(pack(pa.table({"ids": pa.ListArray.from_arrays(offsets(sizes[at]), pa.array(own, pa.uint32()))})))
        return pa.table([table.column("block"), table.column("shard"), pa.array(payloads, pa.binary())],
                        names=["block", "shard", "codes"])
    return encode


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every range, end to end."""
    total = int(sizes.sum())
    before = np.cumsum(sizes, dtype=np.int64) - sizes
    return np.arange(total, dtype=np.int64) - np.repeat(before - starts, sizes)


def offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32))


def _joined(sizes: np.ndarray, texts: pa.Array, at: np.ndarray) -> pa.Array:
    """Texts with the given numbers, joined by blanks per document."""
    return pc.binary_join(_lists(sizes, texts.take(pa.array(at))), pa.scalar(" ", texts.type))


class Coded:
    """A block with the ids of its words: documents as rows of the word table."""

    def __init__(self, known: BlockWords, answers: dict[int, pa.Scalar], n_shards: int, id_type: pa.DataType):
        ids, sizes, row = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(known.words), np.int64)
        n = 0
        for shard, at in known.by_shard(n_shards):
            lists = unpack(answers[shard].as_buffer()).column("ids").combine_chunks()
            row[at] = n + np.arange(len(at))
            n += len(at)
            ids.append(lists.flatten().to_numpy())
            sizes.append(np.diff(lists.offsets.to_numpy()))
        self.ids, self.sizes = np.concatenate(ids).astype(np.int32), np.concatenate(sizes).astype(np.int64)
        self.keys = known.rows.column(0).combine_chunks().cast(id_type)
        at = row[known.codes]
        some = self.sizes[at] > 0  # words the tokenizer drops leave no blank
        self.at, owner = at[some], known.owner[some]
        self.n_words = np.bincount(owner, minlength=len(self.keys))
        self.n_ids = np.bincount(owner, weights=self.sizes[self.at], minlength=len(self.keys)).astype(np.int64)

    def texts(self, per_id: pa.Array) -> pa.Array:
        """Texts of all ids of each document joined by blanks, given the text of each id of the word table."""
        return _joined(self.n_words, _joined(self.sizes, per_id, np.arange(len(self.ids))), self.at)


def _join_by_position(vocabulary: str, id_type: pa.DataType, n_shards: int, finish: Callable[[Coded, pa.Array], pa.Table]):
    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = dict(zip(right.column("shard").to_pylist(), right.column("codes"), strict=True))
        block = Coded(BlockWords(left.column("payload")), answers, n_shards, id_type)
        return finish(block, block.texts(piece_table(vocabulary).take(pa.array(block.ids))))  # the id-to-piece join
    return join


def _texts(block: Coded, decoded: pa.Array) -> pa.Table:
    flat = block.ids[ragged((np.cumsum(block.sizes) - block.sizes)[block.at], block.sizes[block.at])]
    return pa.table([block.keys, pa.ListArray.from_arrays(offsets(block.n_ids), pa.array(flat)), decoded.cast(pa.string())],
                    names=["id", "ids", "decoded"])


def _digests(block: Coded, decoded: pa.Array) -> pa.Table:
    decimals = block.texts(pa.array(block.ids).cast(pa.large_string()))
    hashed = [pa.array([hashlib.sha256(t.as_buffer() or b"").hexdigest() for t in texts], pa.string()) for texts in (decimals, decoded)]
    return pa.table([block.keys, pa.array(block.n_ids), *hashed], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _coded(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, block_bytes: int, shard_bytes: int, finish: Callable,
           fields: list[StructField]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    check_word_vocabulary(vocabulary)
    total = text_bytes(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType
    blocks = pack_blocks(rows, parts_for(total, block_bytes))
    n_shards = parts_for(total, shard_bytes)
    asked = blocks.groupBy("block").applyInArrow(_distinct_words(n_shards), WORDS)
    answers = asked.groupBy("shard").applyInArrow(_word_table(vocabulary), CODES)
    join = _join_by_position(vocabulary, to_arrow_type(kind), n_shards, finish)
    found = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        releasing_pair(join), StructType([StructField("id", kind), *fields]))
    return found.withColumnRenamed("id", id_col)


def encode_decode(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = WORD_BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id_col``, ``ids`` and ``decoded`` text of every row; ``vocabulary`` is the file's content."""
    return _coded(docs, vocabulary, id_col, text_col, block_bytes, shard_bytes, _texts,
                  [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])


def encode_decode_digests(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
                          block_bytes: int = WORD_BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The same with ``n_tokens`` and the SHA-256 of the blank-joined decimal ids and of the decoded text instead of both."""
    return _coded(docs, vocabulary, id_col, text_col, block_bytes, shard_bytes, _digests,
                  [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
