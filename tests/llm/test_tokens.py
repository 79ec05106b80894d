"""Token counts and the word codec against the tokenizers library."""

import hashlib
import random

import numpy as np

from foliospark.llm.queries import op2, op10, vocabulary
from foliospark.llm.texts import ascii_lower, library_tokenizer, words_of
from foliospark.llm.token_counts import PairTable, RaggedBpe, byte_letters, token_counts
from foliospark.llm.blocks import pack_blocks
from foliospark.llm.word_codec import encode_decode, encode_decode_digests

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "aaa" * 100, "ab" * 3000, "  x  y\n\n z ", "<|endoftext|>hi<|endoftext|><|endoftext|>", "<|startoftext|>", "don't we'LL ",
       "日本語テキスト", "👍🏽 emoji", "\x85\x1c\xa0 a b", "é" * 999, "é ́x", "ΑΣ ΣΑΣ İ", "word " * 3000, "x" * 60_000, "same", "same"]


def frame(spark):
    return spark.createDataFrame([(i % 15, t, "x", i) for i, t in enumerate(ODD)], "doc_id long, text string, ids string, n_tokens long")


def test_counts_equal_the_library(spark):
    v = vocabulary("byte_bpe_50k.json")
    tokenizer = library_tokenizer(v)
    rows = token_counts(frame(spark), v).collect()
    expected = [(i % 15, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t in enumerate(ODD)]
    assert sorted(map(tuple, rows)) == sorted(expected)
    assert token_counts(frame(spark).limit(0), v).count() == 0


def test_random_strings_and_all_letters():
    v = vocabulary("byte_bpe_50k.json")
    tokenizer, bpe = library_tokenizer(v), RaggedBpe(v)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefgh THE'\n1.,é") for _ in range(rng.randrange(400))) for _ in range(500)]
    texts += [f"a{chr(c)} {chr(c)}1 {chr(c)}" for c in range(0, 0x3100)]
    assert bpe.count_texts(texts).tolist() == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(set(byte_letters())) == 256


def test_pair_table_answers_what_it_holds():
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, 300, 5000), rng.integers(0, 300, 5000)
    unique = np.unique(np.stack([left, right]), axis=1)
    table = PairTable(unique[0], unique[1], np.arange(unique.shape[1]))
    assert (table.rank(unique[0], unique[1]) == np.arange(unique.shape[1])).all()
    assert (table.rank(unique[0] + 1000, unique[1]) == 2**31 - 1).all()


def test_op2_limits(spark):
    rows = op2(spark, FOLDER).collect()
    assert len(rows) == 200 and all(r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_codec_round_trip_equals_the_library(spark):
    v = vocabulary("word_bpe_49k.json")
    tokenizer = library_tokenizer(v)
    for sizes in ({}, {"block_bytes": 4000, "shard_bytes": 9000}):
        rows = encode_decode(frame(spark), v, **sizes).collect()
        expected = []
        for i, t in enumerate(ODD):
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            expected.append((i % 15, ids, tokenizer.decode(ids, skip_special_tokens=False)))
        assert sorted((r.doc_id, r.ids, r.decoded) for r in rows) == sorted(expected)
    assert encode_decode(frame(spark).limit(0), v).count() == 0


def test_many_equal_rows_are_many_blocks(spark):
    """A third of all rows are one text; blocks stay of one size and every row keeps its result."""
    v = vocabulary("word_bpe_49k.json")
    texts = ["the same words again and again"] * 1500 + [f"other words {i} {i * i}" for i in range(3000)]
    rows = spark.createDataFrame([(7 if i < 1500 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    sizes = [n for (n,) in rows.mapInArrow(lambda b: b, "doc_id long, text string").transform(
        lambda d: pack_blocks(d, 15)).groupBy("block").applyInArrow(_count_rows, "n long").collect()]
    assert sum(sizes) == 4500 and len(sizes) == 15 and max(sizes) < 2 * sorted(sizes)[7]
    out = encode_decode_digests(rows, v, block_bytes=9000, shard_bytes=30_000).collect()
    assert len(out) == 4500 and sum(r.doc_id == 7 for r in out) == 1500 and len({tuple(r) for r in out}) <= 3001


def _count_rows(table):
    import pyarrow as pa

    from foliospark.llm.blocks import unpack_all

    return pa.table({"n": pa.array([sum(t.num_rows for t in unpack_all(table.column("payload")))], pa.int64())})


def test_op10_digests(spark):
    tokenizer = library_tokenizer(vocabulary("word_bpe_49k.json"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op10(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == digest(" ".join(map(str, ids)))
        assert r.decoded_sha256 == digest(tokenizer.decode(ids, skip_special_tokens=False))


def test_text_helpers():
    assert words_of(" a\tb\x0bc\x0c\r\nd\x1ce ") == ["a", "b", "c", "d\x1ce"] and words_of(None) == []
    assert ascii_lower("ABCÄİ") == "abcÄİ"
