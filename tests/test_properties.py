"""Random inputs against plain Python."""

import random
import re
import tracemalloc

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.functions.embedding import HashingEmbedder
from foliospark.operators import chunking

BLANK = "[" + re.escape(text.SPACE_CHARACTERS) + "]"


def cleaned(s):
    s = re.sub("\n{4,}", "\n\n\n", s.strip(text.SPACE_CHARACTERS))
    s = re.sub(" {3,}", "  ", s.replace("\n\n", " ")).replace("\t", "")
    return re.sub(f"\n+({BLANK}*\n)*", "\n", s)


def test_clean_up(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \n\n\n\t\r\x0b\xa0 abé.") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.c for r in df.select("id", text.clean_source_text(F.col("t")).alias("c")).collect()}
    assert got == {i: cleaned(t) for i, t in enumerate(texts)}


def test_missing_text_gives_no_chunks(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "id long, text string")
    for split in (chunking.split_tokens, chunking.split_sentences):
        assert split(df, "text", 4).count() == 0 and split(df, "text", 4, adjacent=False).count() == 0
    assert chunking.split_characters(df.where("id < 3"), "text", 4).count() == 0


def test_sentence_overlap(spark):
    df = spark.createDataFrame([(1, "a b. c. d e f. g. h i.")], "id long, text string")
    got = [r.chunk for r in chunking.split_sentences(df, "text", 4, 2).orderBy("chunk_no").collect()]
    assert got == ["a b. c.", "c. d e f.", "g. h i."]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nabc", max_size=30), min_size=1, max_size=5))
def test_embedder_is_additive_over_tokens(texts):
    embedder = HashingEmbedder()
    whole = embedder(texts)
    for row, body in zip(whole, texts):
        parts = [embedder([t])[0] for t in body.split()]
        assert list(row) == list(sum(parts)) if parts else not row.any()


def test_quadratic_inputs_stay_fast(spark):
    # Long runs that invite backtracking: blanks, digits, letters without a mail sign, open tags.
    bodies = [" " * 20000 + "x", "a" * 20000, "1 " * 10000, "\n " * 10000, "<script>" * 2000, "a. " * 7000]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, t string")
    from foliospark.functions import html

    out = df.select(text.clean_source_text(F.col("t")), text.redact(F.col("t")), html.readable_text(F.col("t")),
                    F.size(chunking.sentences(F.col("t")))).collect()
    assert len(out) == len(bodies)


def test_embedding_many_texts_takes_little_memory():
    texts = [" ".join(f"w{(i * j) % 997}" for j in range(256)) for i in range(4_000)]
    tracemalloc.start()
    vectors = HashingEmbedder()(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert vectors.shape == (4_000, 64) and (vectors[3_999] == HashingEmbedder()(texts[-1:])[0]).all()
    assert peak < 20 << 20  # 5 MB of texts, a million tokens
