import random

from pyspark.sql import functions as F

from foliospark.functions.packing import greedy_runs
from foliospark.operators import chunking, sequences
from foliospark.operators.containment import anchored_passages, passage_hits, passages_in_texts


def words(n, rng):
    return " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(n))


def test_token_windows_restore_the_tokens(spark):
    rng = random.Random(1)
    texts = [(i, words(n, rng) if n else "  \n") for i, n in enumerate([0, 1, 4, 5, 6, 10, 11, 53])]
    df = spark.createDataFrame(texts, "id long, text string")
    rows = chunking.split_tokens(df, "text", 5).orderBy("id", "chunk_no").collect()
    for i, text in texts:
        mine = [r for r in rows if r.id == i]
        assert " ".join(r.chunk for r in mine).split() == text.split()
        assert all(r.prev == (mine[k - 1].chunk if k else None) for k, r in enumerate(mine))
        assert all(r.next == (mine[k + 1].chunk if k + 1 < len(mine) else None) for k, r in enumerate(mine))


def test_token_windows_with_overlap(spark):
    df = spark.createDataFrame([(1, "a b c d e f g")], "id long, text string")
    got = [r.chunk for r in chunking.split_tokens(df, "text", 4, 2).orderBy("chunk_no").collect()]
    assert got == ["a b c d", "c d e f", "e f g"]


def runs_by_hand(sizes, limit, overlap):
    out, start = [], 0
    used = 0
    for at, size in enumerate(sizes):
        if at != start and used + size > limit:
            out.append((start, at))
            start = next(s for s in range(start + 1, at + 1)
                         if s == at or (sum(sizes[s:at]) <= overlap and sum(sizes[s:at]) + size <= limit))
            used = sum(sizes[start:at])
        used += size
    return out + [(start, len(sizes))] if sizes else []


def test_greedy_runs(spark):
    rng = random.Random(2)
    cases = [(i, [rng.randint(1, 9) for _ in range(rng.randint(0, 25))]) for i in range(60)] + [(99, [50, 1, 50])]
    df = spark.createDataFrame(cases, "id long, sizes array<int>")
    for overlap in (0, 4):
        got = {r.id: [tuple(x) for x in r.runs] for r in df.select("id", greedy_runs(F.col("sizes"), 12, overlap).alias("runs")).collect()}
        assert got == {i: runs_by_hand(sizes, 12, overlap) for i, sizes in cases}


def test_sentences_stay_whole_unless_too_long(spark):
    df = spark.createDataFrame([(1, "One two. Three four five! Six?\nseven " + "x " * 12 + ". End")], "id long, text string")
    got = [r.chunk for r in chunking.split_sentences(df, "text", 6).orderBy("chunk_no").collect()]
    assert got == ["One two. Three four five! Six?", "seven x x x x x", "x x x x x x", "x . End"]


def test_character_chunks_are_lossless_and_within_budget(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice(["a", "bcd", " ", "\n", "\n\n", "efghijklmnop"]) for _ in range(rng.randint(0, 120)))) for i in range(30)]
    df = spark.createDataFrame(texts, "id long, text string")
    rows = chunking.split_characters(df, "text", 10).orderBy("id", "chunk_no").collect()
    for i, text in texts:
        chunks = [r.chunk for r in rows if r.id == i]
        assert "".join(chunks) == text
        assert all(0 < len(c) <= 10 for c in chunks)


def test_packing_keeps_token_order(spark):
    rng = random.Random(4)
    docs = [(i, [rng.randint(0, 99) for _ in range(rng.choice([0, 1, 3, 17]))]) for i in range(23)]
    sparse = [(i * 1000, ids, len(ids) * 3) for i, ids in docs]  # gaps between keys lose nothing
    df = spark.createDataFrame(sparse, "id long, ids array<bigint>, n_chars long")
    for segment in (5, 1000):
        rows = sequences.pack_constant_length(df, "id", "ids", "n_chars", 8, buffer_chars=60, eos=-1, rows_per_segment=segment).collect()
        buffers, read = {}, 0
        for _, ids, n in sparse:
            buffers.setdefault(read // 60, []).extend([*ids, -1])
            read += n
        expected = {(b, k): stream[k * 8:k * 8 + 8] for b, stream in buffers.items() for k in range(len(stream) // 8)}
        assert {(r.buffer_no, r.seq_no): r.input_ids for r in rows} == expected
    (whole,) = sequences.pack_constant_length(df, "id", "ids", "n_chars", 8).groupBy("buffer_no").count().collect()
    assert whole["count"] == sum(len(ids) + 1 for _, ids in docs) // 8


def test_infilling_is_a_permutation(spark):
    docs = [(i, list(range(100, 100 + n))) for i, n in enumerate([0, 1, 2, 5, 40, 41, 42, 43, 44])]
    df = spark.createDataFrame(docs, "id long, ids array<bigint>")
    marks = {"prefix": 1, "middle": 2, "suffix": 3}
    for rate in (0.0, 1.0):
        got = {r.id: r.ids for r in sequences.fill_in_middle(df, "id", "ids", rate=rate, **marks).collect()}
        for i, ids in docs:
            assert sorted(t for t in got[i] if t > 3) == ids
            assert len(got[i]) == len(ids) + (3 if rate else 0)
    kept = {r.id: r.ids for r in sequences.fill_in_middle(df, "id", "ids", rate=1.0, truncate=True, **marks).collect()}
    assert all(len(kept[i]) == len(ids) for i, ids in docs)
    assert sequences.fill_in_middle(df, "id", "ids", prefix=None, middle=2, suffix=3) is df


def test_sample_packing_loses_nothing(spark):
    rng = random.Random(5)
    docs = [(i, [rng.randint(1, 99) for _ in range(rng.choice([0, 1, 3, 9, 25]))]) for i in range(40)]
    df = spark.createDataFrame([(i * 977, ids) for i, ids in docs], "id long, ids array<bigint>")
    rows = sequences.pack_samples(df, "id", "ids", 8, samples_per_shard=16).orderBy("shard", "bin_no").collect()
    assert all(len(r.input_ids) == 8 for r in rows)
    for shard in range(3):
        stream = [t for r in rows if r.shard == shard for t in r.input_ids[:8 - r.n_pad]]
        assert stream == [t for i, ids in docs if i // 16 == shard for t in ids]


def test_instruction_rows_mask_the_prompt(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi there"), (1, 1, "assistant", "hello you"), (1, 2, "user", "lost")],
                               "conv_id long, turn long, role string, text string")
    (row,) = sequences.instruction_rows(df).collect()
    assert row.labels[-2:] == row.input_ids[-2:] and set(row.labels[:-2]) == {-100}
    assert len(row.labels) == len(row.input_ids)


def test_passages_in_texts(spark):
    rng = random.Random(6)
    texts = [(i, words(rng.randint(1, 60), rng)) for i in range(40)]
    passages = [(i, t[rng.randint(0, len(t) // 2):][:rng.randint(1, 80)]) for i, (_, t) in enumerate(texts)]
    passages += [(100, "a"), (101, "zz"), (102, " a"), (103, "a b"), (104, passages[3][1]), (105, passages[3][1])]
    got = passages_in_texts(spark.createDataFrame(passages, "p long, s string"), spark.createDataFrame(texts, "t long, x string"),
                            "p", "s", "t", "x").collect()
    assert sorted(map(tuple, got)) == sorted((p, t) for p, s in passages for t, x in texts if s in x)


def test_short_and_odd_passages_in_rounds(spark):
    texts = [(i, f"a{i % 3} b{i} c") for i in range(12)] + [(20, None), (21, ""), (22, "é" * 70 + "日本" * 40), (23, "x" * 1_200_000 + "needle in the stack")]
    passages = [(i, t) for i, t in enumerate(["a1", "b1", "1 b", "c", "", "zz", "a1 b", "b11 c", None, "é日", "é" * 65, "é" * 71, "本日本日",
                                              "x" * 40 + "needle", "needle in the stack", "x" * 1_200_000, "k"])]
    frames = spark.createDataFrame(passages, "p long, s string"), spark.createDataFrame(texts, "t long, x string")
    for size in ({}, {"round_passages": 4}):
        got = passages_in_texts(*frames, "p", "s", "t", "x", **size).collect()
        assert sorted(map(tuple, got)) == sorted((p, t) for p, s in passages for t, x in texts if s is not None and x is not None and s in x)


def test_passages_that_share_their_words(spark):
    """All passages and texts share most of their words; no false candidate leaves the scan."""
    rng = random.Random(9)
    opening, ending = "all of them begin with the same long sentence ", " and end in the very same way as well"
    passages = [(i, opening + words(6, rng) + f" mark{i} " + words(6, rng) + ending) for i in range(300)]
    texts = [(i, " ".join(passages[rng.randrange(200)][1] for _ in range(3)) + opening * 3 + ending) for i in range(200)]
    p, t = spark.createDataFrame(passages, "p long, passage string"), spark.createDataFrame(texts, "id long, text string")
    anchored = anchored_passages(p.select("passage"), t)
    rarest = {r.passage: r.n_texts for r in anchored.collect()}
    want = sorted((i, j) for i, s in passages for j, x in texts if s in x)
    assert passage_hits(anchored, t).count() == len(want)
    assert sum(rarest.values()) <= 2 * len(want)  # anchors stand in few texts although the openings stand in all
    assert sorted(map(tuple, passages_in_texts(p, t, "p", "passage", "id", "text").collect())) == want


def test_no_passages(spark):
    texts = spark.createDataFrame([(1, "a")], "t long, x string")
    none = spark.createDataFrame([], "p long, s string")
    assert passages_in_texts(none, texts, "p", "s", "t", "x").collect() == []
