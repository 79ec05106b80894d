"""The Pitman-Yor model: exact counts and base scores, normalised samples, held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm.pitman_yor import hpy_scores, seat
from foliospark.llm.queries_models import op1

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or "")) + [""]


def check_counts(rows, docs, held_out):
    train = Counter(w for (i, t) in docs if not held_out(i) for w in tokens(t))
    n, v = sum(train.values()), len(train)
    expected = sorted((str(i), held_out(i), len(tokens(t)), sum(train[w] > 0 for w in tokens(t)), n,
                       round(sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in docs)
    assert sorted((str(r[0]), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == expected


def test_op1_counts_base_and_gain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = op1(spark, FOLDER).collect()
    check_counts(rows, docs, lambda i: zlib.crc32(str(i).encode()) % 5 == 1)
    for part in (True, False):
        own = [r for r in rows if r.held_out == part]
        assert sum(r.score for r in own) > sum(r.base_score for r in own)
        assert sum(r.score > r.base_score for r in own) > 0.9 * len(own)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 40, "shard_bytes": 70}])
def test_odd_rows(spark, sizes):
    docs = [(1, "a b a b a c"), (2, None), (2, ""), (3, "A B z\tq"), (3, "A B z\tq"), (None, "a \x0b é É"), (4, "x" * 30_000)]
    frame = spark.createDataFrame([(i, t, "own", 1.0) for i, t in docs], "doc_id long, text string, held_out string, score double")
    rows = hpy_scores(frame, F.col("doc_id") == 3, **sizes).collect()
    check_counts(rows, docs, lambda i: i == 3)
    assert all(-1000 < r.score < 0 for r in rows)
    nothing = hpy_scores(frame, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in nothing)
    assert hpy_scores(frame.limit(0), F.lit(False)).count() == 0


def test_scores_do_not_depend_on_blocks_or_order(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} the w{i % 5} w{i}. end") for i in range(60)], "doc_id long, text string")
    a = hpy_scores(docs, F.col("doc_id") % 5 == 1).collect()
    b = hpy_scores(docs.repartition(4), F.col("doc_id") % 5 == 1, block_bytes=200).collect()
    assert sorted((r.id, round(r.score, 3)) for r in a) == sorted((r.id, round(r.score, 3)) for r in b)


class PlainProcess:
    """Restaurants of words before, classes and a root, seated customer by customer."""

    def __init__(self, texts, discounts, rng):
        self.texts, self.d, self.rng = [t for t in texts], discounts, rng
        self.known = len({w for t in texts for w in t})
        self.seats = defaultdict(lambda: defaultdict(list))  # restaurant -> dish -> sizes of its tables
        self.tokens = [(t[i - 1] if i else None, w) for t in texts for i, w in enumerate(t)]
        for before, word in self.tokens:
            self.add(0, before, word)

    def parent(self, level, place):
        return (ord(place[-1]) % 256 if place else 256) if level == 0 else "root"

    def p(self, level, place, word):
        if level == 3:
            return 0.5 / self.known if word is not None else 0.5
        room = self.seats[level, place]
        n, tables = sum(map(sum, room.values())), sum(map(len, room.values()))
        own, d = room.get(word, []), self.d[level]
        return (sum(own) - d * len(own) + (1 + d * tables) * self.p(level + 1, self.parent(level, place), word)) / (1 + n)

    def add(self, level, place, word):
        if level == 3:
            return
        room, d = self.seats[level, place], self.d[level]
        own, tables = room[word], sum(map(len, room.values()))
        new = (1 + d * tables) * self.p(level + 1, self.parent(level, place), word)
        at = self.rng.random() * (new + sum(own) - d * len(own))
        for i, size in enumerate(own):
            if at < size - d:
                own[i] += 1
                return
            at -= size - d
        own.append(1)
        self.add(level + 1, self.parent(level, place), word)

    def remove(self, level, place, word):
        if level == 3:
            return
        own = self.seats[level, place][word]
        at = self.rng.choices(range(len(own)), own)[0]
        own[at] -= 1
        if not own[at]:
            del own[at]
            self.remove(level + 1, self.parent(level, place), word)

    def sweep(self):
        for before, word in self.tokens:
            self.remove(0, before, word)
            self.add(0, before, word)


def discount(counts):
    ns = Counter(counts)
    return min(max(ns[1] / (ns[1] + 2 * ns[2]) if ns[1] else 0.5, 0.1), 0.95)


def test_scores_equal_a_plain_sequential_sampler(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}{c}" for i, c in enumerate("abcabcabcabcabcaab")]
    docs = []
    for i in range(120):
        words = [rng.choices(vocabulary, [1 / (k + 1) for k in range(18)])[0]]
        while len(words) < 12:
            words.append(vocabulary[(vocabulary.index(words[-1]) * 3 + 1) % 18] if rng.random() < 0.5 else rng.choices(vocabulary, [1 / (k + 1) for k in range(18)])[0])
        docs.append((i, " ".join(words)))
    docs += [(200, "w0a unknown w1b"), (201, "w3a w3a w3a"), (202, "")]
    held = lambda i: i % 5 == 1 or i >= 200
    train = [tokens(t) for i, t in docs if not held(i)]
    pairs = Counter((t[i - 1] if i else None, w) for t in train for i, w in enumerate(t))
    classes = Counter((ord(b[-1]) % 256 if b else 256, w) for b, w in pairs)
    plain = PlainProcess(train, [discount(pairs.values()), discount(classes.values()), discount(Counter(w for _, w in classes).values())], rng)
    known, probabilities, n_samples = {w for t in train for w in t}, defaultdict(float), 40
    wanted = {(t[i - 1] if i else None, w) for _, text in docs for t in [tokens(text)] for i, w in enumerate(t)}
    for sweep in range(10 + n_samples):
        plain.sweep()
        if sweep >= 10:
            for before, word in wanted:
                place = before if before is None or before in known else before
                probabilities[before, word] += plain.p(0, place, word if word in known else None) / n_samples
    rows = hpy_scores(spark.createDataFrame(docs, "doc_id long, text string"), F.expr("doc_id % 5 = 1 OR doc_id >= 200"),
                      block_bytes=3000, shard_bytes=2000).collect()
    errors = []
    for r in rows:
        own = tokens(dict(docs)[r.id])
        expected = sum(math.log10(probabilities[own[i - 1] if i else None, w]) for i, w in enumerate(own))
        errors.append(abs(r.score - expected) / len(own))
        assert math.isclose(r.perplexity, 10 ** (-r.score / len(own)), rel_tol=1e-9)
    assert sum(errors) / len(errors) < 0.02 and max(errors) < 0.1


def test_seating_follows_the_process():
    rng = np.random.default_rng(0)
    assert seat(np.array([0, 1]), np.array([1.0, 1.0]), np.array([0.5, 0.5]), 0.5, rng).tolist() == [0, 1]
    for n, others, parent, d in ((40, 0, 0.1, 0.5), (400, 0, 0.1, 0.5), (400, 20, 0.1, 0.5), (400, 0, 0.01, 0.5), (60, 5, 0.9, 0.8)):
        weight, t = 1 + d * others, np.arange(n + 1)
        chance = np.zeros(n + 1)
        chance[1] = 1
        for seated in range(1, n):  # exact distribution of the tables of one dish, its own tables weighing too
            new = (weight + d * t) * parent
            new = new / (new + np.maximum(seated - d * t, 1e-9))
            chance = chance * (1 - new) + np.concatenate([[0], (chance * new)[:-1]])
        drawn = seat(np.full(20_000, n), np.full(20_000, weight), np.full(20_000, parent), d, rng)
        mean = (chance * t).sum()
        assert abs(drawn.mean() - mean) < 0.03 * mean
    big = seat(np.full(2000, 100_000), np.full(2000, 1.5), np.full(2000, 0.05), 0.4, rng)  # past the exact seats
    tables = np.ones(2000)
    for seated in range(1, 100_000):
        new = (1.5 + 0.4 * tables) * 0.05
        tables += rng.random(2000) < new / (new + seated - 0.4 * tables)
    assert abs(big.mean() - tables.mean()) < 0.03 * tables.mean()


def test_the_word_before_is_the_context(spark):
    """Two words with the same last letter are followed by different words, and each expects its own."""
    train = [(i, " ".join(["cat sat", "bat flew"] * 20)) for i in range(20)]
    asked = [(100, "cat sat"), (101, "bat sat"), (102, "bat flew"), (103, "cat flew")]
    docs = spark.createDataFrame(train + asked, "doc_id long, text string")
    score = {r.id: r.score for r in hpy_scores(docs, F.col("doc_id") >= 100).collect() if r.held_out}
    assert score[100] > score[103] + 1 and score[102] > score[101] + 1


def test_scores_of_one_and_many_shards_agree(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} the w{i % 5} w{i % 11}. then w{i % 3} end") for i in range(400)], "doc_id long, text string")
    one, many = ({r.id: r.score / r.n_tokens for r in hpy_scores(docs, F.col("doc_id") % 5 == 1, **sizes).collect()}
                 for sizes in ({}, {"block_bytes": 2000, "shard_bytes": 1000}))
    assert max(abs(one[i] - many[i]) for i in one) < 0.05


def test_work_tables_and_shuffles_go_when_they_have_been_read(spark):
    import time
    from pathlib import Path

    from foliospark.session import SHUFFLE_CLEANUP, materialise, shared_root

    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {f.rsplit("/", 1)[1] for f in files.split() if "/shuffle_" in f}

    before = shuffles()
    table = materialise(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), "test-released", parts=("k",))
    for _ in range(50):  # files are removed in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and spark.conf.get(SHUFFLE_CLEANUP) == "false" and table.agg(F.sum("count")).first()[0] == 1000
    root = Path(shared_root(spark).removeprefix("file://"))
    held = lambda: {str(f.parent) for f in root.glob("hpy-*/**/*.parquet")}
    old = held()
    docs = spark.createDataFrame([(i, f"a b c{i % 5} d") for i in range(40)], "doc_id long, text string")
    found = hpy_scores(docs, F.col("doc_id") % 5 == 1, block_bytes=200, shard_bytes=100)
    assert found.count() == 40 and found.count() == 40
    assert {f.rsplit("/", 1)[1][:11] for f in held() - old} == {"hpy-answers"}


def test_a_block_and_a_shard_take_few_bytes_a_token():
    """Words are never Python objects one by one, and contexts of a shard are numbered before they are repeated by pair."""
    import tracemalloc

    import pyarrow as pa

    from foliospark.llm.blocks import pack
    from foliospark.llm.pitman_yor import _ask, _merge, block_tokens

    rng = random.Random(1)
    texts = [" ".join(f"Word{rng.randrange(9000)}" for _ in range(500)) for _ in range(400)]
    rows = pa.table({"id": pa.array(range(len(texts))), "held_out": [i % 5 == 1 for i in range(len(texts))], "text": texts})
    payload = pa.chunked_array([[pack(rows.slice(i, 100)) for i in range(0, len(texts), 100)]], pa.binary())

    def peak(task):
        tracemalloc.start()
        try:
            result = task()
            return result, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    (_, sizes, words, pairs, at), used = peak(lambda: block_tokens(payload))
    assert used < 70 * sizes.sum() and len(at) == sizes.sum() == 400 * 501 and words[0] == "" and len(pairs) > 150_000
    blocks = [_ask(1)(pa.table({"block": pa.array([b] * payload.length(), pa.int32()), "payload": payload})) for b in range(8)]
    asked = pa.concat_tables(blocks).drop_columns("block")
    merged, used = peak(lambda: _merge(1)(asked))
    assert used < 70 * 8 * len(pairs) and merged.num_rows == 2


def test_a_sweep_takes_a_shard_in_slices(spark, monkeypatch):
    """Slices cover all words and pairs once; the tables of a sweep are as many as without them, but for chance."""
    from foliospark.llm import pitman_yor

    own = np.array([3, 1, 9, 0, 2, 2], np.uint32)
    monkeypatch.setattr(pitman_yor, "SWEPT_PAIRS", 4)
    assert [(w.start, w.stop, p.start, p.stop) for w, p in pitman_yor._slices(own)] == [(0, 2, 0, 4), (2, 3, 4, 13), (3, 6, 13, 17)]
    docs = spark.createDataFrame([(i, f"w{i % 7} the w{i % 5} w{i % 11}. then w{i % 3} end") for i in range(400)], "doc_id long, text string")
    sliced = {r.id: r.score / r.n_tokens for r in hpy_scores(docs, F.col("doc_id") % 5 == 1).collect()}
    monkeypatch.undo()
    whole = {r.id: r.score / r.n_tokens for r in hpy_scores(docs, F.col("doc_id") % 5 == 1).collect()}
    assert max(abs(sliced[i] - whole[i]) for i in whole) < 0.05
