"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from foliospark.llm.queries_spelling import op13
from foliospark.llm.spelling import BLOCK_BYTES, LONG, Letters, layouts, mixed, spelled, spelling_variants

FOLDER = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(docs, slips=True):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if slips and h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(words):
    """All pairs that agree in their first or second half (one edit leaves one of them) are compared."""
    halves, neighbours = defaultdict(set), defaultdict(set)
    for w in words:
        for size in {len(w) // 2, (len(w) - 1) // 2, (len(w) + 1) // 2}:
            halves["first", w[:size]].add(w)
            halves["last", w[len(w) - size:]].add(w)
    for group in halves.values():
        for a in group:
            neighbours[a].update(b for b in group if near(a, b))
    form = {}
    for w, n in words.items():
        best = min(neighbours[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(neighbours[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def rows_of(frame):
    rows = list(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()))
    assert len(rows) == len(set(rows))
    return set(rows)


def made_docs():
    rng = random.Random(5)
    stems = ["straße", "elephant", "naïveté", "running", "aaaaaa", "aaaaaaa", "zzzzzzz", "àéîõü÷×", "Ünderscore", "b" * 70, "b" * 71, "c" * 5000, "c" * 5001]
    words = []
    for stem in stems:
        for k in range(12):
            word = stem
            for _ in range(k % 4):
                i = rng.randrange(len(word))
                word = rng.choice([word[:i] + rng.choice("aeÿzÀ") + word[i + 1:], word[:i] + word[i + 1:], word[:i] + rng.choice("bß") + word[i:]])
            words += [word] * rng.choice([4, 5, 6, 30, 200, 1000])
    rng.shuffle(words)
    docs = [(i, rng.choice([" ", "-", "Ø ", "Š"]).join(words[i * 40:i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    return docs + [(1, None), (2, ""), (None, "elephant elephant's ELEPHANT"), (3, "short words only"), (4, "elephant " * 300), (4, "elephant " * 300)]


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int")


def test_odd_words_equal_brute_force(spark):
    docs = made_docs()
    expected = plain_variants(plain_words(docs))
    assert any(r[1] and r[2] != r[1] for r in expected)  # chains of forms
    assert rows_of(spelling_variants(frame(spark, docs), slip_rate=199)) == expected
    assert rows_of(spelling_variants(frame(spark, docs), slip_rate=199, round_bytes=2 * BLOCK_BYTES)) == expected  # many rounds, lengths in parts
    assert rows_of(spelling_variants(frame(spark, docs))) == plain_variants(plain_words(docs, slips=False))
    assert spelling_variants(frame(spark, docs).limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = list(map(tuple, spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()))
    assert rows_of(op13(spark, FOLDER)) == plain_variants(plain_words(docs))


def test_slips_stand_where_the_hash_says(spark):
    docs = [(i, f"Overall wording{chr(97 + i % 26)} Étendue") for i in range(2000)]
    found = Counter(r.word for r in spelled(frame(spark, docs)).collect())
    plain = Counter()
    for i, text in docs:
        for run in RUN.findall(text):
            word = run.replace("O", "o")
            h = zlib.crc32(f"{i}:{word}".encode())
            plain[word if h % 199 else word[:h % len(word)] + word[h % len(word) + 1:]] += 1
    assert found == plain


def test_rounds_hold_every_word_once():
    rng = np.random.default_rng(0)
    counts = {6: 900, 7: 5, 8: 4000, LONG: 17}
    rounds = layouts(counts, 64 * BLOCK_BYTES)
    assert len(rounds) > 2 and all(r.total <= 64 for r in rounds)
    for shard, n in counts.items():
        hashes = mixed(rng.integers(0, 2**63, n, dtype=np.uint64))
        places = [r.places(np.full(n, shard), hashes) for r in rounds]
        assert (sum(here.astype(int) for _, here in places) == 1).all()
        assert all((block[here] >= 0).all() and (block[here] < r.total).all() for r, (block, here) in zip(rounds, places))
    assert len(set(Letters.of(["ab", "ba", "aab", "b"]).hashes().tolist())) == 4
