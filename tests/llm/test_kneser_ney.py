"""The Kneser-Ney model against a plain one, and its verdicts on labelled documents."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm.kneser_ney import (SYMBOLS, TURNS, classified, discounts, fit, gram_probabilities, perplexities, scored_with_threshold,
                                       trusted_split, word_events)
from foliospark.llm.queries_models import op9

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.01"


def events(word, order):
    data = b" " * (order - 1) + word.encode() + b" "
    return [data[i:i + order] for i in range(len(data) - order + 1)]


class PlainModel:
    def __init__(self, texts, order, continuations=False):
        words = Counter(w for t in texts for w in WORD.findall(t or ""))
        if continuations:  # as often as different words, or the start, stand before
            own = [["", *WORD.findall(t or "")] for t in texts]
            words = Counter(w for _, w in {p for o in own for p in zip(o, o[1:], strict=False)})
        tables = [Counter()]
        for w, n in words.items():
            for e in events(w, order):
                tables[0][e] += n
        for k in range(order - 1, 0, -1):
            tables.append(Counter(g for g in {(e[:1], e[1:]) for e in tables[-1]} for g in [g[1]]))
        self.tables = tables[::-1]
        self.discount, self.context = [], []
        for table in self.tables:
            ns = Counter(table.values())
            d = discounts(*[ns[i] for i in (1, 2, 3, 4)])
            context = defaultdict(lambda: [0, 0.0])
            for g, c in table.items():
                context[g[:-1]][0] += c
                context[g[:-1]][1] += d[min(c, 3) - 1]
            self.discount.append(d)
            self.context.append(context)

    def p(self, gram):
        p = 1 / SYMBOLS
        for k, (table, d, context) in enumerate(zip(self.tables, self.discount, self.context, strict=True), 1):
            g = gram[-k:]
            if g[:-1] in context:
                total, held = context[g[:-1]]
                c = table[g]
                p = (c - d[min(c, 3) - 1] if c else 0) / total + held / total * p
        return p


TEXTS = ["the cat sat on the mat", "the dog and the cat ate the hat. The end.", "a bat, a rat; an éclair", None, "", "the the the"] * 3 + ["on"]


def test_events_of_words():
    for order in (2, 5, 6):
        words = ["a", "été", "hello", "x" * 50]
        keys, sizes = word_events(words, order)
        assert keys.tolist() == [int.from_bytes(e, "big") for w in words for e in events(w, order)]
        assert sizes.tolist() == [len(w.encode()) + 1 for w in words]
    assert [len(x) for x in word_events([], 5)] == [0, 0]


@pytest.mark.parametrize("order", [2, 4])
def test_probabilities_equal_a_plain_model(spark, order):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    model, plain = fit(texts, "text", order), PlainModel(TEXTS, order)
    words = ["the", "cat", "zebra", "été", "q", "an", "THE"]
    grams = sorted({e for w in words for e in events(w, order)})
    asked = spark.createDataFrame([(int.from_bytes(g, "big"),) for g in grams], "gram long")
    found = {r.gram: r.p for r in gram_probabilities(asked, model).collect()}
    for g in grams:
        assert math.isclose(found[int.from_bytes(g, "big")], plain.p(g), rel_tol=1e-9)
    context = b"the"[:order - 1].rjust(order - 1)
    every = spark.createDataFrame([(int.from_bytes(context + bytes([b]), "big"),) for b in range(256)], "gram long")
    assert math.isclose(gram_probabilities(every, model).agg(F.sum("p")).first()[0], 1.0, rel_tol=1e-9)


def test_scores_equal_a_plain_model(spark):
    docs = spark.createDataFrame([(i % 9, t, "en" if i % 2 else None, "x") for i, t in enumerate([*TEXTS, "zebra été q", " \t", "q" * 500])],
                                 "doc_id long, text string, lang string, perplexity string")
    model, plain = fit(docs, "text", 3), PlainModel([*TEXTS, "zebra été q", " \t", "q" * 500], 3)
    for sizes in ({}, {"block_bytes": 60, "shard_bytes": 90}):
        rows = perplexities(docs, model, **sizes).collect()
        assert len(rows) == docs.count()
        texts = defaultdict(list)
        for r in rows:
            texts[r.id].append((r.n_words, r.n_events, r.log_prob, r.perplexity))
        expected = defaultdict(list)
        for r in docs.collect():
            own = [e for w in WORD.findall(r.text or "") for e in events(w, 3)]
            log = sum(math.log(plain.p(e)) for e in own)
            expected[r.doc_id].append((len(WORD.findall(r.text or "")), len(own), log, math.exp(-log / len(own)) if own else None))
        for i in expected:
            for a, b in zip(sorted(texts[i], key=str), sorted(expected[i], key=str), strict=True):
                assert a[:2] == b[:2] and np.allclose([x or 0 for x in a[2:]], [x or 0 for x in b[2:]], rtol=1e-5)


def test_discounts():
    assert discounts(0, 1, 1, 1) == (0.5, 1.0, 1.5)
    assert all(0 < d <= k for d, k in zip(discounts(100, 80, 70, 90), (1, 2, 3), strict=True))


def test_verdicts_on_labelled_documents(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = op9(spark, FOLDER).collect()
    assert len(rows) == 1000
    kept = lambda good: [r.kept for r in rows if r.doc_id in labels and bool(labels[r.doc_id].quality) == good]
    assert sum(kept(True)) >= 0.97 * len(kept(True)) and sum(kept(False)) <= 0.15 * len(kept(False))


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (1, "a b", "en"), (2, None, None), (None, "c", "xx"), (4, "z", None)],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = scored_with_threshold(docs, labels).collect()  # 1 is the only trusted id, and none is left out for a threshold
    assert sorted((r.id or 0, r.n_words, r.kept) for r in out) == [(0, 1, True), (1, 2, True), (1, 2, True), (2, 0, False), (4, 1, True)]
    both = labels.union(spark.createDataFrame([(1, 0, 0)], labels.schema)).union(spark.createDataFrame([(5, None, None)], labels.schema))
    assert [part.count() for part in trusted_split(labels)] == [1, 0] and [part.count() for part in trusted_split(both)] == [0, 0]
    none = scored_with_threshold(docs, labels.limit(0)).collect()
    assert [r.kept for r in none if r.n_words] == [True] * 4 and not any(r.kept for r in none if not r.n_words)
    assert scored_with_threshold(docs.limit(0), labels).count() == 0
    assert sorted(map(str, classified(docs, labels.limit(0)).collect())) == sorted(str(r) for r in docs.collect() if r.text)


def test_words_in_another_order_score_lower(spark):
    """A salad of known words and one word repeated have the words of clean text but not its order."""
    clean = ["the cat sat on the mat", "the dog ate the hat", "a rat ran to the cat"]
    train = spark.createDataFrame([(t,) for t in clean * 30], "text string")
    asked = ["the cat sat on the mat", "mat the on sat cat the", "cat cat cat cat cat cat", "the dog ate the zebra"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(asked)], "doc_id long, text string, lang string")
    model = fit(train, across=True)
    for sizes in ({}, {"block_bytes": 30, "shard_bytes": 30}):
        found = {r.id: r.perplexity for r in perplexities(docs, model, **sizes).collect()}
        assert found[1] > 1.5 * found[0] and found[2] > 1.5 * found[0] and found[3] > found[0]


def test_pair_probabilities_equal_a_plain_model(spark):
    model, plain = fit(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "text", 3, across=True), PlainModel(TEXTS, 3, continuations=True)
    pairs = Counter(p for t in TEXTS for own in [[None, *WORD.findall(t or "")]] for p in zip(own, own[1:], strict=False))
    ns = Counter(pairs.values())
    d = discounts(*[ns[i] for i in (1, 2, 3, 4)])

    def p(before, word):
        of_bytes = math.prod(plain.p(e) for e in events(word, 3))
        total = sum(c for (b, _), c in pairs.items() if b == before)
        if not total:
            return of_bytes
        held = sum(d[min(c, 3) - 1] for (b, _), c in pairs.items() if b == before)
        c = pairs[before, word]
        return (c - d[min(c, 3) - 1] if c else 0) / total + held / total * of_bytes

    asked = [*TEXTS[:6], "mat the on sat cat the", "zebra the zebra"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(asked)], "doc_id long, text string, lang string")
    for r in perplexities(docs, model, block_bytes=60, shard_bytes=90).collect():
        own = [None, *WORD.findall(asked[r.id] or "")]
        assert math.isclose(r.log_prob, sum(math.log(p(b, w)) for b, w in zip(own, own[1:], strict=False)), rel_tol=1e-5, abs_tol=1e-6)


def test_all_trusted_documents_train_or_calibrate(spark):
    labels = spark.range(70_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    training, left_out = (part.count() for part in trusted_split(labels))
    assert training + left_out == 70_000 and 13_000 < left_out < 15_000


def test_requests_and_their_shuffles_go_when_they_are_answered(spark):
    from pathlib import Path

    from foliospark.session import shared_root

    root = Path(shared_root(spark).removeprefix("file://"))
    held = lambda: {f.parent.name[:-33] for f in root.glob("*/*.parquet") if f.parent.name not in old}
    old = {f.parent.name for f in root.glob("*/*.parquet")}
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    scores = perplexities(docs, fit(docs, across=True), block_bytes=60, shard_bytes=90)
    assert "answers" in held() and not held() & {"requests", "known-grams"}
    assert scores.count() == len(TEXTS)


def test_documents_are_scored_in_turns_and_no_model_passes_the_driver(spark, monkeypatch):
    from pathlib import Path

    from pyspark import SparkContext
    from pyspark.sql.classic.dataframe import DataFrame

    from foliospark.session import shared_root

    def refused(*_):
        raise AssertionError("through the driver")

    monkeypatch.setattr(SparkContext, "broadcast", refused)
    monkeypatch.setattr(DataFrame, "toArrow", refused)
    root = Path(shared_root(spark).removeprefix("file://"))
    old = {f.parent.name for f in root.glob("*/*.parquet")}
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS * 3)], "doc_id long, text string, lang string")
    model = fit(docs, across=True)
    scores = perplexities(docs, model, block_bytes=60, shard_bytes=90, spend_model=True)
    held = [f.parent.name[:-33] for f in root.glob("*/*.parquet") if f.parent.name not in old]
    assert not {"requests", "known-grams", "known-words", "pair-counts"} & set(held)
    folders = {f.parent.name for f in root.glob("*/*.parquet")} - old
    assert [sum(f.startswith(kind) for f in folders) for kind in ("scores-", "answers-")] == [TURNS - 1, 1]  # of the last turn only
    found = {r.id: r.log_prob for r in scores.collect()}
    whole = {r.id: r.log_prob for r in perplexities(docs, fit(docs, across=True)).collect()}  # one turn
    assert len(found) == len(TEXTS) * 3 and all(math.isclose(found[i], whole[i], rel_tol=1e-9) for i in whole)
