"""URL verdicts and packing against plain versions."""

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from foliospark.llm.packing import Plan, bin_patterns, nnls, pack_documents
from foliospark.llm.queries import URL_RULES, op4, vocabulary
from foliospark.llm.texts import library_tokenizer
from foliospark.llm.url_filter import fit_url_model, judge_urls, labelled_by_rules, url_parts

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "https://www.example.com/en/x?y#z", "http://example.com/en/?q=/fr/",
       "http://a.b.example.com/en/1", "http://notexample.com/en/", "ftp://x.net/es/#a?b", "http://x.net?/fr/", "x://net/fr/", "a://b://c/d",
       "http://ÄÖ.org/ü", "http://h/" + "p" * 30_000, "http://com/"]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.rule), default=None)


def test_parts_and_rules(spark):
    urls = spark.createDataFrame([(i, u, "old") for i, u in enumerate(ODD)], "page_id long, url string, verdict string")
    for row in judge_urls(urls, URL_RULES, "allow").collect():
        assert (row.host, row.path) == plain_parts(row.url)
        rule = plain_rule(row.host, row.path)
        assert (row.rule, row.verdict) == ((rule.rule, rule.verdict) if rule else (None, "allow"))


def test_model_learns_the_labels(spark):
    good = [f"https://news{i}.org/article/{i}" for i in range(60)]
    bad = [f"http://casino{i}.biz/win/{i}" for i in range(60)]
    known = spark.createDataFrame([(u, "allow") for u in good[:40]] + [(u, "block") for u in bad[:40]], "url string, verdict string")
    model = fit_url_model(known)
    fresh = spark.createDataFrame([(u,) for u in good[40:] + bad[40:]] + [(None,)], "url string")
    verdicts = {r.url: r.verdict for r in judge_urls(fresh, [], model).collect()}
    assert sum(verdicts[u] == "allow" for u in good[40:]) >= 19 and sum(verdicts[u] == "block" for u in bad[40:]) >= 19
    assert judge_urls(fresh.limit(0), URL_RULES, model).count() == 0
    assert fit_url_model(known.where("verdict = 'block'")) == "block" and fit_url_model(known.limit(0)) == "allow"


def test_op4_covers_all_pages(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()}
    rows = op4(spark, FOLDER).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        rule = plain_rule(*plain_parts(pages[r.page_id]))
        assert r.rule == (rule.rule if rule else None) and r.verdict in ("allow", "block")
        assert rule is None or r.verdict == rule.verdict


def test_nnls_on_known_systems():
    rng = np.random.default_rng(3)
    a = rng.random((8, 30))
    b = a @ np.where(rng.random(30) < 0.2, rng.random(30), 0)
    x = nnls(a, b)
    assert (x >= 0).all() and np.abs(a @ x - b).max() < 1e-6
    assert nnls(a, -np.ones(8)).max() == 0


def check_plan(histogram, max_len):
    plan = Plan(histogram, max_len)
    used = defaultdict(int)
    for parts, count in plan.groups:
        assert count > 0 and sum(parts) <= max_len
        for p in parts:
            used[p] += count
    assert dict(used) == {k: n for k, n in histogram.items() if n}
    return plan


def test_plans_hold_every_piece_and_waste_little():
    rng = np.random.default_rng(5)
    assert all(len(p) in (2, 3) for p in bin_patterns(64))
    for max_len in (2048, 100, 7, 1):
        for rows in (0, 1, 5, 4000, 10**7):
            lengths = np.arange(1, max_len + 1)
            share = 1 / (lengths + max_len / 8)
            histogram = dict(zip(lengths.tolist(), rng.multinomial(rows, share / share.sum()).tolist(), strict=True))
            plan = check_plan(histogram, max_len)
            if rows >= 4000 and max_len > 1:
                assert plan.n_sequences <= 1.01 * sum(k * n for k, n in histogram.items()) / max_len + 1


def test_documents_are_packed_whole(spark):
    v = vocabulary("word_bpe_49k.json")
    tokenizer = library_tokenizer(v)
    texts = [None, "", " \n", "Hello WORLD don't <|endoftext|> <|ENDOFTEXT|>", "word " * 900, "É" * 50, "ΑΣ ΣΑΣ\u00a0x\x1cy\x85z"] + ["same text here"] * 40
    docs = spark.createDataFrame([(i % 30, t, i) for i, t in enumerate(texts)], "doc_id long, text string, length long")
    rows = pack_documents(docs, v, 64).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    expected = []
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for a in range(0, len(ids), 64):
            part = np.array(ids[a:a + 64], "<u4")
            expected.append((i % 30, a // 64, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted(expected) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert pack_documents(docs.limit(0), v, 64).count() == 0


def test_parts_of_odd_urls(spark):
    host, path = url_parts(F.col("url"))
    rows = spark.createDataFrame([(u,) for u in ODD], "url string").select("url", host.alias("h"), path.alias("p")).collect()
    assert all((r.h, r.p) == plain_parts(r.url) for r in rows)
    assert labelled_by_rules(spark.createDataFrame([(u,) for u in ODD], "url string"), URL_RULES).count() == sum(
        plain_rule(*plain_parts(u)) is not None for u in ODD)


def test_equal_pieces_are_numbered_by_many_tasks(spark, monkeypatch):
    """A third of all rows are one row: pieces of one length get every rank once, from windows of about equal size."""
    from foliospark.llm import packing

    monkeypatch.setattr(packing, "BUCKET_ROWS", 100)
    docs = spark.createDataFrame([(7, "a b c") if i % 3 == 0 else (i, "a b " * (i % 5)) for i in range(3000)], "doc_id long, text string")
    cut = packing.token_pieces(docs, vocabulary("word_bpe_49k.json"), 16, 0)
    pieces = packing.materialise(cut.withColumn("_deal", F.xxhash64(*cut.columns, F.monotonically_increasing_id())), "test-pieces")
    sizes = sorted(r["count"] for r in pieces.groupBy(F.pmod("_deal", F.lit(30))).count().collect())
    assert sizes[-1] < 2 * sizes[15]
    for length, ranks in packing.numbered_by_length(pieces, 3000).groupBy("length").agg(F.collect_list("rank")).collect():
        assert sorted(ranks) == list(range(len(ranks)))
    packed = packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), 16).collect()
    assert len(packed) == 3000 and len({(r.sequence_id, r.offset) for r in packed}) == 3000


def test_words_are_encoded_once_for_all_tasks_capitals_and_marks(monkeypatch):
    from foliospark.llm import packing

    v, encoded = vocabulary("word_bpe_49k.json"), []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode(self, text, **kw):
            encoded.extend(text.split(" "))
            return self.tokenizer.encode(text, **kw)

        def encode_batch_fast(self, words, **kw):
            encoded.extend(words)
            return self.tokenizer.encode_batch_fast(words, **kw)

    monkeypatch.setattr(packing, "library_tokenizer", lambda v: Counted(library_tokenizer(v)))
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    codec = packing.WordIds(v)
    odd = ["a. a.. a., 'a.' it's. it's, x.. .y a.b a .b! <a. <|endoftext|>. <|startoftext|>.", "é. é. é.́ é. z?\n w;", "ß. ÷. ª. 1. 2, ’s. 'S.",
           "ab. <|ENDOFTEXT|>, q.́ r. ΑΣ. İ. \x85É. ÀÞ×\xa0Q. end."]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in codec.encode(odd * 2)] == [
        library_tokenizer(v).encode(t, add_special_tokens=False).ids for t in odd * 2]
    encoded.clear()
    for _ in range(3):  # as many tasks
        assert len(list(codec.encode(["été Été ÉTÉ. été, ÉTÉ", "Word word. WORD!"]))) == 2
    assert sorted(w for w in encoded if w.isalpha()) == ["word", "été"] and len(encoded) <= 5
