"""Column-expression operators against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from foliospark.llm import line_quality
from foliospark.llm.external_shuffle import scatter, shuffle_to_shards
from foliospark.llm.line_quality import text_rules, with_line_verdict
from foliospark.llm.queries_native import op5, op8
from foliospark.llm.winnowing import edited, fingerprint, word_hashes, with_next

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, " ", "a", "a b", "x " * 40, "one two three four five six seven\none two three four five six seven", "\n\n",
       " ".join(f"w{i}" for i in range(300)), "é b c d\x0be f g", "a b c d e " * 3 + "z", "tail   \t blanks  "]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "h", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, source string, n_words long")


def winnowed(runs, window):
    """Rightmost smallest (by the upper 40 bits) run of every window."""
    high = [h & ~((1 << 24) - 1) for h in runs]
    starts = range(max(1, len(runs) - window + 1)) if runs else []
    places = []
    for s in starts:
        span = range(s, min(s + window, len(runs)))
        place = min(span, key=lambda i: (high[i], -i))
        if not places or places[-1] != place:
            places.append(place)
    return [(p, runs[p]) for p in places]


def test_fingerprint_equals_plain_winnowing(spark):
    for k, window in ((4, 16), (3, 5), (1, 1)):
        rows = frame(spark, ODD).select(
            "text", fingerprint(F.col("text"), 1, 1).alias("single"), fingerprint(F.col("text"), k, 1).alias("runs"),
            fingerprint(F.col("text"), k, window).alias("kept"), word_hashes(F.coalesce("text", F.lit(""))).alias("words")).collect()
        for row in rows:
            assert len(row.words) == len(WORD.findall(row.text or ""))
            runs = [p.hash for p in row.runs]
            assert len(runs) == (max(1, len(row.words) - k + 1) if row.words else 0)
            assert [(p.position, p.hash) for p in row.kept] == winnowed(runs, window)


def test_shared_passage_is_found(spark):
    passage = " ".join(f"p{i}" for i in range(19))  # window + k - 1 words
    texts = [f"{'a ' * n}{' '.join(f'x{n}_{i}' for i in range(50))} {passage} {' '.join(f'y{n}_{i}' for i in range(n))}" for n in range(1, 9)]
    prints = [{p.hash for p in r.p} for r in frame(spark, texts).select(fingerprint(F.col("text")).alias("p")).collect()]
    assert all(a & b for a in prints for b in prints)


def test_edited_texts_and_next(spark, tmp_path):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    ids = sorted(docs)
    rows = {r.doc_id: r for r in op8(spark, FOLDER).collect()}
    assert sorted(rows) == ids
    for at, i in enumerate(ids):
        text, following = docs[i], docs[ids[(at + 1) % len(ids)]]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    mean = lambda c: sum(r[c] for r in rows.values()) / len(rows)
    assert mean("near_edited") > 0.2 > mean("near_next")


@pytest.mark.parametrize("ids", [[5], [3, 3, 3], [None, 1, None, 2], list(range(0, 4000, 7))])
def test_next_over_segments(spark, ids):
    rows = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "doc_id long, text string")
    rows = rows.withColumn("tie", F.xxhash64("text"))
    out = with_next(rows, "doc_id", ["text"], len(ids) << 20, "tie").collect()  # about 48 rows a segment
    order = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie))
    assert len(out) == len(ids)
    assert [r.next_text for r in order] == [r.text for r in order[1:] + order[:1]]


def test_edited_halves(spark):
    cases = [("abcde", "xyz", "abcxy"), ("ab", "", "a"), ("", "x", ""), ("a", "x", "a"), ("abcdefgh", "x", "abcdx"), ("ééüü", "ßß", "ééßß")]
    rows = spark.createDataFrame(cases, "a string, b string, c string")
    assert all(r.e == r.c for r in rows.select("c", edited(F.col("a"), F.col("b")).alias("e")).collect())


def plain_rules(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    places = {i + o for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for o in range(5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(places),
            "base_failed": len(words) < 10 or 100 * len(places) > 20 * len(words)}


def test_text_rules_on_odd_texts(spark):
    texts = ODD + ["a b c d e a b c d e", "#*$ %& |<> x", "q w e r t y u i o p " * 30 + "end", "l1\nl1\n l1\n\n"]
    for row in text_rules(frame(spark, texts)).collect():
        assert {k: row[k] for k in plain_rules("")} == plain_rules(row.text), row.text


def plain_verdicts(rows, min_docs, share, kept_share):
    norm = lambda line: " ".join(WORD.findall(line)).lower()
    texts, hosts = defaultdict(set), defaultdict(set)
    for host, text in rows:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                texts[host, norm(line)].add(text)
    often = {k for k, v in texts.items() if len(v) > max(min_docs, len(hosts[k[0]]) * share)}
    out = []
    for host, text in rows:
        gone = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if (host, norm(x)) in often)
        rules = plain_rules(text)
        out.append(not rules["base_failed"] and not (gone and rules["n_words"] - gone < kept_share * rules["n_words"]))
    return out


def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark):
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    often = " ".join(f"o{j}" for j in range(15))
    rows = [("a", f"{body(i)}\n{often}") for i in range(12)] + [("a", f"{often.upper()}  \nx{i} y{i} z{i}") for i in range(4)]
    rows += [("b", f"{body(i)}\n{often}") for i in range(3)] + [("a", f"{body(99)}\ncopied line")] * 40
    rows += [(None, None), (None, often), ("a", ""), ("a", "few words")]
    docs = spark.createDataFrame([(i, t, h, "own", 5) for i, (h, t) in enumerate(rows)],
                                 "doc_id long, text string, source string, kept string, text_key long")
    out = sorted(with_line_verdict(docs, min_docs=5, max_share=0.01).collect(), key=lambda r: r.doc_id)
    assert [r.kept for r in out] == plain_verdicts(rows, 5, 0.01, 0.2)
    assert out[0].cleaned_text == body(0) and out[16].cleaned_text == f"{body(0)}\n{often}"
    assert not any(r.kept for r in out[12:16]) and all(r.kept for r in out[19:59])
    assert with_line_verdict(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [20, 2000])
def test_the_limit_is_one_share_at_every_host_size(spark, size):
    """A line in a fifth of a host's texts goes, one in a twentieth stays; both hosts under the query's own settings."""
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(20))
    rows = [("h", body(i) + ("\nin a fifth of all texts" if i % 5 == 0 else "") + ("\nin a twentieth of them" if i % 20 == 1 else "")) for i in range(size)]
    rows += [("h", rows[1][1])] * size  # copies are one text
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    out = with_line_verdict(docs).collect()
    assert sum(r.removed_words for r in out) == 6 * size // 5 and all(r.kept for r in out)
    assert {r.cleaned_text for r in out} == {t.replace("\nin a fifth of all texts", "") for _, t in rows}


def test_lines_are_removed_on_the_small_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert with_line_verdict(docs).where("removed_words > 0").count() > 0


def test_long_texts_sort_whole_hashes(spark, monkeypatch):
    texts = [" ".join(random.Random(n).choice("abc") for _ in range(n)) for n in (3, 5, 6, 12, 40, 300)] + ["x y z " * 50, " ".join(map(str, range(200)))]
    for limit in (1, 1 << 16):
        monkeypatch.setattr(line_quality, "PACKED_WORDS", limit)
        for row in text_rules(frame(spark, texts)).collect():
            assert row.n_repeat_words == plain_rules(row.text)["n_repeat_words"]


def test_shards_hold_everything_once(spark):
    docs = spark.createDataFrame([(i % 50 if i % 3 else None, None if i % 7 == 0 else f"text {i % 9}" * (i % 40), "s", i, i, i)
                                  for i in range(1003)], "doc_id long, text string, source string, shard long, record long, bucket long")
    out = shuffle_to_shards(docs, 7, bucket_bytes=20_000)
    rows = out.collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(7)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(tuple(r.record) for r in rows) == Counter(map(tuple, docs.collect()))
    again = shuffle_to_shards(docs.repartition(5), 7, bucket_bytes=20_000).collect()
    assert sorted((r.shard, r.slot, tuple(map(str, r.record))) for r in again) == sorted((r.shard, r.slot, tuple(map(str, r.record))) for r in rows)
    order = [r.record.shard for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(sum(b > a for a, b in zip(order, order[1:], strict=False)) / len(order) - 0.5) < 0.08
    assert shuffle_to_shards(docs.limit(0), 7).count() == 0


def test_equal_rows_go_to_many_buckets(spark):
    """A third of all rows are one row; every bucket gets its share, and every row its place."""
    docs = spark.createDataFrame([(7, "same text") if i % 3 == 0 else (i, f"text {i}") for i in range(6000)], "doc_id long, text string")
    sizes = sorted(r["count"] for r in scatter(docs, 12, 7).groupBy("bucket").count().collect())
    assert len(sizes) == 12 and sizes[-1] < 2 * sizes[6]
    rows = shuffle_to_shards(docs, 5, bucket_bytes=30_000).collect()
    assert Counter(r.record.doc_id for r in rows)[7] == 2001 - (7 % 3 == 0) and len({(r.shard, r.slot) for r in rows}) == 6000


def test_op5_digests(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op5(spark, FOLDER).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in docs.items()}
