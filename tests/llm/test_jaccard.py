"""The Jaccard join and components against brute force."""

import random
import re

import numpy as np
import pytest

from foliospark.llm.components import components
from foliospark.llm.jaccard_join import _from_planes, _planes, jaccard_components, shingle_set, tile_links
from foliospark.llm.queries_models import op3

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_components(rows):
    """(id, size, smallest reachable id) of (id, text) rows."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(s), least[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


def edited_copies(rng, n_bases=6, copies=60):
    """Documents of mixed length, their copies with random edits, and shared passages."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 5)))
    passage, texts = [word() for _ in range(60)], []
    for _ in range(n_bases):
        base = [word() for _ in range(rng.choice([8, 30, 120, 400]))]
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(int(rng.random() * 0.06 * len(own))):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own += passage[:rng.randrange(60)]
            texts.append(" ".join(own) if rng.random() < 0.9 else " ".join(own).upper() + "\n")
    return texts + texts[:20] + ["", None, "one", "ONE", "two words", " \t", "É e", "é e"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, class long, component_id string")


@pytest.mark.parametrize("seed,sizes", [(1, {}), (2, {"shard_shingles": 3000, "block_shingles": 1500}), (3, {"block_shingles": 400})])
def test_components_equal_all_pairs(spark, seed, sizes):
    rng = random.Random(seed)
    texts = edited_copies(rng)
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    out = jaccard_components(frame(spark, rows).repartition(5), **sizes).collect()
    assert sorted(map(tuple, out)) == plain_components(rows)


def test_op3_on_the_smallest_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, op3(spark, FOLDER).collect())) == plain_components(rows)


def test_odd_tables(spark):
    assert jaccard_components(frame(spark, [])).count() == 0
    assert sorted(map(tuple, jaccard_components(frame(spark, [(3, None), (4, "")])).collect())) == [(3, 0, 3), (4, 0, 4)]
    same = [(5, "a b c d e f")] * 4 + [(None, "a b c d e f")]
    assert sorted(map(str, jaccard_components(frame(spark, same)).collect())) == sorted(
        ["Row(doc_id=5, n_shingles=2, component_id=5)"] * 4 + ["Row(doc_id=None, n_shingles=2, component_id=5)"])


def test_tile_links_span_the_links_of_a_tile():
    rng = np.random.default_rng(4)
    for _ in range(20):
        bases = [rng.integers(0, 1 << 48, rng.integers(5, 200)).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(60):
            base = bases[rng.integers(4)]
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) < rng.choice([0.9, 0.97, 1])],
                                                  rng.integers(0, 1 << 48, rng.integers(0, 6)).astype(np.uint64)])))
        sets = [s for s in sets if len(s)]
        m = np.array([len(s) for s in sets])
        linked = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * (o := len(np.intersect1d(sets[i], sets[j])))
                  >= 80 * (m[i] + m[j] - o)}
        found = tile_links(m, sets)
        assert all((max(p), min(p)) in linked for p in found)

        def groups(pairs, n=len(sets)):
            label = list(range(n))
            for a, b in pairs:
                label = [label[b] if x == label[a] else x for x in label]
            return sorted(tuple(i for i in range(n) if label[i] == x) for x in set(label))

        assert groups(found) == groups(linked)


def test_shingle_hashes_and_planes():
    a, b = shingle_set("A b c d e f"), shingle_set("a B C\td\ne f ")
    assert a.tolist() == b.tolist() and len(a) == 2 and len(shingle_set("x y")) == 1 and len(shingle_set(None)) == 0
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 48, 1000).astype(np.uint64))
    assert (_from_planes(_planes(values)) == values).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1050)] + [(2, 1050), (1049, 1050), (500, 500)]
    label = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(label[i] == 100 for i in range(100, 161)) and all(label[i] == 2 for i in [2, 7, *range(1000, 1051)]) and label[500] == 500


def test_one_row_of_a_component_stays(spark):
    """Repeated ids, missing ids and equal rows; rows without words are no copies of each other."""
    from foliospark.llm.jaccard_join import one_per_component

    body, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(3, body, 1), (3, body, 1), (3, body, 2), (None, body, 1), (None, body, 1), (7, body + " end", 1),
            (None, other, 1), (None, other, 1), (None, other, 2), (9, None, 1), (9, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra long")
    out = [tuple(r) for r in one_per_component(docs).collect()]
    assert sorted((r[0] or 0, r[1]) for r in out if r[1]) == [(0, other), (3, body)]
    assert sum(r[1] is None for r in out) == 2 and set(out) <= set(rows)
    assert one_per_component(docs.limit(0)).count() == 0


def test_shingles_split_and_fold_ascii_only():
    """Words of bytes are the words of the text: only A-Z are folded and only the six ASCII blanks divide."""
    from foliospark.llm.texts import ascii_lower, words_of

    odd = "Ab\x0bC\x0c\u00c4\u00a0x\x1cy\x85Z \u2003\u0130 \u212a\r\n\t\x1f q"
    for text in (odd, f" {odd}  {odd} {odd} ", "", " \t", "one", "A a A a A a A a"):
        words = words_of(ascii_lower(text))
        runs = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        found = shingle_set(text)
        assert len(found) == len(runs) and (np.diff(found.astype(np.int64)) > 0).all()
        assert found.tolist() == shingle_set(" ".join(words)).tolist()
