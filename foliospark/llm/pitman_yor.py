"""Scores of texts under a hierarchical Pitman-Yor language model.

A token is a word (A-Z lower-cased) or the end of its text. Every token is served in the restaurant of
its context, the word before or the start of the text, so restaurants are as many as words. The parent
of a context is the restaurant of its class, its last character modulo 256 (or the start); the 257
classes share one root, whose base gives half its mass to the unknown word and half, evenly, to the
vocabulary. Customers are the tokens of the training texts; a table of a restaurant is a customer of
its parent.

Seating is sampled by blocked Gibbs sweeps: in each, a dish leaves its restaurant and its customers sit down
again one after another, at a table or a new one, given all other dishes as the sweep before left them (a
parallel approximation: a sequential sampler would see dishes already redrawn). Past ``EXACT_SEATS``
customers of a dish they sit down in runs of doubling length with the probability of the run's middle. Dishes are words, so a word's customers in all restaurants lie
in one shard and shards are sampled side by side. After every sweep the tables of each context are
summed over all shards: shards send their share to the shard of the context and get the total back.
Totals of classes and of the root are a few hundred numbers. So every sweep and every kept sample has
exact totals, each sample is a normalised model, and probabilities are averaged over the samples.
Discounts come from the counts of counts.

Blocks of documents send their distinct (context, word) pairs with training counts to the shards and
get back one log probability per pair and one count per word. Contexts travel as their class and 54
bits of a hash. Null texts are empty: one end token. Repeated rows are scored and counted once each.
Extra columns are dropped. Without training texts every token is unknown. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from ..session import discard, materialise
from .blocks import by_shard, pack, pack_blocks, parts_for, shard_of, text_bytes, unpack, unpack_all
from .texts import releasing_group, releasing_pair
from .word_codec import split_words

START = 256  # the class of a first token's context
CONTEXTS = 257  # classes
_STEP = 512  # class key: word number * _STEP + class
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
BURN_IN, SAMPLES = 2, 3
STRENGTH = 1.0
UNKNOWN_MASS = 0.5
EXACT_SEATS = 512
SWEPT_PAIRS = 1 << 19  # pairs of a shard whose words a sweep takes together
TURNS = 8  # parts of the shards that answer one after another


def sorted_codes(words: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in order, and the number of each word: the same whatever the order of the rows."""
    coded = words.combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


def context_ids(words: list[str]) -> np.ndarray:
    """Contexts by the word before: a hash and, in the low bits, the class. The empty word stands for the start of a text."""
    mixed = np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in words), ">u8").astype(np.uint64)
    last = np.fromiter((ord(w[-1]) % START if w else START for w in words), np.int64, len(words))
    return np.where(last == START, START, (mixed >> np.uint64(1)).astype(np.int64) // _STEP * _STEP + last)


def one_row(**columns: pa.Array | np.ndarray) -> bytes:
    """Columns of different lengths as one packed row of lists."""
    values = {c: v if isinstance(v, pa.Array) else pa.array(v) for c, v in columns.items()}
    return pack(pa.table({c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in values.items()}))


def lists(payload) -> dict[str, np.ndarray | pa.Array]:
    held = unpack(payload)
    values = {c: held.column(c)[0].values for c in held.column_names}
    return {c: v if pa.types.is_string(v.type) else v.to_numpy() for c, v in values.items()}


def block_tokens(payloads: pa.ChunkedArray):
    """Tokens of a block: documents, tokens per document, sorted words, sorted pair keys, and the pair of each token.

    A pair key is the number of the word times the number of words, plus the number of the word before.
    """
    rows = pa.concat_tables(unpack_all(payloads)).combine_chunks()
    owner, words = split_words(pc.ascii_lower(rows.column("text")))  # of the bytes only A-Z
    distinct, coded = sorted_codes(pa.chunked_array([words]))
    sizes = np.bincount(owner, minlength=rows.num_rows) + 1
    keys = np.zeros(len(coded) + len(sizes), np.int64)  # every text ends with the empty word, so that is the first one
    keys[np.arange(len(coded)) + owner] = coded + 1
    del owner, words, coded
    n_words = len(distinct) + 1
    keys *= n_words
    keys[1:] += keys[:-1] // n_words  # a text starts after an empty word
    pairs, at = np.unique(keys, return_inverse=True)
    return rows.drop_columns("text"), sizes, ["", *distinct.to_pylist()], pairs, at.astype(np.int32)


def _pairs_by_shard(words: list[str], pairs: np.ndarray, n_shards: int):
    return by_shard(shard_of(words, n_shards)[pairs // len(words)])


def _ask(n_shards: int):
    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        docs, sizes, words, pairs, at = block_tokens(table.column("payload"))
        train = np.repeat(~np.asarray(docs.column("held_out").combine_chunks().to_numpy(zero_copy_only=False), bool), sizes)
        counts = np.bincount(at, train, len(pairs)).astype(np.uint32)
        spelled, contexts, out = pa.array(words, pa.string()), context_ids(words), []
        for shard, p in _pairs_by_shard(words, pairs, n_shards):
            word, own = np.unique(pairs[p] // len(words), return_counts=True)
            before, place = np.unique(pairs[p] % len(words), return_inverse=True)
            out.append((shard, block, one_row(word=spelled.take(pa.array(word)), own=own.astype(np.uint32), context=contexts[before],
                                              place=place.astype(np.uint32), n=counts[p])))
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))],
                        names=["shard", "block", "asked"])
    return ask


STATS = pa.list_(pa.struct([("kind", pa.string()), ("context", pa.int32()), ("value", pa.float64())]))
ROWS = "shard int, kind string, source int, payload binary, stats array<struct<kind:string,context:int,value:double>>"
_ROWS = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("source", pa.int32()), ("payload", pa.binary()), ("stats", STATS)])


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ROWS)], schema=_ROWS)


def _stat_rows(stats: dict[str, np.ndarray]) -> list[dict]:
    return [{"kind": kind, "context": int(i), "value": float(values[i])} for kind, values in stats.items() for i in np.flatnonzero(values)]


def _by_context_shard(context: np.ndarray, n_shards: int):
    return by_shard(context // _STEP % n_shards)


def _shares(shard: int, step: int, n_shards: int, context: np.ndarray, **values: np.ndarray) -> list[tuple]:
    """A shard's share of what the contexts hold, to the shards of the contexts."""
    return [(k, f"shares{step}", shard, one_row(context=context[p], **{c: v[p] for c, v in values.items()}), None)
            for k, p in _by_context_shard(context, n_shards)]


def _merge(n_shards: int):
    """The training pairs of a shard: sorted words and contexts, places of the pairs, counts; contexts that are only asked for too."""
    def merge(table: pa.Table) -> pa.Table:
        shard, parts = table.column("shard")[0].as_py(), [lists(p.as_buffer()) for p in table.column("asked")]
        words, codes = sorted_codes(pa.chunked_array([p["word"] for p in parts], pa.string()))
        context = np.unique(np.concatenate([p["context"] for p in parts]))
        place = np.concatenate([np.searchsorted(context, p["context"]).astype(np.int32)[p["place"]] for p in parts])
        word = np.repeat(codes.astype(np.int32), np.concatenate([p["own"] for p in parts]))
        n = np.concatenate([p["n"] for p in parts])
        del parts, codes
        trained = n > 0
        n, word, place = n[trained], word[trained], place[trained]
        known = np.unique(word)
        key = np.searchsorted(known, word) * len(context) + place
        del trained, word, place
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.add.reduceat(n, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        key = key[first]
        del order, n, first
        word, place = key // len(context), key % len(context)
        del key
        own_class, customers = np.unique(word * _STEP + context[place] % _STEP, return_counts=True)  # one table a pair
        served = np.bincount(own_class // _STEP, minlength=len(known))
        levels = (counts, customers, served)
        stats = {"customers": np.bincount(own_class % _STEP, customers, CONTEXTS), "tables": np.bincount(own_class % _STEP, minlength=CONTEXTS),
                 "words": np.array([len(known)]), "root": np.array([len(known)]), "trained": np.array([counts.sum()]),
                 "ones": np.array([(c == 1).sum() for c in levels]), "twos": np.array([(c == 2).sum() for c in levels])}
        pairs = one_row(word=words.take(pa.array(known)), own=np.bincount(word, minlength=len(known)).astype(np.uint32), context=context,
                        place=place.astype(np.uint32), n=counts)
        shares = _shares(shard, 0, n_shards, context, customers=np.bincount(place, counts, len(context)).astype(np.int64),
                         tables=np.bincount(place, minlength=len(context)))
        return _rows([(shard, "pairs", shard, pairs, _stat_rows(stats)), *shares])
    return merge


def _sum_shares(step: int):
    def add(table: pa.Table) -> pa.Table:
        """Totals of the contexts of a shard, back to all that sent a share, in the order of their contexts."""
        parts = [lists(p.as_buffer()) for p in table.column("payload")]
        _, at = np.unique(np.concatenate([p["context"] for p in parts]), return_inverse=True)
        names = [c for c in parts[0] if c != "context"]
        totals = {c: np.bincount(at, np.concatenate([p[c] for p in parts])).astype(np.int64)[at] for c in names}
        ends = np.cumsum([len(p["context"]) for p in parts])
        return _rows([(source, f"totals{step}", table.column("shard")[0].as_py(),
                       one_row(**{c: v[end - len(p["context"]):end] for c, v in totals.items()}), None)
                      for source, p, end in zip(table.column("source").to_pylist(), parts, ends.tolist(), strict=True)])
    return add


def _summed_shares(rows: DataFrame, step: int) -> DataFrame:
    return rows.where(F.col("kind") == f"shares{step}").groupBy("shard").applyInArrow(releasing_group(_sum_shares(step)), ROWS)


@dataclass
class Totals:
    """Sums over all shards; arrays run over classes."""

    customers: np.ndarray
    pairs: np.ndarray
    n_words: int
    discount: float
    root_discount: float
    word_discount: float = 0.5
    trained: int = 0

    @property
    def base_known(self) -> float:
        return (1 - UNKNOWN_MASS) / max(self.n_words, 1)


@dataclass
class Sample:
    """One sample's totals: tables per class, and of the root."""

    tables: np.ndarray
    root: float


def _summed(states: DataFrame) -> dict[tuple[str, int], float]:
    """Totals by kind and class: a few per class and sweep, whatever the size of the corpus."""
    rows = states.select(F.inline("stats")).groupBy("kind", "context").agg(F.sum("value").alias("value")).collect()
    return {(r.kind, r.context): r.value for r in rows}


def _per_class(found: dict[tuple[str, int], float], kind: str) -> np.ndarray:
    return np.array([found.get((kind, k), 0.0) for k in range(CONTEXTS)])


def _totals(states: DataFrame) -> tuple[Totals, Sample]:
    found = _summed(states)

    def discount(level: int) -> float:
        ones, twos = found.get(("ones", level), 0.0), found.get(("twos", level), 0.0)
        return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.1, 0.95))

    tables = _per_class(found, "tables")
    return (Totals(_per_class(found, "customers"), tables, int(found.get(("words", 0), 0)), discount(1), discount(2), discount(0),
                   int(found.get(("trained", 0), 0))), Sample(tables, found.get(("root", 0), 0.0)))


def seat(customers: np.ndarray, weight: np.ndarray, parent: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down one after another.

    ``weight`` is the strength plus the discount of the other dishes' tables: with each table a dish opens
    another discount is added to it. ``parent`` is the parent's probability of the dish.
    """
    tables = (customers > 0).astype(np.int64)
    going, n = np.flatnonzero(customers > 1), 1
    while len(going):
        runs = np.minimum(n if n >= EXACT_SEATS else 1, customers[going] - n)
        new = (weight[going] + discount * tables[going]) * parent[going]
        p = new / (new + np.maximum(n + (runs - 1) / 2 - discount * tables[going], 1e-9))
        tables[going] += rng.random(len(going)) < p if n < EXACT_SEATS else rng.binomial(runs, p)
        n += n if n >= EXACT_SEATS else 1
        going = going[customers[going] > n]
    return tables


def reseat(word: np.ndarray, context: np.ndarray, customers: np.ndarray, tables: np.ndarray, root: np.ndarray, totals: Totals,
           held: Sample, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """New tables of the classes, per pair, and of the root, per word, given the totals of all shards."""
    d, d0, s, n_words = totals.discount, totals.root_discount, STRENGTH, len(root)
    parent = root_share(np.bincount(word, tables, n_words)[word] - tables, word, root, totals, held)
    tables = seat(customers, s + d * np.maximum(held.tables[context] - tables, 0), parent, d, rng)
    served = np.bincount(word, tables, n_words).astype(np.int64)
    root = seat(served, s + d0 * np.maximum(held.root - root, 0), np.full(n_words, totals.base_known), d0, rng)
    return tables, root


def root_share(others: np.ndarray, word: np.ndarray, root: np.ndarray, totals: Totals, held: Sample) -> np.ndarray:
    """The root's probability of words with so many customers there."""
    d0, s = totals.root_discount, STRENGTH
    new = (s + d0 * held.root) / (s + held.tables.sum()) * totals.base_known
    return np.maximum(others - d0 * np.minimum(root[word], others), 0) / (s + held.tables.sum()) + new


def _held(table: pa.Table) -> dict[str, list[dict]]:
    """Rows of a shard by kind, in the order of their source."""
    rows = sorted(zip(table.column("kind").to_pylist(), table.column("source").to_pylist(), range(len(table)), strict=True))
    out: dict[str, list[dict]] = {}
    for kind, _, i in rows:
        out.setdefault(kind, []).append(lists(table.column("payload")[i].as_buffer()))
    return out


def _of_contexts(replies: list[dict], context: np.ndarray, n_shards: int, name: str) -> np.ndarray:
    """Totals of all contexts of a shard from the replies, which come in the order of the context's shards."""
    out = np.zeros(len(context), np.int64)
    for (_, p), reply in zip(_by_context_shard(context, n_shards), replies, strict=True):
        out[p] = reply[name]
    return out


def _words_of_pairs(own: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(own)), own)


def _classes(pairs: dict) -> tuple[np.ndarray, np.ndarray]:
    """The sorted class keys of words and the class key of each pair."""
    own_class, at = np.unique(_words_of_pairs(pairs["own"]) * _STEP + pairs["context"][pairs["place"]] % _STEP, return_inverse=True)
    return own_class, at.astype(np.int32)


def _slices(own: np.ndarray):
    """Words in runs of about ``SWEPT_PAIRS`` pairs, and the pairs of each run. A word's pairs stay together."""
    ends = np.cumsum(own, dtype=np.int64)
    start = 0
    while start < len(own):
        first = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, first + SWEPT_PAIRS, "right")))
        yield slice(start, stop), slice(first, int(ends[stop - 1]))
        start = stop


def _sweep(step: int, n_shards: int, totals: Totals, held: Sample, seed: int):
    def sweep(table: pa.Table) -> pa.Table:
        shard, rows = table.column("shard")[0].as_py(), _held(table)
        pairs, rng = rows["pairs"][0], np.random.default_rng([seed, shard, step])
        context, n_words = pairs["context"], len(pairs["word"])
        before = rows[f"tables{step - 1}"][0] if step > 1 else None  # in the first sweep all have one
        all_tables = _of_contexts(rows[f"totals{step - 1}"], context, n_shards, "tables")
        d, s = totals.discount, STRENGTH
        shares, of_class, root_tables = np.zeros(len(context), np.int64), np.zeros((2, CONTEXTS)), 0
        seated: dict[str, list[np.ndarray]] = {c: [np.zeros(0, np.uint32)] for c in ("tables", "classes", "root")}
        n_classes = 0  # of the words before
        for words, own in _slices(pairs["own"]):
            place, n = pairs["place"][own], pairs["n"][own]
            own_class, at = _classes({"own": pairs["own"][words], "context": context, "place": place})
            word, of = own_class // _STEP, own_class % _STEP
            ranges = {"tables": own, "classes": slice(n_classes, n_classes + len(word)), "root": words}
            sizes = {"tables": len(place), "classes": len(word), "root": words.stop - words.start}
            tables, classes, root = (before[c][r].astype(np.int64) if before else np.ones(sizes[c], np.int64) for c, r in ranges.items())
            n_classes += len(word)
            # The class's probability of each pair's word without the pair's own tables.
            others = np.bincount(at, tables, len(word))[at] - tables
            new = (s + d * held.tables[of]) * root_share(np.bincount(word, classes, len(root))[word], word, root, totals, held)
            parent = (np.maximum(others - d * np.minimum(classes[at], others), 0) + new[at]) / (s + totals.customers[of[at]])
            weight = s + totals.word_discount * np.maximum(all_tables[place] - tables, 0)
            tables = seat(n, weight, parent, totals.word_discount, rng)
            customers = np.bincount(at, tables, len(word)).astype(np.int64)
            classes, root = reseat(word, of, customers, classes, root, totals, held, rng)
            of_class += [np.bincount(of, v, CONTEXTS) for v in (customers, classes)]
            root_tables += root.sum()
            np.add.at(shares, place, tables)
            for c, v in (("tables", tables), ("classes", classes), ("root", root)):
                seated[c].append(v.astype(np.uint32))
        stats = {"customers": of_class[0], "tables": of_class[1], "root": np.array([root_tables])}
        seated_row = one_row(**{c: np.concatenate(v) for c, v in seated.items()})
        sent = _shares(shard, step, n_shards, context, tables=shares)
        return _rows([(shard, f"tables{step}", shard, seated_row, _stat_rows(stats)), *sent])
    return sweep


def pair_probabilities(totals: Totals, samples: list[Sample], context: np.ndarray, counts: np.ndarray, tables: list[np.ndarray],
                       served: list[np.ndarray], root: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """Averaged predictive probability of (class, word) pairs.

    Per pair: customers, tables per sample, the word's customers and tables in the root per
    sample, and whether the word is known.
    """
    d, d0, s = totals.discount, totals.root_discount, STRENGTH
    base = np.where(known, totals.base_known, UNKNOWN_MASS if totals.n_words else 1.0)
    mean = np.zeros(len(context))
    for sample, t, c0, t0 in zip(samples, tables, served, root, strict=True):
        all_served = sample.tables.sum()
        parent = (c0 - d0 * t0 + (s + d0 * sample.root) * base) / (s + all_served)
        held = s + totals.customers[context]
        mean += (counts - d * t + (s + d * sample.tables[context]) * parent) / held
    return mean / len(samples)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted keys among sorted ones; the number of keys for those that are missing."""
    at = np.searchsorted(keys, wanted)
    return np.where(np.append(keys, -1)[at] == wanted, at, len(keys))


def _answer(n_shards: int, totals: Totals, samples: dict[int, tuple[Totals, Sample]]):
    """``samples``: of each kept step, the totals of the classes' customers and of their tables."""
    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, s = _held(right), STRENGTH
        pairs = rows["pairs"][0]
        context, n_words = pairs["context"], len(pairs["word"])
        own_class, at = _classes(pairs)
        key = _words_of_pairs(pairs["own"]) * len(context) + pairs["place"]
        # One more word, unknown, and one more pair and class, never trained, stand for whatever is missing.
        more = lambda values, kind=np.int64: np.append(values, kind(0)).astype(kind)
        counts = more(pairs["n"], np.uint32)
        word_counts = more(np.add.reduceat(pairs["n"], np.cumsum(pairs["own"], dtype=np.int64) - pairs["own"]) if n_words else pairs["n"])
        customers = _of_contexts(rows["totals0"], context, n_shards, "customers")
        seated = []
        for step, (of_classes, held) in samples.items():
            own = rows[f"tables{step}"][0]
            seated.append((of_classes, held, _of_contexts(rows[f"totals{step}"], context, n_shards, "tables"), more(own["tables"], np.uint32),
                           more(np.bincount(at, own["tables"], len(own_class))), more(own["classes"]),
                           more(np.bincount(own_class // _STEP, own["classes"], n_words)), more(own["root"])))
        payloads = []
        for asked in (lists(p.as_buffer()) for p in left.column("asked")):
            found = pc.fill_null(pc.index_in(asked["word"], value_set=pairs["word"]), n_words).to_numpy().astype(np.int64)
            dish = np.repeat(found, asked["own"])
            before = np.searchsorted(context, asked["context"])[asked["place"]]
            of = context[before] % _STEP
            pair, in_class = _find(key, dish * len(context) + before), _find(own_class, dish * _STEP + of)
            p = np.zeros(len(dish))
            for of_classes, held, all_tables, tables, served, classes, in_root, root in seated:
                parent = pair_probabilities(of_classes, [held], of, served[in_class], [classes[in_class]], [in_root[dish]], [root[dish]],
                                            dish < n_words)
                d = totals.word_discount
                p += (counts[pair] - d * tables[pair] + (s + d * all_tables[before]) * parent) / (s + customers[before])
            payloads.append(one_row(log_p=np.log10(p / len(seated)).astype(np.float32), count=word_counts[found]))
        return pa.table([left.column("block"), left.column("shard"), pa.array(payloads, pa.binary())], names=["block", "shard", "answer"])
    return answer


def _score(n_shards: int, n_train: float, n_words: int, out: pa.Schema):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, sizes, words, pairs, at = block_tokens(left.column("payload"))
        answers = dict(zip(right.column("shard").to_pylist(), right.column("answer"), strict=True))
        logs, counts = np.zeros(len(pairs)), np.zeros(len(words), np.int64)
        for shard, p in _pairs_by_shard(words, pairs, n_shards):
            given = lists(answers[shard].as_buffer())
            logs[p], counts[np.unique(pairs[p] // len(words))] = given["log_p"], given["count"]
        counts = counts[pairs // len(words)]
        base = np.log10((counts + 0.5) / (n_train + 0.5 * (n_words + 1)))
        starts = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(v[at], starts) for v in ((counts > 0).astype(np.int64), base, logs)]
        return pa.Table.from_arrays([docs.column("id").cast(out.field("id").type), docs.column("held_out"), pa.array(sizes),
                                     *map(pa.array, sums)], schema=out)
    return score


def hpy_scores(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
               shard_bytes: int = SHARD_BYTES, seed: int = 5) -> DataFrame:
    """Scores of all rows under a model of those not held out.

    id, held_out, n_tokens, n_known, base_score (add-half unigrams) and score (log10), train_tokens, perplexity per token.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    total = text_bytes(docs, text_col)
    n_shards = parts_for(total, shard_bytes)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = pack_blocks(rows, parts_for(total, block_bytes))
    asked = blocks.groupBy("block").applyInArrow(releasing_group(_ask(n_shards)), "shard int, block int, asked binary")
    asked = materialise(asked.withColumn("turn", F.col("shard") % TURNS), "hpy-asked", parts=("turn",))
    merged = materialise(asked.drop("turn").groupBy("shard").applyInArrow(releasing_group(_merge(n_shards)), ROWS), "hpy-pairs")
    totals, held = _totals(merged)
    of_kind = lambda rows, kind: rows.where(F.col("kind") == kind)
    joined = lambda frames: reduce(DataFrame.unionByName, frames).drop("stats").groupBy("shard")
    pairs = of_kind(merged, "pairs")
    seated, of_classes, samples, given, written = merged, totals, {}, [pairs], [merged]
    shares = [_summed_shares(merged, 0)]
    for step in range(1, BURN_IN + SAMPLES + 1):
        sent = [pairs, of_kind(seated, f"tables{step - 1}"), _summed_shares(seated, step - 1)]
        before, seated = seated, materialise(joined(sent).applyInArrow(
            releasing_group(_sweep(step, n_shards, of_classes, held, seed)), ROWS), "hpy-tables")
        if 1 < step <= BURN_IN + 1:  # what a burn-in sweep wrote serves the next one only
            discard(before)
        else:
            written += [before] if step > 1 else []
        found = _summed(seated)
        of_classes = replace(totals, customers=_per_class(found, "customers"))
        held = Sample(_per_class(found, "tables"), found.get(("root", 0), 0.0))
        if step > BURN_IN:
            samples[step] = of_classes, held
            given.append(of_kind(seated, f"tables{step}"))
            shares.append(_summed_shares(seated, step))
    summed = materialise(reduce(DataFrame.unionByName, shares), "hpy-totals")
    answers, known = [], reduce(DataFrame.unionByName, [*given, summed]).drop("stats")
    for turn in range(min(TURNS, n_shards)):  # what is asked and known is shuffled for a few shards at a time
        own, held = asked.where(F.col("turn") == turn), known.where(F.col("shard") % TURNS == turn)
        answers.append(materialise(own.drop("turn").groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(
            releasing_pair(_answer(n_shards, totals, samples)), "block int, shard int, answer binary"), "hpy-answers"))
        discard(asked, part=f"turn={turn}")
    discard(*written, seated, summed)
    answers = reduce(DataFrame.unionByName, answers)
    kinds = StructType([rows.schema["id"], StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
                        StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType())])
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        releasing_pair(_score(n_shards, float(totals.trained), totals.n_words, to_arrow_schema(kinds))), kinds)
    return scored.withColumns({"train_tokens": F.lit(totals.trained).cast("long"), "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))})
