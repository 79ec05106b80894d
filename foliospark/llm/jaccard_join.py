"""Exact n-gram Jaccard self-join: size-banded tiles, bitmap bounds, sorted-array intersection.

A document is its set of distinct shingles (runs of ``width`` words, A-Z lower-cased; all words when
there are fewer), two documents link at ``percent`` or more shared shingles of their union. The steps:

1. Equal sets become one class, keyed by a hash of the set, so copies cost one row however many.
2. Classes post their shingle hashes to shards of bounded size; a shard returns, to every class, its
   shingles that other classes have too, with the number of classes. Shingles that a fixed-size sample
   finds in more than ``HOT_SHARE`` of the documents (a bounded list) are not counted but taken as the
   most frequent, which bounds the rows one shingle brings to a shard. Only the order depends on it.
3. Classes order their shingles from rare to frequent. Partners must share one of the first
   ``m - ceil(m * percent) + 1`` (``m`` shingles in all); a class without a shared shingle among those
   is done. This rests on exact counts over all rows and drops no link.
4. Each prefix shingle names a home, the smallest class within two steps, so classes with a common
   prefix shingle meet in its home while shingles with about the same classes share one home.
5. Homes are cut into blocks by size band; two blocks make a tile where their sizes can link. In a
   tile, hashed bitmaps bound the overlap of every pair from above, pairs that pass are intersected
   exactly, and pairs already connected inside the tile are skipped: a tile returns at most one link
   per class, never all pairs of a group.
6. Connected components of the links give every class, and so every document, its smallest id.

Null or wordless texts have an empty set and link with nothing (their own id). Repeated rows each get
their row; rows with a null id take part, and get the smallest id they reach, null if there is none.
Extra columns are dropped. An empty table gives an empty result. Shingles are compared by 48 hash bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from ..operators.sizes import at_most, broadcast_when
from ..session import materialise
from .blocks import by_shard, pack, parts_for, unpack_all
from .components import components
from .texts import releasing, releasing_group
from .word_codec import ragged

WIDTH = 5
PERCENT = 80
HASH_BITS = 48
SHARD_SHINGLES = 1_000_000
BLOCK_SHINGLES = 500_000  # shingles of a tile's side
RUN_CHARS = 4 << 20
KNOWN_WORDS = 100_000  # whose hashes a worker remembers
BATCH_ROWS = 2_000  # texts turned into Python strings together
SAMPLE_DOCS = 4_000
HOT_SHARE = 0.01
HOT_CLASSES = 1 << 30  # stands for the count of a hot shingle
BROADCAST_REMOVED = 200_000  # hashes of rows
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                         0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _word_hash() -> _WordHash:
    return _WordHash()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 48-bit hashes of a text's shingles."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and the six ASCII blanks, nothing else
    if not words:
        return np.zeros(0, np.uint64)
    known = _word_hash()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total = _mixed(total + h[k:len(h) - n + 1 + k] * _MULTIPLIERS[k % 8])
    return _distinct(total >> np.uint64(64 - HASH_BITS))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a sort of so few takes a quarter of the time of the library's hash table."""
    values.sort()
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values if first.all() else values[first]


def class_key(shingles: np.ndarray) -> int:
    """Signed 64-bit key of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def _runs(texts: list) -> Iterator[tuple[int, int]]:
    start = held = 0
    for row, text in enumerate(texts):
        held += len(text or "")
        if held >= RUN_CHARS:
            yield start, row + 1
            start, held = row + 1, 0
    if start < len(texts):
        yield start, len(texts)


def document_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n_shingles, class) of every row; the class is null without shingles."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column("_text"):
                found = shingle_set(text.as_py(), width)
                sizes.append(len(found))
                keys.append(class_key(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())],
                                             names=["id", "n_shingles", "class"])

    return rows.mapInArrow(releasing(measure), StructType([StructField("id", rows.schema["_id"].dataType), StructField("n_shingles", LongType()),
                                                StructField("class", LongType())]))


def hot_shingles(docs: DataFrame, n_docs: int, text_col: str, width: int) -> np.ndarray:
    """Shingles of more than ``HOT_SHARE`` of a sample of about ``SAMPLE_DOCS`` rows.

    At most (shingles of the sample) / (HOT_SHARE * sample) values, whatever the size of the corpus.
    """
    sample = docs.select(F.col(text_col).alias("_text"))
    if n_docs > SAMPLE_DOCS:
        sample = sample.sample(SAMPLE_DOCS / n_docs, seed=11)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column("_text")]
            if sets:
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts)], names=["shingle", "n"])

    counted = sample.mapInArrow(releasing(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    least = max(HOT_SHARE * min(n_docs, SAMPLE_DOCS), 20)
    return np.array(sorted(r.shingle for r in counted.where(F.col("n") > least).select("shingle").collect()), np.uint64)


_PLANES = 6


def _planes(values: np.ndarray) -> bytes:
    """48-bit numbers byte plane by byte plane, which compresses well when they are sorted."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_PLANES].T).tobytes()


def _from_planes(data) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(_PLANES, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :_PLANES] = planes.T
    return whole.view("<u8").ravel()


def _postings(hashes: np.ndarray, row: np.ndarray, classes: np.ndarray, sizes: np.ndarray) -> bytes:
    """Sorted hashes with the class and set size of each, as one payload."""
    used, local = np.unique(row, return_inverse=True)
    return pack(pa.table({"hashes": pa.array([_planes(hashes)], pa.binary()),
                          "local": pa.array([local.astype(np.uint32)], pa.list_(pa.uint32())),
                          "class": pa.array([classes[used]], pa.list_(pa.int64())),
                          "m": pa.array([sizes[used]], pa.list_(pa.int64()))}))


def _read_postings(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, set size) arrays."""
    local = table.column("local")[0].values.to_numpy()
    return (_from_planes(table.column("hashes")[0].as_buffer()), table.column("class")[0].values.to_numpy()[local],
            table.column("m")[0].values.to_numpy()[local])


def posted(docs: DataFrame, text_col: str, width: int, n_shards: int, hot: np.ndarray) -> DataFrame:
    """(target, payload): postings to shards; hot shingles go past them to the buckets of their classes, as -1 - bucket."""
    rows = docs.select(F.col(text_col).alias("_text"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in (whole.column("_text").slice(at, BATCH_ROWS).to_pylist() for whole in batches
                      for at in range(0, whole.num_rows, BATCH_ROWS)):
            for a, b in _runs(texts):
                own: dict[int, np.ndarray] = {}
                for text in texts[a:b]:
                    found = shingle_set(text, width)
                    if len(found):
                        own.setdefault(class_key(found), found)
                if not own:
                    continue
                classes = np.fromiter(own, np.int64, len(own))
                sizes = np.fromiter(map(len, own.values()), np.int64, len(own))
                hashes, row = np.concatenate(list(own.values())), np.repeat(np.arange(len(own)), sizes)
                order = np.argsort(hashes, kind="stable")
                hashes, row = hashes[order], row[order]
                shard = (hashes % np.uint64(n_shards)).astype(np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
                    is_hot = hot[at] == hashes
                    shard[is_hot] = -1 - classes[row[is_hot]] % n_shards
                out = [(target, _postings(hashes[p], row[p], classes, sizes)) for target, p in by_shard(shard)]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int32()), pa.array([p for _, p in out], pa.binary())],
                                                 names=["target", "payload"])

    return rows.mapInArrow(releasing(post), StructType([StructField("target", IntegerType()), StructField("payload", BinaryType())]))


def _returned(hashes: np.ndarray, classes: np.ndarray, sizes: np.ndarray, counts: np.ndarray, n_buckets: int) -> pa.Table:
    """Repeated shingles back to the buckets of their classes."""
    out = []
    for bucket, p in by_shard(classes % n_buckets):
        p = p[np.lexsort((hashes[p], classes[p]))]
        out.append((bucket, pack(pa.table({"hash": pa.array([_planes(hashes[p])], pa.binary()), "class": pa.array([classes[p]], pa.list_(pa.int64())),
                                           "m": pa.array([sizes[p]], pa.list_(pa.int64())),
                                           "n": pa.array([counts[p]], pa.list_(pa.int64()))}))))
    return pa.table([pa.array([b for b, _ in out], pa.int32()), pa.array([p for _, p in out], pa.binary())], names=["bucket", "payload"])


def _count_shard(n_buckets: int):
    """Classes of every shingle of a shard; shingles of one class are dropped."""
    def count(table: pa.Table) -> pa.Table:
        target = table.column("target")[0].as_py()
        parts = [_read_postings(t) for t in unpack_all(table.column("payload"))]
        hashes, classes, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        if target < 0:
            return _returned(hashes, classes, sizes, np.full(len(hashes), HOT_CLASSES), n_buckets)
        order = np.lexsort((classes, hashes))
        hashes, classes, sizes = hashes[order], classes[order], sizes[order]
        first = np.ones(len(hashes), bool)  # a class can come from several tasks
        first[1:] = (hashes[1:] != hashes[:-1]) | (classes[1:] != classes[:-1])
        hashes, classes, sizes = hashes[first], classes[first], sizes[first]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(hashes)]]))
        counts = np.repeat(counts, counts)
        shared = counts > 1
        return _returned(hashes[shared], classes[shared], sizes[shared], counts[shared], n_buckets)
    return count


PREFIXES = StructType([StructField("class", LongType()), StructField("m", LongType()), StructField("shared", BinaryType()),
                       StructField("prefix", ArrayType(LongType()))])


def _prefixes(percent: int):
    """Per class that may have partners: its shared shingles, and those of them in its prefix."""
    def choose(table: pa.Table) -> pa.Table:
        parts = [(_from_planes(t.column("hash")[0].as_buffer()), *(t.column(c)[0].values.to_numpy() for c in ("class", "m", "n")))
                 for t in unpack_all(table.column("payload"))]
        hashes, classes, sizes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((hashes, counts, classes))
        hashes, classes, sizes, counts = hashes[order], classes[order], sizes[order], counts[order]
        first = np.ones(len(hashes), bool)  # hot shingles come once per task
        first[1:] = (hashes[1:] != hashes[:-1]) | (classes[1:] != classes[:-1])
        hashes, classes, sizes = hashes[first], classes[first], sizes[first]
        starts = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]])) if len(classes) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(classes))
        rows = []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            m = int(sizes[a])
            n_prefix = m - -(-percent * m // 100) + 1 - (m - (b - a))  # the rarest, unshared ones come first
            if n_prefix > 0:
                rows.append((int(classes[a]), m, np.sort(hashes[a:b]).tobytes(), hashes[a:a + n_prefix].astype(np.int64)))
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))],
                        names=["class", "m", "shared", "prefix"])
    return choose


def homes(prefixes: DataFrame) -> DataFrame:
    """(home, class) so that classes with a common prefix shingle have a common home."""
    posts = materialise(prefixes.select("class", F.explode("prefix").alias("shingle")), "prefix-posts")
    least = posts.groupBy("shingle").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least <> most")
    near = posts.join(least.select("shingle", "least"), "shingle")
    label = near.groupBy("class").agg(F.min("least").alias("label"))
    home = near.join(label, "class").groupBy("shingle").agg(F.min("label").alias("home"))
    return posts.join(home, "shingle").select("home", "class").distinct()


def size_band(m, percent: int):
    """Sets whose bands differ by more than one cannot link."""
    return F.floor(F.log(m.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")


def tiles(members: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """(tile, side, class): pairs of size-banded blocks of a home that can hold links.

    ``members`` has home, class and m. A home that fits one block is one tile.
    """
    band = members.withColumn("band", size_band(F.col("m"), percent))
    per_band = band.groupBy("home", "band").agg(F.sum("m").alias("n"))
    blocks = per_band.withColumn("blocks", F.ceil(F.col("n") / block_shingles).cast("int"))
    cut = band.join(blocks.select("home", "band", "blocks"), ["home", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    above = blocks.select("home", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("home", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    # A block meets every block of its own band (as the lower or the higher number) and of both neighbours.
    whole = per_band.groupBy("home").agg(F.sum("n").alias("total"))
    placed = cut.join(above, ["home", "band"], "left").join(below, ["home", "band"], "left").join(whole, "home")
    name = lambda b1, k1, b2, k2: F.struct(b1.alias("band_a"), k1.alias("block_a"), b2.alias("band_b"), k2.alias("block_b"))
    numbers = lambda n: F.when(n.isNull() | (n < 1), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 1))
    b, k = F.col("band"), F.col("block")
    single = F.array(name(F.lit(0), F.lit(0), F.lit(0), F.lit(0)))
    own = F.transform(numbers(F.col("blocks")), lambda o: name(b, F.least(k, o), b, F.greatest(k, o)))
    up = F.transform(numbers(F.col("above")), lambda o: name(b, k, b + 1, o))
    down = F.transform(numbers(F.col("below")), lambda o: name(b - 1, o, b, k))
    listed = F.when(F.col("total") <= block_shingles, single).otherwise(F.concat(own, up, down))
    return placed.select("class", F.explode(listed).alias("t"), "home", "block").select("home", "t.*", "class")


def _popcounts(rows: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows).sum(axis=1, dtype=np.int64)


def _bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    marks = np.zeros((1, bits), bool)
    marks[0, (values % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(marks, axis=1).view(np.uint64)


def tile_links(m: np.ndarray, shared: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what links connect in one tile, at most one per member: pairs of positions."""
    n = len(m)
    r = np.fromiter(map(len, shared), np.int64, n)
    # Bits for the middle set, as sets of a tile are of similar size; the shared width only weakens the bound.
    bits = 1 << max(6, int(2 * max(1, int(np.median(m)))).bit_length())
    bitmap = np.concatenate([_bitmap(s, bits) for s in shared])
    order = np.argsort(m, kind="stable")
    m, r, bitmap = m[order], r[order], bitmap[order]
    shared = [shared[i] for i in order]
    flat, ends = np.concatenate(shared), np.cumsum(r)
    label, links = np.arange(n), []
    last = np.searchsorted(m * percent, m * 100, side="right")  # partners are smaller than m / (percent / 100)
    for i in range(n - 1):
        cand = np.arange(i + 1, last[i])
        cand = cand[label[cand] != label[i]]
        if not len(cand):
            continue
        need = -(-percent * (m[i] + m[cand]) // (100 + percent))  # smallest overlap that links
        cand, need = cand[np.minimum(r[i], r[cand]) >= need], need[np.minimum(r[i], r[cand]) >= need]
        differing = _popcounts(bitmap[cand] ^ bitmap[i])
        passed = (r[i] + r[cand] - differing) // 2 >= need
        cand, need = cand[passed], need[passed]
        if not len(cand):
            continue
        values = flat[ragged(ends[cand] - r[cand], r[cand])]
        place = np.minimum(np.searchsorted(shared[i], values), r[i] - 1)
        starts = np.cumsum(r[cand]) - r[cand]
        overlap = np.add.reduceat(shared[i][place] == values, starts, dtype=np.int64)
        for j in cand[overlap >= need].tolist():
            if label[j] != label[i]:
                links.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return links


def _links(percent: int):
    def link(table: pa.Table) -> pa.Table:
        classes, at = np.unique(table.column("class").to_numpy(), return_index=True)
        m = table.column("m").to_numpy()[at]
        shared = [np.frombuffer(table.column("shared")[int(i)].as_buffer(), np.uint64) for i in at]
        least = np.arange(len(classes))  # smallest member that links reach: stars settle in few rounds later
        for i, j in tile_links(m, shared, percent) if len(classes) > 1 else []:
            least[least == max(least[i], least[j])] = min(least[i], least[j])
        joined = np.flatnonzero(least != np.arange(len(classes)))
        return pa.table([pa.array(classes[least[joined]]), pa.array(classes[joined])], names=["a", "b"])
    return link


def class_links(docs: DataFrame, sets: DataFrame, text_col: str, width: int, percent: int, *,
                shard_shingles: int = SHARD_SHINGLES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b): links between classes that connect all classes that are connected."""
    n_docs, total = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    n_shards = parts_for(total, shard_shingles)
    hot = hot_shingles(docs, n_docs, text_col, width)
    posts = posted(docs, text_col, width, n_shards, hot)
    back = posts.groupBy("target").applyInArrow(releasing_group(_count_shard(n_shards)), "bucket int, payload binary")
    alive = materialise(back.groupBy("bucket").applyInArrow(releasing_group(_prefixes(percent)), PREFIXES), "prefixes")
    members = homes(alive).join(alive.select("class", "m"), "class")
    placed = materialise(tiles(members, percent, block_shingles), "tiles")
    tile = [c for c in placed.columns if c != "class"]
    full = placed.join(alive.select("class", "m", "shared"), "class")
    return full.groupBy(*tile).applyInArrow(_links(percent), "a long, b long")


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT, **sizes) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row."""
    sets = materialise(document_sets(docs, id_col, text_col, width), "sets")
    links = class_links(docs, sets, text_col, width, percent, **sizes)
    label = components(links)
    classes = sets.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"))
    labelled = classes.join(label.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    found = labelled.join(smallest, "label").select("class", "component_id")
    return sets.join(found, "class", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def one_per_component(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row of ``docs`` per component, unchanged: the smallest id, missing ids last, and of equal ids one row.

    Rows are told apart by two hashes of all columns; of rows that are equal in all columns one stays. Rows
    without shingles are like no other and stay. The hashes of removed rows are written and counted; up
    to ``BROADCAST_REMOVED`` are sent to all tasks, beyond that both sides are shuffled.
    """
    key = F.struct(F.xxhash64(*docs.columns).alias("a"), F.xxhash64(F.lit(59), *docs.columns).alias("b"))  # no row goes with another by a collision
    hashed = docs.withColumn("_row_key", key)
    ranked = hashed.withColumn("_rank", F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.col("_row_key").alias("key")))
    found = materialise(jaccard_components(ranked, id_col="_rank", **options).select(
        F.col("_rank.key").alias("_row_key"), (F.col("_rank.key") == F.col("component_id.key")).alias("_stays"), "n_shingles"), "row-components")
    removed = materialise(found.where(~F.col("_stays")).select("_row_key").distinct(), "removed")
    stay = hashed.join(broadcast_when(removed, at_most(removed, BROADCAST_REMOVED)), "_row_key", "left_anti")
    equal = materialise(found.where(F.col("_stays") & (F.col("n_shingles") > 0)).groupBy("_row_key").agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("_row_key"), "equal-rows")
    if equal.isEmpty():
        return stay.select(*docs.columns)
    few = broadcast_when(equal, at_most(equal, BROADCAST_REMOVED))
    one = stay.join(few, "_row_key", "left_semi").groupBy("_row_key").agg(F.first(F.struct(*docs.columns)).alias("_row"))
    return stay.join(few, "_row_key", "left_anti").select(*docs.columns).unionByName(one.select("_row.*"))
