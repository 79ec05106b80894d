"""Cells of a vector table with radius bounds: which of them a question has to visit, exactly.

Stored vectors are assigned once to the nearest of a bounded number of pivots. A cell keeps the largest
angle between its pivot and a member. A question first searches one part of its nearest cell, which gives
it a floor: the score its k-th best has at least. By the triangle inequality no member of a cell scores
above ``cos(angle to the pivot - radius)``; cells where that is below the floor are skipped.

Neighbouring cells are packed until they fill a task. Questions travel to the packs that hold a cell they
visit, once to each with a bit per cell; the corpus is dealt by pack once per pass and slice.
A pack with very many members (copies fall into one cell) is cut into parts by a hash of the id, and very many
questions into slices, each of which meets every part. A task is dealt one part and one slice, no more, and reads the
questions in batches after the part, so neither many members nor many questions need memory, in the sort
before the task either; it only meets the cells that some of the questions at hand visit. There are two packs a
core, more where their rows would not fit a task: so often a question travels at most, however many cells there are. Where angles tell little (vectors without clusters) most cells are visited and the
search is the plain blocked product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .similarity import BLOCK_ROWS, BROADCAST_VALUES, MATCHES, QUESTION_ROWS, Rules, Search, Vectors

MAX_PIVOTS = 1024
PART_VALUES = 8_000_000  # numbers of the members a task holds (64 MB)
SLICE_VALUES = 16_000_000  # numbers of the questions dealt to a task (128 MB)
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1.5e-6  # rounding of scores and of angles near zero
ASSIGNED = "cell int, angle double, id long, vector array<double>, grp long"


@dataclass
class Cells:
    """An index of a corpus: pivots, radius, pack and parts of every cell, and the members as a written table."""

    pivots: np.ndarray
    radius: np.ndarray
    pack: np.ndarray
    parts: np.ndarray  # of the cell's pack; 0 for an empty cell
    members: DataFrame  # cell, id, vector, grp

    @property
    def used(self) -> np.ndarray:
        return np.flatnonzero(self.parts)


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def build_cells(corpus: DataFrame, block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS) -> Cells:
    """Index of a corpus (id, vector, grp); rows without a usable vector are left out, as they have no score.

    Pivots are the square root of the row count in number (``max_pivots`` at most), the vectors with the
    smallest id hashes.
    """
    usable = corpus.where(F.size("vector") > 0)
    first = usable.select(F.size("vector")).first()
    wanted = min(max_pivots, max(1, BROADCAST_VALUES // (first[0] if first else 1)), max(1, math.isqrt(corpus.count())))
    pivots = Vectors.from_arrow(usable.orderBy(F.xxhash64("id"), "id").limit(wanted).toArrow()).unit

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Vectors.from_arrow(batch)
            if not len(rows.ids):
                continue
            for piece in rows.pieces(8192):
                angles = _angles(piece.unit, pivots)
                cell = angles.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell]), pa.array(piece.ids),
                     _lists(piece.unit), pa.array(piece.group)], names=["cell", "angle", "id", "vector", "grp"])

    if not len(pivots):
        pivots = np.zeros((0, 1))
        empty = corpus.sparkSession.createDataFrame([], ASSIGNED).drop("angle")
        return Cells(pivots, np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), empty)
    members = materialise(corpus.mapInArrow(assign, ASSIGNED), "cells")
    radius, sizes = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for row in members.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # a row per pivot
        radius[row.cell], sizes[row.cell] = row.radius, row.n
    tasks = 2 * corpus.sparkSession.sparkContext.defaultParallelism
    pack, parts = _packs(pivots, sizes, max(1, min(block_rows, PART_VALUES // pivots.shape[1], -(-int(sizes.sum()) // tasks))))
    return Cells(pivots, radius, pack, parts, members.drop("angle"))


def _packs(pivots: np.ndarray, sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Pack of every cell, and the parts of that pack: chains of near cells of at most ``rows`` members, or one larger cell."""
    near, left, at = pivots @ pivots.T, sizes > 0, int(sizes.argmax())
    pack, filled = np.zeros(len(sizes), np.int64), [0]
    while left.any():
        if filled[-1] and filled[-1] + sizes[at] > rows:
            filled.append(0)
        pack[at], left[at] = len(filled) - 1, False
        filled[-1] += int(sizes[at])
        at = int(np.where(left, near[at], -np.inf).argmax())
    return pack, np.where(sizes > 0, -(-np.array(filled)[pack] // rows), 0)


def _lists(matrix: np.ndarray) -> pa.Array:
    sizes = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(matrix.ravel()))


ROUTED = "id long, vector array<double>, grp long, cell int, visits binary, packs array<int>, n_cells int"


def _routed(questions: DataFrame, cells: Cells, floors: DataFrame | None, n_rules: int) -> DataFrame:
    """Questions with the cells they visit (a bit for each that is used) and the packs of these: the nearest one, or all that
    their floors leave. ``cell`` is the nearest."""
    pivots, radius, used = cells.pivots[cells.used], cells.radius[cells.used], cells.used
    packs, seeded = cells.pack[used], floors is not None
    of_pack = np.argsort(packs, kind="stable")
    own, first = np.unique(packs[of_pack], return_index=True)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            floor = dict(zip(table["id"].to_pylist(), table["floors"].to_pylist(), strict=True)) if seeded else {}
            for piece in Vectors.from_arrow(table).pieces(2048):
                angles = _angles(piece.unit, pivots)
                nearest = angles.argmin(axis=1)
                if not seeded:
                    visits = np.arange(len(used)) == nearest[:, None]
                else:
                    bound = np.cos(np.maximum(0.0, angles - radius - ANGLE_SLACK)) + SCORE_SLACK
                    lowest = np.array([min(floor[i]) if floor[i] and len(floor[i]) == n_rules else -np.inf for i in piece.ids.tolist()])
                    visits = bound >= lowest[:, None]
                row, col = np.nonzero(np.logical_or.reduceat(visits[:, of_pack], first, axis=1))
                ends = np.searchsorted(row, np.arange(len(visits) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece.ids), _lists(piece.unit), pa.array(piece.group), pa.array(used[nearest].astype(np.int32)),
                     pa.array([bits.tobytes() for bits in np.packbits(visits, axis=1)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(own[col].astype(np.int32))), pa.array(visits.sum(axis=1).astype(np.int32))],
                    names=["id", "vector", "grp", "cell", "visits", "packs", "n_cells"])

    if seeded:
        questions = questions.join(floors, "id", "left")
    return questions.mapInArrow(route, ROUTED)


def _parts_of(cells: Cells):
    """Parts of a pack, by the ``pack`` column."""
    parts = np.zeros(int(cells.pack.max()) + 1, np.int64)
    parts[cells.pack[cells.used]] = cells.parts[cells.used]
    return F.element_at(F.lit(parts.tolist()), F.col("pack") + 1)


def _blocks(held: list[pa.Table]) -> list[tuple[int, Vectors]]:
    """Members of one part by cell."""
    rows = pa.concat_tables(held)
    cell = rows["cell"].to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
    return [(int(cell[low]), Vectors.from_arrow(rows.slice(low, high - low))) for low, high in zip(cuts, cuts[1:])]


def _found(rows: pa.Table, blocks: list[tuple[int, Vectors]], used: np.ndarray, rules: Sequence[Rules]) -> Iterator[pa.RecordBatch]:
    """Best matches of questions in the blocks of the cells they visit; questions of one nearest cell follow one another."""
    places = np.searchsorted(used, [cell for cell, _ in blocks])
    for low in range(0, rows.num_rows, QUESTION_ROWS):
        piece = rows.slice(low, QUESTION_ROWS)
        bits = np.frombuffer(b"".join(piece["visits"].to_pylist()), np.uint8).reshape(piece.num_rows, -1)
        wanted = np.unpackbits(np.bitwise_or.reduce(bits, axis=0)).astype(bool)[places]
        search = Search(Vectors.from_arrow(piece), rules)
        for visited, (_, block) in zip(wanted, blocks, strict=True):
            if visited:
                search.add(block)
        yield from search.matches()


def _dealt(questions: DataFrame, cells: Cells, n_slices: int) -> DataFrame:
    """Members (side 0) and questions (side 1), a task for every part of a pack and slice of the questions."""
    first = np.unique(cells.pack[cells.used], return_index=True)[1]
    parts = np.zeros(int(cells.pack.max()) + 1, np.int64)
    parts[cells.pack[cells.used][first]] = cells.parts[cells.used][first]
    before = F.element_at(F.lit((np.cumsum(parts) - parts).tolist()), F.col("pack") + 1)
    packed = cells.members.withColumn("pack", F.element_at(F.lit(cells.pack.tolist()), F.col("cell") + 1).cast("int"))
    members = packed.select("pack", F.pmod(F.xxhash64("id"), _parts_of(cells)).cast("int").alias("part"), F.lit(0).alias("side"),
                            "cell", F.lit(None).cast("binary").alias("visits"), "id", "vector", "grp",
                            (F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))) if n_slices > 1 else F.lit(0)).alias("slice"))
    asked = questions.select("pack", "part", F.lit(1).alias("side"), "cell", "visits", "id", "vector", "grp",
                             F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(n_slices)).cast("int").alias("slice"))
    task = ((before + F.col("part")) * n_slices + F.col("slice")).cast("int")
    return members.unionByName(asked).repartitionById(int(parts.sum()) * n_slices, task).drop("slice").sortWithinPartitions(
        "pack", "part", "side", "cell")


def _meet(questions: DataFrame, cells: Cells, rules: Sequence[Rules], n_slices: int) -> DataFrame:
    """Best matches of questions (pack, part, cell, visits, id, vector, grp) in the parts they visit."""
    used, dealt = cells.used, _dealt(questions, cells, n_slices)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, blocks = None, [], None
        for batch in batches:
            place = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(place)], strict=True):
                if low == high:
                    continue
                rows = pa.Table.from_batches([batch.slice(low, high - low)])
                if key != (place[low, 0], place[low, 1]):
                    key, held, blocks = (place[low, 0], place[low, 1]), [], None
                if place[low, 2] == 0:
                    held.append(rows)
                    continue
                if blocks is None:
                    blocks, held = _blocks(held) if held else [], []
                yield from _found(rows, blocks, used, rules)

    return dealt.mapInArrow(meet, MATCHES)


def search_cells(questions: DataFrame, cells: Cells, rules: Sequence[Rules]) -> tuple[DataFrame, DataFrame]:
    """Matches (rule, question_id, doc_id, score), the best of a question among them, and the visits (id, n_cells) of each question."""
    if not len(cells.used):
        spark = questions.sparkSession
        return spark.createDataFrame([], MATCHES), spark.createDataFrame([], "id long, n_cells int")
    n_slices = max(1, -(-questions.count() * cells.pivots.shape[1] // SLICE_VALUES))
    nearest = _routed(questions, cells, None, len(rules)).withColumn("pack", F.get("packs", 0))
    one_part = nearest.withColumn("part", F.pmod(F.xxhash64("id"), _parts_of(cells)).cast("int"))
    wanted = F.element_at(F.lit([rule.k for rule in rules]), F.col("rule") + 1)
    seeds = _meet(one_part, cells, rules, n_slices).groupBy("question_id", "rule").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = seeds.where(F.col("n") >= wanted).groupBy(F.col("question_id").alias("id")).agg(F.collect_list("floor").alias("floors"))  # one a rule
    routed = materialise(_routed(questions, cells, floors, len(rules)), "routes")
    visits = routed.withColumn("pack", F.explode("packs")).withColumn("part", F.explode(F.sequence(F.lit(0), _parts_of(cells).cast("int") - 1)))
    return _meet(visits, cells, rules, n_slices), routed.select("id", "n_cells")


def skipped_share(visits: DataFrame, cells: Cells) -> float:
    """Share of (question, cell) pairs that were not visited."""
    n, visited = visits.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_cells"), F.lit(0))).first()
    return 1.0 - visited / (n * len(cells.used)) if n and len(cells.used) else 0.0
