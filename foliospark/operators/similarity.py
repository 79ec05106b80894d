"""Exact top-k similarity search as blocked matrix products.

Corpus rows meet questions inside NumPy, but only the best ``k`` per question and task leave a task, so
no table of all pairs ever exists. Questions are sent to the tasks when their measured size is small;
beyond that they are routed to the cells of the corpus that can hold one of their best (``cells``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_VALUES = 4_000_000      # numbers in the broadcast question matrix (32 MB)
BLOCK_ROWS = 100_000              # corpus rows a task holds at most
QUESTION_ROWS, DOC_ROWS = 512, 8192  # one product inside a task
DIGITS = 6
MATCHES = "rule int, question_id long, doc_id long, score double"


@dataclass
class Vectors:
    ids: np.ndarray
    unit: np.ndarray
    group: np.ndarray

    @classmethod
    def from_arrow(cls, table) -> Vectors:
        """Rows with a usable vector in id order, scaled to length one; zero and missing vectors have no score."""
        if isinstance(table, pa.RecordBatch):
            table = pa.Table.from_batches([table])
        table = table.filter(pc.is_valid(table["vector"])).combine_chunks()
        ids = table["id"].to_numpy()
        if not len(ids):
            return cls(ids.astype(np.int64), np.zeros((0, 0)), ids.astype(np.int64))
        widths = pc.unique(pc.list_value_length(table["vector"]))
        if len(widths) != 1:
            raise ValueError(f"vectors of different widths: {widths.to_pylist()}")
        flat = pc.list_flatten(table["vector"]).to_numpy().astype(np.float64)
        matrix = flat.reshape(len(ids), -1)
        length = np.sqrt((matrix * matrix).sum(axis=1))
        order = np.argsort(ids, kind="stable")
        order = order[length[order] > 0]
        return cls(ids[order], matrix[order] / length[order, None], table["grp"].to_numpy()[order])

    def pieces(self, rows: int) -> Iterator[Vectors]:
        for i in range(0, len(self.ids), rows):
            yield Vectors(self.ids[i:i + rows], self.unit[i:i + rows], self.group[i:i + rows])


@dataclass
class Rules:
    k: int
    exclude_self: bool = False
    group: str | None = None

    def allowed(self, questions: Vectors, docs: Vectors) -> np.ndarray | None:
        mask = None
        if self.exclude_self:
            mask = questions.ids[:, None] != docs.ids[None, :]
        if self.group:
            same = questions.group[:, None] == docs.group[None, :]
            rule = same if self.group == "same" else ~same
            mask = rule if mask is None else mask & rule
        return mask


class Best:
    """Best matches so far of a few questions, ordered by rounded score and then by lower id."""

    def __init__(self, questions: Vectors, rules: Rules):
        self.questions, self.rules = questions, rules
        self.row, self.score, self.doc = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def floor(self) -> np.ndarray:
        """Score a document needs to matter: the k-th best so far, column-shaped."""
        counts = np.bincount(self.row, minlength=len(self.questions.ids))
        out, full = np.full(len(counts), -np.inf), counts >= self.rules.k
        out[full] = self.score[np.cumsum(counts)[full] - 1]
        return out[:, None]

    def add(self, docs: Vectors, scores: np.ndarray) -> None:
        k = self.rules.k
        mask = self.rules.allowed(self.questions, docs)
        if mask is not None:
            scores = np.where(mask, scores, -np.inf)
        keep = (scores >= self.floor()) & (scores > -np.inf)
        if scores.shape[1] > k and np.count_nonzero(keep) > 4 * k * len(scores):
            # All above the k-th score, and of those equal to it the lowest ids: at most k per question,
            # however many copies of a document there are.
            level_score = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
            above, level = scores > level_score, scores == level_score
            keep &= above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        row, col = np.nonzero(keep)
        if not len(row):
            return
        row, score, doc = (np.concatenate(pair) for pair in (
            (self.row, row), (self.score, scores[row, col]), (self.doc, docs.ids[col])))
        order = np.lexsort((doc, -score, row))
        row = row[order]
        first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
        self.row, self.score, self.doc = row[first], score[order][first], doc[order][first]


class Search:
    """All questions against a stream of document batches, in products of bounded size; every rule keeps its own best."""

    def __init__(self, questions: Vectors, rules: Sequence[Rules]):
        self.best = [[Best(part, rule) for rule in rules] for part in questions.pieces(QUESTION_ROWS)]

    def add(self, docs: Vectors) -> None:
        for part in docs.pieces(DOC_ROWS):
            for bests in self.best:
                scores = np.round(bests[0].questions.unit @ part.unit.T, DIGITS) + 0.0
                for best in bests:
                    best.add(part, scores)

    def matches(self) -> Iterator[pa.RecordBatch]:
        for bests in self.best:
            for number, best in enumerate(bests):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.row), number, np.int32)), pa.array(best.questions.ids[best.row]), pa.array(best.doc),
                     pa.array(best.score)], names=["rule", "question_id", "doc_id", "score"])


def _side(df: DataFrame, key: str, vector: str, group: str | None) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"),
                     (F.col(group) if group else F.lit(0)).cast("long").alias("grp"))


def top_k_similar(questions: DataFrame, corpus: DataFrame, k: int, *, question_id: str = "question_id",
                  doc_id: str = "doc_id", vector: str = "vector", exclude_self: bool = False,
                  group: str | None = None, group_rule: str | None = None,
                  broadcast_values: int = BROADCAST_VALUES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(question_id, doc_id, score, rank) of the ``k`` corpus rows with the highest cosine.

    Ids are whole numbers and unique per side. Scores are rounded to six digits before ranking;
    equal scores rank by lower id. ``group_rule`` "same" or "other" compares only rows whose
    ``group`` value equals, or differs from, the question's.
    """
    return top_k_by_rule(questions, corpus, [Rules(k, exclude_self, group_rule)], question_id=question_id, doc_id=doc_id, vector=vector,
                         group=group, broadcast_values=broadcast_values, block_rows=block_rows).drop("rule")


def top_k_by_rule(questions: DataFrame, corpus: DataFrame, rules: Sequence[Rules], *, question_id: str = "question_id",
                  doc_id: str = "doc_id", vector: str = "vector", group: str | None = None,
                  broadcast_values: int = BROADCAST_VALUES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The same for several rules in one search; ``rule`` is the rule's number."""
    from .cells import build_cells, search_cells

    q, c = _side(questions, question_id, vector, group), _side(corpus, doc_id, vector, group)
    sample = q.where(F.size("vector") > 0).select(F.size("vector")).first()  # all vectors share one width
    most = max(1, broadcast_values // (sample[0] if sample else 1))
    small = q.limit(most + 1).toArrow()
    found = (_search_broadcast(Vectors.from_arrow(small), c, rules) if small.num_rows <= most
             else search_cells(q, build_cells(c, block_rows), rules)[0])
    order = Window.partitionBy("rule", "question_id").orderBy(F.desc("score"), "doc_id")
    most_wanted = F.element_at(F.lit([rule.k for rule in rules]), F.col("rule") + 1)
    return found.withColumn("rank", F.row_number().over(order)).where(
        (F.col("rank") <= max(rule.k for rule in rules)) & (F.col("rank") <= most_wanted))


def _search_broadcast(questions: Vectors, corpus: DataFrame, rules: Sequence[Rules]) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(questions)  # at most BROADCAST_VALUES numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, rules)
        for batch in batches:
            search.add(Vectors.from_arrow(batch))
        yield from search.matches()

    return corpus.mapInArrow(scan, MATCHES)  # one task per split of the corpus, each hands on k matches per question
