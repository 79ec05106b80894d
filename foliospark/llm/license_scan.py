"""License wording found by token automata compiled from template markup.

A template is wording with optional regions (which may be left out, and may be nested) and replaceable
regions (a bounded number of any words, or of words of a pattern). It compiles to an automaton over words;
all templates share one, determinised state by state as texts need it. A text is accepted at a word if the
mandatory wording follows there word for word; the longest accepted span is taken. Phrases are templates
without such regions, and count at every place they stand.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Texts without a word that every
template of the automaton asks for are only counted. Automata start only where a first word of a template
stands, and since no region is unbounded, every start ends after a bounded number of words.

One pass over the scan, no shuffle. Null and empty texts have no words, labels and score 0. Texts of any
length are scanned whole: a text costs its bytes, two numbers a word and its spans. Repeated rows each get
their row. Extra columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .texts import releasing

SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])  # A-Z stand in them and are lower-cased
LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c in SEPARATORS else c for c in range(256))
MARK = re.compile(r"<<(.*?)>>", re.S)
MAX_WORDS = 40  # of a replaceable region
Template = tuple[str, str]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER).split()


class Region:
    """Parsed ``var`` mark: from ``least`` to ``most`` words, each of the pattern if there is one."""

    def __init__(self, mark: str):
        fields = dict(field.split("=", 1) for field in mark.split(";")[1:])
        self.least, self.most = map(int, fields.get("words", "1-1").split("-"))
        self.match = fields.get("match")
        if not 0 <= self.least <= self.most <= MAX_WORDS:
            raise ValueError(f"a replaceable region has up to {MAX_WORDS} words: {mark}")


def parse(markup: str) -> list:
    """Words, regions, and lists of these for optional parts."""
    open_parts: list[list] = [[]]
    for i, piece in enumerate(MARK.split(markup)):
        if i % 2 == 0:
            open_parts[-1] += words_of(piece)
        elif piece.startswith("var"):
            open_parts[-1].append(Region(piece))
        elif piece.startswith("beginOptional"):
            open_parts.append([])
        elif piece == "endOptional" and len(open_parts) > 1:
            part = open_parts.pop()
            open_parts[-1].append(part)
        else:
            raise ValueError(f"mark <<{piece}>> is not understood here")
    if len(open_parts) > 1:
        raise ValueError("an optional part is not closed")
    if not open_parts[0] or not isinstance(open_parts[0][0], bytes):
        raise ValueError("a template begins with a mandatory word")
    return open_parts[0]


class TokenAutomaton:
    """Automaton of many templates; accepting states name the templates they complete."""

    def __init__(self, markups: Sequence[str]):
        self.skips: list[list[int]] = []  # states reached without a word
        self.by_word: list[dict[bytes, list[int]]] = []
        self.by_pattern: list[list[tuple[int, int]]] = []  # (pattern, state); pattern -1 takes any word
        self.patterns: list[re.Pattern] = []
        self.accepts: dict[int, int] = {}
        start = self._state()
        self.needed, self.first = [], set()
        for number, markup in enumerate(markups):
            parts = parse(markup)
            self.needed.append(max((w for w in parts if isinstance(w, bytes)), key=len))
            self.first.add(parts[0])
            begin = self._state()
            self.skips[start].append(begin)
            self.accepts[self._compile(parts, begin)] = number
        self.words = {w for edges in self.by_word for w in edges}
        self.sets: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.steps: list[dict] = []
        self.complete: list[tuple[int, ...]] = []
        self.start = self._number({start})

    def _state(self) -> int:
        self.skips.append([])
        self.by_word.append({})
        self.by_pattern.append([])
        return len(self.skips) - 1

    def _compile(self, parts: list, state: int) -> int:
        """Adds the parts after a state and returns the state behind them."""
        for part in parts:
            begin = state
            if isinstance(part, bytes):
                state = self._state()
                self.by_word[begin].setdefault(part, []).append(state)
            elif isinstance(part, list):
                state = self._compile(part, begin)
                joined = self._state()
                self.skips[begin].append(joined)
                self.skips[state].append(joined)
                state = joined
            else:
                pattern = -1
                if part.match:
                    self.patterns.append(re.compile(part.match.encode()))
                    pattern = len(self.patterns) - 1
                joined = self._state()
                for taken in range(part.most + 1):
                    if taken >= part.least:
                        self.skips[state].append(joined)
                    if taken < part.most:
                        following = self._state()
                        self.by_pattern[state].append((pattern, following))
                        state = following
                state = joined
        return state

    def _number(self, states: set[int]) -> int:
        """Number of a set of states, closed under skips."""
        todo = list(states)
        while todo:
            for other in self.skips[todo.pop()]:
                if other not in states:
                    states.add(other)
                    todo.append(other)
        key = tuple(sorted(states))
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.complete.append(tuple(self.accepts[s] for s in key if s in self.accepts))
        return self.numbers[key]

    def step(self, state: int, word: bytes) -> int:
        fits = tuple(i for i, p in enumerate(self.patterns) if p.fullmatch(word))
        kind = (word if word in self.words else None, fits)  # words that no template names are alike
        following = self.steps[state].get(kind)
        if following is None:
            found = set()
            for s in self.sets[state]:
                found.update(self.by_word[s].get(word, ()))
                found.update(to for pattern, to in self.by_pattern[s] if pattern < 0 or pattern in fits)
            following = self.steps[state][kind] = self._number(found) if found else -1
        return following

    def ends_from(self, word_at: Callable[[int], bytes], start: int, n_words: int) -> dict[int, int]:
        """Template to the last word of its longest accepted span that starts at a word."""
        state, at, ends = self.start, start, {}
        while at < n_words:
            state = self.step(state, word_at(at))
            if state < 0:
                break
            for template in self.complete[state]:
                ends[template] = at
            at += 1
        return ends


@lru_cache(maxsize=4)
def automaton(markups: tuple[str, ...]) -> tuple[TokenAutomaton, re.Pattern]:
    """The automaton and a pattern of its first words, once per Python worker."""
    made = TokenAutomaton(markups)
    first = b"|".join(sorted(map(re.escape, made.first)))
    return made, re.compile(rb"(?<![^ ])(?:" + first + rb")(?![^ ])")


def spans(text: str | None, markups: tuple[str, ...]) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words, and (template, first word, last word) of every accepted start."""
    made, first = automaton(markups)
    plain = (text or "").encode().translate(LOWER)
    inside = np.frombuffer(plain, np.uint8) != 32
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if len(plain) else np.zeros(0, np.int64)
    if not any(word in plain for word in set(made.needed)):
        return len(starts), []
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1

    def word_at(i: int) -> bytes:
        return plain[starts[i]:ends[i]]

    found = []
    for match in first.finditer(plain):
        at = int(np.searchsorted(starts, match.start()))
        found += [(template, at, last) for template, last in made.ends_from(word_at, at, len(starts)).items()]
    return len(starts), found


SPAN = StructType([StructField("label", StringType()), StructField("kind", StringType()),
                   StructField("first_word", LongType()), StructField("last_word", LongType())])


def license_spans(docs: DataFrame, phrases: Sequence[Template], templates: Sequence[Template], *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words`` and ``spans`` (label, phrase or template, first and last word) of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType
    schema = StructType([StructField(id_col, kind), StructField("n_words", LongType()), StructField("spans", ArrayType(SPAN))])
    markups = tuple(markup for _, markup in [*phrases, *templates])
    names = [(label, "phrase") for label, _ in phrases] + [(label, "template") for label, _ in templates]
    automaton(markups)  # refuses bad markup before the job starts
    id_type, span_type = to_arrow_type(kind), pa.list_(to_arrow_type(SPAN))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column(1):
                n_words, here = spans(text.as_py(), markups)
                counts.append(n_words)
                found.append([(*names[t], first, last) for t, first, last in here])
            lists = [[dict(zip(("label", "kind", "first_word", "last_word"), s, strict=True)) for s in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(counts, pa.int64()), pa.array(lists, span_type)],
                                             names=[id_col, "n_words", "spans"])

    return rows.mapInArrow(releasing(scan), schema)


def license_report(docs: DataFrame, phrases: Sequence[Template], templates: Sequence[Template], *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: places of phrases, labels of phrases, labels of both, and the share of labels whose whole wording stands."""
    found = license_spans(docs, phrases, templates, id_col=id_col, text_col=text_col)
    base = F.filter("spans", lambda s: s["kind"] == "phrase")
    proven = F.array_distinct(F.transform(F.filter("spans", lambda s: s["kind"] == "template"), lambda s: s["label"]))
    labels = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["label"])))
    places = F.transform("base", lambda s: s["first_word"])
    parts = found.withColumn("base", base).withColumn("proven", proven).withColumn("all_labels", labels)
    return parts.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda s: s["label"]))), ",").alias("base_labels"),
        F.array_join("all_labels", ",").alias("labels"),
        F.when(F.size("all_labels") > 0, F.size("proven") / F.size("all_labels")).otherwise(0.0).cast(DoubleType()).alias("score"))
