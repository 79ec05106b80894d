"""Cheapest repair of the turn structure of conversations.

A repaired conversation has role initials ``(s?(ua)+)?``: an optional system turn, then user and
assistant in turns. Rows may be kept (0), given the role user or assistant (1) or deleted (2); empty
user or assistant rows may be inserted anywhere (5). Blank and repeated rows must go, and a row whose
text breaks off costs 5 more unless it is deleted. Among the cheapest edits the ASCII-least sequence
of their initials D, I, K, R is taken.

Conversations are streamed, never gathered. Rows are dealt by conversation and sorted by turn, twice:

1. Rows without their texts run *backwards* through ``mapInPandas``, which carries the least cost to
   the end from each of the four structure states across Arrow batches. The best edit of a row in
   every state is a backpointer of one byte. Backpointers leave the task in strings of bounded length
   as rows of their own: they go through Spark's shuffle and not to a local file, so a lost executor
   costs a recomputation and a giant conversation no memory.
2. Rows with their texts run *forwards*, every string of backpointers sorted before the first row it
   belongs to. The state chooses the edit out of each byte; repaired rows leave one after another.

A conversation is one task's stream whatever its length, since its repaired rows have one order. A task
holds one batch, one string of backpointers, and for digests the edits' initials (one byte a row).

Order: turn (nulls first), then role, then the text's SHA-256; equal rows are interchangeable and the
later ones count as repeats. A null role, text, conversation or turn reads as one space where text is
made of it (so a null text is blank); null conversations are one conversation. ``copies_col`` may say how
often a row stands at its place. Roles are told apart by
their first character alone, an empty role fits nowhere. Empty texts are blank, texts of any length are
one value. Other columns are ignored, so names cannot clash. An empty table gives an empty result; a
conversation without rows (all dropped) is still reported, with zeros.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
DELETE, RESTORE, INSERT = 2, 1, 5
TRUNCATED = 5
CHUNK_ROWS = 1 << 16  # backpointers in one string
RUNS_OUT = 1 << 12  # rows of one outgoing batch
RUN_CHARS = 8 << 20  # or texts of this length
LETTERS = "DIKR"
ROLE_OF = ("user", "user", "assistant", "user")  # what may be inserted or set in a state
NEXT = (2, 2, 3, 2)  # the state after that
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state after a kept row; states: nothing yet, s, u, a
AT_END = (0, 10, 5, 0)  # insertions that complete a conversation
LEGAL = {"su", "ua", "au"}
NOWHERE = (False, 0, "", b"")  # turn, role and digest of a conversation without rows


def edits_before(initial: str, must_go: bool, truncated: bool, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Least cost to the end from every state before a row, and the edit of each state (two bits each)."""
    extra = TRUNCATED if truncated else 0
    options = []
    for state in range(4):
        ways = [(DELETE + after[state], 0)]
        if not must_go:
            if initial in KEPT[state]:
                ways.append((extra + after[KEPT[state][initial]], 2))
            ways.append((RESTORE + extra + after[NEXT[state]], 3))
        options.append(ways)
    least = [min(ways)[0] for ways in options]
    two, three = min(least[2], INSERT + least[3]), min(least[3], INSERT + least[2])
    least[0], least[1], least[2], least[3] = min(least[0], INSERT + two), min(least[1], INSERT + two), two, three
    byte = 0
    for state, ways in enumerate(options):
        best = least[state]
        letter = min([edit for cost, edit in ways if cost == best] + ([1] if INSERT + least[NEXT[state]] == best else []))
        byte |= letter << (2 * state)
    return tuple(least), byte


def _read(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies_col: str | None) -> DataFrame:
    """Own names and no nulls: key (null-safe by ``has_conv``), turn, role, text, copies (0: dropped, 2: repeated at once)."""
    def string(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    copies = F.col(copies_col) if copies_col else F.lit(1)
    return rows.select(string(conv).alias("conv"), F.col(conv).isNotNull().alias("has_conv"), F.col(turn).isNotNull().alias("has_turn"),
                       F.coalesce(F.col(turn), F.lit(0)).cast("long").alias("turn"), string(role).alias("role"),
                       string(text).alias("text"), copies.cast("int").alias("copies"))


def damaged(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults planted by the hash of ``conv:turn`` modulo 20; ``copies`` is 0 for dropped and 2 for repeated ones."""
    own = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return own.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                      F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                      F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


ORDER = ["has_conv", "conv", "has_turn", "turn", "role", "digest", "seq"]
POINTERS = ("conv string, has_conv boolean, has_turn boolean, turn long, role string, digest binary, seq long, pointers binary, "
            "gaps long, blank long, duplicate long, truncated long, illegal long, cost long")


def _backwards(rows: DataFrame) -> DataFrame:
    """Strings of backpointers and, with the first of a conversation, its counts and cost."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = rows.select("conv", "has_conv", "has_turn", "turn", "role", "copies", F.unhex(F.sha2("text", 256)).alias("digest"),
                        F.substring("role", 1, 1).alias("initial"), (trimmed == "").alias("blank"),
                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("broken"))
    same = Window.partitionBy("has_conv", "conv").orderBy("role", "digest", (F.col("copies") > 0).desc(), "has_turn", "turn")
    seen = (F.col("copies") > 0) & F.coalesce((F.lag("role").over(same) == F.col("role")) & (F.lag("digest").over(same) == F.col("digest")), F.lit(False))
    # Of equal rows the first is the one not seen before: it comes last in this backward order.
    placed = light.withColumn("seen", seen).sortWithinPartitions("has_conv", "conv", *map(F.desc, ORDER[2:-1]), F.desc("seen"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, out = None, []
        costs, held, chunk, first = AT_END, bytearray(), 0, None
        counts, turns, last_turn, ends, follower = {}, 0, None, [], None

        def row(last: bool):
            found = (max(0, ends[1] - ends[0] + 1 - turns) if ends else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                     counts["illegal"], costs[0]) if last else (None,) * 6
            return (key[1], key[0], *(first or NOWHERE), -chunk, bytes(reversed(held)), *found)

        def frame():
            return pd.DataFrame(out, columns=_names(POINTERS)).astype({c: "Int64" for c in COUNTS})

        for batch in batches:
            for conv, has_conv, has_turn, turn, role, copies, digest, initial, blank, broken, seen in zip(*(batch[c] for c in BACKWARD), strict=True):
                if (has_conv, conv) != key:
                    if key is not None:
                        out.append(row(True))
                    key = (has_conv, conv)
                    costs, held, chunk, first = AT_END, bytearray(), 1, None
                    counts, turns, last_turn, ends, follower = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), 0, None, [], None
                for copy in range(copies - 1, -1, -1):
                    again = bool(seen or copy)
                    fault = "blank" if blank else "duplicate" if again else "truncated" if broken else None
                    if fault:
                        counts[fault] += 1
                    if follower is not None and initial + follower not in LEGAL:
                        counts["illegal"] += 1
                    follower = initial
                    costs, byte = edits_before(initial, blank or again, fault == "truncated", costs)
                    if len(held) == CHUNK_ROWS:
                        out.append(row(False))
                        held, chunk = bytearray(), chunk + 1
                    held.append(byte)
                    first = (has_turn, turn, role, digest)
                if copies and has_turn:
                    turns += turn != last_turn
                    last_turn = turn
                    ends = [turn, ends[1] if ends else turn]
            if len(out) >= RUNS_OUT or sum(len(r[7]) for r in out) >= RUN_CHARS:
                yield frame()
                out = []
        if key is not None:
            out.append(row(True))
        if out:
            yield frame()

    return placed.select(*BACKWARD).mapInPandas(scan, POINTERS)


BACKWARD = ["conv", "has_conv", "has_turn", "turn", "role", "copies", "digest", "initial", "blank", "broken", "seen"]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
REPAIRED = ("conv string, has_conv boolean, position long, edit string, role string, text string, "
            "gaps long, blank long, duplicate long, truncated long, illegal long, cost long")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _forwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits in order; position 0 of a conversation holds its counts, deleted rows have no role and text."""
    key, out, chars = None, [], 0
    state, position, strings, at = 0, 0, deque(), 0
    none = (None,) * len(COUNTS)

    def edit(letter: str, role: str | None = None, text: str | None = None):
        nonlocal position
        position += 1
        out.append((key[1], key[0], position, letter, role, text, *none))

    def insert():
        nonlocal state
        edit("I", ROLE_OF[state], "")
        state = NEXT[state]

    def finish():
        while key is not None and state in (1, 2):
            insert()

    def frame():
        return pd.DataFrame(out, columns=_names(REPAIRED)).astype({c: "Int64" for c in COUNTS})

    for batch in batches:
        for conv, has_conv, role, text, copies, pointers, *counts in zip(*(batch[c] for c in FORWARD), strict=True):
            if (has_conv, conv) != key:
                finish()
                key, state, position, strings, at = (has_conv, conv), 0, 0, deque(), 0
            if pointers is not None:
                if len(pointers):
                    strings.append(pointers)
                if not pd.isna(counts[-1]):
                    out.append((conv, has_conv, 0, "", None, None, *map(int, counts)))
                continue
            for _ in range(copies):
                if at == len(strings[0]):
                    strings.popleft()
                    at = 0
                byte = strings[0][at]
                at += 1
                while (letter := LETTERS[byte >> (2 * state) & 3]) == "I":
                    insert()
                if letter == "D":
                    edit("D")
                elif letter == "K":
                    edit("K", role, text)
                    state = KEPT[state][role[0]]
                else:
                    edit("R", ROLE_OF[state], text)
                    state = NEXT[state]
            chars += len(text)
            if len(out) >= RUNS_OUT or chars >= RUN_CHARS:
                yield frame()
                out, chars = [], 0
    finish()
    if out:
        yield frame()


FORWARD = ["conv", "has_conv", "role", "text", "copies", "pointers", *COUNTS]


def repaired_turns(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """Every edit in order: (conv, has_conv, position, edit, role, text), and at position 0 the counts of the conversation.

    Deleted rows have a null role and text; what has a role is the repaired conversation. The rows of a
    partition come conversation by conversation, in order.
    """
    own = _read(rows, conv_col, turn_col, role_col, text_col, copies_col)
    texts = own.where("copies > 0").select("conv", "has_conv", "has_turn", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
                                           F.lit(1).cast("long").alias("seq"), "text", "copies", F.lit(None).cast("binary").alias("pointers"),
                                           *[F.lit(None).cast("long").alias(c) for c in COUNTS])
    pointers = _backwards(own).select("conv", "has_conv", "has_turn", "turn", "role", "digest", "seq", F.lit("").alias("text"),
                                      F.lit(0).alias("copies"), "pointers", *COUNTS)
    together = texts.unionByName(pointers).repartition("has_conv", "conv").sortWithinPartitions(*ORDER)
    return together.select(*FORWARD).mapInPandas(_forwards, REPAIRED)


REPORT = ("conv string, has_conv boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, head, audit, sha, started, out = None, None, bytearray(), hashlib.sha256(), False, []

    def row():
        return (key[1], key[0], *head, audit.decode(), sha.hexdigest())

    for batch in batches:
        for conv, has_conv, position, letter, role, text, *counts in zip(*(batch[c] for c in _names(REPAIRED)), strict=True):
            if position == 0:
                if key is not None:
                    out.append(row())
                key, head, audit, sha, started = (has_conv, conv), tuple(map(int, counts)), bytearray(), hashlib.sha256(), False
                continue
            audit += letter.encode()
            if role is not None:
                sha.update(f"{chr(10) if started else ''}{role}:{text}".encode())
                started = True
        if len(out) >= RUNS_OUT:
            yield pd.DataFrame(out, columns=_names(REPORT))
            out = []
    if key is not None:
        out.append(row())
    if out:
        yield pd.DataFrame(out, columns=_names(REPORT))


def repair_report(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """One row per conversation: ``conv_col``, counts of faults, cost, the edits' initials and the repaired rows' SHA-256.

    Reads the rows of ``repaired_turns`` in the partitions it leaves them in, without another shuffle.
    """
    kind = rows.schema[conv_col].dataType
    turns = repaired_turns(rows, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col, copies_col=copies_col)
    report = turns.mapInPandas(_digests, REPORT)
    return report.select(F.when(F.col("has_conv"), F.col("conv").cast(kind)).alias(conv_col), *_names(REPORT)[2:])
