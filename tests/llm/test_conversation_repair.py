"""Conversation repair against a plain search over all edit sequences."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from foliospark.llm import conversation_repair
from foliospark.llm.conversation_repair import damaged, repair_report, repaired_turns
from foliospark.llm.queries_conversations import op12

FOLDER = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain_repair(rows, every=False):
    """Report of one conversation's rows: the least (cost, initials) over sequences of edits; ``every``: without pruning."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(BLANK)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    # Edit sequences in the order of (cost, initials), until one leaves a legal conversation.
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, shape, kept = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            break
        node = (i, shape[-1:])
        if (node in done and not every) or not re.fullmatch("(s?(ua)*u?)?", shape) or len(shape) > 2 * len(rows) + 3:
            continue
        done.add(node)
        for role in ("user", "assistant"):
            heapq.heappush(queue, (cost + 5, audit + "I", i, shape + role[0], (*kept, (role, ""))))
        if i == len(rows):
            continue
        _, _, role, text = rows[i]
        heapq.heappush(queue, (cost + 2, audit + "D", i + 1, shape, kept))
        if faults[i] not in ("blank", "duplicate"):
            extra = 5 if faults[i] == "truncated" else 0
            if role:
                heapq.heappush(queue, (cost + extra, audit + "K", i + 1, shape + role[0], (*kept, (role, text))))
            for other in ("user", "assistant"):
                heapq.heappush(queue, (cost + extra + 1, audit + "R", i + 1, shape + other[0], (*kept, (other, text))))
    initials = [r[2][:1] for r in rows]
    turns = {r[1] for r in rows if r[1] is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def expected(rows, damage=plain_damage):
    convs = {r[0]: [] for r in rows}
    for row in damage(rows):
        convs[row[0]].append(row)
    return {conv: plain_repair(own, every=len(own) < 4) for conv, own in convs.items()}


def made_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 8)):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
                text = rng.choice(["Yes.", "No!", "open", "", " \n", None, "Ja. \t", "é?", f"t{turn}.", f"t{turn}"])
                place = rng.choice([turn, turn, turn, 2 * turn, None])
                rows += [(conv if conv else None, place, role, text)] * rng.choice([1, 1, 1, 2])
    rng.shuffle(rows)
    return rows


def report(frame, **names):
    return {r[0]: tuple(r)[1:] for r in repair_report(frame, **names).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, digest int")


def test_odd_conversations_equal_plain_search(spark):
    rows = made_rows(3, 400)
    assert report(frame(spark, rows)) == expected(rows, lambda rs: [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rs])
    assert report(damaged(frame(spark, rows)), copies_col="copies") == expected(rows)
    assert repair_report(frame(spark, rows).limit(0)).count() == 0


def test_query_equals_plain_search(spark):
    rows = list(map(tuple, spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    assert {r.conv_id: tuple(r)[1:] for r in op12(spark, FOLDER).collect()} == expected(rows)


def test_long_conversation_in_short_strings(spark, monkeypatch):
    """Backpointers of one conversation over many strings, repeats across their ends included."""
    for name in ("CHUNK_ROWS", "RUNS_OUT"):
        monkeypatch.setattr(conversation_repair, name, 7)
    rows = [(7, t, random.Random(t).choice(["user", "assistant"]), random.Random(-t).choice(["a.", "b.", "c", f"{t}."])) for t in range(300)]
    rows += [(7, 20, "user", "same."), (7, 150, "user", "same.")] * 15
    out = repaired_turns(frame(spark, rows)).collect()
    assert [r.position for r in out] == list(range(len(out)))
    assert {7: tuple(report(frame(spark, rows))[7])} == expected(rows, list)
    assert "".join(r.edit for r in out) == expected(rows, list)[7][6]


@pytest.mark.parametrize("text", ["x" * 3_000_000 + ".", "."])
def test_one_row(spark, text):
    rows = [(1, None, "user", text)]
    assert report(frame(spark, rows)) == expected(rows, list)
