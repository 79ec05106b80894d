"""Small text helpers that run inside tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa

BLANKS = "\t\n\x0b\x0c\r"
ASCII_WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[str]:
    """Runs of characters other than the six ASCII blanks."""
    if not text:
        return []
    for blank in BLANKS:
        if blank in text:
            text = text.replace(blank, " ")
    return list(filter(None, text.split(" ")))


def ascii_lower(text: str) -> str:
    """A-Z to a-z and nothing else."""
    return text.lower() if text.isascii() else text.translate(UPPER_TO_LOWER)


UPPER_TO_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def read_vocabulary(path: str) -> str:
    """Content of a tokenizer file; a few MB, so it travels with the task instead of a local path."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=4)
def library_tokenizer(vocabulary: str):
    """The tokenizers library's object for a vocabulary, once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # not this C library
        return None


def release_memory() -> None:
    """Give freed memory back: Python workers stay between tasks and would keep it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def releasing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that gives its memory back at the end."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release_memory()
    return run


def releasing_group(group: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one large group."""
    def run(table):
        try:
            return group(table)
        finally:
            release_memory()
    return run


def releasing_pair(group: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for a function of two large groups."""
    def run(left, right):
        try:
            return group(left, right)
        finally:
            release_memory()
    return run
