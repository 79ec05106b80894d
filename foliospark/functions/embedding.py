"""Text to vector: a hook for model clients, and an offline embedder used by default."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

WIDTH = 64
CACHED_TOKENS = 200_000
PIECE_CHARS = 1 << 20  # of the texts whose tokens are numbered together
Embedder = Callable[[list[str]], np.ndarray]


class HashingEmbedder:
    """Signed feature hashing of whitespace tokens; the same text gives the same vector anywhere.

    Tokens of many texts are split and numbered by Arrow, so only distinct tokens are hashed; a batch is taken in
    pieces of bounded size, as its tokens take many times the memory of its texts.
    """

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {"": -1}

    def _cell(self, token: str) -> int:
        """Column of a token: its slot, moved by ``width`` when its sign is negative."""
        cell = self.known.get(token)
        if cell is None:
            number = int(md5(token.encode()).hexdigest()[:8], 16)
            cell = number % (2 * self.width)
            if len(self.known) < CACHED_TOKENS:
                self.known[token] = cell
        return cell

    def __call__(self, texts: list[str]) -> np.ndarray:
        out, before = np.zeros((len(texts), self.width)), np.cumsum([0, *map(len, texts)])[:-1]
        cuts = [0, *(np.flatnonzero(np.diff(before // PIECE_CHARS)) + 1).tolist(), len(texts)]
        for low, high in zip(cuts, cuts[1:]):
            out[low:high] = self._counted(texts[low:high])
        return out

    def _counted(self, texts: list[str]) -> np.ndarray:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))  # the gaps of TOKEN_GAP
        flat = words.flatten().dictionary_encode()
        cells = np.array([self._cell(t) for t in flat.dictionary.to_pylist()], np.int64)[flat.indices.to_numpy()]
        rows = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
        used = cells >= 0
        counts = np.bincount(rows[used] * 2 * self.width + cells[used], minlength=2 * self.width * len(texts))
        signed = counts.reshape(len(texts), 2, self.width)
        return (signed[:, 0] - signed[:, 1]).astype(float)


def embed(text: Column, make_client: Callable[[], Embedder] = HashingEmbedder, batch_size: int | None = None) -> Column:
    """Vector of each text. ``make_client`` runs once per task.

    ``batch_size`` is the number of texts per client call, for a model endpoint that takes few at a
    time (10, say); Arrow batches stay as Spark cuts them. Null text is embedded as empty text.
    """

    @F.arrow_udf(ArrayType(DoubleType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        client = make_client()
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            step = batch_size or max(1, len(texts))
            parts = [client(texts[i:i + step]) for i in range(0, len(texts), step)]
            matrix = np.concatenate(parts) if parts else np.zeros((0, 1))
            ends = np.arange(len(texts) + 1, dtype=np.int32) * matrix.shape[1]
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.reshape(-1), type=pa.float64()))

    return vectors(text)
