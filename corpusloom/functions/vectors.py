"""Vector columns and the built-in hash embedder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BatchEmbedder = Callable[[Sequence[str]], np.ndarray]


def unit(vector: Column) -> Column:
    """Vector scaled to length one, as doubles; a zero vector stays zero."""
    wide = vector.cast("array<double>")
    length = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda total, x: total + x * x))
    return F.zip_with(
        wide,
        F.array_repeat(length, F.size(wide)),
        lambda x, n: F.when(n > 0, x / n).otherwise(F.lit(0.0)),
    )


class _Slots(dict):
    """Bucket and sign of a word as one number; holds on to so many words."""

    def __init__(self, dim: int, held: int):
        super().__init__()
        self.dim, self.held = dim, held

    def __missing__(self, word: str) -> int:
        digest = hashlib.md5(word.encode()).hexdigest()
        slot = int(digest[:8], 16) % self.dim * 2 + (int(digest[8], 16) >= 8)
        if len(self) < self.held:
            self[word] = slot
        return slot

    def __reduce__(self):
        return _Slots, (self.dim, self.held)


class HashEmbedder:
    """Signed feature hashing of lower-case words; stands in for a served model.

    The first eight hex digits of a word's MD5 choose the bucket, the ninth
    chooses the sign, and the sums are scaled to length one.
    """

    words = re.compile(r"[a-z0-9]+")

    def __init__(self, dim: int = 64, cached_words: int = 200_000):
        self.dim = dim
        self.slots = _Slots(dim, cached_words)

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        sums = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            words = self.words.findall((text or "").lower())
            if words:
                slots = np.fromiter(map(self.slots.__getitem__, words), "int64", len(words))
                sums[row] = np.bincount(slots >> 1, weights=1 - 2 * (slots & 1), minlength=self.dim)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        return np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)
