"""Words of texts and their hashes, for use inside tasks."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

# Fixed value: a word is a run of bytes other than blank and the control characters 9 to 13.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, by its start; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out = out * _MULTIPLIER + hashes[j : n + j]
    return mixed(out)
