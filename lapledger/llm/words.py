"""Words of texts as arrays, for the tasks that count, hash or compare them.

A word is ``[^\\x20\\x09-\\x0D]+``. UTF-8 bytes of other characters are never separators, so words are found
on bytes. Hashes have 64 bits and depend on the bytes of a word only.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PLACES = 64
SEPARATORS = (0x20, *range(0x09, 0x0E))
ODD = 0x9E3779B97F4A7C15


def random_table(seed: int, *shape: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, shape, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on every bit of the number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    data: np.ndarray  # the bytes of all texts, one after another
    starts: np.ndarray  # where each word starts
    ends: np.ndarray
    bounds: np.ndarray  # words before each text, and in all
    text_starts: np.ndarray  # where each text starts, and where the last ends


def words_of(column: pa.Array, lower: bool = False, separators: Iterable[int] = SEPARATORS) -> Words:
    """The words of each text, the runs between ``separators`` (bytes); null counts as empty. ``lower`` turns A-Z into a-z."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]] if len(offsets) else np.zeros(0, np.uint8)
    at = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    apart = np.zeros(256, bool)
    apart[list(separators)] = True
    inside = ~apart[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[at] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[at] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at), at)


def word_hashes(words: Words, seed: int = 1, separators: Iterable[int] = SEPARATORS) -> np.ndarray:
    """A hash of each word: a random number for each byte at its place, added up and mixed."""
    data, starts, ends, *_ = words
    if not len(starts):
        return np.zeros(0, np.uint64)
    numbers = random_table(seed, PLACES, 256)
    numbers[:, list(separators)] = 0  # what follows a word up to the next one adds nothing
    spans = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), spans)
    value = numbers.ravel()[((place & (PLACES - 1)) << 8) | data[starts[0] :]]
    if (ends - starts).max() > PLACES:
        value *= (2 * (place // PLACES) + 1).astype(np.uint64)
    return mixed(np.add.reduceat(value, starts - starts[0]) + (ends - starts).astype(np.uint64))


def run_hashes(hashes: np.ndarray, k: int, seed: int = 2) -> np.ndarray:
    """A hash of each run of k words that starts at a word; runs may reach over the end of a text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    weights = random_table(seed, k) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * weights[i]
    return mixed(total)
