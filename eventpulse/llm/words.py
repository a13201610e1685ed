"""Words of a batch of texts as 64-bit hashes, computed with numpy inside tasks.

A batch is one byte buffer with row offsets, as Arrow holds it, so no string
object is made per word. A word is hashed eight bytes at a time, each step a bijection
of what came before combined with the next bytes; words of more than LONG bytes are
hashed by BLAKE2b. So words of up to eight bytes with the same length never share a
hash, and all others do so by chance only. A run of words is hashed by doubling: the
hash of two neighbouring runs is a mixed combination of theirs. Equal hashes are taken
as equal words: with 10**12 different words, the chance of any clash with a given one
is below 10**-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of a word that are hashed eight at a time; a longer word is hashed on its own.
LONG = 128
#: Text that a task works on at a time; arrays over its words and grams take up to 40 times that.
BATCH_BYTES = 1 << 19

_SEED = U64(0xA0761D6478BD642F)
#: Multipliers of two independent hashes of runs.
STEPS = (U64(0xD6E8FEB86659FD93), U64(0x9E3779B97F4A7C15))


def _table(separators: bytes | range | list[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Bytes of words between white space, and of words of lower-case letters, digits and non-ASCII.
SPACED = _table([0x20, *range(0x09, 0x0E)])
ALNUM = _table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose result looks random."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span."""
    size = ends - starts
    out = mix(size.astype(U64) + _SEED)
    if not len(data):
        return out
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    # the eight bytes from each place on, without a copy
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    live, at = np.flatnonzero(size), 0
    while len(live) and at < LONG:
        left = size[live] - at
        part = eight[starts[live] + at]
        short = left < 8
        part[short] &= (U64(1) << (8 * left[short]).astype(U64)) - U64(1)
        out[live] = mix(out[live] ^ part)
        live, at = live[left > 8], at + 8
    for k in live.tolist():
        digest = blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


class Words(NamedTuple):
    """Words of several rows: hash, first byte, end byte; row r has words bounds[r]:bounds[r+1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the row offsets; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end bytes of words, and word bounds per row."""
    mask = inside[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    first[cut] = mask[cut]
    cut = cut[cut > 0] - 1
    last[cut] = mask[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words_of(column: pa.Array, inside: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, offsets = buffer_of(column)
    if lower:
        data = LOWER[data]
    starts, ends, bounds = spans_of(data, offsets, inside)
    return Words(hash_words(data, starts, ends), starts, ends, bounds)


def windows(hashes: np.ndarray, width: int, step: np.uint64 = STEPS[0]) -> np.ndarray:
    """Hash of each run of ``width`` words of one sequence; none if it is shorter."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, done, part, size = None, 0, hashes, 1
    while True:
        if width & size:
            out = part if out is None else mix(out[: len(part) - done] * step ^ part[done:])
            done += size
        if done == width:
            return out[:n]
        part, size = mix(part[:-size] * step ^ part[size:]), 2 * size


def slices(batches: Iterator[pa.RecordBatch], text: str | int = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of at most ``most`` bytes of text, or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text) if isinstance(text, str) else text)
        size = np.asarray(pc.binary_length(column).fill_null(0)).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(size)))
        i = 0
        while i < len(size):
            j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
