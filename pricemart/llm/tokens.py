"""Vectorised words and word n-grams: numpy over the UTF-8 bytes of a chunk of texts.

A byte table gives each byte a class; a token is a maximal run of bytes of one class other than 0, and ends with
its text.  Its 64-bit hash is a polynomial over the bytes modulo 2^64 taken from running sums, so no Python loop
touches the words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15           # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
SEGMENT = 1 << 22                   # longer byte ranges are cut at token ends

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
LOWER = np.where(_UPPER, _B + 32, _B).astype(np.uint8)
SAME = _B.astype(np.uint8)
_SPACE = (_B == 32) | ((_B >= 9) & (_B <= 13))
_ALNUM = ((_B >= 48) & (_B <= 57)) | _UPPER | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
#: maximal runs of anything but white space
NON_SPACE = (~_SPACE).astype(np.uint8)
#: maximal runs of ASCII letters, digits and non-ASCII characters
ALNUM = _ALNUM.astype(np.uint8)
#: the same (class 1) and runs of other visible bytes (class 2)
ALNUM_OR_SIGNS = np.where(_ALNUM, 1, np.where(_SPACE | (_B < 32) | (_B == 127), 0, 2)).astype(np.uint8)


class Words(NamedTuple):
    hashes: np.ndarray      # uint64, one per token
    starts: np.ndarray      # first byte of each token in ``data``
    ends: np.ndarray        # byte after its last one
    offsets: np.ndarray     # text i has tokens offsets[i]:offsets[i + 1]
    data: np.ndarray        # the bytes of all texts


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row (null: none) and their n + 1 offsets."""
    col = pc.fill_null(texts.cast(pa.large_binary()), b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    buf = col.buffers()[2] if len(col) else None
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(size, np.uint64)
        step = 1
        while step < size:                      # doubling: base^(i + step) = base^i * base^step
            have[step:2 * step] = have[:step] * np.uint64(pow(base, step, 1 << 64))
            step *= 2
        if size <= 2 * SEGMENT:
            _powers[base] = have
    return have[:n]


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower[data].astype(np.uint64) + np.uint64(1)) * _power(BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(INVERSE, len(data) + 1)[starts])


def words(texts: pa.Array, classes: np.ndarray = ALNUM, lower: np.ndarray = LOWER) -> Words:
    """Tokens of every text; equal (after ``lower``) tokens have equal hashes."""
    data, off = flat(texts)
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), z, z, np.zeros(len(off), np.int64), data)
    cls = classes[data]
    edge = np.zeros(n + 1, bool)
    edge[1:n] = cls[1:] != cls[:-1]
    edge[off] = True
    edge[0] = edge[n] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    own = cls[starts] != 0
    starts, ends = starts[own], ends[own]
    if n <= SEGMENT:
        hashes = _hash(data, starts, ends, lower)
    else:                                       # bounded memory for very long texts
        hashes = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
            a, b = starts[i], ends[j - 1]
            hashes[i:j] = _hash(data[a:b], starts[i:j] - a, ends[i:j] - a, lower)
            i = j
    return Words(hashes, starts, ends, np.searchsorted(starts, off), data)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n tokens from each position on (shorter by n - 1); it may run over the end of a text."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    g = np.zeros(m, np.uint64)
    for i in range(n):
        g = g * np.uint64(BASE) + hashes[i:i + m]
    return mix(g)


def starts_inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """For each position of ``ngrams``: whether its n tokens belong to one text."""
    total = int(offsets[-1])
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    end = np.repeat(offsets[1:], np.diff(offsets))[:m]
    return np.arange(m) + n <= end


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text of each token."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def token_bytes(w: Words, i: int, lower: np.ndarray = LOWER) -> bytes:
    return lower[w.data[w.starts[i]:w.ends[i]]].tobytes()
