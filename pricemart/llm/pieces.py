"""Tokenizer ids of many texts at once, by a table of pieces.

A pre-tokenizer cuts a text at places that can be told from the bytes alone: between words and signs, and around white
space.  ``cuts`` finds those places with numpy, so each piece's ids don't depend on its neighbours and a text's ids are
those of its pieces in a row.  ``PieceTable`` remembers the ids of pieces of up to 31 bytes under the bytes themselves
(four 64-bit numbers with the length, compared in full); new and longer pieces go to the ``tokenizers`` library.

Cuts are only made where both sides are known: ASCII letters and Latin-1 letters, ASCII digits, other visible ASCII signs
but the apostrophe (contractions), ASCII white space.  Everything else stays inside its piece.  A text that may hold a
special token ("<|") is one piece.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

from pricemart.llm.tokens import flat, mix

LIMIT = 31                      # bytes of a piece in the table
TABLE_PIECES = 1_500_000        # pieces that a worker remembers (some 100 MB)

UNKNOWN, LETTER, DIGIT, SIGN, SPACE, WIDE = range(6)        # WIDE: may be white space to the library
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = SIGN
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
_KIND[39] = UNKNOWN
_KIND[9:14] = _KIND[32] = SPACE
_KIND[28:32] = _KIND[127] = WIDE
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def cuts(data: np.ndarray, off: np.ndarray, drops_space: bool, parts: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of the texts ``data[off[i]:off[i + 1]]``.

    ``drops_space``: white space is no part of any piece.  Else a piece may begin with one space, as words of byte-level
    vocabularies do, and white space has pieces of its own.  ``parts``: letters, digits and signs part."""
    n = len(data)
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)                    # Latin-1 letters: two bytes, but for the signs of times and division
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    edge = np.zeros(n + 1, bool)
    a, b = kind[:-1], kind[1:]
    if parts:
        edge[1:n] = (a != b) & (a - LETTER < 3) & (b - LETTER < 3)      # unsigned: both are letter, digit or sign
    if drops_space:
        edge[1:n] |= (a == SPACE) != (b == SPACE)
    else:
        for first, second, width in ((0xC2, None, 2), (0xE1, 0x9A, 3), (0xE2, 0x80, 3), (0xE2, 0x81, 3), (0xE3, 0x80, 3)):
            lead = np.flatnonzero(data[:n - width + 1] == first)
            lead = lead if second is None else lead[data[lead + 1] == second]
            for i in range(width):                              # some of these are white space
                kind[lead + i] = WIDE
        word = (kind != SPACE) & (kind != WIDE)
        edge[1:n] |= word[:-1] & (b == SPACE) | (a == SPACE) & (data[:-1] != 32) & word[1:]
        # Of white space before a word the last goes alone or with the word.  At a text's end there is no word after it.
        last = (a[:-1] == SPACE) & (b[:-1] == SPACE) & word[2:]
        edge[1:n - 1] |= last
        ends = off[1:-1] - 1
        ends = ends[ends >= off[:-2]]
        ends = ends[(ends > 0) & (kind[ends] == SPACE)]
        edge[ends[kind[ends - 1] == SPACE]] = False
    edge[off] = True
    edge[0] = edge[n] = True
    special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if n > 1 else np.zeros(0, np.int64)
    for i in np.unique(np.searchsorted(off, special, side="right") - 1).tolist():
        edge[off[i] + 1:off[i + 1]] = False
        kind[off[i]] = UNKNOWN
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    if drops_space:
        own = kind[starts] != SPACE
        starts, ends = starts[own], ends[own]
    return starts, ends


PROBE = "ab12.cd (ef)  gh\n\ni"
BYTE_LEVEL = [2, 4, 5, 7, 9, 11, 12, 13, 16, 17, 18, 19]          # ends of the words of PROBE, byte level


class PieceTable:
    """Ids of texts by the tokenizer file ``path``; ``drops_space`` as in ``cuts``.

    Which cuts are right is asked of the file's own pre-tokenizer; where none are, whole texts go to the library."""

    def __init__(self, path: str, drops_space: bool = False, pieces: int = TABLE_PIECES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.drops_space, self.room = drops_space, pieces
        self.size = max(self.tok.get_vocab(with_added_tokens=True).values(), default=0) + 1
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self._clear()
        ends = []
        if self.tok.pre_tokenizer is not None:
            ends = sorted({b for _, (_, b) in self.tok.pre_tokenizer.pre_tokenize_str(PROBE)})
        self.parts = {2, 4, 5, 7}.issubset(ends)
        self.whole = not drops_space and (self.tok.normalizer is not None or ends != BYTE_LEVEL)

    @staticmethod
    def shared(path: str, drops_space: bool) -> PieceTable:
        """The worker process's table: Spark reuses workers, so later tasks find it filled."""
        home = sys.modules.setdefault("_pricemart_pieces", types.ModuleType("_pricemart_pieces"))
        key = f"{path}|{drops_space}"
        if not hasattr(home, key):
            setattr(home, key, PieceTable(path, drops_space))
        return getattr(home, key)

    def _clear(self) -> None:
        self.n = self.used = 0
        self.keys = np.zeros((1024, 4), np.uint64)
        self.at, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool = np.zeros(1 << 12, self.kind)
        self.slots = np.full(1 << 12, -1, np.int32)

    @staticmethod
    def _keys(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The bytes of pieces of up to ``LIMIT`` bytes as four numbers; the last byte is the length."""
        padded = np.concatenate([data, np.zeros(32, np.uint8)])
        words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        out = np.zeros((len(starts), 4), np.uint64)
        out[:, 0] = words[starts] & _MASK[np.minimum(size, 8)]
        for i in (1, 2, 3):
            more = np.flatnonzero(size > 8 * i)
            if len(more):
                out[more, i] = words[starts[more] + 8 * i] & _MASK[np.minimum(size[more] - 8 * i, 8)]
        out[:, 3] |= size.astype(np.uint64) << np.uint64(56)
        return out

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        for i, by in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9), (3, 0xD6E8FEB86659FD93)):
            h = (h ^ (h >> np.uint64(29))) + keys[:, i] * np.uint64(by)
        return mix(h)

    def _find(self, keys: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 for new ones."""
        mask = np.uint64(len(self.slots) - 1)
        slot = (h & mask).astype(np.int64)
        found = self.slots[slot]
        left = np.flatnonzero((found >= 0) & (self.keys[found] != keys).any(1))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            found[left] = self.slots[slot[left]]
            left = left[(found[left] >= 0) & (self.keys[found[left]] != keys[left]).any(1)]
        return found

    def _insert(self, first: int) -> None:
        """Slots for the entries from ``first`` on."""
        mask = len(self.slots) - 1
        entry = np.arange(first, self.n, dtype=np.int32)
        slot = (self._hash(self.keys[first:self.n]) & np.uint64(mask)).astype(np.int64)
        while len(entry):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entry[free]                # of several entries for one slot the last is in
            out = self.slots[slot] != entry
            entry, slot = entry[out], (slot[out] + 1) & mask

    def _add(self, keys: np.ndarray, ids: list[np.ndarray]) -> None:
        first, more = self.n, len(keys)
        while self.n + more > len(self.at):
            self.keys, self.at, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.keys, self.at, self.count))
        size = np.array([len(x) for x in ids], np.int64)
        total = int(size.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        if total:
            self.pool[self.used:self.used + total] = np.concatenate(ids)
        self.keys[first:first + more], self.count[first:first + more] = keys, size
        self.at[first:first + more] = self.used + np.cumsum(size) - size
        self.n, self.used = first + more, self.used + total
        if 2 * self.n > len(self.slots):
            width = len(self.slots)
            while 2 * self.n > width:
                width *= 4
            self.slots, first = np.full(width, -1, np.int32), 0
        self._insert(first)

    def ask(self, pieces: list[str]) -> list[np.ndarray]:
        """The library's ids of each piece."""
        out: list = [None] * len(pieces)
        # A piece of letters (after its space) is one word to the library: many are one text, told apart by its words.
        plain = [i for i, p in enumerate(pieces) if (p if self.drops_space else p[1:]).isalpha() and (self.drops_space or p[0] == " ")]
        alone = sorted(set(range(len(pieces))).difference(plain))
        for j in range(0, len(plain), 1000):
            group = plain[j:j + 1000]
            found = self.tok.encode((" " if self.drops_space else "").join(pieces[i] for i in group), add_special_tokens=False)
            ids, word = np.array(found.ids, self.kind), np.array(found.word_ids, np.int64)
            first = np.flatnonzero(word[1:] != word[:-1]) + 1
            if len(first) != len(group) - 1:            # a letter that turns into something else in lower case
                alone += group
                continue
            for i, part in zip(group, np.split(ids, first)):
                out[i] = part
        for i, e in zip(alone, self.tok.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(e.ids, self.kind)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i]:offsets[i + 1]]; nulls have none."""
        data, off = flat(texts)
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(len(off), np.int64)
        if self.whole:
            own = [np.array(e.ids, self.kind) for e in self.tok.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])
        starts, ends = cuts(data, off, self.drops_space, self.parts)
        size = ends - starts
        short = np.flatnonzero(size <= LIMIT)
        if self.n > self.room:
            self._clear()
        keys = self._keys(data, starts[short], size[short])
        h = self._hash(keys)
        entry = self._find(keys, h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            first = {}                                          # distinct new pieces, by their bytes
            raw = data.tobytes()
            for i, (a, b) in zip(new.tolist(), zip(starts[short[new]].tolist(), ends[short[new]].tolist())):
                first.setdefault(raw[a:b], i)
            self._add(keys[list(first.values())], self.ask([p.decode() for p in first]))
            entry[new] = self._find(keys[new], h[new])
        count, at, pool = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), self.pool
        count[short], at[short] = self.count[entry], self.at[entry]
        long = np.flatnonzero(size > LIMIT)
        if len(long):
            own = self.ask([data[a:b].tobytes().decode() for a, b in zip(starts[long].tolist(), ends[long].tolist())])
            count[long] = [len(x) for x in own]
            at[long] = self.used + np.cumsum(count[long]) - count[long]
            pool = np.concatenate([pool[:self.used], *own])
        end = np.cumsum(count)
        ids = pool[np.repeat(at - (end - count), count) + np.arange(int(end[-1]) if len(end) else 0)]
        return ids, np.concatenate([[0], end])[np.searchsorted(starts, off)]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text's ids."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    return out, offsets + np.arange(n + 1)
