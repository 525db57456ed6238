"""Words of whole texts as NumPy arrays, by bytes of their UTF-8 form.

Every word class used here is closed under UTF-8: all bytes of characters
beyond ASCII are word bytes, so a byte table decides.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa

from vellum.llm.common import utf8

_rng = np.random.default_rng(1_234_577)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E37_79B9_7F4A_7C15)         # odd
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD1B5_4A32_D192_ED03)         # odd, between words
_SEED = np.uint64(0x9E37_79B9_7F4A_7C15)
_TURN = np.uint64(0xA24B_AED4_963E_E407)         # odd, between pieces of a word
#: Words of more bytes than this are hashed one by one.
LONG_WORD = 256


def _lowered() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lowered()


def not_space() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[[0x20, 9, 10, 11, 12, 13]] = False
    return t


def alphanumeric() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t[LOWER]


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5_D329_728E_A185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DA_DEF4_BC2D_D44D)
    return x ^ (x >> np.uint64(33))


@functools.lru_cache(4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def _room(n: int) -> int:
    return 1 << max(12, int(n).bit_length())


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end], A-Z as a-z.

    Words are taken eight bytes at a time, all words together, and mixed after each
    piece, so that what one piece changes no later piece can undo by its
    place alone (as sums of bytes times powers can)."""
    lowered = np.zeros(len(data) + 8, dtype=np.uint8)
    np.take(LOWER, data, out=lowered[:len(data)])
    pieces = np.ndarray(len(data) + 1, dtype="<u8", buffer=lowered, strides=(1,))
    length = end - start
    out = length.astype(np.uint64) * _TURN + _SEED
    open_ = np.nonzero(length <= LONG_WORD)[0]
    done = 0
    while len(open_):
        left = length[open_] - done
        piece = pieces[start[open_] + done]
        short = left < 8
        if short.any():
            bits = (np.minimum(left, 7) * 8).astype(np.uint64)
            piece = np.where(short, piece & ((np.uint64(1) << bits) - np.uint64(1)), piece)
        out[open_] = mix64((out[open_] ^ piece) * _TURN + _STEP)
        open_ = open_[left > 8]
        done += 8
    for k in np.nonzero(length > LONG_WORD)[0]:
        digest = hashlib.blake2b(lowered[start[k]:end[k]], digest_size=8).digest()
        out[k] = np.frombuffer(digest, dtype="<u8")[0]
    return out


class Words:
    """The words of a string column: ``hash`` (64 bits, A-Z as a-z), byte
    places ``start`` and ``end`` in ``data``, and ``first``, the word offsets of
    the rows (row r has the words first[r] .. first[r + 1])."""

    def __init__(self, column: pa.Array, table: np.ndarray):
        self.data, self.offs = utf8(column)
        data, n = self.data, len(self.data)
        inside = table[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offs] = True
        edge[0] = edge[n] = True
        left, right = edge[:-1].copy(), edge[1:].copy()
        if n:
            left[1:] |= ~inside[:-1]
            right[:-1] |= ~inside[1:]
        self.start = np.nonzero(inside & left)[0]
        self.end = np.nonzero(inside & right)[0] + 1
        self.hash = word_hashes(data, self.start, self.end)
        self.first = np.searchsorted(self.start, self.offs)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words, and their row offsets; a row with
        fewer words, but not none, has one shingle, its whole sequence."""
        return window_hashes(self.hash, self.first, width)


def window_hashes(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    offs = np.concatenate([[0], np.cumsum(count)])
    rows = np.repeat(np.arange(len(n)), count)
    begin = first[:-1][rows] + np.arange(offs[-1]) - offs[:-1][rows]
    padded = np.concatenate([h, np.zeros(width, dtype=np.uint64)])
    short = n < width
    acc = np.zeros(len(begin), dtype=np.uint64)
    length = np.minimum(n, width)[rows] if short.any() else np.full(len(begin), width)
    for k in range(width):
        word = padded[begin + k]
        if short.any():
            word = np.where(k < length, word, np.uint64(0))
        # shifted between words: a plain polynomial has sequences that collide at any odd factor
        acc = (acc ^ word) * _STEP
        acc ^= acc >> np.uint64(29)
    return mix64(acc + length.astype(np.uint64)), offs
