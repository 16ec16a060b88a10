"""Words made of digits, letters and everything beyond ASCII, as 64-bit hashes, by numpy over the bytes of many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .shingles import mix

#: A word as a regular expression, for A-Z lower-cased texts and for texts as they are. Fixed by the operators' contracts.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes hashed at once; a piece of a longer text ends where a word does.
PIECE = 1 << 19

_code = np.arange(256)
INSIDE = ((_code >= ord("0")) & (_code <= ord("9"))) | ((_code | 32 >= ord("a")) & (_code | 32 <= ord("z")) & (_code >= 64)) | (_code >= 128)
_FOLD = np.where((_code >= ord("A")) & (_code <= ord("Z")), _code + 32, _code)
_VALUE = (np.random.default_rng(2113).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_FOLD]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** (0 ... n - 1), modulo 2 ** 64; kept up to the length of a usual piece."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * PIECE), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 2 * PIECE:
            _powers[base] = have
    return have[:n]


def hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word of ``data``; the hash of a word doesn't depend on where it stands."""
    edge = np.flatnonzero(np.diff(INSIDE[data].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(_BASE, len(data)), out=upto[1:])
    return start, end, mix((upto[end] - upto[start]) * _power(_INVERSE, len(data))[start])


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, start, end, hash) of all words in order; start and end count the bytes of the text.

    Short texts share a piece; a long one takes several, none of which cuts a word.
    """
    at = 0
    while at < len(texts):
        last, size = at, 0
        while last < len(texts) and (last == at or size + len(texts[last]) <= PIECE):
            size, last = size + len(texts[last]) + 1, last + 1
        if last - at > 1:
            data = np.frombuffer(b"\n".join(texts[at:last]), np.uint8)
            first = np.cumsum([0, *(len(t) + 1 for t in texts[at : last - 1])])
            start, end, h = hashed(data)
            which = np.searchsorted(first, start, side="right") - 1
            yield which + at, start - first[which], end - first[which], h
        else:
            data, lo = np.frombuffer(texts[at], np.uint8), 0
            while lo < len(data):
                hi = lo + PIECE
                while hi < len(data) and INSIDE[data[hi]]:  # on to the end of the word, by growing strides
                    stop = np.flatnonzero(~INSIDE[data[hi : hi + PIECE]])
                    hi += int(stop[0]) if len(stop) else PIECE
                start, end, h = hashed(data[lo:hi])
                yield np.full(len(start), at), start + lo, end + lo, h
                lo = hi
        at = last


def lookup(vocabulary: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted ``vocabulary``, or -1."""
    if not len(vocabulary):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    return np.where(vocabulary[at] == h, at, -1)
