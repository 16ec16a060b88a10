"""Word shingles as 64-bit hashes, a batch of texts at a time in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

WIDTH = 5
_RNG = np.random.default_rng(1405)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
#: Bytes hashed at once; pieces end at white space, or the text's end.
PIECE = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (multiply and shift, twice)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a piece of bytes: runs without white space, A-Z lower-cased."""
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    size = end - start
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    power = np.full(int(size.max()), _STEP, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    h = np.add.reduceat(_BYTE[_LOWER[data[inside]]] * power[at], first)
    return start, mix(h + size.astype(np.uint64))


def words_of(text: bytes | str) -> np.ndarray:
    """Hashes of a whole text's words, in order."""
    data = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
    out, at = [], 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        out.append(word_hashes(data[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles_of_words(w: np.ndarray) -> np.ndarray:
    """Hashes of the runs of WIDTH words; with fewer words, of the whole sequence; without, none. Not yet distinct."""
    if not len(w):
        return w
    n = max(1, len(w) - WIDTH + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(WIDTH, len(w))):
        h += w[k : k + n] * _PLACE[k]
    return mix(h + np.full(1, min(len(w), WIDTH), np.uint64) * _STEP)


def sets_of(texts: list[str | None], group_bytes: int = 1 << 20) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for null texts and texts without words."""
    raw = [(t or "").encode() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (end == at or size + len(raw[end]) <= group_bytes):
            size, end = size + len(raw[end]) + 1, end + 1
        if end - at == 1:
            out.append(np.unique(shingles_of_words(words_of(raw[at]))))
        else:
            data = np.frombuffer(b"\n".join(raw[at:end]), np.uint8)
            start, h = word_hashes(data)
            ends = np.cumsum([len(x) + 1 for x in raw[at:end]])
            cut = np.searchsorted(start, ends)
            prev = 0
            for c in cut:
                out.append(np.unique(shingles_of_words(h[prev:c])))
                prev = c
        at = end
    return out


def digest(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
