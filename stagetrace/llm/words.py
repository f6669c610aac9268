"""Words of whole texts as 64-bit hashes, worked out with NumPy for many texts at once.

A word is a run of characters outside ``\x20`` and ``\x09``-``\x0D``. Word hashes are differences of
prefix sums of a polynomial over random byte values modulo 2**64, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Bytes hashed in one go; longer texts are cut at white space.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit; one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``, at least."""
    size = 1 << max(10, (n - 1).bit_length())
    key = (base, size)
    if key not in _POWERS:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _POWERS[key] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[key]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def piece_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair; ``base`` is odd, pieces hold at least one value."""
    n = len(values) + 1
    prefix = np.zeros(n, np.uint64)
    np.cumsum(values * powers(base, n)[: n - 1], dtype=np.uint64, out=prefix[1:])
    return (prefix[end] - prefix[start]) * powers(_inverse(base), n)[start]


def _hash_block(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(raw, np.uint8)
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    return mix(piece_hashes(_BYTE[data], start, end, _BASE)), start, end


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word."""
    if len(raw) <= 2 * BLOCK:
        return _hash_block(raw)
    out, at = [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        if end < len(raw):
            spaces = np.flatnonzero(SPACE[np.frombuffer(raw, np.uint8, end - at, at)])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:  # a word longer than a block: on to the next white space
                end = _next_space(raw, end)
        h, s, e = _hash_block(raw[at:end])
        out.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _next_space(raw: bytes, at: int) -> int:
    while at < len(raw):
        found = np.flatnonzero(SPACE[np.frombuffer(raw, np.uint8, min(BLOCK, len(raw) - at), at)])
        if len(found):
            return at + int(found[0]) + 1
        at += BLOCK
    return len(raw)


def in_blocks(texts: list[bytes], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``limit`` bytes together, one text at least."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def many_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts on end, and where each text's words begin (one entry more than texts)."""
    if len(texts) == 1:
        h, _, _ = word_hashes(texts[0])
        return h, np.array([0, len(h)])
    h, start, _ = word_hashes(b"\n".join(texts))
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    return h, np.searchsorted(start, first)
