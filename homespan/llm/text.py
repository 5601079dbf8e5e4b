"""Shared text helpers: the word definition, lower-casing, vectorised word hashes and batch walking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words are runs of bytes other than space and \\t..\\r; ``bytes.split`` cuts at exactly these.
_UPPER = bytes(range(65, 91))
_LOWER_TABLE = bytes.maketrans(_UPPER, _UPPER.lower())
_LOWER = np.frombuffer(_LOWER_TABLE, np.uint8)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SLICE_BYTES = 1 << 20
_powers: dict[str, np.ndarray] = {}


def lower_ascii(raw: bytes) -> bytes:
    return raw.translate(_LOWER_TABLE)


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return (lower_ascii(raw) if lower else raw).split()


def rows_of(column: pa.Array, rows: int = 256) -> Iterator[list[str | None]]:
    """The values of a text column as short Python lists, so few are objects at once."""
    for start in range(0, len(column), rows):
        yield column.slice(start, rows).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def hash_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some byte strings, A-Z lower-cased, and the string each belongs to.

    A word's hash is a difference of running sums, so no Python object per word is made.
    """
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    buf = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    if not raws:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = _IN_WORD[buf]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = _power_tables(max(len(buf), _SLICE_BYTES + 1))
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER[buf].astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    first = np.cumsum(sizes + 1) - sizes - 1
    return hashes, np.searchsorted(first, starts, side="right") - 1


def hash_shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` consecutive words (runs across strings included)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _BASE + hashes[k: k + n]
    return mix(total + np.uint64(size))


def slices(raws: list[bytes], most: int = _SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, strings) with about ``most`` bytes each; a longer string comes alone."""
    start = total = 0
    for i, raw in enumerate(raws):
        if total and total + len(raw) > most:
            yield start, raws[start:i]
            start, total = i, 0
        total += len(raw) + 1
    if start < len(raws):
        yield start, raws[start:]
