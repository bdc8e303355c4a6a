"""Hashed words and word sets of many texts at once, with NumPy.

Texts are joined in chunks of bounded size; words get a 64-bit polynomial hash from one running sum over
the bytes, and whatever is built on words (shingles, line tokens) is computed on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

CHUNK = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (a murmur-style finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(name: str, base: int, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, 2 * CHUNK), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name]


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, encoded texts) for runs of at most CHUNK bytes, or one longer text."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if run and size + len(b) > CHUNK:
            yield first, run
            first, run, size = i, [], 0
        run.append(b)
        size += len(b) + 1
    if run:
        yield first, run


def hashed_words(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased, split at ASCII white space) and the number of each word's text."""
    lengths = np.fromiter(map(len, run), np.int64, len(run))
    data = np.frombuffer(b"\n".join(run), np.uint8)
    upper = (data >= 65) & (data <= 90)
    data = data + upper * np.uint8(32)
    inside = np.concatenate([[False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", BASE, len(data))[: len(data)], dtype=np.uint64)])
    words = mix((sums[ends] - sums[starts]) * _power("inverse", _INVERSE, len(data))[starts]) if len(starts) else np.zeros(0, np.uint64)
    firsts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    return words, np.searchsorted(firsts, starts, "right") - 1


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one parcel."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    """The columns of a parcel, given their kinds."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += out[-1].nbytes
    return out


def chain(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words."""
    n = len(words) - k + 1
    out = np.full(max(n, 0), k, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + words[j : j + n])
    return out


def shingle_sets(run: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; of fewer words, the whole sequence is one."""
    words, of = hashed_words(run)
    bounds = np.searchsorted(of, np.arange(len(run) + 1))
    long = chain(words, k)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            yield np.unique(long[a : b - k + 1])
        else:
            yield chain(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)
