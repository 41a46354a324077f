"""Vectorised hashing of words, shingles and characters over Arrow batches.

All functions work on a whole batch of texts at once; a batch is cut into slices of bounded size first, so memory
doesn't follow the batch. A text is never cut: a slice holds at least one whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one slice holds at most, unless a single text is longer.
SLICE_BYTES = 1_000_000

#: From this length on words are hashed by BLAKE2b: sums of powers modulo 2**64 have known collisions from 1024 bytes on.
LONG_WORD = 256

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser of 64 bits: every input bit reaches every output bit."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random uint64 that depend on the seed alone."""
    with np.errstate(over="ignore"):
        return mix(_U(seed * 0xD1342543DE82EF95 + 1 & _MASK) + np.arange(1, n + 1, dtype=_U) * _U(_BASE))


def _powers(base: int) -> np.ndarray:
    out = np.array([1], dtype=_U)
    step = base
    while len(out) < SLICE_BYTES:
        with np.errstate(over="ignore"):
            out = np.concatenate([out, out * _U(step)])
        step = step * step & _MASK
    return out


_cache: dict[str, np.ndarray] = {}


def _table(name: str, length: int) -> np.ndarray:
    """Powers of the base or of its inverse, at least length of them."""
    base = _BASE if name == "power" else _BASE_INVERSE
    have = _cache.get(name)
    if have is None:
        have = _powers(base)
    while len(have) < length:
        with np.errstate(over="ignore"):
            have = np.concatenate([have, have * _U(pow(base, len(have), 1 << 64))])
    _cache[name] = have
    return have


#: Word characters are all bytes but the six ASCII white-space ones.
WORD_CLASS = np.ones(256, np.uint8)
WORD_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0

#: 0 white space, 1 letters, digits and all non-ASCII bytes, 2 other characters.
TOKEN_CLASS = np.full(256, 2, np.uint8)
TOKEN_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
TOKEN_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1

_BYTE = stream(11, 256)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _LOWER[97:123]


@dataclass
class Slice:
    """Consecutive texts of a batch: first is the number of the first one; offsets has one entry more than texts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string array into slices of whole texts; a null text counts as empty."""
    first = 0
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if not len(chunk):
            continue
        array = chunk.cast(pa.large_string()).fill_null("")
        _, offs, data = array.buffers()
        offsets = np.frombuffer(offs, np.int64)[array.offset : array.offset + len(array) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(array):
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(array))
            yield Slice(first + at, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to
        first += len(array)


@dataclass
class Words:
    """Words of a slice: text number within the slice, byte start and end, class, hash; counts has a number per text."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    hash: np.ndarray
    counts: np.ndarray
    first: np.ndarray  # number of each text's first word


def _digests(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """64 bits of the BLAKE2b digest of each run of bytes, A-Z in lower case if asked."""
    runs = (data[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist()))
    return np.array([int.from_bytes(hashlib.blake2b(r.lower() if lower else r, digest_size=8).digest(), "little") for r in runs], _U)


def words(part: Slice, classes: np.ndarray = WORD_CLASS, lower: bool = False, cuts: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes of one class other than 0, none of which crosses the end of a text or a place in cuts."""
    data, offsets = part.data, part.offsets
    n = len(data)
    kind = classes[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[offsets] = True
    if cuts is not None:
        edge[:n] |= cuts
    at = np.flatnonzero(edge[:n])
    if n:
        used = kind[at] > 0
        start, end = at[used], np.append(at[1:], n)[used]
    else:
        start = end = np.zeros(0, np.int64)
    power, inverse = _table("power", n + 1), _table("inverse", n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, _U)
        np.cumsum((_LOWER if lower else _BYTE)[data] * power[:n], out=total[1:])
        hashes = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U))
    long = np.flatnonzero(end - start >= LONG_WORD)
    if len(long):
        hashes[long] = _digests(data, start[long], end[long], lower)
    text = np.searchsorted(offsets[1:], start, "right")
    counts = np.bincount(text, minlength=len(part))
    return Words(text, start, end, kind[start] if n else start.astype(np.uint8), hashes, counts, np.cumsum(counts) - counts)


def grams(w: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words inside one text, and the number of each run's first word."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.flatnonzero(w.text[:n] == w.text[size - 1 :])
    with np.errstate(over="ignore"):
        power = 1
        total = np.zeros(n, _U)
        step = (_BASE * 2 * seed + 0xC2B2AE3D27D4EB4F) & _MASK | 1
        for k in range(size):
            total += w.hash[k : k + n] * _U(power)
            power = power * step & _MASK
    return mix(total[at]), at


def seen_before(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of keys: which are equal to an earlier row, and which have an equal row anywhere else."""
    n = len(keys[0])
    before, shared = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        order = np.lexsort(keys[::-1])
        same = np.ones(n - 1, bool)
        for k in keys:
            k = k[order]
            same &= k[1:] == k[:-1]
        before[order[1:]] = same
        shared[order[1:]] = same
        shared[order[:-1]] |= same
    return before, shared


def cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie within size places from one of the starts on."""
    delta = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(starts + size, n), minlength=n + 1)[: n + 1]
    return np.cumsum(delta)[:n] > 0


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def windows(w: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Like grams(), by prefix sums: the cost doesn't follow the size."""
    n = len(w.hash)
    if n < size:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.flatnonzero(w.text[: n - size + 1] == w.text[size - 1 :])
    values = w.hash if seed == 0 else mix(w.hash + _U(seed))
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, _U)
        np.cumsum(values * _table("power", n)[:n], out=total[1:])
        return mix((total[at + size] - total[at]) * _table("inverse", n)[at] + _U(size)), at


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    """Maximum of every width consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = np.maximum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.maximum(x[: len(x) - rest], x[rest:]) if rest else x
