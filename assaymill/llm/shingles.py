"""Hashed word shingles and similarity sketches of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

U = np.uint64
_MASK = (1 << 64) - 1


def _stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed random words."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits look independent."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = _stream(11, 256)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def spans_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; spans stand in order and do not overlap."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(owner)) - begins[owner]
    value = _BYTES[data[starts[owner] + place]] * _powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, begins) + lengths.astype(U))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in order.

    ``data`` holds the UTF-8 bytes of all texts, text i in ``offsets[i]:offsets[i + 1]``. A-Z count as
    a-z; words stand between ASCII white space. A word's hash is a polynomial of its
    bytes' random words.
    """
    data = _LOWER[data]
    space = _SPACE[data]
    starts = ~space
    starts[1:] &= space[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[heads] = ~space[heads]
    starts = np.flatnonzero(starts)
    if not len(starts):
        return np.empty(0, U), np.empty(0, np.int64)
    ends = np.append(starts[1:], len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, ends - starts)
    value = _BYTES[data[starts[0] :]] * _powers(int(place.max()) + 1)[place]
    value[space[starts[0] :]] = 0
    hashes = mix(np.add.reduceat(value, starts - starts[0]))
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and the bounds of each set.

    A text of fewer than ``k`` words but some is one shingle; one without words has none.
    """
    n = len(offsets) - 1
    words, text = word_hashes(data, offsets)
    count = np.bincount(text, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))
    factors = _stream(23, k)
    parts, owners = [], []
    if len(words) >= k:
        whole = text[: len(words) - k + 1] == text[k - 1 :]
        total = np.zeros(len(words) - k + 1, dtype=U)
        for j in range(k):
            total += words[j : len(words) - k + 1 + j] * factors[j]
        parts.append(mix(total[whole]))
        owners.append(text[: len(words) - k + 1][whole])
    for size in range(1, k):
        short = np.flatnonzero(count == size)
        total = np.full(len(short), size, dtype=U)
        for j in range(size):
            total += words[first[short] + j] * factors[j]
        parts.append(mix(total))
        owners.append(short)
    hashes = np.concatenate(parts) if parts else np.empty(0, U)
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
        hashes, owner = hashes[new], owner[new]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))
    return hashes, bounds


def sketches(hashes: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketches: one row of ``size`` coordinates per set; empty sets stay unfilled.

    In round i every element of a set falls into one bin with the value (i, random), and a bin
    keeps its least value. After ``size`` rounds the i-th further round throws all
    elements into bin i, so every bin is filled; sets of about ``size`` elements need few rounds,
    and two sets agree on a coordinate with a chance of their similarity.
    """
    n = len(bounds) - 1
    empty = U(_MASK)
    out = np.full((n, size), empty, dtype=U)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    live = np.flatnonzero(sizes > 0)
    seeds = _stream(37, 2 * size)
    flat = out.reshape(-1)
    for i in range(2 * size):
        if not len(live):
            break
        thrown = mix(hashes ^ seeds[i])
        value = (U(i) << U(44)) | (thrown & U((1 << 44) - 1))
        if i < size:
            place = ((thrown >> U(44)) * U(size)) >> U(20)
        else:
            place = np.full(len(hashes), i - size, dtype=U)
        np.minimum.at(flat, owner * size + place.astype(np.int64), value)
        if i < 8 or i % 8 == 0 or i >= size:
            open_rows = (out[live] == empty).any(axis=1)
            if not open_rows.all():
                live = live[open_rows]
                keep = np.isin(owner, live, assume_unique=False)
                hashes, owner = hashes[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A key per band of ``rows`` coordinates; keys of different bands never meet but by chance."""
    n, size = sketch.shape
    bands = sketch[:, : size // rows * rows].reshape(n, -1, rows)
    total = (bands * _stream(41, rows)).sum(axis=2, dtype=U)
    return mix(total + _stream(43, bands.shape[1]))
