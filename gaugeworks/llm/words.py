"""Words of many texts at once, in numpy: 64-bit hashes, shapes and shingles without a Python loop over words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


@dataclass
class Words:
    """Words in text order. first[d]:first[d + 1] are those of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def split_words(texts: list[str | None], lower: bool = True) -> Words:
    """Words [^\\x20\\x09-\\x0D]+ of every text, A-Z lowered first if asked; null is the empty text."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    gap = _GAP[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    first = np.concatenate(([0], np.searchsorted(start, ends, "left"))) if len(raw) else np.zeros(1, np.int64)
    size = end - start
    if len(start):
        inside = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data)))) if start[0] == 0 else None
        if inside is None:
            inside = np.arange(start[0], len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
            part, blank = data[start[0] :], gap[start[0] :]
        else:
            part, blank = data, gap
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.full(int(inside.max()) + 1, _ODD, np.uint64))
            value = _BYTE[part] * power[inside]
            value[blank] = 0
            hashed = mix(np.add.reduceat(value, start - start[0]) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    else:
        hashed = np.zeros(0, np.uint64)
    return Words(data, start, end, first, hashed)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words; a shorter text is one run, an empty one none."""
    h, n = words.hash, len(words.hash)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, n - size + 1), np.uint64)
        for k in range(size):
            runs = mix(runs + h[k : n - size + 1 + k] + np.uint64(k + 1) * _ODD) if len(runs) else runs
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                one = np.zeros(1, np.uint64)
                for k in range(b - a):
                    one = mix(one + h[a + k] + np.uint64(k + 1) * _ODD)
                out.append(mix(one + np.uint64(b - a) * np.uint64(0xA0761D6478BD642F)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
