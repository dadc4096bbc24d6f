"""Word shingles of whole texts as 64-bit hashes (used inside tasks)."""
from __future__ import annotations

import numpy as np

WORDS = 5
CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_PLACES = mix(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    if not cache or len(cache["up"]) < n:
        size = max(n, 2 * CHUNK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            cache[name] = np.concatenate([np.ones(1, np.uint64),
                                          np.cumprod(np.full(size, base, np.uint64))])
    return cache["up"], cache["down"]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of every word of a buffer; A-Z count as a-z."""
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, stop = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[_FOLD[data]] * up[:len(data)], out=prefix[1:])
    return start, mix((prefix[stop] - prefix[start]) * down[start])


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of WORDS words; one for
    a text with fewer words, none for a text without words."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0
    for text in texts:
        batch.append(text.encode("utf-8", "surrogatepass"))
        size += len(batch[-1])
        if size >= CHUNK:
            out += _sets(batch)
            batch, size = [], 0
    return out + _sets(batch)


def _sets(batch: list[bytes]) -> list[np.ndarray]:
    if not batch:
        return []
    ends = np.cumsum([len(b) + 1 for b in batch])       # one blank after each text
    start, word = word_hashes(np.frombuffer(b" ".join(batch) + b" ", np.uint8))
    edges = np.append(0, np.searchsorted(start, ends))
    whole = np.zeros(max(0, len(word) - WORDS + 1), np.uint64)
    for i in range(WORDS if len(whole) else 0):
        whole += word[i:len(word) - WORDS + 1 + i] * _PLACES[i]
    whole = mix(whole)
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi - lo >= WORDS:
            out.append(np.unique(whole[lo:hi - WORDS + 1]))
        elif hi > lo:
            few = (word[lo:hi] * _PLACES[:hi - lo]).sum(dtype=np.uint64)
            out.append(mix(np.array([few + np.uint64(hi - lo)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
