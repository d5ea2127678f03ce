"""Word shingles of whole texts as 64-bit hashes, computed in arrays over many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE = 5
SLICE_BYTES = 1_500_000


def _table(name: str, size: int) -> np.ndarray:
    return np.frombuffer(hashlib.shake_128(name.encode()).digest(8 * size), "<u8").copy()


_BYTE = _table("byte", 256)
_PLACE = _table("place", SHINGLE) | np.uint64(1)
_LENGTH = _table("length", SHINGLE + 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``blob`` and where they start; A-Z counts as a-z."""
    space = _SPACE[blob]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    word = np.cumsum(np.bincount(starts, minlength=len(blob))) - 1
    place = np.arange(len(blob)) - starts[np.maximum(word, 0)]
    longest = int(np.diff(np.append(starts, len(blob))).max())
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(longest, _STEP)]))
    value = _BYTE[_FOLD[blob]] * power[np.maximum(place, 0)]
    value[space] = 0
    return _mixed(np.add.reduceat(value, starts)), starts


def _of_slice(texts: list[bytes]) -> list[np.ndarray]:
    blob = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    words, starts = _word_hashes(blob)
    ends = np.cumsum([len(text) + 1 for text in texts])
    last = np.searchsorted(starts, ends)
    first = np.concatenate([[0], last[:-1]])
    n = len(words) - SHINGLE + 1
    if n > 0:
        total = words[:n] * _PLACE[0]
        for i in range(1, SHINGLE):
            total = total + words[i : n + i] * _PLACE[i]
        every = _mixed(total + _LENGTH[SHINGLE])
    found = []
    for a, b in zip(first, last, strict=True):
        if b - a >= SHINGLE:
            found.append(np.unique(every[a : b - SHINGLE + 1]))
        elif b > a:
            few = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64)
            found.append(_mixed(np.array([few], np.uint64) + _LENGTH[b - a]))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def shingle_sets(texts: list[str | None]):
    """The sorted distinct shingle hashes of each text, in order.

    A text with one to four words has one shingle, the whole sequence; a text without
    words has none.
    """
    held, size = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(data) > SLICE_BYTES:
            yield from _of_slice(held)
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield from _of_slice(held)
