"""Word shingles of whole texts as sets of 64-bit numbers, in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed together.
BLOCK = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUE = mixed(_LOWER.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("back", _BACK)):
            steps = np.full(n, np.uint64(base), dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["back"][:n]


def word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of joined texts; ``begins`` has the texts' first places and the end."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    word = ~_SPACE[data]
    apart = np.zeros(len(data) + 1, dtype=bool)
    apart[begins] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | apart[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | apart[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, back = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(begins, starts, side="right") - 1


def _long_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, cut at white space."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data):  # up to the next white space
            gap = np.flatnonzero(_SPACE[data[end : end + BLOCK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + BLOCK)
        out.append(word_hashes(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _sets(hashes: np.ndarray, counts: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles per text from the word hashes of several texts in turn."""
    weights = [mixed(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1) for k in range(words)]
    wide = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
    for k in range(words):
        wide += hashes[k : k + len(wide)] * weights[k]
    wide = mixed(wide)
    at = 0
    for n in counts.tolist():
        if n >= words:
            yield np.unique(wide[at : at + n - words + 1])
        elif n:
            short = np.array([n], dtype=np.uint64)
            for k in range(n):
                short = mixed(short + hashes[at + k : at + k + 1] * weights[k])
            yield short
        else:
            yield np.zeros(0, dtype=np.uint64)
        at += n


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The set of each text of an Arrow string column: its distinct runs of ``words`` lower-cased words.

    A text with fewer words is one shingle, one without words (or null) has
    none. Small texts are hashed block by block, a long one on its own.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        if offsets[at + 1] - offsets[at] > BLOCK:
            hashes = _long_words(data[offsets[at] : offsets[at + 1]])
            yield from _sets(hashes, np.array([len(hashes)]), words)
            at += 1
            continue
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, side="right")) - 1)
        begins = offsets[at : end + 1] - offsets[at]
        hashes, owner = word_hashes(data[offsets[at] : offsets[end]], begins)
        yield from _sets(hashes, np.bincount(owner, minlength=end - at), words)
        at = end
