"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The splitting pattern of the rank files,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is a machine of eight states over eight symbols. A symbol follows from the
classes of a code point and of the next ones. Transition functions compose
associatively: a block of texts is cut into equal parts, the parts' functions
are composed side by side, a scan over the parts gives the state each begins in,
and a second pass finds the states within. No regular expression is run.

Slices between boundaries go through a cache to ids; new slices are merged pair
by pair, the lowest rank first, the leftmost of equals. ``starts`` keeps where
in ``ids`` each slice begins, so that single slices can be decoded. Null and
empty texts have no ids. Texts are read whole. A worker's cache is emptied when
it is full, which changes no result.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from optiontide.llm.common import lean

LETTER, NUMBER, OTHER, SPACE, BLANK = range(5)
# Symbols of the machine.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_WHITE, S_WHITE_LAST, S_BLANK_LAST = range(8)
# States: in a run of letters, numbers, others or white space; after a leading blank; one or two letters before the end of a
# contraction; after a finished token.
IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, PREFIX, LAST_ONE, LAST_TWO, DONE = range(8)
#: Bytes that a worker's cache of slices may take.
CACHE = 32 << 20
#: Slices up to so many bytes are merged in arrays.
SHORT = 48
NEVER = np.int64(1) << 40
BLOCK = 1 << 18
WIDTH = 256

#: White space of the pattern (fixed values).
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def class_table() -> np.ndarray:
    """The class of every code point, by the Unicode tables of the Python at hand."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), dtype=np.uint8, count=0x110000)
    table[list(WHITE)] = SPACE
    table[0x20] = BLANK
    return table


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary flag by symbol (8 more for the first of a text) and state."""
    to = {S_LETTER: IN_LETTER, S_NUMBER: IN_NUMBER, S_OTHER: IN_OTHER, S_SHORT: LAST_ONE, S_LONG: LAST_TWO, S_WHITE: IN_WHITE, S_WHITE_LAST: DONE, S_BLANK_LAST: PREFIX}
    step, cut = np.zeros((16, 8), dtype=np.uint8), np.ones((16, 8), dtype=bool)
    for symbol, state in to.items():
        step[symbol] = step[symbol + 8] = state
    for symbol, run in ((S_LETTER, IN_LETTER), (S_NUMBER, IN_NUMBER), (S_OTHER, IN_OTHER), (S_SHORT, IN_OTHER), (S_LONG, IN_OTHER)):
        for state in (run, PREFIX):
            step[symbol, state], cut[symbol, state] = run, False
    cut[S_WHITE, IN_WHITE] = False
    step[S_LETTER, LAST_TWO], cut[S_LETTER, LAST_TWO] = LAST_ONE, False
    step[S_LETTER, LAST_ONE], cut[S_LETTER, LAST_ONE] = DONE, False
    return step, cut


STEP, CUT = _machine()


def symbols(codes: np.ndarray, firsts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Symbols of joined texts; ``firsts`` are the places where texts begin (empty texts left out)."""
    kind = table[codes]
    n = len(codes)
    white = kind >= SPACE
    follows = np.zeros(n + 2, dtype=bool)
    follows[: n - 1] = ~white[1:]
    first = np.zeros(n + 3, dtype=bool)
    first[firsts] = True
    follows[:n] &= ~first[1 : n + 1]  # the end of a text counts as white space
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_WHITE], dtype=np.uint8)[kind]
    last = white & follows[:n]
    out[last] = np.where(kind[last] == BLANK, S_BLANK_LAST, S_WHITE_LAST)
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        after = np.zeros(n + 2, dtype=np.uint32)
        after[:n] = codes
        one = np.where(first[quote + 1], 0, after[quote + 1])
        two = np.where(first[quote + 1] | first[quote + 2], 0, after[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[quote[short]] = S_SHORT
        out[quote[long]] = S_LONG
    out[firsts] += 8
    return out


def boundaries(signs: np.ndarray) -> np.ndarray:
    """Places where slices begin, by composing transition functions."""
    n = len(signs)
    rows = -(-n // WIDTH)
    grid = np.zeros(rows * WIDTH, dtype=np.uint8)
    grid[:n] = signs
    columns = np.ascontiguousarray(grid.reshape(rows, WIDTH).T)
    flat = STEP.ravel()
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for c in range(WIDTH):
        whole = flat[(columns[c].astype(np.int16) * 8)[:, None] + whole]
    begin = np.empty(rows, dtype=np.uint8)
    state = DONE
    for r, row in enumerate(whole.tolist()):
        begin[r] = state
        state = row[state]
    cuts, cut = np.empty((WIDTH, rows), dtype=bool), CUT.ravel()
    state = begin
    for c in range(WIDTH):
        at = columns[c].astype(np.int16) * 8 + state
        cuts[c], state = cut[at], flat[at]
    return np.flatnonzero(cuts.T.ravel()[:n])


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: neighbours of the lowest rank are merged, the leftmost first."""
    n = len(piece)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ids that merge, sorted (left << 32 | right), and what they merge to."""
    pairs = {}
    for word, rank in ranks.items():
        for i in range(1, len(word)):
            left, right = ranks.get(word[:i]), ranks.get(word[i:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    keys = np.array(sorted(pairs), dtype=np.int64)
    return keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)


class Merger:
    """Ids of slices; short new ones are merged side by side in arrays, and slices seen before come from a cache."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray] | None = None):
        self.ranks, self.cache, self.held = ranks, {}, 0
        self.keys, self.values = pairs or pair_table(ranks)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged neighbours, NEVER where they don't merge; ids of -1 are padding."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], NEVER)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of slices of similar length, all merged one pair a round."""
        width = max(map(len, pieces))
        codes = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), width)
        ids = np.where(np.arange(width) < np.array([len(p) for p in pieces])[:, None], self.bytes[codes], -1)
        ranks, rows, out = self.pair_ranks(ids[:, :-1], ids[:, 1:]), np.arange(len(pieces)), [[]] * len(pieces)
        while len(rows):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            lowest = ranks[np.arange(len(rows)), best] if ranks.shape[1] else np.full(len(rows), NEVER)
            done = lowest == NEVER
            for r, own in zip(rows[done].tolist(), ids[done].tolist(), strict=True):
                out[r] = [i for i in own if i >= 0]
            ids, ranks, rows, best, lowest = ids[~done], ranks[~done], rows[~done], best[~done], lowest[~done]
            if not len(rows):
                break
            line = np.arange(len(rows))
            ids[line, best] = lowest
            keep = np.ones(ids.shape, dtype=bool)
            keep[line, best + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            ranks = ranks[keep[:, 1:]].reshape(len(rows), -1)
            if ranks.shape[1]:
                after = np.minimum(best, ranks.shape[1] - 1)
                ranks[line, after] = self.pair_ranks(ids[line, after], ids[line, after + 1])
                before = np.maximum(best - 1, 0)
                ranks[line, before] = self.pair_ranks(ids[line, before], ids[line, before + 1])
        return out

    def learn(self, slices: set[str]) -> None:
        """Put the ids of slices into the cache, which is emptied first when it is full."""
        if self.held > CACHE:
            self.cache, self.held = {}, 0
        new = [t for t in slices if t not in self.cache]
        self.held += sum(map(len, new)) * 10 + 250 * len(new)  # string, list and entry; at most an id for each byte
        short = []
        for text in new:
            piece = text.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(piece)
            if whole is not None:
                self.cache[text] = [whole]
            elif len(piece) > SHORT:
                self.cache[text] = merge_pairs(piece, self.ranks)
            else:
                short.append((len(piece), text, piece))
        short.sort(key=lambda x: x[0])
        for at in range(0, len(short), 4096):
            part = short[at : at + 4096]
            self.cache.update(zip([x[1] for x in part], self.merge_many([x[2] for x in part]), strict=True))


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file: a base64 word and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


def encode_texts(texts: list[str], merger: Merger, table: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids of each text, and the place among them where each slice begins."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    joined = "".join(texts)
    if joined:
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        cuts = boundaries(symbols(codes, begins[:-1][lengths > 0], table))
    else:
        cuts = np.zeros(0, dtype=np.int64)
    edges = [*cuts.tolist(), len(joined)]
    slices = [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    merger.learn(set(slices))
    found = list(map(merger.cache.__getitem__, slices))
    ids = np.fromiter(chain.from_iterable(found), dtype=np.int32)
    places = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))])
    parts = np.searchsorted(cuts, begins)
    at = places[parts]
    starts = places[:-1] - np.repeat(at[:-1], np.diff(parts))
    return pa.ListArray.from_arrays(at.astype(np.int32), ids), pa.ListArray.from_arrays(parts.astype(np.int32), starts.astype(np.int32))


def _with(df: DataFrame, **kinds: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, k) for n, k in kinds.items()]])


def encode(df: DataFrame, text: str, rank_file: str) -> DataFrame:
    """``df`` with ``ids`` (array<int>) and ``starts`` (place in ids where each slice begins); columns of these names are replaced.

    ``rank_file`` is read on the driver; its table and the class table are
    broadcast, a few MB whatever the input.
    """
    kept = [c for c in df.columns if c.lower() not in ("ids", "starts")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    shared = df.sparkSession.sparkContext.broadcast((ranks := read_ranks(rank_file), class_table(), pair_table(ranks)))
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, table, pairs = shared.value
        merger = Merger(ranks, pairs)
        for whole in batches:
            for batch in blocks_of(whole, place):
                texts = [t or "" for t in batch.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *encode_texts(texts, merger, table)], [*kept, "ids", "starts"])

    return rows.mapInArrow(lean(run), _with(rows, ids=T.ArrayType(T.IntegerType()), starts=T.ArrayType(T.IntegerType())))


def round_trip(df: DataFrame, text: str, rank_file: str) -> DataFrame:
    """``df`` with ``ids`` and ``decoded`` in place of its text: every text is encoded, and the ids are decoded again, by the same worker.

    One worker a task instead of the two of ``decode`` after ``encode``, and the text does not come back from it.
    """
    kept = [c for c in df.columns if c.lower() not in ("ids", "decoded") and c != text]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    ranks = read_ranks(rank_file)
    shared = df.sparkSession.sparkContext.broadcast((ranks, class_table(), pair_table(ranks), word_table(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, table, pairs, words = shared.value
        merger = Merger(ranks, pairs)
        for whole in batches:
            for batch in blocks_of(whole, len(kept)):
                ids, _ = encode_texts([t or "" for t in batch.column(len(kept)).to_pylist()], merger, table)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, decode_ids(ids, words)], [*kept, "ids", "decoded"])

    left = rows.drop("__text")
    return rows.mapInArrow(lean(run), _with(left, ids=T.ArrayType(T.IntegerType()), decoded=T.BinaryType()))


def blocks_of(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with texts of about ``BLOCK`` bytes, a longer text on its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
    total, at = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and total + size > BLOCK:
            yield batch.slice(at, i - at)
            total, at = 0, i
        total += size
    if batch.num_rows > at:
        yield batch.slice(at)


def word_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids joined, and where each id's begin and how many they are (-1 for an id that is none)."""
    begin, size = np.zeros(max(ranks.values()) + 1, dtype=np.int64), np.full(max(ranks.values()) + 1, -1, dtype=np.int64)
    joined = bytearray()
    for word, rank in ranks.items():
        begin[rank], size[rank] = len(joined), len(word)
        joined += word
    return np.frombuffer(bytes(joined), dtype=np.uint8), begin, size


def decode_ids(ids: pa.ListArray, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    """The bytes of each list of ids, gathered for all lists at once; null lists give null."""
    data, begin, size = words
    offsets = ids.offsets.to_numpy()
    own = ids.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = size[own]
    if (sizes < 0).any() or (own < 0).any():
        raise ValueError("an id without bytes")
    ends = np.concatenate([[0], np.cumsum(sizes)])
    gathered = data[np.repeat(begin[own] - ends[:-1], sizes) + np.arange(ends[-1])]
    at = ends[offsets - offsets[0]].astype(np.int32)
    out = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at), pa.py_buffer(gathered)])
    return pc.if_else(ids.is_null(), pa.scalar(None, pa.binary()), out) if ids.null_count else out


def decode(df: DataFrame, ids: str, rank_file: str) -> DataFrame:
    """``df`` with ``decoded`` (binary), the bytes of the ids joined; null ids give null, an unknown id fails."""
    kept = [c for c in df.columns if c.lower() != "decoded"]
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    shared = df.sparkSession.sparkContext.broadcast(word_table(read_ranks(rank_file)))
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, at = batch.column(place).offsets.to_numpy(), 0
            while at < batch.num_rows:  # about BLOCK / 4 ids at a time, a longer list on its own
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK // 4, side="right")) - 1)
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_ids(part.column(place), shared.value)], [*kept, "decoded"])
                at = end

    return rows.mapInArrow(lean(run), _with(rows, decoded=T.BinaryType()))


def decode_slice(ids: list[int], starts: list[int], slice_no: int, words: dict[int, bytes]) -> bytes:
    """The bytes of one slice of an encoded text."""
    stop = starts[slice_no + 1] if slice_no + 1 < len(starts) else len(ids)
    return b"".join(words[i] for i in ids[starts[slice_no] : stop])
