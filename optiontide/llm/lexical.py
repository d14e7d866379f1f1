"""Ranked lexical search by the Best Position Algorithm.

A document's score for an item is the sum of the impacts of the item's terms in
it. For every term an impact list holds its documents by falling impact. Lists are read
side by side; a document that turns up is looked up in all other lists (direct
access), which also tells its positions there. A list's best position is the last one
up to which every position has been seen, by either way. Documents not seen yet stand behind the best positions in all lists, so the
sum of the impacts right behind them is a bound; reading stops when it is strictly below the k-th score, so documents of equal scores are
all seen.

On Spark, one pass counts the items' terms in every text and writes them by
document; document counts and lengths of the whole corpus are aggregated from that, and
impacts follow from them. A task turns the documents of its partition into segments of at
most ``SEGMENT`` occurrences, runs the algorithm per segment and item, and carries each item's k best from one segment to the
next, so the bar rises. What tasks found meets in a ranking per item (at most k rows of an item from each task).
No text and no list is shuffled. Items are dealt by hash to blocks of about ``TERMS`` terms, each a pass of its own over all
documents, so what is sent to the tasks has a bound.

Terms are maximal runs of digits, letters and characters beyond ASCII, only A-Z lower-cased. All scores are 64-bit integers.

Defined cases: null and empty texts have no terms and are never found; items without terms, or whose terms occur nowhere, have no rows. Rows that
share an item id form one item with all their terms; a null id is an item. Every row of the documents ranks on its own, also
where ids repeat; equal scores go by ascending document id, null last. Long texts are counted piece by piece. Other columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from optiontide.llm.common import Folder
from optiontide.llm.quality import _views

#: Terms of a block of items, occurrences in a segment, bytes of a text that are split at once.
TERMS = 500_000
SEGMENT = 1_000_000
PIECE = 1 << 20
#: Positions of every list that are read at a time, at first and at most.
FIRST, MOST = 16, 1024

_SPLIT = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms_of(text: memoryview | bytes) -> Iterator[list[bytes]]:
    """All terms of a text, a piece of about ``PIECE`` bytes at a time."""
    rest = b""
    for at in range(0, len(text), PIECE):
        part = rest + bytes(text[at : at + PIECE]).translate(_SPLIT)
        if at + PIECE < len(text):
            cut = part.rfind(b" ") + 1  # the last term may go on
            part, rest = part[:cut], part[cut:]
        yield part.split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Corpus:
    """Documents with a term, all terms, and the weight of each term that occurs, by its number."""

    documents: int
    terms: int
    weights: np.ndarray

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms."""
        if len(n) and int(n.max()) * self.documents * 50 < 1 << 62:
            return 50 + (50 * n * self.documents) // self.terms
        return np.array([50 + (50 * int(x) * self.documents) // self.terms for x in n], dtype=np.int64)

    def impacts(self, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Segment:
    """Impact lists of the occurrences of some documents: by falling impact, and by document for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int):
        self.n_docs = n_docs
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.terms, self.begins = np.unique(term[order], return_index=True)
        self.ends = np.append(self.begins[1:], len(order))
        self.position = np.arange(len(order)) - np.repeat(self.begins, self.ends - self.begins)
        by_doc = np.lexsort((self.doc, term[order]))
        self.by_doc, self.doc_sorted = by_doc, self.doc[by_doc]

    def lists(self, terms: np.ndarray) -> list[tuple[int, int]]:
        """Where the lists of terms begin and end; lists without weight or documents are left out."""
        at = np.searchsorted(self.terms, terms)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)] if len(self.terms) else at[:0]
        return [(int(self.begins[i]), int(self.ends[i])) for i in at if self.impact[self.begins[i]] > 0]

    def looked_up(self, span: tuple[int, int], docs: np.ndarray) -> np.ndarray:
        """Places of documents in a list, -1 where it does not hold them."""
        begin, end = span
        at = begin + np.searchsorted(self.doc_sorted[begin:end], docs)
        there = (at < end) & (self.doc_sorted[np.minimum(at, end - 1)] == docs)
        return np.where(there, self.by_doc[np.minimum(at, end - 1)], -1)


def best_positions(segment: Segment, terms: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and scores that may be among the k best, and positions read: every document with a score of at least
    ``bar`` that k others do not beat.

    ``bar`` is a score that k documents elsewhere reach already.
    """
    spans = segment.lists(terms)
    seen_docs = np.zeros(segment.n_docs, dtype=bool)
    seen = [np.zeros(end - begin, dtype=bool) for begin, end in spans]
    best = [0] * len(spans)  # places right behind the best positions: all before them have been seen
    docs, scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    top, read, depth, step = np.zeros(0, dtype=np.int64), 0, 0, FIRST
    while spans:
        bound = sum(int(segment.impact[begin + at]) for (begin, end), at in zip(spans, best, strict=True) if begin + at < end)
        kth = max(bar, int(top.min())) if len(top) == k else bar
        if bound < max(kth, 1):
            break
        new = []
        for (begin, end), marks in zip(spans, seen, strict=True):
            marks[depth : depth + step] = True
            new.append(segment.doc[min(begin + depth, end) : min(begin + depth + step, end)])
            read += len(new[-1])
        found = np.unique(np.concatenate(new))
        found = found[~seen_docs[found]]
        seen_docs[found] = True
        total = np.zeros(len(found), dtype=np.int64)
        for span, marks in zip(spans, seen, strict=True):
            at = segment.looked_up(span, found)
            own = at >= 0
            total[own] += segment.impact[at[own]]
            marks[at[own] - span[0]] = True
        docs.append(found)
        scores.append(total)
        top = np.concatenate([top, total])
        if len(top) > k:
            top = np.partition(top, len(top) - k)[-k:]
        for i, marks in enumerate(seen):
            rest = np.flatnonzero(~marks[best[i] : best[i] + 2 * MOST + step])
            while not len(rest) and best[i] < len(marks):  # a whole stretch has been seen
                best[i] = min(best[i] + 2 * MOST + step, len(marks))
                rest = np.flatnonzero(~marks[best[i] : best[i] + 2 * MOST + step])
            best[i] = best[i] + int(rest[0]) if len(rest) else len(marks)
        depth, step = depth + step, min(2 * step, MOST)
    return np.concatenate(docs), np.concatenate(scores), read


class Ranking:
    """The k best rows of each item so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, {}

    def bar(self, item: int) -> int:
        rows = self.rows.get(item, ())
        return int(rows[-1][0]) if len(rows) == self.k else 0

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        rows = [*self.rows.get(item, ()), *[(s, d) for s, d in zip(scores.tolist(), ids, strict=True) if s > 0]]
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
        self.rows[item] = rows[: self.k]


def _counted(numbers: dict[bytes, int]):
    """doc, text to doc, n (terms of the text), term numbers and how often they occur, of the terms in ``numbers``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, times = [], [], []
            for text in _views(batch.column(1)):
                size, found = 0, Counter()
                for part in terms_of(text):
                    size += len(part)
                    found.update(filter(numbers.__contains__, part))
                n.append(size)
                own = sorted((numbers[t], c) for t, c in found.items())
                terms.append([t for t, _ in own])
                times.append([c for _, c in own])
            whole = pa.list_(pa.int32()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, whole[0]), pa.array(times, whole[1])], ["doc", "n", "terms", "times"])

    return run


def _searched(items: list[np.ndarray], corpus: Corpus, k: int):
    """doc, n, terms, times to item, doc, score: the k best of each item among a task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking, parts, held, kind = Ranking(k), [], 0, None

        def search() -> None:
            ids = [d for batch in parts for d in batch.column(0).to_pylist()]
            sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in parts])
            term = np.concatenate([b.column(2).flatten().to_numpy() for b in parts])
            tf = np.concatenate([b.column(3).flatten().to_numpy() for b in parts])
            m = corpus.lengths(np.concatenate([b.column(1).to_numpy() for b in parts]))
            doc = np.repeat(np.arange(len(ids)), sizes)
            segment = Segment(doc, term, corpus.impacts(term, tf, m[doc]), len(ids))
            for item, terms in enumerate(items):
                docs, scores, _ = best_positions(segment, terms, k, ranking.bar(item))
                good = scores >= max(1, ranking.bar(item))
                docs, scores = docs[good], scores[good]
                if len(docs):
                    if len(docs) > k:  # all that reach the k-th score, so that ids decide among equals
                        reach = scores >= np.partition(scores, len(scores) - k)[-k]
                        docs, scores = docs[reach], scores[reach]
                    ranking.add(item, scores, [ids[d] for d in docs.tolist()])
            parts.clear()

        for whole in batches:
            kind = whole.schema.field(0).type
            offsets, at = whole.column(2).offsets.to_numpy(), 0
            while at < whole.num_rows:
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT - held, side="right")) - 1)
                end = min(end, whole.num_rows)
                parts.append(whole.slice(at, end - at))
                held += int(offsets[end] - offsets[at]) + (end - at)
                if held >= SEGMENT or end < whole.num_rows:
                    search()
                    held = 0
                at = end
        if parts:
            search()
        if kind is not None:
            found = [(item, d, s) for item, rows in ranking.rows.items() for s, d in rows]
            item, docs, scores = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(docs, kind), pa.array(scores, pa.int64())], ["item", "doc", "score"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item text."""
    for batch in batches:
        owner, found = [], []
        for i, text in enumerate(_views(batch.column(1))):
            own = sorted({t for part in terms_of(text) for t in part})
            owner += [i] * len(own)
            found += own
        own = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(own), pa.array(found, pa.binary())], ["item", "term"])


def search(documents: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text", k: int = 50) -> DataFrame:
    """item, rank (from 1), doc, score: the ``k`` best documents of each item, scores above 0."""
    folder = Folder(documents, "lexical")
    item_kind, doc_kind = (df.schema[c].dataType.simpleString() for df, c in ((items, item), (documents, doc)))
    pairs = items.select(F.col(item).alias("item"), F.col(query).alias("text")).mapInArrow(_item_terms, f"item {item_kind}, term binary").distinct()
    pairs = folder.put(pairs, "pairs")
    blocks = -(-max(pairs.count(), 1) // TERMS)
    listed = pairs.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    rows = documents.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    ranked = None
    for block in range(blocks):
        found = listed.where(F.col("block") == block).select("item", "term").toArrow().to_pydict()
        numbers = {t: i for i, t in enumerate(sorted(set(found["term"])))}
        names = sorted(set(found["item"]), key=lambda x: (x is None, x if x is not None else 0))
        places, owned = {n: i for i, n in enumerate(names)}, [[] for _ in names]
        for own, term in zip(found["item"], found["term"], strict=True):
            owned[places[own]].append(numbers[term])
        owned = [np.array(sorted(x), dtype=np.int32) for x in owned]
        counted = folder.put(rows.mapInArrow(_counted(numbers), f"doc {doc_kind}, n long, terms array<int>, times array<long>"), f"counted-{block}")
        total = counted.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not total["documents"]:
            continue
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for each term of the block
        weights = np.zeros(len(numbers), dtype=np.int64)
        for r in holding:
            weights[r["term"]] = weight(total["documents"], r["count"])
        corpus = Corpus(total["documents"], total["terms"], weights)
        best = counted.where("size(terms) > 0").mapInArrow(_searched(owned, corpus, k), f"item int, doc {doc_kind}, score long")
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())))
        best = best.where(F.col("rank") <= k)
        named = documents.sparkSession.createDataFrame(list(enumerate(names)), f"__number int, __name {item_kind}")
        best = best.join(F.broadcast(named), F.col("item") == F.col("__number"))
        best = folder.put(best.select(F.col("__name").alias(item), "rank", F.col("doc").alias(doc), "score"), f"best-{block}")
        ranked = best if ranked is None else ranked.union(best)
    if ranked is None:
        return documents.sparkSession.createDataFrame([], f"{item} {item_kind}, rank int, {doc} {doc_kind}, score long")
    return ranked
