"""Severity of toxic texts by cumulative-link ordinal regression.

Features are hashed words and word beginnings (runs of letters, A-Z lowered),
counted over whole texts. Those whose presence tells graded texts apart
are kept; their counts enter as log(1 + count). One weight vector is shared by
all thresholds: P(grade <= g) = logistic(threshold[g] - weights . features), with
the thresholds in order. The result is the expected grade.

Fitting uses at most ``SAMPLE`` labelled texts, those with the smallest key
hashes; feature frequencies are counted on Spark, and the driver holds
``FEATURES`` numbers for each text of the sample. Scoring covers every text; null
and empty texts have no features and score by the thresholds alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optiontide.llm import shingles
from optiontide.llm.common import Folder
from optiontide.llm.shingles import mixed

SAMPLE = 6000
FEATURES = 256
LEAST_TEXTS = 5
LEAST_SCORE = 4.0
HEADS = (4, 5, 6, 8)
STEPS = 40
SHRINK = 1e-4

_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


def _hashed(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every word and word beginning of joined texts."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    word = _LETTER[data]
    apart = np.zeros(len(data) + 1, dtype=bool)
    apart[begins] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | apart[1:-1]
    last[:-1] &= ~word[1:] | apart[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, back = shingles._powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(shingles._VALUE[data] * up, out=sums[1:])
    owner = np.searchsorted(begins, starts, side="right") - 1
    owners, out = [owner], [mixed((sums[ends] - sums[starts]) * back[starts])]
    for n in HEADS:
        there = ends - starts > n
        at = starts[there]
        owners.append(owner[there])
        out.append(mixed((sums[at + n] - sums[at]) * back[at] + np.uint64(n)))
    return np.concatenate(owners), np.concatenate(out).view(np.int64)


def text_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, feature hash) in pieces; a long text comes in several."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        if offsets[at + 1] - offsets[at] > shingles.BLOCK:
            begin, stop = int(offsets[at]), int(offsets[at + 1])
            while begin < stop:
                end = min(stop, begin + shingles.BLOCK)
                while end < stop and _LETTER[data[end]]:
                    end += 1
                owner, found = _hashed(data[begin:end], np.array([0, end - begin]))
                yield owner + at, found
                begin = end
            at += 1
            continue
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + shingles.BLOCK, side="right")) - 1)
        owner, found = _hashed(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        yield owner + at, found
        at = end


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per feature and grade, summed within a batch."""
    for batch in batches:
        grades = batch.column("grade").to_numpy().astype(np.int64)
        seen = [np.unique(np.stack([o, f]), axis=1) for o, f in text_features(batch.column("text")) if len(o)]
        if not seen:
            continue
        pairs = np.unique(np.concatenate(seen, axis=1), axis=1)
        cells, counts = np.unique(np.stack([pairs[1], grades[pairs[0]]]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cells[0]), pa.array(cells[1].astype(np.int32)), pa.array(counts)], ["feature", "grade", "texts"])


def _counted(features: np.ndarray, texts: pa.Array) -> np.ndarray:
    """log(1 + count) of the sorted ``features`` in each text."""
    out = np.zeros((len(texts), len(features)))
    if len(features):
        for owner, found in text_features(texts):
            at = np.minimum(np.searchsorted(features, found), len(features) - 1)
            hit = features[at] == found
            np.add.at(out, (owner[hit], at[hit]), 1)
    return np.log1p(out)


@dataclass
class SeverityModel:
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, rows: np.ndarray) -> np.ndarray:
        """P(grade > g) for each threshold g."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - (rows @ self.weights)[:, None], -50, 50)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_ordinal(rows: np.ndarray, grades: np.ndarray, levels: int, steps: int = STEPS, shrink: float = SHRINK) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds: penalised likelihood by Fisher scoring with halved steps."""
    n, width = rows.shape
    share = np.array([(grades <= g).mean() for g in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    free = np.concatenate([np.zeros(width), np.log(share / (1 - share)) + 1e-3 * np.arange(levels - 1)])
    penalty = np.concatenate([np.full(width, shrink), np.full(levels - 1, 1e-9)])

    def chances(free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(grade <= g) with 0 and 1 at the ends, and P(grade = g)."""
        below = _logistic(free[width:][None, :] - (rows @ free[:width])[:, None])
        below = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        return below, np.maximum(np.diff(below, axis=1), 1e-12)

    def loss(free: np.ndarray) -> float:
        if (np.diff(free[width:]) <= 0).any():
            return np.inf
        return -np.log(chances(free)[1][np.arange(n), grades]).mean() + 0.5 * (penalty * free**2).sum()

    now = loss(free)
    for _ in range(steps):
        below, each = chances(free)
        steep = below * (1 - below)
        slope, curve = np.zeros_like(free), np.zeros((len(free), len(free)))
        for g in range(levels):
            moves = np.zeros((n, len(free)))
            moves[:, :width] = -(steep[:, g + 1] - steep[:, g])[:, None] * rows
            if g < levels - 1:
                moves[:, width + g] = steep[:, g + 1]
            if g:
                moves[:, width + g - 1] -= steep[:, g]
            curve += (moves / each[:, g : g + 1]).T @ moves / n
            own = grades == g
            slope -= (moves[own] / each[own, g : g + 1]).sum(axis=0) / n
        step = np.linalg.solve(curve + np.diag(penalty + 1e-9), slope + penalty * free)
        size = 1.0
        while size > 1e-6 and loss(free - size * step) >= now:
            size /= 2
        if size <= 1e-6:
            break
        free = free - size * step
        before, now = now, loss(free)
        if before - now < 1e-7:
            break
    return free[:width], free[width:]


def fit(df: DataFrame, labels: DataFrame, key: str, text: str, grade: Column, levels: int, sample: int = SAMPLE) -> SeverityModel | None:
    """A model from at most ``sample`` rows of ``labels`` with a grade from 0 to ``levels`` - 1; None if there is none.

    The sample is chosen from keys and grades alone and is small enough to be
    broadcast to the texts. A key that repeats counts once, with its highest grade.
    """
    keys = labels.select(F.col(key).alias("__key"), grade.cast("int").alias("grade")).where("__key is not null and grade is not null")
    keys = keys.groupBy("__key").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("__key"), "__key").limit(sample)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(keys), F.col("key") == F.col("__key"))
    few = Folder(df, "severity").put(rows.dropDuplicates(["key"]).select("grade", "text"), "sample")
    counts = few.mapInArrow(_frequencies, "feature long, grade int, texts long").groupBy("feature").agg(
        *[F.sum(F.when(F.col("grade") > g, F.col("texts")).otherwise(0)).alias(f"above{g}") for g in range(levels - 1)], F.sum("texts").alias("texts"))
    totals = few.groupBy("grade").count().collect()
    total = sum(r["count"] for r in totals)
    if not total:
        return None
    scores = []
    for g in range(levels - 1):
        share = sum(r["count"] for r in totals if r["grade"] > g) / total
        if 0 < share < 1:
            spread = F.sqrt(F.col("texts") * share * (1 - share) * (1 - F.col("texts") / F.lit(float(total))) + 1e-9)
            scores.append((F.col(f"above{g}") - F.col("texts") * share) / spread)
    if not scores:
        return None
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    chosen = counts.where((F.col("texts") >= LEAST_TEXTS) & (best >= LEAST_SCORE)).orderBy(best.desc(), "feature").limit(FEATURES).select("feature").collect()
    features = np.sort(np.array([r[0] for r in chosen], dtype=np.int64))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _counted(features, batch.column("text")).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array([v.tobytes() for v in values], pa.binary())], ["grade", "row"])

    found = few.mapInArrow(counted, "grade int, row binary").toArrow().to_pydict()
    matrix = np.stack([np.frombuffer(b, dtype=np.float32) for b in found["row"]]).astype(np.float64)
    grades = np.array(found["grade"], dtype=np.int64)
    order = np.lexsort((*matrix.T, grades)) if len(features) else np.argsort(grades)
    weights, thresholds = fit_ordinal(matrix[order], grades[order], levels)
    return SeverityModel(features, weights, thresholds)


def severity(df: DataFrame, text: str, model: SeverityModel | None) -> DataFrame:
    """``df`` with ``severity`` (the expected grade), ``grade`` (thresholds passed) and ``toxic`` (the last one passed).

    Columns of these names are replaced; without a model they are 0, 0 and false.
    """
    kept = [c for c in df.columns if c.lower() not in ("severity", "grade", "toxic")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                if model is None:
                    above = np.zeros((part.num_rows, 1))
                else:
                    above = model.above(_counted(model.features, part.column(place)))
                grade = (above >= 0.5).sum(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(above.sum(axis=1)), pa.array(grade), pa.array(above[:, -1] >= 0.5)], [*kept, "severity", "grade", "toxic"])

    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema.add("severity", "double").add("grade", "integer").add("toxic", "boolean")
    return rows.mapInArrow(run, schema)
