"""Quality of texts by compression.

Two zstandard dictionaries are built, from text labelled good and from text
labelled bad. A text is compressed in pieces of ``PIECE`` bytes with either,
so the dictionaries matter as much at its end as at its beginning. Two normalised
size differences describe it: between the two results, over their sum, and between the raw text
and the good result, over the raw size (repetition shows there). Logistic regression on these and their products,
fitted on labelled texts that were not used for the dictionaries, gives the calibrated score.

Bounds: at most ``SAMPLE`` labelled texts of each label, those with the smallest key
hashes; the first third of them builds the dictionaries, with at most ``LEARNT`` pieces of a text, spread over the whole of it; the rest
calibrates by whole texts. The driver holds these pieces and two numbers for each
calibrating text. Scoring covers every whole text.

Defined cases: null and empty texts have no size, so both differences are 0. Labels of a key that repeats
count once, the least one; of texts that repeat a key, the one with the least hash counts. Without labels of both
kinds there is no model and every score is 0.5. Equal texts get equal scores, repeated rows stay. Other columns stay; one called
``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from optiontide.llm.common import Folder

SAMPLE = 3000
LEARNT = 8
PIECE = 1024
DICTIONARY = 1 << 16
LEVEL = 3
#: Range of the difference between the dictionaries that is told apart, and least share of the raw size.
WIDEST, LEAST = 0.5, 1e-3
RIDGE = 0.1
STEPS = 30


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; of few or short pieces that can't be trained on, their own end."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


class Sizes:
    """Compressed sizes of whole texts with two dictionaries, without the frames' own bytes."""

    def __init__(self, good: bytes, bad: bytes):
        options = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.tools = []
        for data in (good, bad):
            words = zstandard.ZstdCompressionDict(data)
            words.precompute_compress(compression_params=options)
            tool = zstandard.ZstdCompressor(compression_params=options, dict_data=words)
            self.tools.append((tool, len(tool.compress(b""))))

    def differences(self, text: memoryview | bytes) -> tuple[float, float]:
        """(bad - good) / (bad + good), and (raw - good) / raw; 0, 0 for no bytes."""
        if not len(text):
            return 0.0, 0.0
        good, bad = (
            sum(len(tool.compress(text[at : at + PIECE])) - frame for at in range(0, len(text), PIECE)) for tool, frame in self.tools)
        return (bad - good) / max(bad + good, 1), 1 - good / len(text)


def _features(differences: np.ndarray) -> np.ndarray:
    """Both differences on scales near 1, their squares and their product, and a constant."""
    between = np.clip(differences[:, 0], -WIDEST, WIDEST) / WIDEST
    left = np.log(np.maximum(1 - differences[:, 1], LEAST))
    return np.stack([np.ones(len(between)), between, left, between * between, left * left, between * left], axis=1)


@dataclass
class QualityModel:
    """Dictionaries, and the logistic weights of the scaled features."""

    good: bytes
    bad: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def scores(self, differences: np.ndarray) -> np.ndarray:
        raw = (((_features(differences) - self.mean) / self.spread) * self.weights).sum(axis=1)
        return np.round(1 / (1 + np.exp(-np.clip(raw, -30, 30))), 9)  # free of what block a text is in


def calibrated(differences: np.ndarray, good: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, spread and logistic weights for texts of which ``share`` are good outside the sample."""
    rows = _features(differences)
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    mean[0], spread[0] = 0, 1
    rows = (rows - mean) / spread
    balance = np.where(good == 1, share / max(good.mean(), 1e-9), (1 - share) / max(1 - good.mean(), 1e-9))
    weights, ridge = np.zeros(rows.shape[1]), RIDGE * np.array([0, 1, 1, 1, 1, 1])
    for _ in range(STEPS):
        found = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (balance * (found - good)) + ridge * weights
        curve = (rows * (balance * found * (1 - found))[:, None]).T @ rows + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        weights = weights - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return mean, spread, weights


def _views(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each text of a column, without copies; none for null."""
    wide = column.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = memoryview(wide.buffers()[2] or b"")
    for i, valid in enumerate(wide.is_valid().to_pylist()):
        yield data[offsets[i] : offsets[i + 1]] if valid else data[:0]


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``LEARNT`` pieces of each text, spread over the whole of it."""
    for batch in batches:
        good, mark, number, pieces = [], [], [], []
        for label, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _views(batch.column(2)), strict=True):
            last = max(0, len(text) - 1) // PIECE
            for n, k in enumerate(np.unique(np.linspace(0, last, LEARNT).astype(np.int64)).tolist()):
                good.append(label)
                mark.append(key)
                number.append(n)
                pieces.append(bytes(text[k * PIECE : (k + 1) * PIECE]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(good, pa.int32()), pa.array(mark, pa.int64()), pa.array(number, pa.int32()), pa.array(pieces, pa.binary())],
            ["good", "mark", "number", "piece"])


def fit(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> QualityModel | None:
    """A model from at most ``sample`` rows of ``labels`` for each of label 1 and 0; None unless there are both.

    The sample is chosen from keys and labels alone and is small enough to be broadcast to the texts.
    """
    known = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("good")).where("__key IS NOT NULL AND good IN (0, 1)")
    known = known.groupBy("__key").agg(F.min("good").alias("good"))
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    if len(counts) < 2:
        return None
    few = [known.where(F.col("good") == g).orderBy(F.xxhash64("__key"), "__key").limit(sample) for g in (0, 1)]
    order = Window.partitionBy("good").orderBy(F.xxhash64("__key"), "__key")  # 2 * sample rows
    few = few[0].union(few[1]).withColumn("rank", F.row_number().over(order))
    third = F.when(F.col("good") == 1, F.lit(-(-min(counts[1], sample) // 3))).otherwise(F.lit(-(-min(counts[0], sample) // 3)))
    few = few.withColumn("builds", F.col("rank") <= third)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(few), F.col("key") == F.col("__key"))
    rows = rows.groupBy("key").agg(F.min_by(F.struct("good", "builds", F.coalesce("text", F.lit("")).alias("text")), F.struct(F.xxhash64("text"), "text")).alias("x"))
    chosen = Folder(df, "quality").put(rows.select(F.xxhash64("key").alias("mark"), "x.*"), "sample")

    found = chosen.where("builds").select("good", "mark", "text").mapInArrow(_learnt, "good int, mark long, number int, piece binary").toArrow()
    found = found.sort_by([("mark", "ascending"), ("number", "ascending")]).to_pydict()
    good, bad = (_dictionary([p for g, p in zip(found["good"], found["piece"], strict=True) if g == own]) for own in (1, 0))
    if not good or not bad:
        return None

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for batch in batches:
            pairs = np.array([sizes.differences(t) for t in _views(batch.column(1))]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["good", "between", "raw"])

    rest = chosen.where("NOT builds").select("good", "text").mapInArrow(measured, "good int, between double, raw double").toArrow()
    rest = rest.sort_by([("good", "ascending"), ("between", "ascending"), ("raw", "ascending")])
    marks = rest["good"].to_numpy()
    if len(set(marks.tolist())) < 2:
        return None
    share = counts[1] / (counts[0] + counts[1])
    return QualityModel(good, bad, *calibrated(np.stack([rest["between"].to_numpy(), rest["raw"].to_numpy()], axis=1), marks, share))


def score(df: DataFrame, text: str, model: QualityModel | None) -> DataFrame:
    """``df`` with ``score`` from 0 to 1, the chance of label 1."""
    kept = [c for c in df.columns if c.lower() != "score"]
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad) if model else None
        for batch in batches:
            if model is None or not batch.num_rows:
                scores = np.full(batch.num_rows, 0.5)
            else:
                scores = model.scores(np.array([sizes.differences(t) for t in _views(batch.column(place))]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*kept, "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))
