"""Language identification with string kernels.

A text is the set of its character n-grams of 1 to 3 code points (a blended
spectrum, presence only), hashed to ``BITS`` places. The kernel of two texts is
the size of their sets' intersection over the root of the sizes' product. A few
landmark texts per language span a Nyström feature space; one kernel ridge
regression per language against the rest is solved there. Scoring is three
matrix products per block of windows: presence by landmarks, by the feature map,
by the regressions.

A text of more than ``WINDOW`` characters is cut into windows of equal size that
overlap by an n-gram, each with a set of its own, so no set fills up however long
the text is. Its shares are the mean of all windows' shares, weighted by how far
a window's best share is above chance (to the power ``CLEARNESS``): windows that
look alike in all languages (ids, tables, other scripts) count little beside
prose, and a text and its repetition score the same.

Fitting takes at most ``per_language`` labelled texts of each language (spread
over hash ranges, so no language is gathered in one task) of the ``LABELS`` most frequent languages, chosen by key and label alone
and broadcast to the texts, of each text up to ``LEARNT`` windows spread evenly; only packed n-gram sets of these reach the
driver, ``BITS / 8`` bytes each. Prediction covers every whole text, window by
window. Null texts and texts without a letter are ``und`` with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from optiontide.llm.common import lean

BITS = 1 << 14
SIZES = (1, 2, 3)
PER_LANGUAGE = 384
LANDMARKS = 16
#: Labels that are learnt at most, the most frequent ones.
LABELS = 200
RIDGE = 1e-2
#: Hash ranges of a language that are sampled on their own.
RANGES = 128
#: Most characters of a window, and most windows of a text that are learnt from.
WINDOW = 4096
LEARNT = 4
CLEARNESS = 4
ROWS = 256
UNKNOWN = "und"

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def ngram_places(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed places of the n-grams of code points, one array per size."""
    for n in SIZES:
        if len(codes) < n:
            return
        mixed = np.full(len(codes) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint32(15)
        yield mixed & np.uint32(BITS - 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def window_starts(length: int) -> np.ndarray:
    """Borders of the windows of a text: even steps from 0 to ``length``, of at most ``WINDOW`` characters."""
    count = max(1, -(-length // WINDOW))
    return np.arange(count + 1, dtype=np.int64) * length // count


def window(text: str, borders: np.ndarray, k: int) -> str:
    """Window ``k`` with the characters that complete its last n-grams."""
    return text[borders[k] : borders[k + 1] + SIZES[-1] - 1]


def presence(text: str, row: np.ndarray) -> None:
    """Mark the n-grams of a text."""
    for places in ngram_places(code_points(text)):
        row[places] = 1


@dataclass
class LanguageModel:
    """Languages, packed landmark sets, and the weights that take kernel values to one score per language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        self._dense = None

    def kernel(self, sets: np.ndarray) -> np.ndarray:
        """Kernel of 0/1 rows with the landmarks."""
        if self._dense is None:
            self._dense = np.unpackbits(self.landmarks, axis=1).astype(np.float32).T.copy()
            self._sizes = self._dense.sum(axis=0)
        sizes = sets.sum(axis=1)
        return (sets @ self._dense) / np.sqrt(np.maximum(sizes, 1)[:, None] * self._sizes[None, :])

    def scores(self, sets: np.ndarray) -> np.ndarray:
        """Shares of the languages, rows adding up to 1: a softmax over the ridge outputs."""
        raw = 8.0 * (self.kernel(sets).astype(np.float64) @ self.weights)
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)

    def text_scores(self, texts: list[str]) -> np.ndarray:
        """Shares of the languages in whole texts, over all their windows, of which ``ROWS`` are held at a time."""
        sums, weights = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        sets, owners = np.zeros((ROWS, BITS), dtype=np.float32), []

        def add() -> None:
            shares = self.scores(sets[: len(owners)])
            clear = (shares.max(axis=1) - 1 / len(self.languages) + 1e-3) ** CLEARNESS
            np.add.at(sums, owners, shares * clear[:, None])
            np.add.at(weights, owners, clear)
            sets[: len(owners)] = 0
            owners.clear()

        for i, text in enumerate(texts):
            borders = window_starts(len(text))
            for k in range(len(borders) - 1):
                presence(window(text, borders, k), sets[len(owners)])
                owners.append(i)
                if len(owners) == ROWS:
                    add()
        if owners:
            add()
        return sums / weights[:, None]


def fit_sets(packed: np.ndarray, languages: np.ndarray, ridge: float = RIDGE, landmarks: int = LANDMARKS) -> LanguageModel:
    """Nyström map and one-versus-rest ridge regressions from packed n-gram sets."""
    names = sorted(set(languages))
    chosen = np.concatenate([np.flatnonzero(languages == name)[:landmarks] for name in names])
    model = LanguageModel(names, packed[chosen], np.zeros((len(chosen), len(names))))
    cross = np.concatenate([
        model.kernel(np.unpackbits(packed[i : i + ROWS], axis=1).astype(np.float32)) for i in range(0, len(packed), ROWS)]).astype(np.float64)
    values, vectors = np.linalg.eigh(cross[chosen])
    strong = values > 1e-8 * max(values.max(), 1e-8)
    to_features = vectors[:, strong] / np.sqrt(values[strong])
    features = cross @ to_features
    sides = np.where(languages[:, None] == np.array(names)[None, :], 1.0, -1.0)
    share = np.array([(languages == name).mean() for name in names])
    balance = 1.0 / share[np.searchsorted(names, languages)]
    gram = (features * balance[:, None]).T @ features
    gram += ridge * len(packed) * np.eye(gram.shape[0])
    model.weights = to_features @ np.linalg.solve(gram, (features * balance[:, None]).T @ sides)
    return model


def _texts(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of up to ``LEARNT`` windows of each text, spread over the whole of it, with their number."""
    for batch in batches:
        owners, numbers, bits = [], [], []
        for i, text in enumerate(_texts(batch, "text")):
            borders = window_starts(len(text or ""))
            few = np.unique(np.linspace(0, len(borders) - 2, LEARNT).astype(np.int64))
            for number, k in enumerate(few.tolist()):
                row = np.zeros(BITS, dtype=np.uint8)
                presence(window(text or "", borders, k), row)
                owners.append(i)
                numbers.append(number)
                bits.append(np.packbits(row).tobytes())
        own = pa.array(owners, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(own), batch.column(1).take(own), pa.array(numbers, pa.int32()), pa.array(bits, pa.binary())],
            ["lang", "mark", "number", "bits"])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(df: DataFrame, key: str, text: str, label: str, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """A model from at most ``per_language`` labelled texts of each language; None if there is no such text.

    The driver holds ``BITS / 8`` bytes for each of their windows, ``LEARNT`` a text at most.
    """
    mark = F.xxhash64(key)
    rows = df.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).alias("lang"), mark.alias("mark")).distinct()
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LABELS).select(F.col("lang").alias("__common"))
    rows = rows.join(F.broadcast(common), F.col("lang") == F.col("__common")).drop("__common")
    order = Window.partitionBy("lang", F.pmod("mark", F.lit(RANGES))).orderBy("mark", "key")
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= max(1, per_language // RANGES)).select("key", "lang")
    few = few.select(F.col("key").alias("__key"), F.col("lang").alias("__lang"))
    texts = df.where(has_letter(F.col(text))).select(F.col(key).alias("key"), F.col(label).alias("lang"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(few), F.col("key").eqNullSafe(F.col("__key")) & (F.col("lang") == F.col("__lang")))
    texts = texts.dropDuplicates(["key", "lang"])
    sets = texts.select("lang", F.xxhash64("key").alias("mark"), "text").mapInArrow(lean(_packed), "lang string, mark long, number int, bits binary")
    found = sets.toArrow().to_pydict()
    if not found["lang"]:
        return None
    packed = np.stack([np.frombuffer(b, dtype=np.uint8) for b in found["bits"]])
    languages = np.array(found["lang"], dtype=object)
    order = np.lexsort((np.array(found["mark"]), np.array(found["number"]), languages.astype(str)))
    return fit_sets(packed[order], languages[order].astype(str))


def predict(df: DataFrame, text: str, model: LanguageModel | None) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    out = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = batch.column(place).to_pylist()
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
                if known:
                    shares = model.text_scores([texts[i] for i in known])
                    best = shares.argmax(axis=1)
                    for j, i in enumerate(known):
                        names[i], scores[i] = model.languages[best[j]], shares[j, best[j]]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"])

    schema = out.add("lang_pred", "string").add("score", "double")
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(lean(run), schema)
