"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation of the centred principal axes is learnt so that the signs of the
rotated vectors lose least (iterative quantisation), on at most ``SAMPLE``
vectors per dimension; every vector is coded and indexed. A code is cut into
substrings, one table each; rotations from different starts give more tables.
Where vectors share a common direction a pair's angle grows with centring, so
tables and rotations are fitted: pairs at the least cosine are made from the
sample, and the first setting in which ``RECALL`` of them meet is taken. Vectors that share a substring meet, and their cosine is taken in double
precision from the original vectors. A pair counts in the first table that
holds it, so link counts need no list of pairs: a task gives one count and one
link to a local root per vector.

Equal vectors fold to one class first. A large bucket is cut into blocks that
meet pairwise, so no task holds more than two blocks. Vectors of different
dimension never link. Null vectors, zero vectors and those with null or
non-finite components link with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optiontide.llm.common import Folder
from optiontide.llm.components import components
from optiontide.llm.shingles import mixed

COSINE = 0.9
BITS = 64
#: Tables of a rotation and numbers of rotations, tried in this order until RECALL of PAIRS pairs at the least cosine meet.
TABLES = (6, 8, 11, 16, 22, 32, 64)
ROTATIONS = range(2, 9)
RECALL = 0.95
PAIRS = 2048
SAMPLE = 4096
ROUNDS = 40
#: Vectors of a bucket that meet in one task, and of small buckets that share a task.
BLOCK = 1024
PACK = 4096


def learn(sample: np.ndarray, seed: int, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) whose signs are the code of a unit vector."""
    mean = sample.mean(axis=0)
    _, _, axes = np.linalg.svd(sample - mean, full_matrices=len(sample) < sample.shape[1])
    axes = axes[: min(bits, sample.shape[1])].T
    flat = (sample - mean) @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(flat @ rotation >= 0, 1.0, -1.0).T @ flat)
        rotation = (u @ v).T
    return mean, axes @ rotation


def substrings(unit: np.ndarray, models: list[tuple[np.ndarray, np.ndarray]], tables: int = TABLES[0]) -> np.ndarray:
    """Substring of every table of every rotation, one column each."""
    out = []
    for mean, projection in models:
        bits = (unit - mean) @ projection >= 0
        for part in np.array_split(np.arange(bits.shape[1]), tables):
            out.append(bits[:, part] @ (np.int64(1) << np.arange(len(part), dtype=np.int64)))
    return np.stack(out, axis=1)


def partners(unit: np.ndarray, cosine: float, seed: int = 0) -> np.ndarray:
    """For each vector one at the given cosine to it (or as far as it goes): its centred part turned towards another vector's."""
    rng = np.random.default_rng(seed)
    mean = unit.mean(axis=0)
    own = unit - mean
    size = np.linalg.norm(own, axis=1, keepdims=True)
    along = own / np.maximum(size, 1e-12)
    other = own[rng.permutation(len(own))] + 1e-6 * rng.standard_normal(own.shape)
    other -= (other * along).sum(axis=1, keepdims=True) * along
    other *= size / np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)

    def turned(angle: np.ndarray) -> np.ndarray:
        return _unit(mean + np.cos(angle) * own + np.sin(angle) * other)

    low, high = np.zeros((len(unit), 1)), np.full((len(unit), 1), np.pi)
    for _ in range(40):
        middle = (low + high) / 2
        near = (unit * turned(middle)).sum(axis=1, keepdims=True) >= cosine
        low, high = np.where(near, middle, low), np.where(near, high, middle)
    return turned(low)


def fitted(sample: np.ndarray, cosine: float) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Rotations and tables of each, so many that ``RECALL`` of pairs at ``cosine`` share a table."""
    step = max(1, len(sample) // PAIRS)
    other = partners(sample, cosine)[::step]
    own, models = sample[::step], []
    for tables in TABLES:
        met = np.zeros(len(own), dtype=bool)
        for k in range(ROTATIONS[-1]):
            if k == len(models):
                models.append(learn(sample, k))
            met |= (substrings(own, models[k : k + 1], tables) == substrings(other, models[k : k + 1], tables)).any(axis=1)
            if k + 1 in ROTATIONS and met.mean() >= RECALL:
                return models[: k + 1], tables
    return models, TABLES[-1]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class, dimension and bytes of every vector that may link; nulls for the others."""
    for batch in batches:
        ids, sizes, data = [], [], []
        for value in batch.column("vector").to_pylist():
            vector = np.array([np.nan if x is None else x for x in value or ()], dtype=np.float64)
            good = len(vector) > 0 and np.isfinite(vector).all() and np.abs(vector).max() > 0
            if good:  # by a power of two, which changes no digit: lengths neither overflow nor vanish
                vector = np.ldexp(vector, -np.frexp(np.abs(vector).max())[1])
            data.append(vector.tobytes() if good else None)
            ids.append(hashlib.blake2b(data[-1], digest_size=16).digest() if good else None)
            sizes.append(len(vector) if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], ["key", "cls", "dim", "vector"])


def _matrix(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), dtype=np.float64).reshape(len(data), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _coded(models: dict[int, tuple[list, int]]):
    """One row per class and table: bucket, table, class and all substrings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                codes = substrings(_unit(_matrix(part.column("vector").to_pylist())), *models[dim])
                n, width = codes.shape
                table = np.tile(np.arange(width, dtype=np.int64), n)
                place = mixed((codes.ravel() * width + table).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim)).view(np.int64)
                own = pa.array([c.tobytes() for c in codes.astype(np.int32)], pa.binary()).take(pa.array(np.repeat(np.arange(n), width)))
                cls = part.column("cls").take(pa.array(np.repeat(np.arange(n), width)))
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(table.astype(np.int32)), cls, own], ["bucket", "tab", "cls", "codes"])
    return run


def _roots(near: np.ndarray) -> np.ndarray:
    """Least reachable place of every place of a symmetric 0/1 matrix."""
    root = np.arange(len(near))
    while True:
        least = np.array([min(root[i], root[row].min(initial=len(near))) for i, row in enumerate(near)])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _links(cosine: float):
    def one_bucket(rows: pd.DataFrame) -> pd.DataFrame | None:
        vectors = _matrix(rows["vector"].tolist())
        norms = np.linalg.norm(vectors, axis=1)
        near = (vectors @ vectors.T) / (norms[:, None] * norms[None, :]) >= cosine
        np.fill_diagonal(near, False)
        if not near.any():
            return None
        table = int(rows["tab"].iloc[0])
        codes = np.frombuffer(b"".join(rows["codes"]), dtype=np.int32).reshape(len(rows), -1)[:, :table]
        block, weight = rows["block"].to_numpy(), rows["weight"].to_numpy()
        first = near if block.min() == block.max() else near & (block[:, None] != block[None, :])
        counts = np.zeros(len(rows), dtype=np.int64)
        for i in np.flatnonzero(first.any(axis=1)):
            others = np.flatnonzero(first[i])
            met = (codes[others] == codes[i]).any(axis=1) if table else np.zeros(len(others), dtype=bool)
            counts[i] = weight[others[~met]].sum()
        root = _roots(near)
        there = np.flatnonzero((counts > 0) | (root != np.arange(len(rows))))
        cls = rows["cls"].to_numpy()
        return pd.DataFrame({"cls": cls[there], "root": cls[root[there]], "links": counts[there]})

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, own in rows.groupby("bucket", sort=False) if len(own) > 1 and (x := one_bucket(own)) is not None]
        return pd.concat(found) if found else pd.DataFrame({"cls": [], "root": [], "links": np.zeros(0, dtype=np.int64)})
    return run


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) of each row.

    ``n_links`` counts the other rows whose cosine is ``cosine`` or more and
    that share a table; ``component_id`` is the smallest key reachable by
    links, ``kept`` whether it is the row's own. Repeated keys are separate rows.
    """
    folder = Folder(df, "itq")
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    signed = folder.put(rows.mapInArrow(_vectors, f"key {kind}, cls binary, dim int, vector binary"), "signed")
    classes = folder.put(
        signed.where(F.col("cls").isNotNull()).groupBy("cls").agg(
            F.max("dim").alias("dim"), F.max("vector").alias("vector"), F.count(F.lit(1)).alias("weight"), F.min("key").alias("least")), "classes")
    models = {}
    for (dim,) in classes.select("dim").distinct().collect():
        sample = classes.where(F.col("dim") == dim).orderBy("cls").limit(SAMPLE).select("vector").collect()
        unit = _unit(_matrix([r[0] for r in sample]))
        models[dim] = fitted(unit, cosine)
    coded = folder.put(classes.select("cls", "dim", "vector").mapInArrow(_coded(models), "bucket long, tab int, cls binary, codes binary"), "coded")
    sizes = coded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    packs = max(1, coded.count() // PACK)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (
        coded.join(sizes, "bucket").join(classes.select("cls", "vector", "weight"), "cls")
        .withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("pack", F.when(F.col("blocks") > 1, F.col("bucket")).otherwise(F.pmod(F.col("bucket"), F.lit(packs))))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    )
    found = folder.put(
        dealt.groupBy("pack", "low", "high").applyInPandas(_links(cosine), "cls binary, root binary, links long"), "found")
    labels = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), f"{folder.path}/components")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    grouped = (
        classes.select("cls", "weight", "least").join(labels, F.col("cls") == F.col("node"), "left").join(counts, "cls", "left")
        .select("cls", F.coalesce("label", "cls").alias("label"), "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    least = grouped.groupBy("label").agg(F.min("least").alias("component"))
    owner = grouped.join(least, "label").select(F.col("cls").alias("__cls"), "n_links", "component")
    out = signed.select("key", "cls").join(owner, F.col("cls") == F.col("__cls"), "left")
    component = F.when(F.col("__cls").isNull(), F.col("key")).otherwise(F.col("component"))
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"))
