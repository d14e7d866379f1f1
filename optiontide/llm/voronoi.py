"""Exact top-k search by inner product as a Voronoi kNN join.

Pivots, rows of a hash sample that are far from each other, cut data and queries alike: a row belongs to its nearest pivot. A pass over the data
keeps per cell its number of rows and its radius. For a query q and a cell with pivot c and radius r no score in the cell is above
``q . c + |q| r`` and none below ``q . c - |q| r``; the latter with the cells' numbers of rows, and the (k + 1)-th best score of q with the
pivots, which are rows too, tell a score that k other rows reach at least. So a query
needs only the cells whose bound reaches that score, and the queries of a pivot the cells that any of them needs; pivots that need the same cells
share a group. Cells are sent to the groups that need them. Where little can be left out, as with vectors without clusters, groups would repeat
most of the data; where they would send more than ``MOST_SENT`` times the rows, all queries form one group. A group meets its data in slices (and a large
group in parts), each solved by one matrix product; the best of all slices are
merged.

The bounds only leave out vectors; scores are whole numbers throughout, and scores beyond 64 bits stand at the end of the range. Rows
equal in key and vector count once. Shorter vectors count as filled up with
zeros. Rows with a null key take no part. Empty tables, and tables without a query, give an empty result; ties go to smaller keys. Other
columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from optiontide.llm.common import Folder

#: Queries per pivot, most pivots, queries of a group that meet in one task, and data rows of a slice.
PER_PIVOT = 128
MOST_PIVOTS = 64
#: Rows, those with the least hashes, from which pivots far from each other are chosen.
SAMPLE = 2048
PART = 1024
#: Times the rows that one group of all queries would be sent, up to which groups of their own are formed.
MOST_SENT = 2
SLICE = 16384


def whole_numbers(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component x as double; null for vectors that are null or hold null or non-finite components."""
    values = vector.cast("array<double>")
    good = vector.isNotNull() & F.forall(values, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.when(good, F.transform(values, lambda x: F.floor(x * float(factor))))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, own in enumerate(column.to_pylist()):
        out[i, : len(own)] = own
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def _cells(pivots: np.ndarray, width: int):
    """Per task and pivot: rows of its cell and their greatest distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius, number = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            far = _distances(_rows(batch.column("q"), width).astype(np.float64), pivots)
            own = far.argmin(axis=1)
            np.maximum.at(radius, own, far[np.arange(len(own)), own])
            number += np.bincount(own, minlength=len(pivots))
        there = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(radius[there]), pa.array(number[there])], ["pivot", "radius", "number"])
    return run


def _spread(rows: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows, each the farthest from those before it."""
    far, chosen = np.full(len(rows), np.inf), []
    for _ in range(min(count, len(rows))):
        chosen.append(int(far.argmax()) if chosen else 0)
        far = np.minimum(far, _distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def _needs(pivots: np.ndarray, radius: np.ndarray, held: np.ndarray, width: int, k: int):
    """Per task: number of queries of each group, and the cells that they need (group, cell, queries)."""
    sizes = np.sqrt((pivots * pivots).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = np.zeros((len(pivots), len(pivots)), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows(batch.column("q"), width).astype(np.float64)
            group, length = _distances(rows, pivots).argmin(axis=1), np.sqrt((rows * rows).sum(axis=1))
            score = rows @ pivots.T
            error = 1e-9 * length[:, None] * (sizes + radius)[None, :] + 1e-6
            least = score - length[:, None] * radius[None, :] - error  # every row of the cell scores that much
            order = np.argsort(-least, axis=1, kind="stable")
            enough = (np.cumsum(held[order], axis=1) > k).argmax(axis=1) if held.sum() > k else None
            line = np.arange(len(rows))
            reached = least[line, order[line, enough]] if enough is not None else np.full(len(rows), -np.inf)
            if len(pivots) > k:
                reached = np.maximum(reached, np.partition(score, len(pivots) - k - 1, axis=1)[:, len(pivots) - k - 1] - error.max(axis=1))
            wanted = score + length[:, None] * radius[None, :] + error >= reached[:, None]
            np.add.at(need, group, wanted.astype(np.int64))
        group, cell = np.nonzero(need)
        yield pa.RecordBatch.from_arrays(
            [pa.array(group.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(need[group, cell])], ["group", "cell", "queries"])
    return run


def _sent(pivots: np.ndarray, width: int, groups: np.ndarray, need: np.ndarray, parts: np.ndarray, slices: np.ndarray, queries: bool):
    """Rows to the (group, part, slice) where they are needed: queries to all slices of theirs, data to all parts of the groups that need its cell.

    ``groups`` has the group of the queries of each pivot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, hashed = _rows(batch.column("q"), width), batch.column("hashed").to_numpy()
            cell = _distances(rows.astype(np.float64), pivots).argmin(axis=1)
            if queries:
                group = groups[cell]
                times = slices[group]
            else:
                row, group = np.nonzero(need[:, cell].T)
                times = parts[group]
            row = np.repeat(np.arange(len(rows)) if queries else row, times)
            group = np.repeat(group, times)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            part = hashed[row] % parts[group] if queries else turn
            piece = turn if queries else hashed[row] % slices[group]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(piece.astype(np.int32)), batch.column("id").take(at),
                 pa.array([r.tobytes() for r in rows], pa.binary()).take(at)], ["g", "p", "s", "id", "q"])
    return run


def _solved(k: int, kind: type):
    """The best ``k`` of one slice for each query of one part; ``kind`` holds the sums exactly."""
    ends = np.iinfo(np.int64)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        if not len(left) or not len(right):
            return empty
        right = right.sort_values("id", kind="stable")
        ids, asked = right["id"].to_numpy(), left["id"].to_numpy()
        data, queries = (np.frombuffer(b"".join(x["q"]), dtype=np.int64).reshape(len(x), -1) for x in (right, left))
        data, out = data.astype(kind).T, []
        for at in range(0, len(asked), 64):
            scores = queries[at : at + 64].astype(kind) @ data
            if kind is object:
                scores = np.clip(scores, ends.min, ends.max).astype(np.int64)
            for query, row in zip(asked[at : at + 64], scores, strict=True):
                there = np.flatnonzero(ids != query)
                if len(there) > k:
                    least = np.partition(row[there], len(there) - k)[len(there) - k]
                    there = there[row[there] >= least]
                there = there[np.argsort(-row[there], kind="stable")][:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[there], "score": row[there].astype(np.int64)}))
        return pd.concat(out)
    return run


def top_k(df: DataFrame, key: str, vector: str, asked: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of every asked row, ties to smaller keys.

    ``vector`` holds whole numbers (array<bigint>); null vectors take no part.
    The driver holds the pivots and one summary per pivot.
    """
    folder = Folder(df, "voronoi")
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("q"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = folder.put(
        rows.groupBy("id", "q").agg(F.max("asked").alias("asked")).withColumn("hashed", F.shiftrightunsigned(F.xxhash64("id"), 1)), "rows")
    most = F.array_max(F.transform("q", lambda x: F.abs(x.cast("double"))))
    size = rows.agg(F.count(F.lit(1)), F.sum(F.col("asked").cast("long")), F.max(F.size("q")), F.max(most)).first()
    n, number, width, largest = (x or 0 for x in size)
    if not number:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    count = int(min(MOST_PIVOTS, max(k + 2, number // PER_PIVOT)))
    chosen = rows.orderBy(F.xxhash64("id"), "id", "q").limit(SAMPLE).select("q").collect()
    sample = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        sample[i, : len(r["q"])] = r["q"]
    pivots = _spread(sample, count)
    found = rows.select("q").mapInArrow(_cells(pivots, width), "pivot int, radius double, number long")
    radius, held = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for r in found.groupBy("pivot").agg(F.max("radius").alias("radius"), F.sum("number").alias("number")).collect():  # a row for each pivot
        radius[r["pivot"]], held[r["pivot"]] = r["radius"] * (1 + 1e-9), r["number"]
    wanted = rows.where("asked").select("q").mapInArrow(_needs(pivots, radius, held, width, k), "group int, cell int, queries long")
    need = np.zeros((len(pivots), len(pivots)), dtype=bool)
    asking = np.zeros(len(pivots), dtype=np.int64)
    for r in wanted.groupBy("group", "cell").agg(F.sum("queries").alias("queries")).collect():  # pivots squared at most
        need[r["group"], r["cell"]] = True
        asking[r["group"]] = max(asking[r["group"]], r["queries"])
    # Pivots whose queries need the same cells form one group; a group's number of queries is at most the sum over its pivots. Every query needs the cell
    # of its best pivot, so the greatest number that need one cell tells a pivot's queries well enough to split large groups.
    need, groups = np.unique(need, axis=0, return_inverse=True)
    groups = groups.reshape(-1)
    asking = np.bincount(groups, weights=asking).astype(np.int64)
    parts = np.maximum(1, -(-asking // PART)) * need.any(axis=1)
    if (need * held[None, :]).sum(axis=1) @ parts > MOST_SENT * n * -(-number // PART):
        need, parts, groups = np.ones((1, len(pivots)), dtype=bool), np.array([-(-number // PART)]), np.zeros(len(pivots), dtype=np.int64)
    slices = np.maximum(1, -(-(need * held[None, :]).sum(axis=1) // SLICE))
    kind = "g int, p int, s int, id long, q binary"
    columns = rows.select("id", "q", "hashed", "asked")
    left = columns.where("asked").mapInArrow(_sent(pivots, width, groups, need, parts, slices, True), kind)
    right = columns.mapInArrow(_sent(pivots, width, groups, need, parts, slices, False), kind)
    bound = width * int(largest) ** 2
    exact = np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object  # sums below 2**53 are exact as doubles
    best = left.groupBy("g", "p", "s").cogroup(right.groupBy("g", "p", "s")).applyInPandas(_solved(k, exact), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
