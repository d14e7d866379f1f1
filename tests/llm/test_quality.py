"""Compression classifier: sizes by definition, held-out labels, odd rows."""

import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
from optiontide.llm import quality as Q


def model_of(spark, sf_dir, **options):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return Q.fit(docs, labels, "doc_id", "text", "quality", **options)


def test_sizes_by_definition():
    good, bad = b"the cat sat on the mat. " * 40, b"BUY!! NOW!! " * 80
    sizes = Q.Sizes(good, bad)
    text = ("the cat sat. BUY!! " * 200).encode()
    expected = []
    for data in (good, bad):
        options = zstandard.ZstdCompressionParameters.from_level(Q.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        tool = zstandard.ZstdCompressor(compression_params=options, dict_data=zstandard.ZstdCompressionDict(data))
        expected.append(sum(len(tool.compress(text[i : i + Q.PIECE])) - len(tool.compress(b"")) for i in range(0, len(text), Q.PIECE)))
    assert sizes.differences(text) == ((expected[1] - expected[0]) / sum(expected), 1 - expected[0] / len(text))
    assert sizes.differences(b"") == (0.0, 0.0)


def test_calibration_meets_the_optimum():
    rng = np.random.default_rng(2)
    good = rng.integers(0, 2, 400)
    pairs = np.stack([rng.normal(0.1 * good, 0.1), rng.uniform(0.3, 0.7, 400)], axis=1)
    mean, spread, weights = Q.calibrated(pairs, good, 0.8)
    rows = (Q._features(pairs) - mean) / spread
    found = 1 / (1 + np.exp(-rows @ weights))
    balance = np.where(good == 1, 0.8 / good.mean(), 0.2 / (1 - good.mean()))
    slope = rows.T @ (balance * (found - good)) + Q.RIDGE * np.array([0, 1, 1, 1, 1, 1]) * weights
    assert np.abs(slope).max() < 1e-6
    assert abs((balance * found).sum() - (balance * good).sum()) < 1e-6  # calibrated in the large


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = entry.queries()["op11_quality_compression"](spark, sf_dir)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect()}
    found = {r[0]: r for r in rows.collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for k, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(labels[k], r["score"], r["predicted"]) for k, r in found.items() if r["held_out"] and k in labels]
    right = sum(a == c for a, _, c in held) / len(held)
    assert right >= 0.93, right
    best, worst = [s for a, s, _ in held if a == 1], [s for a, s, _ in held if a == 0]
    assert np.mean([[g > b for b in worst] for g in best]) >= 0.88


def test_query_equals_a_plain_run(spark, sf_dir):
    """The same pieces, dictionaries and sizes computed row by row from the model."""
    model = model_of(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sizes = Q.Sizes(model.good, model.bad)
    for r in Q.score(docs, "text", model).collect():
        pair = np.array([sizes.differences((r["text"] or "").encode())])
        assert r["score"] == model.scores(pair)[0]
    again = model_of(spark, sf_dir)
    assert (again.good, again.bad, again.weights.tolist()) == (model.good, model.bad, model.weights.tolist())


def test_odd_rows(spark, sf_dir):
    model = model_of(spark, sf_dir)
    rows = [(1, None, 0.1), (2, "", 0.2), (2, "", 0.2), (3, "é" * 700_001, 0.3), (None, "Plain words.", 0.4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score double")
    found = Q.score(df, "text", model)
    assert found.columns == ["doc_id", "text", "score"]
    got = found.collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    none = Q.score(df.limit(0), "text", model)
    assert none.count() == 0
    assert {r["score"] for r in Q.score(df, "text", None).collect()} == {0.5}


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "c d"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(1, None), (None, 0)], [(1, 1), (9, 0)], [(1, 1), (1, 0), (2, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality long")
        assert Q.fit(docs, labels, "doc_id", "text", "quality") is None
