"""Severity and language queries against plain implementations of their rules, on the queries' own rows."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from optiontide.llm import lang_id, queries, shingles, toxicity

MASK = (1 << 64) - 1


def _mixed(x):
    return int(shingles.mixed(np.array([x & MASK], dtype=np.uint64))[0])


def _hash(piece, more=0):
    """Polynomial over the bytes' values, A-Z lowered, mixed."""
    total = 0
    for i, b in enumerate(piece):
        low = b + 32 if 65 <= b <= 90 else b
        total += _mixed(low + 0x5851F42D4C957F2D) * pow(0x9E3779B97F4A7C15, i, 1 << 64)
    found = _mixed(total + more)
    return found - (1 << 64) if found >> 63 else found


def _words(text):
    word = bytearray()
    for b in (text or "").encode() + b" ":
        if b >= 128 or chr(b).isalpha():
            word.append(b)
        elif word:
            yield bytes(word)
            word.clear()


def test_severity_against_a_plain_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, "doc_id", "text", queries.severity_grade(), 3)
    place = {int(f): i for i, f in enumerate(model.features)}
    memory = {}

    def features(word):
        if word not in memory:
            memory[word] = [_hash(word), *[_hash(word[:n], n) for n in toxicity.HEADS if len(word) > n]]
        return memory[word]

    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in queries.op9(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for key, text in texts.items():
        counts = Counter(f for w in _words(text) for f in features(w) if f in place)
        score = sum(math.log1p(n) * model.weights[place[f]] for f, n in counts.items())
        above = [1 / (1 + math.exp(max(-50, min(50, t - score)))) for t in model.thresholds]
        assert abs(got[key].severity - sum(above)) < 1e-9
        if min(abs(a - 0.5) for a in above) > 1e-9:
            assert got[key].grade == sum(a >= 0.5 for a in above) and got[key].toxic == (above[-1] >= 0.5)
    # The fit: no step along a weight or a threshold makes the likelihood of the sample better.
    graded = labels.select("doc_id", queries.severity_grade().alias("g")).where("g IS NOT NULL").collect()
    rows = []
    for r in graded:
        row = np.zeros(len(place))
        for f, n in Counter(f for w in _words(texts.get(r.doc_id)) for f in features(w) if f in place).items():
            row[place[f]] = math.log1p(n)
        rows.append(row)
    rows, grades = np.stack(rows), np.array([r.g for r in graded])

    def loss(weights, thresholds):
        cut = 1 / (1 + np.exp(-np.clip(np.append(thresholds, 50)[None, :] - (rows @ weights)[:, None], -50, 50)))
        share = np.diff(np.hstack([np.zeros((len(rows), 1)), cut]), axis=1)[np.arange(len(rows)), grades]
        return -np.log(np.maximum(share, 1e-12)).mean() + toxicity.SHRINK / 2 * (weights @ weights)

    now = loss(model.weights, model.thresholds)
    for step in (1e-2, -1e-2):
        for i in range(len(model.weights)):
            moved = model.weights.copy()
            moved[i] += step
            assert loss(moved, model.thresholds) >= now - 2e-4
        for i in range(len(model.thresholds)):
            moved = model.thresholds.copy()
            moved[i] += step
            assert loss(model.weights, moved) >= now - 2e-4


def _places(text):
    """Hashed 1- to 3-grams of one window, one by one."""
    codes, found = [ord(c) for c in text.lower()], set()
    for n in lang_id.SIZES:
        for at in range(len(codes) - n + 1):
            x = n * 0x27D4EB2F & 0xFFFFFFFF
            for k in range(n):
                x = (x ^ codes[at + k]) * int(lang_id._MULTIPLIERS[k]) & 0xFFFFFFFF
                x ^= x >> 15
            found.add(x & (lang_id.BITS - 1))
    return found


def test_languages_against_a_plain_run(spark, sf_dir):
    """Kernel, landmarks, regression outputs and window weights computed text by text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = queries.language_model(docs)
    marks = [set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in model.landmarks]
    assert len(marks) <= lang_id.LANDMARKS * len(model.languages) and model.languages == sorted(model.languages)
    got = {r.doc_id: r for r in queries.op1(spark, sf_dir).collect()}
    rows = docs.orderBy(F.xxhash64("doc_id")).limit(60).collect()  # of the query's rows, those that are recomputed
    for r in rows:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == (lang_id.UNKNOWN, 0)
            continue
        count = max(1, -(-len(r.text) // lang_id.WINDOW))
        borders = [k * len(r.text) // count for k in range(count + 1)]
        total, weight = np.zeros(len(model.languages)), 0.0
        for a, b in zip(borders, borders[1:], strict=False):
            own = _places(r.text[a : b + 2])
            kernel = np.array([len(own & m) / math.sqrt(max(len(own), 1) * len(m)) for m in marks])
            raw = np.exp(8.0 * (kernel @ model.weights) - (8.0 * (kernel @ model.weights)).max())
            shares = raw / raw.sum()
            clear = (shares.max() - 1 / len(shares) + 1e-3) ** lang_id.CLEARNESS
            total, weight = total + shares * clear, weight + clear
        shares = total / weight
        assert abs(got[r.doc_id].score - shares.max()) < 1e-4
        if np.sort(shares)[-1] - np.sort(shares)[-2] > 1e-3:
            assert got[r.doc_id].lang_pred == model.languages[int(shares.argmax())]


def test_regression_weights_meet_their_equations():
    """One-versus-rest ridge on the landmark features: the gradient of its penalised squares is zero."""
    rng = np.random.default_rng(3)
    sets = (rng.random((90, lang_id.BITS)) < 0.01).astype(np.uint8)
    languages = np.array(["a", "b", "c"])[np.arange(90) % 3]
    for i, name in enumerate(("a", "b", "c")):
        sets[languages == name, 100 * i : 100 * i + 60] = 1
    model = lang_id.fit_sets(np.packbits(sets, axis=1), languages)
    cross = model.kernel(sets.astype(np.float32)).astype(np.float64)
    chosen = np.concatenate([np.flatnonzero(languages == n)[: lang_id.LANDMARKS] for n in model.languages])
    values, vectors = np.linalg.eigh(cross[chosen])
    strong = values > 1e-8 * values.max()
    to_features = vectors[:, strong] / np.sqrt(values[strong])
    features = cross @ to_features
    weights = np.linalg.lstsq(to_features, model.weights, rcond=None)[0]
    sides = np.where(languages[:, None] == np.array(model.languages)[None, :], 1.0, -1.0)
    slope = features.T @ (3.0 * (features @ weights - sides)) + lang_id.RIDGE * 90 * weights
    assert np.abs(slope).max() < 1e-4 * np.abs(features.T @ sides).max()
    assert (model.scores(sets.astype(np.float32)).argmax(axis=1) == np.arange(90) % 3).all()
