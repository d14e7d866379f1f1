"""Ranked search against brute force, its early stop, and odd rows."""

import collections
import math
import random
import re

import numpy as np
import pytest

from optiontide.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, k):
    found = [(doc, collections.Counter(terms(text))) for doc, text in documents]
    n_docs = sum(1 for _, c in found if c)
    total = sum(sum(c.values()) for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    wanted = collections.defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = set()
    for item, own in wanted.items():
        rows = []
        for doc, c in found:
            score = 0
            for t in own & set(c):
                m = 50 + (50 * sum(c.values()) * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        rows.sort(key=lambda r: r[:3])
        out |= {(item, i + 1, r[3], -r[0]) for i, r in enumerate(rows[:k])}
    return out


def table(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(1 / (1e-3 + rng.random()))}" for _ in range(500)] + ["Größe", "ÉTÉ", "été", "naïve", "X9", "x9", "漢字"]
    documents = [(i, rng.choice(" .,-\n").join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    documents += [(n, None), (n + 1, ""), (n + 2, "--- !!"), (None, "w1 w2 w3 Größe"), (5, "w1 w2 w3"), (5, "w1 w2 w3"), (n + 3, "W9 " * 3000 + "z" * 50_000)]
    documents += [(i, "one and the same w7 text") for i in range(n + 10, n + 90)]  # ties beyond k
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(12)]
    items += [(20, None), (21, "..."), (22, "nowhere at all here"), (None, "w1 Größe"), (3, "w2 x9"), (23, "the same text w7"), (24, "z" * 50_000 + " w9")]
    return documents, items


@pytest.mark.parametrize(("segment", "piece", "terms_at_once", "first"), [(1_000_000, 1 << 20, 500_000, 16), (40, 64, 20, 1)])
def test_search_against_brute_force(spark, monkeypatch, segment, piece, terms_at_once, first):
    for name, value in (("SEGMENT", segment), ("PIECE", piece), ("TERMS", terms_at_once), ("FIRST", first)):
        monkeypatch.setattr(L, name, value)
    documents, items = table(segment % 97, 300)
    df = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS rank", "3 AS item").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term")
    found = L.search(df, asked, k=10)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(documents, items, 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert L.search(none, items).count() == 0
    assert L.search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0
    assert L.search(none.unionAll(spark.createDataFrame([(1, "...")], "doc_id long, text string")), items).count() == 0


def test_reading_stops_early_and_bounds_hold():
    rng = np.random.default_rng(4)
    n, width = 4000, 6
    term, doc = np.repeat(np.arange(width), n), np.tile(np.arange(n), width)
    impact = (1e6 / (1 + rng.permuted(np.tile(np.arange(n), (width, 1)), axis=1))).astype(np.int64).reshape(-1)
    impact[doc < 30] += 200_000  # some are good in every list
    segment = L.Segment(doc, term, impact, n)
    docs, scores, read = L.best_positions(segment, np.arange(width), 20, 0)
    total = np.bincount(doc, weights=impact).astype(np.int64)
    kth = np.sort(total)[-20]
    assert set(np.flatnonzero(total >= kth)) <= set(docs.tolist())
    assert (total[docs] == scores).all()
    assert read < 0.2 * len(term)
    _, _, less = L.best_positions(segment, np.arange(width), 20, int(total.max()))
    assert less <= read


def test_positions_seen_by_direct_access_count():
    """Both lists rank the documents alike: what one list shows is seen in the other at once."""
    n = 1000
    doc, term = np.tile(np.arange(n), 2), np.repeat([0, 1], n)
    impact = np.tile(np.arange(n, 0, -1), 2).astype(np.int64)
    docs, scores, read = L.best_positions(L.Segment(doc, term, impact, n), np.array([0, 1]), 16, 0)
    assert read == 2 * L.FIRST and len(docs) == L.FIRST and scores.min() == 2 * (n - 15)
