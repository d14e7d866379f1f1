"""Sharding, secret scans, rollups and mixing against plain versions."""

import random
import time
import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from optiontide.llm import mixing, queries, secrets, sharding, token_rollup
from optiontide.llm.common import word_count

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [
    None, "", " \t\n", "A b", "A b", 'x token = "abcdefgh1234" y', "token=secret: abcdefghij", "API_KEY:'abc' password:12345678",
    "AKIAABCDEFGHIJKL and AKIA12", "f" * 31 + " " + "0123456789abcdef" * 3, "é🙂 SECRET=abcd/efgh+1= é", "k9Xv2QpLr8ZtW4mBn7Ys3Jd tail",
    "12345678901234567890123", "word " * 3000,
]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (3, TEXTS[3], "en", "s0", 3), (None, "A b", None, None, None)], DOCS)


def saved(df, path):
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)


BASE = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in BASE.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(docs, tmp_path, spark):
    path = saved(docs, tmp_path / "d")
    rows = queries.op6(spark, path).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = "A b" if r.doc_id is None else TEXTS[r.doc_id]
        want = base_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in want) for k in range(3)]
        assert {x for x in listed.split(",") if x} <= set(r.spans.split(","))
    spans = {r.doc_id: r.spans for r in rows}
    assert spans[11] == "entropy_base64:0:23" and spans[12] == "" and spans[6] == ""


def window_entropy(value):
    """The definition, window by window, without increments."""
    best = None
    for at in range(len(value) - secrets.WINDOW + 1):
        window = value[at : at + secrets.WINDOW]
        total = sum(secrets._weight(window.count(c)) for c in set(window))
        best = total if best is None else min(best, total)
    return best


def test_window_entropy(spark):
    values = ["k9Xv2QpLr8ZtW4mBn7Ys3Jd", "a" * 40 + "Zx9", "abcdefghijklmnopqrst", "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5p6", "0123456789abcdef" * 8]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for v, got in df.select("v", secrets.most_entropy(F.col("v"))).collect():
        assert got == window_entropy(v)


def test_redaction_and_clash(docs, spark):
    df = docs.withColumn("secrets", F.lit(1)).where("doc_id in (0, 5, 9)")
    found = secrets.find_secrets(df)
    out = {r.doc_id: r.t for r in found.select("doc_id", secrets.redacted(F.col("text"), F.col("secrets")).alias("t")).collect()}
    assert out[0] is None and out[5] == 'x [assign]" y' and out[9] == "f" * 31 + " [hex]"


def _plainly_redacted(text, spans):
    """Spans by start, kind as listed; what overlaps an earlier one goes with it."""
    out, at = "", 0
    for s in spans:
        if s["start"] >= at:
            out += text[at : s["start"]] + f"[{s['kind']}]"
        at = max(at, s["end"])
    return out + text[at:]


@pytest.mark.parametrize("piece", [7, 1024])
def test_redaction_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(secrets, "PIECE", piece)
    rng = random.Random(piece)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    parts = [
        lambda: f'password = "{hexes(40)}"', lambda: "AKIA" + hexes(24).upper(), lambda: hexes(64), lambda: "é\n" * rng.randint(0, 9),
        lambda: f"token:{hexes(8)}", lambda: "plain words " * rng.randint(0, 5), lambda: "\U0001F600" * 3, lambda: "secret=" + "Aa0Bb1Cc2" * 6]
    texts = [" ".join(rng.choice(parts)() for _ in range(rng.randint(0, 30))) for _ in range(25)] + ["", None, hexes(5000), "password=" + "k9" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("spans", secrets.secret_spans(F.col("text")))
    rows = df.withColumn("out", secrets.redacted(F.col("text"), F.col("spans"))).collect()
    for r in rows:
        assert r["out"] == (_plainly_redacted(r["text"], r["spans"]) if r["spans"] else r["text"])


def test_work_grows_with_a_text_full_of_keys(spark):
    """Eight times the text takes far less than the square of that in time."""
    rng = random.Random(1)
    line = lambda: f"token: {''.join(rng.choice('ABCDEFGHJK0123456789abcdef') for _ in range(30))} é\n"
    seconds = []
    for n in (1000, 1000, 8000):
        text = "".join(line() for _ in range(n))
        df = spark.createDataFrame([(text,)], "text string").withColumn("spans", secrets.secret_spans(F.col("text")))
        start = time.perf_counter()
        found = df.select(F.size("spans").alias("n"), secrets.redacted(F.col("text"), F.col("spans")).alias("out")).first()
        seconds.append(time.perf_counter() - start)
        assert found["n"] >= n and found["out"].count("[assign]") == n and "token" not in found["out"]
    assert seconds[2] < 20 * max(seconds[1], 0.3), seconds


def test_allow_list(spark):
    df = spark.createDataFrame([("k9Xv2QpLr8ZtW4mBn7Ys3Jd",)], "text string")
    assert secrets.find_secrets(df, allow=("^k9Xv",)).first()["secrets"] == []


def test_sharding(docs, tmp_path, spark):
    rows = queries.op4(spark, saved(docs, tmp_path / "d")).collect()
    by_shard = {}
    for r in rows:
        text = "A b" if r.doc_id is None else TEXTS[r.doc_id]
        assert r.size == len((text or "").encode()) + 1
        assert r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16 and r.law == "key"
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1


def test_shards_are_even_and_weighted(spark):
    rows = spark.range(40000).withColumn("s", sharding.rendezvous(F.col("id"), {0: 1.0, 1: 1.0, 2: 2.0}))
    counts = {r.s: r["count"] for r in rows.groupBy("s").count().collect()}
    assert abs(counts[0] - 10000) < 500 and abs(counts[1] - 10000) < 500 and abs(counts[2] - 20000) < 500
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), {0: 0.0})


def test_slots_of_clashing_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 9, 9), (2, 9, 9)], "id long, slot long, Shard int")
    out = sharding.shard_records(df, "id", {0: 1.0}).collect()
    assert sorted((r.shard, r.slot) for r in out) == [(0, 0), (0, 1)]
    assert sharding.shard_records(df.where("id > 5"), "id", {0: 1.0}).count() == 0


def test_rollup_batches(spark, tmp_path):
    side = token_rollup.side
    rows = spark.createDataFrame([("a", "en", 5), ("a", "en", None), (None, None, 2)], "source string, lang string, n long")
    one = side(F.col("source"), F.col("lang"), F.lit("v1"), F.col("n"))
    two = side(F.col("source"), F.col("lang"), F.lit("v2"), F.col("n") * 2)
    root = str(tmp_path / "t")
    inserts = rows.select(token_rollup.nothing().alias("before"), one.alias("after"))
    for _ in range(2):
        assert token_rollup.commit_batch(inserts, root, "1")
    token_rollup.commit_batch(rows.where("source is null").select(one.alias("before"), two.alias("after")), root, "2")
    want = {("a", "en", "v1", 2, 5), (None, None, "v2", 1, 4)}
    assert {tuple(r) for r in token_rollup.totals(spark, root).collect()} == want
    token_rollup.commit_batch(inserts.where("false"), root, "3")
    token_rollup.compact(spark, root, f"{root}-2")
    assert not token_rollup.commit_batch(inserts, f"{root}-2", "1")
    assert {tuple(r) for r in token_rollup.totals(spark, f"{root}-2").collect()} == want
    token_rollup.commit_batch(rows.where("source = 'a'").select(one.alias("before"), token_rollup.nothing().alias("after")), f"{root}-2", "4")
    assert {tuple(r) for r in token_rollup.totals(spark, f"{root}-2").collect()} == {(None, None, "v2", 1, 4)}
    assert token_rollup.totals(spark, f"{root}-none").count() == 0


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == {"a": 200.0, "b": pytest.approx(500 / 3), None: pytest.approx(250 / 3)}
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op2(spark, sf_dir).collect()
    assert len(rows) == docs.count()
    assert sorted(map(tuple, queries.op2(spark, sf_dir).collect())) == sorted(map(tuple, rows))
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    sizes, taken, goal = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0
        sizes[s], taken[s], goal[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken, r.target
    assert goal == pytest.approx(mixing.targets(sizes))
    for s in goal:
        assert abs(taken[s] - goal[s]) <= max(5, 0.02 * goal[s])
    # the rates solve the dual: within a source, log(rate) is proportional to the size where the bound does not hold
    by = {}
    for r in rows:
        if 0 < r.rate < 2 and r.size:
            by.setdefault(source[r.doc_id], []).append((r.size, r.rate))
    for own in by.values():
        slopes = [math.log(rate) / size for size, rate in own if rate > 1e-4]
        assert max(slopes) - min(slopes) < 1e-4 * max(abs(max(slopes)), 1e-3) + 1e-6
        

def test_mix_of_odd_tables(docs, spark):
    rows = docs.withColumn("rate", F.lit("x")).withColumn("copies", F.lit("y"))
    out = mixing.mix(rows, "source", word_count(F.col("text")), ["doc_id"]).collect()
    assert len(out) == docs.count() and {r.source_size for r in out if r.source is None} == {sum(r.size for r in out if r.source is None)}
    assert all(r.copies in (0, 1, 2) for r in out)
    assert mixing.mix(docs.where("false"), "source", word_count(F.col("text")), ["doc_id"]).count() == 0


def test_mix_with_columns_of_the_results_names(docs, spark):
    words = word_count(F.col("text"))
    plain = mixing.mix(docs, "source", words, ["doc_id"]).select("doc_id", "size", "target", "copies").collect()
    named = docs.select(F.col("doc_id").alias("copies"), "text", F.col("source").alias("target"), words.alias("size"), F.lit("x").alias("Rate"))
    found = mixing.mix(named.withColumn("key", F.col("copies")), "target", F.col("size"), ["copies"])
    assert found.columns == ["text", "key", "size", "source_size", "target", "rate", "copies"]
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(found.select("key", "size", "target", "copies").collect()) == order(plain)
