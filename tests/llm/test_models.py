"""Language ID, encoding, similarity joins and severity against brute force, round trips and held-out rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from optiontide.llm import bpe, components, hyperminhash, itq, lang_id, queries, secrets, shingles, toxicity, voronoi

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def saved(df, path, name="documents"):
    df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows."""
    rows = [(0, None, "en", "a", 0), (1, "", None, None, 0), (2, "12 34 !!", "en", "a", 8), (3, "the thing and the other", None, "b", 23),
            (3, "the thing and the other", None, "b", 23), (None, "the thing and the other", "en", "b", 23), (4, "wo rd " * 200000, "en", "a", 1200000)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.RANK_FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_against_the_library(reference_encoding):
    merger, table = bpe.Merger(bpe.read_ranks(queries.RANK_FILE)), bpe.class_table()
    random.seed(5)
    letters = list("abst rvel'd m  \n\n\t!?.,12é中  🙂'\"´²Ⅷ")
    texts = ["".join(random.choices(letters, k=random.randint(0, 50))) for _ in range(4000)]
    texts += ["", "x" * 5000, "ab" * 3000, " " * 700 + "a", "don't we'll they've i'm", "''s 's'll\n's"]
    ids, starts = bpe.encode_texts(texts, merger, table)
    words = {v: k for k, v in merger.ranks.items()}
    for text, own, at in zip(texts, ids.to_pylist(), starts.to_pylist(), strict=True):
        assert own == reference_encoding.encode_ordinary(text)
        assert b"".join(bpe.decode_slice(own, at, i, words) for i in range(len(at))) == text.encode()


def test_round_trip_is_decode_after_encode(spark, odd):
    df = odd.withColumn("IDS", F.lit(1)).withColumn("n", F.lit(2))
    one = bpe.round_trip(df, "text", queries.RANK_FILE)
    assert one.columns == [c for c in df.columns if c not in ("text", "IDS")] + ["ids", "decoded"]
    two = bpe.decode(bpe.encode(odd, "text", queries.RANK_FILE), "ids", queries.RANK_FILE)
    plain = lambda rows: sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in rows)
    assert plain(one.collect()) == plain(two.collect())
    assert bpe.round_trip(df.limit(0), "text", queries.RANK_FILE).count() == 0


def test_decoding_in_arrays():
    words = bpe.word_table(bpe.read_ranks(queries.RANK_FILE))
    ids = pa.array([[1, 2, 300], None, [], [4]], pa.list_(pa.int32()))
    ranks = {v: k for k, v in bpe.read_ranks(queries.RANK_FILE).items()}
    want = [None if own is None else b"".join(ranks[i] for i in own) for own in ids.to_pylist()]
    assert bpe.decode_ids(ids, words).to_pylist() == want
    assert bpe.decode_ids(ids.slice(2), words).to_pylist() == want[2:] and bpe.decode_ids(ids.slice(0, 0), words).to_pylist() == []
    with pytest.raises((ValueError, IndexError)):
        bpe.decode_ids(pa.array([[60000]], pa.list_(pa.int32())), words)


def test_bpe_query(odd, tmp_path, spark, reference_encoding):
    texts = {r.doc_id: r.text for r in odd.collect()}
    rows = queries.op10(spark, saved(odd, tmp_path / "d")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        own = reference_encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(own) and r.ids_sha256 == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    clash = odd.where("doc_id = 3").withColumn("ids", F.lit(1)).withColumn("starts", F.lit(1))
    assert dict(bpe.encode(clash, "text", queries.RANK_FILE).dtypes)["ids"] == "array<int>"
    assert bpe.encode(odd.where("false"), "text", queries.RANK_FILE).count() == 0


def test_language_held_out(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1(spark, sf_dir).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    right = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(right) >= 0.9 * len(right)


def test_language_of_odd_tables(odd, tmp_path, spark):
    rows = queries.op1(spark, saved(odd, tmp_path / "d")).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in rows) == [(0, "en"), (0, "und"), (1, "und"), (2, "und"), (3, "en"), (3, "en"), (4, "en")]
    none = lang_id.fit(odd.where("lang = 'xx'"), "doc_id", "text", "lang")
    assert none is None and {r.lang_pred for r in lang_id.predict(odd.withColumn("score", F.lit("x")), "text", none).collect()} == {"und"}


def test_language_kernel_is_the_presence_kernel():
    texts = ["abcab", "bcd", "Zoë zoë"]
    sets = np.zeros((3, lang_id.BITS), dtype=np.float32)
    for row, text in zip(sets, texts, strict=True):
        lang_id.presence(text, row)
    model = lang_id.LanguageModel(["x"], np.packbits(sets.astype(np.uint8), axis=1), np.zeros((3, 1)))
    grams = [{t.lower()[i : i + n] for n in lang_id.SIZES for i in range(len(t) - n + 1)} for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in grams] for a in grams]
    assert np.allclose(model.kernel(sets), want, atol=1e-6)


@pytest.fixture(scope="module")
def long_texts(spark):
    """Documents to learn from, and clean texts: joined to megabytes, and beside many ids or letters of another script."""
    random.seed(6)
    signs = "abcdefghijklmnopqrstuvwxyz0123456789-_"
    ids = " ".join("".join(random.choices(signs, k=16)) for _ in range(30000))
    han = "".join(chr(random.randrange(0x4E00, 0x9FA5)) for _ in range(100000))
    texts = {}
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect():
        texts.setdefault(r.lang, []).append(r.text)
    cases = []
    for lang, own in texts.items():
        one = next(t for t in own if 4000 < len(t) < 6000)
        cases += [(lang, one), (lang, f"{one} {ids}"), (lang, f"{ids} {one}"), (lang, one + han), (lang, " ".join(own))]
    assert max(len(t) for _, t in cases) > 10_000_000
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), cases


def test_language_of_long_and_symbol_rich_texts(long_texts, spark):
    docs, cases = long_texts
    rows = spark.createDataFrame([(k, lang, t) for k, (lang, t) in enumerate(cases)], "k int, lang string, text string")
    got = lang_id.predict(rows, "text", queries.language_model(docs)).collect()
    assert len(got) == len(cases) and [(r.k, r.lang_pred) for r in got if r.lang_pred != r.lang] == []


def test_pipeline_keeps_long_and_id_heavy_documents(long_texts, spark):
    docs, cases = long_texts
    clean = spark.createDataFrame([(-1 - k, t, None, "long", len(t)) for k, (_, t) in enumerate(cases)], DOCS)
    junk = spark.createDataFrame([(-100, "0123456789 " * 500000, None, "junk", 5500000)], DOCS)
    learnt = docs.where("lang IS NOT NULL").select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.identify_language(spark, learnt.union(clean).union(junk), "")
    found = {r.doc_id: r.lang for r in kept.where("doc_id < 0").select("doc_id", "lang").collect()}
    assert found == {-1 - k: lang for k, (lang, _) in enumerate(cases)}


def test_windows_hold_every_ngram(monkeypatch):
    monkeypatch.setattr(lang_id, "WINDOW", 7)
    for length in (0, 1, 7, 8, 50, 99):
        text = "".join(chr(97 + k % 26) if k % 9 else " " for k in range(length))
        borders = lang_id.window_starts(length)
        cut = [lang_id.window(text, borders, k) for k in range(len(borders) - 1)]
        grams = [{t[i : i + n] for n in lang_id.SIZES for i in range(len(t) - n + 1)} for t in (*cut, text)]
        assert set().union(*grams[:-1]) == grams[-1] and max(map(len, cut)) <= 9


def sets_of(texts, words):
    def lowered(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").split(" ")
    out = []
    for t in texts:
        w = [x for part in lowered(t) for x in part.split("\n") if x]
        out.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    return out


def components_of(keys, sets, percent):
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        least[find(i)] = min(least.get(find(i), k), k)
    return [least[find(i)] for i in range(len(keys))]


@pytest.fixture(scope="module")
def copies():
    """Near copies in a chain and in a star, short texts, and texts that share passages."""
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size in (6, 9, 30, 90, 300, 500):
        base_text = random.choices(words, k=size)
        for _ in range(25):
            own = list(base_text)
            for _ in range(random.randint(0, max(1, size // 25))):
                own[random.randrange(size)] = random.choice(words)
            texts.append(" ".join(own))
            base_text = own if random.random() < 0.3 else base_text
    passage = " ".join(random.choices(words, k=40))
    texts += [f"{passage} {' '.join(random.choices(words, k=30))}" for _ in range(60)]
    texts += [None, "", "  ", "One", "one", "two words", "Two  Words", texts[3], texts[3].upper()]
    return texts


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(spark, tmp_path, copies, block, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    monkeypatch.setattr(hyperminhash, "BLOCK_BYTES", block * 4096)
    keys = random.Random(3).sample(range(1000), len(copies))
    docs = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in zip(keys, copies, strict=True)], DOCS)
    rows = {r.doc_id: r for r in queries.op8(spark, saved(docs, tmp_path / "d")).collect()}
    sets = sets_of(copies, 4)
    for key, own, component in zip(keys, sets, components_of(keys, sets, 80), strict=True):
        assert rows[key].n_shingles == len(own) and rows[key].component_id == component and rows[key].kept == (key == component)


def test_near_duplicates_of_odd_tables(odd, spark):
    rows = hyperminhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id in (0, 1, 3)} == {(0, 0, True), (1, 1, True), (3, 3, True)}
    left = hyperminhash.one_of_each(odd.withColumn("key", F.lit(1)).withColumn("mark", F.lit(1)))
    assert sorted(r.doc_id for r in left.collect()) == [0, 1, 2, 3, 4]
    assert hyperminhash.near_duplicates(odd.where("false")).count() == 0


def test_one_of_each_of_repeated_and_null_keys(spark):
    base = [f"w{i}" for i in range(200)]
    near = [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in (199, 198, 197)]
    other = [" ".join(reversed(t.split())) for t in near]
    rows = [(7, near[0]), (7, near[1]), (7, near[1]), (9, near[2]), (None, near[2]), (None, other[0]), (None, other[1]), (None, None), (None, "")]
    docs = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in rows], DOCS)
    left = [(r.doc_id, r.text) for r in hyperminhash.one_of_each(docs).collect()]
    assert len([r for r in left if r[1] in near]) == 1 and {k for k, t in left if t in near} == {7}
    assert len([r for r in left if r[1] in other]) == 1 and len(left) == 4


def test_registers_estimate():
    rng = np.random.default_rng(1)
    for n in (100, 230, 3000):
        base_set = rng.integers(0, 2**64, size=n, dtype=np.uint64)
        errors = []
        for _ in range(30):
            keep = int(n * rng.uniform(0.75, 1))
            other = np.unique(np.concatenate([base_set[:keep], rng.integers(0, 2**64, size=n - keep, dtype=np.uint64)]))
            a, b = hyperminhash.registers(np.unique(base_set)), hyperminhash.registers(other)
            guess = hyperminhash.estimated(a[None], b[None], np.array([float(n)]), np.array([float(n)]))[0]
            errors.append(guess - keep / (2 * n - keep))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_shingles_of_long_texts(monkeypatch):
    texts = pa.array(["a b c d e f g h " * 50, None, "x" * 900 + " y z w v", "A\x0bb c D"])
    whole = [s.tolist() for s in shingles.shingle_sets(texts, 4)]
    monkeypatch.setattr(shingles, "BLOCK", 64)
    assert [s.tolist() for s in shingles.shingle_sets(texts, 4)] == whole
    assert [len(s) for s in whole] == [8, 0, 2, 1]


def test_components(spark, tmp_path):
    random.seed(4)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(random.randrange(100, 400), random.randrange(100, 400)) for _ in range(150)] + [(7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(pairs, "a long, b long"), str(tmp_path / "c")).collect()}
    nodes = sorted({x for p in pairs for x in p})
    label = {x: x for x in nodes}
    for _ in nodes:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert all(got.get(x, x) == label[x] for x in nodes)
    assert components.components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "e")).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 24))
    rows = [(i, (centres[i % 40] + 0.12 * rng.standard_normal(24)).tolist(), 0) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(60)]
    rows += [(2000, None, 0), (2001, [0.0] * 24, 0), (2002, [None] * 24, 0), (2003, [float("nan")] * 24, 0), (2004, [], 0), (2050, rows[3][1], 0), (5, rows[5][1], 1)]
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", block)
    rows = vector_rows()
    got = queries.op7(spark, saved(spark.createDataFrame(rows, VECTORS), tmp_path / "e", "embeddings")).collect()
    assert len(got) == len(rows)
    good = [(k, np.array(v, dtype=np.float32).astype(float)) for k, v, _ in rows if v and None not in v and np.isfinite(v).all() and np.linalg.norm(v)]
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = {}
    for (k, _), n in zip(good, near.sum(axis=1), strict=True):
        want.setdefault(k, []).append(n)
    found = {}
    for r in got:
        found.setdefault(r.vec_id, []).append(r.n_links)
    total = sum(map(sum, want.values()))
    assert sum(map(sum, found.values())) >= 0.97 * total
    assert all(sorted(found[k])[i] <= n for k, own in want.items() for i, n in enumerate(sorted(own)))
    for r in got:
        assert r.kept == (r.vec_id == r.component_id) and (r.component_id == r.vec_id or r.n_links)
        if r.vec_id in (2000, 2001, 2002, 2003, 2004):
            assert (r.n_links, r.component_id) == (0, r.vec_id)
    assert queries.op7(spark, saved(spark.createDataFrame([], VECTORS), tmp_path / "none", "embeddings")).count() == 0


def test_near_vectors_of_any_length(spark):
    """Huge and tiny vectors have cosines like others."""
    rows = [(0, [1e200, 2e200, 0.0]), (1, [1e-200, 2e-200, 0.0]), (2, [1.0, 2.0, 1e-3]), (3, [-1e200, 5e199, 0.0]), (4, [5e-324, 1e-323, 0.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {0: (3, 0), 1: (3, 0), 2: (3, 0), 4: (3, 0), 3: (0, 3)}


@pytest.mark.parametrize("common", [0.5, 0.8])
def test_near_vectors_with_a_common_direction(spark, common):
    rng = np.random.default_rng(4)
    own = rng.standard_normal((1500, 63))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    turn = rng.standard_normal(own.shape)
    turn -= (turn * own).sum(axis=1, keepdims=True) * own
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = (0.901 - common**2) / (1 - common**2)
    rest = np.concatenate([own, cosine * own + np.sqrt(1 - cosine**2) * turn]) * np.sqrt(1 - common**2)
    vectors = np.column_stack([np.full(3000, common), rest])
    near = vectors @ vectors.T >= 0.9
    np.fill_diagonal(near, False)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    links = {r.vec_id: r.n_links for r in itq.near_vectors(rows).collect()}
    assert near.sum() >= 3000 and all(links[k] <= n for k, n in enumerate(near.sum(axis=1)))
    assert sum(links.values()) >= 0.9 * near.sum()


@pytest.mark.parametrize("slice_rows,part,pivots", [(16384, 1024, 128), (37, 3, 2)])
def test_top_k(spark, tmp_path, slice_rows, part, pivots, monkeypatch):
    monkeypatch.setattr(voronoi, "SLICE", slice_rows)
    monkeypatch.setattr(voronoi, "PART", part)
    monkeypatch.setattr(voronoi, "PER_PIVOT", pivots)
    rows = vector_rows()
    got = queries.op3(spark, saved(spark.createDataFrame(rows, VECTORS), tmp_path / "e", "embeddings")).collect()
    data = {(k, tuple(np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int))) for k, v, _ in rows if v is not None and None not in v and np.isfinite(v).all()}
    want = []
    for k, q in data:
        if k % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), j) for j, v in data if j != k)[:5]
            want += [(k, i + 1, j, -s) for i, (s, j) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_clusters_sends_little(spark, tmp_path, monkeypatch):
    """Clustered vectors meet only the groups that need their cell; the result is the plain one."""
    monkeypatch.setattr(voronoi, "PER_PIVOT", 2)
    sent = []
    plain = voronoi._sent
    monkeypatch.setattr(voronoi, "_sent", lambda pivots, width, groups, need, *rest: sent.append((need, rest[0])) or plain(pivots, width, groups, need, *rest))
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 16)) * 40
    owner = rng.integers(0, 12, 3000)
    vectors = (centres[owner] + rng.standard_normal((3000, 16))).round().astype(np.int64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, q array<bigint>")
    got = sorted(map(tuple, voronoi.top_k(df, "vec_id", "q", F.col("vec_id") % 50 == 0, 5).collect()))
    scores = vectors @ vectors.T
    want = []
    for q in range(0, 3000, 50):
        best = sorted((-scores[q, j], j) for j in range(3000) if j != q)[:5]
        want += [(q, i + 1, j, -s) for i, (s, j) in enumerate(best)]
    assert got == sorted(want)
    need, parts = sent[0]
    assert len(need) > 1 and need[need.any(axis=1)].mean() < 0.5 and parts.max() == 1


def test_top_k_of_huge_components(spark):
    rows = [(0, [-1e30, 1.0]), (50, [1e30, 2.0]), (1, [3.0, 1e18]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("q", voronoi.whole_numbers(F.col("v"), 256))
    got = {(r.query_id, r.vec_id): r.score for r in voronoi.top_k(df, "vec_id", "q", F.col("vec_id") % 50 == 0, 5).collect()}
    top = 2**63 - 1
    assert len(got) == 6 and got[0, 50] == -top - 1 and got[50, 1] == top and got[50, 2] == top


def test_top_k_of_few_rows(spark, tmp_path):
    rows = [(0, [1.0], 0), (7, [2.0], 0), (None, [3.0], 0)]
    got = queries.op3(spark, saved(spark.createDataFrame(rows, VECTORS), tmp_path / "e", "embeddings")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 131072)]
    assert queries.op3(spark, saved(spark.createDataFrame([], VECTORS), tmp_path / "none", "embeddings")).count() == 0


def test_ordinal_fit_orders_and_separates():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 4))
    line = x @ np.array([2.0, -1.0, 0.0, 0.5]) + rng.logistic(size=1500)
    grades = (line > -1).astype(int) + (line > 1.5)
    weights, edges = toxicity.fit_ordinal(x, grades, 3, shrink=1e-6)
    assert np.allclose(weights, [2, -1, 0, 0.5], atol=0.3) and np.allclose(edges, [-1, 1.5], atol=0.3)


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labelled = docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    model = toxicity.fit(labelled.select("doc_id", "text"), labelled.where("doc_id % 2 = 0"), "doc_id", "text", queries.severity_grade(), 3)
    rows = toxicity.severity(labelled.where("doc_id % 2 = 1").select("doc_id", "text", F.col("toxic").alias("truth")), "text", model).collect()
    clean = [r for r in rows if r.truth == 0]
    bad = [r for r in rows if r.truth == 1]
    assert sum(r.toxic for r in clean) <= 0.03 * len(clean) and sum(r.toxic for r in bad) >= 0.4 * len(bad)
    assert np.mean([r.severity for r in bad]) > np.mean([r.severity for r in clean]) + 0.5


def test_toxicity_of_odd_tables(odd, spark):
    rows = odd.withColumn("toxic", F.lit("x")).withColumn("grade", F.lit(2))
    model = toxicity.fit(odd, odd, "doc_id", "text", F.when(F.col("doc_id") == 3, 2).when(F.col("doc_id") == 4, 0), 3)
    out = toxicity.severity(rows, "text", model).collect()
    assert len(out) == odd.count() and all(0 <= r.severity <= 2 for r in out)
    assert toxicity.fit(odd, odd, "doc_id", "text", F.lit(None), 3) is None
    assert not any(r.toxic for r in toxicity.severity(odd, "text", None).collect())


def test_pipeline(spark, sf_dir, tmp_path, reference_encoding):
    """Stage by stage against plain versions of its decisions."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "secret scans", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf_dir).write.parquet(str(tmp_path / str(k)))
        tables.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert tables[-1].columns == docs.columns
    raw, known, single, clean, mixed, tokens = [t.collect() for t in tables]
    assert len(known) >= 0.97 * len(raw)
    keys = [r.doc_id for r in known]
    sets = sets_of([r.text for r in known], 5)
    want = {k for k, c in zip(keys, components_of(keys, sets, 80), strict=True) if k == c}
    assert {r.doc_id for r in single} == want and len(single) == len(want)
    before = {r.doc_id: r for r in single}
    assert len(clean) == len(single)
    spans = secrets.find_secrets(tables[2]).where(F.size("secrets") > 0).select("doc_id").collect()
    assert {r.doc_id for r in clean if r.text != before[r.doc_id].text} == {r.doc_id for r in spans}
    for r in clean:
        assert r.n_chars == (len(r.text) if r.text != before[r.doc_id].text else before[r.doc_id].n_chars)
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    texts = {r.doc_id: r.text for r in clean}
    assert set(taken.values()) == {1, 2} and set(taken) <= set(texts)
    assert len(tokens) == len(mixed)
    for r in tokens:
        assert r.n_tokens == len(reference_encoding.encode_ordinary(texts[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
