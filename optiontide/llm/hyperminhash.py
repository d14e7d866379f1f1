"""Near duplicates by HyperMinHash.

A text is its set of word shingles. A signature has 128 registers of 16 bits:
the number of leading zeros of a least hash value and the ten bits that follow
(mantissa). Sets above ``DENSE`` shingles fill the registers from one hash by
buckets, an empty bucket borrowing from others in a fixed random order; smaller
sets take a least value per register of 128 hashes. Sets near the border carry
both, so that any two sets that may be similar share a kind.

Registers are banded, 25 bands of 5. Texts with equal sets fold to one class
first. Every bucket's members are compared with its least one by the Jaccard
estimate (corrected for registers that agree by chance); pairs that it does not
rule out join classes to clusters. In buckets that hold several clusters every member names its few most
similar ones of other clusters, round by round until no pair crosses clusters;
the number of pairs stays in proportion to the members. Each cluster is then
solved on the full sets: pairs of blocks of bounded size meet, pairs that are joined
already or that the estimate rules out are passed over, and a task returns no more links
than a tree needs. So a bucket or cluster may hold any number of texts, no link is given up, and pairs
are never listed. Links join classes to components.

A text without words links with nothing. Null and repeated keys are kept: rows
of equal sets share a class whatever their keys. Work tables go to the shared
folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optiontide.llm.common import Folder, lean
from optiontide.llm.components import components
from optiontide.llm.shingles import mixed, shingle_sets

WORDS = 5
PERCENT = 80
REGISTERS = 128
MANTISSA = 10
BANDS, ROWS = 25, 5
#: Sets of more shingles use buckets of one hash; from 80 % of that on, both kinds.
DENSE = 256
BOTH = DENSE * 4 // 5
#: Estimates this far below the threshold (four standard errors) are not confirmed.
MARGIN = 0.14
#: Members of a bucket that meet in one group, and bytes of their registers and full sets.
BLOCK = 512
BLOCK_BYTES = 2 << 20
#: Rows of small buckets or clusters that share a group, and their bytes.
PACK = 1024
PACK_BYTES = 4 << 20
#: Rows whose band keys are made at once.
KEYED = 1024
#: Partners that a member names in a round, and more rounds than clusters can be halved.
BEST = 3
ROUNDS = 64

_SEEDS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64))
_DONORS = np.stack([np.random.default_rng(k).permutation(REGISTERS) for k in range(64)])
_BAND = [np.arange(b, BANDS * ROWS, BANDS) for b in range(BANDS)]


def compressed(values: np.ndarray) -> np.ndarray:
    """16-bit registers of least values: leading zeros, then the mantissa; never 0."""
    zeros = 63 - np.frexp(values.astype(np.float64))[1].clip(0, 63)
    wrong = (zeros > 0) & ((values >> (63 - zeros).astype(np.uint64)) > 1)  # rounded up to the next power
    zeros = (zeros - wrong).clip(0, 62).astype(np.uint64)
    rest = (values << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | rest).astype(np.uint16)


def registers(grams: np.ndarray) -> np.ndarray:
    """Registers of a sorted set: row 0 for small sets, row 1 for large ones; zeros where a kind does not apply."""
    out = np.zeros((2, REGISTERS), dtype=np.uint16)
    n = len(grams)
    if 0 < n <= DENSE:
        out[0] = compressed(mixed(grams[:, None] ^ _SEEDS[None, :]).min(axis=0))
    if n > BOTH:
        heads = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(57)
        at = np.searchsorted(grams, heads)
        own = np.minimum(at, n - 1)
        full = (at < n) & ((grams[own] >> np.uint64(57)) == np.arange(REGISTERS, dtype=np.uint64))
        row = np.where(full, compressed(grams[own] << np.uint64(7)), 0).astype(np.uint16)
        empty = np.flatnonzero(~full)
        for donors in _DONORS:
            if not len(empty):
                break
            out[1] = row
            given = donors[empty]
            row[empty] = np.where(full[given], out[1][given], 0)
            empty = empty[row[empty] == 0]
        if len(empty):
            row[empty] = row[full][0]
        out[1] = row
    return out


def by_chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that the registers of independent sets of n and m values agree."""
    total, both = np.zeros(np.broadcast(n, m).shape), (n + m).astype(np.float64)
    for zeros in range(40):
        low = 2.0 ** -(zeros + 1)
        width = low / (1 << MANTISSA)
        total += n * m * width * (np.exp(-both * low) - np.exp(-both * 2 * low)) / both
    return np.minimum(total, 0.5)


def estimated(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates; registers have shape (..., 2, REGISTERS)."""
    kind = ((left[..., 1, 0] != 0) & (right[..., 1, 0] != 0)).astype(np.int64)
    pick = kind[..., None, None]
    same = (np.take_along_axis(left, pick, -2) == np.take_along_axis(right, pick, -2))[..., 0, :].mean(axis=-1)
    share = np.where(kind == 1, REGISTERS, 1)
    chance = by_chance(np.maximum(n / share, 1.0), np.maximum(m / share, 1.0))
    return (same - chance) / (1 - chance)


def _fixed(column: pa.Array, kind, *shape: int) -> np.ndarray:
    """A binary column without nulls, all of one width, as an array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32 if pa.types.is_binary(column.type) else np.int64)
    first, last = offsets[column.offset], offsets[column.offset + len(column)]
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[first:last].view(kind).reshape(len(column), *shape)


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 128) for whole in batches for at in range(0, whole.num_rows, 128)):
            sizes, ids, signs = [], [], []
            for grams in shingle_sets(batch.column("text"), words):
                sizes.append(len(grams))
                ids.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                signs.append(registers(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(signs, pa.binary())],
                ["key", "mark", "n_shingles", "set_id", "registers"])
    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                grams = [g.tobytes() for g in shingle_sets(part.column("text"), words)]
                yield pa.RecordBatch.from_arrays([part.column("set_id"), pa.array(grams, pa.binary())], ["set_id", "grams"])
    return run


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (whole.slice(at, KEYED) for whole in batches for at in range(0, whole.num_rows, KEYED)):
        rows = _fixed(batch.column("registers"), np.uint16, 2, REGISTERS).astype(np.uint64)
        owners, keys = [], []
        for kind in (0, 1):
            there = np.flatnonzero(rows[:, kind, 0])
            for b, places in enumerate(_BAND):
                key = np.full(len(there), kind * BANDS + b + 1, dtype=np.uint64)
                for p in places:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[there, kind, p])
                owners.append(there)
                keys.append(key.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), batch.column("set_id").take(pa.array(np.concatenate(owners)))], ["band", "set_id"])


def _close_enough(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                left, right = (_fixed(part.column(c), np.uint16, 2, REGISTERS) for c in ("ra", "rb"))
                n, m = (part.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("na", "nb"))
                good = estimated(left, right, n, m) >= share - MARGIN
                good &= np.minimum(n, m) >= share * np.maximum(n, m)
                yield part.filter(pa.array(good)).select(["a", "b"])
    return run


def _registers_of(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["registers"]), dtype=np.uint16).reshape(len(rows), 2, REGISTERS)


def _named(share: float):
    """Bucket by bucket, each member with its most similar partners in other clusters that the estimate does not rule out."""
    def one_bucket(rows: pd.DataFrame, out: list) -> None:
        regs, n, ids, block = _registers_of(rows), rows["n_shingles"].to_numpy(np.float64), rows["set_id"].to_numpy(), rows["block"].to_numpy()
        codes = pd.factorize(rows["label"])[0]
        for i in range(len(rows)):
            there = codes != codes[i]
            if block.min() != block.max():
                there &= block != block[i]
            others = np.flatnonzero(there & (np.minimum(n, n[i]) >= share * np.maximum(n, n[i])))
            if len(others):
                guess = estimated(regs[i][None], regs[others], n[i : i + 1], n[others])
                good = np.flatnonzero(guess >= share - MARGIN)
                good = good[np.argsort(-guess[good], kind="stable")[:BEST]]
                out += [(max(ids[i], ids[j]), min(ids[i], ids[j])) for j in others[good]]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[bytes, bytes]] = []
        for _, own in rows.groupby("band", sort=False):
            if own["label"].nunique() > 1:
                one_bucket(own, out)
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"])
    return run


def _linked(percent: int):
    """Cluster by cluster, links that join what the full sets confirm: no more than a tree needs."""
    share = percent / 100

    def one_cluster(rows: pd.DataFrame, out: list) -> None:
        regs, n, ids, block = _registers_of(rows), rows["n_shingles"].to_numpy(np.float64), rows["set_id"].to_numpy(), rows["block"].to_numpy()
        sets = [np.frombuffer(g, dtype=np.uint64) for g in rows["grams"]]
        root, low, high = np.arange(len(rows)), block.min(), block.max()
        for i in np.flatnonzero(block == low):
            there = (root != root[i]) & (block == high) & (np.minimum(n, n[i]) >= share * np.maximum(n, n[i]))
            if low == high:
                there[: i + 1] = False
            others = np.flatnonzero(there)
            if not len(others):
                continue
            others = others[estimated(regs[i][None], regs[others], n[i : i + 1], n[others]) >= share - MARGIN]
            for at in range(0, len(others), 256):
                part = others[at : at + 256]
                joined = np.concatenate([sets[j] for j in part])
                place = np.minimum(np.searchsorted(sets[i], joined), len(sets[i]) - 1)
                both = np.add.reduceat((sets[i][place] == joined).astype(np.int64), np.concatenate([[0], np.cumsum(n[part])[:-1]]).astype(np.int64))
                for j in part[100 * both >= percent * (n[i] + n[part] - both)]:
                    if root[j] != root[i]:
                        out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
                        root[root == root[j]] = root[i]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[bytes, bytes]] = []
        for _, own in rows.groupby("label", sort=False):
            if len(own) > 1:
                one_cluster(own, out)
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _estimate(pairs: DataFrame, classes: DataFrame, share: float) -> DataFrame:
    """Of pairs (a, b), those that the estimate does not rule out."""
    for side in "ab":
        own = classes.select(F.col("set_id").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("registers").alias(f"r{side}"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(lean(_close_enough(share)), "a binary, b binary")


def _sets(ids: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Full sets (set_id, grams) of the classes ``ids``, each from one of its texts."""
    chosen = ids.join(classes, "set_id").select("set_id", F.col("rep.key").alias("__key"), F.col("rep.mark").alias("__mark"))
    found = texts.join(chosen, F.col("key").eqNullSafe(F.col("__key")) & (F.col("mark") == F.col("__mark"))).select("set_id", "text")
    sets = found.mapInArrow(lean(_full_sets(words)), "set_id binary, grams binary")
    return sets.groupBy("set_id").agg(F.max("grams").alias("grams"))  # repeated rows fold here


def _blocked(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a bucket or cluster (``key``, with its number of ``members`` and their ``bytes``) dealt to groups of pairs of blocks; small
    ones share groups. Groups are bounded by rows and by bytes; a set that is larger than a block is a block of its own or nearly so."""
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes") / F.col("members")).alias("bytes")).first()
    packs = max(1, whole["n"] // PACK, int((whole["bytes"] or 0) // PACK_BYTES))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    return (
        rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("pack", F.when(F.col("blocks") > 1, F.xxhash64(key)).otherwise(F.pmod(F.xxhash64(key), F.lit(packs))))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    )


def _across(members: DataFrame, labels: DataFrame, classes: DataFrame, share: float, folder: Folder, name: str) -> DataFrame:
    """Pairs that members of different clusters name in the buckets that hold more than one cluster."""
    named = members.join(labels, F.col("set_id") == F.col("node"), "left").select(
        "band", "members", "set_id", F.coalesce("label", "set_id").alias("label"))
    open_ = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    rows = folder.put(named.join(open_, "band"), f"open-{name}")
    rows = _blocked(rows.withColumn("bytes", F.col("members") * REGISTERS * 4), "band").join(classes.select("set_id", "n_shingles", "registers"), "set_id")
    return folder.put(rows.groupBy("pack", "low", "high").applyInPandas(_named(share), "a binary, b binary").distinct(), f"pairs-{name}")


def _components(df: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """key, mark (hash of the text), n_shingles, component and first of each row: ``first`` is whether key and mark are the component's least."""
    share = percent / 100
    folder = Folder(df, "minhash")
    texts = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    signed = folder.put(
        texts.mapInArrow(lean(_signatures(words)), f"key {kind}, mark long, n_shingles long, set_id binary, registers binary"), "signed")
    classes = folder.put(
        signed.where("n_shingles > 0").groupBy("set_id").agg(
            F.max("n_shingles").alias("n_shingles"), F.max("registers").alias("registers"), F.min(F.struct("key", "mark")).alias("rep"),
            F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark")).alias("least")), "classes")

    members = folder.put(classes.select("set_id", "registers").mapInArrow(lean(_band_keys), "band long, set_id binary"), "members")
    heads = members.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min("set_id").alias("head")).where("members > 1")
    members = folder.put(members.join(heads, "band"), "buckets")

    stars = members.where("set_id <> head").select(F.col("set_id").alias("a"), F.col("head").alias("b")).distinct()
    pairs = folder.put(_estimate(stars, classes, share), "stars")
    clusters = components(pairs, f"{folder.path}/clusters")
    members = members.where("members > 2")
    for k in range(ROUNDS + 1):  # every round at least halves the clusters that a pair still crosses
        more = _across(members, clusters, classes, share, folder, str(k))
        if more.isEmpty():
            break
        if k == ROUNDS:
            raise RuntimeError("clusters did not settle")
        pairs = pairs.union(more)
        clusters = components(pairs, f"{folder.path}/clusters-{k}")

    own = clusters.select(F.col("node").alias("set_id"), "label").join(classes.select("set_id", "n_shingles"), "set_id")
    sizes = own.groupBy("label").agg(F.count(F.lit(1)).alias("members"), F.sum(8 * F.col("n_shingles") + 4 * REGISTERS).alias("bytes"))
    inside = folder.put(clusters.select(F.col("node").alias("set_id"), "label").join(sizes, "label"), "inside")
    sets = folder.put(_sets(inside.select("set_id"), classes, texts, words), "sets")
    rows = _blocked(inside, "label").join(classes.select("set_id", "n_shingles", "registers"), "set_id").join(sets, "set_id")
    links = folder.put(rows.groupBy("pack", "low", "high").applyInPandas(_linked(percent), "a binary, b binary"), "links")
    labels = components(links, f"{folder.path}/components")

    grouped = classes.join(labels, F.col("set_id") == F.col("node"), "left").select("set_id", F.coalesce("label", "set_id").alias("label"), "least")
    least = grouped.groupBy("label").agg(F.min("least").alias("component"))
    owner = folder.put(grouped.join(least, "label").select(F.col("set_id").alias("__set"), "component"), "owner")
    rows = signed.select("key", "mark", "n_shingles", "set_id").join(owner, F.col("set_id") == F.col("__set"), "left")
    alone = F.col("__set").isNull()
    first = F.col("key").eqNullSafe(F.col("component.key")) & (F.col("mark") == F.col("component.mark"))
    return rows.select(
        "key", "mark", "n_shingles", F.when(alone, F.col("key")).otherwise(F.col("component.key")).alias("component"), (alone | first).alias("first"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row.

    Rows link when their shingle sets have a Jaccard similarity of ``percent``
    hundredths or more. ``component_id`` is the smallest key of the component,
    ``kept`` whether it is the row's own.
    """
    component = F.col("component")
    return _components(df, key, text, words, percent).select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``df`` with one row of each group of near duplicates: the one with the smallest key.

    Among texts that repeat that key, the one with the smallest hash; null keys come last.
    Rows that repeat a key and its text count as one; texts without words all stay.
    """
    found = Folder(df, "minhash-kept").put(_components(df, key, text, words, percent), "found")
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__mark"))

    def marks(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("key").alias("__key"), F.col("mark").alias("__mark")).distinct()

    left = df.join(marks(found.where(~F.col("first"))), same, "left_anti")
    again = found.where("n_shingles > 0").groupBy("key", "mark").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    if again.isEmpty():
        return left
    return left.join(marks(again), same, "left_anti").union(left.join(marks(again), same, "left_semi").dropDuplicates([key, text]))
