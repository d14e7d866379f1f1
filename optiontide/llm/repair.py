"""Repair of conversation structure by weighted CYK parsing of intervals.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.
Edits are Keep (0), Rerole to user or assistant (3), Delete (4, the only one for
blank and duplicate rows) and Insert of a user or assistant row without text
(3); a truncated row that stays costs 3 more. The repair is the least cost, among
equals the ASCII-least string of edit initials (the audit).

The grammar is in Chomsky normal form. A nonterminal names the pieces of a well-formed string by their first and
last role: nothing, u..u, u..a, a..u, a..a, and s alone, s..u, s..a. Binary rules join neighbouring pieces
(u..a from u..u and a..a, and so on); a row derives the pieces that its edits give; nothing derives the pieces that insertions give
(their closure: one or two rows, more are never cheaper). A cell holds, per nonterminal, the
least (cost, audit) of an interval of rows. Every factor of a well-formed string
has a nonterminal, so whatever an interval derives, its two halves derive too: one split point gives the minimum over all of
them. Intervals are therefore combined bottom-up by doubling length, in proportion to the rows. Two audits of one cell with one cost are
never a prefix of each other (they edit the same rows, and an insertion costs), so the least of parts is a part of the least.

On Spark, rows are sorted by ranges and numbered without gaps, equal rows on their own, so a conversation of any length is spread out.
Cells of up to ``SPAN`` rows are built in tasks; cells of a conversation are then combined up to ``SPAN`` at a time, level by
level. An audit is one value of its conversation, as the result asks for it.

Defined cases: null roles and texts read as one space; null conversations are one conversation; null turns come first, rows of one
turn are ordered by role, then text; repeated rows are duplicates of the first. Roles with another initial can't be kept. An empty
table gives empty results; texts are read whole; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from optiontide.llm.common import Folder

#: Rows of a leaf interval, and cells combined at once.
SPAN = 256
SHIFT = SPAN.bit_length() - 1
COST = {"R": 3, "D": 4, "I": 3, "truncated": 3}

NOTHING, UU, UA, AU, AA, S, SU, SA = range(8)
# Piece, left part, right part.
RULES = (
    (UU, UU, AU), (UU, UA, UU), (UA, UA, UA), (UA, UU, AA), (AU, AA, UU), (AU, AU, AU), (AA, AA, UA), (AA, AU, AA),
    (SU, S, UU), (SU, SA, UU), (SU, SU, AU), (SA, S, UA), (SA, SA, UA), (SA, SU, AA),
    (NOTHING, NOTHING, NOTHING), *[(x, NOTHING, x) for x in range(1, 8)], *[(x, x, NOTHING) for x in range(1, 8)],
)
WHOLE = (NOTHING, UA, SA)
#: Pieces that insertions alone give.
INSERTED = ((0, ""), (3, "I"), (6, "II"), (6, "II"), (3, "I"), None, None, None)

BLANK = r"[\x20\x09-\x0D]"
Cell = tuple[tuple[int, str] | None, ...]
CELL = "array<struct<cost:long,audit:string>>"


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring intervals taken together."""
    out: list[tuple[int, str] | None] = [None] * 8
    for x, y, z in RULES:
        a, b = left[y], right[z]
        if a is not None and b is not None:
            found = (a[0] + b[0], a[1] + b[1])
            if out[x] is None or found < out[x]:
                out[x] = found
    return tuple(out)


@lru_cache(maxsize=None)
def row_cell(code: str) -> Cell:
    """One row with the insertions around it. ``code``: initial of the role (o: another), capital if truncated, x if it must go."""
    out: list[tuple[int, str] | None] = [None] * 8
    out[NOTHING] = (COST["D"], "D")
    if code != "x":
        more, role = COST["truncated"] * code.isupper(), code.lower()
        for x, initial in ((UU, "u"), (AA, "a")):
            out[x] = (more, "K") if role == initial else (COST["R"] + more, "R")
        if role == "s":
            out[S] = (more, "K")
    return joined(joined(INSERTED, tuple(out)), INSERTED)


def doubled(cells: list[Cell]) -> Cell:
    """Neighbouring intervals joined two by two, up to the whole."""
    while len(cells) > 1:
        cells = [joined(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


@lru_cache(maxsize=1 << 14)
def _short_cell(codes: str) -> Cell:
    return doubled([row_cell(c) for c in codes])


def span_cell(codes: str) -> Cell:
    """The cell of a string of row codes; pieces of 8 rows are remembered, as many of them are alike."""
    return doubled([_short_cell(codes[i : i + 8]) for i in range(0, len(codes), 8)])


def best_whole(cell: Cell) -> tuple[int, str]:
    return min(cell[x] for x in WHOLE if cell[x] is not None)


def illegal_pairs(initials: str) -> int:
    """Neighbours that are not su, ua or au."""
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


@dataclass
class Repair:
    """``conversations``: counts, cost and audit of each; ``rows``: repaired rows with ``number`` and ``part`` as their order."""

    conversations: DataFrame
    rows: DataFrame


def _plain(cell: Cell) -> list[dict | None]:
    return [None if x is None else {"cost": x[0], "audit": x[1]} for x in cell]


CELL_SCHEMA = f"conv {{kind}}, block long, base long, first string, last string, illegal long, cell {CELL}"
CELL_ARROW = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _emit(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
    """Conversation and block of a batch with base, first and last initial, illegal pairs and cell."""
    base, first, last, illegal, cells = zip(*found, strict=True) if found else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(base, pa.int64()), pa.array(first, pa.string()), pa.array(last, pa.string()),
         pa.array(illegal, pa.int64()), pa.array([_plain(c) for c in cells], CELL_ARROW)],
        ["conv", "block", "base", "first", "last", "illegal", "cell"])


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, block, base, initials, codes to the cell of each block."""
    for whole in batches:
        for at in range(0, whole.num_rows, SPAN):
            batch = whole.slice(at, SPAN)
            found = [
                (base, initials[0], initials[-1], illegal_pairs(initials), span_cell(codes))
                for base, initials, codes in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)], strict=True)]
            yield _emit(batch, found)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, block and the list of cells inside it, in order, to one cell."""
    for whole in batches:
        for at in range(whole.num_rows):
            batch = whole.slice(at, 1)
            parts = batch.column(2).to_pylist()[0]
            cells = [tuple(None if x is None else (x["cost"], x["audit"]) for x in p["cell"]) for p in parts]
            crossing = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(parts, parts[1:], strict=False))
            yield _emit(batch, [(parts[0]["base"], parts[0]["first"], parts[-1]["last"], sum(p["illegal"] for p in parts) + crossing, doubled(cells))])


def row_edits(audit: str, system: bool) -> Iterator[tuple[list[str], str, str, list[str]]]:
    """Row by row: roles inserted before it, edit, role that its place asks for, roles inserted after the last row."""
    emitted, waiting = 0, []

    def role() -> str:
        k = emitted - system
        return "system" if k < 0 else ("user", "assistant")[k % 2]

    held: tuple[list[str], str, str] | None = None
    for letter in audit:
        if letter == "I":
            waiting.append(role())
            emitted += 1
            continue
        if held is not None:
            yield (*held, [])
        held = (waiting, letter, "" if letter == "D" else role())
        emitted += letter != "D"
        waiting = []
    if held is not None:
        yield (*held, waiting)


EDIT_SCHEMA = "number long, before array<string>, edit string, place string, after array<string>"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """base, audit, whether the repaired conversation begins with a system row: one row per row of the conversation."""
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        number, before, edit, place, after = zip(*rows, strict=True)
        texts = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(before, texts), pa.array(edit, pa.string()), pa.array(place, pa.string()), pa.array(after, texts)],
            ["number", "before", "edit", "place", "after"])

    rows: list[tuple] = []
    for batch in batches:
        for base, audit, system in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            for k, edit in enumerate(row_edits(audit, system)):
                rows.append((base + k, *edit))
                if len(rows) == 8192:
                    yield batch_of(rows)
                    rows = []
    if rows:
        yield batch_of(rows)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest repair of every conversation of ``df``.

    ``conversations``: conv, gaps, blank, duplicate, truncated, illegal, cost,
    audit, n_rows. ``rows``: conv, number (of a row before the repair, over all conversations),
    part (from 0, of what stands in that row's place: rows inserted before it, itself, rows inserted after it), role, text.
    """
    folder = Folder(df, "repair")
    kind = df.schema[conv].dataType.simpleString()
    fixed = folder.put(df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("row")), "fixed")

    # Sorted by ranges; the row number of the table as last key lets equal rows fall into several ranges.
    order = ["conv", "turn", "role", "text", "row"]
    place = folder.put(
        fixed.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("at")), "sorted")
    chunk, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    starts = place.groupBy(chunk.alias("chunk")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = folder.put(starts.select("chunk", "start"), "starts")  # a row for each partition
    numbered = place.join(F.broadcast(starts), chunk == F.col("chunk")).withColumn("number", F.col("start") + inside)

    full = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    light = folder.put(numbered.select(
        "conv", "turn", "number", F.substring("role", 1, 1).alias("initial"), full.alias("full"),
        F.col("text").rlike(rf"[.!?]{BLANK}*\z").alias("ended"), F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")), 256).alias("same")), "light")
    firsts = light.where("full").groupBy("conv", "same").agg(F.min("number").alias("first_number"))
    flagged = light.join(firsts.select("first_number"), F.col("number") == F.col("first_number"), "left").select(
        "conv", "number", "initial", (~F.col("full")).alias("blank"), (F.col("full") & F.col("first_number").isNull()).alias("duplicate"),
        (F.col("first_number").isNotNull() & ~F.col("ended")).alias("truncated"))
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("o"))
    code = F.when(F.col("blank") | F.col("duplicate"), F.lit("x")).when(F.col("truncated"), F.upper(letter)).otherwise(letter)

    def count(name: str):
        return F.sum(F.col(name).cast("long")).alias(name)

    blocks = flagged.groupBy("conv", F.shiftright("number", SHIFT).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("number", letter.alias("letter"), code.alias("code")))).alias("rows"),  # up to SPAN
        count("blank"), count("duplicate"), count("truncated"))
    blocks = folder.put(blocks.select(
        "conv", "block", F.col("rows")[0]["number"].alias("base"), F.array_join(F.col("rows.letter"), "").alias("initials"),
        F.array_join(F.col("rows.code"), "").alias("codes"), "blank", "duplicate", "truncated"), "blocks")
    cells = folder.put(
        blocks.select("conv", "block", "base", "initials", "codes").mapInArrow(_leaves, CELL_SCHEMA.format(kind=kind)), "cells-0")
    for level in range(1, 64):
        most = cells.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        up = F.shiftright("block", SHIFT) if most > SPAN else F.lit(0).cast("long")
        grouped = cells.groupBy("conv", up.alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("base", "first", "last", "illegal", "cell"))).alias("parts"))  # up to SPAN, bases differ
        cells = folder.put(grouped.mapInArrow(_combined, CELL_SCHEMA.format(kind=kind)), f"cells-{level}")

    whole = [F.col("cell")[x] for x in WHOLE]
    best = F.array_min(F.filter(F.array(*[
        F.when(w.isNotNull(), F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"), F.lit(x == SA).alias("system"))) for w, x in zip(whole, WHOLE, strict=True)
    ]), lambda w: w.isNotNull()))
    solved = folder.put(cells.select("conv", "base", "illegal", best.alias("best")).select("conv", "base", "illegal", "best.*"), "solved")
    counts = blocks.groupBy("conv").agg(
        F.sum(F.length("codes")).cast("long").alias("n_rows"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    turns = light.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))

    def with_(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv", "__conv")
        return left.join(right, F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")

    conversations = with_(with_(solved, counts), turns).select(
        F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "n_rows")

    edits = solved.select("base", "audit", "system").mapInArrow(_edits, EDIT_SCHEMA).withColumnRenamed("number", "edited")
    empty = F.array().cast("array<struct<role:string,text:string>>")

    def added(names: str):
        return F.transform(names, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    own = F.when(F.col("edit") == "D", empty).otherwise(F.array(F.struct(
        F.when(F.col("edit") == "R", F.col("place")).otherwise(F.col("role")).alias("role"), F.col("text").alias("text"))))
    rows = numbered.select("conv", "number", "role", "text").join(edits, F.col("number") == F.col("edited")).select(
        F.col("conv").alias(conv), "number", F.posexplode(F.concat(added("before"), own, added("after"))).alias("part", "x"))
    return Repair(conversations, rows.select(conv, "number", "part", "x.role", "x.text"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key and line in order, rows of a key next to each other: SHA-256 of each key's lines joined by newlines, read in a stream."""
    now, running = None, None
    for batch in batches:
        keys, lines, done = batch.column(0), batch.column(1), []
        for key, line in zip(keys.to_pylist(), lines.to_pylist(), strict=True):
            if running is not None and key == now:
                running.update(b"\n")
            else:
                if running is not None:
                    done.append((now, running.hexdigest()))
                now, running = key, hashlib.sha256()
            running.update(line.encode("utf-8", "surrogatepass"))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], keys.type), pa.array([h for _, h in done], pa.string())], ["conv", "sha256"])
        kind = keys.type
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([running.hexdigest()], pa.string())], ["conv", "sha256"])


def transcripts(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv, sha256 of ``role:text`` of a conversation's repaired rows, joined by newlines.

    The digest of a conversation is one sequence of bytes; a task reads it row by row and holds none of it.
    """
    kind = rows.schema[conv].dataType.simpleString()
    lines = rows.select(F.col(conv).alias("conv"), "number", "part", F.concat_ws(":", "role", "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "number", "part").select("conv", "line")
    return lines.mapInArrow(_digests, f"conv {kind}, sha256 string")
