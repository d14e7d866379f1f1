"""Repair of conversations against all edit sequences, on long conversations and on odd rows."""

import hashlib
import itertools
import random
import re

import pytest

from optiontide.llm import repair as R

WELL = re.compile(r"(s?(ua)+)?\Z")


def brute(codes):
    """Least (cost, audit) over all edits, with up to two insertions at each place."""
    inserts = ["", "u", "a", "ua", "au", "uu", "aa"]
    best = None
    rows = []
    for c in codes:
        options = [(4, "D", "")]
        if c != "x":
            more = 3 * c.isupper()
            options += [(more, "K", c.lower()), (3 + more, "R", "u"), (3 + more, "R", "a")]
        rows.append(options)
    for edits in itertools.product(*rows):
        for gaps in itertools.product(inserts, repeat=len(codes) + 1):
            roles, audit, cost = gaps[0], "I" * len(gaps[0]), 3 * len(gaps[0])
            for (c, letter, role), gap in zip(edits, gaps[1:], strict=True):
                roles, audit, cost = roles + role + gap, audit + letter + "I" * len(gap), cost + c + 3 * len(gap)
            if WELL.match(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@pytest.mark.parametrize("length", [1, 2, 3])
def test_cells_against_all_edits(length):
    alphabet = "suaoxUAS"
    cases = list(itertools.product(alphabet, repeat=length))
    if length == 3:
        cases = random.Random(5).sample(cases, 25)
    for case in cases:
        assert R.best_whole(R.span_cell("".join(case))) == brute(case), case


def walked(codes):
    """Least (cost, audit) from left to right over four states; insertions one at a time."""
    state = {"": (0, ""), "s": None, "u": None, "a": None}

    def closed(now):
        for _ in range(3):
            for target, sources in (("u", ("", "s", "a")), ("a", ("u",))):
                found = [(now[x][0] + 3, now[x][1] + "I") for x in sources if now[x]]
                now[target] = min([x for x in [now[target], *found] if x], default=None)
        return now

    for c in codes:
        state, new = closed(state), {"": [], "s": [], "u": [], "a": []}
        for x, v in state.items():
            if v is None:
                continue
            new[x].append((v[0] + 4, v[1] + "D"))
            if c != "x":
                more = 3 * c.isupper()
                for target in {"": "su", "s": "u", "u": "a", "a": "u"}[x]:
                    if c.lower() == target:
                        new[target].append((v[0] + more, v[1] + "K"))
                    elif target != "s":
                        new[target].append((v[0] + 3 + more, v[1] + "R"))
        state = {x: min(v, default=None) for x, v in new.items()}
    state = closed(state)
    return min(x for x in (state[""], state["a"]) if x)


def test_any_bracketing_gives_the_same():
    rng = random.Random(3)
    for _ in range(60):
        codes = "".join(rng.choice("suaoxUASO") for _ in range(rng.randint(1, 60)))
        cells = [R.row_cell(c) for c in codes]
        while len(cells) > 1:
            i = rng.randrange(len(cells) - 1)
            cells[i : i + 2] = [R.joined(cells[i], cells[i + 1])]
        assert cells[0] == R.span_cell(codes)
        assert R.best_whole(cells[0]) == walked(codes)


ROLES = ["system", "user", "assistant", "tool", "", "User"]


def plain(rows):
    """Brute-force results: counts, cost, audit and digest of one conversation's rows."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        fault = "blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen else None
        if fault is None and not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            fault = "truncated"
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = walked(codes)
    lines, i, place = [], 0, None
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K" and place is None and rows[i][1][:1] == "s":
            place, wanted = 0, "system"
        else:
            place = (place or 0) + 1
            wanted = "user" if place % 2 else "assistant"
        if letter == "I":
            lines.append(f"{wanted}:")
        else:
            lines.append(f"{rows[i][1] if letter == 'K' else wanted}:{rows[i][2]}")
            i += 1
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def table(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?  ", "cut off", " \t", "", None, "a\nb.", "x" * 5000 + ".", "é. \n"]
    rows = []
    for conv in [1, 2, 3, None, *range(10, 40)]:
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice([*ROLES, "user", "assistant", None]), rng.choice(texts)))
    rows += [(7, t, ("user", "assistant")[t % 2], f"Turn {t % 40}.") for t in range(400)]  # long, with repeats
    rows += [(8, 3, "user", "Same.")] * 150
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("span", [4, 256])
def test_repair_against_plain_rows(spark, monkeypatch, span):
    monkeypatch.setattr(R, "SPAN", span)
    monkeypatch.setattr(R, "SHIFT", span.bit_length() - 1)
    rows = table(span)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS cost", "'x' AS audit", "2 AS number", "'y' AS part")  # names of results
    found = R.repair(df)
    digest = {r["conv"]: r["sha256"] for r in R.transcripts(found.rows).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    got = {
        r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], digest.get(r["conv_id"], nothing))
        for r in found.conversations.collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = plain([r[1:] for r in rows if r[0] == conv])
    assert got == want


def test_repair_of_nothing(spark):
    found = R.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.conversations.count() == 0 and found.rows.count() == 0 and R.transcripts(found.rows).count() == 0
