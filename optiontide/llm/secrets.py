"""Secret scans with built-in functions only.

Three fixed patterns give base spans. Beside them, candidate strings (runs of
key characters with a digit) are searched by a window that slides one
character at a time; the Shannon entropy of the window is kept up by
incremental counts and compared with the limit of the string's character
class. Values on the allow list give no entropy span; base spans always stay.

Null and empty texts have no spans. Texts are read whole; positions are code
points, ends exclusive. Repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optiontide.llm.common import without

# Kind, pattern, group that must have a least length, that length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # runs are maximal, so the least length may stand in the pattern
)
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Bits of a symbol's count in the window, and symbols whose counts share a number.
BITS, PACKED = 5, 12
#: Bits a window must reach, by class.
LIMITS = {"entropy_hex": 3.05, "entropy_base64": 3.75}
#: Values that are no secrets: plain numbers, record ids, and words joined by dashes or slashes.
ALLOW = (r"^[0-9+/_=-]+$", r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$", r"^(?:[A-Za-z]+|[0-9]+)(?:[/_=-]+(?:[A-Za-z]+|[0-9]+))+$")

#: Code points of a text that are redacted at once.
PIECE = 1024

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
UNIT = 1 << 20


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine) -> Column:
    """Every value combined with all before it, by doubling distances: as many rounds as the length has binary digits."""
    def step(done, k):
        far = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(done, lambda v, i: F.when(i >= far, combine(v, F.get(done, i - far))).otherwise(v))

    def rounds(n):
        return F.when(n > 1, F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    return let(values, lambda v: F.aggregate(rounds(F.size(v)), v, step))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with places: array of (start, end, value of ``group``).

    The lengths of the matches and of the pieces between them, summed up, give the places; both come from the same
    pattern, whose matches are never empty.
    """
    hits = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))

    def placed(found):
        ends = running(F.transform(found, lambda x: F.length(x["gap"]) + F.length(x["hit"])), lambda a, b: a + b)
        return let(ends, lambda e: F.transform(found, lambda x, i: F.struct(
            (F.get(e, i) - F.length(x["hit"])).alias("start"), F.get(e, i).alias("end"), x["part"].alias("value"))))

    found = let(F.filter(hits, lambda x: x["hit"].isNotNull()), placed)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _weight(c: int) -> int:
    """c log2 c in whole units, so that sums have no rounding of their own."""
    return round(UNIT * c * math.log2(c)) if c else 0


def most_entropy(value: Column) -> Column:
    """Units of c log2 c summed over the characters of the window with the highest entropy; least is best.

    The window's counts are packed, ``BITS`` bits a symbol, ``PACKED`` symbols a number. It fills up character by character; then
    each step changes the counts of the symbol that goes and of the one that comes.
    """
    change = F.array(*[F.lit(_weight(c + 1) - _weight(c)).cast("long") for c in range(WINDOW + 1)])
    codes = F.transform(F.split(value, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    none = F.array(*[F.lit(0).cast("long")] * -(-len(ALPHABET) // PACKED))

    def place(code):
        return F.struct(F.floor(code / PACKED).cast("int").alias("word"), ((code % PACKED) * BITS).alias("bit"))

    def count(counts, at):
        return F.call_function("shiftright", F.get(counts, at["word"]), at["bit"]).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def added(counts, at, sign):
        return F.transform(counts, lambda c, k: F.when(k == at["word"], c + sign * F.call_function("shiftleft", F.lit(1).cast("long"), at["bit"])).otherwise(c))

    def slide(places):
        def come(state, i):
            new = F.get(places, i)
            total = state["sum"] + F.get(change, count(state["counts"], new))
            return F.struct(added(state["counts"], new, 1).alias("counts"), total.alias("sum"))

        def go(state, i):
            old = F.get(places, i - WINDOW)
            total = state["sum"] - F.get(change, count(state["counts"], old) - 1)
            return F.when(i < WINDOW, state).otherwise(F.struct(added(state["counts"], old, -1).alias("counts"), total.alias("sum")))

        def step(state, i):
            moved = let(go(state["window"], i), lambda w: come(w, i))
            return let(moved, lambda w: F.struct(
                w.alias("window"), F.when(i < WINDOW - 1, state["best"]).otherwise(F.least(state["best"], w["sum"])).alias("best")))

        start = F.struct(F.struct(none.alias("counts"), F.lit(0).cast("long").alias("sum")).alias("window"), F.lit((1 << 63) - 1).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), start, step, lambda s: s["best"])

    return let(F.transform(codes, place), slide)


def entropy_limit(kind: str) -> int:
    """The highest sum of c log2 c at which a window of the class counts as secret."""
    return math.floor(UNIT * WINDOW * (math.log2(WINDOW) - LIMITS[kind]))


def _base(found: Column, rank: int, kind: str, least: int) -> Column:
    return F.transform(F.filter(found, lambda x: F.length(x["value"]) >= least), lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value")))


def secret_spans(text: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """All spans of a text, by start, then kind as listed: array of (start, rank, end, kind, value)."""
    text = F.coalesce(text, F.lit(""))
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        parts.append(_base(matches(text, pattern, group), rank, kind, least))

    def suspicious(x):
        listed = F.lit(False)
        for pattern in allow:
            listed = listed | x["value"].rlike(pattern)
        return x["value"].rlike("[0-9]") & ~listed

    def classed(x):
        is_hex = x["value"].rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        limit = F.when(is_hex, F.lit(entropy_limit("entropy_hex"))).otherwise(F.lit(entropy_limit("entropy_base64")))
        return F.struct(
            x["start"].alias("start"), F.when(is_hex, F.lit(3)).otherwise(F.lit(4)).alias("rank"), x["end"].alias("end"),
            F.when(most_entropy(x["value"]) <= limit, F.when(is_hex, F.lit("entropy_hex")).otherwise(F.lit("entropy_base64"))).alias("kind"),
            x["value"].alias("value"))

    scanned = F.transform(F.filter(matches(text, CANDIDATE), suspicious), classed)
    parts.append(F.filter(scanned, lambda x: x["kind"].isNotNull()))
    return F.array_sort(F.concat(*[p.cast(SPAN) for p in parts]))


def find_secrets(df: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``df`` with ``secrets``, the spans of each text; a column of that name is replaced."""
    return without(df, "secrets").withColumn("secrets", secret_spans(F.col(text), allow))


def listing(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def _first(values: Column, bound: Column) -> Column:
    """How many of the rising ``values`` are not above ``bound``: a binary search."""
    digits = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))

    def step(below, k):
        far = F.call_function("shiftleft", F.lit(1), k)
        return F.when(F.get(values, below + far - 1) <= bound, below + far).otherwise(below)

    return F.aggregate(F.reverse(digits), F.lit(0), step)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets.

    The text is read in pieces of ``PIECE`` code points, each with the spans that touch it, so the work grows with text and spans.
    """
    def joined(spans):
        # Where the spans up to each one reach; a span that begins there or later begins a cut, up to where the next cut's spans before it reach.
        reach = running(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
        return let(reach, lambda r: F.filter(
            F.transform(spans, lambda x, i: F.struct(
                x["start"].alias("start"), F.when((i == 0) | (x["start"] >= F.get(r, i - 1)), x["kind"]).alias("kind"), F.get(r, i - 1).alias("before"))),
            lambda x: x["kind"].isNotNull()))

    def cut(cuts, last):
        """Ends of the cuts: where the spans before the next cut reach; the last one's is where all reach."""
        return F.transform(cuts, lambda x, i: F.coalesce(F.get(cuts, i + 1)["before"], last))

    def piece_of(cuts, starts, ends):
        def one(piece, p):
            begin = p * PIECE
            stop = begin + F.length(piece)
            low, high = _first(ends, begin), _first(starts, stop - 1)

            def kept(j):
                from_ = F.greatest(F.coalesce(F.get(ends, j - 1), F.lit(0)), begin)
                own = F.get(cuts, j)
                text = F.substr(piece, from_ - begin + 1, F.greatest(own["start"] - from_, F.lit(0)))
                return F.concat(text, F.when(own["start"] >= begin, F.concat(F.lit("["), own["kind"], F.lit("]"))).otherwise(F.lit("")))

            def parts(low, high):
                inner = F.when(high > low, F.transform(F.sequence(low, high - 1), kept)).otherwise(F.array().cast("array<string>"))
                from_ = F.greatest(F.coalesce(F.get(ends, high - 1), F.lit(0)), begin)
                rest = F.when(from_ < stop, F.substr(piece, from_ - begin + 1, stop - from_)).otherwise(F.lit(""))
                return F.concat(F.array_join(inner, ""), rest)

            return let(F.struct(low.alias("low"), high.alias("high")), lambda b: parts(b["low"], b["high"]))

        return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), one), "")

    def whole(spans):
        last = F.array_max(F.transform(spans, lambda x: x["end"]))
        return let(joined(spans), lambda cuts: let(
            F.struct(F.transform(cuts, lambda x: x["start"]).alias("starts"), cut(cuts, last).alias("ends")),
            lambda b: piece_of(cuts, b["starts"], b["ends"])))

    return F.when(F.size(spans) > 0, let(spans, whole)).otherwise(text)
