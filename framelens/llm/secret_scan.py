"""Secret scans: named patterns, and windows of high entropy inside candidate strings.

Only SQL functions. A candidate is a run of characters of one class. A window of ``window`` characters slides over
it; the counts of its characters are kept in an array and change by one for the character that enters and one for
that which leaves, and with them the sum of c * log2(c), so a step costs the same at any width and any place. The
entropy of the window is log2(w) - sum / w. The span of all windows at or above the class's threshold is reported,
unless the allow-list covers the candidate.

Everything is linear in the text but for lists that grow in a fold: those are built in blocks of ``BLOCK``. No pattern
repeats a group without a bound, or a long match would overflow the stack of Java's matcher.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, text_of

#: Pattern, the group whose length counts, the least length.
NAMED = {
    "assign": (r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", r"""^(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?""", 6),
    # The least lengths stand in the patterns: a run that is too short has no later start that is long enough.
    "access": (r"AKIA[A-Z0-9]{16,}", None, 20),
    "hex": (r"[0-9a-f]{24,}", None, 24),
}


@dataclass(frozen=True)
class EntropyClass:
    """Candidate runs of ``alphabet``: ``pattern`` finds them; each pattern of ``needs`` must match inside one."""

    kind: str
    alphabet: str
    pattern: str
    needs: tuple[str, ...]
    window: int
    bits: float


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A uniform draw of w characters of an alphabet of a has about log2(min(a, w)) less a fifth; prose stays far below.
ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", DIGITS + "abcdef", r"(?<![0-9A-Za-z])[0-9a-f]{24,}(?![0-9A-Za-z])", ("[0-9]", "[a-f]"), 24, 3.0),
    EntropyClass("entropy_upper", DIGITS + UPPER, r"(?<![0-9A-Za-z])[0-9A-Z]{20,}(?![0-9A-Za-z])", ("[0-9]", "[A-Z]"), 20, 3.4),
    EntropyClass("entropy_base64", DIGITS + LOWER + UPPER + "+/=_-", r"(?<![0-9A-Za-z+/=_-])[0-9A-Za-z+/=_-]{24,}(?![0-9A-Za-z+/=_-])", ("[0-9]", "[a-z]", "[A-Z]"), 24, 3.9),
)
#: Candidates that are not secrets: identifiers by form, dummies and alphabets by content.
ALLOW = (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", r"(?i)example|sample|dummy|placeholder|changeme|your[_-]", r"(?i)0123456789|abcdefghij|deadbeef", r"^(?=[A-Za-z])(?=[A-Za-z]*[/_-])(?![A-Za-z/_-]*[/_-]{2})[A-Za-z/_-]*[A-Za-z]$")

#: Matches whose places are added up in one go, and code points of a text that is cut.
BLOCK, TEXT_BLOCK = 512, 4096
SPAN = "array<struct<start:int,end:int,kind:string,rank:int>>"


def _ahead(values: Column, zero: int, joined: Callable[[Column, Column], Column]) -> Column:
    """For each integer of an array what ``joined`` makes of all before it, from ``zero``. It must be associative.

    A list that a fold appends to is copied at every step, so blocks are folded one by one and then their totals.
    """

    def scanned(numbers: Column) -> Column:
        state = F.struct(F.lit(zero).alias("now"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(numbers, state, lambda acc, x: F.struct(joined(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")))

    def blocked(numbers: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(numbers), F.lit(BLOCK))
        return F.transform(starts, lambda at: scanned(F.slice(numbers, at, F.lit(BLOCK))))

    def lifted(blocks: Column) -> Column:
        bases = scanned(F.transform(blocks, lambda b: b["now"]))["out"]
        return F.flatten(F.zip_with(blocks, bases, lambda b, base: F.transform(b["out"], lambda x: joined(base, x))))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(bound(values, lambda numbers: bound(blocked(numbers), lifted)))


def _matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as structs (start, value), in code points.

    The text is split at the matches; pieces and matches alternate, so their lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, v: F.struct(p.alias("gap"), v.alias("value")))

    def placed(pairs: Column) -> Column:
        before = _ahead(F.transform(pairs, lambda p: p["gap"] + F.length(p["value"])), 0, lambda a, b: a + b)
        return F.zip_with(pairs, before, lambda p, at: F.struct((at + p["gap"]).alias("start"), p["value"].alias("value")))

    return F.when(text.rlike(pattern), bound(pairs, placed)).otherwise(F.array().cast("array<struct<start:int,value:string>>"))


def _named(text: Column, rank: int, kind: str, pattern: str, lead: str | None, least: int) -> Column:
    def counted(value: Column) -> Column:
        return F.length(F.regexp_replace(value, lead, "") if lead else value)

    long = F.filter(_matches(text, pattern), lambda m: counted(m["value"]) >= least)
    return F.transform(long, lambda m: _span(m["start"], m["start"] + F.length(m["value"]), kind, rank))


def _span(start: Column, end: Column, kind: str, rank: int) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"))


def named_spans(text: Column) -> Column:
    """The spans of the named patterns, sorted by start, then by kind as listed."""
    return _sorted(F.concat(*[_named(text, rank, kind, *rule) for rank, (kind, rule) in enumerate(NAMED.items())]))


def _sorted(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["rank"].alias("rank"))).cast(SPAN)


def entropy_extent(value: Column, cls: EntropyClass) -> Column:
    """(first, last) places of the windows of ``value`` whose entropy reaches the threshold; last is -1 if none does."""
    size, w = len(cls.alphabet), cls.window
    weight = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(w + 2)])
    bound_ = F.lit(w * (math.log2(w) - cls.bits) + 1e-9)
    state = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    of = lambda counts, code: F.get(counts, code)

    def step(acc: Column, codes: Column) -> Column:
        enters, leaves = codes["enters"], codes["leaves"]
        counts = F.transform(acc["counts"], lambda c, i: c + F.when(i == enters, 1).otherwise(0) - F.when(i == leaves, 1).otherwise(0))
        # The character that leaves is counted after the other has entered.
        came = of(acc["counts"], enters)
        went = of(acc["counts"], leaves) + F.when(leaves == enters, 1).otherwise(0)
        total = acc["sum"] + F.get(weight, came + 1) - F.get(weight, came) + F.when(leaves < 0, 0.0).otherwise(F.get(weight, went - 1) - F.get(weight, went))
        return F.struct(counts.alias("counts"), total.alias("sum"), acc["at"].alias("at"), acc["first"].alias("first"), acc["last"].alias("last"))

    def judged(acc: Column) -> Column:
        at = acc["at"]
        high = (at >= w - 1) & (acc["sum"] <= bound_)
        first = F.when(high & (acc["first"] < 0), at - w + 1).otherwise(acc["first"])
        return F.struct(acc["counts"].alias("counts"), acc["sum"].alias("sum"), (at + 1).alias("at"), first.alias("first"), F.when(high, at).otherwise(acc["last"]).alias("last"))

    codes = F.transform(F.slice(F.split(value, ""), 1, F.length(value)), lambda c: F.instr(F.lit(cls.alphabet), c) - 1)

    def folded(codes: Column) -> Column:
        left = F.slice(F.concat(F.array_repeat(F.lit(-1), w), codes), 1, F.size(codes))
        moves = F.zip_with(codes, left, lambda e, l: F.struct(e.alias("enters"), l.alias("leaves")))
        return F.aggregate(moves, state, lambda acc, x: bound(step(acc, x), judged), lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    return bound(codes, folded)


def _high(text: Column, rank: int, cls: EntropyClass, allow: tuple[str, ...]) -> Column:
    def suspect(m: Column) -> Column:
        allowed = reduce(lambda a, b: a | b, [m["value"].rlike(p) for p in allow], F.lit(False))
        return reduce(lambda a, b: a & b, [m["value"].rlike(p) for p in cls.needs]) & ~allowed

    extents = F.transform(F.filter(_matches(text, cls.pattern), suspect), lambda m: F.struct(m["start"].alias("start"), entropy_extent(m["value"], cls).alias("x")))
    return F.transform(F.filter(extents, lambda m: m["x"]["last"] >= 0), lambda m: _span(m["start"] + m["x"]["first"], m["start"] + m["x"]["last"] + 1, cls.kind, rank))


def entropy_spans(text: Column, classes: tuple[EntropyClass, ...] = ENTROPY_CLASSES, allow: tuple[str, ...] = ALLOW) -> Column:
    """The spans of high entropy of each class, in the order of the classes."""
    return F.concat(*[_high(text, len(NAMED) + i, cls, allow) for i, cls in enumerate(classes)])


def scan_secrets(docs: DataFrame, text_col: str = "text", into: str = "secrets", classes: tuple[EntropyClass, ...] = ENTROPY_CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Adds a struct ``into`` with ``base``, the spans of the named patterns, and ``spans``, all spans.

    Spans are (start, end, kind, rank) in code points with an exclusive end, by start and then by kind. Entropy spans
    come on top of the base ones, which the allow-list never touches. A null or empty text has no spans; a very long
    one is scanned whole, in time linear in its length and memory of about a hundred bytes a character of its longest
    candidate. Rows are scanned one by one: repeats, ties and other columns make no difference; an empty table gives
    none, and a column called ``into`` is replaced.
    """
    text = text_of(text_col)
    both = lambda base: F.struct(base.alias("base"), _sorted(F.concat(base, entropy_spans(text, classes, allow))).alias("spans"))
    return docs.withColumn(into, bound(named_spans(text), both))


def span_text(spans: Column) -> Column:
    """kind:start:end for each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """Replaces every maximal run of overlapping or touching spans by ``mark``. The spans are sorted by start.

    The text is cut into blocks first, so taking a piece of it doesn't walk there from its start.
    """

    def without(spans: Column) -> Column:
        ended = _ahead(F.transform(spans, lambda s: s["end"]), -1, F.greatest)
        marked = F.zip_with(spans, ended, lambda s, before: F.struct(before.alias("before"), s["start"].alias("start")))
        fresh = F.filter(marked, lambda m: m["start"] > m["before"])
        end = F.array_max(F.transform(spans, lambda s: s["end"]))

        def told(blocks: Column) -> Column:
            def piece(start: Column, end: Column | None = None) -> Column:
                first = F.floor(start / TEXT_BLOCK).cast("int")
                if end is None:
                    near = F.slice(blocks, first + 1, F.greatest(F.lit(0), F.size(blocks) - first))
                    return F.substring(F.array_join(near, ""), start - first * TEXT_BLOCK + 1, F.lit(1 << 30))
                near = F.slice(blocks, first + 1, F.floor(end / TEXT_BLOCK).cast("int") - first + 1)
                return F.substring(F.array_join(near, ""), start - first * TEXT_BLOCK + 1, end - start)

            return F.concat(F.array_join(F.transform(fresh, lambda m: F.concat(piece(F.greatest(m["before"], F.lit(0)), m["start"]), F.lit(mark))), ""), piece(end))

        return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0)), told)

    return F.when(F.size(spans) > 0, bound(spans, without)).otherwise(text)
