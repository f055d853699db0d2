"""Secrets in texts: base patterns, and strings whose sliding windows are too even for words.

Base spans are leftmost matches of a pattern for each kind that pass the kind's check. Further spans come from candidate
strings, the maximal runs of a character class's symbols that hold a window. A window of fixed width slides over a run; a
counter for each symbol and the sum of n log n over the counters change only by the symbol that enters and the one that
leaves, and the window's Shannon entropy is log(width) minus that sum over the width. The span goes from the first window
that reaches its class's entropy and has both digits and letters to the end of the last one. Runs that an allow-list
knows (identifiers in groups, words and numbers joined by signs, placeholders, rows of the keyboard, named digests) are
suppressed; base spans never are. A further span inside a base span or inside another one is dropped.

Everything is column expressions. The sums are integers of 2^20ths of a bit, so results don't depend on rounding.
Counters are kept as one character each of a short string, which an entering or leaving symbol overlays.

Defined cases: a null text is an empty text without spans; texts and runs of any length are read whole, in time that grows
with their length; repeated rows get equal results; of equal further spans the first class's stays; an empty table gives
no rows; columns that aren't asked for are not read, and kept columns may have any name but ``_text``, ``_base``, ``_spans``;
places count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.spans import bound, found, running

# Kinds in their order, and the base patterns. Possessive forms match the same texts as greedy ones here.
KINDS = ("assign", "access", "hex", "entropy")
LEAD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?"
PATTERNS = {
    "assign": LEAD + r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
LEAST_VALUE = 6
#: Parts of every keyword, in lower case; a text without any has no assignment.
KEYWORDS = ("passw", "secret", "token", "key")
#: Runs that any access key, hex key or candidate lies in.
LONG = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"

#: Runs that are base spans as a whole, so that nothing can be added in them.
WHOLE = r"^(?:[0-9a-f]{24,}+|AKIA[A-Z0-9]{16,}+)$"

DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
UNIT = 1 << 20
#: The sign of the count 0; counts up to a window's width are ASCII signs.
ZERO = 48


@dataclass(frozen=True)
class Class:
    """A character class: its symbols (digits first), the window's width and the least entropy in bits of a secret."""

    name: str
    symbols: str
    regex: str
    width: int
    bits: float

    @property
    def pattern(self) -> str:
        return rf"(?<!{self.regex}){self.regex}{{{self.width},}}+"

    @property
    def most(self) -> int:
        """The largest sum of n log n, in units, of a window that reaches the entropy."""
        return int(self.width * (log2(self.width) - self.bits) * UNIT)


CLASSES = (
    Class("hex", DIGITS + "abcdefABCDEF", "[0-9a-fA-F]", 24, 3.0),
    Class("upper", DIGITS + UPPER, "[A-Z0-9]", 20, 3.4),
    Class("base64", DIGITS + UPPER + UPPER.lower() + "+/_-", "[A-Za-z0-9+/_-]", 20, 3.8),
)

#: Runs that are no secrets.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[+/_-]*+(?:(?:[A-Za-z]{1,19}+|[0-9]{1,8}+)(?:[+/_-]++|$))++$",
    r"(?i)example|sample|placeholder|changeme|dummy|redacted|your[_-]",
    r"(?i)xxxxxx|000000|abcdefgh|12345678|qwertyui",
    r"^sha(?:1|256|384|512)[-_]",
)


def weight(n: int) -> int:
    """n log n in units."""
    return round(n * log2(n) * UNIT) if n else 0


def checked(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.char_length(F.regexp_replace(match, "^" + LEAD, "")) >= LEAST_VALUE
    return F.lit(True)  # the pattern has the length


SPAN = "array<struct<kind:int,start:int,end:int>>"


def base_spans(docs: DataFrame, text: Column) -> DataFrame:
    """The columns, ``_text``, ``_long`` (has a long run) and ``_base``: base spans (kind number, start, end)."""
    names = docs.columns
    step = docs.select(*names, F.coalesce(text, F.lit("")).alias("_text")).select(
        *names, "_text", F.inline(F.array(F.struct(F.col("_text").rlike(LONG).alias("_long"), F.lower("_text").alias("_lower")))))
    named = F.lit(False)
    for word in KEYWORDS:
        named = named | F.col("_lower").contains(word)
    gates = {"assign": named, "access": F.col("_long"), "hex": F.col("_long")}

    def spans(number: int, kind: str) -> Column:
        good = F.filter(found(F.col("_text"), PATTERNS[kind], gates[kind]), lambda x: checked(kind, x["match"]))
        return F.transform(good, lambda x: F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    every = F.concat(*[spans(i, k) for i, k in enumerate(KINDS) if k in PATTERNS])
    return step.select(*names, "_text", "_long", F.inline(F.array(F.struct(every.alias("_base")))))


def windows(run: Column, c: Class) -> Column:
    """The first start and the last end, within a run, of windows that reach the class's entropy; null ends if there are none.

    The window starts full of a sign that is no symbol, which leaves before any window is judged.
    """
    none = len(c.symbols) + 1
    grows = F.array(*[F.lit(weight(n + 1) - weight(n)) for n in range(c.width)])  # of the sum, from n to n + 1
    codes = F.transform(F.split(run, ""), lambda x: F.instr(F.lit(c.symbols), x))
    moves = bound(codes, lambda a: F.zip_with(
        a, F.slice(F.concat(F.array_repeat(F.lit(none), c.width), a), F.lit(1), F.size(a)),
        lambda enters, leaves: F.struct(enters.alias("enters"), leaves.alias("leaves"))))

    def count(s: Column, symbol: Column) -> Column:
        return F.ascii(F.substring(s["counts"], symbol, F.lit(1))) - ZERO

    def put(counts: Column, symbol: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + ZERO), symbol, F.lit(1))

    def digit(symbol: Column) -> Column:
        return (symbol <= 10).cast("int")

    def good(s: Column) -> Column:
        return (s["at"] >= c.width) & (s["sum"] <= c.most) & (s["digits"] > 0) & (s["digits"] < c.width)

    def first(s: Column) -> Column:
        return F.coalesce(s["first"], F.when(good(s), s["at"] - c.width))

    def last(s: Column) -> Column:
        return F.when(good(s), s["at"]).otherwise(s["last"])

    def step(s: Column, x: Column) -> Column:
        """Judge the window held, then slide it by a symbol."""
        enters, leaves = x["enters"], x["leaves"]
        more, less = count(s, enters), count(s, leaves)
        same = enters == leaves
        return F.struct(
            F.when(same, s["counts"]).otherwise(put(put(s["counts"], leaves, less - 1), enters, more + 1)).alias("counts"),
            F.when(same, s["sum"]).otherwise(s["sum"] + F.get(grows, more) - F.get(grows, less - 1)).alias("sum"),
            (s["digits"] + digit(enters) - digit(leaves)).alias("digits"),
            (s["at"] + 1).alias("at"), first(s).alias("first"), last(s).alias("last"))

    null = F.lit(None).cast("int")
    start = F.struct(
        F.lit(chr(ZERO) * len(c.symbols) + chr(ZERO + c.width)).alias("counts"), F.lit(weight(c.width)).alias("sum"), F.lit(0).alias("digits"),
        F.lit(0).alias("at"), null.alias("first"), null.alias("last"))
    return F.aggregate(moves, start, step, lambda s: F.struct(first(s).alias("first"), last(s).alias("last")))


def further_spans(with_base: DataFrame, allowed: tuple[str, ...] = ALLOWED, classes: tuple[Class, ...] = CLASSES) -> DataFrame:
    """Adds ``_further``: the spans of the windows, class by class."""

    def known(match: Column) -> Column:
        hit = match.rlike(WHOLE)
        for pattern in allowed:
            hit = hit | match.rlike(pattern)
        return hit

    def of_class(c: Class) -> Column:
        runs = F.filter(found(F.col("_text"), c.pattern, F.col("_long")), lambda x: ~known(x["match"]))
        spans = F.transform(runs, lambda x: bound(windows(x["match"], c), lambda w: F.struct(
            F.lit(KINDS.index("entropy")).alias("kind"), (x["start"] + w["first"]).alias("start"), (x["start"] + w["last"]).alias("end"))))
        return F.filter(spans, lambda x: x["start"].isNotNull())

    names = with_base.columns
    every = F.when(F.col("_long"), F.concat(*map(of_class, classes))).otherwise(F.array().cast(SPAN))
    return with_base.select(*names, F.inline(F.array(F.struct(every.alias("_further")))))


def with_spans(docs: DataFrame, keep: list[str], text: str = "text", allowed: tuple[str, ...] = ALLOWED,
               classes: tuple[Class, ...] = CLASSES) -> DataFrame:
    """The ``keep`` columns, ``_text``, ``_base`` and ``_spans`` of every document; spans (kind number, start, end) by start and kind."""
    masked = docs.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate([*keep, text])])
    marked = further_spans(base_spans(masked, F.col(f"_in{len(keep)}")), allowed, classes)
    order = lambda added: lambda x: F.struct(
        x["start"].alias("start"), F.lit(added).alias("added"), (-x["end"]).alias("before"), x["kind"].alias("kind"), x["end"].alias("end"))
    every = F.sort_array(F.concat(F.transform("_base", order(0)), F.transform("_further", order(1))))

    def outer(items: Column) -> Column:
        """Spans that reach past all before them; a base span always stays."""
        ends = F.concat(F.array(F.lit(0)), F.transform(items, lambda x: x["end"]))
        both = F.zip_with(items, F.slice(running(ends, F.lit(0), lambda a, b: F.greatest(a, b)), F.lit(1), F.size(items)), lambda x, reach: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), ((x["added"] == 0) | (x["end"] > reach)).alias("kept")))
        return F.transform(F.filter(both, lambda x: x["kept"]), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    kept = bound(every, outer)
    spans = F.when(F.size("_further") > 0, kept).otherwise(F.col("_base"))
    names = [F.col(f"_in{i}").alias(c) for i, c in enumerate(keep)]
    return marked.select(*names, "_text", *[by_start(c).alias(n) for n, c in (("_base", F.col("_base")), ("_spans", spans))])


def by_start(spans: Column) -> Column:
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return F.transform(ordered, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def spans_text(spans: str) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
