"""Personal data in texts: base patterns, and further spans chosen by boosted trees.

Base spans are leftmost matches of a pattern for each kind that pass the kind's check. High-recall generators then
propose further, overlapping spans (every run of digits and separators as a card, an address and a phone, and every part
of it between separators that has a kind's digits; every ``name@host`` and ``name at host`` form as an email). A candidate has format and context features with few values each. Trees are boosted
on the table of feature cells of the whole corpus, counted by whether the candidate is a base span, and each kind's
threshold is the least score at which cells above it are base spans often enough. An email's features are those that
addresses with a sign and spelt ones share; spelt in full (``(at)``, ``dot``) they are unlabelled and not learned from, while
words with `` at `` and plain dots, as prose has them, count as no base spans. Base spans stay; of the chosen candidates
that overlap none of them the best are added first, of equal ones the leftmost.

Everything is column expressions; only the cell counts, bounded by the features' values, reach the driver. Matches get
their places from the lengths of the matches and of the texts between them, in one pass.

Defined cases: a null text is an empty text without spans (redaction leaves it null); texts of any length are read whole;
repeated rows get equal results; ties between candidates go to the first kind; without base spans nothing is learned
and nothing is added; an empty table gives no rows; places count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Masked
from tidemark.llm.spans import bound, cut, found, pieces, running

# Kinds in their order, and the base patterns. Possessive forms match the same texts as greedy ones here,
# and a start inside a run that already failed is skipped, so long runs cost linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
ADDRESS = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
#: Generators of candidates. ``WRITTEN`` has the addresses with a sign or spelt; ``SPELT`` those with spaces beside a dot, too.
RUN = r"[0-9](?:[0-9\x20().-]*[0-9])?"
DOT = r"(?:\.|\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?)"
WRITTEN = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:(?:@|\x20?(?:\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:" + DOT + r"[A-Za-z0-9-]++)*+"
    r"|\x20at\x20[A-Za-z0-9-]++(?:" + DOT + r"[A-Za-z0-9-]++)++)")
SPELT = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]++)++"
CUES = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|address",
    "card": r"(?i)card|visa|credit|payment",
    "phone": r"(?i)phone|\btel|call|mobile|fax",
}
LEAST_DIGITS, MOST_DIGITS = 7, 19
#: Digits that a part of a run needs for each kind.
DIGITS = {"ip": (4, 12), "card": (12, 19), "phone": (8, 15)}
DOTTED = r"^[0-9]+(?:\.[0-9]+){3}$"
SIGNED = r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"
AT, SPACED = r"(?:@|\(at\)|\[at\]|\x20at\x20)", r"\x20\.|\.\x20"
SPELT_OUT = r"\(at\)|\[at\]|\(dot\)|\[dot\]|\x20dot\x20"
CONTEXT_CHARS = 24
#: Boosting: trees a kind, learning rate, least share of base spans above the threshold.
TREES, RATE, PRECISION = 20, 0.3, 0.9


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def checked(kind: str, match: Column) -> Column:
    """Whether a base match passes its kind's check."""
    if kind == "ip":
        return match.rlike(ADDRESS)
    if kind == "card":
        return F.char_length(digits(match)).between(16, 19) & F.call_function("luhn_check", digits(match))
    if kind == "phone":
        return F.char_length(digits(match)).between(8, 15)
    return F.lit(True)


SPAN = "array<struct<kind:int,start:int,end:int>>"


def base_spans(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``_text`` and ``_base``: base spans (kind number, start, end) by kind and start."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    step = docs.select(*[F.col(f"`{c}`") for c in keep], t.alias("_text")).withColumn("_digits", F.col("_text").rlike("[0-9]"))
    gates = {"email": F.col("_text").contains("@"), "ip": F.col("_digits"), "card": F.col("_digits"), "phone": F.col("_text").contains("+")}

    def spans(number: int, kind: str) -> Column:
        good = F.filter(found(F.col("_text"), PATTERNS[kind], gates[kind]), lambda x: checked(kind, x["match"]))
        return F.transform(good, lambda x: F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    every = F.concat(*[spans(i, k) for i, k in enumerate(KINDS)])
    return step.select(*[F.col(f"`{c}`") for c in keep], "_text", "_digits", F.inline(F.array(F.struct(every.alias("_base")))))


#: Features of a candidate and how many values each has.
FEATURES = {"length": 9, "separators": 5, "groups": 6, "luhn": 2, "address": 2, "before": 3, "cue": 2}


def parts(run: Column) -> Column:
    """The parts of a run that begin and end at separators, as an array of (start, end, match, n digits), without the run."""
    kind = "array<struct<start:int,end:int,match:string,n:int>>"

    def of_start(x: Column, gs: Column, i: Column) -> Column:
        def part(h: Column) -> Column:
            begin, end = x["g"][i]["start"], h["end"]
            return bound(cut(x["p"], begin, end), lambda match: F.struct(
                (run["start"] + begin).alias("start"), (run["start"] + end).alias("end"), match.alias("match"), F.char_length(digits(match)).alias("n")))

        return F.transform(F.slice(gs, i + 1, MOST_DIGITS), part)  # a group has a digit at least

    def of_groups(x: Column) -> Column:
        return F.flatten(F.transform(x["g"], lambda g, i: of_start(x, x["g"], i)))

    groups = F.struct(found(run["match"], "[0-9]++", F.lit(True)).alias("g"), pieces(run["match"]).alias("p"))
    inner = F.filter(bound(groups, of_groups), lambda x: (x["n"] <= MOST_DIGITS) & (x["end"] - x["start"] < run["end"] - run["start"]))
    return F.when(run["match"].rlike("[^0-9]"), inner).otherwise(F.array().cast(kind))


def candidates(with_base: DataFrame) -> DataFrame:
    """Adds ``_candidates``: spans with their features, and whether they are base spans of their kind."""
    text = F.col("_text")
    runs = F.filter(found(text, RUN, F.col("_digits")), lambda x: F.char_length(digits(x["match"])) >= LEAST_DIGITS)
    gate = text.contains("(at)") | text.contains("[at]") | text.contains(" at ")
    spaced = F.filter(found(text, SPELT, gate), lambda x: x["match"].rlike(SPACED))
    names = [F.col(f"`{c}`") for c in with_base.columns]
    made = F.struct(pieces(text).alias("_pieces"), runs.alias("_runs"), F.concat(found(text, WRITTEN, gate | text.contains("@")), spaced).alias("_written"))
    with_runs = with_base.select(*names, F.inline(F.array(made)))
    with_runs = with_runs.select(*names, "_pieces", "_runs", "_written", F.inline(F.array(F.struct(F.flatten(F.transform("_runs", parts)).alias("_parts")))))

    def described(x: Column, number: int, kind: str) -> Column:
        lead = cut(F.col("_pieces"), F.greatest(F.lit(0), x["start"] - CONTEXT_CHARS), x["start"])
        return bound(F.struct(lead.alias("lead"), digits(x["match"]).alias("plain")), lambda y: features(x, y["lead"], y["plain"], number, kind))

    def features(x: Column, lead: Column, plain: Column, number: int, kind: str) -> Column:
        match = x["match"]
        n = F.char_length(plain)
        length = sum((n >= F.lit(k)).cast("int") for k in (8, 10, 11, 13, 16, 17, 20, 25))
        marks = F.regexp_replace(match, "[0-9]", "")
        separators = F.when(marks == "", 0).when(marks.rlike("[()]"), 4).when(marks.rlike(r"^\x20+$"), 1).when(marks.rlike("^-+$"), 2).otherwise(3)
        groups = F.least(F.size(F.split(match, r"[^0-9]+")) - 1, F.lit(5))
        before = F.when(lead.rlike(r"[\p{L}0-9]$"), 1).when(lead.rlike(r"[=:\"']\s*$"), 2).otherwise(0)
        if kind == "email":
            length, separators = match.rlike(SPACED).cast("int"), F.when(match.rlike(r"[A-Za-z0-9-]\W[a-z]{2,6}$"), 0).when(match.rlike(r"\W[A-Za-z]+$"), 1).otherwise(2)
            groups = F.least(F.size(F.split(F.regexp_extract(match, f"{AT}(.*)$", 1), DOT)) - 1, F.lit(5))
        return F.struct(
            F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            length.cast("int").alias("length"), separators.cast("int").alias("separators"), groups.cast("int").alias("groups"),
            (F.lit(0) if kind == "email" else F.call_function("luhn_check", plain).cast("int")).alias("luhn"),
            (match.rlike(r"^[A-Za-z]+[._%+0-9-]") if kind == "email" else match.rlike(ADDRESS)).cast("int").alias("address"), before.cast("int").alias("before"),
            lead.rlike(CUES[kind]).cast("int").alias("cue"),
            # the base rule, seen from the candidate
            (F.when(F.lit(kind == "phone"), lead.endswith("+") & n.between(8, 15))
             .when(F.lit(kind == "card"), n.between(16, 19) & F.call_function("luhn_check", plain) & match.rlike(r"^[0-9](?:[\x20-]?[0-9])++$"))
             .when(F.lit(kind == "email"), match.rlike(SIGNED))
             .when(F.lit(kind == "ip"), match.rlike(ADDRESS)).otherwise(F.lit(False))).cast("int").alias("is_base"),
            (~match.rlike(SPELT_OUT) if kind == "email" else F.lit(True)).alias("learned"),
        )

    def of_kind(number: int, kind: str) -> Column:
        if kind == "email":
            return F.transform("_written", lambda x: described(x, number, kind))
        low, high = DIGITS[kind]
        fits = F.filter("_parts", lambda x: x["n"].between(low, high) & (x["match"].rlike(DOTTED) if kind == "ip" else F.lit(True)))
        every = F.concat("_runs", F.transform(fits, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"))))
        return F.transform(every, lambda x: described(x, number, kind))

    proposed = [of_kind(i, k) for i, k in enumerate(KINDS)]
    return with_runs.select(*names, F.inline(F.array(F.struct(F.concat(*proposed).alias("_candidates")))))


@dataclass(frozen=True)
class Trees:
    """Boosted trees of depth two for a kind, as (feature, at most, left value or tree, right value or tree)."""

    start: float
    trees: tuple
    threshold: float

    def score(self, x: Column) -> Column:
        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            feature, most, left, right = tree
            return F.when(x[feature] <= most, walk(left)).otherwise(walk(right))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + walk(tree)
        return total


def boost(cells: np.ndarray, good: np.ndarray, total: np.ndarray, trees: int = TREES, rate: float = RATE) -> Trees | None:
    """Trees on feature cells (a row each) with counts of base spans and of all candidates; None if none is a base span."""
    if not good.sum():
        return None
    names = list(FEATURES)
    share = (good.sum() + 1) / (total.sum() + 2)
    score = np.full(len(cells), float(np.log(share / (1 - share))))
    start, grown = score[0] if len(score) else 0.0, []

    def gain(g: np.ndarray, h: np.ndarray) -> float:
        return float(g.sum() ** 2 / (h.sum() + 1.0))

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        best = (1e-9, None)
        for f in range(len(names)) if depth else ():
            for most in np.unique(cells[rows, f])[:-1]:
                left = cells[rows, f] <= most
                better = gain(g[rows][left], h[rows][left]) + gain(g[rows][~left], h[rows][~left]) - gain(g[rows], h[rows])
                if better > best[0]:
                    best = (better, (f, int(most), left))
        if best[1] is None:
            return round(rate * float(g[rows].sum() / (h[rows].sum() + 1.0)), 6)
        f, most, left = best[1]
        return names[f], most, grow(rows[left], g, h, depth - 1), grow(rows[~left], g, h, depth - 1)

    def value(tree, row: np.ndarray) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if row[names.index(tree[0])] <= tree[1] else tree[3]
        return tree

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = good - total * p, total * p * (1 - p)
        tree = grow(np.arange(len(cells)), g, h, 2)
        grown.append(tree)
        score = score + np.array([value(tree, row) for row in cells])
    order = np.argsort(-score, kind="stable")
    above = np.cumsum(good[order]) / np.cumsum(total[order])
    last = np.append(score[order][1:] < score[order][:-1], True)  # equal scores go together
    fit = np.flatnonzero((above >= PRECISION) & last)
    return Trees(float(start), tuple(grown), float(score[order][fit[-1]]) - 1e-6 if len(fit) else float("inf"))


def learn(described: DataFrame) -> dict[int, Trees]:
    """Trees of each kind, from the cells of all candidates of the corpus."""
    names = list(FEATURES)
    each = described.select(F.explode("_candidates").alias("c")).where("c.learned").select("c.kind", *[f"c.{n}" for n in names], "c.is_base")
    rows = each.groupBy("kind", *names).agg(F.sum("is_base").alias("good"), F.count("*").alias("total")).collect()
    out = {}
    for number in range(len(KINDS)):
        own = sorted(tuple(r) for r in rows if r["kind"] == number)
        if own:
            table = np.array([list(map(float, r[1:])) for r in own])
            trees = boost(table[:, : len(names)], table[:, -2], table[:, -1])
            if trees:
                out[number] = trees
    return out


def chosen(described: DataFrame, trees: dict[int, Trees]) -> DataFrame:
    """Adds ``_spans``: base spans and the chosen candidates, by kind and start."""

    def scored(x: Column) -> Column:
        value = F.lit(float("-inf"))
        for number, t in trees.items():
            value = F.when(x["kind"] == number, t.score(x) - F.lit(t.threshold)).otherwise(value)
        return value

    good = F.filter("_candidates", lambda x: scored(x) >= 0)
    some = F.transform(good, lambda x: F.struct(
        x["start"].alias("start"), F.lit(1).alias("added"), x["kind"].alias("kind"), x["end"].alias("end"), scored(x).alias("score")))
    base = F.transform("_base", lambda x: F.struct(x["start"].alias("start"), F.lit(0).alias("added"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(float("inf")).alias("score")))
    rest = [F.col(f"`{c}`") for c in described.columns if c != "_candidates"]
    if not trees:
        return described.select(*rest, F.col("_base").alias("_spans"))

    def chains(items: Column) -> Column:
        """Spans in order of their start, cut where one starts behind all before it."""
        ends = running(F.transform(items, lambda x: x["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
        reach = F.slice(F.concat(F.array(F.lit(-1)), ends), F.lit(1), F.size(items))
        fresh = F.zip_with(items, reach, lambda x, r: x["start"] >= r)
        places = F.filter(F.transform(fresh, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
        return bound(F.concat(places, F.array(F.size(items))), lambda at: F.transform(
            F.slice(at, F.lit(1), F.size(at) - 1), lambda start, k: F.slice(items, start + 1, F.get(at, k + 1) - start)))

    def best(chain: Column) -> Column:
        """The base spans of a chain, and of its other spans the best that overlap none taken before."""
        order = F.sort_array(F.transform(chain, lambda x: F.struct(
            x["added"].alias("added"), (-x["score"]).alias("score"), x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))

        def take(taken: Column, x: Column) -> Column:
            free = (x["added"] == 0) | ~F.exists(taken, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
            span = F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
            return F.when(free, F.concat(taken, F.array(span))).otherwise(taken)

        return F.aggregate(order, F.array().cast(SPAN), take)

    marked = described.select(*rest, F.inline(F.array(F.struct(some.alias("_some")))))
    every = F.when(F.size("_some") > 0, bound(
        F.sort_array(F.concat(base, F.col("_some"))), lambda items: F.sort_array(F.flatten(F.transform(chains(items), best))))).otherwise(F.col("_base"))
    return marked.select(*rest, F.inline(F.array(F.struct(every.alias("_spans")))))


def with_spans(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``_text``, ``_base`` and ``_spans`` of every document, with trees learned from all of them."""
    described = candidates(base_spans(docs, keep, text))
    return chosen(described, learn(described))


def spans_text(spans: str) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``size`` follows where the column exists.

    Overlapping spans become one mark, of the first.
    """
    masked = Masked(docs)
    text, size = masked[text], masked.names.get(size)
    marked = with_spans(masked.df, masked.df.columns, text)
    by_start = F.sort_array(F.transform("_spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def replaced(x: Column) -> Column:
        """The text between spans, with a mark for each span that starts behind all before it."""
        ends = F.concat(F.array(F.lit(0)), running(F.transform(x["spans"], lambda y: y["end"]), F.lit(0), lambda a, b: F.greatest(a, b)))

        def joined(reach: Column) -> Column:
            done = F.zip_with(x["spans"], F.slice(reach, F.lit(1), F.size(x["spans"])), lambda y, r: F.when(
                y["start"] >= r, F.concat(cut(x["pieces"], r, y["start"]), F.get(names, y["kind"]))).otherwise(F.lit("")))
            tail = cut(x["pieces"], F.element_at(reach, -1), F.char_length("_text"))
            return F.concat(F.array_join(done, ""), tail)

        return bound(ends, joined)

    made = F.when(F.size("_spans") > 0, bound(
        F.struct(by_start.alias("spans"), pieces(F.col("_text")).alias("pieces")), replaced)).otherwise(F.col(f"`{text}`"))
    out = marked.select(*masked.df.columns, F.inline(F.array(F.struct(made.alias("_made")))))
    changed = {text: F.col("_made")}
    if size:
        changed[size] = F.when(F.col("_made").isNull(), F.col(size)).otherwise(F.char_length("_made").cast("long"))
    return masked.restore(out.select(*[changed.get(c, F.col(c)).alias(c) for c in masked.df.columns]))
