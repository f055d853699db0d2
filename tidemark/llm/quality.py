"""Quality rules: a table of thresholds on counts and ratios of a text, compiled into Spark columns.

Counts of words, symbols, stop words, repeated windows and lines are built-in column expressions over the whole text;
a rule compares two counts in integers (``100 * count`` against ``percent * total``), so no rounding decides. There are no
user functions.

Defined cases: null and empty texts have no words and fail; a text shorter than a window has no repeated words; a
rule whose total is zero passes; repeated rows get equal results; very long texts are counted whole; an empty table
gives no rows; columns of the input with the same names as the counts are kept apart, only ``keep`` is passed on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import words_of

WINDOW = 5
# Frequent function words of the corpus languages.
STOP_WORDS = (
    "a", "and", "be", "by", "for", "in", "is", "it", "of", "that", "the", "this", "to", "was", "with",
    "au", "ce", "de", "des", "en", "et", "la", "le", "les", "par", "pour", "que", "qui", "un", "une",
    "das", "den", "der", "des", "die", "ein", "eine", "im", "ist", "mit", "nicht", "und", "von", "zu",
    "como", "con", "del", "el", "las", "los", "no", "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """``count`` must be between ``low`` and ``high`` percent of ``total``; texts of fewer words are let off."""

    name: str
    count: str
    total: str
    low: int = 0
    high: int | None = None
    from_words: int = 0


#: Base rules: whatever breaks one fails.
BASE_RULES = (
    Rule("few_words", "n_words", "one", low=1000),
    Rule("repeated_words", "n_repeat_words", "n_words", high=20),
)
#: The method's further rules.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=2000),
    Rule("marks", "n_marks", "n_words", high=20),
    Rule("exclamations", "n_exclaims", "n_words", high=30),
    Rule("upper_case", "n_upper", "word_chars", high=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=40),
    Rule("stop_words", "n_stop_words", "one", low=100, from_words=500),
)


def passes(rule: Rule) -> Column:
    count, total = F.col(rule.count) * 100, F.col(rule.total)
    ok = (count >= rule.low * total) if rule.low else F.lit(True)
    if rule.high is not None:
        ok = ok & (count <= rule.high * total)
    return ok | (total == 0) | (F.col("n_words") < rule.from_words) if rule.from_words or rule.total != "one" else ok


def counted(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and the counts that rules use."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = F.size("_words")
    windows = F.transform(
        F.sequence(F.lit(0), size - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])
    )
    hashed = F.when(size >= WINDOW, windows).otherwise(F.array().cast("array<bigint>"))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # windows by hash and place; those beside an equal hash are repeated, and their places in order cover the words
    placed = F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    beside = F.filter(
        "_placed", lambda x, i: F.coalesce(F.get("_placed", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_placed", i + 1)["h"] == x["h"], F.lit(False))
    )
    places = F.sort_array(F.transform(beside, lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        places, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"]
    )
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    names = [F.col(f"`{c}`") for c in keep]
    step = docs.select(*names, t.alias("_text"), words_of(F.col(f"`{text}`")).alias("_words"), lines.alias("_lines"))
    step = step.select(*names, "_text", "_words", "_lines", hashed.alias("_windows"))
    step = step.select(*names, "_text", "_words", "_lines", placed.alias("_placed"))
    counts = {
        "n_words": size,
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.col("_placed").isNull(), F.lit(0)).otherwise(covered),
        "n_lines": F.size("_lines"),
        "n_exclaims": F.regexp_count("_text", F.lit("!")),
        "n_marks": F.regexp_count("_text", F.lit(r"[#*$%&]{2,}")),  # bars and brackets of tables and markup are none
        "n_upper": F.regexp_count("_text", F.lit("[A-Z]")),
        "n_stop_words": F.size(F.array_intersect("_words", F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))]))),
        "one": F.lit(1),
    }
    # made as one struct and unfolded, so that a filter on a count runs on it and isn't merged into its arrays
    return step.select(*names, F.inline(F.array(F.struct(*[c.cast("long").alias(n) for n, c in counts.items()]))))


def judged(docs: DataFrame, keep: list[str], text: str = "text", base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The counts, ``base_failed``, ``broken`` (the method's rules a text breaks) and ``kept``."""
    failed = F.lit(False)
    for rule in base:
        failed = failed | ~passes(rule)
    broken = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    counts = counted(docs, keep, text)
    return counts.select("*", failed.alias("base_failed"), broken.alias("broken")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    ).drop("one")


def rule_sql(rule: Rule) -> str:
    """A rule as SQL text, for the oracle."""
    total = "1" if rule.total == "one" else rule.total
    parts = [f"100 * {rule.count} >= {rule.low} * {total}"] if rule.low else []
    if rule.high is not None:
        parts.append(f"100 * {rule.count} <= {rule.high} * {total}")
    text = f"({' AND '.join(parts)})"
    if rule.from_words or rule.total != "one":
        text = f"({text} OR {total} = 0 OR n_words < {rule.from_words})"
    return text
