"""Source divergence against a brute-force version and its SQL, and its defined edge cases."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import divergence

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, `key` string, open int"


def brute(rows, threshold=3, top=200):
    rows = [((t or ""), l or "", s or "") for t, l, s in rows]
    terms = [TERMS.findall(t.translate(UPPER)) for t, _, _ in rows]
    out = set()
    for lang in {l for _, l, _ in rows}:
        own = [(w, s) for w, (_, l, s) in zip(terms, rows, strict=True) if l == lang]
        seen = Counter(t for w, _ in own for t in set(w))
        kept = {t for t, n in seen.items() if n >= threshold}
        counts = defaultdict(Counter)
        for w, s in own:
            counts[s].update(t for t in w if t in kept)
        every = Counter()
        for c in counts.values():
            every.update(c)

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s, c in counts.items():
            pairs = [(o, sum((p(c, t) - p(d, t)) ** 2 // p(d, t) for t in kept)) for o, d in counts.items() if o != s]
            items = [(t, (p(c, t) - p(every, t)) ** 2 // p(every, t)) for t in kept if c[t] and p(c, t) > p(every, t)]
            for part, found in (("pair", pairs), ("term", items)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, v, i) for i, (item, v) in enumerate(found, 1) if part == "pair" or i <= top}
    return out


def audited(spark, rows, **options):
    df = spark.createDataFrame([(1, t, l, s, "x", 2) for t, l, s in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in divergence.audited(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def corpus():
    random = np.random.default_rng(8)
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "Abcdefghijklmnopqrstuvwxyz" * 3, "é", "éé", "日本", "日本語", "ÀB", "àb", "É", "straße", "don't"]
    words += ["".join(random.choice(list("aeinrst"), random.integers(1, 12))) for _ in range(150)]
    rows = []
    for _ in range(300):
        n = int(random.integers(0, 30))
        text = str(random.choice([" ", "-", "1", "\n"])).join(random.choice(words, n))
        rows.append((text if random.random() > 0.03 else None, [None, "", "en", "de"][random.integers(0, 4)], ["s1", "s2", "", None, "Ω"][random.integers(0, 5)]))
    return rows + [("", "empty", "a"), ("x1y", "empty", "b"), ("only once", "one", "a")]


def test_audit_equals_brute_force(spark):
    rows = corpus()
    assert audited(spark, rows) == brute(rows)
    assert audited(spark, rows, threshold=1, top=5) == brute(rows, 1, 5)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 17])
def test_prefix_levels_keep_exactly_the_frequent_terms(spark, bits, monkeypatch):
    """Also where a small bit table and small tasks' tables make prefixes collide and counts come in parts."""
    monkeypatch.setattr(divergence, "TASK_KEYS", 50)
    rows = corpus()
    df = spark.createDataFrame([(1, t, l, s, "x", 2) for t, l, s in rows], SCHEMA)
    got = {(r["lang"], r["term"]) for r in divergence.term_counts(df, sieve_bits=bits, first=1).collect()}
    seen = Counter((l or "", t) for text, l, _ in rows for t in set(TERMS.findall((text or "").translate(UPPER))))
    assert got == {k for k, n in seen.items() if n >= 3}


def test_sieve_finds_what_it_holds(spark):
    keys = [("en", bytes([i % 256, i // 256 + 1])) for i in range(2000)]
    sieve = divergence.Sieve.of(spark.createDataFrame(keys, "lang string, key binary"), 1 << 20)
    assert all(sieve.has(divergence.Sieve.seed(lang), key) for lang, key in keys)
    assert sum(sieve.has(divergence.Sieve.seed("de"), key) for _, key in keys) < 30
    assert divergence.Sieve.of(spark.createDataFrame([], "lang string, key binary")) is None


def test_sieve_answers_for_many_as_for_each(spark):
    keys = [("en", bytes([i % 256, i // 256 + 1])) for i in range(500)]
    sieve, seed = divergence.Sieve.of(spark.createDataFrame(keys, "lang string, key binary"), 1 << 12), divergence.Sieve.seed("en")
    asked = [k for _, k in keys] + [b"", b"\xff" * 40] + [bytes([9, 9, i]) for i in range(256)]
    assert list(sieve.which(seed, asked)) == [sieve.has(seed, k) for k in asked] and not all(sieve.which(seed, asked))
    assert list(sieve.which(seed, [])) == []
    kept, terms = divergence.Kept(sieve, "en"), [k + b"tail" for k in asked]
    for _ in range(2):  # the second time all answers are at hand
        assert kept.beginning(terms, 2) == [t for t in terms if sieve.has(seed, t[:2])]


def test_long_terms_and_empty_tables(spark):
    rows = [("x" * 600 + f" y{i}", "en", "s") for i in range(3)] + [("x" * 599, "en", "t")]
    got = audited(spark, rows)
    assert got == brute(rows)
    counts = divergence.term_counts(spark.createDataFrame([(1, t, l, s, "x", 2) for t, l, s in rows], SCHEMA))
    assert [(len(r["term"]), r["n"]) for r in counts.orderBy("term").collect()][::-1] == [(1, 3), (600, 3)]
    assert divergence.audited(spark.createDataFrame([], SCHEMA)).collect() == []
