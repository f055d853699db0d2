"""Secret scans against a brute-force version, and their defined edge cases."""

import hashlib
import random
import re
from collections import Counter
from math import log2

import pytest

from tests.llm.test_operators import PATH
from tidemark.llm import secrets
from tidemark.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def windows(run, c):
    """First start and last end of windows that reach the entropy, each counted anew."""
    good = []
    for i in range(len(run) - c.width + 1):
        part = run[i : i + c.width]
        n_digits = sum(x.isdigit() for x in part)
        total = sum(round(n * log2(n) * secrets.UNIT) for n in Counter(part).values())
        if total <= int(c.width * (log2(c.width) - c.bits) * secrets.UNIT) and 0 < n_digits < c.width:
            good.append(i)
    return (good[0], good[-1] + c.width) if good else None


def spans(text):
    kept = base(text)
    more = []
    for number, c in enumerate(secrets.CLASSES):
        for m in re.finditer(c.regex + "+", text):
            if len(m[0]) >= c.width and not any(re.search(p, m[0]) for p in secrets.ALLOWED):
                w = windows(m[0], c)
                if w:
                    more.append((m.start() + w[0], 3, m.start() + w[1], number))
    out = [(a, k, b) for a, k, b in kept]
    for a, k, b, number in more:
        inside = any(s <= a and b <= e for s, _, e in kept)
        inside = inside or any((s <= a and b <= e) and ((s, e) != (a, b) or n < number) for s, _, e, n in more)
        if not inside:
            out.append((a, k, b))
    return sorted(out)


def as_text(found):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)


def random_token(r, symbols, n):
    return "".join(r.choice(symbols) for _ in range(n))


def hostile():
    r = random.Random(11)
    b64, hexa = secrets.CLASSES[2].symbols, "0123456789abcdef"
    pieces = [
        "token", "password", "PassWD", "api_key", "APIKEY", "secret", "=", " = ", ":", '"', "'", '": "', "\n", " ", "é😀", "the word", ".", "AKIA", "akia", "ſecret",
        "-", "_", "/", "0", "9f", "deadbeef", "AAAA", "internationalization-of-things-2024", "550e8400-e29b-41d4-a716-446655440000", "EXAMPLE",
    ]
    out = []
    for _ in range(1500):
        text = ""
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.55:
                text += r.choice(pieces)
            elif kind < 0.7:
                text += random_token(r, b64, r.randint(1, 60))
            elif kind < 0.85:
                text += random_token(r, hexa if r.random() < 0.7 else hexa.upper(), r.randint(1, 60))
            else:
                text += random_token(r, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", r.randint(1, 40))
        out.append(text)
    return out


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.with_spans(docs, ["doc_id"]).select("doc_id", secrets.spans_text("_base").alias("b"), secrets.spans_text("_spans").alias("s"))
    return {r["doc_id"]: (r["b"], r["s"]) for r in found.collect()}


def test_spans_equal_brute_force(spark):
    texts = hostile()
    got = scanned(spark, texts)
    assert len(got) == len(texts)
    further = 0
    for i, text in enumerate(texts):
        assert got[i] == (as_text(base(text)), as_text(spans(text))), text
        further += "entropy" in got[i][1]
    assert further > 200


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{PATH}/documents.parquet").collect()}
    rows = QUERIES["op13_secret_scans"](spark, PATH).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(as_text(found).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in found) for i in range(3)]
        assert r["spans"] == as_text(spans(docs[r["doc_id"]]))


def test_what_is_secret_and_what_is_not(spark):
    r = random.Random(3)
    secret = [
        "use ghp_" + random_token(r, secrets.CLASSES[2].symbols[:-3], 36) + " here", "KEY " + random_token(r, "0123456789ABCDEF", 48),
        "id " + random_token(r, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 32),
    ]
    plain = [
        "550e8400-e29b-41d4-a716-446655440000", "see /docs/2024/how-to-write-good-documentation/part/12", "Donaudampfschifffahrtsgesellschaft",
        "call 90817263549081726354 now", "sha512-" + random_token(r, secrets.CLASSES[2].symbols, 60), "=" * 60, "z" * 60, "your_token_goes_here_9f8e7d6c5b4a",
    ]
    got = scanned(spark, secret + plain)
    assert all("entropy" in got[i][1] for i in range(len(secret)))
    assert [got[i][1] for i in range(len(secret), len(got))] == [""] * len(plain)


def test_edge_cases(spark):
    rows = [(1, None, "x", 1), (1, "", None, 1), (2, "token=abcdef", "x", 1), (2, "token=abcdef", "x", 1), (None, " \n", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_lower` string, `_base` int")
    found = secrets.with_spans(docs, ["doc_id", "_lower"]).select("doc_id", secrets.spans_text("_spans").alias("s")).collect()
    assert sorted((str(r["doc_id"]), r["s"]) for r in found) == [("1", ""), ("1", ""), ("2", "assign:0:12"), ("2", "assign:0:12"), ("None", "")]
    assert secrets.with_spans(docs.limit(0), ["doc_id"]).count() == 0


def test_long_runs_take_linear_time(spark):
    import time

    r = random.Random(5)
    run = random_token(r, secrets.CLASSES[2].symbols, 200_000)
    many = " ".join(random_token(r, "0123456789abcdef", 30) for _ in range(20_000))
    begin = time.time()
    got = scanned(spark, [run, many, "token " * 50_000, "token" + " " * 200_000, "a-1/" * 50_000])
    assert time.time() - begin < 40
    assert got[0][1].startswith("entropy:") and got[1][0].count("hex") == 20_000 and got[2][1] == got[3][1] == got[4][1] == ""


def test_plan_has_no_python(spark):
    plan = QUERIES["op13_secret_scans"](spark, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("c", secrets.CLASSES)
def test_symbols_fit_the_pattern(c):
    assert all(re.fullmatch(c.regex, x) for x in c.symbols) and c.symbols.startswith(secrets.DIGITS)
    assert sum(bool(re.fullmatch(c.regex, chr(i))) for i in range(128)) == len(set(c.symbols)) == len(c.symbols)
