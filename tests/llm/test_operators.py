"""The training-data operators against brute force, exact round trips and held-out accuracy, and their defined edge cases."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.oracle import compare, connect
from tidemark.llm import bpe, chat, language, packing, pii, quality, resemblance, scoring, simhash, sketches, urls
from tidemark.llm.queries import QUERIES, URL_RULES, byte_bpe_path

PATH = "/root/testdata/sf0.001"
HOSTILE = r"\### Assistant: </turn> ok"
ODD = [
    None, "", " \n\t ", "one", "a b c d e f g h i j k l", "<|endoftext|> x<|endoftext|>", "it's  we'll\n\n 'S don't \x85 \x0b", "日本語 😀 é́ ñ",
    "word " * 3000, "x" * 3000, "12 " * 500, "Mail a@b.cd_x@d.e or +1 (068) 555-2748, 10.0.0.1, 4111 1111 1111 1111.", HOSTILE,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i % 5 else None, t, None if i % 3 else "en", None, 1, "a", "b") for i, t in enumerate(ODD + ODD[3:6])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `_text` string, n_words string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def docs(spark):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id", "text").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_number_is_registered():
    registered = queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(registered) and "op6_quality_rules" in oracle_sql()


def test_quality_matches_its_sql(spark):
    assert compare(queries()["op6_quality_rules"](spark, PATH), connect(PATH), oracle_sql()["op6_quality_rules"]) is None


def test_bpe_equals_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random = np.random.default_rng(3)
    letters = [*" \n\t   'sllré1２😀.,!\x0b\x1c\x85", "<|endoftext|>", "the ", "tion", "aaa"]
    texts = [t or "" for t in ODD] + ["".join(random.choice(letters, random.integers(0, 40))) for _ in range(3000)]
    for memory in (10, 100_000):
        encoder = bpe.Encoder(bpe.Vocabulary.load(byte_bpe_path()), memory)
        for part in (texts[:50], texts[50:], texts[:50]):
            ids, counts = encoder.encode(part)
            expected = library.encode_batch(part, add_special_tokens=False)
            assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == expected[0].ids
            assert ids.tolist() == [i for e in expected for i in e.ids] and counts.tolist() == [len(e.ids) for e in expected]
            assert encoder.decode(ids, counts) == [library.decode(e.ids, skip_special_tokens=False) for e in expected]


def test_bpe_columns_round_trip(odd):
    coded = bpe.encode_texts(odd.select("n_chars", "text"), "text", ["n_chars"], byte_bpe_path())
    back = bpe.decode_ids(coded, "ids", ["n_chars"], byte_bpe_path())
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] or "" for r in odd.select("text").collect())


def near_components(prints, distance):
    values = np.array(sorted(set(prints.values())), dtype=np.uint64)
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    place, least = {int(v): i for i, v in enumerate(values)}, {}
    for d, p in prints.items():
        least[root(place[p])] = min(d, least.get(root(place[p]), d))
    return {d: least[root(place[p])] for d, p in prints.items()}


@pytest.mark.parametrize("limit", [1, 64])
def test_links_connect_all_pairs_within_two_bits(spark, limit):
    random = np.random.default_rng(5)
    base = random.integers(0, 1 << 63, 12, dtype=np.int64)
    near = [int(b) ^ sum(1 << int(k) for k in set(random.integers(0, 62, random.integers(0, 4)).tolist())) for b in base for _ in range(30)]
    prints = dict(enumerate([*near, 0, -1]))
    nodes = spark.createDataFrame([(p,) for p in set(prints.values())], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, 2, limit)).collect()}
    roots = {d: found.get(p, p) for d, p in prints.items()}
    expected = near_components({d: np.uint64(p & (2**64 - 1)) for d, p in prints.items()}, 2)
    groups = lambda of: sorted(sorted(g) for g in {v: [d for d in of if of[d] == v] for v in of.values()}.values())
    assert groups(roots) == groups(expected)


def test_simhash_query(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op3_simhash"](spark, PATH).collect()}
    prints = {d: int(rows[d]["fingerprint"], 16) for d in docs}
    for d, text in list(docs.items())[:40]:
        hashes = simhash.shingle_hashes(text, 3)
        bits = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
        assert prints[d] == bits
    assert {d: rows[d]["component_id"] for d in docs} == near_components(prints, 2)


def test_representatives_keep_one_of_each_group(spark):
    words = [f"w{i}" for i in np.random.default_rng(2).integers(0, 5000, 400)]
    changed = [*words[:200], "other", *words[201:]]
    apart = [f"v{i}" for i in range(300)]
    rows = [(5, " ".join(words), "x"), (3, " ".join(changed), "x"), (3, " ".join(changed), "x"), (9, " ".join(apart), "x"), (None, " ".join(apart), "y"), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, f0 string")
    kept = resemblance.representatives(frame).collect()
    assert sorted((r["doc_id"] or -1, r["f0"]) for r in kept if r["text"]) == [(3, "x"), (9, "x")] and len(kept) == 3
    assert resemblance.representatives(frame.limit(0)).count() == 0


def test_sketch_query_and_order(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op5_bottom_k"](spark, PATH).collect()}
    ids, sketcher = sorted(docs), sketches.Sketcher()
    for i, d in enumerate(ids):
        text, following = docs[d], docs[ids[(i + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert rows[d]["n_chars"] == len(text) and rows[d]["edited_sha256"] == sha(edited)
        assert rows[d]["fingerprint"] == sketches.to_text(sketcher.sketch(text))
        assert rows[d]["edited_fingerprint"] == sketches.to_text(sketcher.sketch(edited))


def test_sketches_estimate_and_merge(spark):
    a, b = [f"a{i}" for i in range(3000)], [f"a{i}" for i in range(1500, 4500)]
    s = sketches.Sketcher()
    x, y, both = s.sketch(" ".join(a)), s.sketch(" ".join(b)), s.sketch(" ".join(a + b))
    assert abs(sketches.resemblance(x, y, sketches.K) - 1 / 3) < 0.15 and abs(sketches.containment(x, y, sketches.K) - 0.5) < 0.2
    assert abs(sketches.distinct_count(x, sketches.K) / 2996 - 1) < 0.3
    assert (sketches.from_text(sketches.to_text(x)) == x).all() and len(sketches.merge(sketches.K, x, y)) == sketches.K
    frame = spark.createDataFrame([(1, "g", " ".join(a)), (2, "g", " ".join(b)), (3, "h", None)], "doc_id long, g string, text string")
    merged = {r["g"]: r["sketch"] for r in sketches.merged(sketches.sketched(frame, ["g"]), ["g"]).collect()}
    assert np.array(merged["g"]).view(np.uint64).tolist() == sketches.merge(sketches.K, x, y).tolist() and "h" not in merged
    assert len(both) == sketches.K


@pytest.mark.parametrize("rows", [[], [(4, "a b")], [(None, "x"), (None, None), (2, "y"), (2, "y"), (1, "z")]])
def test_next_texts_with_nulls_and_ties(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sketches.map_with_next(frame, "doc_id", "own string, following string", lambda: lambda a, b: (a, b)).collect()
    order = sorted(((d is not None, d or 0, t or "") for d, t in rows))
    expected = [(a[1] if a[0] else None, a[2], order[(i + 1) % len(order)][2]) for i, a in enumerate(order)]
    assert collections.Counter(map(tuple, found)) == collections.Counter(expected)


def brute_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
            good = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_brute_force(spark):
    texts = [t or "" for t in ODD] + [
        "é a@b.cd_x@d.e f", "x@y@z.com +12345678", "4111-1111-1111-1111  1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0004", "1" * 5000, "a" * 50000 + "@b.c",
        "1-" * 3000, "1.2.3.4 " * 700, "\t12 34 56 78"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.with_spans(frame, ["doc_id"]).select("doc_id", pii.spans_text("_base").alias("b"), pii.spans_text("_spans").alias("s")).collect()
    for r in rows:
        assert r["b"] == ",".join(brute_spans(texts[r["doc_id"]]))
        assert set(filter(None, r["b"].split(","))) <= set(r["s"].split(","))


def test_pii_query_is_native(spark, docs):
    frame = QUERIES["op4_pii"](spark, PATH)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for r in frame.collect():
        base = brute_spans(docs[r["doc_id"]])
        assert r["base_sha256"] == sha(",".join(base)) and r["n_card"] == sum(b.startswith("card") for b in base)


def test_trees_add_what_looks_like_base_spans(spark):
    rows = [(i, f"call +1 (0{i:02d}) 555-20{i:02d} or 1 (1{i:02d}) 555-10{i:02d} now" if i < 3 else f"call +1 (0{i:02d}) 555-20{i:02d} now") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r[0]: r[1] for r in pii.with_spans(frame, ["doc_id"]).select("doc_id", pii.spans_text("_spans")).collect()}
    assert spans[1].count("phone") == 2 and spans[9].count("phone") == 1
    redacted = {r["doc_id"]: r["text"] for r in pii.redacted(frame).collect()}
    assert redacted[1] == "call [PHONE] or [PHONE] now"


def test_chat_round_trip(spark):
    for text in (HOSTILE, "", "\\", "####", "\\n\n</turn>", "### user\n</turn>\n"):
        formatted = "".join("".join(chat.turn_parts(r, text)) for r in ("user", "assistant", "a\nb"))
        assert chat.parsed(formatted) == [("user", text), ("assistant", text), ("a\nb", text)] and chat.unescaped(chat.escaped(text)) == text
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"),
            (None, None, None, None), (4, 1, "assistant", HOSTILE), (4, 1, "assistant", HOSTILE)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    trees = chat.prefix_trees(frame, byte_bpe_path())
    back = chat.read_back(trees, byte_bpe_path(), "formatted string, masked string", lambda f, m: (f, "|".join(m)))
    found = {r["conv_id"]: (chat.parsed(r["formatted"]), r["masked"]) for r in back.collect()}
    assert found[1] == ([("user", "hi"), ("assistant", "yo")], "yo") == found[3] and found[2][1] == "no" and found[None][0] == [("", "")]
    assert found[4] == ([("assistant", HOSTILE)] * 2, "|".join([chat.escaped(HOSTILE)] * 2))
    assert chat.prefix_trees(frame.limit(0), byte_bpe_path()).count() == 0


def test_chat_query(spark):
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{PATH}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-7] = [("user", HOSTILE), ("assistant", HOSTILE)]
    rows = QUERIES["op7_chat_formatting"](spark, PATH).collect()
    assert len(rows) == len(turns)
    for r in rows:
        t = turns[r["conv_id"]]
        loss = "".join(x for role, x in t if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(t), sha("".join(f"{a}\n{b}\n" for a, b in t)), len(loss), sha(loss))


def test_packing_query(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op8_best_fit_packing"](spark, PATH).collect()
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    for d, text in docs.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["piece"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert r["piece"] == 0 or r["length"] == 1024
            at += r["length"]
        assert at == len(ids)
    assert len(sequences) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_plans_place_every_item():
    random = np.random.default_rng(1)
    for lengths in ([], [5], [1024] * 3, random.integers(300, 700, 2000), np.clip(random.lognormal(5.5, 1.2, 20000), 1, 1024).astype(int)):
        counts = np.bincount(np.array(lengths, dtype=int), minlength=1025)
        made = packing.plan(counts)
        placed = sum((np.bincount(c, minlength=1025) * n for c, n in made.runs), np.zeros(1025, int))
        assert (placed == counts).all() and all(c.sum() <= 1024 for c, _ in made.runs)
        bound = -(-int((counts * np.arange(1025)).sum()) // 1024)
        assert bound <= made.sequences <= 1.02 * bound + 1


def test_language_is_right_on_held_out_documents(spark):
    truth = dict(spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id", "lang").collect())
    rows = QUERIES["op9_language_id"](spark, PATH).where("held_out").collect()
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_code_lengths_are_those_of_a_direct_coder():
    texts = {"x": "abab abac", "y": "zab zzz"}
    rows = [(k, int(g), int(n)) for k, t in texts.items() for g, n in zip(*np.unique(language.grams_of(t.encode()), return_counts=True), strict=True)]
    model = language.build_model(rows, min_context=1)
    assert abs(np.exp2(-model.bits.reshape(-1, model.width, 2)).sum(axis=1) - 1).max() < 1.0  # unseen bytes share the rest
    counts = {k: collections.Counter() for k in texts}
    for k, t in texts.items():
        padded = language.PAD + t.encode()
        for i in range(3, len(padded)):
            for n in range(4):
                counts[k][padded[i - n : i], padded[i]] += 1

    def probability(k, context, byte):
        seen = {b: n for (c, b), n in counts[k].items() if c == context}
        if not seen:
            return probability(k, context[1:], byte)
        total, kinds = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (total + kinds)
        if not context:
            return kinds / (total + kinds) / (256 - kinds)
        return kinds / (total + kinds) * probability(k, context[1:], byte) / (1 - sum(probability(k, context[1:], b) for b in seen))

    text = b"ab zac"
    direct = [-sum(np.log2(probability(k, (language.PAD + text)[i : i + 3], text[i])) for i in range(len(text))) for k in ("x", "y")]
    assert np.allclose(language.code_lengths([text.decode()], model)[0], direct, rtol=1e-4)


def test_scores_beat_word_shares(spark, docs):
    rows = QUERIES["op10_lm_scoring"](spark, PATH).collect()
    assert len(rows) == len(docs)
    assert all(r["n_words"] == len(docs[r["doc_id"]].encode().split()) and (r["log_likelihood"] < 0) == (r["n_words"] > 0) for r in rows)
    classes = scoring.Classes([b"a", b"b"])
    flat, places, counts = classes.padded(["a b a b " * 400, "", "b a"])
    net = scoring.Network.start()
    before = net.log_probabilities(flat, places).mean()
    for _ in range(30):
        net.train(flat, places, 0.2)
    assert before < net.log_probabilities(flat, places).mean() and counts.tolist() == [1600, 0, 2]
    assert np.allclose(scoring.Network.from_flat(net.flat()).flat(), net.flat())


def test_word_counts_cover_the_corpus(spark, docs):
    counted = {bytes(r["word"]): r["n"] for r in scoring.word_counts(spark.read.parquet(f"{PATH}/documents.parquet")).collect()}
    assert counted == collections.Counter(w for t in docs.values() for w in scoring.words(t))


def test_url_rules_and_hosts(spark):
    given = [None, "nothing", "http://A.Example.COM/en/1?x", "https://www.example.com/en/", "http://example.com/fr/2", "x://b.net/es/#t", "x://net/fr/1", "x://bnet/es/1",
             "http://casino-win.org/en/1", "http://casino-win.org/en/2", "http://clean.org/en/1", "http://b.com", "http://É.com/en/"]
    frame = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    rows = {r["page_id"]: r for r in urls.judged(frame, ["page_id"], URL_RULES).collect()}

    def expected(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        return host, path, best and best.text, best and best.verdict

    for i, url in enumerate(given):
        host, path, rule, verdict = expected(url)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule) and (not rule or rows[i]["verdict"] == verdict)
    assert rows[8]["verdict"] == "block" and rows[10]["verdict"] == "allow" and rows[0]["verdict"] == "allow"
    plan = urls.judged(frame, ["page_id"], URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert urls.judged(frame.limit(0), ["page_id"], URL_RULES).count() == 0


def test_stages_on_odd_and_empty_tables(spark, odd):
    for frame in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, PATH)
            rows = out.collect()
            assert name == "packing" or out.columns == frame.columns
            assert frame is odd or not rows
    kept = quality.judged(odd, ["doc_id", "n_words"][:1]).where("kept").collect()
    assert all(r["n_words"] >= 10 for r in kept)


def test_operators_on_odd_rows(spark, odd):
    n = odd.count()
    assert simhash.near_duplicates(odd).count() == n and sketches.sketched(odd, ["n_chars"]).count() == n
    model = language.learn(odd)
    assert language.identify(odd, model, ["doc_id"]).count() == n
    und = language.identify(odd.where("text is null or text = ''"), model, ["doc_id"]).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in und] == [("und", 0.0)] and language.learn(odd.limit(0)) is None
    assert language.identify(odd, None, ["doc_id"]).where("lang_pred != 'und'").count() == 0
    assert scoring.scored(odd, ["doc_id"]).count() == n and scoring.scored(odd.limit(0), ["doc_id"]).count() == 0


def test_pipeline_equals_its_stages(spark, docs):
    docs_frame = spark.read.parquet(f"{PATH}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs_frame = stage(spark, docs_frame, PATH)
    once = collections.Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in docs_frame.collect())
    again = collections.Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, PATH).collect())
    assert once == again and once


def near_texts(random, words, changed):
    """A text of so many distinct words, and a copy with every shingle of the last words changed."""
    own = [f"w{random.integers(0, 1 << 40)}" for _ in range(words)]
    return " ".join(own), " ".join([*own[: words - changed], *(f"v{random.integers(0, 1 << 40)}" for _ in range(changed))])


def test_near_copies_are_those_of_exact_resemblance(spark):
    random = np.random.default_rng(8)
    near = [near_texts(random, 104, 11) for _ in range(60)]  # 89 of 111 shingles: 0.80
    far = [near_texts(random, 104, 14) for _ in range(60)]  # 86 of 114: 0.75
    rows = [(i, t) for i, t in enumerate(t for pair in near + far for t in pair)]
    kept = {r["doc_id"] for r in resemblance.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {*range(0, 120, 2), *range(120, 240)}


def test_crowded_files_keep_every_near_link(spark):
    # sliding texts: each is near a few others only, and all are one component of a file too dense for all pairs at once
    random = np.random.default_rng(6)
    words = [f"w{random.integers(0, 1 << 40)}" for _ in range(700)]
    rows = [(i, " ".join(words[at : at + 104])) for i, at in enumerate([*range(0, 400, 5), *range(480, 560, 5)])]
    order = random.permutation(len(rows)).tolist()
    frame = spark.createDataFrame([(order[i], t) for i, t in rows], "doc_id long, text string")
    for options in ({"dense": 0}, {"dense": 0, "leaders": 0, "block": 8}, {"dense": 0, "leaders": 1}):
        kept = {r["doc_id"] for r in resemblance.representatives(frame, **options).collect()}
        assert kept == {min(order[:80]), min(order[80:])}


def test_blocks_hold_every_pair_once_and_no_whole_file(spark):
    """One file of 600 texts, none near another: every pair is met once, no key holds the file, and nothing is linked."""
    members = spark.range(600).selectExpr("'f' AS key", "id AS node", "100L AS n", "id AS label")
    sizes = members.groupBy("key").agg(F.count("*").alias("t"))
    met = resemblance.all_pairs(members, sizes, 50)
    assert met.count() == met.select("node", "other").distinct().count() == 600 * 599 // 2
    assert met.groupBy("key", "i", "j").count().agg(F.max("count")).first()[0] < 75 * 75
    shared = F.sequence(F.lit(1), F.lit(82))
    own = F.sequence(F.col("id") * 1000 + 1000, F.col("id") * 1000 + 1017)
    sets = spark.range(600).select(F.col("id").alias("node"), F.concat(shared.cast("array<bigint>"), own).alias("hashes"))  # 82 of 118: 0.69
    labels = resemblance.near_components(members.drop("label"), sets, dense=0, block=50)
    assert labels.count() == 600 and labels.where("node <> label").count() == 0


def found_spans(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r[0]: r[1] for r in pii.with_spans(frame, ["doc_id"]).select("doc_id", pii.spans_text("_spans")).collect()}
    return [[t[int(a) : int(b)] + f" {k}" for k, a, b in (x.split(":") for x in rows[i].split(",") if x)] for i, t in enumerate(texts)]


def test_spelt_emails_are_found(spark):
    base = [f"write to ann.{i}@mail{i % 4}.example.com now" for i in range(40)]
    prose = [f"they were at work. Then at home. Word{i}" for i in range(20)]
    spelt = ["write to bob.7 (at) mail1 (dot) example (dot) com now", "write to bob at mail1 dot example dot com. Then", "x bob[at]mail2.example.com y"]
    spans = found_spans(spark, base + prose + spelt)
    assert all(len(s) == 1 for s in spans[:40]) and not any(spans[40:60])
    assert spans[60:] == [["bob.7 (at) mail1 (dot) example (dot) com email"], ["bob at mail1 dot example dot com email"], ["bob[at]mail2.example.com email"]]


def test_parts_of_digit_runs_are_found(spark):
    texts = ["pay 4111 1111 1111 1111 now"] * 20 + [f"call +1 (0{i}) 555-20{i} now" for i in range(10, 90)]
    mixed = ["order 12 4111 1111 1111 1111 ok", "at 10.0.0.1 4111 1111 1111 1111 ok", "call 1 (068) 555-2748 1 (069) 555-2749 ok", "4111 1111 1111 1111 5500 0000 0000 0004"]
    spans = found_spans(spark, texts + mixed)[100:]
    assert spans[0] == ["4111 1111 1111 1111 card"] and spans[1] == ["10.0.0.1 ip", "4111 1111 1111 1111 card"]
    assert spans[2] == ["1 (068) 555-2748 phone", "1 (069) 555-2749 phone"] and spans[3] == ["4111 1111 1111 1111 card", "5500 0000 0000 0004 card"]


def test_every_word_has_its_own_probability(spark):
    # "u" and "v" have one class if their hashes agree; the network can't tell them apart, their counts do
    own = [f"c{i}" for i in range(scoring.FREQUENT)]
    rest = [w for w in (f"z{i}" for i in range(3000)) if scoring.xxh64_intdigest(w.encode(), 42) % scoring.SHARED == 5][:2]
    rows = [(i, f"{' '.join(own)} {' '.join(own)} {' '.join(own)} {' '.join(own)} {rest[0]}" + (f" {rest[1]}" if not i else "")) for i in range(4)]
    rows += [(10, f"c1 c2 {rest[0]} c3 c4"), (11, f"c1 c2 {rest[1]} c3 c4"), (11, f"c1 c2 {rest[1]} c3 c4"), (12, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = scoring.scored(frame, ["doc_id"]).collect()
    scores = {r["doc_id"]: r["log_likelihood"] for r in found}
    assert len(found) == 8 and abs(scores[10] - scores[11] - np.log(5 / 3)) < 1e-3 and scores[12] == 0


def test_training_sees_every_window(spark, monkeypatch):
    frame = spark.createDataFrame([("a b",)], "text string").coalesce(1)
    start = scoring.Network.start()
    net = scoring.trained(frame, [b"a", b"b"], rounds=1)
    target_bias = net.group_bias - start.group_bias
    assert target_bias[0] > 0 and target_bias[1] > 0 and (target_bias[2:] < 0).all()  # classes 0 and 1, a group each


def test_one_bad_page_does_not_block_its_template(spark):
    urls_ = [f"x://a.org/en/{i}" for i in range(30)] + ["x://a.org/en/bet"] + [f"x://b.org/casino/{i}" for i in range(9)]
    urls_ += [f"x://c.org/a/b/c/{i}/view/{i * 7}" for i in range(30)]
    frame = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    rows = [r.asDict() for r in urls.judged(frame, ["page_id"], []).orderBy("page_id").collect()]
    assert [r["verdict"] for r in rows] == ["allow"] * 31 + ["block"] * 9 + ["allow"] * 30
    assert {r["template"] for r in rows[40:]} == {"/a/b/c/*/view/*"}


def test_fingerprints_link_texts_below_the_resemblance(spark):
    """A text changed in places that leave its fingerprint is one component with it, though they share too few shingles."""
    frame = spark.createDataFrame([(1, "a b c", 10, 0), (1, "a b c", 20, 0), (2, "x", 20, 3), (3, "y", 30, -1), (4, "z", 40, 64 + 1)], "i long, t string, node long, fp long")
    kept = resemblance.Scratch(spark)
    labels = {r["node"]: r["label"] for r in resemblance.fingerprint_labels(frame, 2, kept).collect()}
    assert labels == {10: 10, 20: 10, 30: 30, 40: 10}
    shingles = spark.createDataFrame([("f", n, 100) for n in (10, 20, 30)], "key string, node long, n long")
    sets = spark.createDataFrame([(n, [n]) for n in (10, 20, 30)], "node long, hashes array<long>")
    seeds = spark.createDataFrame(list(labels.items()), "node long, label long")
    joined = {r["node"]: r["label"] for r in resemblance.near_components(shingles, sets, seeds=seeds).collect()}
    assert joined == labels


def test_network_steps_equal_plain_ones():
    """A step with all groups and positions at once is the step that takes each window's gradient by itself."""
    random = np.random.default_rng(3)
    pad = np.full(scoring.SIDE, scoring.PAD, dtype=np.int32)
    flat = np.concatenate([pad, random.zipf(1.3, 900).astype(np.int32) % scoring.CLASSES, pad])
    places = random.permutation(np.arange(scoring.SIDE, len(flat) - scoring.SIDE))
    network, plain = scoring.Network.start(), scoring.Network(*(a.astype(np.float64) for a in scoring.Network.start().arrays()))
    network.train(flat, places, 0.25)
    h, size = plain.hidden(flat, places), scoring.GROUPS
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    changes = [np.zeros_like(a) for a in plain.arrays()]
    for row, place in zip(h, places, strict=True):
        g, w = flat[place] % size, flat[place] // size
        d1, d2 = softmax(row @ plain.group + plain.group_bias), softmax(row @ plain.inner[g] + plain.inner_bias[g])
        d1[g] -= 1
        d2[w] -= 1
        dh = (plain.group @ d1 + plain.inner[g] @ d2) * (1 - row * row)
        for i, offset in enumerate(scoring.OFFSETS):
            changes[0][i, flat[place + offset]] += dh
        changes[1] += dh
        changes[2] += np.outer(row, d1)
        changes[3] += d1
        changes[4][g] += np.outer(row, d2)
        changes[5][g] += d2
    for got, start, change in zip(network.arrays(), plain.arrays(), changes, strict=True):
        assert np.allclose(got, start - 0.25 / np.sqrt(len(places)) * change, atol=1e-4)


def test_components_of_stars_need_no_round_and_chains_end_without_a_spare_one(spark, tmp_path):
    def found(edges):
        stored, labels = [], []

        def store(df, label):
            labels.append(label)
            df.write.parquet(str(tmp_path / f"{len(labels)}-{len(edges)}"))
            stored.append(spark.read.parquet(str(tmp_path / f"{len(labels)}-{len(edges)}")))
            return stored[-1]

        rows = simhash.components(spark.createDataFrame(edges, "a long, b long"), store).collect()
        assert len(rows) == len({r["node"] for r in rows})
        return {r["node"]: r["root"] for r in rows}, labels.count("links") - 1

    # stars, a link given twice and turned round, a node linked to itself
    assert found([(1, 2), (1, 3), (3, 1), (1, 3), (-5, 9), (7, 7)]) == ({1: 1, 2: 1, 3: 1, -5: -5, 9: -5}, 0)
    assert found([(2, 3), (1, 2), (3, 4), (10, 11)]) == ({1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10}, 2)
    assert found([]) == ({}, 0)


def test_scores_equal_brute_force_whatever_shares_are_known(spark, monkeypatch):
    """Shares that tasks know and shares that are joined give the sum of each word's two log-probabilities and its share."""
    texts = ["a b a c d " * 9, "a b zz a " * 7 + "yy xx", "xx " * 40 + "a", "b", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    first = scoring.FREQUENT
    monkeypatch.setattr(scoring, "FREQUENT", 3)  # of the words that are looked for here; tasks keep the number of classes
    frequent, counts = [b"xx", b"a", b"b"], collections.Counter(w for t in texts for w in scoring.words(t or ""))
    assert [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3]] == frequent
    shared = lambda w: first + scoring.xxh64_intdigest(w, scoring.SEED) % scoring.SHARED
    in_class = collections.Counter()
    for w in set(counts) - set(frequent):
        in_class[shared(w)] += counts[w]
    net = scoring.trained(frame, frequent)
    softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())

    def expected(text):
        found = scoring.words(text or "")
        own = [scoring.PAD] * 2 + [frequent.index(w) if w in frequent else shared(w) for w in found] + [scoring.PAD] * 2
        total = 0
        for i, w in enumerate(found, 2):
            h = np.tanh(net.bias + sum(net.context[k, own[i + o]] for k, o in enumerate(scoring.OFFSETS)))
            g, c = own[i] % scoring.GROUPS, own[i] // scoring.GROUPS
            total += softmax(h @ net.group + net.group_bias)[g] + softmax(h @ net.inner[g] + net.inner_bias[g])[c]
            total += 0 if w in frequent else np.log(counts[w] / in_class[own[i]])
        return total

    for known in (0, 2, 1000):
        monkeypatch.setattr(scoring, "KNOWN", known)
        rows = scoring.scored(frame, ["doc_id"]).collect()
        assert all(abs(r["log_likelihood"] - expected(texts[r["doc_id"]])) < 1e-3 and r["n_words"] == len(scoring.words(texts[r["doc_id"]] or "")) for r in rows)
        assert len(rows) == len(texts)


def test_far_scores_make_no_denormal_numbers():
    """Products with denormal numbers take many times as long; a network that is sure of itself made them in every step."""
    random = np.random.default_rng(4)
    scores = random.normal(0, 60, (50, 2 * scoring.GROUPS)).astype(np.float32)
    plain = scores.reshape(-1, scoring.GROUPS).astype(np.float64)
    wanted = np.exp(plain - plain.max(axis=1, keepdims=True))
    assert ((0 < wanted) & (wanted < np.finfo(np.float32).tiny)).any()
    made = scoring.exponentials(scoring.bounded(scores)).reshape(-1, scoring.GROUPS)
    assert (made > 1e-27).all() and np.allclose(made, wanted, atol=1e-7, rtol=1e-5)
    flat = np.concatenate([np.full(2, scoring.PAD), random.integers(0, scoring.CLASSES, 600), np.full(2, scoring.PAD)]).astype(np.uint16)
    net = scoring.Network.start()
    net.group *= 100
    net.inner *= 100
    net.train(flat, np.arange(2, 602), 0.25)
    assert np.isfinite(net.flat()).all() and (net.log_probabilities(flat, np.arange(2, 602)) <= 0).all()


def test_plans_keep_configurations_small():
    """The driver keeps what is in each configuration, not a count for every length: that was over 100 MB, which it never gave back."""
    counts = np.bincount(np.clip(np.random.default_rng(5).lognormal(5.9, 0.7, 20000).astype(int), 1, packing.CAPACITY), minlength=packing.CAPACITY + 1)
    tracemalloc.start()
    try:
        made = packing.plan(counts, rounds=60)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 30e6
    assert (sum(n * np.bincount(x, minlength=len(counts)) for x, n in made.runs) == counts).all()
