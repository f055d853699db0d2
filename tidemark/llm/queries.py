"""The operators' registered queries: production parameters, whole tables, digest columns derived from real outputs."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, chat, clustering, divergence, language, packing, pii, quality, scoring, secrets, simhash, sketches, urls
from tidemark.llm.common import map_slices, table


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


URL_RULES = [
    urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return urls.judged(table(spark, sf_dir, "pages"), ["page_id"], URL_RULES)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded text."""
    vocabulary = spark.sparkContext.broadcast(bpe.Vocabulary.load(byte_bpe_path()))

    def digests(texts: list[str]) -> list:
        encoder = bpe.task_encoder(vocabulary)
        ids, counts = encoder.encode(texts)
        cuts = np.append(0, np.cumsum(counts)) * 4
        data = ids.astype("<u4").tobytes()
        return [
            counts,
            [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
            [hashlib.sha256(t.encode()).hexdigest() for t in encoder.decode(ids, counts)],
        ]

    docs = table(spark, sf_dir, "documents")
    return map_slices(docs, "text", ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, over three-word shingles and two bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text and of its text edited at the end, and their likeness."""

    def task():
        sketcher, last = sketches.Sketcher(), [None, None]

        def sketch(text: str) -> np.ndarray:
            if last[0] != text:
                last[:] = [text, sketcher.sketch(text)]
            return last[1]

        def row(text: str, following: str) -> tuple:
            cut = len(text) // 4
            edited = text[: len(text) - cut] + following[:cut]
            own, other = sketch(text), sketcher.sketch(edited)
            near = sketches.resemblance(own, other, sketches.K)
            near_next = sketches.resemblance(own, sketch(following), sketches.K)
            return (
                len(text), hashlib.sha256(edited.encode()).hexdigest(), sketches.to_text(own), sketches.to_text(other), near, near_next,
            )

        return row

    added = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sketches.map_with_next(table(spark, sf_dir, "documents"), "doc_id", added, task)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judged(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", *columns)


STOP_LIST = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
OP6_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, list_aggregate(words[i + 1:i + 5], 'string_agg', ' ') AS x
  FROM (SELECT doc_id, words, unnest(range(len(words) - 4)) AS i FROM w WHERE len(words) >= 5)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(5) r(k) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(list_aggregate(list_concat([''], words), 'string_agg', '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, len(regexp_extract_all(t, '!')) AS n_exclaims, len(regexp_extract_all(t, '[#*$%&]{{2,}}')) AS n_marks, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
         len(list_distinct(list_filter(words, lambda x: x IN ({STOP_LIST})))) AS n_stop_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
judged AS (
  SELECT *, NOT ({' AND '.join(quality.rule_sql(r) for r in quality.BASE_RULES)}) AS base_failed,
         {' AND '.join(quality.rule_sql(r) for r in quality.RULES)} AS good FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good AS kept FROM judged
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and all spans of personal data in every document."""
    found = pii.with_spans(table(spark, sf_dir, "documents"), ["doc_id"])
    kinds = F.transform("_base", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, (lambda n: lambda k: k == n)(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("_base"), 256).alias("base_sha256"), pii.spans_text("_spans").alias("spans"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted as prefix trees and read back from the token streams."""
    hostile = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], "conv_id long, turn long, role string, text string")
    trees = chat.prefix_trees(rows.unionByName(extra), byte_bpe_path())

    def digests(formatted: str, masked: list[str]) -> tuple:
        turns = chat.parsed(formatted)
        said = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode())
        loss = "".join(map(chat.unescaped, masked))
        return len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)

    added = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chat.read_back(trees, byte_bpe_path(), added, digests)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), ["doc_id"], byte_bpe_path(), end_id=2).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, model, ["doc_id"])
    return found.withColumn("held_out", language.held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    return scoring.scored(table(spark, sf_dir, "documents"), ["doc_id"])


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector after five rounds and a last assignment."""
    return clustering.clustered(table(spark, sf_dir, "embeddings"))


def op11_sql(clusters: int = clustering.CLUSTERS, rounds: int = clustering.ROUNDS) -> str:
    """The rounds one after the other, every vector against every centroid."""
    good = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64"
    gap = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {good}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM x
  ORDER BY 1 LIMIT {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT x.r, min(row(CAST({gap} AS BIGINT), c.cluster)) AS best FROM x, c{i} AS c GROUP BY x.r)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT cluster, list(mean ORDER BY dim) AS v FROM (
    SELECT cluster, dim, CAST((s - (((s % n) + n) % n)) // n AS BIGINT) AS mean FROM (
      SELECT best[2] AS cluster, dim, sum(value) AS s, count(*) AS n
      FROM (SELECT a.best, unnest(x.v) AS value, unnest(range(64)) AS dim FROM a{i} AS a JOIN x USING (r)) GROUP BY 1, 2))
  GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN m{i} AS m USING (cluster))""")
    return ",".join(steps) + f"""
SELECT x.vec_id, c.cluster, a.best[1] AS distance, CAST(sum(a.best[1]) OVER (PARTITION BY c.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best[1]) OVER () AS BIGINT) AS inertia, sha256(list_aggregate(c.v, 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN x USING (r) JOIN c{rounds} AS c ON c.cluster = a.best[2]
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the other sources and the whole of its language."""
    return divergence.audited(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
of_lang AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM c GROUP BY lang, term),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(total.total, 0) + size.v) AS HUGEINT) AS p
  FROM groups AS g JOIN kept AS k ON k.lang = g.lang JOIN size ON size.lang = g.lang
  LEFT JOIN total ON total.lang = g.lang AND total.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT of_lang.lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (total + size.v) AS HUGEINT) AS q FROM of_lang JOIN size USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sums.value, 0) AS BIGINT) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST(((p.p - q.q) * (p.p - q.q)) // q.q AS BIGINT)
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and all spans of secrets in every document."""
    found = secrets.with_spans(table(spark, sf_dir, "documents"), ["doc_id"])
    counts = [F.size(F.filter("_base", (lambda n: lambda x: x["kind"] == n)(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(secrets.PATTERNS)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.spans_text("_base"), 256).alias("base_sha256"), secrets.spans_text("_spans").alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_bpe_round_trip, op3_simhash, op4_pii, op5_bottom_k, op6_quality_rules, op7_chat_formatting, op8_best_fit_packing, op9_language_id, op10_lm_scoring,
    op11_centroid_clustering, op12_source_divergence, op13_secret_scans)}
SQL = {"op6_quality_rules": OP6_SQL, "op11_centroid_clustering": op11_sql(), "op12_source_divergence": OP12_SQL}
