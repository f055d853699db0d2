"""URL filters: path-template trees judged by labelled purity.

Every host has a tree of path segments. Going down from the host, a segment that makes up enough of its parent's pages
stays as it is, and so does one of a few without digits; all others of that parent become one wildcard, at every depth.
Templates of a host that differ in one segment are siblings; those with labelled pages whose
share of bad ones doesn't differ significantly from all siblings' share are merged and judged on their pooled counts. Pages are labelled by explicit rules or else by terms of
the url: a page with a term is bad, one without is good; the purity of a template is its share of bad pages, smoothed towards
a small share, so that one bad page among others blocks nothing. An explicit rule's verdict always comes first.

Everything is DataFrame operations on counts of distinct (host, path), which are combined before each shuffle. Totals and
kept segments are written before they are joined, so a host with very many pages is split by the skew join.

Defined cases: a null url, or one without ``://``, has an empty host and path and is judged like others of that kind;
repeated pages get a row each; very long urls are read whole, with a round for each level of the deepest path; an empty table
gives no rows; further columns are ignored; without rules and terms nothing is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import written

#: Pages and share of its parent's pages that a segment needs to stay.
MIN_PAGES, MIN_SHARE = 5, 0.05
#: Different segments below which those without digits all stay.
FEW_KINDS = 20
#: A template's purity starts as if ``SMOOTHING`` labelled pages had a share ``PRIOR`` of bad ones; it is blocked above
#: ``REJECT``. Siblings' shares may differ by ``ERRORS`` standard errors.
SMOOTHING, PRIOR, REJECT, ERRORS = 1.0, 0.1, 0.5, 1.96
# Terms whose presence in a host or path labels a page as bad.
TERMS = ("adult", "bet", "bets", "betting", "casino", "gambling", "porn", "poker", "sex", "spam", "viagra", "warez", "xxx")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict (allow or block) for a host, its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        own = (F.col("host") == self.host) | F.col("host").endswith("." + self.host)
        return own & F.col("path").startswith(self.path)


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    rest = F.coalesce(F.get(F.split(F.col(f"`{url}`"), "://", 2), F.lit(1)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest fitting rule, null if none fits."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.text))
    text = F.coalesce(*[F.when(r.fits(), F.lit(r.text)) for r in order]) if order else F.lit(None).cast("string")
    verdict = F.coalesce(*[F.when(r.fits(), F.lit(r.verdict)) for r in order]) if order else F.lit(None).cast("string")
    return pages.withColumns({"rule": text, "rule_verdict": verdict})


def labelled(paths: DataFrame) -> DataFrame:
    """Adds ``bad`` and ``known`` pages of each path, from its rule or else from its terms."""
    words = F.split(F.concat_ws("/", F.col("host"), F.translate("path", UPPER, LOWER)), "[^a-z0-9]+")
    term = F.arrays_overlap(words, F.array(*map(F.lit, TERMS)))
    bad = F.when(F.col("rule_verdict") == "block", F.lit(True)).when(F.col("rule_verdict") == "allow", F.lit(False)).otherwise(term)
    return paths.withColumns({"bad": F.when(bad, F.col("n")).otherwise(0), "known": F.col("n")})


def templates(paths: DataFrame) -> DataFrame:
    """Adds ``template`` to distinct paths with their pages ``n``: the path of its tree's node.

    Paths that have ended are set aside, so deep levels cost only what their few paths do.
    """
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = written(paths.withColumns({"_parts": parts, "template": F.lit("")}), "url-level")
    ended, i, key = [tree.where(F.size("_parts") == 0).drop("_parts")], 0, ["host", "template"]
    tree = tree.where(F.size("_parts") > 0).withColumn("_s", F.get("_parts", F.lit(0)))
    while not tree.isEmpty():
        counts = written(tree.groupBy(*key, "_s").agg(F.sum("n").alias("c")), "url-segments")
        totals = written(counts.groupBy(*key).agg(F.sum("c").alias("total"), F.count("*").alias("kinds")), "url-totals")
        enough = (F.col("c") >= MIN_PAGES) & (F.col("c") >= MIN_SHARE * F.col("total"))
        enough = enough | ((F.col("kinds") <= FEW_KINDS) & ~F.col("_s").rlike("[0-9]"))
        stays = written(counts.join(totals, key).where(enough).select(*key, "_s", F.lit(True).alias("stays")), "url-stays")
        step = F.when(F.col("stays"), F.col("_s")).otherwise(F.lit("*"))
        tree = written(tree.join(stays, [*key, "_s"], "left").withColumn("template", F.concat_ws("/", "template", step)).drop("stays", "_s"), "url-level")
        i += 1
        ended.append(tree.where(F.size("_parts") == i).drop("_parts"))
        tree = tree.where(F.size("_parts") > i).withColumn("_s", F.get("_parts", F.lit(i)))
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def purities(tree: DataFrame) -> DataFrame:
    """(host, template, purity): from the counts of the template merged with its similar siblings."""
    sums = [F.sum(c).alias(c) for c in ("n", "bad", "known")]
    nodes = written(tree.groupBy("host", "template").agg(*sums), "url-nodes")
    parts = F.split("template", "/")
    place = F.filter(F.sequence(F.lit(0), F.size("_p") - 1), lambda i: ~F.get("_p", i).isin("", "*"))
    spots = nodes.withColumn("_p", parts).withColumn("at", F.explode(place))
    siblings = spots.withColumn("group", F.array_join(F.transform("_p", lambda s, i: F.when(i == F.col("at"), F.lit("*")).otherwise(s)), "/")).drop("_p")
    siblings = written(siblings.where(F.col("known") > 0), "url-siblings")
    key = ["host", "group", "at"]
    pooled = [F.sum(c).alias(f"all_{c}") for c in ("bad", "known")]
    pool = written(siblings.groupBy(*key).agg(*pooled), "url-pool")
    share = F.col("all_bad") / F.col("all_known")
    error = F.sqrt(share * (1 - share) / F.col("known"))
    similar = F.abs(F.col("bad") / F.col("known") - share) <= ERRORS * error
    alike = written(siblings.join(pool, key).where(similar).select(*siblings.columns), "url-alike")
    merged = written(alike.groupBy(*key).agg(*pooled), "url-merged")
    best = alike.join(merged, key).groupBy("host", "template").agg(F.max(F.struct("all_known", "all_bad")).alias("m"))
    best = written(best.select("host", "template", F.col("m.all_known").alias("m_known"), F.col("m.all_bad").alias("m_bad")), "url-best")
    known, bad = F.greatest("known", F.coalesce("m_known", F.lit(0))), F.when(F.coalesce("m_known", F.lit(0)) > F.col("known"), F.col("m_bad")).otherwise(F.col("bad"))
    purity = (bad + F.lit(SMOOTHING * PRIOR)) / (known + F.lit(SMOOTHING))
    return nodes.join(best, ["host", "template"], "left").select("host", "template", purity.alias("purity"))


def judged(pages: DataFrame, keep: list[str], rules: list[Rule], url: str = "url") -> DataFrame:
    """The ``keep`` columns, ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity`` of every page."""
    kept = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]
    seen = parsed(pages.select(*kept, F.col(f"`{url}`").alias("_url")), "_url")
    paths = with_rule(seen.groupBy("host", "path").agg(F.count("*").alias("n")), rules)
    tree = written(templates(labelled(paths)), "url-tree")
    known = written(tree.join(written(purities(tree), "url-purities"), ["host", "template"]).select("host", "path", "rule", "rule_verdict", "template", "purity"), "url-verdicts")
    own = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    out = seen.drop("_url").join(known, ["host", "path"])
    names = [F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*names, "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "template", "purity")
