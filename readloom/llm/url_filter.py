"""URL allow and block lists (operator 2).

A trie over reversed host labels, each host with a trie over its rules' path segments, is
built once on the driver, broadcast, and walked for every URL in Arrow batches.

A rule ``host/path`` fits its host and all subdomains if the URL's path starts with the rule's
path. The longest fitting rule wins (characters of host and path together); at equal length
the rule with more host labels, then block over allow. Without a fitting rule the verdict is
``default_verdict``.

Only a rule list of at most ``MOST_TRIE_RULES`` entries and ``MOST_TRIE_CHARS`` characters is broadcast,
84 MB of trie; beyond that the same answer comes from equi-joins: of the URLs' host suffixes with the
lengths of paths that each rule host has, and of the URLs' path starts of these lengths with the rules.

Defined results: a null URL, or one without ``://``, has empty host and path and fits no rule;
an empty path fits only rules without a path. Rows are judged one by one, so repeated rows
get equal results; extra columns pass through and only result columns of the same name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A rule takes up to 2,090 bytes of trie with its characters (measured, every rule on a host and path of its own).
MOST_TRIE_RULES, MOST_TRIE_CHARS = 40_000, 4_000_000

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@dataclass
class _Paths:
    """Rules of one host below one run of whole segments."""

    below: dict = field(default_factory=dict)
    partial: dict = field(default_factory=dict)  # length: {start of the next segment: (rank, verdict, rule)}, the best of each start


@dataclass
class _Hosts:
    below: dict = field(default_factory=dict)
    paths: _Paths | None = None


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


class UrlTrie:
    """Longest-match lookup of (host, path) among allow and block rules."""

    def __init__(self, rules):
        self.root = _Hosts()
        for verdict, rule in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            host, path = split_rule(rule)
            node = self.root
            labels = host.split(".") if host else []
            for label in reversed(labels):
                node = node.below.setdefault(label, _Hosts())
            node.paths = node.paths or _Paths()
            spot, parts = node.paths, path.split("/")
            for part in parts[:-1]:
                spot = spot.below.setdefault(part, _Paths())
            same, rank = spot.partial.setdefault(len(parts[-1]), {}), (len(host) + len(path), len(labels), verdict == "block")
            if parts[-1] not in same or rank > same[parts[-1]][0]:
                same[parts[-1]] = rank, verdict, host + path

    def find(self, host: str, path: str):
        """(verdict, rule) of the longest fitting rule, or None."""
        best = None
        node, labels, segments = self.root, host.split("."), path.split("/")
        at = len(labels)
        while node is not None:
            if node.paths is not None:
                spot = node.paths
                for segment in segments:
                    # Rules that end here have few lengths, however many they are: one look a length.
                    for n, starts in spot.partial.items():
                        got = starts.get(segment[:n]) if n <= len(segment) else None
                        if got is not None and (best is None or got[0] > best[0]):
                            best = got
                    spot = spot.below.get(segment)
                    if spot is None:
                        break
            at -= 1
            node = node.below.get(labels[at]) if at >= 0 else None
        return best and best[1:]


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def judge_urls(df: DataFrame, rules=RULES, url: str = "url", default_verdict: str = "allow", most_trie_rules: int = MOST_TRIE_RULES) -> DataFrame:
    """Add host, path, rule and verdict to every row. ``rules``: a list of (verdict, rule), or a DataFrame of them."""
    df = with_host_and_path(df, url)
    if not isinstance(rules, DataFrame):
        rules = list(rules)
        if len(rules) > most_trie_rules or sum(len(r) for _, r in rules) > MOST_TRIE_CHARS:
            rules = df.sparkSession.createDataFrame(rules, "verdict string, rule string")
    if isinstance(rules, DataFrame):
        rules = rules.select("verdict", "rule").where("verdict is not null and rule is not null").distinct()
        n, chars = rules.agg(F.count("*"), F.coalesce(F.sum(F.length("rule")), F.lit(0))).first()
        if n > most_trie_rules or chars > MOST_TRIE_CHARS:
            return _judge_by_join(df, rules, default_verdict)
        rules = [(r.verdict, r.rule) for r in rules.collect()]
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("verdict string, rule string")
    def walk(host, path):
        import pandas as pd

        find = trie.value.find
        got = [find(h, p) or (None, None) for h, p in zip(host, path)]
        return pd.DataFrame(got, columns=["verdict", "rule"], dtype=object)

    return df.withColumn("_found", walk("host", "path")).withColumns({"rule": F.col("_found.rule"), "verdict": F.coalesce("_found.verdict", F.lit(default_verdict))}).drop("_found")


def _judge_by_join(df: DataFrame, rules: DataFrame, default_verdict: str) -> DataFrame:
    """The same answer for rule lists of any size: each distinct (host, path) meets the rules of its host suffixes."""
    slash = F.instr("rule", "/")
    parts = rules.select(
        "verdict",
        F.lower(F.when(slash > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule"))).alias("rule_host"),
        F.when(slash > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("rule_path"),
    )
    pages = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = pages.withColumn("rule_host", F.explode(F.concat(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")), F.array(F.lit("")))))
    # A rule host's paths have few lengths, however many rules it has: each URL asks once a length.
    lengths = parts.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    starts = suffixes.join(lengths, "rule_host").withColumn("n", F.explode("lengths")).where(F.col("n") <= F.length("path"))
    fit = starts.withColumn("rule_path", F.substring("path", F.lit(1), F.col("n"))).join(parts, ["rule_host", "rule_path"])
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.when(F.col("rule_host") == "", 0).otherwise(F.size(F.split("rule_host", r"\."))), F.col("verdict") == "block")
    best = fit.groupBy(F.col("host").alias("_h"), F.col("path").alias("_p")).agg(F.max_by(F.struct("verdict", F.concat("rule_host", "rule_path").alias("rule")), rank).alias("_found"))
    out = df.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    return out.withColumns({"rule": F.col("_found.rule"), "verdict": F.coalesce("_found.verdict", F.lit(default_verdict))}).drop("_found", "_h", "_p")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the fixed rules."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH parts AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT page_id, max_by(verdict, length(rule_host || rule_path)) AS verdict, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN best USING (page_id)
"""
