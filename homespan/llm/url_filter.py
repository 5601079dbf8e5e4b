"""URL rules in a trie over reversed host labels and path segments."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Rules are sent to every task up to this many characters in all; beyond it they are joined.
BROADCAST_CHARS = 64 << 20
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    rest = F.substring_index(_after(url), "/", 1)
    return F.translate(F.substring_index(F.substring_index(rest, "?", 1), "#", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    plain = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    return F.when(F.locate("/", plain) > 0, F.substr(plain, F.locate("/", plain))).otherwise("")


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


class RuleTrie:
    """Longest-match lookup. A node's children are host labels from the right, then path segments.

    A rule's last path segment may be a part of a url's segment (a rule fits if the path starts with the rule's
    path), so it is kept at the node of the segment before, by its text. Of all rules that fit, the one with most host
    labels wins, then the longest path, then block over allow.
    """

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("h", label), {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(("p", segment), {})
            ends = node.setdefault("ends", {})
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (host + path, verdict)

    def _best_path(self, node: dict, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path.split("/"):
            ends = node.get("ends")
            if ends:
                for n in range(len(segment), -1, -1):
                    if segment[:n] in ends:
                        best = ends[segment[:n]]
                        break
            node = node.get(("p", segment))
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict), or None if no rule fits."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            best = self._best_path(node, path) or best
        return best


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, default: str = DEFAULT,
               broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict (the rule's, else ``default``).

    ``rules`` are (verdict, host, path) rows, a list or a table of these columns; a rule holds for its host and all
    subdomains if the url's path starts with the rule's path. Host names in rules are lower case. Tables are counted
    first: up to ``broadcast_chars`` they become a trie in every task, beyond that each url is joined by all its
    host suffixes and path prefixes. Null urls have no host, path or rule. Repeated pages give repeated
    rows; other columns are not read.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    rules = rules.select("verdict", "host", "path").where("verdict is not null and host is not null and path is not null")
    chars = rules.agg(F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0))).first()[0]
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if chars > broadcast_chars:
        return _joined(urls, rules, default)
    trie = spark.sparkContext.broadcast(RuleTrie([tuple(r) for r in rules.collect()]))

    @F.arrow_udf("rule string, verdict string")
    def matched(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        match = trie.value.match
        found = [match(h, p) or (None, default) for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)],
                                          ["rule", "verdict"])

    return urls.withColumn("m", matched.asNondeterministic()("host", "path")).select(
        "page_id", "host", "path", "m.rule", "m.verdict")


def _joined(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for rule tables of any size: distinct urls meet the rules at each host suffix and path prefix."""
    distinct = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda n: F.array_join(F.slice(labels, -n, n), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.left("path", n))
    keys = distinct.select("host", "path", F.explode(suffixes).alias("rule_host")).select(
        "*", F.explode(prefixes).alias("rule_path"))
    wanted = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    order = F.struct(F.size(F.split("rule_host", r"\.")), F.length("rule_path"), "verdict")
    best = keys.join(wanted, ["rule_host", "rule_path"]).groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("m"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "m.rule", F.coalesce("m.verdict", F.lit(default)).alias("verdict"))
