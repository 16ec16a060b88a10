"""URL filters: pattern rules found through their rarest literal token, and host/path rules. DataFrame functions only.

A pattern rule is text in which ``*`` stands for any run of characters and ``^`` for one separator (anything but a
letter or digit) or an end of the URL; every other character stands for itself, case-insensitively. A run of letters
and digits in the rule that touches neither ``*`` nor an open end is a *literal token*: every URL that fits has it as
a whole token. Each rule is filed under the one of its tokens that the fewest URLs hold (counted over all of them);
a URL's own tokens fetch the rules to try, and only those run as regular expressions. Rules without such a token are
tried on every URL.

Lists of up to ``LITERAL_RULES`` rules are held in the plan, as an index over hashes of tokens and hosts, and nothing is
shuffled. Longer lists are tables: different URLs' tokens, and the ends of their hosts, are joined with the rules filed
under them, and the result goes back to the rows by URL. Both ways give the same results, for any number of rules.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, whole

#: Default block patterns: hosts and words of spam, betting and tracking.
BLOCK_PATTERNS = (
    "^casino^",
    "^poker^",
    "^free-bets^",
    "^cheap-pills^",
    "^viagra^",
    "^payday-loans^",
    "^ads-track^",
    "^adserver^",
    "^xxx^",
    "^porn^",
)

#: Rules of a kind that are held in the plan as literals; longer lists are joined as tables.
LITERAL_RULES = 20_000


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule_regex(pattern: str) -> str:
    """The Java regular expression of a pattern rule, over a lower-cased URL."""
    return "(?s)" + "".join(".*" if c == "*" else "(?:[^a-z0-9]|^|$)" if c == "^" else c if re.fullmatch(r"\w", c, re.A) else "\\" + c for c in pattern.lower())


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every fitting URL holds whole: runs of letters and digits bounded by other literals or ``^``."""
    p = pattern.lower()
    return sorted({m[0] for m in re.finditer(r"[a-z0-9]+", p) if m.start() > 0 and m.end() < len(p) and p[m.start() - 1] != "*" and p[m.end()] != "*"})


def url_tokens(url: Column) -> Column:
    """Distinct tokens (runs of a-z and 0-9) of a URL, lower-cased."""
    return F.array_distinct(F.split(F.lower(url), "[^a-z0-9]+"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased. Path: from there up to ``? #`` or the end. Both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(`{0}`, instr(`{0}`, '://') + 3)".format("__u"))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def token_counts(urls: DataFrame, url_col: str, tokens: list[str]) -> dict[str, int]:
    """How many rows of ``urls`` hold each of ``tokens``; at most one number a token comes to the driver."""
    if not tokens:
        return {}
    found = urls.select(F.explode(F.array_intersect(url_tokens(F.col(url_col)), F.array(*map(F.lit, tokens)))).alias("t")).groupBy("t").count()
    return {t: 0 for t in tokens} | {r["t"]: r["count"] for r in found.collect()}


def host_ends(host: Column) -> Column:
    """A host and what is left of it without its first label, without its first two, and so on."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def _buckets(rows: list[dict], key: str, kind: str) -> tuple[Column, int]:
    """A literal hash table of ``rows`` by ``key``, and its number of buckets."""
    buckets: list[list[dict]] = [[] for _ in range(1 << (2 * len(rows)).bit_length())]
    for r in rows:
        buckets[zlib.crc32(r[key].encode()) % len(buckets)].append(r)
    # Foldable: Spark turns it into one literal when it optimises the plan.
    return F.from_json(F.lit(json.dumps(buckets)), f"array<array<{kind}>>"), len(buckets)


def _under(table: tuple[Column, int], key: str, value: Column) -> Column:
    return F.filter(F.get(table[0], F.crc32(value.cast("binary")).cast("bigint") % table[1]), lambda r: r[key] == value)


def _tried(always: list[int], fetched: Column, res: Column) -> Column:
    """Numbers of the fetched rules, and of those that are always tried, whose regular expressions fit, in order."""
    return F.filter(F.array_sort(F.concat(fetched, F.array(*map(F.lit, always)).cast("array<int>"))), lambda i: F.regexp(F.col("__low"), F.get(res, i)))


def _literal_patterns(df: DataFrame, rules: list[dict]) -> Column:
    """The first pattern rule that fits, by a literal index over the rarest tokens."""
    counts = token_counts(df, "__u", sorted({t for r in rules for t in r["t"]}))
    filed = [{"t": min(r["t"], key=lambda t: (counts[t], t)), "i": i} for i, r in enumerate(rules) if r["t"]]
    index = _buckets(filed, "t", "struct<t:string,i:int>")
    res, names = (F.from_json(F.lit(json.dumps([r[k] for r in rules])), "array<string>") for k in ("re", "p"))
    fetched = F.flatten(F.transform(url_tokens(F.col("__low")), lambda t: F.transform(_under(index, "t", t), lambda r: r["i"])))
    return F.get(names, F.get(_tried([i for i, r in enumerate(rules) if not r["t"]], fetched, res), F.lit(0)))


def _joined_patterns(urls: DataFrame, rules: list[dict]) -> DataFrame:
    """(__u, pattern) of the URLs (__u, __low), each once, that a pattern rule fits: the first; rules are a table joined by token."""
    spark = urls.sparkSession
    table = spark.createDataFrame([(i, r["p"], r["re"], r["t"]) for i, r in enumerate(rules)], "i int, p string, re string, t array<string>")
    held = urls.select("__u", "__low", F.explode(url_tokens(F.col("__low"))).alias("token"))
    own = table.select("i", F.explode("t").alias("token"))
    counts = held.join(own.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    filed = own.join(counts, "token", "left").groupBy("i").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("x")).select("i", F.col("x.token").alias("token"))
    hits = held.join(filed.join(table.select("i", "re"), "i"), "token").filter(F.regexp("__low", F.col("re"))).select("__u", "i")
    always = [i for i, r in enumerate(rules) if not r["t"]]
    if always:
        res = F.from_json(F.lit(json.dumps([rules[i]["re"] for i in always])), "array<string>")
        first = F.get(_tried(list(range(len(always))), F.array().cast("array<int>"), res), F.lit(0))
        hits = hits.unionByName(urls.select("__u", F.get(F.array(*map(F.lit, always)), first).alias("i")).filter("i is not null"))
    return hits.groupBy("__u").agg(F.min("i").alias("i")).join(table.select("i", F.col("p").alias("pattern")), "i").select("__u", "pattern")


def _literal_hosts(rules: list[dict]) -> Column:
    """struct(n, x, v) of the longest host rule that fits __host and __path, by a literal index over hosts."""
    index = _buckets(rules, "h", "struct<h:string,p:string,n:int,x:string,v:string>")
    fits = lambda s: F.filter(_under(index, "h", s), lambda r: F.startswith(F.col("__path"), r["p"]))
    found = F.flatten(F.transform(host_ends(F.col("__host")), lambda s: F.transform(fits(s), lambda r: F.struct(r["n"].alias("n"), r["x"].alias("x"), r["v"].alias("v")))))
    return F.array_max(found)


def _joined_hosts(urls: DataFrame, rules: list[dict]) -> DataFrame:
    """(__u, best) of the URLs (__u, __host, __path), each once, that a host rule fits; rules are a table joined by host."""
    table = urls.sparkSession.createDataFrame([(r["h"], r["p"], r["n"], r["x"], r["v"]) for r in rules], "h string, p string, n int, x string, v string")
    ends = urls.select("__u", "__path", F.explode(host_ends(F.col("__host"))).alias("h"))
    return ends.join(table, "h").filter(F.startswith(F.col("__path"), F.col("p"))).groupBy("__u").agg(F.max(F.struct("n", "x", "v")).alias("best"))


def filter_urls(pages: DataFrame, patterns: Sequence[str] = BLOCK_PATTERNS, host_rules: Sequence[HostRule] = (), url_col: str = "url", literal_rules: int = LITERAL_RULES) -> DataFrame:
    """Adds host, path, rule, verdict and pattern to every row of ``pages``; no shuffle but the count of rule tokens, with lists of up to ``literal_rules``.

    verdict: that of the longest host rule that fits (``rule`` is its text; of equal texts the later verdict by name);
    else ``block`` if a pattern rule fits (``pattern`` is the first in order), else ``allow``. Existing columns of these
    names are replaced; all others stay. Null or empty URLs and URLs without ``://`` have an empty host and path, and
    the verdict of the rules that fit that. URLs are used whole, however long, line breaks included. Equal rows are
    judged alike and stay repeated. With no patterns every verdict outside the host rules is ``allow``; an empty table
    gives no rows.
    """
    own = ("host", "path", "rule", "verdict", "pattern")
    url = F.col("__u")
    df = pages.select(whole(pages), F.col(f"`{url_col}`").alias("__u"))
    rules = [{"p": p, "re": rule_regex(p), "t": literal_tokens(p)} for p in dict.fromkeys(patterns)]
    hosts = [{"h": r.host.lower(), "p": r.path, "n": len(r.text), "x": r.text, "v": r.verdict} for r in dict.fromkeys(host_rules)]

    def parts(df: DataFrame) -> DataFrame:
        host, path = host_and_path(url)
        return df.withColumns({"__host": host, "__path": path, "__low": F.coalesce(F.lower(url), F.lit(""))})

    df = parts(df)
    names = {"pattern": F.lit(None).cast("string"), "best": F.lit(None).cast("struct<n:int,x:string,v:string>")}
    if 0 < len(rules) <= literal_rules:
        names["pattern"] = _literal_patterns(df, rules)
    if 0 < len(hosts) <= literal_rules:
        names["best"] = _literal_hosts(hosts)
    if max(len(rules), len(hosts)) > literal_rules:
        urls = parts(df.select(F.coalesce("__u", F.lit("")).alias("__u")).distinct())
        found = urls.select("__u")
        if len(rules) > literal_rules:
            found = found.join(_joined_patterns(urls, rules), "__u", "left")
            names["pattern"] = F.col("__found.pattern")
        if len(hosts) > literal_rules:
            found = found.join(_joined_hosts(urls, hosts), "__u", "left")
            names["best"] = F.col("__found.best")
        # Written: the join back has shuffles of its own, whose hot URLs Spark splits.
        found = cut(found, "url-verdicts")
        found = found.select(F.col("__u").alias("__k"), F.struct(*(c for c in found.columns if c != "__u")).alias("__found"))
        df = df.join(found, F.coalesce("__u", F.lit("")) == F.col("__k"), "left")
    df = df.withColumns({"pattern": names["pattern"], "__best": names["best"], "host": F.col("__host"), "path": F.col("__path")})
    said = F.coalesce(F.col("__best.v"), F.when(F.col("pattern").isNotNull(), "block").otherwise("allow"))
    return df.withColumns({"rule": F.col("__best.x"), "verdict": said}).select(*(F.col("row")[c].alias(c) for c in pages.columns if c not in own), *own)
