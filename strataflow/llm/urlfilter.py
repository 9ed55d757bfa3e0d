"""URL verdicts: longest-prefix rules and, where none fits, a cascade of Bloom filters over hosts.

The cascade is exact for every key of the universe it was built for.  Level 1 encodes the listed keys; level 2 encodes
the other keys that level 1 lets through by mistake; level 3 encodes the listed keys that level 2 lets through; and so
on until a level lets nothing through.  A key's membership is the parity of the first level that refuses it.  Levels
are arrays of 64-bit words, made by grouped bit-or, so a lookup is a few bit tests in generated code and pages are
neither joined nor shuffled.  DataFrame functions only.

Size: level 1 has ``log2(unlisted / listed) / ln 2`` bits per listed key or so, later ones two bits or fewer per key they encode.  A
cascade is held to ``max_bytes``, checked before each level is made.  A longer list is split by key hash into several
cascades, each within the bound, and the pages of each part are judged by their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import table
from strataflow.session import settle

# (verdict, rule) of the contract: host, then path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    raw = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls.  Equal lengths: the rule first in text order."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(what)).otherwise(verdict)
    return found, verdict


@dataclass(frozen=True)
class Level:
    words: int
    probes: int
    bits: Column  # array of 64-bit words

    def holds(self, key: Column, number: int) -> Column:
        test = F.lit(True)
        for at in positions(key, number, self.words, self.probes):
            word = F.get(self.bits, F.shiftright(at, 6).cast("int"))
            test = test & (F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return test


def positions(key: Column, level: int, words: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(p)), F.lit(words * 64).cast("long")) for p in range(probes)]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def member(self, key: Column) -> Column:
        """Whether a key of the universe is listed; a null key is not."""
        key = F.coalesce(key.cast("string"), F.lit(""))
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            answer = F.when(~self.levels[number - 1].holds(key, number), F.lit(number % 2 == 0)).otherwise(answer)
        return answer

    @property
    def bytes(self) -> int:
        return sum(8 * level.words for level in self.levels)


def _level(keys: DataFrame, count: int, rate: float, number: int) -> Level:
    """A Bloom filter over ``count`` keys with about the given rate of false positives."""
    bits = max(64.0, count * math.log(1 / rate) / math.log(2) ** 2)
    words, probes = math.ceil(bits / 64), max(1, round(bits / max(count, 1) * math.log(2)))
    probes = min(probes, 24)
    at = keys.select(F.explode(F.array(*positions(F.col("key"), number, words, probes))).alias("at"))
    filled = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    every = keys.sparkSession.range(words).select(F.col("id").alias("word"))
    whole = every.join(filled, "word", "left").agg(
        F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).getField("bits").alias("bits"))
    return Level(words, probes, settle(whole, "bloom-level").scalar())


def cascade(universe: DataFrame, max_bytes: int = 64 << 20) -> Cascade:
    """The cascade for a table of (key, listed).

    Keys repeat harmlessly; a key listed in any row is listed; null keys are ignored.  An empty universe or an empty
    list gives a cascade that lists nothing.
    """
    keys = settle(
        universe.where(F.col("key").isNotNull()).groupBy(F.col("key").cast("string").alias("key"))
        .agg(F.coalesce(F.bool_or("listed"), F.lit(False)).alias("listed")), "url-keys")
    size = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("listed").cast("long")), F.lit(0)).alias("listed")).first()
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    n_in, n_out, number, levels, used = size.listed, size.n - size.listed, 1, [], 0
    if not n_in:
        return Cascade(())
    while n_in:
        # The share of the other keys that level 1 may let through.
        rate = min(0.5, math.sqrt(0.5) * n_in / n_out) if number == 1 and n_out else 0.5
        used += math.ceil(max(64.0, n_in * math.log(1 / rate) / math.log(2) ** 2) / 8)
        if used > max_bytes:
            raise ValueError(f"the cascade needs over {max_bytes} bytes; split the list by key hash")
        levels.append(_level(inside, n_in, rate, number))
        # What this level lets through by mistake is what the next one encodes.
        wrong = settle(outside.where(levels[-1].holds(F.col("key"), number)), "url-mistakes")
        inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in
        number += 1
    return Cascade(tuple(levels))


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit("part")), F.lit(parts)).cast("int")


def cascades(universe: DataFrame, max_bytes: int = 64 << 20) -> list[Cascade]:
    """As many cascades as keep each within ``max_bytes``: number p serves the keys whose ``part_of`` is p."""
    size = universe.agg(F.count("*").alias("n"), F.count_if(F.col("listed")).alias("listed")).first()
    # Rows count at least as often as keys, so this is no less than what is needed but for chance, which the third covers.
    odds = max(2.0, (size.n - size.listed) / max(1, size.listed))
    needed = size.listed * ((math.log2(odds) + 0.5) / math.log(2) + 5) / 8
    parts = max(1, math.ceil(needed * 4 / 3 / max_bytes))
    return [cascade(universe if parts == 1 else universe.where(part_of(F.col("key"), parts) == p), max_bytes) for p in range(parts)]


def judge(pages: DataFrame, listed: Cascade | list[Cascade], url: str = "url", key: str = "page_id", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict.  Null urls and urls without ``://`` have an empty host and path.

    With several cascades the urls are read once for each, and every row is judged by one.
    """
    if isinstance(listed, list):
        if len(listed) > 1:
            at = part_of(host_of(F.col(url)), len(listed))
            return reduce(DataFrame.unionAll, [judge(pages.where(at == p), one, url, key, rules) for p, one in enumerate(listed)])
        listed = listed[0]
    parts = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    method = F.when(listed.member(F.col("host")), F.lit("block")).otherwise(F.lit("allow"))
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


def host_list(pages: DataFrame, url: str = "url", least: int = 3) -> DataFrame:
    """(key, listed) for every host: listed are hosts with ``least`` pages or more that use tracking queries more often than the corpus.

    A stand-in for a bought block list that grows with the pages it is read from.  Compared as whole numbers, so nothing is rounded.
    """
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    hosts = settle(pages.groupBy(host_of(F.col(url)).alias("key")).agg(
        F.count("*").alias("pages"), F.sum(address.contains("utm_").cast("long")).alias("tracked")), "hosts")
    total = hosts.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum("tracked"), F.lit(0)).alias("tracked")).first()
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return hosts.select("key", (
        (F.col("pages") >= least) & (wide("tracked") * F.lit(total.pages) > wide("pages") * F.lit(total.tracked))).alias("listed"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the contract's rules, else by the cascade over the hosts of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, cascades(host_list(pages)))


OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(coalesce(url, ''), '://')
              THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), listed AS (
  SELECT host FROM parts GROUP BY host
  HAVING count(*) >= 3 AND sum(CASE WHEN contains(url, 'utm_') THEN 1 ELSE 0 END) * (SELECT count(*) FROM parts)
    > count(*) * (SELECT sum(CASE WHEN contains(url, 'utm_') THEN 1 ELSE 0 END) FROM parts)
), ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
