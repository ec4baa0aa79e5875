"""Operator 7: URL filters by a Bloom filter cascade, in built-in SQL functions only.

A rule is (verdict, host, path prefix). Its key is host + path, e.g. ``example.com/en/``. A URL can
match few keys: the suffixes of its host by labels times the prefixes of its path that have the
length of some rule's path. Over the table, those candidate keys form the complete key universe.

The cascade holds the rules' keys exactly over that universe. Level 1 is a Bloom filter of the
listed keys, level 2 one of the universe's keys that level 1 takes wrongly, level 3 one of the
listed keys that level 2 takes wrongly, and so on until a level makes no error. A key is listed if
the first level that refuses it has an even number. A second cascade holds the keys to block among
the listed ones. Level 1 has enough bits per listed key for the expected number of false positives
over the whole universe to be below the number of listed keys, so all levels together are
bounded by the size of the rule list (times the logarithm of the universe's), never by the table;
they are literals in the plan and nothing is joined.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no rule. Of
the rules that fit, the longest key wins, of equally long ones that with the longer host. A URL
that fits no rule is in no list and gets the default verdict. Rows are judged one by one, so
repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


class Level(NamedTuple):
    words: tuple[int, ...]  # 64 bits each
    bits: int
    hashes: int
    salt: int


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def candidate_keys(host: Column, path: Column, rules) -> Column:
    """Keys that a URL can match, the longest first: array of (n, hn, key)."""
    labels = max(len(r.host.split(".")) for r in rules)
    lengths = sorted({len(r.path) for r in rules})
    out = []
    for k in range(1, labels + 1):
        enough = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) >= k - 1
        suffix = F.substring_index(host, ".", -k)
        for n in lengths:
            key = F.concat(suffix, F.substr(path, F.lit(1), F.lit(n)))
            fits = enough & (F.length(path) >= n)
            out.append(
                F.when(
                    fits,
                    F.struct(F.length(key).alias("n"), F.length(suffix).alias("hn"), key.alias("key")),
                )
            )
    return F.reverse(F.array_sort(F.filter(F.array(*out), lambda x: x.isNotNull())))


def _positions(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(salt * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def _takes(level: Level, key: Column) -> Column:
    """Whether a level's Bloom filter takes a key: all its bits are set."""
    words = F.array(*(F.lit(w).cast("bigint") for w in level.words))
    out = F.lit(True)
    for at in _positions(key, level.bits, level.hashes, level.salt):
        word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
        out = out & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
    return out


def contains(levels: list[Level], key: Column) -> Column:
    """Exact membership of a key of the universe: parity of the first level that refuses it."""
    out = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        out = F.when(_takes(levels[k], key), out).otherwise(F.lit(k % 2 == 1))
    return out


def _filter(keys: DataFrame, n: int, per_key: float, salt: int) -> Level:
    """A Bloom filter of ``n`` keys; its bits come to the driver as 64-bit words."""
    bits = max(64, 64 * math.ceil(n * per_key / 64))
    hashes = max(1, min(24, round(per_key * math.log(2))))
    at = F.explode(F.array(*_positions(F.col("key"), bits, hashes, salt))).alias("at")
    words = (
        keys.select(at)
        .groupBy(F.floor(F.col("at") / 64).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 64) as int))")).alias("bits"))
        .collect()
    )
    found = {r.w: r.bits for r in words}
    return Level(tuple(found.get(w, 0) for w in range(bits // 64)), bits, hashes, salt)


def cascade(listed: DataFrame, universe: DataFrame, max_levels: int = 40) -> list[Level]:
    """Levels that hold the keys of ``listed`` exactly over ``universe``; both (key), distinct.

    The keys to be kept out at one level are those the next encodes; each level looks at the
    errors of the one before only.
    """
    n_in, n_all = listed.count(), universe.count()
    if not n_in:
        return []
    # few enough false positives over the universe that level 2 is no larger than level 1
    per_key = 1.44 * math.log2(max(2.0, 2 * n_all / n_in))
    levels: list[Level] = []
    inside, outside, n = listed, universe.join(listed, "key", "left_anti"), n_in
    while True:
        level = _filter(inside, n, per_key, len(levels) + 1)
        levels.append(level)
        wrong = outside.where(_takes(level, F.col("key")))
        n = wrong.count()
        if not n:
            return levels
        if len(levels) >= max_levels:
            raise ValueError("the cascade does not end; raise the bits per key")
        inside, outside, per_key = wrong, inside, 1.44 * 2


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced."""
    spark = pages.sparkSession
    host, path = url_parts(url)
    parts = pages.select(host.alias("host"), path.alias("path"))
    universe = (
        parts.select(F.explode(candidate_keys(F.col("host"), F.col("path"), rules)["key"]).alias("key"))
        .distinct()
    )
    listed = spark.createDataFrame([(r.key,) for r in rules], "key string").distinct()
    universe = universe.union(listed).distinct()
    blocked = spark.createDataFrame([(r.key,) for r in rules if r.verdict == "block"], "key string")
    is_rule = cascade(listed, universe)
    is_block = cascade(blocked.distinct(), listed)  # asked for listed keys only
    keys = candidate_keys(F.col("host"), F.col("path"), rules)
    hits = F.filter(keys, lambda x: contains(is_rule, x["key"]))
    rule = F.get(hits, F.lit(0))["key"]
    verdict = F.when(F.col("rule").isNull(), default).otherwise(
        F.when(contains(is_block, F.col("rule")), "block").otherwise("allow")
    )
    return (
        pages.withColumn("host", host)
        .withColumn("path", path)
        .withColumn("rule", rule)
        .withColumn("verdict", verdict)
    )
