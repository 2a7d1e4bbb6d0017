"""URL verdicts from host/path rules and, where no rule fits, an exact key list held in a Bloom filter cascade.

Level 0 of the cascade is a Bloom filter of the listed keys. Those keys of the corpus that pass it without being
listed are encoded in level 1; the listed keys that pass level 1 by mistake in level 2; and so on until nobody passes
by mistake. For every key of the universe (all keys of the corpus and all listed keys) the first level that a key
fails decides, and the answer is exact; no row is joined with the list.

The levels are built by DataFrame aggregation (bit_or over words of bits) from the distinct keys. Their size follows
the list, not the corpus: about 1.44 * log2(corpus / list) + 5 bits a listed key. It is known from the counts before a
level is built: up to ``MAX_BITS`` (8 MiB) in all they go into the plan as binary literals; beyond that the verdict
comes from a join with the list instead, with the same rows.

Everything on the way is DataFrame functions. Null urls and urls without "://" have an empty host and path; an empty
key is looked up like any other; null listed keys are ignored; repeated rows get the same verdict; an empty list
blocks nothing; an empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from docindex.llm.scratch import stored

MAX_BITS = 64 << 20
WORD, BYTE = 60, 6  # bits of a collected word, and of a byte of the literal (below 64, so that it reads as ASCII)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Fixed values: (verdict, host, path). A rule fits its host and all subdomains if the url's path starts with its path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return F.when(F.instr(url, "://") > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=tuple(RULES)) -> Column:
    """The longest fitting rule as struct(rule, verdict), null if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


class Level:
    """One Bloom filter: its number, size, hashes a key, and the packed bits."""

    def __init__(self, number: int, keys: int, rate: float):
        self.number = number
        self.hashes = max(1, math.ceil(math.log2(1 / rate)))
        self.bits = max(WORD, math.ceil(keys * 1.44 * math.log2(1 / rate)))
        self.packed = b""

    def positions(self, key: Column) -> list:
        return [F.pmod(F.xxhash64(F.lit(self.number), F.lit(j), key), F.lit(self.bits)) for j in range(self.hashes)]

    def build(self, keys: DataFrame) -> "Level":
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("at"))
        words = (at.groupBy(F.expr(f"at div {WORD}").alias("word"))
                 .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(at % {WORD} AS int))")).alias("value")).collect())  # bits / 60 rows
        packed = bytearray(math.ceil(self.bits / WORD) * (WORD // BYTE))
        for r in words:
            for k in range(WORD // BYTE):
                packed[r["word"] * (WORD // BYTE) + k] = r["value"] >> (BYTE * k) & 63
        self.packed = bytes(packed)
        return self

    def passes(self, key: Column) -> Column:
        out = F.lit(True)
        for at in self.positions(key):
            at = at.cast("int")
            byte = F.ascii(F.substring(F.lit(self.packed), F.floor(at / BYTE).cast("int") + 1, F.lit(1)).cast("string"))
            out = out & (F.getbit(byte.cast("long"), F.pmod(at, F.lit(BYTE))) == 1)
        return out


def cascade(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> list | None:
    """Levels for the distinct keys of ``listed`` (key) over ``universe`` (key), or None when over ``max_bits``."""
    listed = stored(listed.where("key is not null").distinct(), "listed")
    others = stored(universe.where("key is not null").distinct().join(listed, "key", "left_anti"), "others")
    inside, outside = listed, others
    n_in, n_out = inside.count(), outside.count()
    levels: list = []
    while n_in:
        first = not levels
        rate = min(0.5, max(n_in / (math.sqrt(2) * n_out), 1e-9)) if first and n_out else 0.5
        level = Level(len(levels), n_in, rate)
        if sum(x.bits for x in [*levels, level]) > max_bits:
            return None
        levels.append(level.build(inside))
        passed = stored(outside.where(level.passes(F.col("key"))), "passed")
        inside, outside, n_in = passed, inside, passed.count()
    return levels


def is_listed(levels: list, key: Column) -> Column:
    """Exact membership of a key of the universe: the first failed level decides."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(level.passes(key), out).otherwise(F.lit(level.number % 2 == 1))
    return out


def judge(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url", rules=tuple(RULES), max_bits: int = MAX_BITS) -> DataFrame:
    """One row a page: key, host, path, rule, verdict. ``listed`` (key) holds the blocked hosts."""
    parts = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    levels = cascade(listed, parts.select(F.col("host").alias("key")), max_bits)
    if levels is None:
        block = listed.where("key is not null").distinct().withColumn("in_list", F.lit(True))
        parts = parts.join(block, parts["host"] == block["key"], "left").drop(block["key"]).withColumn("in_list", F.coalesce("in_list", F.lit(False)))
    else:
        parts = parts.withColumn("in_list", is_listed(levels, F.col("host")))
    ruled = parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    return ruled.select(key, "host", "path", F.col("r.rule").alias("rule"),
                        F.coalesce("r.verdict", F.when(F.col("in_list"), "block").otherwise("allow")).alias("verdict"))


def insecure_hosts(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Stand-in for a block list, in its schema (key): hosts whose page of the least id is not served over https."""
    first = (pages.where(F.instr(url, "://") > 0).groupBy(host_of(F.col(url)).alias("key")).agg(F.min(F.struct(F.col(key), F.col(url))).alias("m")))
    return first.where(~F.col(f"m.{url}").startswith("https://")).select("key")
