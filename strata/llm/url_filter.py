"""URL verdicts by host and path rules, and by a Bloom filter cascade for listed keys.

The cascade answers exactly for every key of a universe that is known beforehand. Level 0 encodes the listed keys, level
1 those other keys of the universe that level 0 takes for listed, level 2 the listed keys that level 1 takes for
others, and so on until a level is wrong for none. A key is listed if the first level that denies it is odd. All is
built-in expressions: levels are literals in the plan, so judging rows needs no join.

The literals are bounded: keys are dealt by hash over as many segments as keep a segment's levels below
`segment_bytes`, and the segments are applied one after the other, each to its own keys.

Defined cases: null urls and urls without `://` have empty host and path; a null key is not listed; repeated keys count
once; an empty list denies all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, free_name, saved

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(text: str) -> list[Rule]:
    """Rules like `block net/, allow example.net/en/`: a verdict, a host and a path from its first slash on."""
    rules = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        verdict, _, target = part.partition(" ")
        host, slash, rest = target.strip().partition("/")
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"no rule: {part!r}")
        rules.append(Rule(verdict, host, slash + rest))
    return rules


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, rule.name) if name is None else name.when(fits, rule.name)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


@dataclass(frozen=True)
class Level:
    """A Bloom filter: its number of 32-bit words, its words as text, its hashes."""

    n_words: int
    words: str
    n_hashes: int
    seed: int

    def _bits(self, key: Column) -> list[Column]:
        n_bits = F.lit(self.n_words * 32).cast("bigint")
        first, second = (F.pmod(F.xxhash64(F.lit(seed), key), n_bits) for seed in (self.seed, self.seed + 1))
        return [F.pmod(first + second * i, n_bits) for i in range(self.n_hashes)]

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded into one literal
        tests = [F.get(words, F.shiftright(bit, 5).cast("int")).bitwiseAND(_power(bit)) != 0 for bit in self._bits(key)]
        return _all(tests)


def _power(bit: Column) -> Column:
    """2 to the place of the bit in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(32)).cast("int"))


def _all(tests: list[Column]) -> Column:
    whole = tests[0]
    for test in tests[1:]:
        whole = whole & test
    return whole


def build_level(keys: DataFrame, n_keys: int, false_rate: float, seed: int) -> Level:
    """A filter of the keys of column `key`. Its size is fixed by n_keys; only its words come to the driver."""
    n_hashes = max(1, round(-math.log2(false_rate)))
    n_words = max(1, math.ceil(n_keys * n_hashes / math.log(2) / 32))
    shape = Level(n_words, "", n_hashes, seed)
    bits = keys.select(F.explode(F.array(*shape._bits(F.col("key")))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 5).cast("int").alias("word")).agg(F.bit_or(_power(F.col("bit"))).alias("value"))
    filled = [0] * n_words
    for word, value in words.collect():
        filled[word] = value
    return Level(n_words, ",".join(map(str, filled)), n_hashes, seed)


@dataclass(frozen=True)
class Cascade:
    """segments: for each the levels in order."""

    segments: list[list[Level]]

    def _segment(self, key: Column) -> Column:
        return segment_of(key, len(self.segments))

    def listed(self, key: Column, segment: int = 0) -> Column:
        """Whether a key of the universe, of this segment, is listed."""
        answer = F.lit(len(self.segments[segment]) % 2 == 1)
        for depth in range(len(self.segments[segment]) - 1, -1, -1):
            answer = F.when(self.segments[segment][depth].holds(key), answer).otherwise(F.lit(depth % 2 == 1))
        return F.coalesce(answer, F.lit(False)) & key.isNotNull()

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """Add whether the key is listed: one projection for a segment, each written before the next."""
        df = df.withColumn(name, F.lit(False))
        for segment in range(len(self.segments)):
            own = self._segment(key) == segment
            marked = F.when(own, self.listed(key, segment)).otherwise(F.col(name)) if len(self.segments) > 1 else self.listed(key)
            df = df.withColumn(name, marked)
            if segment + 1 < len(self.segments):
                df = saved(df, "segment")
        return df


def segment_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(n))


def build_cascade(universe: DataFrame, false_rate: float = 0.02, segment_bytes: int = 4 << 20) -> Cascade:
    """universe: key, listed; every key once. Levels are built until none of the keys is judged wrongly."""
    keys = universe.where(F.col("key").isNotNull())
    n_listed = keys.where("listed").count()
    word_bytes = 11  # of a 32-bit word as decimal text
    bits = n_listed * -math.log2(false_rate) / math.log(2)
    n_segments = max(1, math.ceil(bits / 32 * word_bytes * 1.5 / segment_bytes))
    segments = []
    for segment in range(n_segments):
        own = keys.where(segment_of(F.col("key"), n_segments) == segment) if n_segments > 1 else keys
        inside, outside, levels = own.where("listed").select("key"), own.where("not listed").select("key"), []
        n_inside = inside.count() if n_segments > 1 else n_listed
        while n_inside:
            levels.append(build_level(inside, n_inside, false_rate if not levels else 0.5, 1000 + 2 * len(levels)))
            wrong = saved(outside.where(levels[-1].holds(F.col("key"))), "false-positives")
            inside, outside, n_inside = wrong, inside, wrong.count()
        segments.append(levels)
    return Cascade(segments)


def judge_urls(pages: DataFrame, url: str, rules: list[Rule], listed_share: float = 0.25) -> DataFrame:
    """Add host, path, rule and verdict.

    Where no rule fits, a host is judged by the company it keeps: hosts of which at least `listed_share` of all
    urls are blocked by a rule are listed, and the cascade over all hosts of the corpus says which those are.
    Columns with these names are replaced.
    """
    by_rule_name, listed = free_name(pages, "_by_rule"), free_name(pages, "_listed")
    parts = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rule, by_rule = matched_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, by_rule_name: by_rule})
    blocked = F.count_if(F.col(by_rule_name).eqNullSafe("block"))
    hosts = ruled.where(F.col("host") != "").groupBy(F.col("host").alias("key")).agg((blocked >= F.count(F.lit(1)) * listed_share).alias("listed"))
    cascade = build_cascade(saved(hosts, "hosts"))
    marked = cascade.mark(ruled, F.when(F.col("host") != "", F.col("host")), listed)
    by_list = F.when(F.col(listed), "block").otherwise("allow")
    return marked.withColumn("verdict", F.coalesce(by_rule_name, by_list)).drop(by_rule_name, listed)
