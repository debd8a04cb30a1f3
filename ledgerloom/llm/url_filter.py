"""URL rules by a Bloom filter cascade: exact membership of keys, with no join.

A url is looked up under a few keys: its last L host labels followed by the first P
characters of its path, for every shape (L, P) that a rule has. The keys of all urls are
the key universe. Level 1 of a cascade is a Bloom filter of the listed keys; level 2
holds the keys of the universe that level 1 lets through by mistake; level 3 the listed
keys that level 2 lets through; and so on, until a level makes no mistake. A key is
listed if the first level that rejects it is an even one. Over the universe the answer
is exact, so probing needs no list, no join and no Python: the levels are literals.

Size: level 1 aims at a rate of sqrt(2) / 2 * listed / unlisted, so that level 2 gets
about as many keys as are listed, and each later level takes half of the one before it.
The levels follow the list and the logarithm of the universe, not the number of urls.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import bits
from ledgerloom.llm.common import staged

# Bits of one level at most; a literal of 2 MB. A longer list must be split by the caller.
MOST_BITS = 1 << 24
MOST_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        return self.host.count(".") + 1, len(self.path)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def lookup_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> list[Column]:
    """The key of each shape. A host with fewer labels, or a shorter path, gives the
    shorter key; any rule that equals it fits the url as well."""
    return [F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)) for labels, length in shapes]


def universe(hosts: DataFrame, shapes: list[tuple[int, int]], rules: list[Rule], verdict: str) -> DataFrame:
    """Every distinct key of the corpus and the list, marked listed or not: a grouping
    with map-side sums, so a host that a third of the urls share is one row per task."""
    keys = hosts.select(F.explode(F.array(*lookup_keys(F.col("host"), F.col("path"), shapes))).alias("key"))
    spark = hosts.sparkSession
    named = [r.key for r in rules if r.verdict == verdict]
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in named]).cast("array<string>")).alias("key"))
    both = keys.withColumn("listed", F.lit(False)).unionByName(listed.withColumn("listed", F.lit(True)))
    return both.groupBy("key").agg(F.bool_or("listed").alias("listed"))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[bits.Bits, ...]

    def holds(self, key: Column) -> Column:
        """Exact for the keys of the universe the cascade was built over."""
        inside: Column = F.lit(len(self.levels) % 2 == 1)
        for depth, level in reversed(list(enumerate(self.levels))):
            inside = F.when(level.holds(key), inside).otherwise(F.lit(depth % 2 == 1))
        return inside


def build_cascade(keys: DataFrame) -> Cascade:
    """A cascade over rows (key, listed). Each level reads what the level before it let
    through; only level 1 reads the whole universe."""
    sizes = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    listed, others = sizes.get(True, 0), sizes.get(False, 0)
    if not listed:
        return Cascade(())
    left, levels, side = keys, [], True
    rate = min(0.5, math.sqrt(0.5) * listed / max(1, others))
    while len(levels) < MOST_LEVELS:
        own = left.filter(F.col("listed") == side)
        count = listed if side else others
        m, k = bits.shape(count, rate, MOST_BITS)
        if m == MOST_BITS:
            raise ValueError(f"a level of {count} keys needs over {MOST_BITS} bits; split the list")
        level = bits.build(own, "key", m, k, salt=len(levels) + 1)
        levels.append(level)
        # the keys of this level go on only if the next level takes them by mistake
        left = staged(left.filter((F.col("listed") == side) | level.holds(F.col("key"))), "cascade")
        counts = {r["listed"]: r["count"] for r in left.groupBy("listed").count().collect()}
        listed, others = counts.get(True, 0), counts.get(False, 0)
        side, rate = not side, 0.5
        if not (listed if side else others):
            return Cascade(tuple(levels))
    raise RuntimeError("the cascade doesn't end")


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to every row; other columns of these names are
    replaced.

    Rules fit their host and all its subdomains when the path starts with theirs; the
    longest rule wins. Without a fitting rule the key is unlisted: rule is null and the
    verdict is ``default``. Null, empty and malformed urls have empty host and path and
    get the default. An empty table or an empty list is no special case.
    """
    shapes = sorted({r.shape for r in rules})
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col(f"`{url}`"))
    split = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    if not rules:
        return split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    cascades = {v: build_cascade(staged(universe(split.select("host", "path"), shapes, rules, v), "keys")) for v in ("allow", "block")}
    found = []
    for key in lookup_keys(F.col("host"), F.col("path"), shapes):
        for verdict, cascade in cascades.items():
            if cascade.levels:
                hit = F.struct(F.char_length(key).alias("size"), key.alias("rule"), F.lit(verdict).alias("verdict"))
                found.append(F.when(cascade.holds(key), hit))
    best = F.sort_array(F.array(*found), asc=False)[0]
    return split.withColumn("__best", best).select(
        *kept, "host", "path",
        F.col("__best.rule").alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"),
    )
