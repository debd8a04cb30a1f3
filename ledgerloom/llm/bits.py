"""Bloom filters made and probed with DataFrame functions alone.

A filter is an array of 64-bit words. Its bits are set by a ``bit_or`` aggregate (one
row per word, summed before the shuffle) and it is probed as an array literal, so that
a lookup is plain generated code: no join, no Python. The word count is a parameter
that the caller bounds; it never follows the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bits:
    """``m`` bits, ``k`` probes; ``salt`` separates the filters of one cascade."""

    m: int
    k: int
    salt: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        """True for every key put in, and for a few others. Null for a null key."""
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")

        def probe(bound: Column) -> Column:
            found = F.lit(True)
            for place in places(bound, self.m, self.k, self.salt):
                word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
                found = found & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
            return found

        return F.exists(F.array(key), probe)  # binds the key, so that it is computed once


def places(key: Column, m: int, k: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(salt * 64 + i)), F.lit(m)) for i in range(k)]


def shape(keys: int, rate: float, most_bits: int) -> tuple[int, int]:
    """Bits and probes for a false-positive rate, at most ``most_bits`` bits."""
    wanted = math.ceil(max(1, keys) * -math.log(rate) / math.log(2) ** 2)
    m = min(most_bits, max(64, (wanted + 63) // 64 * 64))
    return m, max(1, min(12, round(m / max(1, keys) * math.log(2))))


def build(keys: DataFrame, column: str, m: int, k: int, salt: int = 0) -> Bits:
    """A filter of a column's values; the driver gets at most ``m / 64`` rows."""
    place = F.explode(F.array(*places(F.col(column), m, k, salt))).alias("place")
    set_words = (
        keys.select(place)
        .groupBy(F.shiftright("place", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 AS INT)))").alias("word"))
        .collect()
    )
    words = [0] * (m // 64)
    for row in set_words:
        words[row["at"]] = row["word"]
    return Bits(m, k, salt, tuple(words))


def prefilter(keys: DataFrame, column: str, count: int, most_bits: int = 1 << 20) -> Bits:
    """A filter that keeps most rows without a partner away from a shuffle. With more
    keys than the bound suits it lets more rows through; it never loses one."""
    return build(keys, column, *shape(count, 0.01, most_bits))
