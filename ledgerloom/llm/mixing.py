"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Targets: sources share the words of all documents by weight; a target stops at
   ``most_repeats`` times its source, and the excess is shared again by weight.
2. Quotas: the mix has ``total words / block_tokens`` blocks. They go to the sources one
   by one, each to the highest quotient target / (2 * blocks so far + 1); the blocks of a
   source go to its shards in the same way, by shard size. Quotas are integers.
3. Selection: the documents of a shard lie on one line in a seeded order. A quota of q
   over n blocks takes every block q // n times and q % n blocks once more, spread from a
   seeded start. A document gets the words of the blocks it lies in.

Shards: a source has one shard per ``shard_rows`` documents, dealt by a hash of the
document, so a hot source has more shards and never a larger one. The prefix sums of
step 3 are windows over one shard. The driver sees one row per source; the shards of a
source meet in one group of one row per shard.
"""

from __future__ import annotations

import heapq
import math
import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, word_count

WEIGHTS = (1, 2, 3)
# One row per source reaches the driver; more sources than this are refused.
MOST_SOURCES = 1_000_000


def share(sizes: list[int], weights: list[float], most_repeats: float) -> list[float]:
    """Targets that add up to all sizes, none above ``most_repeats`` times its size."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most_repeats * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(most_repeats * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def apportion(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Sainte-Laguë: each seat to the highest quotient votes / (2 * seats so far + 1),
    ties to the earlier one, none above ``most``. The seats whose quotients surely
    belong to the result are given at once; a heap gives the rest one by one."""
    given = [0] * len(votes)
    total = float(sum(votes))
    if total <= 0:
        return given
    limit = most or [seats] * len(votes)
    sure = seats - (len(votes) + 1) // 2 - 1
    if sure > 0:
        for i, v in enumerate(votes):
            given[i] = min(limit[i], math.floor(v * sure / total + 0.5))
    left = seats - sum(given)
    heap = [(-v / (2 * given[i] + 1), i) for i, v in enumerate(votes) if v > 0 and given[i] < limit[i]]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        given[i] += 1
        left -= 1
        if given[i] < limit[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def plan_sources(sources: DataFrame, weights: tuple, most_repeats: int, block_tokens: int) -> tuple[DataFrame, int]:
    """One row per source with its target and its quota of blocks, and the words of a block."""
    rows = sources.collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"over {MOST_SOURCES} sources; mix groups of sources instead")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    sizes = [r["source_size"] for r in rows]
    targets = share(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))], most_repeats)
    block_tokens = block_size(targets, block_tokens)
    quotas = apportion(targets, round(sum(sizes) / block_tokens))
    made = [(r["source"], r["source_size"], t, q) for r, t, q in zip(rows, targets, quotas)]
    return sources.sparkSession.createDataFrame(made, "source string, source_size long, target double, quota long"), block_tokens


def block_size(targets: list[float], most: int) -> int:
    """Words of a block: few enough that the smallest target is 32 blocks or more, so that
    a quota of whole blocks comes near every target; at least one, at most ``most``."""
    return max(1, min(most, int(min((t for t in targets if t > 0), default=32 * most) // 32)))


def shard_quotas(shards: DataFrame, most_repeats: int, block_tokens: int, seed: int) -> DataFrame:
    """The blocks of each shard: whole rounds, blocks beyond them, and a seeded start."""

    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("shard")
        blocks = [-(-int(s) // block_tokens) for s in group["shard_size"]]
        quota = apportion([float(s) for s in group["shard_size"]], int(group["quota"].iloc[0]), [most_repeats * b for b in blocks])
        starts = [random.Random(f"{seed}/{g.source_no}/{g.shard}").randrange(max(1, b)) for g, b in zip(group.itertuples(), blocks)]
        return pd.DataFrame(
            {
                "source_no": group["source_no"], "shard": group["shard"], "blocks": blocks,
                "rounds": [q // max(1, b) for q, b in zip(quota, blocks)],
                "extra": [q % max(1, b) for q, b in zip(quota, blocks)], "start": starts,
            }
        )

    return shards.groupBy("source_no").applyInPandas(
        split, "source_no long, shard int, blocks long, rounds long, extra long, start long"
    )


def taken_before(place: Column, block_tokens: int) -> Column:
    """Words of the extra blocks among the first ``place`` words of a shard's line."""
    at = F.expr("start")
    block = F.floor(place / block_tokens)

    def chosen(j: Column) -> Column:  # extra blocks among the first j, exactly spread
        return F.expr("0L") + F.floor((j * F.col("extra") + at) / F.greatest(F.col("blocks"), F.lit(1)))

    whole = chosen(block)
    return whole * block_tokens + (chosen(block + 1) - whole) * (place - block * block_tokens)


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    most_repeats: int = 3,
    block_tokens: int = 64,
    shard_rows: int = 20_000,
    seed: int = 20,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, draw.

    ``size`` is the number of words (a null text has none); ``taken`` the words the mix
    takes of it, repeats counted, at most ``most_repeats`` times the size. A null source
    is a source of its own, the last. Equal rows are dealt as rows of their own; empty
    documents take nothing; an empty table gives no rows; other columns don't matter. Blocks
    have ``block_tokens`` words, or fewer where a source's target is small. The result depends on the
    rows and the seed alone (equal rows may swap places).
    """
    sized = staged(
        docs.select(
            F.col("`doc_id`").cast("long").alias("doc_id"),
            F.col("`source`").cast("string").alias("source"),
            word_count(F.col("`text`")).alias("size"),
            F.xxhash64(F.col("`doc_id`").cast("long"), F.col("`text`"), F.lit(seed)).alias("draw"),
        ),
        "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = staged(sources.coalesce(1), "mix-sources")
    plan, block_tokens = plan_sources(sources.select("source", "source_size"), weights, most_repeats, block_tokens)
    plan = staged(
        plan.join(sources.select("source", "docs"), plan["source"].eqNullSafe(sources["source"])).select(
            plan["*"],
            F.greatest(F.lit(1), F.ceil(F.col("docs") / shard_rows)).cast("int").alias("shards"),
            F.xxhash64(plan["source"], F.lit(3)).alias("source_no"),
        ),
        "mix-plan",
    )
    dealt = (
        sized.withColumn("source_no", F.xxhash64("source", F.lit(3)))
        .join(plan.select("source_no", "source_size", "target", "quota", "shards"), "source_no")
        .withColumn("shard", F.pmod(F.xxhash64("draw", F.lit(5)), F.col("shards")).cast("int"))
    )
    shards = dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("quota"))
    quotas = staged(shard_quotas(shards, most_repeats, block_tokens, seed), "mix-quotas")
    line = Window.partitionBy("source_no", "shard").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum("size").over(line)).join(quotas, ["source_no", "shard"])
    extra = taken_before(F.col("end"), block_tokens) - taken_before(F.col("end") - F.col("size"), block_tokens)
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + extra).cast("long").alias("taken"), "draw",
    )


def repeated(docs: DataFrame, seed: int = 20, **options) -> DataFrame:
    """The mix as documents: each row as many times as the mix takes it, with all columns,
    whatever their names.

    A fraction of a document becomes a whole one with that chance, by a seeded draw of
    the row, so a source keeps its words on average; no row comes more than
    ``most_repeats`` times. Rows of one id and text share what the mix takes of them.
    Documents without words have no share in a mix of words and are left out.
    """
    share = mix(docs, seed=seed, **options).groupBy("draw").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    text, own = F.col("`text`"), F.col("`doc_id`").cast("long")
    # the row is held in one column, so that no other can clash with its own
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(own, text, F.lit(seed)).alias("draw"))
    met = keyed.join(share, "draw")
    chance = F.pmod(F.xxhash64("draw", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor(F.col("taken") / F.col("size") + chance).cast("int")
    some = met.filter(F.col("size") > 0).withColumn("times", times).filter("times > 0")
    return some.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
