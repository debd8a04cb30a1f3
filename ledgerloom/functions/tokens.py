"""Hash tokens and repeatable draws, as built-in expressions.

They use md5 text and integer arithmetic only, so any engine computes the same
value for the same row: a task that runs twice gives the same result, and a test
can recompute it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hex_number(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


# Multipliers of the mixing rounds, all odd, the added constant, and the bits of a word.
# The first draw takes three rounds, each further one two.
ROUNDS = (
    747796405, 1566083941, 1103515245, 1812433253, 1664525, 22695477, 134775813, 1597334677, 1131446405, 1013904223, 277803737,
)
FIRST_ROUNDS = 3
ADDEND = 11
MASK = (1 << 31) - 1
# What a day adds to the first word of a state, and a repeat to the second.
DAY_STEP, REPEAT_STEP = 461845907, 739982445


def cell_state(seed: int, *texts: Column) -> tuple[Column, Column]:
    """Two words of 31 bits for a seed and some texts: one digest per dictionary pair.
    Together they are a counter state of 62 bits."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in texts]))
    return tuple(_hex_number(F.substring(digest, start, 8)).bitwiseAND(F.lit(MASK)) for start in (1, 9))


def draw_rounds(names: list[str]) -> dict[int, str]:
    """After which mixing round each draw is taken."""
    rounds = {FIRST_ROUNDS + 2 * i: name for i, name in enumerate(names)}
    if max(rounds) > len(ROUNDS):
        raise ValueError(f"{len(ROUNDS)} rounds are too few for {len(names)} draws")
    return rounds


def pinned(value: Column) -> Column:
    """The same value, but a filter on it stays above the projection that computes it.
    Pushed below, it would repeat all steps up to there, each round's two to three times
    over, and the generated code would be too long to be compiled."""
    return value + F.rand(0) * F.lit(0.0)


def with_draws(df: DataFrame, state: tuple[str, str], day: str, repeat: str, names: list[str]) -> DataFrame:
    """Add uniform numbers in [0, 1) that depend only on the state, the day and the
    repeat of a row.

    Day and repeat move the two words apart, and every round replaces the pair (x, y) by
    (y, mix(x * multiplier + y)), which can be undone: rows of one state never share a
    pair, and rows of different states do at the rate of 62 random bits. Integer steps
    that fit a long take the place of a digest per row; each is a projection of its own,
    so no step is computed twice."""
    columns, taken, mask = df.columns, draw_rounds(names), F.lit(MASK)
    # words that can't be null keep the generated code small enough to be compiled
    word = lambda start, step: F.coalesce((F.col(start) + step).bitwiseAND(mask), F.lit(0).cast("bigint"))
    mixed = df.withColumns({
        "_x": word(state[0], F.unix_date(day).cast("bigint") * F.lit(DAY_STEP)),
        "_y": word(state[1], F.col(repeat).cast("bigint") * F.lit(REPEAT_STEP)),
    })
    for i, multiplier in enumerate(ROUNDS[: max(taken)], start=1):
        mixed = mixed.withColumn("_z", (F.col("_x") * F.lit(multiplier) + F.col("_y") + ADDEND).bitwiseAND(mask))
        mixed = mixed.withColumns({"_x": F.col("_y"), "_y": F.col("_z").bitwiseXOR(F.shiftright("_z", 15))})
        if i in taken:
            mixed = mixed.withColumn(taken[i], pinned(F.col("_y") / F.lit(float(1 << 31))))
    return mixed.select(*columns, *names)
