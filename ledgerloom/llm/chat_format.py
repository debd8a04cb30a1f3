"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of
its own, with all turns before it as context and only its reply trainable.

A turn is written as one marked piece, by its role:

    user        [INST]text[/INST]
    assistant   [OUT]text</s>
    any other   [ROLE]role[TEXT]text[/ROLE]

Control strings inside a text get a backslash behind their first character, and those that
have backslashes there already get one more, so that taking one away gives the text back
and no text can end a turn or begin one.

Contexts repeat their conversation, so the examples of a conversation of n turns are
n * n / 2 turns long: every row holds its whole context, whatever its length, and the last
one holds the whole conversation. Rows are made one after the other from the conversation's
pieces, which are held once; no more than a row is held beside them.

A conversation is numbered in pages of ``PAGE`` turn numbers (turn div PAGE). A page names
its examples, and ends with a row of its own where its last turn isn't trained, so the length
of that row tells where the next page begins in every text.

Everything here is DataFrame functions: one shuffle of the texts, no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick

# The template.
USER, REPLY, OTHER = ("[INST]", "[/INST]"), ("[OUT]", "</s>"), ("[ROLE]", "[TEXT]", "[/ROLE]")
TRAINED = "assistant"
PAGE = 64

_CONTROL = r"(/?(?:INST|OUT|ROLE|TEXT)\]|/?s>)"
_PLAIN = r"([\[<])(\\*)" + _CONTROL
_ESCAPED = r"([\[<])(\\*)\\" + _CONTROL
_TURN = r"(?s)\[INST\].*?\[/INST\]|\[OUT\].*?</s>|\[ROLE\].*?\[TEXT\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, "$1$2\\\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def marked(role: Column, text: Column) -> Column:
    """A turn in its marks; role and text are escaped already."""
    return (
        F.when(role == "user", F.concat(F.lit(USER[0]), text, F.lit(USER[1])))
        .when(role == TRAINED, F.concat(F.lit(REPLY[0]), text, F.lit(REPLY[1])))
        .otherwise(F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), text, F.lit(OTHER[2])))
    )


def page_of(turn: Column) -> Column:
    """Pages in the order of turns; rows without a turn come first, on a page of their own."""
    return F.coalesce(F.floor(turn / F.lit(PAGE)).cast("long"), F.lit(-(1 << 62)))


def expand(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn, and one per page that doesn't end with such a turn.

    conv_id, page, example (place of the last turn on the page, from 0), text (the marked
    turns of the conversation up to and with that turn), loss_start and loss_end (code points
    of the text between which it is trainable; equal where nothing is), whole (the row holds
    every turn of its conversation).

    Turns go by number, nulls first; turns with one number by role and text. Null texts and
    roles are empty. Repeated rows are turns of their own, as are empty texts. A null conv_id
    is a conversation. An empty table gives no rows. Other columns don't matter, whatever
    their names.
    """
    rows = pick(conversations, ("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    clean = rows.select("conv_id", page_of(F.col("turn")).alias("page"), "turn", escape(role).alias("role"), escape(text).alias("text"))
    held = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("page", "turn", "role", "text"))).alias("turns"))
    pieces = held.withColumn("pieces", F.transform("turns", lambda t: marked(t["role"], t["text"]))).withColumn("pages", F.col("turns.page"))
    each = pieces.select("conv_id", "pieces", "pages", F.posexplode("turns").alias("place", "target"))
    trained = F.col("target.role") == TRAINED
    page, after = F.col("target.page"), F.get("pages", F.col("place") + 1)
    each = each.filter(trained | ~after.eqNullSafe(page)).withColumn("first", F.array_position("pages", page).cast("int") - 1)
    made = F.array_join(F.slice("pieces", F.lit(1), F.col("place") + 1), "")
    ends = F.char_length("text") - F.when(F.col("trained"), len(REPLY[1])).otherwise(0)
    return (
        each.select(
            "conv_id", page.alias("page"), (F.col("place") - F.col("first")).alias("example"), made.alias("text"),
            trained.alias("trained"), F.char_length("target.text").alias("size"), (F.col("place") == F.size("pieces") - 1).alias("whole"),
        )
        .withColumn("loss_end", ends)
        .withColumn("loss_start", F.col("loss_end") - F.when(F.col("trained"), F.col("size")).otherwise(0))
        .select("conv_id", "page", "example", "text", "loss_start", "loss_end", "whole")
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text: an array of role and text as they were."""

    def turn(piece: Column) -> Column:
        inner = lambda begin, end: F.substr(piece, F.lit(len(begin) + 1), F.char_length(piece) - len(begin) - len(end))
        other = inner(OTHER[0], OTHER[2])
        cut = F.position(F.lit(OTHER[1]), other)
        role = (
            F.when(piece.startswith(USER[0]), F.lit("user"))
            .when(piece.startswith(REPLY[0]), F.lit(TRAINED))
            .otherwise(unescape(F.substr(other, F.lit(1), cut - 1)))
        )
        own = (
            F.when(piece.startswith(USER[0]), inner(*USER))
            .when(piece.startswith(REPLY[0]), inner(*REPLY))
            .otherwise(F.substr(other, cut + len(OTHER[1])))
        )
        return F.struct(role.alias("role"), unescape(own).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(_TURN), F.lit(0)), turn)


def read_loss(text: Column, start: Column, end: Column) -> Column:
    """What is trainable of a formatted text, as it was."""
    return unescape(F.substr(text, start + 1, end - start))


def read_back(examples: DataFrame) -> DataFrame:
    """Rows of ``expand`` by conversation: conv_id, turns (role and text), loss (the trainable
    texts in order), formatted_chars (of each text, from its page on). Needs no shuffle where
    the examples are still dealt by conversation. Of a text, no more goes on than is kept."""
    loss = read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end"))
    held = examples.select("conv_id", "page", "example", F.when(F.col("whole"), F.col("text")).alias("text"), F.char_length("text").cast("long").alias("chars"), loss.alias("loss"))
    rows = held.groupBy("conv_id").agg(F.max("text").alias("text"), F.sort_array(F.collect_list(F.struct("page", "example", "chars", "loss"))).alias("rows"))

    def add(sums: Column, row: Column) -> Column:
        """``before`` is what the last row of the page before holds."""
        before = F.when(row["page"].eqNullSafe(sums["page"]), sums["before"]).otherwise(sums["last"])
        return F.struct(row["page"].alias("page"), before.alias("before"), row["chars"].alias("last"), (sums["chars"] + row["chars"] - before).alias("chars"))

    none = F.struct(F.lit(None).cast("long").alias("page"), *[F.lit(0).cast("long").alias(n) for n in ("before", "last", "chars")])
    chars = F.aggregate("rows", none, add, lambda sums: sums["chars"])
    return rows.select("conv_id", read_turns(F.col("text")).alias("turns"), F.array_join("rows.loss", "").alias("loss"), chars.alias("formatted_chars"))


def digests(conversations: DataFrame) -> DataFrame:
    """Format the conversations, read the result back and give the figures of each."""
    whole = read_back(expand(conversations))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
