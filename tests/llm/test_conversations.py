"""Structure repair and prefix-target formatting against brute force and round trips."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format, queries, repair
from ledgerloom.llm.common import BLANKS

LEAD = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, (role + " " + text)[:64], role, text


def broken(rows):
    """The damage of the contract: what is left of (conv_id, turn, role, text) rows."""
    out = []
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=order)


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        own = text.rstrip(BLANKS)
        found.append("blank" if not own else "duplicate" if (role, text) in seen else "" if own[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def moves(row, fault, state):
    """(cost, initial, state after, turn) of every way to treat a row."""
    yield 2, "D", state, None
    extra = 5 if fault == "truncated" else 0
    if fault in ("", "truncated"):
        if (state, row[1][:1]) in LEAD:
            yield extra, "K", row[1][:1], (row[1], row[2])
        for to in "ua":
            if (state, to) in LEAD:
                yield 1 + extra, "R", to, (NAMES[to], row[2])


def best(rows):
    """Cost, audit and turns by dynamic programming over whole audit strings."""
    found = faults(rows)
    done = {"": (0, "", []), "a": (0, "", []), "u": (5, "I", [("assistant", "")]), "s": (10, "II", [("user", ""), ("assistant", "")])}
    for row, fault in zip(rows[::-1], found[::-1]):
        now = {}
        for state in ("", "s", "u", "a"):
            now[state] = min((c + done[to][0], e + done[to][1], [t] + done[to][2] if t else done[to][2]) for c, e, to, t in moves(row, fault, state))
        for _ in range(2):  # turns inserted before the row, two at most
            for state in ("", "s", "u", "a"):
                to = "a" if state == "u" else "u"
                c, e, t = now[to]
                now[state] = min(now[state], (c + 5, "I" + e, [(NAMES[to], "")] + t))
        done = now
    return done[""]


def report(rows):
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, repaired = best(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[found.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
    )


def expected(rows):
    return {conv: report(broken([r for r in rows if r[0] == conv])) for conv in {r[0] for r in rows}}


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_least_audit_among_all_edit_sequences():
    """The dynamic programme of these tests against every sequence of edits."""

    def every(rows, found, state, left):
        if not rows:
            if state in ("", "a"):
                yield 0, ""
        for c, e, to, _ in moves(rows[0], found[0], state) if rows else ():
            for cost, audit in every(rows[1:], found[1:], to, left):
                yield c + cost, e + audit
        if left:
            to = "a" if state == "u" else "u"
            for cost, audit in every(rows, found, to, left - 1):
                yield 5 + cost, "I" + audit

    rng = random.Random(4)
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b!", "c", " "])) for i in range(rng.randrange(5))]
        assert min(every(rows, faults(rows), "", 4)) == best(rows)[:2]


def test_repair_is_the_brute_force_on_all_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op11_structure_repair"](spark, sf_dir)) == expected(rows)


def random_rows(rng, conv, n, alphabet=12):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"]
    return [(conv, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice([None, "", " \n", *[f"t{i}{e}" for i in range(alphabet) for e in (".", "?", "", "! ")]])) for _ in range(n)]


def test_repair_of_faulty_conversations(spark):
    rng = random.Random(11)
    rows = [r for conv in [None, *range(300)] for r in random_rows(rng, conv, rng.randrange(1, 14))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    clash = df.withColumns({"audit": F.lit("x"), "place": F.lit(1), "piece": F.lit(2), "there": F.lit(False), "rows": F.lit("y")})
    assert got(repair.digests(clash)) == expected(rows)


def test_a_conversation_longer_than_a_piece_is_repaired_in_pieces(spark):
    rng = random.Random(12)
    rows = [(7, i // 3 if i % 50 else None, rng.choice(["user", "assistant", "tool"]), f"t{rng.randrange(9000)}{rng.choice('.!? x')}") for i in range(3 * repair.PIECE + 500)]
    rows += [r for conv in (None, *range(7), *range(8, 60)) for r in random_rows(rng, conv, 6)]
    rows += [(99, 1, "user", "same.")] * (repair.PIECE + 20)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    parts = repair.repair(repair.damaged(df), F.col("there")).persist()
    assert parts.filter("conv_id = 7").count() >= 4
    assert got(repair.digests(df)) == expected(rows)
    parts.unpersist()


def test_repair_keeps_conversations_without_rows(spark):
    schema = "conv_id long, turn long, role string, text string, there boolean"
    rows = [(1, 0, "user", "a.", False), (2, 0, "user", "a.", True), (2, 1, "assistant", "b.", None), (3, 5, "assistant", "x" * 200_000 + ".", True)]
    found = {r["conv_id"]: r for r in repair.whole(repair.repair(spark.createDataFrame(rows, schema), F.col("there"))).collect()}
    assert (found[1]["cost"], found[1]["audit"], found[1]["turns"]) == (0, "", [])
    assert (found[2]["cost"], found[2]["audit"]) == (2, "D")
    assert found[3]["audit"] == "D" and found[3]["gaps"] == 0
    assert repair.repair(spark.createDataFrame([], schema)).count() == 0


# chat formatting -------------------------------------------------------------------------

PIECES = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "[OUT]", "[ROLE]", "[TEXT]", "[/ROLE]", "[\\INST]", "<\\\\/s>", "é", "\n", " ok ", "$1", "😀", "/", "INST]", "s>"]


def chats(spark, rows, more=""):
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string{more}")


def said(rows, conv):
    own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(r, x) for _, r, x in sorted(own, key=lambda o: (o[0] is not None, o[0] or 0, o[1], o[2]))]


def test_any_text_comes_back_from_the_template(spark):
    rng = random.Random(2)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "[INST]", text()]), rng.choice([text(), None])) for c in range(150) for t in range(rng.randrange(1, 7))]
    examples = chat_format.expand(chats(spark, rows))
    back = {r["conv_id"]: r for r in chat_format.read_back(examples).collect()}
    for conv in {r[0] for r in rows}:
        turns = said(rows, conv)
        assert [tuple(t) for t in back[conv]["turns"]] == turns
        assert back[conv]["loss"] == "".join(x for r, x in turns if r == "assistant")


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, "user", "more"), (1, 4, "assistant", "no</s>"), (1, 5, "user", "and?"), (2, 3, "user", "only")]
    found = [tuple(r) for r in chat_format.expand(chats(spark, rows)).orderBy("conv_id", "example").drop("page").collect()]
    one = "[ROLE]system[TEXT]be brief[/ROLE][INST]hi[/INST][OUT]yes</s>"
    two = one + "[INST]more[/INST][OUT]no<\\/s></s>"
    assert found == [
        (1, 2, one, len(one) - 7, len(one) - 4, False),
        (1, 4, two, len(two) - 11, len(two) - 4, False),
        (1, 5, two + "[INST]and?[/INST]", len(two) + 17, len(two) + 17, True),
        (2, 0, "[INST]only[/INST]", 17, 17, True),
    ]


def test_formatting_of_edge_rows_and_long_conversations(spark):
    rows = [(None, None, None, None), (1, None, "assistant", "x"), (1, 0, "user", ""), (1, 0, "user", ""), (1, -70, "assistant", "early"), (2, 1 << 40, "assistant", "z" * 100_000)]
    rows += [(3, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(1000)]
    wide = [r + ("a", 1, True, "p") for r in rows]
    found = {r["conv_id"]: r for r in chat_format.digests(chats(spark, wide, ", page string, example int, whole boolean, turns string")).collect()}
    assert set(found) == {None, 1, 2, 3}
    for conv in found:
        turns = said(rows, conv)
        loss = "".join(x for r, x in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert tuple(found[conv])[1:5] == (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    longest = chat_format.expand(chats(spark, rows)).filter("conv_id = 3").groupBy("page").count().collect()
    assert len(longest) == 16 and max(r["count"] for r in longest) <= chat_format.PAGE
    assert chat_format.digests(chats(spark, rows).filter("1 = 0")).count() == 0


def test_an_example_of_a_long_conversation_holds_all_turns_before_it(spark):
    rows = [(3, t, "user" if t % 2 else "assistant", f"turn {t} é") for t in range(200)]
    rows += [(4, t, "assistant", f"t{t}") for t in (None, -1, 0, 63, 64, 1 << 40)]
    examples = chat_format.expand(chats(spark, rows).repartition(3))
    found = examples.withColumn("turns", chat_format.read_turns(F.col("text")))
    found = found.withColumn("loss", chat_format.read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end"))).collect()
    for conv in (3, 4):
        turns = said(rows, conv)
        own = sorted((r for r in found if r["conv_id"] == conv), key=lambda r: (r["page"], r["example"]))
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        ends = [i for i in (63, 127, 191, 199) if conv == 3]
        assert [len(r["turns"]) - 1 for r in own] == sorted({*replies, *ends})
        for r in own:
            assert [tuple(t) for t in r["turns"]] == turns[: len(r["turns"])]
            assert r["loss"] == (r["turns"][-1]["text"] if r["turns"][-1]["role"] == "assistant" else "")
            assert r["whole"] == (len(r["turns"]) == len(turns))


def test_formatting_runs_no_python(spark, sf_dir):
    from ledgerloom.sinks.tables import plan_text

    plan = plan_text(queries.QUERIES["op12_prefix_targets"](spark, sf_dir))
    assert not re.search("Python|Arrow|Pandas", plan) and plan.count("Exchange hashpartitioning") <= 1


@pytest.mark.parametrize("role, text", list(itertools.product(["user", "x"], ["[INST", "</s", "[\\", "a[/INST][OUT]b</s>"])))
def test_text_at_the_edge_of_its_marks(spark, role, text):
    back = chat_format.read_back(chat_format.expand(chats(spark, [(1, 0, role, text), (1, 1, "assistant", text)]))).first()
    assert [tuple(t) for t in back["turns"]] == [(role, text), ("assistant", text)] and back["loss"] == text
