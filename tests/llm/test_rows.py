"""Whole rows through the pipeline's operators: clashing names, and small sources."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import exact_dedup, mixing, ngram_join

# Every name an operator uses for a column of its own.
NAMES = [
    "__key", "__best", "__once", "__set", "__own", "__least", "__docs", "__row", "__draw", "__taken", "__size", "__times", "__copy",
    "__score", "__passages", "row", "key", "own", "best", "digest", "sha", "draw", "taken", "size", "times", "copy", "text_sha256",
    "score", "passages", "set_id", "root", "n", "count",
]


@pytest.fixture
def clashing(docs):
    return docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in NAMES])


@pytest.mark.parametrize("keep", [exact_dedup.keep_first, ngram_join.keep_one, mixing.repeated])
def test_rows_come_through_whole_whatever_their_names(clashing, docs, keep):
    got, plain = keep(clashing), keep(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    assert got.dtypes == clashing.dtypes
    ids = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows)
    rows = got.collect()
    assert ids(rows) == ids(plain.collect()) and rows
    for r in rows:
        assert all(r[n] == f"{n}:{'-' if r.doc_id is None else r.doc_id}" for n in NAMES)


def test_toxic_stage_keeps_names_and_types(spark, clashing, sf_dir):
    got = corpus_pipeline.drop_toxic(spark, clashing, sf_dir)
    assert got.dtypes == clashing.dtypes
    assert all(r["__score"].startswith("__score:") and r["__passages"].startswith("__passages:") for r in got.collect())


def test_small_sources_come_near_their_targets(spark):
    """One of 10 words beside one of 40,000: blocks of 64 words would give it none."""
    rows = [(1, "w " * 10, "a"), (2, "w " * 7, "b"), (3, "w " * 3, "b")] + [(10 + i, "w " * 400, "c") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    taken = {}
    for r in found:
        own = taken.setdefault((r.source, r.target), [0])
        own[0] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    assert {s for s, _ in taken} == {"a", "b", "c"}
    assert all(abs(t[0] - target) <= 1 + 0.01 * target for (_, target), t in taken.items())
    assert dict((s, t) for s, t in taken)["a"] == 30.0
    assert mixing.block_size([30.0, 30.0, 39940.0], 64) == 1 and mixing.block_size([1e6, 4096.0], 64) == 64 and mixing.block_size([], 64) == 64


def test_groups_of_copies_are_decided_by_their_rows(spark):
    """What stays doesn't depend on how often a part of the job runs: no random key."""
    rows = [(i, f"text {i % 40}" + " " * (i % 3), "s") for i in range(400)] + [(1000 + i, f"alone {i}", "s") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = exact_dedup.keep_first(docs)
    assert "uuid" not in kept._jdf.queryExecution().toString().lower()
    want = {min((i for i in range(400) if i % 40 == g and i % 3 == 2), default=None) for g in range(40)}
    assert {r.doc_id for r in kept.collect()} == want | {1000 + i for i in range(200)}


def test_a_task_gives_back_what_its_arrays_took(spark):
    """Also when the next operator's task runs in the same worker: what is freed isn't kept."""
    import re

    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    from ledgerloom.llm.common import with_columns

    def private():
        with open("/proc/self/smaps_rollup") as file:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", file.read()).group(1)) / 1024

    def make():
        kept = [np.ones(1 << 12) for _ in range(4000)]  # 125 MB in blocks that come from the heap
        stays = [np.ones(1 << 12) for _ in range(10)]  # above them: the heap's top stays where it is
        before = private()
        kept.clear()
        return lambda ids: [pa.array([private() - before + 0 * len(stays)] * len(ids))]

    rows = spark.range(0, 2, 1, 1).toDF("id").withColumn("text", F.repeat(F.lit("x"), 1 << 20))
    first, second = (r["grown"] for r in with_columns(rows, ["id"], [("grown", T.DoubleType())], make).orderBy("id").collect())
    assert second < first - 50 or second < -100


def test_batches_of_texts_are_small(spark):
    """A worker is fed by about a MB of text at a time, whatever the rows of a file."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from ledgerloom.llm.common import pick, with_columns

    def make():
        return lambda texts: [pa.array([texts.buffers()[2].size] * len(texts))]  # of the batch, of which a slice is a part

    rows = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 4000).alias("text"))
    docs = pick(rows, ("doc_id", "long"), ("text", "string"))
    held = with_columns(docs, ["text"], [("held", T.LongType())], make).select("doc_id", "held").collect()
    assert sorted(r["doc_id"] for r in held) == list(range(6000))
    assert max(r["held"] for r in held) < 2 << 20


def test_bounds_of_batches_that_a_session_sets_stay(spark):
    from ledgerloom.llm.common import BATCHES, importable

    other, own = spark.newSession(), {"spark.sql.parquet.columnarReaderBatchSize": "1000"}
    for key, value in own.items():
        other.conf.set(key, value)
    importable(other)
    assert {key: other.conf.get(key) for key in BATCHES} == BATCHES | own
