"""The registered query and the writer against a plain numbering of all sequences."""

import hashlib
import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import queries, training_order
from ledgerloom.llm.common import table

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")
LENGTH = 256


def brute(texts):
    """By (file, row): the sequences of every text in order, their slots from the
    permutation, and what the query says of them."""
    import base64

    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = []
    for doc, text in texts:
        ids = coder.encode_ordinary(text or "") + [queries.END_OF_TEXT]
        found += [(doc, i // LENGTH, ids[i : i + LENGTH]) for i in range(0, len(ids), LENGTH)]
    slots = training_order.Permutation(len(found), 4).slots(np.arange(len(found))) if found else []
    layout = training_order.Layout(LENGTH, queries.END_OF_TEXT + 1, len(found))
    return sorted(
        (int(s), int(s) // layout.per_shard, int(s) % layout.per_shard * layout.stride, doc, part, len(ids), hashlib.sha256(np.array(ids, "<u2").tobytes()).hexdigest())
        for s, (doc, part, ids) in zip(slots, found)
    )


def rows(df):
    return sorted(tuple(r) for r in df.select("slot", "shard", "byte_offset", "doc_id", "part", "n_tokens", "token_ids_sha256").collect())


def test_query_gives_every_sequence_its_slot(spark, sf_dir):
    held = pq.read_table(f"{sf_dir}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    assert rows(queries.QUERIES["op4_training_order"](spark, sf_dir)) == brute([(r["doc_id"], r["text"]) for r in held])


def test_equal_file_names_in_the_folders_of_a_table(spark, tmp_path):
    """Spark writes equal names into every folder; repeated rows, a null id, a null, an
    empty and a long text are in it."""
    docs = [(i % 300 if i != 17 else None, None if i == 3 else "" if i == 4 else "word " * (20_000 if i == 5 else i % 400), i % 2) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, half int").coalesce(1)
    frame.write.partitionBy("half").parquet(str(tmp_path / "documents.parquet"))
    names = [sorted(f for f in os.listdir(tmp_path / "documents.parquet" / f"half={h}") if f.endswith("parquet")) for h in (0, 1)]
    assert names[0] == names[1]
    order = [(d, t) for h in (0, 1) for d, t, half in docs if half == h]
    assert rows(queries.QUERIES["op4_training_order"](spark, str(tmp_path))) == brute(order)


def tokens(spark, n=300, file="f"):
    made = [(i, np.arange(i % 60).astype("<u2").tobytes(), file, i) for i in range(n)]
    return spark.createDataFrame(made, "doc_id long, ids binary, file string, row long").coalesce(2)


def test_rows_that_file_and_row_do_not_tell_apart_are_refused(spark):
    twice = tokens(spark).unionByName(tokens(spark))
    with pytest.raises(ValueError, match="apart"):
        training_order.materialise(twice, key=1, end_id=99, vocabulary=100, length=16)


def test_a_run_goes_on_where_one_died_and_no_other_is_mixed_in(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(training_order, "SHARD_BYTES", 1 << 11)
    monkeypatch.setattr(training_order, "WAVE_SHARDS", 5)
    path = str(tmp_path / "shards")
    options = dict(key=1, end_id=99, vocabulary=100, length=16, path=path)
    _, layout, n = training_order.materialise(tokens(spark), **options)
    want = sorted(map(tuple, training_order.read_shards(spark, path, layout).collect()))
    assert [r[0] for r in want] == list(range(n))
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    assert manifest["n"] == n and manifest["waves"] >= 3
    shards = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/wave=0").select("path", "length").collect()
    assert len({r.path for r in shards}) == len(shards) and all(r.length % layout.stride == 0 for r in shards)
    os.remove(f"{path}/wave=1/_SUCCESS")  # this wave had not been committed
    kept = os.stat(f"{path}/wave=0/_SUCCESS").st_mtime_ns
    training_order.materialise(tokens(spark), **options)
    assert sorted(map(tuple, training_order.read_shards(spark, path, layout).collect())) == want
    assert os.stat(f"{path}/wave=0/_SUCCESS").st_mtime_ns == kept
    for other in (dict(key=2), dict(vocabulary=99)):
        with pytest.raises(ValueError, match="holds shards of"):
            training_order.materialise(tokens(spark), **(options | other))
    with pytest.raises(ValueError, match="holds shards of"):
        training_order.materialise(tokens(spark, 301), **options)


def test_a_record_out_of_its_place_is_noticed(spark, tmp_path):
    path = str(tmp_path / "shards")
    _, layout, n = training_order.materialise(tokens(spark), key=1, end_id=99, vocabulary=100, length=16, path=path)
    folder = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-") and "shard=" in d][0]
    with open(folder, "rb") as file:
        raw = file.read()
    with open(folder, "wb") as file:
        file.write(raw[layout.stride :] + raw[: layout.stride])
    os.remove(os.path.join(os.path.dirname(folder), "." + os.path.basename(folder) + ".crc"))
    with pytest.raises(Exception, match="out of its place"):
        training_order.read_shards(spark, path, layout).count()


def test_the_setting_of_the_session_stays(spark, sf_dir):
    before = spark.conf.get(training_order.CLEANUP)
    training_order.materialise(tokens(spark), key=1, end_id=99, vocabulary=100, length=16)
    assert spark.conf.get(training_order.CLEANUP) == before
    assert table(spark, sf_dir, "documents").select(F.col("_metadata.file_path")).first()
