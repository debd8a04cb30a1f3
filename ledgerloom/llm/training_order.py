"""Training-order materialisation: every sequence gets a slot, every slot a place.

A sequence is a run of ``length`` token ids of one document (the end mark included; the
last one is filled up with it). Sequences have dense numbers 0 … N - 1 in table order: a
task counts within the slices it reads, and the slices' totals, one row per slice, are
summed up. A keyed Feistel network permutes the numbers; a number that leaves the
domain walks on until it is back (cycle-walking), so slots are dense as well, and any
slot can be computed, and inverted, from key and N alone.

Shard s holds the slots [s * per_shard, (s + 1) * per_shard) as records of one stride, so
slot i lies at byte (i % per_shard) * stride of shard i // per_shard. A reader goes
through the files in order and can begin again at any slot. A record is: slot (int64),
doc_id (int64), part (int32), ids used (int32), ``length`` ids (uint16, or uint32 for large
vocabularies), and a line end, which Spark's text writer puts there.

Shards are written in waves of slot ranges. A wave deals its sequences to partitions by
shard, exactly one shard a partition, sorts each and commits its folder. A run that is
repeated with the same path skips committed waves; a manifest beside them holds what the
slots depend on, and a run with other values is refused.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, forget_at_exit, importable, slices, staged
from ledgerloom.shared import scratch_path

HEAD = struct.Struct("<qqii")
NO_ID = -(1 << 63)  # stands for a null doc_id
ROUNDS = 6
# Shards grow with the table between these sizes, so that there are about SHARDS of them; a
# wave has at most WAVE_SHARDS, and there are LEAST_WAVES of them where there are as many
# shards, since a wave's share of the records is in temporary space at a time.
SHARD_BYTES, MOST_SHARD_BYTES, SHARDS, WAVE_SHARDS, LEAST_WAVES = 8 << 20, 128 << 20, 10_000, 10_000, 3
MOST_REPLICATED = 1 << 20  # slices up to which their offsets are replicated
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
Encoder = Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]]
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Permutation:
    """A keyed permutation of 0 … n - 1."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = _U(max(1, (max(1, n - 1).bit_length() + 1) // 2))
        self.mask = _U((1 << int(self.half)) - 1)
        self.keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + np.array([key & (1 << 64) - 1], np.uint64))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (_mix(left + key) & self.mask), left
            else:
                left, right = right, left ^ (_mix(right + key) & self.mask)
        return (left << self.half) | right

    def _walk(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(numbers.astype(np.uint64), back)
        while len(out := np.flatnonzero(x >= _U(self.n))):
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


class Layout:
    """Sizes that follow from the sequence length, the vocabulary and the table's size."""

    def __init__(self, length: int, vocabulary: int, n: int = 0):
        self.length = length
        self.kind = np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")
        self.stride = HEAD.size + length * self.kind.itemsize + 1
        shard = min(max(SHARD_BYTES, MOST_SHARD_BYTES), max(SHARD_BYTES, n * self.stride // SHARDS))
        self.per_shard = max(1, shard // self.stride)
        self.record = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("part", "<i4"), ("used", "<i4"), ("ids", self.kind, (length,)), ("end", "u1")])


def binaries(data: bytes, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of some bytes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def numbered(tokens: DataFrame, layout: Layout, end_id: int, encoder: Encoder | None = None) -> DataFrame:
    """Stage (doc_id, ids, file, first, before, begins): the ids as bytes with the end mark,
    and the number of sequences before the row in its slice. A slice is a run of rows of one
    file that a task reads in order; (file, first row) orders the slices of a table
    whatever the tasks."""
    names = ["doc_id", "ids", "file", "first", "before", "begins"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder() if encoder else None
        file, last, first, before = None, None, 0, 0
        for batch in batches:
            for piece in slices(batch):
                doc_ids, own, files, rows = (piece.column(i) for i in range(4))
                if encode:
                    flat, counts = encode(own)
                else:
                    held = [x or b"" for x in own.to_pylist()]
                    flat, counts = np.frombuffer(b"".join(held), layout.kind), np.fromiter(map(len, held), np.int64, len(held)) // layout.kind.itemsize
                ends = np.cumsum(counts)
                ids = np.insert(flat.astype(layout.kind), ends, layout.kind.type(end_id))
                sequences = -(-(counts + 1) // layout.length)
                out: list = [[], [], []]
                for name, row, n in zip(files.to_pylist(), rows.to_pylist(), sequences.tolist()):
                    begins = name != file or row != last + 1
                    if begins:
                        file, first, before = name, row, 0
                    last = row
                    for column, value in zip(out, (first, before, begins)):
                        column.append(value)
                    before += n
                made = [doc_ids, binaries(ids.tobytes(), (counts + 1) * layout.kind.itemsize), files]
                made += [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays(made, names)

    made = tokens.select("doc_id", "text" if encoder else "ids", "file", "row").mapInArrow(count, "doc_id long, ids binary, file string, first long, before long, begins boolean")
    return staged(made, "sequences", **{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"})


def offsets(held: DataFrame, layout: Layout) -> DataFrame:
    """(file, first, base, slices, n): per slice the sequences before it. Prefix sums over
    the slices of a file, and over the files."""
    parts = F.ceil(F.octet_length("ids") / (layout.kind.itemsize * layout.length))
    runs = held.groupBy("file", "first").agg(F.sum(parts).alias("n"), F.count_if("begins").alias("slices"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.sum("n").over(earlier(Window.partitionBy("file").orderBy("first")))
    files = runs.groupBy("file").agg(F.sum("n").alias("_all"))
    before = files.select(F.col("file").alias("_file"), F.sum("_all").over(earlier(Window.orderBy("file"))).alias("_before"))
    joined = runs.withColumn("_inside", inside).join(before, F.col("file").eqNullSafe(F.col("_file")))
    base = F.coalesce("_inside", F.lit(0)) + F.coalesce("_before", F.lit(0))
    return staged(joined.select("file", "first", base.alias("base"), "slices", "n"), "slices")


def materialise(tokens: DataFrame, key: int, end_id: int, vocabulary: int, length: int = 256, path: str | None = None, encoder: Encoder | None = None) -> tuple[str, Layout, int]:
    """Write the shards of (doc_id, ids, file, row); return folder, layout and N. ``ids``
    are the bytes of the layout's number type. With an ``encoder`` the rows have a ``text``
    instead: called once per task, it gives a function from an array of texts to all their
    ids in a row and the number of each, so that texts go to a worker once and don't return.

    A document without ids (or null ids) is one sequence that holds the end mark; a null
    doc_id stays null. Equal rows are sequences of their own. An empty table writes nothing.
    ``file`` and ``row`` give the rows their order and must tell any two rows apart, so take
    the whole path of the file; if they don't, that is an error. Other columns don't matter.
    """
    spark = tokens.sparkSession
    importable(spark)
    held = numbered(tokens, Layout(length, vocabulary), end_id, encoder)
    starts = offsets(held, Layout(length, vocabulary))
    total = starts.agg(F.sum("n").alias("n"), F.max("slices").alias("slices"), F.count("*").alias("count")).first()
    n = total["n"] or 0
    if (total["slices"] or 0) > 1:
        raise ValueError("file and row don't tell the rows apart")
    layout = Layout(length, vocabulary, n)
    if path is None:
        path = scratch_path(spark, "shards")
        forget_at_exit(spark, path)
    if not n:
        return path, layout, 0
    shards = -(-n // layout.per_shard)
    waves = max(min(LEAST_WAVES, shards), -(-shards // WAVE_SHARDS))
    agree(spark, path, {"key": key, "n": n, "length": length, "vocabulary": vocabulary, "end_id": end_id, "per_shard": layout.per_shard, "waves": waves})
    if total["count"] <= MOST_REPLICATED:
        starts = F.broadcast(starts)
    own = starts.select(F.col("file").alias("_file"), F.col("first").alias("_first"), "base")
    met = F.col("file").eqNullSafe(F.col("_file")) & (F.col("first") == F.col("_first"))
    ready = held.join(own, met).select("doc_id", "ids", (F.col("base") + F.col("before")).alias("start"))
    permutation, size = Permutation(n, key), layout.kind.itemsize

    def place(low: int, high: int):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin in range(0, batch.num_rows, 512):
                    yield records(batch.slice(begin, 512))

        def records(batch: pa.RecordBatch) -> pa.RecordBatch:
            bodies = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) // size
            counts = -(-sizes // length)
            owner = np.repeat(np.arange(len(counts)), counts)
            part = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            slot = permutation.slots(batch.column(2).to_numpy()[owner] + part)
            mine = np.flatnonzero((slot >= low) & (slot < high))
            slot, owner, part = slot[mine], owner[mine], part[mine]
            flat = np.append(np.frombuffer(b"".join(bodies), layout.kind), np.full(length, end_id, layout.kind))
            begins = (np.cumsum(sizes) - sizes)[owner] + part * length
            made = np.zeros(len(mine), layout.record)
            made["slot"] = slot
            made["doc_id"] = batch.column(0).fill_null(NO_ID).to_numpy()[owner]
            made["part"], made["used"] = part, np.minimum(length, sizes[owner] - part * length)
            made["ids"] = np.lib.stride_tricks.sliding_window_view(flat, length)[begins]
            short = np.flatnonzero(made["used"] < length)
            made["ids"][short] = np.where(np.arange(length) < made["used"][short, None], made["ids"][short], layout.kind.type(end_id))
            raw = made.view(np.uint8).reshape(len(mine), layout.stride)[:, :-1]
            body = binaries(raw.tobytes(), np.full(len(mine), layout.stride - 1))
            return pa.RecordBatch.from_arrays([pa.array(slot), body], ["slot", "body"])

        return step

    kept = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # a wave's shuffle files go when it is written
    try:
        for wave in range(waves):
            first, last = shards * wave // waves, shards * (wave + 1) // waves
            if not done(spark, f"{path}/wave={wave}"):
                rows = ready.mapInArrow(place(first * layout.per_shard, last * layout.per_shard), "slot long, body binary")
                shard = rows.withColumn("shard", F.floor(F.col("slot") / F.lit(layout.per_shard)).cast("long"))
                dealt = shard.repartitionById(last - first, (F.col("shard") - first).cast("int")).sortWithinPartitions("shard", "slot")
                dealt.select(F.col("body").cast("string").alias("value"), "shard").write.mode("overwrite").partitionBy("shard").option("lineSep", "\n").text(f"{path}/wave={wave}")
    finally:
        spark.conf.unset(CLEANUP) if kept is None else spark.conf.set(CLEANUP, kept)
    discard(held)
    return path, layout, n


def agree(spark: SparkSession, path: str, values: dict) -> None:
    """Write the manifest of a folder of shards, or compare it with the one it has."""
    folder, text = f"{path}/manifest", json.dumps(values, sort_keys=True)
    if done(spark, folder):
        held = "".join(r["value"] for r in spark.read.text(folder).collect())  # one line
        if held != text:
            raise ValueError(f"{path} holds shards of {held}, not of {text}")
        return
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(folder)


def done(spark: SparkSession, folder: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(folder + "/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def read_shards(spark: SparkSession, path: str, layout: Layout, from_slot: int = 0) -> DataFrame:
    """Sequences from a slot on: slot, shard, byte_offset, doc_id, part, n_tokens, ids (the
    bytes of the ids used). Files before the slot are not opened."""
    importable(spark)
    schema = "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, ids binary"
    names = [c.strip().split()[0] for c in schema.split(",")]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = np.frombuffer(content.as_buffer(), layout.record)
                for begin in range(0, len(raw), 2048):
                    rows = raw[begin : begin + 2048]
                    place = np.arange(begin, begin + len(rows))
                    if (rows["slot"] != place + shard * layout.per_shard).any():
                        raise ValueError(f"shard {shard} holds a record out of its place")
                    keep = place + shard * layout.per_shard >= from_slot
                    rows, place = rows[keep], place[keep]
                    inside = np.arange(layout.length)[None] < rows["used"][:, None]
                    ids = binaries(rows["ids"][inside].tobytes(), rows["used"] * layout.kind.itemsize)
                    doc = pa.array(rows["doc_id"], mask=rows["doc_id"] == NO_ID)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place + shard * layout.per_shard), pa.array(np.full(len(rows), shard)), pa.array(place * layout.stride), doc, pa.array(rows["part"]), pa.array(rows["used"]), ids],
                        names,
                    )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{path}/wave=*")
    number = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("long")
    wanted = files.select(number.alias("shard"), "content").filter(F.col("shard") >= from_slot // layout.per_shard)
    return wanted.mapInArrow(step, schema)
