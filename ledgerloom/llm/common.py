"""Helpers the operators share: staged tables, columns that may be missing, Arrow steps."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.shared import scratch_path

# The characters that separate words in every contract: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# Rows that an executor holds at once, by bytes or by few rows: Spark's own bounds (64 MB to
# a Python worker, 4096 rows of a file) let a task on texts hold tens of MB in buffers that
# double as they grow, and an executor keeps what they took. The first is a little below what
# ``slices`` cuts at, as a batch ends with the row that passes it.
BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(15 << 16),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def importable(spark: SparkSession) -> None:
    """Ready a session for the operators. Python workers find this package where it is not
    installed: they get the path the driver has it at, unless the session names a PYTHONPATH
    of its own. Batches are small, unless the session sets their bounds."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *wanted: tuple[str, str]) -> DataFrame:
    """Just the named columns, cast; extra columns never get into an operator."""
    importable(df.sparkSession)
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in wanted])


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage, so a lost
    executor costs a re-read and not a recomputation. Removed when the application ends."""
    spark = df.sparkSession
    importable(spark)
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    forget_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def forget_at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def discard(df: DataFrame) -> None:
    """Remove a staged table that has no reader left."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/ledgerloom/" in folder:
            place = jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def with_columns(
    df: DataFrame,
    reads: list[str],
    adds: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """Append columns that Python computes from Arrow batches. ``make`` runs once per
    task and returns a function from the read arrays to the added arrays."""
    importable(df.sparkSession)
    schema = T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in adds])
    names = [f.name for f in schema.fields]
    places = [df.columns.index(c) for c in reads]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        compute = make()
        for batch in batches:
            for part in slices(batch):
                added = compute(*[part.column(i) for i in places])
                yield pa.RecordBatch.from_arrays(list(part.columns) + list(added), names)
                del part, added
                release()
            del batch
        del compute
        release()

    return df.mapInArrow(step, schema)


def release() -> None:
    """Give freed memory back to the system. A worker lives on and serves other operators'
    tasks, and what the allocators keep for it counts against the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library's
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a step holds a few MB of text at a time (one row at least)."""
    if not batch.num_rows:
        return
    size = max(1, batch.nbytes // batch.num_rows)
    step = max(1, most_bytes // size)
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def free_name(name: str, columns: list[str]) -> str:
    """The name, or a longer one that no column has (whatever its case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash64(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def is_held_out(doc_id: Column) -> Column:
    """The fold no label is learnt from: crc32 of the id as text, modulo 5, is 0. A null
    id has no such remainder and counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def code_points(text: Column) -> Column:
    return F.coalesce(F.char_length(text), F.lit(0)).cast("long")
