"""Reports on stored tables: files, sizes, estimated counts and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.sizes import pretty_size


def stored_files(table: DataFrame, by: list[str], values: Column | None = None) -> DataFrame:
    """One row per data file: its partition values, size and rows. Only the file
    footers and the partition values are read, unless ``values`` is given: the bytes of
    a row's values, which are added up per file."""
    summed = [] if values is None else [F.sum(values.cast("bigint")).alias("value_bytes")]
    return table.groupBy(
        *by,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count("*").alias("row_cnt"), *summed)


def partition_sizes(
    files: DataFrame, by: list[str], prefix: str | None = None, minimum: int = 0
) -> DataFrame:
    """Files, rows, bytes and size text per partition, largest first; optionally
    only labels with a prefix and sizes above a minimum."""
    sizes = files.groupBy(*by).agg(
        F.count("*").alias("file_cnt"),
        F.sum("row_cnt").alias("row_cnt"),
        F.sum("file_size").alias("size_bytes"),
    )
    if prefix is not None:
        sizes = sizes.filter(F.col(by[0]).like(f"{prefix}%"))
    if minimum:
        sizes = sizes.filter(F.col("size_bytes") > minimum)
    return sizes.withColumn("size", pretty_size(F.col("size_bytes"))).orderBy(
        F.desc_nulls_first("size_bytes"), *[F.asc_nulls_last(c) for c in by]
    )


def estimated_count(files: DataFrame) -> DataFrame:
    """Sum of the per-file row counts, which arrive as text from each part."""
    parts = files.select(F.col("row_cnt").cast("string").alias("result"))
    return parts.agg(F.sum(F.col("result").cast("double")).alias("estimated_count"))


def refresh_statistics(spark: SparkSession, table: str, rows: bool = True) -> dict[str, int]:
    """Recompute a table's statistics and read them back: bytes and, unless only
    the file sizes are wanted (no data is read then), rows."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{'' if rows else ' NOSCAN'}")
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Statistics'").collect()
    numbers = {}
    for part in found[0]["data_type"].split(","):
        value, unit = part.split()
        numbers[unit] = int(value)
    return numbers


def rewrite_columnar(
    source: DataFrame, path: str, cluster_by: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """Rewrite a table as parquet. ``cluster_by`` range-partitions and sorts the
    rows, so that the minimum and maximum of a row group let a filter skip it;
    name a selective last column, or a hot first value stays in one range."""
    if cluster_by:
        spread = (
            source.repartitionByRange(partitions, *cluster_by)
            if partitions
            else source.repartitionByRange(*cluster_by)
        )
        source = spread.sortWithinPartitions(*cluster_by)
    source.write.mode("overwrite").parquet(path)
    return source.sparkSession.read.parquet(path)


def value_bounds(source: DataFrame, columns: list[str], bits: int) -> list[list]:
    """Per column up to 2 ** bits - 1 values that part its rows into equal shares; a value
    that fills several shares is named once. One pass, a few numbers come back."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = source.agg(*[F.percentile_approx(F.col(f"`{c}`"), shares, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
    return [sorted(set(values or ())) for values in found]


def share_number(value: Column, bounds: list) -> Column:
    """How many of the bounds lie below a value, by a tree of comparisons. Nulls come last."""
    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(bounds[middle]), below(low, middle)).otherwise(below(middle + 1, high))

    return below(0, len(bounds))


def interleaved(numbers: list[Column], bits: int) -> Column:
    """One number of the bits of several, the highest of each first: rows that lie close
    in it lie close in all of them."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(reversed(numbers)):
            own = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key.bitwiseOR(F.shiftleft(own, bit * len(numbers) + place))
    return key


def rewrite_clustered(
    source: DataFrame, path: str, cluster_by: list[str], bits: int = 6, file_rows: int = 1 << 22, group_bytes: int | None = None
) -> DataFrame:
    """Rewrite a table as parquet so that a filter on any one of several ordered columns
    skips row groups. The columns are parted into equal shares and the rows sorted by the
    interleaved bits of their share numbers; a file per ``file_rows`` rows. A value that a
    third of the rows have is one share of its column and is spread by the others."""
    bounds = value_bounds(source, cluster_by, bits)
    numbers = [share_number(F.col(f"`{c}`"), b) for c, b in zip(cluster_by, bounds)]
    keyed = source.withColumn("_cluster", interleaved(numbers, bits))
    order = ["_cluster", *cluster_by]
    files = max(1, -(-source.count() // file_rows))
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_cluster")
    writer = dealt.write.mode("overwrite")
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path)


def stored_bytes(table: DataFrame) -> DataFrame:
    """Bytes and files of a stored table."""
    files = stored_files(table, [])
    return files.agg(F.sum("file_size").alias("size_bytes"), F.count("*").alias("file_cnt"))
