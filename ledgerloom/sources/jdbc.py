"""Remote tables behind one reader interface: JDBC, or a parquet folder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Rows one task should read from a database, and the most connections at a time.
TASK_ROWS = 1_000_000
MOST_CONNECTIONS = 64


@dataclass(frozen=True)
class JdbcTable:
    """Connection and table. Credentials come from the caller, never from code."""

    url: str
    table: str
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def base_options(self) -> dict[str, str]:
        options = {"url": self.url, "dbtable": self.table, **self.properties}
        if self.driver:
            options["driver"] = self.driver
        return options

    def read_options(
        self,
        partition_column: str | None = None,
        low=None,
        high=None,
        partitions: int = 1,
        fetch_size: int = 10_000,
    ) -> dict[str, str]:
        """Split reads by a column range, so that no single task pulls the whole
        table, and bound the rows a driver buffers per round trip."""
        options = {**self.base_options(), "fetchsize": str(fetch_size)}
        options["pushDownPredicate"] = "true"
        if partition_column is None:
            if partitions > 1:
                raise ValueError("several partitions need a partition column and its range")
            return options
        if low is None or high is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(partitions),
        )
        return options

    def write_options(self, batch_size: int = 10_000, partitions: int | None = None) -> dict[str, str]:
        """Batched inserts; ``partitions`` bounds the open connections."""
        options = {**self.base_options(), "batchsize": str(batch_size)}
        if partitions is not None:
            options["numPartitions"] = str(partitions)
        return options

    def split_query(self, column: str) -> str:
        """What the database is asked before a split read: one row."""
        return f"SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT(*) AS cnt FROM {self.table}"

    @staticmethod
    def split_of(column: str, low, high, count: int, task_rows: int = TASK_ROWS, most: int = MOST_CONNECTIONS) -> dict:
        """A split by the range of a column into as many parts as the table has rows for;
        none where the column has no values. ``most`` bounds the open connections."""
        parts = max(1, min(most, -(-count // task_rows)))
        if low is None or parts == 1:
            return {}
        return {"partition_column": column, "low": low, "high": high, "partitions": parts}

    def measured_split(self, spark: SparkSession, column: str, **sizes) -> dict:
        """The split for a read of the whole table, by the bounds and the count that the
        database gives for an indexed column."""
        options = {k: v for k, v in self.base_options().items() if k != "dbtable"}
        row = spark.read.format("jdbc").options(**options, query=self.split_query(column)).load().first()
        return self.split_of(column, row[0], row[1], int(row[2]), **sizes)

    def read(self, spark: SparkSession, split_on: str | None = None, **split) -> DataFrame:
        """``split_on`` names a number, date or time column with an index: the read is split
        by its measured range. Without it and without a range of its own, one task reads
        everything, so leave it out only for small tables."""
        if split_on is not None:
            split |= self.measured_split(spark, split_on)
        return spark.read.format("jdbc").options(**self.read_options(**split)).load()

    def append(self, df: DataFrame, **batching) -> None:
        df.write.format("jdbc").mode("append").options(**self.write_options(**batching)).save()


@dataclass(frozen=True)
class ParquetTable:
    """A parquet folder that stands in for a remote table."""

    path: str

    def read(self, spark: SparkSession, split_on: str | None = None) -> DataFrame:
        return spark.read.parquet(self.path)

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)


def count_where(spark: SparkSession, remote: JdbcTable | ParquetTable, condition, **split) -> DataFrame:
    """Count of the remote rows that meet a condition; the filter and the count
    are pushed to the source where it can take them."""
    return remote.read(spark, **split).filter(condition).agg(F.count("*").alias("cnt"))
