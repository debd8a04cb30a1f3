"""Writers: catalog tables, CSV folders, and what the target declares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.keys import continued_key
from ledgerloom.schemas import TableSpec
from ledgerloom.sources.files import ZONELESS


def create_table(
    spark: SparkSession,
    name: str,
    spec: TableSpec,
    partition_by: tuple[str, ...] = (),
    bucket_by: tuple[str, ...] = (),
    buckets: int = 0,
) -> str:
    """Create an empty parquet table with the declared columns, comments and defaults.
    ``partition_by`` may name a declared column or the text column ``part``; with
    ``bucket_by`` the rows are distributed over that many buckets by those columns."""
    def quoted(text: str) -> str:
        return text.replace("\\", "\\\\").replace("'", "\\'")

    fields = []
    for f in spec.schema:
        comment = quoted(f.metadata.get("comment", ""))
        default = f.metadata.get("default")
        given = "" if default is None else f" DEFAULT CAST('{quoted(str(default))}' AS {f.dataType.simpleString()})"
        fields.append(f"`{f.name}` {f.dataType.simpleString()}{given} COMMENT '{comment}'")
    for extra in partition_by:
        if extra not in spec.columns:
            fields.append(f"`{extra}` string COMMENT 'partition label'")
    clause = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    if bucket_by:
        by = ", ".join(f"`{c}`" for c in bucket_by)
        clause += f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(fields)}) USING parquet{clause}"
        f" COMMENT '{quoted(spec.comment)}'"
    )
    return name


def with_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the columns the rows lack: the declared default, else a typed null."""
    missing = {}
    for f in spec.schema:
        if f.name not in df.columns:
            missing[f.name] = F.lit(f.metadata.get("default")).cast(f.dataType)
    return df.withColumns(missing).select(*spec.columns) if missing else df.select(*spec.columns)


def append_rows(df: DataFrame, table: str) -> None:
    """``INSERT INTO``: columns are matched by name and put in the target's order."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.insertInto(table)


def insert_omitting(df: DataFrame, table: str) -> None:
    """``INSERT INTO table (columns of the rows)``: the columns that the rows lack get the
    default the catalog declares for them, or null."""
    columns = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {{rows}}", rows=df)


def declared_defaults(spark: SparkSession, table: str) -> dict[str, str]:
    """The default expressions that the catalog holds, by column."""
    found = {}
    for field in spark.table(table).schema:
        if "CURRENT_DEFAULT" in field.metadata:
            found[field.name] = field.metadata["CURRENT_DEFAULT"]
    return found


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return held.get(key)


def set_property(spark: SparkSession, table: str, key: str, value: str | None) -> None:
    """Set a table property, or remove it."""
    if value is None:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{key}')")
    else:
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{text}')")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has written and that has no reader left."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def append_with_identity(df: DataFrame, table: str, key: str) -> None:
    """Insert rows without a key into a table that numbers its rows: the numbers go
    on after the largest one in the table."""
    append_rows(continued_key(df, key, df.sparkSession.table(table)), table)


def bucket_layout(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets of a stored table and the columns they go by."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = rows["Bucket Columns"].strip("[]").replace("`", "")
    return int(rows["Num Buckets"]), [c.strip() for c in columns.split(",")]


def append_bucketed(df: DataFrame, table: str) -> None:
    """Insert into a table that lies in buckets. The rows are dealt by the function that
    decides the bucket, so a load adds one file to each bucket and no more."""
    buckets, columns = bucket_layout(df.sparkSession, table)
    append_rows(df.repartition(buckets, *columns), table)


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Create or replace a view in the catalog and return it."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def plan_text(df: DataFrame) -> str:
    """The physical plan as text, the way EXPLAIN FORMATTED shows it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def create_as(df: DataFrame, table: str) -> DataFrame:
    """Create a table from a query and return it."""
    df.write.saveAsTable(table)
    return df.sparkSession.table(table)


def empty_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """CSV folder with a header line; null stays an empty field and an empty
    string becomes a quoted one, so both come back as they were."""
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("timestampNTZFormat", ZONELESS)
    )
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Columns, types and comments of a table."""
    return spark.sql(f"DESCRIBE TABLE {table}")


def tables_in(spark: SparkSession, namespace: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(namespace))
