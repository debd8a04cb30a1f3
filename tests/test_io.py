"""Sources and sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import shared
from ledgerloom.operators import layout
from ledgerloom.schemas import ACCOUNTS, COMPANIES, FACT, WEATHER
from ledgerloom.seeds import companies
from ledgerloom.sinks import tables
from ledgerloom.sources.files import read_csv, read_parquet, write_parquet
from ledgerloom.sources.jdbc import JdbcTable, ParquetTable, count_where
from ledgerloom.sources.rejects import LoadColumn, TooManyRejects, load_csv, zoned_timestamp
from ledgerloom.plans import weather

TEXT = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    rows = [("x", ""), (None, "a,b"), ('say "hi"', None), ("", "z")]
    path = str(tmp_path / "csv")
    tables.write_csv(spark.createDataFrame(rows, TEXT), path)
    assert sorted(map(repr, (tuple(r) for r in read_csv(spark, path, TEXT).collect()))) == sorted(map(repr, rows))


def test_csv_timestamps_keep_microseconds(spark, tmp_path):
    moments = [dt.datetime(1750, 2, 1), dt.datetime(2024, 1, 2, 3, 4, 5, 678901)]
    schema = T.StructType([T.StructField("t", T.TimestampNTZType())])
    path = str(tmp_path / "csv")
    tables.write_csv(spark.createDataFrame([(m,) for m in moments], schema), path)
    assert sorted(r.t for r in read_csv(spark, path, schema).collect()) == moments


@pytest.mark.parametrize("zone", ["UTC", "Europe/Moscow"])
def test_historic_times_do_not_shift(spark, tmp_path, zone):
    schema = T.StructType([T.StructField("city_name", T.StringType()), T.StructField("date", T.TimestampNTZType()), T.StructField("__index_level_0__", T.LongType())])
    first = dt.datetime(1750, 2, 1)
    path = str(tmp_path / "weather")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.createDataFrame([("a", first, 1), (None, first, 2), ("b", dt.datetime(2023, 9, 5), 3)], schema)
        write_parquet(weather.clean(raw), path, legacy_dates=True)
        cleaned = read_parquet(spark, path, legacy_dates=True)
        assert cleaned.columns == ["city_name", "date"]
        assert cleaned.agg(F.min("date"), F.count("*")).first() == (first, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert spark.conf.get("spark.sql.parquet.datetimeRebaseModeInWrite") != "LEGACY"


def test_legacy_dates_differ_only_by_their_calendar(spark, tmp_path):
    path = str(tmp_path / "old")
    days = [dt.date(1500, 3, 1), dt.date(1582, 10, 4), dt.date(1833, 1, 2)]
    write_parquet(spark.createDataFrame([(d,) for d in days], "d date"), path, legacy_dates=True)
    assert sorted(r.d for r in read_parquet(spark, path, legacy_dates=True).collect()) == days


LINES = """station_id,city_name,dt
1,"Moscow, RU",2000-01-01T00:00:00.000+03:00
2,,2000-01-01T00:00:00.000+03:00
3,"",
x4,Perm,2000-01-01T00:00:00.000+03:00
5,Perm,yesterday
6,Perm
7,Perm,2000-01-02T00:00:00.000+03:00,extra
99999999999,Perm,2000-01-02T00:00:00.000+03:00
"""
COLUMNS = [LoadColumn("station_id", "int"), LoadColumn("city_name", "string"), LoadColumn("dt", "timestamp", zoned_timestamp)]


def test_load_parts_good_rows_from_bad_ones(spark, tmp_path):
    file = tmp_path / "weather.csv"
    file.write_text(LINES)
    result = load_csv(spark, str(file), COLUMNS, error_limit=5)
    seconds = result.good.select("station_id", "city_name", F.unix_seconds("dt").alias("s")).orderBy("station_id")
    assert [tuple(r) for r in seconds.collect()] == [
        (1, "Moscow, RU", 946674000), (2, None, 946674000), (3, "", None),
    ]
    bad = sorted((r.bad_column, r.line.split(",")[0]) for r in result.rejects.collect())
    assert bad == [("(line)", "6"), ("(line)", "7"), ("dt", "5"), ("station_id", "99999999999"), ("station_id", "x4")]
    assert tuple(result.report().first()) == (8, 3, 5, 5)
    with pytest.raises(TooManyRejects):
        load_csv(spark, str(file), COLUMNS, error_limit=4)
    with pytest.raises(TooManyRejects):
        load_csv(spark, str(file), COLUMNS, error_share=0.6)
    assert load_csv(spark, str(file), COLUMNS, error_share=0.63).error_limit == 5


def test_rejects_are_the_lines_of_the_files(spark, tmp_path):
    head, stamp = "station_id,city_name,dt", "2000-01-01T00:00:00.000+03:00"
    files = {
        "a.csv": [head, f'1,"x, ""y""",{stamp}', "", f'x,"a, ""b""",{stamp}', "   ", f'2,"open,{stamp}', f"3,p,{stamp}", "4,p,never"],
        "b.csv": [f"9,the head is a row,{stamp}", f"8,q,{stamp}", f'y1,"",{stamp}'],
        "c.csv": [head],
        "d.csv": [head] + [f"{'z' if i % 100 == 7 else ''}{i},city {i},{stamp}" for i in range(2000)],
    }
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if name != "b.csv" else ""))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "8k")  # a file of many splits
    try:
        result = load_csv(spark, str(tmp_path), COLUMNS)
        rejects = [(r.file.rsplit("/", 1)[1], r.line_no, r.bad_column, r.line) for r in result.rejects.collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert all(files[f][n - 1] == line for f, n, _, line in rejects)
    want = [("a.csv", 4, "station_id"), ("a.csv", 6, "(line)"), ("a.csv", 8, "dt"), ("b.csv", 3, "station_id")]
    want += [("d.csv", i + 2, "station_id") for i in range(7, 2000, 100)]
    assert sorted(r[:3] for r in rejects) == sorted(want)
    good = {(r.station_id, r.city_name) for r in result.good.collect()}
    assert {(1, 'x, "y"'), (3, "p"), (8, "q")} <= good and len(good) == 3 + 1980
    assert tuple(result.report().first())[:3] == (4 + 1 + 2 + 2000, 1983, 24)


def test_bulk_loads_append_to_the_buckets(spark, tmp_path):
    stamp = "2000-01-%02dT00:00:00.000+03:00"
    line = lambda i: f"{i % 40},city,{stamp % (i % 20 + 1)},winter,{i}" + "," * 9
    name = weather.create_loaded(spark, shared.scratch_namespace(spark), buckets=4)
    for load in range(2):
        (tmp_path / f"{load}.csv").write_text("head\n" + "\n".join(line(i) for i in range(load * 500, load * 500 + 500)) + "\n")
        weather.bulk_load(spark, str(tmp_path / f"{load}.csv"), name, error_limit=0)
    (tmp_path / "bad.csv").write_text("head\n" + line(1) + "\nno line\n")
    with pytest.raises(TooManyRejects):
        weather.bulk_load(spark, str(tmp_path / "bad.csv"), name, error_limit=0)
    assert spark.table(name).count() == 1000
    assert len(spark.table(name).inputFiles()) == 8  # a file a bucket and load
    rows = weather.by_station_and_day(spark.table(name))
    found = {(r.station_id, r.dt.day if r.dt.hour == 0 else r.dt.day + 1): (r.cnt, r.avg_temp_sum) for r in rows.collect()}
    want = {}
    for i in range(1000):
        n, total = want.get((i % 40, i % 20), (0, 0))
        want[i % 40, i % 20] = (n + 1, total + i)
    assert sorted(found.values()) == sorted(want.values()) and len(found) == len(want)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Bucketed: true" in text


def test_declared_table(spark):
    space = shared.scratch_namespace(spark)
    name = tables.create_table(spark, f"{space}.{COMPANIES.name}", COMPANIES)
    tables.append_rows(companies(spark), name)
    row = spark.table(name).filter("company_id = 6").first()
    assert (row.parent_company_id, row.dttm_start, row.dttm_end.year) == (4, dt.datetime(1900, 1, 1), 3000)
    described = {r.col_name: (r.data_type, r.comment) for r in tables.describe(spark, name).collect()}
    assert described["company_id"] == ("int", "company key")
    assert tables.tables_in(spark, space) == [COMPANIES.name]
    tables.empty_table(spark, name)
    assert spark.table(name).count() == 0
    assert FACT.required == ["transaction_id", "transaction_dt", "company_id", "account_id", "amount", "currency_code"]
    assert ACCOUNTS.limits == {"account_id": 20, "parent_account_id": 20, "account_description": 200}
    assert len(WEATHER.columns) == 14


def test_insert_matches_columns_by_name(spark):
    name = f"{shared.scratch_namespace(spark)}.t"
    tables.create_as(spark.createDataFrame([(1, "x")], "a int, b string"), name)
    tables.append_rows(spark.createDataFrame([("y", 2)], "b string, a int"), name)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "x"), (2, "y")]


def test_jdbc_options():
    remote = JdbcTable("jdbc:postgresql://host/db", "public.acc_data", "org.postgresql.Driver", {"user": "u"})
    split = remote.read_options("transaction_id", 0, 1000, 8)
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "transaction_id"
    assert split["fetchsize"] == "10000" and split["user"] == "u" and split["dbtable"] == "public.acc_data"
    assert "partitionColumn" not in remote.read_options()
    assert remote.write_options(500, 4) == {
        "url": "jdbc:postgresql://host/db", "dbtable": "public.acc_data", "user": "u",
        "driver": "org.postgresql.Driver", "batchsize": "500", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        remote.read_options(partitions=4)
    with pytest.raises(ValueError):
        remote.read_options("id", partitions=4)


def test_a_read_of_a_remote_table_is_split_by_its_rows():
    remote = JdbcTable("jdbc:postgresql://host/db", "public.acc_data")
    assert remote.split_query("id") == "SELECT MIN(id) AS low, MAX(id) AS high, COUNT(*) AS cnt FROM public.acc_data"
    split = remote.split_of("id", 1, 9_000_000, 5_500_000)
    options = remote.read_options(**split)
    assert (options["numPartitions"], options["lowerBound"], options["upperBound"]) == ("6", "1", "9000000")
    assert remote.split_of("id", 1, 10**12, 10**12)["partitions"] == 64
    assert remote.split_of("id", None, None, 0) == {} and remote.split_of("id", 1, 5, 5) == {}
    day = remote.split_of("dt", dt.date(1750, 2, 1), dt.date(2023, 9, 5), 27_621_770)
    assert day["partitions"] == 28 and remote.read_options(**day)["lowerBound"] == "1750-02-01"


def test_remote_stand_in(spark, tmp_path):
    remote = ParquetTable(str(tmp_path / "remote"))
    remote.append(spark.range(10))
    remote.append(spark.range(5))
    assert count_where(spark, remote, F.col("id") < 5).first().cnt == 10


def test_layout_figures_match_the_files(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(1000).withColumn("part", F.col("id") % 4).write.partitionBy("part").parquet(str(path))
    files = layout.stored_files(spark.read.parquet(str(path)), ["part"])
    sizes = layout.partition_sizes(files, ["part"]).collect()
    on_disk = {int(d.name.split("=")[1]): sum(f.stat().st_size for f in d.glob("*.parquet")) for d in path.glob("part=*")}
    assert {r.part: r.size_bytes for r in sizes} == on_disk
    assert [r.size_bytes for r in sizes] == sorted(on_disk.values(), reverse=True)
    assert layout.estimated_count(files).first()[0] == 1000.0
    assert layout.stored_bytes(spark.read.parquet(str(path))).first().size_bytes == sum(on_disk.values())


def test_timed_load(spark, tmp_path):
    seconds = weather.timed_load(spark.range(10), lambda df: df.write.parquet(str(tmp_path / "x")))
    assert seconds > 0 and spark.read.parquet(str(tmp_path / "x")).count() == 10


def test_shared_root_is_the_configured_folder(spark):
    assert shared.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_goes_when_the_application_ends(tmp_path):
    """In a process of its own: the folder is there while it runs, and gone afterwards."""
    import subprocess
    import sys

    code = f"""
import os
from ledgerloom.session import build_session
from ledgerloom import shared
spark = build_session("x", "local[1]", {str(tmp_path)!r}, spark__sql__warehouse__dir={str(tmp_path / 'wh')!r})
spark.range(3).write.parquet(shared.scratch_path(spark, "a"))
space = shared.scratch_namespace(spark)
spark.range(3).write.saveAsTable(space + ".t")
print(len(os.listdir(shared.scratch_folder(spark))))
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=shared.__file__.rsplit("/", 2)[0], timeout=120)
    assert done.stdout.strip().endswith("2"), done.stderr[-2000:]
    left = [f for f in (tmp_path / "ledgerloom").iterdir()] if (tmp_path / "ledgerloom").exists() else []
    assert left == []


def test_shared_root_refuses_a_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        shared.shared_root(Cluster())


def test_clustered_rewrite_keeps_a_city_in_few_files(spark, tmp_path):
    rows = spark.range(20000).select(
        F.concat(F.lit("city "), (F.col("id") * 31 % 40).cast("string")).alias("city_name"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 500).cast("int")).alias("dt"),
    )
    written = layout.rewrite_columnar(rows, str(tmp_path / "c"), ["city_name", "dt"], 8)
    files = layout.stored_files(written, ["city_name"]).groupBy("city_name").agg(F.count("*").alias("n")).collect()
    assert len(files) == 40 and max(r.n for r in files) <= 2
    assert written.count() == 20000
    # A city that holds a third of the rows is spread by its days.
    hot = rows.withColumn("city_name", F.when(F.col("dt") < dt.date(2000, 6, 1), "hot").otherwise(F.col("city_name")))
    written = layout.rewrite_columnar(hot, str(tmp_path / "h"), ["city_name", "dt"], 8)
    files = layout.stored_files(written, ["city_name"]).filter("city_name = 'hot'").collect()
    assert len(files) >= 2 and written.count() == 20000
