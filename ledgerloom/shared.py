"""Places for intermediate tables: the shared folder the cluster names.

Every job that must cut lineage or re-read its own result writes a table here,
so a lost executor costs a task retry and never the data.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, a folder inside the
    warehouse, but only if all work is done on this machine: on a cluster the warehouse
    may be a folder of the driver's disk, so there the setting is asked for."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/") + "/_scratch"


_opened: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """The application's own folder under the shared one; all of it is removed when the
    application ends."""
    folder = f"{shared_root(spark)}/ledgerloom/{spark.sparkContext.applicationId}"
    if folder not in _opened:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(place)
        system.deleteOnExit(place)
        _opened.add(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def create_namespace(spark: SparkSession, name: str, location: str) -> str:
    """Create a schema whose managed tables live under ``location``."""
    place = location.replace("'", "\\'")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{place}'")
    return name


def scratch_namespace(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh schema in the shared folder for the tables of one job."""
    name = f"loom_{label}_{uuid.uuid4().hex[:12]}"
    return create_namespace(spark, name, scratch_path(spark, name))
