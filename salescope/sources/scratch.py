"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from salescope.session import settings

# A stored step ends its job, so the shuffle files behind it are of no more use.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_folder(spark: SparkSession) -> str | None:
    """The folder in ``spark.checkpoint.dir``, if the session names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path that all executors share: below ``spark.checkpoint.dir``, or else in the warehouse."""
    folder = shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/salescope/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where several later steps read the same result: the lineage ends at replicated files, so a lost
    executor costs a re-read, and each reader scans only its own columns and partitions. Without
    ``spark.checkpoint.dir`` the lineage stays and the rows are kept on the executors' disks instead, from
    where Spark computes them again if they are lost.
    """
    spark = df.sparkSession
    if not shared_folder(spark):
        return df.persist(StorageLevel.DISK_ONLY)
    path = new_path(spark, label)
    with settings(spark, FREE_SHUFFLES):
        df.write.partitionBy(*partition_by).parquet(path)
    columns = [f for f in df.schema.fields if f.name not in partition_by]
    columns += [df.schema[name] for name in partition_by]
    return spark.read.schema(type(df.schema)(columns)).parquet(path)


def materialize_observed(
    df: DataFrame, label: str, metrics: Mapping[str, Column], partition_by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``materialize``, and one row of aggregates over all rows, gathered by the tasks that write them.

    The tasks of the last stage count, each partition once, also where tasks or stages run again. Where nothing is
    written the row is taken from the kept rows.
    """
    aggregates = [value.alias(name) for name, value in metrics.items()]
    schema = df.agg(*aggregates).schema
    spark = df.sparkSession
    if not shared_folder(spark):
        stored = materialize(df, label, partition_by)
        return stored, spark.createDataFrame([stored.agg(*aggregates).first()], schema)
    seen = Observation(label)
    stored = materialize(df.observe(seen, *aggregates), label, partition_by)
    found = seen.get
    return stored, spark.createDataFrame([tuple(found[name] for name in metrics)], schema)


def table_prefix(application: str) -> str:
    """How the names of an application's tables begin in the catalog."""
    return f"salescope_{application.replace('-', '_')}_".lower()


def release(spark: SparkSession, application: str | None = None) -> None:
    """Delete what an application (this one by default) stored: its folder, and its tables in the session's catalog.

    To be called when no result of it is read any more.
    """
    application = application or spark.sparkContext.applicationId
    for table in spark.catalog.listTables(pattern=f"{table_prefix(application)}*"):
        spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    folder = shared_folder(spark)
    if folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/salescope/{application}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> tuple[tuple[str, int, int], ...]:
    """(name, size, time of change) of the files at some paths, to tell whether stored results still belong to them."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for text in paths:
        path = hadoop.Path(text)
        for status in path.getFileSystem(conf).listStatus(path):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads."""
    return sum(size for _, size, _ in fingerprint(df.sparkSession, df.inputFiles()))
