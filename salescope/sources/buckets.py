"""Tables stored in buckets by a join key, so that joins on it need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.session import settings
from salescope.sources.scratch import FREE_SHUFFLES, materialize, new_path, shared_folder, table_prefix


def store_bucketed(
    df: DataFrame, label: str, key: str, buckets: int | None = None, columns: Sequence[Column] = ()
) -> DataFrame:
    """``df`` as a table in ``buckets`` sorted files by ``key``, as many as shuffle partitions by default.

    Rows are dealt by the key first, so each bucket is written by one task as one file. Tables with the same number of
    buckets join on the key where they lie. ``columns``, the key among them, are made from those of ``df`` after the rows
    were dealt, so only what they are made from is shuffled. Without a shared folder the rows are kept as ``materialize``
    keeps them.
    """
    spark = df.sparkSession
    shown = columns or [F.col(c) for c in df.columns]
    if not shared_folder(spark):
        return materialize(df.select(*shown), label)
    place = next((c for c in columns if df.select(c).columns == [key]), F.col(key))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{table_prefix(spark.sparkContext.applicationId)}{label}_{uuid.uuid4().hex}"
    with settings(spark, FREE_SHUFFLES):
        dealt = df.repartition(buckets, place).select(*shown)
        dealt.write.bucketBy(buckets, key).sortBy(key).option("path", new_path(spark, label)).saveAsTable(name)
    return spark.table(name)
