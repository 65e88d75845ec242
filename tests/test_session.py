"""Session settings, and what is stored for an application."""

import os
import shutil

from pyspark.sql import functions as F

from salescope.plans import catalog
from salescope.session import RUNTIME_SETTINGS, tune
from salescope.sources import buckets, scratch

FOLDER = "/root/testdata/sf0.001"


def test_settings_of_the_session_are_left_as_they_are(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    tune(spark)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    tune(spark)
    assert spark.conf.get(key) == RUNTIME_SETTINGS[key]
    spark.conf.set(key, before)


def test_stored_results_follow_their_tables(spark, tmp_path):
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        shutil.copy(f"{FOLDER}/{name}.parquet", tmp_path)
    folder = str(tmp_path)
    first = catalog.control_totals(spark, folder).first()
    assert catalog.performance(spark, folder) is catalog.performance(spark, folder)
    half = spark.read.parquet(f"{FOLDER}/lineitem.parquet").where("l_orderkey % 2 = 0")
    half.coalesce(1).write.parquet(f"{tmp_path}/half")
    part = next(f for f in os.listdir(f"{tmp_path}/half") if f.startswith("part"))
    shutil.copy(f"{tmp_path}/half/{part}", f"{tmp_path}/lineitem.parquet")
    spark.catalog.refreshByPath(f"{tmp_path}/lineitem.parquet")
    second = catalog.control_totals(spark, folder).first()
    assert second.Row_Count == half.count() < first.Row_Count
    assert catalog.kpi_global(spark, folder).first().Orders == half.select("l_orderkey").distinct().count()


def test_release_deletes_what_one_application_stored(spark, monkeypatch):
    shared = scratch.shared_folder(spark)
    other = "other-app-1"
    monkeypatch.setattr(scratch, "new_path", lambda s, label: f"{shared}/salescope/{other}/{label}")
    monkeypatch.setattr(buckets, "new_path", scratch.new_path)
    monkeypatch.setattr(buckets, "table_prefix", lambda application: scratch.table_prefix(other))
    rows = spark.range(10).select(F.col("id"), (F.col("id") % 3).alias("key"))
    stored, table = scratch.materialize(rows, "rows"), buckets.store_bucketed(rows, "table", "key", 2)
    assert stored.count() == table.count() == 10 and os.path.exists(f"{shared}/salescope/{other}/rows")
    mine = {t.name for t in spark.catalog.listTables()}
    scratch.release(spark, other)
    assert not os.path.exists(f"{shared}/salescope/{other}")
    left = {t.name for t in spark.catalog.listTables()}
    assert len(mine - left) == 1 and not any(name.startswith(scratch.table_prefix(other)) for name in left)
