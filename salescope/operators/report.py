"""The report as one long table, and formatted figures."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions import text
from salescope.session import settings

FACT_TYPES = {
    "section": "string", "dimension": "string", "rank": "int", "segment": "string", "metric": "string",
    "value": "double", "text": "string",
}
FACT_COLUMNS = tuple(FACT_TYPES)
# Below the folder of a report: its rows by section and run, and which runs are complete.
ROWS, RUNS = "rows", "runs"
RUN_SCHEMA = "section string, run string"

# How the figures of the report are shown. Other figures are whole numbers.
MONEY_METRICS = (
    "Revenue",
    "Profit",
    "AOV",
    "RevPerCustomer",
    "RevenueLatest",
    "RevenuePrevious",
    "RevenuePrior",
    "AvgAttachBasket",
    "AddressableRevenue",
    "AddressableProfit",
    "LinearNext",
    "CagrNext",
    "Low",
    "High",
)
PERCENT_METRICS = (
    "MarginPct",
    "MarginDelta",
    "RevenueShare",
    "RevenueYoY",
    "ProfitYoY",
    "OrdersYoY",
    "CustomersYoY",
    "YoY",
    "LatestVsPrevious",
    "LatestVsPrior",
    "AttachRate",
    "AttachMargin",
    "CAGR",
    "GlobalMarginPct",
)
PLAIN_METRICS = ("NextYear",)
MILLION_METRICS = ("RevenueM", "MedianRevenueM")
POINT_METRICS = ("SharePct",)


def facts(
    df: DataFrame,
    section: str,
    values: Sequence[str] = (),
    texts: Sequence[str] = (),
    dimension: str | None = None,
    rank: str | None = None,
    segment: str | None = None,
) -> DataFrame:
    """Columns of a report table as (section, dimension, rank, segment, metric, value, text) rows."""

    def key(column: str | None, kind: str, name: str) -> str:
        return f"cast({'null' if column is None else f'`{column}`'} as {kind}) as {name}"

    figures = [f"'{v}', cast(`{v}` as double), cast(null as string)" for v in values]
    words = [f"'{t}', cast(null as double), cast(`{t}` as string)" for t in texts]
    cells = ", ".join([*figures, *words])
    return df.selectExpr(
        f"'{section}' as section",
        key(dimension, "string", "dimension"),
        key(rank, "int", "rank"),
        key(segment, "string", "segment"),
        f"stack({len(figures) + len(words)}, {cells}) as (metric, value, text)",
    )


def displayed(report: DataFrame, currency: str) -> DataFrame:
    """Report facts with a ``display`` column: money, percent, whole numbers, labels, 'N/A' where NULL.

    The headline rows hold several measures under the same metrics, so their measure name decides.
    """
    kind = F.when(
        (F.col("section") == "headline_yoy") & (F.col("metric") != "YoY"), F.col("segment")
    ).otherwise(F.col("metric"))
    shown = (
        F.when(F.col("text").isNotNull(), F.col("text"))
        .when(kind.isin(*MONEY_METRICS), text.money("value", currency))
        .when(kind.isin(*PERCENT_METRICS), text.percent("value"))
        .when(kind.isin(*MILLION_METRICS), text.millions("value", currency))
        .when(kind.isin(*POINT_METRICS), text.points("value"))
        .when(kind.isin(*PLAIN_METRICS), F.coalesce(F.col("value").cast("bigint").cast("string"), F.lit(text.MISSING)))
        .otherwise(text.grouped_number("value"))
    )
    return report.withColumn("display", shown)


def new_run() -> str:
    """A key for one writing of the report; later keys sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_facts(report: DataFrame, path: str, sections: Sequence[str] | None = None, run: str | None = None) -> str:
    """Add the report as a new run, or renew only some ``sections`` of it; gives the key of the run.

    Rows go to folders of their section and run, which no reader looks at yet; writing a run again replaces its folders.
    When all rows are there, one small file names the run for each section it renews, also for those left empty. A write
    that stops before that changes nothing for readers.
    """
    run, spark = run or new_run(), report.sparkSession
    rows = report if sections is None else report.where(F.col("section").isin(*sections))
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows.withColumn("run", F.lit(run)).write.mode("overwrite").partitionBy("section", "run").parquet(f"{path}/{ROWS}")
    if sections is None:
        # One row per section, of a report whose sections are fixed.
        written = _rows(spark, path).where(F.col("run") == run).select("section").distinct()
        sections = [row.section for row in written.collect()]
    renewed = spark.createDataFrame([(section, run) for section in sections], RUN_SCHEMA)
    renewed.coalesce(1).write.mode("append").parquet(f"{path}/{RUNS}")
    return run


def _rows(spark: SparkSession, path: str) -> DataFrame:
    fields = [f"`{name}` {kind}" for name, kind in FACT_TYPES.items()]
    return spark.read.schema(", ".join([*fields, "display string", "run string"])).parquet(f"{path}/{ROWS}")


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    """(section, run): the newest complete run of every section."""
    return spark.read.schema(RUN_SCHEMA).parquet(f"{path}/{RUNS}").groupBy("section").agg(F.max("run").alias("run"))


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """The report as it stands: for every section the rows of its newest complete run."""
    current = F.broadcast(current_runs(spark, path))
    return _rows(spark, path).join(current, ["section", "run"], "left_semi").drop("run")


def drop_old_runs(spark: SparkSession, path: str) -> int:
    """Delete the folders of runs that no section shows any more, and of runs that never were complete.

    To be called when nobody writes, and no reader still holds an older report; gives the number of folders deleted.
    """
    current = {(row.section, row.run) for row in current_runs(spark, path).collect()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/{ROWS}")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [
        status.getPath()
        for status in files.globStatus(hadoop.Path(f"{path}/{ROWS}/section=*/run=*"))
        if tuple(part.split("=", 1)[1] for part in str(status.getPath().toString()).split("/")[-2:]) not in current
    ]
    for folder in old:
        files.delete(folder, True)
    return len(old)


def formatted_kpis(kpis: DataFrame, currency: str) -> DataFrame:
    """(metric, formatted) lines of the global figures."""
    lines = {
        "Revenue": text.money("Revenue", currency),
        "Profit": text.money("Profit", currency),
        "MarginPct": text.percent("MarginPct"),
        "Orders": text.grouped_number("Orders"),
        "UnitsSold": text.grouped_number("UnitsSold"),
        "Customers": text.grouped_number("Customers"),
        "AOV": text.money("AOV", currency),
        "RevPerCustomer": text.money("RevPerCustomer", currency),
    }
    rows = [F.struct(F.lit(k).alias("metric"), v.alias("formatted")) for k, v in lines.items()]
    return kpis.select(F.inline(F.array(*rows)))
