"""The ';'-separated line-grain export: writing, reading, filtering."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.config import ALL
from salescope.sources.scratch import materialize

# Quotes inside text are doubled and outer blanks are kept, so text comes back as it was.
CSV_OPTIONS = {
    "sep": ";",
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
BOM = "﻿"
EXPORT_ORDER = ("YearMonthNumber", "Country", "ProductCategory")
ID_COLUMNS = ("SalesOrderNumber", "CustomerKey")
INTEGER_COLUMNS = ("CalendarYear", "YearMonthNumber")
# Figures as they stand in the file; exact, with room for sums over all lines.
FIGURE_COLUMNS = {"Revenue": "decimal(28,8)", "Profit": "decimal(28,8)", "UnitsSold": "decimal(28,8)"}
# What can be wrong with a figure, in the order it is looked for.
NOT_A_NUMBER, OVERFLOW, ROUNDED, MALFORMED = "not a number", "overflow", "rounded", "malformed row"
EXACT = "decimal(38,18)"
FILE, BROKEN, FAULTS = "__file", "__broken", "__faults"


class Loaded(NamedTuple):
    """Rows of an export, and (file, column, reason, n): what could not be read as it stands."""

    rows: DataFrame
    rejects: DataFrame


def export_sales(sales: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write the lines with a header, in global order over the part files.

    The order and customer ids and a row hash follow the sort keys, so one month, country and category that
    holds much of the data is still cut into several ranges.
    """
    keys = [*EXPORT_ORDER, *ID_COLUMNS]
    ranged = [*[F.col(k) for k in keys], F.xxhash64(*sales.columns)]
    split = sales.repartitionByRange(partitions, *ranged) if partitions else sales.repartitionByRange(*ranged)
    split.sortWithinPartitions(*keys).write.options(**CSV_OPTIONS).csv(path)


def first_existing(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """The first path that exists, so a sample can stand in for an absent export."""
    candidates = [paths] if isinstance(paths, str) else list(paths)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in candidates:
        location = jvm.org.apache.hadoop.fs.Path(path)
        if location.getFileSystem(conf).exists(location):
            return path
    raise FileNotFoundError(f"none of {candidates} exists")


def _typed(name: str) -> Column:
    value = F.col(f"`{name}`")
    if name in INTEGER_COLUMNS:
        return value.try_cast("double").try_cast("bigint").alias(name)
    if name in FIGURE_COLUMNS:
        return value.try_cast(FIGURE_COLUMNS[name]).alias(name)
    return value.alias(name)


def apply_filters(df: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """Keep rows equal to every filter value; 'All' and columns that are absent do not filter."""
    for name, wanted in filters.items():
        if name in df.columns and wanted != ALL:
            df = df.where(F.col(name) == F.lit(wanted))
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no rows are left after the filters")
    return df


def clean_names(names: Iterable[str]) -> list[str]:
    return [name.replace(BOM, "").strip() for name in names]


def load_export(
    spark: SparkSession, paths: str | Sequence[str], filters: Mapping[str, str] | None = None
) -> DataFrame:
    """Read an export: names cleaned, figures that do not parse become NULL, ids stay text."""
    path = first_existing(spark, paths)
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    raw = raw.toDF(*clean_names(raw.columns))
    typed = raw.select(*[_typed(name) for name in raw.columns])
    return require_rows(apply_filters(typed, filters or {}))


def _fault(name: str) -> Column:
    """Why a figure is not taken as it stands; NULL for a good one and for an empty field."""
    text = F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
    number = text.try_cast("double")
    typed = number.try_cast("bigint") if name in INTEGER_COLUMNS else text.try_cast(FIGURE_COLUMNS[name])
    exact = number if name in INTEGER_COLUMNS else text.try_cast(EXACT)
    is_number = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(~is_number, F.lit(NOT_A_NUMBER))
        .when(typed.isNull(), F.lit(OVERFLOW))
        .when(typed != exact, F.lit(ROUNDED))
    )


def load_checked(spark: SparkSession, paths: str | Sequence[str], filters: Mapping[str, str] | None = None) -> Loaded:
    """``load_export``, and per file and column the number of figures that were not taken as they stand.

    Figures that are no number or exceed their type are NULL in the rows, those with more places are rounded, rows with too
    few or too many fields are filled or cut. The files are parsed once: the rows are stored with their file and faults,
    and the counts read only those two columns. They cover all rows, also those the filters leave out.
    """
    path = first_existing(spark, paths)
    found = spark.read.options(**CSV_OPTIONS).csv(path).columns
    schema = ", ".join(f"`{i}` string" for i in range(len(found))) + f", {BROKEN} string"
    parsed = spark.read.options(**CSV_OPTIONS, columnNameOfCorruptRecord=BROKEN).schema(schema).csv(path)
    names = clean_names(found)
    raw = parsed.select(*[F.col(f"`{i}`").alias(name) for i, name in enumerate(names)], BROKEN, F.col("_metadata.file_name").alias(FILE))
    figures = [name for name in names if name in (*INTEGER_COLUMNS, *FIGURE_COLUMNS)]
    faults = [F.struct(F.lit(name).alias("column"), _fault(name).alias("reason")) for name in figures]
    faults.append(F.struct(F.lit(None).cast("string").alias("column"), F.when(F.col(BROKEN).isNotNull(), MALFORMED).alias("reason")))
    kept = F.filter(F.array(*faults), lambda fault: fault["reason"].isNotNull())
    stored = materialize(raw.select(*[_typed(name) for name in names], FILE, kept.alias(FAULTS)), "export")
    rejects = (
        stored.select(F.col(FILE).alias("file"), F.inline(FAULTS))
        .groupBy("file", "column", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return Loaded(require_rows(apply_filters(stored.drop(FILE, FAULTS), filters or {})), rejects)
