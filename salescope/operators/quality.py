"""Data-quality checks: each gives rows or counts; ``summary`` states pass or fail.

Figures over all rows of a fact are aggregates that can be observed while it is written (``fact_metrics``). Keys are
checked by counting both sides of a relationship in one tagged group-by (``key_profile``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# (fact, key, dimension, dimension key) and optionally a weight column
Relationship = tuple
PROFILE = "Relationship string, k string, fact bigint, dimension bigint"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("Row_Count")).select(F.lit(name).alias("TableName"), "Row_Count")
            for name, df in tables.items()
        ]
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total rows and NULLs per column in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("TotalRows"),
        *[F.count_if(F.col(c).isNull()).alias(f"Missing_{c}") for c in columns],
    )


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("DuplicateCount")).where("DuplicateCount > 1")


def key_uniqueness(keys: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Duplicate keys of several (table, key column) pairs, stacked."""
    return _union(
        [
            duplicate_keys(df, key).select(
                F.lit(table).alias("TableName"), F.col(key).cast("string").alias("KeyValue"), "DuplicateCount"
            )
            for (table, key), df in keys.items()
        ]
    )


def orphans(
    fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str, weight: str | None = None
) -> DataFrame:
    """Number of fact rows whose key is absent from the dimension; a NULL key is absent too.

    Rows are counted per key before the join, so a hot key reaches it as one row, and so do repeated keys of
    the other side. ``weight`` names a column with the number of fact rows a row stands for.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    keys = fact.groupBy(F.col(key).alias("k")).agg(rows.alias("n"))
    known = dimension.select(F.col(dimension_key).alias("known")).distinct()
    missing = keys.join(known, keys.k == known.known, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("Orphans"))


def key_profile(relationships: Mapping[str, Relationship]) -> DataFrame:
    """(Relationship, FactRows, DimensionRows, DimensionKeys, DuplicateKeys, Orphans) of several relationships.

    Keys of both sides, tagged with their side, meet in one group-by, so uniqueness of the dimension key and orphans of the
    fact come from the same pass. Every task sends a key once per side, however many rows hold it. A NULL key of the fact
    is an orphan. Keys are compared as text.
    """
    spark = next(iter(relationships.values()))[0].sparkSession
    # So that a relationship without rows has a row.
    parts = [spark.createDataFrame([(name, None, 0, 0) for name in relationships], PROFILE)]
    none = F.lit(0).cast("bigint")
    for name, (fact, key, dimension, dimension_key, *weight) in relationships.items():
        rows = F.col(weight[0]).cast("bigint") if weight and weight[0] else F.lit(1).cast("bigint")
        for df, column, counted in ((fact, key, (rows, none)), (dimension, dimension_key, (none, F.lit(1).cast("bigint")))):
            sides = [n.alias(side) for n, side in zip(counted, ("fact", "dimension"))]
            parts.append(df.select(F.lit(name).alias("Relationship"), F.col(column).cast("string").alias("k"), *sides))
    keys = _union(parts).groupBy("Relationship", "k").agg(F.sum("fact").alias("fact"), F.sum("dimension").alias("dimension"))
    absent = (F.col("dimension") == 0) | F.col("k").isNull()
    return keys.groupBy("Relationship").agg(
        F.sum("fact").alias("FactRows"),
        F.sum("dimension").alias("DimensionRows"),
        F.count_if(F.col("dimension") > 0).alias("DimensionKeys"),
        F.count_if(F.col("dimension") > 1).alias("DuplicateKeys"),
        F.coalesce(F.sum(F.when(absent, F.col("fact"))), F.lit(0)).cast("bigint").alias("Orphans"),
    )


def orphan_counts(checks: Mapping[str, Relationship]) -> DataFrame:
    return key_profile(checks).select("Relationship", "Orphans")


def anomaly_rules(amount: str = "SalesAmount", cost: str = "TotalProductCost", quantity: str = "OrderQuantity"):
    return {
        "negative_amount": F.col(amount) < 0,
        "negative_cost": F.col(cost) < 0,
        "non_positive_quantity": F.col(quantity) <= 0,
    }


def anomaly_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.where(reduce(Column.__or__, rules.values()))


def anomaly_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per broken rule and rows with any broken rule, in one pass."""
    counts = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    return df.agg(*counts, F.count_if(reduce(Column.__or__, rules.values())).alias("any_rule"))


def fact_metrics(required: Sequence[str], rules: Mapping[str, Column]) -> dict[str, Column]:
    """Rows, NULLs per required column, rows per broken rule and rows with any broken rule, as aggregates."""
    missing = {f"Missing_{c}": F.count_if(F.col(c).isNull()) for c in required}
    broken = {name: F.count_if(rule) for name, rule in rules.items()}
    return {
        "TotalRows": F.count(F.lit(1)),
        **missing,
        **broken,
        "any_rule": F.count_if(reduce(Column.__or__, rules.values())),
    }


def date_range(dates: DataFrame, column: str = "FullDate") -> DataFrame:
    return dates.agg(
        F.min(column).alias("MinDate"), F.max(column).alias("MaxDate"), F.count(F.lit(1)).alias("DateRows")
    ).withColumn("ExpectedDays", (F.datediff("MaxDate", "MinDate") + 1).cast("bigint"))


def missing_attributes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns is NULL."""
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def line_profile(df: DataFrame, *key: str) -> DataFrame:
    """(TotalRows, DistinctOrderLines, RepeatedLines) of a composite key; a NULL part is a value like others."""
    lines = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return lines.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("TotalRows"),
        F.count(F.lit(1)).alias("DistinctOrderLines"),
        F.count_if(F.col("n") > 1).alias("RepeatedLines"),
    )


def grain(df: DataFrame, *key: str) -> DataFrame:
    """Rows against distinct keys."""
    return line_profile(df, *key).select("TotalRows", "DistinctOrderLines")


def findings(df: DataFrame, *rows: tuple[str, str | Column, Column, Column]) -> DataFrame:
    """(check, target, observed, passed) rows of each row of ``df``; those without a target are left out."""
    made = [
        F.struct(
            F.lit(check).alias("check"),
            (F.lit(target) if isinstance(target, str) else target).alias("target"),
            observed.cast("bigint").alias("observed"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for check, target, observed, passed in rows
    ]
    return df.select(F.inline(F.array(*made))).where("target IS NOT NULL")


def summary(
    fact: str,
    metrics: DataFrame,
    required: Sequence[str],
    rules: Mapping[str, Column],
    relationships: Mapping[str, Relationship],
    unique: Mapping[str, tuple[str, str]],
    lines: DataFrame,
    line_key: Sequence[str],
    dates: DataFrame,
    date_attributes: Sequence[str],
) -> DataFrame:
    """All checks as (check, target, observed, passed).

    ``metrics`` is the row of ``fact_metrics`` over the fact. ``unique`` gives (table, key) of the relationships whose
    dimension is counted and must have unique keys. Lines are read once, dates once, and every relationship once.
    """

    def zero(check: str, target: str | Column, observed: Column) -> tuple[str, str | Column, Column, Column]:
        return check, target, observed, observed == 0

    def named(values: Mapping[str, str]) -> Column:
        found = F.lit(None).cast("string")
        for name, value in values.items():
            found = F.when(F.col("Relationship") == name, F.lit(value)).otherwise(found)
        return found

    tables = named({name: table for name, (table, _) in unique.items()})
    keys = named({name: f"{table}.{key}" for name, (table, key) in unique.items()})
    line, blank = "+".join(line_key), reduce(Column.__or__, [F.col(c).isNull() for c in date_attributes])
    days = dates.agg(
        F.min("FullDate").alias("first"),
        F.max("FullDate").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(blank).alias("blank"),
    )
    parts = [
        findings(
            metrics,
            ("row_count", fact, F.col("TotalRows"), F.col("TotalRows") > 0),
            *[zero("null_values", c, F.col(f"Missing_{c}")) for c in required],
            *[zero("anomalies", name, F.col(name)) for name in rules],
        ),
        findings(
            key_profile(relationships),
            ("row_count", tables, F.col("DimensionRows"), F.col("DimensionRows") > 0),
            zero("duplicate_keys", keys, F.col("DuplicateKeys")),
            zero("orphans", F.col("Relationship"), F.col("Orphans")),
        ),
        findings(
            line_profile(lines, *line_key),
            zero("duplicate_lines", line, F.col("RepeatedLines")),
            zero("grain", line, F.col("TotalRows") - F.col("DistinctOrderLines")),
        ),
        findings(
            days,
            zero("date_gaps", "FullDate", F.datediff("last", "first") + 1 - F.col("n")),
            zero("date_nulls", "+".join(date_attributes), F.col("blank")),
        ),
    ]
    return _union(parts)
