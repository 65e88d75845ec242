"""Typed dimension views over the raw star tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.config import AGE_BOUNDS, AGE_LABELS, HOUSE_OWNER_LABELS, INCOME_BOUNDS, INCOME_LABELS
from salescope.functions import bands, calendar, text


def _cast(name: str, kind: str, alias: str | None = None) -> Column:
    return F.col(name).cast(kind).alias(alias or name)


def lookup(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Left join on an equal key, keeping every row of ``df`` and its own key column.

    No hint: Spark broadcasts the dimension only when its size is under autoBroadcastJoinThreshold and
    otherwise sorts and merges, splitting hot keys at run time.
    """
    other = dimension_key or key
    right = dimension.withColumnRenamed(other, "__lookup_key")
    return df.join(right, df[key] == right["__lookup_key"], "left").drop("__lookup_key")


def customer_dimension(
    customers: DataFrame,
    geography: DataFrame,
    as_of: dt.date,
    age_bounds: Sequence[int] = AGE_BOUNDS,
    income_bounds: Sequence = INCOME_BOUNDS,
) -> DataFrame:
    """Customers with trimmed names, age and income bands, home-owner label and geography."""
    places = geography.select(
        "GeographyKey",
        F.col("City").cast("string").alias("City"),
        F.col("StateProvinceName").cast("string").alias("StateProvinceName"),
        F.col("EnglishCountryRegionName").cast("string").alias("Country"),
        F.col("PostalCode").cast("string").alias("PostalCode"),
    )
    age = bands.years_between("BirthDate", as_of)
    return lookup(customers, places, "GeographyKey").select(
        _cast("CustomerKey", "bigint"),
        text.full_name("FirstName", "LastName").alias("CustomerName"),
        F.trim("FirstName").alias("FirstName"),
        F.trim("LastName").alias("LastName"),
        _cast("Gender", "string"),
        _cast("MaritalStatus", "string"),
        _cast("BirthDate", "date"),
        bands.band(age, age_bounds, AGE_LABELS).alias("AgeGroup"),
        bands.band_sort(age, age_bounds).alias("AgeGroupSort"),
        _cast("EnglishEducation", "string", "Education"),
        _cast("EnglishOccupation", "string", "Occupation"),
        _cast("YearlyIncome", "decimal(18,2)"),
        bands.band("YearlyIncome", income_bounds, INCOME_LABELS).alias("IncomeGroup"),
        bands.band_sort("YearlyIncome", income_bounds).alias("IncomeGroupSort"),
        _cast("TotalChildren", "bigint"),
        _cast("NumberChildrenAtHome", "bigint"),
        bands.decode("HouseOwnerFlag", HOUSE_OWNER_LABELS).alias("HouseOwnerFlag"),
        _cast("NumberCarsOwned", "bigint"),
        _cast("CommuteDistance", "string"),
        _cast("DateFirstPurchase", "date"),
        "City",
        "StateProvinceName",
        "Country",
        "PostalCode",
    )


def product_dimension(products: DataFrame) -> DataFrame:
    """Products with defaults for absent attributes."""

    def filled(name: str, default: str, alias: str | None = None) -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(alias or name)

    return products.select(
        _cast("ProductKey", "bigint"),
        _cast("EnglishProductName", "string", "ProductName"),
        filled("EnglishProductSubcategoryName", "Unknown", "ProductSubcategory"),
        filled("EnglishProductCategoryName", "Unknown", "ProductCategory"),
        filled("ProductLine", "Other"),
        "Color",
        "Size",
        filled("Status", "No Model"),
        filled("ModelName", "No Model"),
        _cast("ListPrice", "decimal(18,2)"),
    )


def territory_dimension(territories: DataFrame) -> DataFrame:
    return territories.select(
        _cast("SalesTerritoryKey", "bigint"),
        F.col("SalesTerritoryGroup").alias("TerritoryGroup"),
        F.col("SalesTerritoryCountry").alias("Country"),
        F.col("SalesTerritoryRegion").alias("Region"),
    )


def duration_days(start: str, end: str) -> Column:
    """Whole days from start to end; negative where the end comes first."""
    return F.datediff(F.col(end), F.col(start))


def promotion_dimension(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        _cast("PromotionKey", "bigint"),
        _cast("EnglishPromotionName", "string", "PromotionName"),
        _cast("DiscountPct", "decimal(10,4)"),
        "StartDate",
        "EndDate",
        duration_days("StartDate", "EndDate").alias("PromotionDurationDays"),
    )


def date_dimension(dates: DataFrame) -> DataFrame:
    """Calendar view over a prebuilt raw date table."""
    return dates.select(
        _cast("DateKey", "bigint"),
        _cast("FullDateAlternateKey", "date", "FullDate"),
        _cast("CalendarYear", "bigint"),
        _cast("CalendarSemester", "bigint"),
        _cast("CalendarQuarter", "bigint"),
        calendar.quarter_label("CalendarQuarter").alias("QuarterLabel"),
        _cast("MonthNumberOfYear", "bigint"),
        F.col("EnglishMonthName").alias("MonthName"),
        calendar.month_year_label("EnglishMonthName", "CalendarYear").alias("MonthYear"),
        calendar.year_month_number("CalendarYear", "MonthNumberOfYear").cast("bigint").alias("YearMonthNumber"),
        _cast("WeekNumberOfYear", "bigint"),
        _cast("DayNumberOfYear", "bigint"),
        _cast("DayNumberOfMonth", "bigint"),
        _cast("DayNumberOfWeek", "bigint"),
        F.col("EnglishDayNameOfWeek").alias("DayName"),
    )


def generate_dates(bounds: DataFrame) -> DataFrame:
    """Raw date table for every day of one (first, last) row; weeks and weekdays follow ISO 8601."""
    first, last = bounds.columns
    day = F.col("FullDateAlternateKey")
    return (
        bounds.where(F.col(first).isNotNull())
        .select(F.explode(F.sequence(F.col(first), F.col(last))).alias("FullDateAlternateKey"))
        .select(
            calendar.date_key(day).alias("DateKey"),
            day,
            F.year(day).cast("bigint").alias("CalendarYear"),
            F.when(F.month(day) <= 6, 1).otherwise(2).cast("bigint").alias("CalendarSemester"),
            F.quarter(day).cast("bigint").alias("CalendarQuarter"),
            F.month(day).cast("bigint").alias("MonthNumberOfYear"),
            F.date_format(day, "MMMM").alias("EnglishMonthName"),
            F.weekofyear(day).cast("bigint").alias("WeekNumberOfYear"),
            F.dayofyear(day).cast("bigint").alias("DayNumberOfYear"),
            F.dayofmonth(day).cast("bigint").alias("DayNumberOfMonth"),
            (F.weekday(day) + 1).cast("bigint").alias("DayNumberOfWeek"),
            F.date_format(day, "EEEE").alias("EnglishDayNameOfWeek"),
        )
    )
