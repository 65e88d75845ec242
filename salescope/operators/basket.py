"""Cross-sell: how often orders with one category also hold another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.ratios import ratio
from salescope.operators.kpi import zero_sum

ORDER = "SalesOrderNumber"
CATEGORY = "ProductCategory"
RATES = "Anchor string, Attach string, AnchorOrders bigint, AttachedOrders bigint, AttachRate double"


def _holds(category: str) -> Column:
    return F.coalesce(F.bool_or(F.col(CATEGORY) == F.lit(category)), F.lit(False))


def order_membership(df: DataFrame, anchor: str, attach: str) -> DataFrame:
    """One row per order: whether it holds the anchor and the attach category."""
    return (
        df.where(F.col(ORDER).isNotNull())
        .groupBy(ORDER)
        .agg(_holds(anchor).alias("HasAnchor"), _holds(attach).alias("HasAttach"))
    )


def attach_analysis(df: DataFrame, anchor: str, attach: str) -> DataFrame:
    """Attach counts and rate, the average attach basket, and what the orders without it could add.

    Two aggregation levels over one scan: per order, then over orders. Figures without a base are NULL.
    """
    is_attach = F.col(CATEGORY) == F.lit(attach)
    orders = df.groupBy(ORDER).agg(
        _holds(anchor).alias("anchor"),
        _holds(attach).alias("attach"),
        F.sum(F.when(is_attach, F.col("Revenue"))).alias("revenue"),
        F.sum(F.when(is_attach, F.col("Profit"))).alias("profit"),
    )
    known = F.col(ORDER).isNotNull()
    totals = orders.agg(
        F.count_if(known & F.col("anchor")).alias("AnchorOrders"),
        F.count_if(known & F.col("anchor") & F.col("attach")).alias("AttachedOrders"),
        F.count_if(known & F.col("attach")).alias("AttachCategoryOrders"),
        zero_sum("revenue").alias("__revenue"),
        zero_sum("profit").alias("__profit"),
    )
    sized = totals.withColumns(
        {
            "GapOrders": F.col("AnchorOrders") - F.col("AttachedOrders"),
            "AttachRate": ratio("AttachedOrders", "AnchorOrders"),
            "AvgAttachBasket": ratio("__revenue", "AttachCategoryOrders"),
            "AttachMargin": ratio("__profit", "__revenue"),
        }
    )
    sized = sized.withColumn("AddressableRevenue", F.col("GapOrders") * F.col("AvgAttachBasket"))
    return sized.select(
        F.lit(anchor).alias("Anchor"),
        F.lit(attach).alias("Attach"),
        "AnchorOrders",
        "AttachedOrders",
        "GapOrders",
        "AttachRate",
        "AttachCategoryOrders",
        "AvgAttachBasket",
        "AttachMargin",
        "AddressableRevenue",
        (F.col("AddressableRevenue") * F.col("AttachMargin")).alias("AddressableProfit"),
    )


def attach_matrix(df: DataFrame) -> DataFrame:
    """Attach rate of every ordered pair of categories that meet in an order.

    An order is reduced to its sorted set of categories, the set to its pairs, and pairs are counted in every task before
    they are shuffled; a category paired with itself counts its orders. Each pair is made in one order and read in both.
    """
    known = df.where(F.col(ORDER).isNotNull() & F.col(CATEGORY).isNotNull())
    sets = known.groupBy(ORDER).agg(F.sort_array(F.collect_set(CATEGORY)).alias("categories"))
    firsts = sets.select("categories", F.posexplode("categories").alias("place", "first"))
    seconds = F.slice("categories", F.col("place") + 1, F.size("categories") - F.col("place"))
    pairs = firsts.select("first", F.explode(seconds).alias("second"))
    counts = pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    both = F.array(
        F.struct(F.col("first").alias("Anchor"), F.col("second").alias("Attach")),
        F.struct(F.col("second").alias("Anchor"), F.col("first").alias("Attach")),
    )
    ordered = counts.select(F.col("n").alias("AttachedOrders"), F.inline(both)).where("Anchor <> Attach")
    anchors = counts.where("first = second").select(F.col("first").alias("Anchor"), F.col("n").alias("AnchorOrders"))
    return ordered.join(anchors, "Anchor").select(
        "Anchor", "Attach", "AnchorOrders", "AttachedOrders", ratio("AttachedOrders", "AnchorOrders").alias("AttachRate")
    )


def attach_rates(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Attach rate of some chosen (anchor, attach) pairs, zero for those that never meet.

    An order is reduced to one flag per category, and the pairs are counted from the flags: no order is
    joined with itself.
    """
    if not pairs:
        return df.sparkSession.createDataFrame([], RATES)
    categories = sorted({c for pair in pairs for c in pair})
    flag = {c: f"has_{i}" for i, c in enumerate(categories)}
    orders = df.where(F.col(ORDER).isNotNull()).groupBy(ORDER).agg(*[_holds(c).alias(flag[c]) for c in categories])
    anchors = [F.count_if(F.col(flag[c])).alias(f"n_{flag[c]}") for c in categories]
    both = [F.count_if(F.col(flag[a]) & F.col(flag[b])).alias(f"p_{i}") for i, (a, b) in enumerate(pairs)]
    counts = orders.agg(*anchors, *both)
    rows = [
        F.struct(
            F.lit(a).alias("Anchor"),
            F.lit(b).alias("Attach"),
            F.col(f"n_{flag[a]}").alias("AnchorOrders"),
            F.col(f"p_{i}").alias("AttachedOrders"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return counts.select(F.inline(F.array(*rows))).withColumn(
        "AttachRate", ratio("AttachedOrders", "AnchorOrders")
    )
