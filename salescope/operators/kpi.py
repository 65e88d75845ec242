"""Key figures at any grain: additive sums and exact distinct counts of orders and customers.

Orders and customers are always counted again at the wanted grain, never added up. NULL ids are not counted.

Counts at many grains come from one table of bitmaps, ``segment_bitmaps``: per segment and period the ids as bits in words
of 64, beside the sums. Unions of words give the figures of any union of segments or periods without the lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.ratios import ratio

SUMS = ("Revenue", "Profit", "UnitsSold")
DISTINCTS = {"Orders": "SalesOrderNumber", "Customers": "CustomerKey"}
MEASURES = (*SUMS, *DISTINCTS)
# Ids per word, and buckets of ids per shuffle partition.
WORD_BITS = 64
BUCKETS_PER_PARTITION = 4
# Two codes of segments fit in a bigint.
CODE_BITS = 31


def zero_sum(value: Column | str) -> Column:
    """Sum that is 0, not NULL, over NULL values."""
    return F.coalesce(F.sum(value), F.lit(0))


def additive_aggregates() -> list[Column]:
    return [zero_sum(name).alias(name) for name in SUMS]


def kpis(df: DataFrame, *by: str) -> DataFrame:
    """The five measures, globally or per group; a NULL group value is a group of its own.

    Lines collapse to one row per group and id, on the map side too, and those rows are counted: no line is repeated per
    distinct count. The order ids carry the sums, so the lines are read once per id column.
    """
    parts = []
    for name, source in DISTINCTS.items():
        sums = SUMS if name == "Orders" else ()
        keyed = df.withColumn("__id", F.col(source)).groupBy(*by, "__id")
        per_id = keyed.agg(F.count(F.lit(1)).alias("__lines"), *[F.sum(m).alias(m) for m in sums])
        parts.append(per_id.groupBy(*by).agg(F.count("__id").alias(name), *[F.sum(m).alias(m) for m in sums]))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy(*by).agg(*[zero_sum(m).alias(m) for m in MEASURES])


def with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "MarginPct": ratio("Profit", "Revenue"),
            "AOV": ratio("Revenue", "Orders"),
            "RevPerCustomer": ratio("Revenue", "Customers"),
        }
    )


def with_share(segments: DataFrame) -> DataFrame:
    """Share of each segment in the revenue of its dimension.

    The totals hold one row per dimension, so they are broadcast; a window would pull all segments of a
    dimension into one task. ``segments`` is read twice: pass a stored table.
    """
    totals = segments.groupBy("dimension").agg(F.sum("Revenue").alias("__total"))
    shared = segments.join(F.broadcast(totals), "dimension", "left")
    return shared.withColumn("RevenueShare", ratio("Revenue", "__total")).drop("__total")


def _slots(dimensions: Sequence[str]) -> dict[str, str]:
    """Dimension to working column, so a measure, period or id can serve as a dimension too."""
    return {d: f"__d{i}" for i, d in enumerate(dimensions)}


def _narrow(df: DataFrame, slots: dict[str, str], *columns: str) -> DataFrame:
    segments = [F.col(d).cast("string").alias(slot) for d, slot in slots.items()]
    return df.select(*segments, *columns)


def additive_by_segment(df: DataFrame, dimensions: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """Sums per (dimension, segment, period).

    The fact collapses to combinations of all dimensions first, so only those rows, not the order lines, are
    repeated per dimension.
    """
    slots = _slots(dimensions)
    lines = _narrow(df, slots, *period, *SUMS)
    combined = lines.groupBy(*slots.values(), *period).agg(*additive_aggregates())
    segments = [F.struct(F.lit(d).alias("dimension"), F.col(slot).alias("segment")) for d, slot in slots.items()]
    repeated = combined.select(*period, *SUMS, F.inline(F.array(*segments)))
    return repeated.groupBy("dimension", "segment", *period).agg(*[F.sum(m).alias(m) for m in SUMS])


def _id_words(
    lines: DataFrame,
    measure: str,
    held: Sequence[str],
    repeated: Column,
    period: Sequence[str],
    sums: Sequence[str] = (),
) -> DataFrame:
    """Bitmaps of one id column: (measure, segment columns, period, bucket, word, bits, sums).

    ``held`` are the columns that hold the segments of a line, ``repeated`` makes the segment columns of its dimensions from
    them. Lines collapse to combinations of id, segments and period first, so an id that holds much of the fact is as many
    rows as it has combinations. Ids are then dealt into buckets by hash and numbered within their bucket, by their first
    period and then by id, so that ids of one period share words. The words are made where the ids were numbered, without a
    shuffle.
    """
    source = DISTINCTS[measure]
    keys = lines.select(source, *period, *held, *sums).groupBy(source, *period, *held)
    combined = keys.agg(*[F.sum(m).alias(m) for m in sums]) if sums else keys.count().drop("count")
    buckets = BUCKETS_PER_PARTITION * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = combined.withColumn("bucket", F.pmod(F.xxhash64(source), F.lit(buckets))).repartition("bucket")
    if period:
        dealt = dealt.withColumn("__first", F.min(F.struct(*period)).over(Window.partitionBy("bucket", source)))
    order = ["__first", source] if period else [source]
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*order)) - 1
    one = F.lit(1).cast("bigint")
    bit = F.when(F.col(source).isNotNull(), F.call_function("shiftleft", one, (F.col("__place") % WORD_BITS).cast("int")))
    placed = dealt.withColumn("__place", place).withColumn("__bit", bit)
    word = F.expr(f"__place div {WORD_BITS}").alias("word")
    rows = placed.select(*period, "bucket", word, "__bit", *sums, repeated)
    segments = [c for c in rows.columns if c not in (*period, "bucket", "word", "__bit", *sums)]
    words = rows.groupBy(*segments, *period, "bucket", "word").agg(
        F.bit_or("__bit").alias("bits"), *[F.sum(m).alias(m) for m in sums]
    )
    return words.withColumn("measure", F.lit(measure))


def segment_bitmaps(df: DataFrame, dimensions: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """Orders and customers per (dimension, segment, period) as bitmaps, with the sums.

    One row per word of 64 ids that occur there: ``measure`` names the id, (``bucket``, ``word``) are the same for an id
    in all segments and periods, ``bits`` has a bit for each id. Sums stand beside the words of the orders, those of lines
    without an order id in words without bits. The fact is read once per id column. Store the result, several figures
    are read from it.
    """
    slots = _slots(dimensions)
    lines = _narrow(df, slots, *period, *DISTINCTS.values(), *SUMS)
    segments = [F.struct(F.lit(d).alias("dimension"), F.col(slot).alias("segment")) for d, slot in slots.items()]
    repeated = F.inline(F.array(*segments))
    parts = [
        _id_words(lines, name, list(slots.values()), repeated, period, SUMS if name == "Orders" else ())
        for name in DISTINCTS
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _code(segment: Column) -> Column:
    """A segment in 31 bits."""
    return F.pmod(F.xxhash64(segment), F.lit(1 << CODE_BITS))


def codes_differ(sums: DataFrame) -> bool:
    """Whether no two segments of a dimension in ``additive_by_segment`` share a code."""
    coded = sums.select("dimension", "segment", _code(F.col("segment")).alias("code")).distinct()
    return coded.groupBy("dimension", "code").count().where("count > 1").isEmpty()


def coded_bitmaps(df: DataFrame, sums: DataFrame, dimensions: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """``segment_bitmaps`` where a line carries codes of its segments, two in a number, instead of their names.

    ``sums`` are those of ``additive_by_segment``, stored; its segments give the codes their names again, so they must
    differ, see ``codes_differ``. The sums are rows of their own without words, so no line carries them.
    """
    slots = _slots(dimensions)
    lines = _narrow(df, slots, *period, *DISTINCTS.values())
    codes = [_code(F.col(slot)) for slot in slots.values()]
    pairs = [codes[i : i + 2] for i in range(0, len(codes), 2)]
    held = [F.shiftleft(p[0], CODE_BITS).bitwiseOR(p[1]) if len(p) == 2 else p[0] for p in pairs]
    names = [f"__codes{i}" for i in range(len(held))]
    packed = lines.select(*period, *DISTINCTS.values(), *[h.alias(n) for h, n in zip(held, names)])
    low = F.lit((1 << CODE_BITS) - 1)
    single = [[F.shiftright(n, CODE_BITS), F.col(n).bitwiseAND(low)] if len(p) == 2 else [F.col(n)] for n, p in zip(names, pairs)]
    numbers = enumerate(code for pair in single for code in pair)
    places = [F.struct(F.lit(i).alias("__dimension"), code.alias("__code")) for i, code in numbers]
    parts = [_id_words(packed, name, names, F.inline(F.array(*places)), period) for name in DISTINCTS]
    words = reduce(lambda a, b: a.unionByName(b), parts)
    number = reduce(lambda a, b: a.when(F.col("dimension") == b[1], F.lit(b[0])), enumerate(slots), F)
    known = sums.select("dimension", "segment").distinct().select(
        number.alias("__dimension"), _code(F.col("segment")).alias("__code"), "dimension", "segment"
    )
    named = words.join(known, ["__dimension", "__code"]).drop("__dimension", "__code")
    return named.unionByName(sums.withColumn("measure", F.lit("Orders")), allowMissingColumns=True)


def counted_segments(df: DataFrame, sums: DataFrame, dimensions: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """The five measures per (dimension, segment, period), for this grain alone and without bitmaps.

    A line gives one number for each dimension, the dimension and the code of its segment; ids and numbers collapse in
    every task, are dealt once by both together, and are counted. ``sums`` as for ``coded_bitmaps``.
    """
    slots = _slots(dimensions)
    lines = _narrow(df, slots, *period, *DISTINCTS.values())
    numbers = [F.lit(i << CODE_BITS).cast("bigint").bitwiseOR(_code(F.col(slot))) for i, slot in enumerate(slots.values())]
    number = reduce(lambda a, b: a.when(F.col("dimension") == b[1], F.lit(b[0] << CODE_BITS)), enumerate(slots), F)
    known = sums.select("dimension", "segment").distinct().withColumn(
        "__segment", number.cast("bigint").bitwiseOR(_code(F.col("segment")))
    )
    parts = [sums]
    for name, source in DISTINCTS.items():
        met = lines.where(F.col(source).isNotNull()).select(source, *period, F.explode(F.array(*numbers)).alias("__segment"))
        counts = met.distinct().groupBy("__segment", *period).agg(F.count(F.lit(1)).alias(name))
        parts.append(counts.join(known, "__segment").drop("__segment"))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy("dimension", "segment", *period).agg(*[zero_sum(m).alias(m) for m in MEASURES])


def figures(bitmaps: DataFrame, *by: str) -> DataFrame:
    """The five measures of ``segment_bitmaps`` per group of its key columns.

    Words that meet in a group are united before their bits are counted; a group of all keys has each word once. An id occurs in every dimension, so keep to one
    dimension, or group by it.
    """
    words = [c for c in bitmaps.columns if c not in ("bits", *SUMS)]
    keys = [c for c in words if c in (*by, "measure", "bucket", "word")]
    united = bitmaps
    if keys != words:
        united = bitmaps.groupBy(*keys).agg(F.bit_or("bits").alias("bits"), *[F.sum(m).alias(m) for m in SUMS])
    ids = F.bit_count("bits").cast("bigint")
    counts = [zero_sum(F.when(F.col("measure") == name, ids)).alias(name) for name in DISTINCTS]
    return united.groupBy(*by).agg(*additive_aggregates(), *counts)


def segment_totals(df: DataFrame, dimensions: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """The five measures per (dimension, segment, period) for several dimensions."""
    return figures(segment_bitmaps(df, dimensions, period), "dimension", "segment", *period)


def segment_kpis(totals: DataFrame) -> DataFrame:
    """Segment totals with margin, order value, revenue per customer and revenue share."""
    return with_share(with_ratios(totals))


def segment_kpis_grouping_sets(totals: DataFrame) -> DataFrame:
    """The same from GROUPING SETS over the segment totals: one pass gives the segments and the total of their dimension.

    ``grouping`` tells a NULL segment from a rolled-up one.
    """
    sets = totals.groupingSets([[F.col("dimension"), F.col("segment")], [F.col("dimension")]], F.col("dimension"), F.col("segment"))
    grouped = sets.agg(*[F.sum(m).alias(m) for m in MEASURES], F.grouping("segment").alias("__total"))
    whole = grouped.where("__total = 1").select("dimension", F.col("Revenue").alias("__whole"))
    shared = grouped.where("__total = 0").join(F.broadcast(whole), "dimension")
    return with_ratios(shared.withColumn("RevenueShare", ratio("Revenue", "__whole")).drop("__total", "__whole"))


def validation_totals(sales: DataFrame) -> DataFrame:
    """Revenue, profit, margin and orders of the sales view."""
    lines = sales.select(
        F.col("SalesAmount").alias("Revenue"),
        (F.col("SalesAmount") - F.col("TotalProductCost")).alias("Profit"),
        "SalesOrderNumber",
    )
    totals = lines.agg(
        F.sum("Revenue").alias("Revenue"),
        F.sum("Profit").alias("Profit"),
        F.count_distinct("SalesOrderNumber").alias("Orders"),
    )
    return totals.select("Revenue", "Profit", ratio("Profit", "Revenue").alias("MarginRate"), "Orders")


def sales_by_year(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue, profit and margin per calendar year, ordered; sales without a date form a NULL year.

    Sales collapse to one row per date key before they meet the calendar.
    """
    daily = sales.groupBy("OrderDateKey").agg(
        F.sum("SalesAmount").alias("Revenue"),
        F.sum(F.col("SalesAmount") - F.col("TotalProductCost")).alias("Profit"),
    )
    years = dates.select(F.col("DateKey"), "CalendarYear")
    yearly = (
        daily.join(years, daily.OrderDateKey == years.DateKey, "left")
        .groupBy("CalendarYear")
        .agg(F.sum("Revenue").alias("Revenue"), F.sum("Profit").alias("Profit"))
    )
    return yearly.withColumn("MarginRate", ratio("Profit", "Revenue")).orderBy("CalendarYear")


def control_metrics() -> dict[str, Column]:
    """Rows, year range, revenue and profit, as aggregates."""
    return {
        "Row_Count": F.count(F.lit(1)),
        "MinYear": F.min("CalendarYear"),
        "MaxYear": F.max("CalendarYear"),
        "TotalRevenue": F.sum("Revenue"),
        "TotalProfit": F.sum("Profit"),
    }


def control_totals(sales_raw: DataFrame) -> DataFrame:
    """The control metrics of the fact, to reconcile it before and after an export."""
    return sales_raw.agg(*[value.alias(name) for name, value in control_metrics().items()])


def preview(sales_raw: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """First rows in a given order."""
    return sales_raw.orderBy(*order).limit(n)
