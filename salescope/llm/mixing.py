"""Mixing sources to target weights, in DataFrame functions only.

Sources in order of their code points, NULL last, carry the given weights in turn and share the words of all documents by
them. A source gives each word at most ``most_epochs`` times: a target above that stops there, and the excess is shared
again by weight until none is above. With s the words of a source and w its weight, the targets are min(most_epochs * s,
r * w) for the rate r at which they add up; sources reach their ceiling in order of s / w, so r comes from running sums in
that order.

Within a source each document has a random key, a hash of its id and text, and the sources are sorted by it in ranges: the
keys are uniform, so equal parts of their range hold about equally many documents, also of a source with most of all rows.
Words are summed per range, the sums are added up over the ranges of a source, and within a range over its documents; so
each document knows how many words come before it. A budget (the target, rounded) of several times the source repeats
whole epochs; the last one is cut at the exact word, inside a document if need be. Keys do not depend on partitions, so
reruns agree.

NULL and empty texts have no words; they stay, and give none. NULL ids are ids like others, rows that agree in id and text
share a key and are in any order, which changes no figure. An empty table gives an empty result. Only ``doc_id``,
``source`` and ``text`` are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
ROWS_PER_RANGE = 2_000
KEY_BITS = 60


def random_key() -> Column:
    """60 random bits of a document's id and text, the same in every run."""
    text = F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, nameless, size, key): ``source`` is '' and ``nameless`` true where it is NULL."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return texts.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("source").isNull().alias("nameless"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
        random_key().alias("key"),
    )


def running(df: DataFrame, order: Sequence[str], sums: dict[str, Column], label: str) -> DataFrame:
    """``df`` with the sum of each column over the rows before a row in a global order.

    Rows are sorted by range; each range is summed by itself, and shifted by the sums of the ranges before it, which are
    one row per partition.
    """
    ranged = df.repartitionByRange(*order).withColumns({name: value for name, value in sums.items()})
    parts = materialize(ranged.withColumn("part", F.spark_partition_id()), label)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("part").agg(*[F.sum(name).alias(name) for name in sums])
    shifts = totals.select("part", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"shift_{name}") for name in sums])
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumns({name: F.coalesce(F.sum(name).over(inside), F.lit(0)) for name in sums})
    moved = local.join(F.broadcast(shifts), "part")
    kept = [c for c in df.columns if c not in sums]
    return moved.select(*kept, *[(F.col(name) + F.col(f"shift_{name}")).alias(name) for name in sums])


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``target`` and ``budget`` for rows (source, nameless, source_size), one per source."""
    ranked = running(sources, ("nameless", "source"), {"rank": F.lit(1).cast("long")}, "source_ranks")
    turn = (F.col("rank") % len(weights)).cast("int")
    weighted = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1))
    ceiling = F.col("source_size") * most_epochs
    ordered = weighted.withColumns(
        {"ceiling": ceiling, "fills_at": F.col("source_size").cast("double") / F.col("weight")}
    )
    sums = {"full": F.col("ceiling"), "spent": F.col("weight").cast("long")}
    filled = materialize(running(ordered, ("fills_at", "nameless", "source"), sums, "source_ceilings"), "source_targets")
    totals = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    if totals.words is None:
        return filled.select("source", "nameless", "source_size", F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("budget"))
    # The rate if just the sources that fill up before this one are full. It rises as long as they are full at the rate
    # before and falls from there on, so the largest is the rate at which the targets add up.
    rate = (F.lit(totals.words) - F.col("full")).cast("double") / (F.lit(totals.weights) - F.col("spent"))
    final = filled.agg(F.max(rate).alias("rate")).first().rate
    target = F.least(F.col("ceiling").cast("double"), F.lit(final) * F.col("weight"))
    return filled.select(
        "source",
        "nameless",
        "source_size",
        target.alias("target"),
        F.least(F.col("ceiling"), F.floor(target + 0.5).cast("long")).alias("budget"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs`` (doc_id, source, text).

    ``taken`` is how many words of the document the mix holds, repeats counted: whole epochs, and in the epoch that is cut
    the first ``taken % size`` words of the document at the cut.
    """
    rows = materialize(sized(docs), "sized_documents")
    counted = rows.groupBy("source", "nameless").agg(F.sum("size").alias("source_size"))
    wanted = targets(materialize(counted, "source_sizes"), weights, most_epochs)
    ranges = max(1, -(-rows.count() // rows_per_range))
    width = -(-(1 << KEY_BITS) // ranges)
    dealt = rows.withColumn("range", F.expr(f"key div {width}L"))
    keys = ["source", "nameless", "range"]
    sums = dealt.groupBy(*keys).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source", "nameless").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    placed = starts.join(wanted, ["source", "nameless"])
    inside = Window.partitionBy(*keys).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(placed, keys)
    epochs = F.expr("if(source_size > 0, budget div source_size, 0)")
    left = F.expr("if(source_size > 0, budget % source_size, 0) - start - before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return joined.select(
        "doc_id",
        F.when(~F.col("nameless"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
    )
