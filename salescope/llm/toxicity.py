"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text in lower case is seen as the set of its n-grams of ``ORDERS`` characters, hashed to ``SLOTS`` slots. From labelled
texts, each slot gets the ratio

    r = log((toxic texts with it + 1) / (toxic texts + 2)) - log((other texts with it + 1) / (other texts + 2))

and the slots whose share differs most between the classes, by the likelihood ratio statistic, are features: x = r where
the slot occurs, 0 elsewhere. A logistic regression on them, trained by Spark, gives the score.

The classifier is fitted on at most ``MOST_LABELLED`` labelled documents, those with the smallest hash of their id;
everything else reads all rows. Whole texts are scored, also very long ones. NULL and empty texts have no n-grams and get
the score of the intercept. Without both labels among the training rows every score is the share of label 1 there, 0 if
there is none. Repeated labels of a document count as toxic if one of them is; rows without an id or label are no labels.
Repeated documents have repeated scores. Label, language, source and id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.blocks import mixed, pieces
from salescope.sources.scratch import materialize

ORDERS = (3, 4, 5)
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
MOST_LABELLED = 20_000
FEATURES = 16_384
LEAST_EVIDENCE = 8.0
PENALTY = 1e-3
# Power of the classes' ratio by which toxic texts weigh more in training.
BALANCE = 0.5
REJECTED = 0.7


@dataclass(frozen=True)
class Model:
    """Weights of the feature slots, already multiplied by their ratios."""

    slots: np.ndarray
    weights: np.ndarray
    intercept: float


def gram_slots(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of all texts, and the text of each."""
    small = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in small], dtype=np.int64)
    points = np.frombuffer("".join(small).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    text = np.repeat(np.arange(len(small), dtype=np.int32), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    room = ends - np.arange(len(points))
    slots, owners = [], []
    hashed = points
    for order in range(2, max(ORDERS) + 1):
        if len(points) < order:
            break
        hashed = hashed[:-1] * np.uint64(0x100000001B3) + points[order - 1 :] + np.uint64(1)
        if order in ORDERS:
            inside = room[: len(hashed)] >= order
            found = (mixed(hashed[inside] + np.uint64(order)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
            slots.append(found)
            owners.append(text[: len(hashed)][inside])
    if not slots:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
    return np.concatenate(slots), np.concatenate(owners)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in batches:
        for piece in pieces(batch, "text", 1 << 20):
            yield piece, piece.column("text").to_pylist()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every slot of the task's rows: texts of either class with it; slot -1 counts the texts."""
    totals = np.zeros((2, SLOTS), dtype=np.int64)
    rows = np.zeros(2, dtype=np.int64)
    for piece, texts in _texts(batches):
        toxic = piece.column("toxic").to_numpy()
        slots, owners = gram_slots(texts)
        seen = np.unique(owners.astype(np.int64) << SLOT_BITS | slots)
        for kind in (0, 1):
            rows[kind] += int((toxic == kind).sum())
            totals[kind] += np.bincount(seen[toxic[seen >> SLOT_BITS] == kind] & (SLOTS - 1), minlength=SLOTS)
    used = np.flatnonzero(totals.any(axis=0))
    columns = [np.append(used, -1), np.append(totals[0, used], rows[0]), np.append(totals[1, used], rows[1])]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "clean", "toxic"])


def _feature_sets(slots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(SLOTS, -1, dtype=np.int32)
        place[slots] = np.arange(len(slots))
        for piece, texts in _texts(batches):
            found, owners = gram_slots(texts)
            known = place[found]
            pairs = np.unique(owners[known >= 0].astype(np.int64) << 32 | known[known >= 0])
            bounds = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column("toxic"), lists], ["toxic", "places"])

    return run


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(text, toxic) of the training rows."""
    known = labels.where("doc_id is not null and toxic is not null").where(~is_held_out(F.col("doc_id")))
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def evidence(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """Likelihood ratio statistic of a slot's two by two table against independence."""
    share = (toxic + clean) / (all_toxic + all_clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    cells = [
        part(toxic, share * all_toxic),
        part(clean, share * all_clean),
        part(all_toxic - toxic, (1 - share) * all_toxic),
        part(all_clean - clean, (1 - share) * all_clean),
    ]
    return 2 * (cells[0] + cells[1] + cells[2] + cells[3])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Learn from the labels of ``docs``; at most ``FEATURES`` numbers reach the driver."""
    rows = materialize(labelled(docs, labels, most), "toxic_labelled")
    counts = rows.mapInArrow(_counts, "slot long, clean long, toxic long").groupBy("slot")
    counts = materialize(counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic_counts")
    total = counts.where("slot = -1").first()
    clean, toxic = (total.clean, total.toxic) if total else (0, 0)
    if not clean or not toxic:
        share = toxic / (clean + toxic) if clean + toxic else 0.0
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), np.inf if share == 1 else -np.inf)
    p, q = (F.col("toxic") + 1) / (toxic + 2), (F.col("clean") + 1) / (clean + 2)
    scored = counts.where("slot >= 0").select(
        "slot", (F.log(p) - F.log(q)).alias("ratio"), evidence(F.col("toxic"), F.col("clean"), toxic, clean).alias("evidence")
    )
    strong = scored.where(F.col("evidence") >= LEAST_EVIDENCE)
    best = strong.orderBy(F.desc("evidence"), "slot").limit(FEATURES).collect()
    if not best:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), float(np.log(toxic / clean)))
    slots, ratios = np.array([r.slot for r in best]), np.array([r.ratio for r in best])
    values = ratios.tolist()
    vector = F.udf(lambda places: Vectors.sparse(len(values), places, [values[i] for i in places]), VectorUDT())
    # Stored before the next Python step, so that a task never needs two workers.
    sets = materialize(rows.mapInArrow(_feature_sets(slots), "toxic int, places array<int>"), "toxic_features")
    weight = F.when(F.col("toxic") == 1, F.lit(float((clean / toxic) ** BALANCE))).otherwise(1.0)
    training = sets.select(F.col("toxic").cast("double").alias("label"), weight.alias("weight"), vector("places").alias("features"))
    training.persist()
    trained = LogisticRegression(maxIter=50, regParam=PENALTY, standardization=False, weightCol="weight").fit(training)
    training.unpersist()
    return Model(slots, trained.coefficients.toArray() * ratios, float(trained.intercept))


def score_texts(model: Model, table: np.ndarray, texts: list[str | None]) -> np.ndarray:
    if not np.isfinite(model.intercept):
        return np.full(len(texts), float(model.intercept > 0))
    slots, owners = gram_slots(texts)
    weighty = table[slots] != 0
    seen = np.unique(owners[weighty].astype(np.int64) << SLOT_BITS | slots[weighty])
    sums = np.bincount(seen >> SLOT_BITS, weights=table[seen & (SLOTS - 1)], minlength=len(texts)) + model.intercept
    return 1 / (1 + np.exp(-np.clip(sums, -700, 700)))


def _table(model: Model) -> np.ndarray:
    table = np.zeros(SLOTS)
    table[model.slots] = model.weights
    return table


def _scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for piece, texts in _texts(batches):
            scores = pa.array(score_texts(model, table, texts), pa.float64())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), scores], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_scorer(model), "doc_id long, score double")


def _keeper(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for piece, texts in _texts(batches):
            yield piece.filter(pa.array(score_texts(model, table, texts) < REJECTED))

    return run


def remove(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    return docs.mapInArrow(_keeper(model), docs.schema)
