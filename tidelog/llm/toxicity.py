"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes ratios.

Features are the distinct character runs of a text (ORDERS bytes long, A-Z lowered, white
space as one kind of character), hashed to 2^20 slots. For each slot the log-count ratio r
compares the share of toxic and of clean training texts that hold it; counts cover all
labelled training rows and are made in parallel. Every slot that occurs has a weight: r
times a coefficient that all slots of its sign and distance from chance (z) share. The up to
OWN_SLOTS slots farthest from chance, from OWN_Z on, have one more of their own. A logistic
regression fits both, on at most `max_rows` different labelled rows (those with the
smallest hashes, half for either kind; all if fewer); the bound is a parameter. There the
counts behind r leave out the text itself, so that what only one text holds proves nothing.
All texts are scored, and whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.components import written
from tidelog.llm.words import SPACES, text_bytes

SLOT_BITS = 20
ORDERS = (4, 5, 6)
PIECE = 1 << 19
MAX_ROWS = 20_000
BLOCK_BITS = 9
EDGES = (1.0, 2.0, 3.0, 4.0, 6.0, 8.0)
KINDS = 2 * (len(EDGES) + 1)
OWN_SLOTS = 4096
OWN_Z = 4.0
_STEP = np.uint32(0x9E3779B1)

_CODES = np.random.default_rng(20240301).integers(1, 2**31, 256, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_CODES[list(SPACES)] = _CODES[0x20]


def _ngrams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Slots of the n-grams that start at each byte, order by order."""
    code = _CODES[data]
    h = code.copy()
    for n in range(2, max(ORDERS) + 1):
        if len(h) < 2:
            return
        h = h[:-1] * _STEP + code[n - 1 :]
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
            yield (mixed >> np.uint32(32 - SLOT_BITS)).astype(np.int32)


def _distinct_slots(data: np.ndarray) -> np.ndarray:
    """Distinct slots of one text, in pieces that overlap by the longest n-gram."""
    if len(data) <= PIECE:
        found = list(_ngrams(data))
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)
    seen = np.zeros(1 << SLOT_BITS, bool)
    for at in range(0, len(data), PIECE):
        for slots in _ngrams(data[at : at + PIECE + max(ORDERS) - 1]):
            seen[slots] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class ToxicityModel:
    """Weights of all slots (already scaled by r) and the bias."""

    weights: np.ndarray
    bias: float

    def margins(self, text: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(text)
        out = np.full(len(text), self.bias)
        for i in range(len(text)):
            out[i] += self.weights[_distinct_slots(data[offsets[i] : offsets[i + 1]])].sum()
        return out


def _counts(spark: SparkSession, rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Texts per slot, toxic and clean, and how many texts there are of either kind."""

    def count(batches):
        # a task has fewer texts than 2^31
        total = np.zeros((2, 1 << SLOT_BITS), np.int32)
        texts = np.zeros(2, np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column(0))
            for i, kind in enumerate(batch.column(1).to_pylist()):
                total[kind][_distinct_slots(data[at[i] : at[i + 1]])] += 1
                texts[kind] += 1
        # narrow and packed: a row for each slot would outweigh the texts of the task
        blocks = total.reshape(2, -1, 1 << BLOCK_BITS)
        for block in [-1, *np.flatnonzero(blocks.any((0, 2)))]:
            counts = texts if block < 0 else blocks[:, block]
            counts = counts.astype(np.min_scalar_type(counts.max()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([counts.itemsize], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)])],
                ["block", "width", "counts"],
            )

    def add(batches):
        sums = {}
        for batch in batches:
            for block, width, counts in zip(*(c.to_pylist() for c in batch.columns)):
                found = np.frombuffer(zlib.decompress(counts), f"<u{width}")
                sums[block] = sums.get(block, 0) + found.astype(np.int64)
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()])], ["block", "counts"])

    parts = rows.mapInArrow(count, "block int, width int, counts binary")
    counted = parts.repartition("block").mapInArrow(add, "block int, counts binary")
    # written, so that the shuffled texts are deleted at once
    total, texts = np.zeros((2, 1 << SLOT_BITS >> BLOCK_BITS, 1 << BLOCK_BITS)), np.zeros(2)
    for block, counts in zip(*(c.to_pylist() for c in written(spark, counted, "slot-counts").toArrow().columns)):
        found = np.frombuffer(counts, np.int64)
        if block < 0:
            texts += found
        else:
            total[:, block] = found.reshape(2, -1)
    clean, toxic = total.reshape(2, -1)
    return toxic, clean, int(texts[1]), int(texts[0])


def _ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-count ratio, its distance from chance, kind) of each slot; the ratio is 0 for one that no text holds."""
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((clean + 1) / (n_clean + 2))
    ratio[toxic + clean <= 0] = 0
    z = np.abs(ratio) / np.sqrt(1 / (toxic + 1) + 1 / (clean + 1))
    return ratio, z, (2 * np.digitize(z, EDGES) + (ratio > 0)).astype(np.int8)


def _fit(
    x_rows: np.ndarray, x_cols: np.ndarray, shared: np.ndarray, y: np.ndarray, scale: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression: weights of the sparse features with value scale[column], of the dense ones, bias.

    L2, both classes weighed alike.
    """
    n, k, value = len(y), len(scale), scale[x_cols]
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))
    centre, spread = shared.mean(0), shared.std(0)
    spread[spread == 0] = 1
    dense = (shared - centre) / spread
    w, bias = np.zeros(k + shared.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, 301):
        z = bias + np.bincount(x_rows, value * w[x_cols], n) + dense @ w[k:]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        grad = np.concatenate([np.bincount(x_cols, value * error[x_rows], k), error @ dense, [error.sum()]])
        grad[:-1] += 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    common = w[k:] / spread
    return w[:k], common, bias - float(centre @ common)


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS
) -> ToxicityModel:
    """Learn from the rows of `docs` (doc_id, text) that `labels` (doc_id, toxic) marks.

    Null ids and null labels teach nothing; of repeated labels of an id the highest holds;
    a repeated doc_id counts once for each row, and the regression takes equal rows once, so
    that no id outweighs the rest of the sample. Without texts of both kinds the model
    gives every text the share of toxic ones, (toxic + 1) / (texts + 2).
    """
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # texts meet their labels once; the labels are the side that is kept in memory, so no text is sorted
    labelled = docs.select("doc_id", "text").where("doc_id IS NOT NULL").join(marks.hint("shuffle_hash"), "doc_id")
    toxic, clean, n_toxic, n_clean = _counts(spark, labelled.select("text", "toxic"))
    weights = np.zeros(1 << SLOT_BITS)
    prior = float(np.log((n_toxic + 1) / (n_clean + 1)))
    if not n_toxic or not n_clean:
        return ToxicityModel(weights, prior)
    ratio, z, kind = _ratios(toxic, clean, n_toxic, n_clean)
    chosen = np.argsort(-z, kind="stable")[:OWN_SLOTS]
    chosen = np.sort(chosen[z[chosen] >= OWN_Z])
    column = np.full(1 << SLOT_BITS, -1, np.int16)
    column[chosen] = np.arange(len(chosen))
    # by the kind of a text: the ratios and kinds of slots when it is left out
    others = [
        _ratios(toxic, np.maximum(clean - 1, 0), n_toxic, n_clean - 1),
        _ratios(np.maximum(toxic - 1, 0), clean, n_toxic - 1, n_clean),
    ]
    sent = spark.sparkContext.broadcast((column, [(r.astype(np.float32), k) for r, _, k in others]))

    def features(batches):
        column, others = sent.value
        for batch in batches:
            data, at = text_bytes(batch.column(0))
            cols, sums = [], []
            for i, y in enumerate(batch.column(1).to_pylist()):
                slots = _distinct_slots(data[at[i] : at[i + 1]])
                own = column[slots]
                cols.append(own[own >= 0])
                sums.append(np.bincount(others[y][1][slots], others[y][0][slots], KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(cols, pa.list_(pa.int16())), pa.array(sums, pa.list_(pa.float64()))],
                ["toxic", "cols", "sums"],
            )

    at = F.xxhash64("doc_id", "text").alias("at")
    known = docs.where("doc_id IS NOT NULL").select("doc_id", at).distinct().join(marks, "doc_id").select("at", "toxic")
    half = {1: max_rows // 2, 0: max_rows - max_rows // 2}
    drawn = [known.where(F.col("toxic") == k).orderBy("at").limit(n) for k, n in half.items()]
    keys = written(spark, drawn[0].union(drawn[1]), "sample")
    rows = docs.where("doc_id IS NOT NULL").select("text", at).join(F.broadcast(keys), "at")
    rows = rows.dropDuplicates(["at"]).select("text", "toxic")
    found = rows.mapInArrow(features, "toxic int, cols array<short>, sums array<double>").toArrow()
    cols = found["cols"].combine_chunks()
    lengths = np.diff(cols.offsets.to_numpy())
    y = found["toxic"].to_numpy().astype(float)
    flat = cols.flatten().to_numpy().astype(np.int64)
    sums = found["sums"].combine_chunks().flatten().to_numpy().reshape(len(y), KINDS)
    own, common, bias = _fit(np.repeat(np.arange(len(y)), lengths), flat, sums, y, ratio[chosen])
    weights = ratio * common[kind]
    weights[chosen] += own * ratio[chosen]
    return ToxicityModel(weights, float(bias))


def with_toxicity(spark: SparkSession, df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """Add `score` in [0, 1]; a null text counts as empty and gets the score of no feature.

    A column of that name is replaced; all other columns and rows stay as they are.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        z = shared.value.margins(texts)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return df.withColumn(score, scored(F.col(text).cast("string")))


def held_out(doc_id, folds: int = 3):
    """Every id whose crc32 leaves 1 is kept from learning."""
    return F.crc32(doc_id.cast("string")) % folds == 1


def judge(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = MAX_ROWS
) -> DataFrame:
    """`docs` with held_out, score and predicted (1 from `threshold` on), learned from the other folds.

    An id that is null belongs to no fold: held_out is null and the row teaches nothing.
    """
    model = train(spark, docs.where(~held_out(F.col("doc_id"))), labels, max_rows)
    out = with_toxicity(spark, docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
