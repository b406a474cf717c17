"""Ranked lexical search: best-first document intervals under range-maximum bounds.

Documents are dealt into shards of bounded size, each built in one task from whole texts
and numbered in the order of doc_id. A shard holds one posting list for each queried term:
its documents and, once N, L and the document frequencies are known, the impact of the term
on each of them. A sparse table over a list answers the largest impact between any two
documents in constant time.

A search begins with the interval of all documents of a shard. An interval's bound is the
sum of its lists' largest impacts; the interval of the highest bound is split at the
document of its largest single impact, which is scored exactly, and the two rests get bounds
of their own. The search ends when no bound reaches the k-th score found. Intervals that
hold few postings are read out whole. Ranks are those of scoring every document.

Which terms are queried reaches the tasks as a bitmap of 2^23 hashes (1 MB, whatever the
number of queries); it steers cost only, the terms themselves are joined afterwards. Queries
meet the shards in blocks of BLOCK.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.components import written

BITMAP_BITS = 23
SHARD_BYTES = 8 << 20
SHARD_ROWS = 1 << 15
BLOCK = 256
# intervals split at once, and postings of an interval that is read out
WIDTH = 32
LEAF = 1024
POSTINGS = "shard long, term binary, docs array<int>, counts array<long>, ids array<long>, lengths array<long>"

# what is neither a digit, an ASCII letter nor beyond ASCII separates; A-Z are lowered
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text in UTF-8; a null text has none."""
    return (text or "").encode().translate(_PLAIN).split()


class _Queried(dict):
    """Whether a term may be queried, by the bitmap; remembers what it was asked."""

    def __init__(self, bitmap: np.ndarray):
        self.bitmap = bitmap

    def __missing__(self, term: bytes) -> bool:
        if len(self) > 500_000:
            self.clear()
        h = zlib.crc32(term) >> (32 - BITMAP_BITS)
        self[term] = found = bool(self.bitmap[h >> 3] >> (h & 7) & 1)
        return found


def _postings(docs: DataFrame, bitmap) -> DataFrame:
    """Rows (shard, term, docs, counts); the row of the empty term has the shard's ids and lengths."""

    def build(batches):
        queried, task, number = _Queried(bitmap.value), TaskContext.get().partitionId(), 0
        ids, lengths, found, size = [], [], [], 0

        def shard():
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            lists = {}
            for at, i in enumerate(order):
                for term, n in found[i].items():
                    own = lists.setdefault(term, ([], []))
                    own[0].append(at)
                    own[1].append(n)
            names = [b"", *lists]
            rows = len(names)
            columns = [
                pa.array(np.full(rows, task << 31 | number)),
                pa.array(names, pa.binary()),
                pa.array([None, *(x[0] for x in lists.values())], pa.list_(pa.int32())),
                pa.array([None, *(x[1] for x in lists.values())], pa.list_(pa.int64())),
                pa.array([[ids[i] for i in order], *[None] * len(lists)], pa.list_(pa.int64())),
                pa.array([[lengths[i] for i in order], *[None] * len(lists)], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["shard", "term", "docs", "counts", "ids", "lengths"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(text)
                ids.append(doc_id)
                lengths.append(len(words))
                found.append(Counter([w for w in words if queried[w]]))
                size += len(text or "")
                if size >= SHARD_BYTES or len(ids) >= SHARD_ROWS:
                    yield shard()
                    number, size = number + 1, 0
                    ids, lengths, found = [], [], []
        if ids:
            yield shard()

    return docs.mapInArrow(build, POSTINGS)


class Shard:
    """Posting lists of one shard with the impacts of their terms and range-maximum tables.

    `lists` are (documents in rising order, impacts), one for each term.
    """

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int):
        self.n_docs = n_docs
        ends = np.cumsum([0, *(len(d) for d, _ in lists)])
        self.start, self.end = ends[:-1], ends[1:]
        self.docs = np.concatenate([d for d, _ in lists]).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.impact = np.concatenate([i for _, i in lists]) if lists else np.zeros(0, np.int64)
        # rising over all lists, so one binary search serves many of them
        self.key = np.repeat(np.arange(len(lists)), np.diff(ends)) * (n_docs + 1) + self.docs
        longest = max((len(d) for d, _ in lists), default=0)
        # levels[j][i]: where the largest impact among i ... i + 2^j - 1 is, the first of equals
        self.levels = [np.arange(len(self.docs), dtype=np.int32)]
        for j in range(1, longest.bit_length()):
            half, last = 1 << (j - 1), self.levels[-1]
            left, right = last[:-half], last[half:]
            self.levels.append(np.where(self.impact[left] >= self.impact[right], left, right))

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest impact, its place) within low ... high - 1 of each list; 0 where that is empty."""
        size = high - low
        place = np.zeros_like(low)
        level = np.frexp(np.maximum(size, 1).astype(float))[1] - 1
        for j in np.unique(level[size > 0]):
            at = (level == j) & (size > 0)
            a, b = self.levels[j][low[at]], self.levels[j][high[at] - (1 << j)]
            place[at] = np.where(self.impact[a] >= self.impact[b], a, b)
        value = np.where(size > 0, self.impact[place], 0) if len(self.impact) else np.zeros_like(low)
        return value, place

    def read_out(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all postings of these intervals."""
        low, size = low.ravel(), (high - low).ravel()
        before = np.cumsum(size) - size
        at = np.repeat(low - before, size) + np.arange(size.sum())
        order = np.argsort(self.docs[at], kind="stable")
        docs = self.docs[at][order]
        first = np.flatnonzero(np.diff(docs, prepend=-1))
        return docs[first], np.add.reduceat(self.impact[at][order], first)

    def best(self, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k highest sums of impacts over the lists `own`, equal ones by document."""
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high = self.start[own][None, :], self.end[own][None, :]
        base = own * (self.n_docs + 1)
        first = np.zeros(1, np.int64)  # no document of the interval comes before it
        value, place = self.largest(low, high)
        while len(low):
            bound = value.sum(1)
            if len(docs) == k:
                open_ = (bound > scores[-1]) | ((bound == scores[-1]) & (first < docs[-1]))
            else:
                open_ = bound > 0
            low, high, first, value, place, bound = (x[open_] for x in (low, high, first, value, place, bound))
            order = np.lexsort((first, -bound))
            now, later = order[:WIDTH], order[WIDTH:]
            small = (high[now] - low[now]).sum(1) <= LEAF
            leaves, split = now[small], now[~small]
            found = [(docs, scores)]
            if len(leaves):
                found.append(self.read_out(low[leaves], high[leaves]))
            parts = [(low[later], high[later], first[later], value[later], place[later])]
            if len(split):
                top = np.argmax(value[split], 1)
                at = self.docs[place[split, top]]
                a, b = low[split], high[split]
                middle = np.searchsorted(self.key, base[None, :] + at[:, None])
                holds = (middle < b) & (self.docs[np.minimum(middle, len(self.docs) - 1)] == at[:, None])
                found.append((at, np.where(holds, self.impact[np.minimum(middle, len(self.docs) - 1)], 0).sum(1)))
                for x, y, begin in ((a, middle, first[split]), (middle + holds, b, at + 1)):
                    parts.append((x, y, begin, *self.largest(x, y)))
            low, high, first, value, place = (np.concatenate(x) for x in zip(*parts))
            docs, scores = (np.concatenate(x) for x in zip(*found))
            keep = np.lexsort((docs, -scores))[:k]
            keep = keep[scores[keep] > 0]
            docs, scores = docs[keep], scores[keep]
        return docs, scores


def _scale(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """What a document's length adds: 100 - 90 + 90 * n * N div L, in whole numbers of any size."""
    if 90 * int(lengths.max(initial=0)) * n < 1 << 63:
        return 10 + 90 * lengths * n // max(total, 1)
    return np.array([10 + 90 * int(x) * n // max(total, 1) for x in lengths], np.int64)


def ranked_search(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item of `queries` (item_id, text) its k best rows of `docs` (doc_id long, text).

    Only scores above 0 count; equal scores go by ascending doc_id, rows without one last. An
    item's terms count once each; an item_id on several rows has the terms of all of them,
    rows without item_id ask nothing. Every row of `docs` is a document of its own, repeated
    ones and those without doc_id included; null and empty texts hold no term and are in no
    count. Other columns are not read. Empty tables give no rows.
    """

    @F.arrow_udf("array<binary>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([list(dict.fromkeys(terms(t))) for t in texts.to_pylist()], pa.list_(pa.binary()))

    def mark(batches):
        seen = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        for batch in batches:
            for term in batch.column(0).to_pylist():
                h = zlib.crc32(term) >> (32 - BITMAP_BITS)
                seen[h >> 3] |= 1 << (h & 7)
        yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()])], ["seen"])

    asked = queries.where("item_id IS NOT NULL").select("item_id", F.explode(split("text")).alias("term")).distinct()
    asked = written(spark, asked, "asked")
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    # a fixed number of tasks, so a fixed number of bitmaps
    for row in asked.select("term").coalesce(8).mapInArrow(mark, "seen binary").toLocalIterator():
        bitmap |= np.frombuffer(row.seen, np.uint8)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = written(spark, _postings(docs, spark.sparkContext.broadcast(bitmap)), "postings")
    length = lambda kept: F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + kept(x))
    n, total = index.where("term = X''").agg(
        F.coalesce(F.sum(length(lambda x: (x > 0).cast("long"))), F.lit(0)),
        F.coalesce(F.sum(length(lambda x: x)), F.lit(0)),
    ).first()
    held = index.where("term <> X''").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    blocks = -(-asked.select("item_id").distinct().count() // BLOCK) or 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
    weight = F.floor(1000 * F.log((2.0 * F.lit(n) + 2) / (2.0 * F.col("df") + 1)))
    weighed = asked.join(held, "term").groupBy("term", block).agg(
        F.max(weight).cast("long").alias("weight"), F.collect_list("item_id").alias("items")
    )
    none = F.array().cast(weighed.schema["items"].dataType)
    every = spark.range(blocks).select(F.lit(b"").alias("term"), F.col("id").cast("int"), F.lit(0).cast("long"), none)
    meeting = index.join(weighed.union(every), "term").drop("term")
    kind = asked.schema["item_id"].dataType.simpleString()
    found = meeting.groupBy("shard", "block").applyInArrow(
        lambda group: _search(group, n, total, k), f"item_id {kind}, doc_id long, score long"
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search(group: pa.Table, n: int, total: int, k: int) -> pa.Table:
    """The best documents of one shard for the items of one block."""
    group = group.combine_chunks()
    head = group.filter(pc.is_valid(group["ids"]))
    rows = group.filter(pc.is_null(group["ids"]))
    ids, lengths = head["ids"][0].values, head["lengths"][0].values.to_numpy()
    scale = _scale(lengths, n, total)
    lists, of_item = [], {}
    for i, (weight, items) in enumerate(zip(rows["weight"].to_pylist(), rows["items"].to_pylist())):
        at, count = rows["docs"][i].values.to_numpy(), rows["counts"][i].values.to_numpy()
        lists.append((at, weight * (1_000_000_000 * count // (1000 * count + 8 * scale[at]))))
        for item in items:
            of_item.setdefault(item, []).append(i)
    shard = Shard(lists, len(ids))
    names, found, scores = [], [], []
    for item, members in of_item.items():
        docs, score = shard.best(np.array(members), k)
        names += [item] * len(docs)
        found.append(docs)
        scores.append(score)
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pa.table(
        {
            "item_id": pa.array(names, rows["items"].type.value_type),
            "doc_id": ids.take(pa.array(at)),
            "score": pa.array(np.concatenate(scores) if scores else np.zeros(0, np.int64)),
        }
    )
