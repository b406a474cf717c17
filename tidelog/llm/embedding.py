"""Near-duplicate embeddings: random-hyperplane hashing, exact cosines, connected components.

Equal vectors are one class. A class's signature in a table is the side of `bits` random
hyperplanes it lies on; two vectors at an angle a agree on a bit with chance 1 - a / pi.
`bits` grows with the logarithm of the number of classes, so that unrelated vectors seldom
meet, and the number of tables with it, so that a pair just at the threshold meets in some
table with a chance of at least RECALL. The planes come from a fixed seed.

Buckets of more than BLOCK classes are dealt to blocks, and pairs of blocks meet in cells
of bounded size. A cell compares all its pairs in double precision, counts a pair only in
the first table where it meets, and returns counts for each class and a spanning forest of
its links, not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.components import components, written

RECALL = 0.99
BLOCK = 256
SEED = 20240315


def plan(classes: int, threshold: float) -> tuple[int, int]:
    """(bits of a signature, number of tables)."""
    bits = max(8, math.ceil(math.log2(max(2, classes))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - agree))


def _vectors(column: pa.Array) -> list[bytes | None]:
    """Doubles of each row as bytes; None for null, empty, zero and non-finite vectors."""
    column = column.cast(pa.list_(pa.float64()))
    out: list[bytes | None] = [None] * len(column)
    starts = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(usable & (np.diff(starts) > 0)):
        values = flat[starts[i] : starts[i + 1]] + 0.0
        if np.isfinite(values).all() and values.any():
            # the scale of a vector is no part of its direction, and squares must not overflow
            out[i] = (values / np.abs(values).max()).tobytes()
    return out


def _directions(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_vectors(batch.column(1)), pa.binary())], ["vec_id", "direction"]
            )

    out = rows.select("vec_id", "embedding").mapInArrow(run, "vec_id long, direction binary")
    return out.withColumn("class", F.md5("direction"))


def _signatures(matrix: np.ndarray, bits: int, tables: int) -> np.ndarray:
    planes = np.random.default_rng([SEED, matrix.shape[1]]).standard_normal((matrix.shape[1], bits * tables))
    sides = (matrix @ planes > 0).reshape(len(matrix), tables, bits)
    return sides @ (1 << np.arange(bits, dtype=np.int64))


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Adds signatures, one number for each table; vectors of different lengths never agree."""

    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            sizes = np.array([len(r) for r in raw])
            out = np.zeros((len(raw), tables), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                matrix = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)
                out[at] = _signatures(matrix, bits, tables) + (int(size) << bits)
            listed = pa.ListArray.from_arrays(np.arange(0, out.size + 1, tables, dtype=np.int32), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], ["node", "direction", "copies", "signatures"])

    return classes.select("node", "direction", "copies").mapInArrow(
        run, "node long, direction binary, copies long, signatures array<long>"
    )


def _cells(signed: DataFrame) -> DataFrame:
    """Rows of the cells where pairs meet: only buckets that several classes share."""
    at = signed.select("node", F.posexplode("signatures").alias("table", "signature"))
    shared = at.groupBy("table", "signature").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (
        at.join(shared, ["table", "signature"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    return dealt.select(
        "node",
        "table",
        "signature",
        "own",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    ).join(signed, "node")


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys of a sorted stream, one table for each key."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        codes = np.stack([table[k].to_numpy() for k in key])
        cuts = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1
        ends = [0, *cuts.tolist()]
        for a, b in zip(ends, ends[1:]):
            yield table.slice(a, b - a)
        held = table.slice(ends[-1]).combine_chunks()
    if held is not None and len(held):
        yield held


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a small symmetric graph."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(linked)).min(1, initial=len(linked))
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(cells: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): partial link counts and spanning links of each cell."""
    key = ["table", "signature", "i", "j"]

    def run(batches):
        for cell in _runs(batches, key):
            table, i, j = (cell[k][0].as_py() for k in ("table", "i", "j"))
            node, copies, own = (cell[k].to_numpy() for k in ("node", "copies", "own"))
            signatures = cell["signatures"].combine_chunks().flatten().to_numpy().reshape(len(cell), -1)
            matrix = np.frombuffer(b"".join(cell["direction"].to_pylist()), np.float64).reshape(len(cell), -1)
            length = np.sqrt((matrix * matrix).sum(1))
            linked = (matrix @ matrix.T) / np.outer(length, length) >= threshold
            linked &= own[:, None] != own[None, :] if i != j else ~np.eye(len(cell), dtype=bool)
            for a, b in zip(*np.nonzero(np.triu(linked))) if table else ():
                # met before, and counted there
                if (signatures[a, :table] == signatures[b, :table]).any():
                    linked[a, b] = linked[b, a] = False
            if linked.any():
                some = linked.any(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[some]),
                        pa.array((linked @ copies)[some].astype(np.int64)),
                        pa.array(node[_roots(linked)[some]]),
                    ],
                    ["node", "links", "root"],
                )

    dealt = cells.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "node long, links long, root long")


def embedding_components(spark: SparkSession, rows: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding).

    n_links counts the other rows at a cosine of at least `threshold` that were found;
    component_id is the smallest vec_id reachable; kept is vec_id = component_id. Vectors
    that are null, empty or zero or hold null or non-finite components link with nothing,
    and so do vectors of different lengths. Repeated rows are vectors of their own: they
    link with each other. A row without vec_id counts as a link, names no component and is
    kept only if it is alone. Other columns, labels among them, are not read.
    """
    given = written(spark, _directions(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")), "directions")
    grouped = given.where("direction IS NOT NULL").groupBy("class").agg(
        F.first("direction").alias("direction"), F.count("*").alias("copies"), F.min("vec_id").alias("vec_id")
    )
    classes = written(spark, grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    bits, tables = plan(classes.count(), threshold)
    signed = written(spark, _signed(classes, bits, tables), "signed")
    found = written(spark, _compare(_cells(signed), threshold), "links")
    joined = components(spark, found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        classes.select("node", "class", "copies", "vec_id")
        .join(joined, "node", "left")
        .join(links, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_class = named.join(lowest, "component").select(
        "class", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    own = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return given.select("vec_id", "class").join(of_class, "class", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"),
    )
