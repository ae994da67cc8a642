"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected on the planes of several random rotations. On each plane a Hilbert curve, shifted at random, puts vectors in
order: keys are range-partitioned and sorted by Spark, which gives every vector its position. A vector is entered in the ``USED``
orders on whose planes it lies farthest out, and a query looks at its neighbours in those same orders: there an order says most
about inner products, and vectors that are near each other lie far out on the same planes. One more order holds all vectors, so
that no query is left without neighbours. Each order is cut into blocks of
``BLOCK`` neighbouring positions; a query is sent to the blocks that its window touches. Candidates of all windows are merged and
ranked by the exact inner product in double precision.

A window reaches ``SHARE`` of all rows and ``PLACES`` more positions to either side, at every size, so recall does not fall as the table
grows. Vectors are shipped as bytes in their own precision.

Equal vectors are one entry of the index with its smallest ids (as many as a result can hold), so a vector that a third of the rows
have is neither a hot key nor a window of copies.

Defined cases: vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part;
ties go to the smaller id; with fewer candidates than asked for, all that the windows hold are returned; rows with a null id take no part;
rows repeated with one id count once, with the smallest of their vectors; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, discard, small_enough

ROTATIONS, USED = 6, 24
SHARE, PLACES = 0.0125, 100
BITS = 12
BLOCK = 5_000
#: Positions whose queries meet a block together, and neighbouring queries that are compared at once.
RUN, NEIGHBOURS = 100_000, 16
#: Vectors that settle the planes' scale.
SAMPLE = 5000


def hilbert_key(x: np.ndarray, y: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of the grid cells (x, y) on the Hilbert curve of 2^bits cells a side."""
    x, y, key = x.astype(np.int64).copy(), y.astype(np.int64).copy(), np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        right, up = x >> level & 1, y >> level & 1
        key += (3 * right ^ up) << 2 * level
        # the curve inside a quadrant is turned so that the ends meet
        low = up == 0
        flip = low & (right == 1)
        mask = (1 << level) - 1
        fx, fy = np.where(flip, ~x & mask, x & mask), np.where(flip, ~y & mask, y & mask)
        x, y = np.where(low, fy, fx), np.where(low, fx, fy)
    return key


def rotations(dimension: int, count: int, seed: int) -> np.ndarray:
    """Orthonormal columns of ``count`` rotations side by side, two for each plane; a last odd axis is left out."""
    rng = np.random.default_rng(seed)
    even = max(1, dimension - dimension % 2)
    return np.concatenate([np.linalg.qr(rng.normal(size=(dimension, dimension)))[0][:, :even] for _ in range(count)], axis=1)


def usable(vector: str) -> Column:
    """Whether a vector takes part: no null or non-finite component, not all zero."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & good & F.exists(v, lambda x: x != 0), F.lit(False))


def best_pairs(x: np.ndarray, ids: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``y`` its ``k`` rows of ``x`` with the largest inner products, ties to smaller ids: (row of y, row of x, product).

    Products from a matrix product choose candidates, with a margin for their rounding; those are summed anew in one fixed order
    in double precision, so a pair has the same product wherever it is met.
    """
    scaled = [v / v.dtype.type(2.0 ** np.floor(np.log2(np.abs(v).max()))) for v in (x, y)]  # powers of 2: no product overflows, no digit is lost
    quick = scaled[1] @ scaled[0].T
    take = min(k, len(x))
    least = np.partition(quick, len(x) - take, axis=1)[:, len(x) - take]
    margin = np.float64(64 * np.finfo(x.dtype).eps) * np.linalg.norm(scaled[1].astype(np.float64), axis=1) * np.linalg.norm(scaled[0].astype(np.float64), axis=1).max()
    row, at = np.nonzero(quick >= (least - margin)[:, None])
    exact = np.concatenate([(y[row[i : i + 50_000]].astype(np.float64) * x[at[i : i + 50_000]].astype(np.float64)).sum(1) for i in range(0, len(row), 50_000)])
    order = np.lexsort((ids[at], -exact, row))
    row, at, exact = row[order], at[order], exact[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    keep = nth < k
    return row[keep], at[keep], exact[keep]


def search(table: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", count: int = ROTATIONS, used: int = USED, share: float = SHARE, places: int = PLACES, seed: int = 11) -> DataFrame:
    """query_id, rank, ``key`` and score of the ``k`` nearest (largest inner product) found for each query row.

    is_query: a condition on ``key``.
    """
    spark = table.sparkSession
    single = isinstance(table.schema[vector].dataType.elementType, T.FloatType)
    dtype = np.dtype(np.float32 if single else np.float64)
    good = table.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"), is_query.alias("q"))
    good = cut(good.groupBy("id").agg(F.min("v").alias("v"), F.bool_or("q").alias("q")), "ann-rows")
    scratch = [good]
    lengths = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    d = lengths[0]["d"]
    good = good.where(F.size("v") == d)
    # one entry for each different vector: its smallest k + 1 ids (the limit on row_number applies before the shuffle)
    first = good.withColumn("_nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("_nth") <= k + 1)
    asked = good.where("q").select("v").distinct().withColumn("asked", F.lit(True))
    entries = first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).join(asked, "v", "left")  # k + 1 ids at most
    entries = cut(entries.select(F.col("ids")[0].alias("e"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked")), "ann-entries")
    scratch.append(entries)
    n = entries.count()
    axes = rotations(d, count, seed)
    left, right = np.arange(0, axes.shape[1], 2), np.minimum(np.arange(0, axes.shape[1], 2) + 1, axes.shape[1] - 1)
    sample = np.array([r[0] for r in entries.select("v").orderBy(F.xxhash64("e")).limit(SAMPLE).collect()])
    spread = np.maximum(np.abs(sample @ axes).max(0), 1e-300)
    shifts = np.random.default_rng(seed + 1).uniform(-0.25, 0.25, axes.shape[1])
    chosen = min(used, len(left)) + 1  # the last order, on the first plane, holds all vectors
    left, right = np.append(left, 0), np.append(right, right[0])

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                b = whole.slice(start, 2000)
                y = b.column(1).flatten().to_numpy().reshape(-1, d).astype(np.float64) @ axes
                share = y / np.maximum(np.abs(y).max(axis=1, keepdims=True), 1e-300)
                energy = share[:, left] ** 2 + share[:, right] ** 2
                energy[:, -1] = np.inf
                plane = np.argsort(-energy, axis=1, kind="stable")[:, :chosen]
                x = [np.clip((np.take_along_axis(y, i[plane], 1) / spread[i[plane]] + shifts[i[plane]] + 1.25) / 2.5 * (1 << BITS), 0, (1 << BITS) - 1).ravel() for i in (left, right)]
                yield pa.RecordBatch.from_arrays([pa.array(plane.ravel().astype(np.int32)), pa.array(hilbert_key(*x)), pa.array(np.repeat(b.column(0).to_numpy(), chosen))], names=["o", "key", "e"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(len(left), np.int64)
        for b in batches:
            o = b.column(0).to_numpy()
            at = np.empty(len(o), np.int64)
            for p in np.unique(o):
                mine = np.flatnonzero(o == p)
                at[mine] = seen[p] + np.arange(len(mine))
                seen[p] += len(mine)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.full(len(o), part, np.int32)), pa.array(at)], names=["o", "e", "part", "at"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = pa.array([v.tobytes() for v in b.column(1).flatten().to_numpy().reshape(-1, d).astype(dtype)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), raw, b.column(2)], names=["e", "raw", "asked"])

    keys = entries.select("e", "v").mapInArrow(order, "o int, key long, e long")
    sorted_ = keys.repartitionByRange("o", "key", "e").sortWithinPartitions("o", "key", "e")
    placed = cut(sorted_.mapInArrow(number, "o int, e long, part int, at long"), "ann-places")
    scratch.append(placed)
    counts = placed.groupBy("o", "part").agg(F.count("*").alias("c"))
    of_order = Window.partitionBy("o")
    before = F.coalesce(F.sum("c").over(of_order.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut(counts.select("o", "part", before.alias("before"), F.sum("c").over(of_order).alias("size")), "ann-offsets")
    scratch.append(offsets)
    placed = placed.join(small_enough(offsets), ["o", "part"]).withColumn("at", F.col("at") + F.col("before"))
    half = int(np.ceil(share * n)) + places
    raw = cut(entries.select("e", "v", "asked").mapInArrow(packed, "e long, raw binary, asked boolean"), "ann-raw")
    scratch.append(raw)
    # a block of positions meets the queries of a run of positions at a time, so neither side of a group grows with the table
    b, last = F.floor(F.col("at") / BLOCK), F.col("size") - 1
    runs = F.explode(F.sequence(F.floor(F.greatest(b * BLOCK - half, F.lit(0)) / RUN), F.floor(F.least((b + 1) * BLOCK - 1 + half, last) / RUN)))
    rows = placed.select("o", "e", "at", b.alias("b"), runs.alias("r")).join(raw.select("e", "raw"), "e")
    visits = F.explode(F.sequence(F.floor(F.greatest(F.col("at") - half, F.lit(0)) / BLOCK), F.floor(F.least(F.col("at") + half, last) / BLOCK)))
    asks = placed.select("o", "e", "at", F.floor(F.col("at") / RUN).alias("r"), visits.alias("b")).join(raw.where("asked").select("e", "raw"), "e")
    asks = asks.select(*[F.col(c).alias(f"q_{c}") for c in ("o", "b", "r", "at", "e", "raw")])

    def rank(here: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        here, queries = here.sort_values("at"), queries.sort_values("q_at")
        x, ids, place = np.frombuffer(b"".join(here["raw"]), dtype).reshape(-1, d), here["e"].to_numpy(), here["at"].to_numpy()
        y, own, asked_at = np.frombuffer(b"".join(queries["q_raw"]), dtype).reshape(-1, d), queries["q_e"].to_numpy(), queries["q_at"].to_numpy()
        out = [pd.DataFrame({"e": own[:0], "c": ids[:0], "score": np.zeros(0)})]
        for i in range(0, len(y), NEIGHBOURS):
            j = min(len(y), i + NEIGHBOURS)
            low, high = np.searchsorted(place, asked_at[i] - half), np.searchsorted(place, asked_at[j - 1] + half, "right")
            if low < high:
                row, near, score = best_pairs(x[low:high], ids[low:high], y[i:j], k + 1)
                out.append(pd.DataFrame({"e": own[i + row], "c": ids[low + near], "score": score}))
        return pd.concat(out)

    found = rows.groupBy("o", "b", "r").cogroup(asks.groupBy("q_o", "q_b", "q_r")).applyInPandas(rank, "e long, c long, score double")
    # an entry is its own candidate too: its other ids may be; k + 1 entries always hold k ids beside the query's own
    merged = found.groupBy("e", "c").agg(F.max("score").alias("score"))
    merged = merged.withColumn("_r", F.row_number().over(Window.partitionBy("e").orderBy(F.desc("score"), "c"))).where(F.col("_r") <= k + 1)
    lists = merged.join(entries.select(F.col("e").alias("c"), "ids"), "c").groupBy("e").agg(F.sort_array(F.flatten(F.collect_list(F.expr("transform(ids, x -> struct(-score AS s, x AS id))")))).alias("l"))
    lists = cut(lists.select("e", F.slice("l", 1, k + 1).alias("l")), "ann-lists")
    scratch.append(lists)
    queries = good.where("q").select("id", "v").join(entries.where("asked").select("e", "v"), "v").select("id", "e")
    own = F.slice(F.filter("l", lambda x: x["id"] != F.col("id")), 1, k)
    result = queries.join(small_enough(lists, 50_000), "e").select(F.col("id").alias("query_id"), F.posexplode(own).alias("_at", "_x"))
    result = cut(result.select("query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_x.id").alias(key), (-F.col("_x.s")).alias("score")), "ann-result")
    discard(*scratch)
    return result
