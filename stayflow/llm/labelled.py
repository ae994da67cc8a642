"""A bounded sample of labelled texts for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows_per_class: int, max_bytes: int, doc_id: str = "doc_id", columns: list[str] | None = None) -> tuple[list[tuple], dict[int, int]]:
    """(label, columns...) of at most ``rows_per_class`` documents of each class, at most ``max_bytes`` of text altogether,
    in the order of a hash of the id; and how many labelled documents each class has.

    usable: whether a label row, by its ``doc_id``, may be learned from. A document with several labels counts by the largest.
    """
    columns = columns or ["text"]
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & usable).groupBy(doc_id).agg(F.max(label).alias("_y"))
    known = known.withColumn("_h", F.xxhash64(F.col(doc_id).cast("string")))
    total = {int(r["_y"]): r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    chosen = [known.where(F.col("_y") == y).orderBy("_h", doc_id).limit(rows_per_class) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).withColumnRenamed(doc_id, "_id")  # at most 2 * rows_per_class rows
    # one row for each id, the first of different ones by hash; texts that can't fit stay where they are
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in docs.select(*columns).dtypes if kind == "string"), F.lit(0))
    picked = docs.where(size <= max_bytes).select(doc_id, *columns).join(F.broadcast(ids), F.col(doc_id) == F.col("_id"))
    nth = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64(*columns), *columns))
    picked = picked.select("_h", "_id", "_y", *columns, nth.alias("_nth")).where("_nth = 1")
    out, used = [], 0
    for r in picked.orderBy("_h", "_id").select("_y", *columns).toLocalIterator():
        size = sum(len(v.encode()) for v in r[1:] if isinstance(v, str))
        if used + size > max_bytes:
            continue
        used += size
        out.append((int(r[0]), *r[1:]))
    return out, total
