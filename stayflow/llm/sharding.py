"""Sharding by extendible hashing.

A document's place is a 60-bit hash of its id. The directory is indexed by leading bits; a bucket whose bytes exceed
the limit splits on one more bit, and only such a bucket, until every shard fits or is a single row. The byte sums of the directory
come from one grouped sum over a prefix long enough for nearly all buckets; what is still too large goes through another pass
with all bits. The driver sees totals only.

Rows that agree in all 60 bits (repeated ids) split on the bits of a hash of their texts in the same way; rows with equal texts too are
alike, and are dealt by their number among each other into numbered parts, so one hot id or text spreads over many shards and tasks.

Defined cases: a null text has 0 bytes; a null id hashes as an empty string; a row larger than the limit is a shard of its own; input
columns that are named like a result column (n_bytes, shard_id, shard_depth, shard_bytes) give way to it; repeated rows are placed one
by one; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, ranked, small_enough

BITS = 60
#: Bits of the first pass beyond log2(bytes / limit).
MORE_BITS = 6


def place_of(column: str) -> Column:
    """The first 60 bits of the value's MD5 digest."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def size_of(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def leaves_of(rows: DataFrame, limit_bytes: int, top: int, deep: int) -> DataFrame:
    """For each prefix of ``deep`` bits (in its bucket ``_of``): its leaf (depth, prefix, bytes), the first depth from ``top`` on that fits; null if none does."""
    fine = cut(rows.groupBy("_of", F.shiftright("_place", BITS - deep).alias("_fine")).agg(F.sum("n_bytes").alias("_bytes"), F.count("*").alias("_rows")), "shard-bits")
    up = lambda a, b: fine.withColumn("_depth", F.explode(F.sequence(F.lit(a), F.lit(b)))).withColumn("_prefix", F.expr(f"shiftright(_fine, {deep} - _depth)"))
    fits = up(top, deep).groupBy("_of", "_depth", "_prefix").agg(F.sum("_bytes").alias("shard_bytes"), F.sum("_rows").alias("_n")).where((F.col("shard_bytes") <= limit_bytes) | (F.col("_n") == 1)).drop("_n")
    # a leaf fits and the prefix a bit shorter does not; only the depths that leaves have are joined, as short prefixes stand for many rows
    fits = cut(fits, "shard-fits")
    above = fits.select("_of", (F.col("_depth") + 1).alias("_depth"), F.col("_prefix").alias("_above"))
    ends = cut(fits.withColumn("_above", F.shiftright("_prefix", 1)).join(above, ["_of", "_depth", "_above"], "left_anti").drop("_above"), "shard-ends")
    low, high = ends.agg(F.min("_depth"), F.max("_depth")).first()
    first = up(top if low is None else low, deep if high is None else high).select("_of", "_fine", "_depth", "_prefix").join(ends, ["_of", "_depth", "_prefix"])
    leaves = cut(fine.join(first.select("_of", "_fine", F.struct("_depth", "_prefix", "shard_bytes").alias("_leaf")), ["_of", "_fine"], "left").select("_of", "_fine", "_leaf", "_bytes"), "shard-leaves")
    discard(fits, ends)
    discard(fine)
    return leaves


def assign_shards(docs: DataFrame, limit_bytes: int, start_bits: int = 0, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (``doc_id`` by default) of each row with n_bytes, shard_id (the leaf's bits; those of the text and a part
    number follow where equal ids had to be parted), shard_depth and shard_bytes."""
    own = ("n_bytes", "shard_id", "shard_depth", "shard_bytes")
    keep = [c for c in ([doc_id] if keep is None else keep) if c.lower() not in own]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    rows = docs.select(row, F.lit("").alias("_of"), place_of(doc_id).alias("_place"), place_of(text).alias("_next"), size_of(text).alias("n_bytes"))
    out = None
    for level in (0, 1):
        sizes = cut(rows.drop("_row"), "shard-rows")
        most = sizes.groupBy("_of").agg(F.sum("n_bytes").alias("_b")).agg(F.max("_b")).first()[0] or 0
        top = start_bits if not level else 0
        deep = min(BITS, max(top, math.ceil(math.log2(max(1.0, most / limit_bytes)))) + MORE_BITS)
        while True:
            leaves = leaves_of(sizes, limit_bytes, top, deep)
            done, left = leaves.where("_leaf IS NOT NULL").drop("_bytes"), leaves.where("_leaf IS NULL").select("_of", "_fine")
            fine = F.shiftright("_place", BITS - deep)
            placed = rows.withColumn("_fine", fine).join(small_enough(done), ["_of", "_fine"])
            placed = placed.select("_row", "n_bytes", F.concat("_of", _name("_leaf._depth", "_leaf._prefix")).alias("shard_id"), (F.col("_leaf._depth") + level * BITS).alias("shard_depth"), F.col("_leaf.shard_bytes").alias("shard_bytes"))
            out = placed if out is None else out.unionByName(placed)
            if left.isEmpty():
                return out.select("_row.*", *own)
            left = small_enough(left)
            rows = rows.withColumn("_fine", fine).join(left, ["_of", "_fine"], "left_semi").drop("_fine")
            if deep == BITS:
                break
            sizes = cut(sizes.withColumn("_fine", fine).join(left, ["_of", "_fine"], "left_semi").drop("_fine"), "shard-rows")
            top, deep = deep + 1, BITS  # few prefixes are left: those of large rows and of repeated ids
        rows = rows.select("_row", F.concat("_of", _name(str(BITS), "_place"), F.lit(".")).alias("_of"), F.col("_next").alias("_place"), F.lit(0).cast("long").alias("_next"), "n_bytes")
    return out.unionByName(_deal_alike(rows, limit_bytes)).select("_row.*", *own)


def _name(depth: str, prefix: str) -> Column:
    return F.expr(f"right(lpad(bin({prefix}), {BITS}, '0'), {depth})")


def _deal_alike(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """Rows with equal ids and texts in parts of as many as fit, by their rank among each other."""
    numbered = ranked(rows.select("_row", "_of", "n_bytes"), ["_of"], "shard-parts")
    room = F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.greatest("n_bytes", F.lit(1))))
    numbered = numbered.withColumn("_shard", F.concat("_of", F.lit("."), F.floor(F.col("_rank") / room).cast("string")))
    held = cut(numbered.groupBy("_shard").agg(F.sum("n_bytes").alias("shard_bytes")), "shard-sums")
    return numbered.join(small_enough(held), "_shard").select("_row", "n_bytes", F.col("_shard").alias("shard_id"), F.lit(2 * BITS).alias("shard_depth"), "shard_bytes")
