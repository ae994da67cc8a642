"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import clear, delete, lifetime, new_path, shared_folder  # noqa: F401

#: A word: a run of bytes other than the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes (as JSON text) up to which a lookup table is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 48 * 2**20


#: Has Spark remove the shuffle files of a finished write, whose result no longer needs them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors. It goes with its `lifetime`."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``cut`` returned, once everything made from them has been written."""
    for df in frames:
        delete(df.sparkSession, df.cut_path)


#: Rows and bytes of an Arrow batch of texts at most; a batch of long documents would otherwise outgrow a worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 500, "spark.sql.execution.arrow.maxBytesPerBatch": 4 * 2**20}


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches no larger than BATCH."""
    conf = df.sparkSession.conf
    for key, most in BATCH.items():
        now = conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, most)
    return df


def texts_of(column: pa.Array) -> list[str | None]:
    """A column's texts; bytes that are not UTF-8, which a file may hold, become U+FFFD."""
    return [None if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and BROADCAST_BYTES, both counted, else as it is. Call it on a cut frame."""
    n, size = df.limit(rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("b")).agg(F.count("*"), F.sum("b")).first()
    return F.broadcast(df) if n <= rows and (size or 0) <= BROADCAST_BYTES else df


def ranked(df: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """``df`` with _rank, the number of each row among those with equal ``keys`` (strings), from 0, in no given order.

    Rows are numbered in each task, then over the tasks by their counts, so a key may hold any share of the rows.
    """
    at = [df.columns.index(k) for k in keys]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            nth = []
            for key in zip(*[b.column(i).to_pylist() for i in at]):
                nth.append(seen.get(key, 0))
                seen[key] = nth[-1] + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nth, pa.int64()), pa.array([task] * b.num_rows, pa.int64())], names=[*b.schema.names, "_nth", "_task"])

    schema = T.StructType([*df.schema.fields, T.StructField("_nth", T.LongType()), T.StructField("_task", T.LongType())])
    numbered = cut(small_batches(df).mapInArrow(number, schema), tag)
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    counts = numbered.groupBy(*keys, "_task").agg(F.count("*").alias("_c")).withColumnsRenamed(names | {"_task": "_of"})
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*names.values()).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut(counts.select(*names.values(), "_of", before.alias("_before")), f"{tag}-offsets")
    same = numbered["_task"] == offsets["_of"]
    for k, name in names.items():
        same = same & numbered[k].eqNullSafe(offsets[name])
    return numbered.join(small_enough(offsets), same).select(*[numbered[c] for c in df.columns], (F.col("_nth") + F.col("_before")).alias("_rank"))


def word_count(text: Column | str) -> Column:
    """Number of words of a text; a null text has 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
