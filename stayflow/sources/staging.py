"""Tables written once to the folder that driver and executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOCAL_FOLDERS: dict[str, str] = {}
#: Folders that go when their application ends, and the paths staged in each open `lifetime`.
LEAVING: set[str] = set()
LIFETIMES: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder that all executors share (spark.checkpoint.dir).

    Where the session names none: a temporary folder if driver and executors are one process, else an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in LOCAL_FOLDERS:
            LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="stayflow-")
        root = LOCAL_FOLDERS[context.applicationId]
    folder = f"{root}/stayflow-{context.applicationId}"
    if folder not in LEAVING:  # so that nothing outlives the application, however it ends
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        LEAVING.add(folder)
    return folder


def new_path(spark: SparkSession, tag: str) -> str:
    """A path for a table, which goes with the innermost open `lifetime`."""
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    if LIFETIMES:
        LIFETIMES[-1].append(path)
    return path


@contextmanager
def lifetime(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside, by queries and operators of both libraries, are deleted at its end: read or write results before."""
    mine: list[str] = []
    LIFETIMES.append(mine)
    try:
        yield
    finally:
        LIFETIMES.remove(mine)
        for path in mine:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete every table that this application has staged; frames made from them can't be read any more."""
    delete(spark, shared_folder(spark))


def stage(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what many reports read is made once. It goes with its `lifetime`, by `clear` or with the application."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (counted), else as it is, so that the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def running_total(df: DataFrame, order: Sequence[str], amount: str, to: str) -> DataFrame:
    """``df`` (staged) with the sum of ``amount`` over all rows before each in ``order``, which names each row.

    Sums run inside each range of the order; a row for each range then says what came before it, so no task holds the whole order.
    """
    ranged = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(F.sum(amount).alias("_sum"))
    starts = ranges.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))  # a row a range
    zero = F.lit(0)
    return ranged.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), zero)).join(F.broadcast(starts), "_range").withColumn(to, F.col("_inside") + F.col("_start")).drop("_range", "_inside", "_start")
