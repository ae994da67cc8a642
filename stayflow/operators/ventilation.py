"""Episodes of ventilation support: gaps and islands over the supported timestamps of a stay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import HOUR_US
from .checks import require_columns, require_none
from .statistics import spread

GAP_H, PASS_H = 8, 24
STAY = ["hospital_id", "stay_id_global"]


def supported_times(obs: DataFrame, markers: Sequence[str]) -> DataFrame:
    """The times at which a stay has any marker, once each."""
    return obs.where(F.col("variable").isin(list(markers)) & F.col("value").isNotNull()).select(*STAY, "time_us").distinct()


def check_times(obs: DataFrame, markers: Sequence[str]) -> None:
    """Raise if a supported row has no time (in ``obs`` a text that is none has become null)."""
    require_columns(obs, [*STAY, "time_us", "variable", "value"], "observations")
    marked = obs.where(F.col("variable").isin(list(markers)) & F.col("value").isNotNull())
    require_none(marked.where("time_us IS NULL"), "supported rows without a time")


def check_identity(stays: DataFrame) -> None:
    bad = stays.select(*STAY).distinct().groupBy("stay_id_global").agg(F.count("*").alias("hospitals"), F.count_if(F.col("hospital_id").isNull()).alias("unnamed"))
    require_none(bad.where("hospitals > 1 OR unnamed > 0 OR stay_id_global IS NULL"), "stays without one hospital")


def episodes(times: DataFrame, gap_h: float = GAP_H) -> DataFrame:
    """Maximal runs of times with gaps of at most ``gap_h`` hours, numbered from 1 in each stay."""
    order = Window.partitionBy(*STAY).orderBy("time_us")
    new = F.coalesce(F.col("time_us") - F.lag("time_us").over(order) > int(gap_h * HOUR_US), F.lit(True)).cast("int")
    runs = times.withColumn("_new", new).withColumn("episode", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(*STAY, "episode").agg(F.min("time_us").alias("start_us"), F.max("time_us").alias("end_us"), F.count("*").alias("timestamps"))
    return out.withColumn("duration_h", (F.col("end_us") - F.col("start_us")) / HOUR_US)


def stay_qc(stays: DataFrame, times: DataFrame, found: DataFrame, pass_h: float = PASS_H) -> DataFrame:
    """Timestamps, episodes and longest episode of every stay, those without support too."""
    n = times.groupBy(*STAY).agg(F.count("*").alias("_times"))
    e = found.groupBy(*STAY).agg(F.count("*").alias("_episodes"), F.max("duration_h").alias("_max"))
    out = stays.select(*STAY).distinct().join(n, STAY, "left").join(e, STAY, "left")
    longest = F.coalesce("_max", F.lit(0.0))
    return out.select(*STAY, F.coalesce("_times", F.lit(0)).cast("long").alias("timestamps"), F.coalesce("_episodes", F.lit(0)).cast("long").alias("episodes"), longest.alias("max_duration_h"), (longest >= pass_h).alias("passes"))


def hospital_summary(qc: DataFrame) -> DataFrame:
    counts = qc.groupBy("hospital_id", "max_duration_h").agg(F.count("*").alias("_c"), F.count_if("passes").alias("_p"))
    n = counts.groupBy("hospital_id").agg(F.sum("_c").alias("stays"), F.sum("_p").alias("passing"))
    out = n.join(spread(counts, ["hospital_id"], "max_duration_h"), "hospital_id")
    return out.select("hospital_id", "stays", "passing", (F.col("passing") / F.col("stays")).alias("share"), F.col("min").alias("min_h"), F.col("_q")[0].alias("p25_h"), F.col("_q")[1].alias("median_h"), F.col("_q")[2].alias("p75_h"), F.col("max").alias("max_h"))


def failed_stays(qc: DataFrame, pass_h: float = PASS_H) -> DataFrame:
    reason = F.when(F.col("timestamps") == 0, "no support").otherwise(f"longest episode under {pass_h} h")
    return qc.where("NOT passes").select(*STAY, "max_duration_h", reason.alias("reason"))
