"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length (words). Each source has a target; whole passes over the source come first, then a
subset whose lengths add up to the rest of the budget. The subset is planned on the counts alone: an even share of every
length, then the longest lengths that still fit, then a bounded knapsack (subset sum) for what remains; where that misses because a
document is a large part of the budget, the long documents are settled first by a knapsack of their own. Which documents
of a length are taken is settled by a seeded hash of their ids.

A source, a length or an id may hold a third of all rows: the documents of a length are counted by hash range, then by id in the one
range that the cut falls in, and every row compares itself with the cut. Neither a row's text nor its columns are shuffled.

Defined cases: a null text has no words; a null source is a source of its own, last in order; documents without words
are never repeated and take nothing; an empty table gives no rows; repeated rows and null ids are taken or left one by one; other columns,
whatever their names and types, are kept by ``take_mix`` and not read by ``mix_sources``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ranked, small_enough, word_count

#: Words of a budget that the knapsack fits exactly; greedy steps bring the budget down to this.
KNAPSACK_WORDS = 60_000
#: Units in which the words of documents over half of that are counted, so that memory doesn't grow with a budget.
LONG_UNITS = 2**21


def reshare(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """``total`` by weight; no share over ``most`` times its size, the excess going to the others by weight."""
    share, open_ = [0.0] * len(sizes), [i for i in range(len(sizes)) if sizes[i] > 0]
    left = total
    while open_:
        whole = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / whole > most * sizes[i]]
        if not over:
            for i in open_:
                share[i] = left * weights[i] / whole
            break
        for i in over:
            share[i] = most * sizes[i]
            left -= share[i]
        open_ = [i for i in open_ if i not in set(over)]
    return share


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the words come nearest to ``budget`` (ties: below it)."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or total <= 0:
        return take
    if budget >= total:
        return counts.copy()
    spread = _spread_budget(lengths, counts, budget, total)
    missed = abs(budget - int((lengths * spread).sum()))
    if not missed or lengths[counts > 0].max() <= KNAPSACK_WORDS // 2:
        return spread
    # a document as long as a part of the budget has to be settled before the others
    other = _long_first(lengths, counts, budget)
    return other if abs(budget - int((lengths * other).sum())) < missed else spread


def _long_first(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Of the long lengths those whose words leave a rest that the short ones can fill, then the rest from the short ones."""
    long_ = lengths > KNAPSACK_WORDS // 2
    short_words = int((lengths * counts)[~long_].sum())
    unit = -(-budget // LONG_UNITS)
    take = np.zeros(len(lengths), np.int64)
    take[long_] = knapsack(-(-lengths[long_] // unit), counts[long_], budget // unit, max(0, budget - short_words) // unit)
    left = budget - int((lengths * take).sum())
    if left > 0:
        take[~long_] = fit_budget(lengths[~long_], counts[~long_], left)
    return take


def _spread_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, total: int) -> np.ndarray:
    """An even share of every length, the longest that still fit, then the knapsack."""
    take = np.zeros(len(lengths), np.int64)
    if budget > KNAPSACK_WORDS:
        even = min(1.0, (budget - KNAPSACK_WORDS / 2) / total)
        take = np.floor(counts * even).astype(np.int64)
        left = budget - int((lengths * take).sum())
        for i in np.argsort(-lengths, kind="stable"):
            if left <= KNAPSACK_WORDS:
                break
            if lengths[i]:
                more = min(int(counts[i] - take[i]), max(0, (left - KNAPSACK_WORDS // 2)) // int(lengths[i]))
                take[i] += more
                left -= more * int(lengths[i])
    left = budget - int((lengths * take).sum())
    return take + knapsack(lengths, counts - take, left) if left <= 2 * KNAPSACK_WORDS else take


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, least: int | None = None) -> np.ndarray:
    """Bounded subset sum over bit sets: which totals are reachable, and with which length each was first reached.

    The total nearest to ``budget``, or to the range from ``least`` to it. A total over twice the budget is farther than none at all.
    """
    least = budget if least is None else least
    top = min(budget + int(lengths.max(initial=0)), 2 * budget)
    mask, reach = (1 << (top + 1)) - 1, 1
    first = np.full(top + 1, -1, np.int32)
    for i in np.argsort(lengths, kind="stable"):
        length, n = int(lengths[i]), int(counts[i])
        if not length or not n or length > top:
            continue
        before, piece, n = reach, 1, min(n, top // length)
        while n > 0:
            step = min(piece, n)
            reach |= (reach << (step * length)) & mask
            n, piece = n - step, piece * 2
        fresh = np.unpackbits(np.frombuffer((reach & ~before).to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little")[: top + 1]
        first[np.flatnonzero(fresh)] = i
        if reach >> least & ((1 << (budget - least + 1)) - 1):
            break
    ok = np.append(0, np.flatnonzero(first[1:] >= 0) + 1)
    away = np.maximum(np.maximum(ok - budget, least - ok), 0)
    at = int(ok[np.argmin(away)])  # the first of the nearest
    take = np.zeros(len(lengths), np.int64)
    while at:
        take[first[at]] += 1
        at -= int(lengths[first[at]])
    return take


def source_targets(counts: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size and target of each source. The driver holds one row for each source."""
    spark = counts.sparkSession
    rows = counts.groupBy("_source").agg(F.sum(F.col("_size") * F.col("n")).alias("source_size")).collect()
    rows.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    sizes = [int(r["source_size"]) for r in rows]
    targets = reshare(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    return spark.createDataFrame([(r["_source"], s, float(t)) for r, s, t in zip(rows, sizes, targets)], "source string, source_size long, target double")


def _with_copies(rows: DataFrame, sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``rows`` (with _id, _source, _size, _h) with _source_size, _target and _copies; sizes: the same four columns, written.

    Of each source and length the first documents by (hash, id) are taken, so all that a row needs is where the cut lies: one row a source and length.
    """
    counts = cut(sizes.groupBy("_source", "_size").agg(F.count("*").alias("n")), "mix-counts")
    targets = source_targets(counts, weights, share, most)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        whole, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
        passes = int(target // whole) if whole else 0
        pick = fit_budget(frame["_size"].to_numpy(), frame["n"].to_numpy(), round(target - passes * whole))
        return frame.assign(passes=passes, pick=pick)

    with_target = counts.join(small_enough(targets), counts["_source"].eqNullSafe(targets["source"])).drop("source")
    plan = with_target.groupBy("_source").applyInPandas(fit, "_source string, _size long, n long, source_size long, target double, passes long, pick long")
    plan = cut(plan.withColumn("_runs", F.ceil(F.sqrt("n"))).withColumnsRenamed({"_source": "p_source", "_size": "p_size"}), "mix-plan")
    # the cut of a length: first the hash range that it falls in, then the id
    part = plan.where("pick > 0 AND pick < n").select("p_source", "p_size", "pick", "_runs")
    run = F.least(F.floor((F.shiftrightunsigned("_h", 1).cast("double") / float(2**63)) * F.col("_runs")), F.col("_runs") - 1)
    open_ = sizes.join(small_enough(part), sizes["_source"].eqNullSafe(part["p_source"]) & (sizes["_size"] == part["p_size"])).withColumn("_run", run)
    open_ = open_.withColumn("_hash", F.shiftrightunsigned("_h", 1))
    group = Window.partitionBy("p_source", "p_size")
    upto = Window.unboundedPreceding, Window.currentRow
    runs = open_.groupBy("p_source", "p_size", "pick", "_run").agg(F.count("*").alias("_in"))
    runs = runs.withColumn("_upto", F.sum("_in").over(group.orderBy("_run").rowsBetween(*upto))).where("_upto >= pick AND _upto - _in < pick")
    runs = cut(runs.select(F.col("p_source").alias("r_source"), F.col("p_size").alias("r_size"), F.col("_run").alias("r_run"), (F.col("pick") - F.col("_upto") + F.col("_in")).alias("_left")), "mix-runs")
    inside = open_.join(small_enough(runs), open_["p_source"].eqNullSafe(runs["r_source"]) & (open_["p_size"] == runs["r_size"]) & (open_["_run"] == runs["r_run"]))
    ids = inside.groupBy("p_source", "p_size", "_left", "_hash", "_id").agg(F.count("*").alias("_c"))
    ids = ids.withColumn("_upto", F.sum("_c").over(group.orderBy("_hash", F.col("_id").asc_nulls_first()).rowsBetween(*upto))).where("_upto >= _left AND _upto - _c < _left")
    ids = ids.select(F.col("p_source").alias("r_source"), F.col("p_size").alias("r_size"), F.col("_hash").alias("_cut_hash"), F.col("_id").alias("_cut_id"), (F.col("_left") - F.col("_upto") + F.col("_c")).alias("_cut_rows"), F.col("_c").alias("_cut_of"))
    plan = cut(plan.join(ids, plan["p_source"].eqNullSafe(ids["r_source"]) & (plan["p_size"] == ids["r_size"]), "left").drop("r_source", "r_size"), "mix-cuts")
    joined = rows.join(small_enough(plan), rows["_source"].eqNullSafe(plan["p_source"]) & (rows["_size"] == plan["p_size"]))
    mine, at = F.shiftrightunsigned("_h", 1), F.col("_cut_hash")
    same = F.coalesce((mine == at) & F.col("_id").eqNullSafe(F.col("_cut_id")), F.lit(False))
    first = (mine < at) | ((mine == at) & F.coalesce(F.col("_id") < F.col("_cut_id"), F.col("_id").isNull()))
    more = F.when(F.col("pick") >= F.col("n"), True).when(F.col("pick") <= 0, False).otherwise(same | first)
    joined = joined.select(*rows.columns, F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "passes", more.cast("long").alias("_more"), (same & (F.col("_cut_of") > F.col("_cut_rows"))).alias("_some"), "_cut_rows")
    found = joined.where("NOT coalesce(_some, false)").drop("_some", "_cut_rows")
    if not plan.where("_cut_of > _cut_rows").isEmpty():
        # rows of one id and length of which only some are taken
        some = ranked(joined.where("_some").withColumn("_key", F.to_json(F.struct("_source", "_size", "_id"))), ["_key"], "mix-alike")
        found = found.unionByName(some.withColumn("_more", (F.col("_rank") < F.col("_cut_rows")).cast("long")).select(*found.columns))
    copies = F.col("passes") + F.col("_more")
    return found.withColumn("_copies", F.when(F.col("_size") == 0, F.least(copies, F.lit(1))).otherwise(copies)).drop("passes", "_more")


def _keys(doc_id: str, text: str, source: str, seed: int) -> list[Column]:
    hashed = F.xxhash64(F.col(f"`{doc_id}`").cast("string"), F.lit(seed))
    return [F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{source}`").cast("string").alias("_source"), word_count(F.col(f"`{text}`")).alias("_size"), hashed.alias("_h")]


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix holds the document) and taken (its words)."""
    sizes = cut(docs.select(*_keys(doc_id, text, source, seed)), "mix-sizes")
    found = _with_copies(sizes, sizes, weights, share, most)
    return found.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).alias("taken"))


def take_mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix holds them, with all their columns."""
    keys = _keys(doc_id, text, source, seed)
    sizes = cut(docs.select(*keys), "mix-sizes")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *keys)
    found = _with_copies(rows, sizes, weights, share, most).where("_copies > 0")
    return found.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))).select("_row.*")
