"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

Suffixes (starts of ``LENGTH``-byte windows) are sorted only through their first ``LENGTH`` bytes, by passes that each look at the next
digit, most significant first; a suffix alone under its digits so far is done and goes no further; groups that are equal in the last
pass are exactly the repeated windows. Passes and their digits:

1. the window's anchor: its least hashed ``GRAM``-byte string, the first of equals. Neighbouring starts share an anchor, so a run of
   starts is one row (some 85 bytes of text a row); most anchors occur once, and their runs are done.
2. to 4. ``DIGITS`` successive digits of the bytes that the windows of a block share: ``STEP`` neighbouring starts at one distance from the anchor.
5. the windows of the blocks that are still not alone, each by all its bytes.

Before pass 2 and after pass 4 equal stretches (all bytes of a run's or a block's windows) are settled at once, however many there
are, and one of each goes on; so only texts that share an anchor and differ around it (next to an edit) reach the later passes.

Every pass counts by a hash in Spark (partial counts first, so that a passage in a third of all documents is one row a task), and
joins the counts back. Digits are hashed to 64 bits each, and windows are equal if their anchors and their own or their stretches' hashes are: 128
bits, at which n windows give a false match with a chance under n^2 / 2^129.

Defined cases: a null text is an empty one; texts under ``LENGTH`` bytes have no window and keep all; a text that repeats itself loses
those bytes too; rows with equal texts (repeated rows included) lose all; an empty table gives no rows; other columns are not read. A row's key
is its id and a hash of its text, so ids need not be unique, and a row that is there many times is looked at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, small_batches

LENGTH, GRAM, STEP, DIGITS = 200, 32, 16, 3
#: Starts that are looked at together; longer texts go in pieces that overlap by a window.
PIECE = 1 << 20
PLACE = np.uint64(PIECE * 2 - 1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE + LENGTH + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_CACHE: dict[str, np.ndarray] = {}


def powers(which: str) -> np.ndarray:
    if which not in _CACHE:
        _CACHE[which] = _powers(BASE if which == "up" else INVERSE)
    return _CACHE[which]


def rolling(raw: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit hash of the ``width`` bytes from each position on, from sums over prefixes."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(TABLE[raw] * powers("up")[:n], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * powers("down")[: n - width + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours: running minima of blocks from the left and from the right."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def runs_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, anchor hash and anchor place of each run of window starts of a piece that share their anchor."""
    h = rolling(raw, GRAM)
    place = np.arange(len(h), dtype=np.uint64)
    least = sliding_minimum(h & ~PLACE | place, LENGTH - GRAM + 1)
    first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    at = (least[first] & PLACE).astype(np.int64)
    return first, np.diff(np.append(first, len(least))), h[at], at


def pieces(raw: bytes) -> Iterator[tuple[int, np.ndarray]]:
    a = np.frombuffer(raw, np.uint8)
    for at in range(0, max(0, len(a) - LENGTH + 1), PIECE):
        yield at, a[at : at + PIECE + LENGTH - 1]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The last column of each slice of rows, as bytes."""
    for whole in batches:
        for at in range(0, whole.num_rows, 100):
            b = whole.slice(at, 100)
            yield b, [t or b"" for t in b.column(b.num_columns - 1).cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def _runs(texts: DataFrame) -> DataFrame:
    """id, t, start, n, off (from the start to the anchor), anchor and stretch (hash of the bytes that the run's windows cover) of all runs; texts: id, t, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raws in _texts(batches):
            rows, starts, counts, offs, anchors, stretches = [], [], [], [], [], []
            for row, raw in enumerate(raws):
                view = memoryview(raw)
                for at, a in pieces(raw):
                    first, n, anchor, place = runs_of(a)
                    offs.append(place - first)
                    first += at
                    rows.append(np.full(len(first), row))
                    starts.append(first)
                    counts.append(n)
                    anchors.append(anchor.view(np.int64))
                    stretches.append(np.fromiter((xxhash.xxh3_64_intdigest(view[s:t]) for s, t in zip(first.tolist(), (first + n + LENGTH - 1).tolist())), np.uint64, len(first)).view(np.int64))
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(counts).astype(np.int32)), pa.array(np.concatenate(offs).astype(np.int32)), pa.array(np.concatenate(anchors)), pa.array(np.concatenate(stretches))], names=["id", "t", "start", "n", "off", "anchor", "stretch"])

    return small_batches(texts).mapInArrow(run, "id long, t long, start int, n int, off int, anchor long, stretch long")


def _blocks(texts: DataFrame) -> DataFrame:
    """id, t, start, n, anchor, the digits d0, d1, ... and stretch of the blocks of the runs wanted; texts: id, t, runs (start, n, off, anchor), text."""
    names = [f"d{i}" for i in range(DIGITS)]
    cuts = [(LENGTH - STEP + 1) * i // DIGITS for i in range(DIGITS + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raws in _texts(batches):
            rows, starts, counts, anchors, digits, stretches = [], [], [], [], [[] for _ in names], []
            for row, (runs, raw) in enumerate(zip(b.column(2).to_pylist(), raws)):
                view = memoryview(raw)
                for r in runs:
                    anchor, start, stop = r["start"] + r["off"], r["start"], r["start"] + r["n"]
                    for k in range((anchor - stop + 1) // STEP, (anchor - start) // STEP + 1):
                        high = anchor - STEP * k  # the block's starts end here, at a full block
                        low = max(start, high - STEP + 1)
                        n = min(stop, high + 1) - low
                        rows.append(row)
                        starts.append(low)
                        counts.append(n)
                        anchors.append(r["anchor"])
                        for column, i, j in zip(digits, cuts, cuts[1:]):
                            column.append(xxhash.xxh3_64_intdigest(view[high + i : high + j], k))
                        stretches.append(xxhash.xxh3_64_intdigest(view[low : low + n - 1 + LENGTH], (anchor - low) * STEP + n))
            if rows:
                at = pa.array(rows, pa.int64())
                longs = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (*digits, stretches)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(starts, pa.int32()), pa.array(counts, pa.int32()), pa.array(anchors, pa.int64()), *longs], names=["id", "t", "start", "n", "anchor", *names, "stretch"])

    return small_batches(texts).mapInArrow(run, f"id long, t long, start int, n int, anchor long, {', '.join(f'{c} long' for c in names)}, stretch long")


def _windows(texts: DataFrame) -> DataFrame:
    """id, t, anchor, start and the hash of every window of the runs wanted; texts: id, t, runs (start, n, anchor), text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raws in _texts(batches):
            rows, anchors, starts, hashes = [], [], [], []
            for row, (runs, raw) in enumerate(zip(b.column(2).to_pylist(), raws)):
                view = memoryview(raw)
                for r in runs:
                    s, n = r["start"], r["n"]
                    rows.append(row)
                    anchors.append(r["anchor"])
                    starts.append(s)
                    hashes.append(np.fromiter((xxhash.xxh3_64_intdigest(view[i : i + LENGTH]) for i in range(s, s + n)), np.uint64, n).view(np.int64))
            if rows:
                at = pa.array(rows, pa.int64())
                ends = np.cumsum([0, *map(len, hashes)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(hashes)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(anchors, pa.int64()), pa.array(starts, pa.int32()), lists], names=["id", "t", "anchor", "start", "hashes"])

    return small_batches(texts).mapInArrow(run, "id long, t long, anchor long, start int, hashes array<long>")


def _survivors(rows: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """A radix pass: the rows that are not alone under ``keys``, the digits so far."""
    shared = cut(rows.groupBy(*keys).agg(F.count("*").alias("_c")).where("_c > 1").select(*keys), f"suffix-{tag}-shared")
    left = cut(rows.join(shared, keys, "left_semi"), f"suffix-{tag}")
    discard(rows, shared)
    return left


def _equal_stretches(rows: DataFrame, keys: list[str], more: list[str], tag: str) -> tuple[DataFrame, DataFrame]:
    """Of rows (id, t, start, n, stretch and ``more``): the spans of those whose stretch repeats under ``keys``; and one
    row of each different stretch (c: how many have it) where a key has several."""
    equal = cut(rows.groupBy(*keys, "stretch").agg(F.count("*").alias("c"), F.min(F.struct("id", "t", "start", "n", *more)).alias("one")), f"suffix-{tag}-equal")
    several = cut(equal.groupBy(*keys).agg(F.count("*").alias("_kinds")).where("_kinds > 1").select(*keys), f"suffix-{tag}-several")
    kinds = cut(equal.join(several, keys, "left_semi"), f"suffix-{tag}-kinds")
    many = cut(equal.where("c > 1").select(*keys, "stretch"), f"suffix-{tag}-many")
    whole = rows.join(many, [*keys, "stretch"], "left_semi").select("id", "t", "start", (F.col("start") + F.col("n") + (LENGTH - 1)).alias("end"))
    whole = cut(whole, f"suffix-{tag}-whole")
    discard(rows, equal, several, many)
    return whole, kinds


def _wanted(texts: DataFrame, kinds: DataFrame, fields: list[str]) -> DataFrame:
    """The texts of ``kinds`` with what is wanted of them: id, t, runs, text. A text comes once, however often its row is there."""
    runs = F.struct(*[F.col(f"one.{c}").alias(c) for c in fields if c != "anchor"], "anchor")
    runs = cut(kinds.groupBy("one.id", "one.t").agg(F.collect_list(runs).alias("runs")), "suffix-wanted")  # one text's runs
    wanted = texts.join(runs.select("id", "t"), ["id", "t"], "left_semi")
    once = wanted.groupBy("id", "t").agg(F.first("text").alias("text"))
    return once.join(runs, ["id", "t"]).select("id", "t", "runs", "text")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """id, t and spans (start, end) covered by repeated windows, sorted by start but not merged, of texts with any; texts: id, t, text."""
    texts = texts.where(F.octet_length("text") >= LENGTH)
    runs = _survivors(cut(_runs(texts), "suffix-all"), ["anchor"], "runs")
    whole, kinds = _equal_stretches(runs, ["anchor"], ["off"], "run")
    blocks, keys = cut(_blocks(_wanted(texts, kinds, ["start", "n", "off", "anchor"])), "suffix-blocks"), ["anchor"]
    discard(kinds)
    for i in range(DIGITS):
        keys.append(f"d{i}")
        blocks = _survivors(blocks, keys, f"digit{i}")
    some, kinds = _equal_stretches(blocks, keys, [], "block")
    windows = _windows(_wanted(texts, kinds, ["start", "n", "anchor"])).withColumn("row", F.monotonically_increasing_id())
    windows = cut(windows, "suffix-windows")
    # a window that several different blocks have is repeated; one block of each kind is here
    flat = windows.select("anchor", F.explode("hashes").alias("h"))
    again = cut(flat.groupBy("anchor", "h").agg(F.count("*").alias("w")).where("w > 1").select("anchor", "h"), "suffix-again")
    single = kinds.where("c = 1").select("one.id", "one.t", "one.start")
    lone = cut(windows.join(single, ["id", "t", "start"], "left_semi"), "suffix-lone")
    found = lone.select("row", "anchor", F.posexplode("hashes").alias("at", "h")).join(again, ["anchor", "h"], "left_semi")
    found = found.groupBy("row").agg(F.sort_array(F.collect_list("at")).alias("at"))  # one block's starts
    found = found.join(lone.select("row", "id", "t", F.col("start").alias("run")), "row")
    firsts = "filter(transform(at, (x, i) -> if(i = 0 OR x - at[i - 1] > 1, x, NULL)), x -> x IS NOT NULL)"
    lasts = "filter(transform(at, (x, i) -> if(i = size(at) - 1 OR at[i + 1] - x > 1, x, NULL)), x -> x IS NOT NULL)"
    parts = found.select("id", "t", "run", F.explode(F.expr(f"zip_with({firsts}, {lasts}, (a, b) -> struct(a, b))")).alias("p"))
    parts = parts.select("id", "t", (F.col("run") + F.col("p.a")).cast("int").alias("start"), (F.col("run") + F.col("p.b") + LENGTH).cast("int").alias("end"))
    spans = whole.unionByName(some).unionByName(parts)
    # one text's spans, each once: a row that is there many times has them as often
    return spans.groupBy("id", "t").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (bytes) of each row."""
    text_ = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(text_).alias("t"), text_.alias("text"))
    spans = cut(repeated_spans(texts), "suffix-spans")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(text_).alias("t"), text_.alias("text"))
    joined = rows.join(spans, ["id", "t"], "left").select("doc", "spans", "text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raws in _texts(batches):
            out: list[list] = [[], [], [], [], []]
            for spans, raw in zip(b.column(1).to_pylist(), raws):
                merged: list[list[int]] = []
                for s in spans or ():
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                kept, at = hashlib.sha256(), 0
                for s, e in merged:
                    kept.update(raw[at:s])
                    at = e
                kept.update(raw[at:])
                for column, value in zip(out, (len(raw), sum(e - s for s, e in merged), len(merged), kept.hexdigest(), [{"start": s, "end": e} for s, e in merged])):
                    column.append(value)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    judged = small_batches(joined).mapInArrow(judge, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>")
    return judged.withColumnRenamed("doc", doc_id)
