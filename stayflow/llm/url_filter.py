"""URL filter: a memory-mapped sorted array of 64-bit xxhash digests, probed by vectorised binary search.

``write_index`` stores the rules as one file: sorted digests, the full rule strings and their actions. The file goes to
the executors with ``SparkContext.addFile``; a lost executor's replacement fetches it anew. Each task maps it, forms the
candidate keys of its urls (every host suffix of as many labels as rules have with every path prefix of a length that some rule has), looks all of
them up with one ``searchsorted`` call, and confirms each hit against the stored string, so that equal digests of
different strings never match. A rule set over ``max_rules`` is joined by digest in Spark in place of being mapped, with equal results.

Defined cases: a null url or one without ``://`` has an empty host and path and matches no rule; among the rules that
fit, the longest string wins, then the longer host; a url that no rule fits gets ``default``; repeated rules with the
same string keep the alphabetically last action ("block" over "allow"); repeated urls are judged alike; an empty table on either side
gives no rows or the default; other columns are not read.
"""

from __future__ import annotations

import atexit
import os
import shutil
import struct
import tempfile
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spark's xxhash64() takes this seed.
SEED = 42
#: Rules up to which the index is a file on each executor (about 60 bytes a rule).
MAX_RULES = 20_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Index(NamedTuple):
    digests: np.ndarray
    offsets: np.ndarray
    actions: np.ndarray
    strings: np.ndarray
    path_lengths: list[int]
    #: Labels of a rule's host at most, and characters of a rule.
    labels: int
    longest: int

    def find(self, keys: list[str]) -> np.ndarray:
        """The rule number of each key, -1 where no rule is that very string."""
        found = np.full(len(keys), -1, np.int64)
        if not keys or not len(self.digests):
            return found
        wanted = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in keys), np.uint64, len(keys))
        left = np.searchsorted(self.digests, wanted, "left")
        inside = np.flatnonzero(left < len(self.digests))
        for i in inside[self.digests[left[inside]] == wanted[inside]]:
            at = int(left[i])
            while at < len(self.digests) and self.digests[at] == wanted[i]:
                if self.text(at) == keys[i]:
                    found[i] = at
                    break
                at += 1
        return found

    def text(self, at: int) -> str:
        return self.strings[int(self.offsets[at]) : int(self.offsets[at + 1])].tobytes().decode()


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def clean_rules(rules: DataFrame) -> DataFrame:
    """One row for each rule string: rule, action, host_length, path_length, digest."""
    host, path = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER), F.coalesce("path", F.lit(""))
    return (
        rules.select(F.concat(host, path).alias("rule"), F.col("action").cast("string").alias("action"), F.length(host).alias("host_length"), F.length(path).alias("path_length"))
        .where("host_length > 0 AND action IN ('allow', 'block')")
        .groupBy("rule", "host_length", "path_length")
        .agg(F.max("action").alias("action"))
        .withColumn("digest", F.xxhash64("rule"))
    )


def write_index(rules: DataFrame, path: str) -> None:
    """Stream the cleaned rules, in the digests' unsigned order, into one file."""
    n, size, labels, longest = 0, 0, 0, 0
    lengths: set[int] = set()
    parts = {k: open(f"{path}.{k}", "w+b") for k in ("digests", "offsets", "actions", "strings")}
    parts["offsets"].write(struct.pack("<Q", 0))
    ordered = rules.orderBy(F.col("digest").bitwiseXOR(F.lit(-(2**63)).cast("long")), "rule")
    for row in ordered.toLocalIterator():
        text = row["rule"].encode()
        size += len(text)
        parts["digests"].write(struct.pack("<q", row["digest"]))
        parts["offsets"].write(struct.pack("<Q", size))
        parts["actions"].write(b"\1" if row["action"] == "block" else b"\0")
        parts["strings"].write(text)
        lengths.add(row["path_length"])
        labels, longest = max(labels, row["rule"][: row["host_length"]].count(".") + 1), max(longest, len(row["rule"]))
        n += 1
    with open(path, "wb") as out:
        out.write(struct.pack("<QQQQ", n, len(lengths), labels, longest))
        out.write(np.array(sorted(lengths), "<u8").tobytes())
        for f in parts.values():
            f.seek(0)
            while block := f.read(1 << 20):
                out.write(block)
            f.close()
            os.remove(f.name)


def open_index(path: str) -> Index:
    with open(path, "rb") as f:
        n, m, labels, longest = struct.unpack("<QQQQ", f.read(32))
    at, out = 32, []
    for kind, count in (("<u8", m), ("<u8", n), ("<u8", n + 1), ("u1", n)):
        out.append(np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind))
        at += count * np.dtype(kind).itemsize
    rest = os.path.getsize(path) - at
    strings = np.memmap(path, "u1", "r", at, (rest,)) if rest else np.zeros(0, "u1")
    return Index(out[1], out[2], out[3], strings, [int(x) for x in out[0]], labels, longest)


def suffixes(host: str, most: int) -> list[str]:
    """The host and each domain above it of at most ``most`` labels, shortest first."""
    parts = host.rsplit(".", most)[-most:] if most else []
    return [".".join(parts[i:]) for i in range(len(parts) - 1, -1, -1)]


def match_urls(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", max_rules: int = MAX_RULES) -> DataFrame:
    """``key``, host, path, rule (null if none fits) and verdict of each row of ``urls``.

    rules: columns host, path and action (allow or block).
    """
    spark = urls.sparkSession
    rules = clean_rules(rules)
    pages = urls.select(F.col(key).alias(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if rules.limit(max_rules + 1).count() > max_rules:
        return _match_by_join(pages, rules, key, default)
    name = f"url-rules-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="stayflow-")  # the driver's own; executors fetch the file from it while the application runs
    atexit.register(shutil.rmtree, folder, True)
    file = os.path.join(folder, name)
    write_index(rules, file)
    spark.sparkContext.addFile(file)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = open_index(SparkFiles.get(name))
        for b in batches:
            host, path = b.column(1).to_pylist(), b.column(2).to_pylist()
            keys, rows = [], []
            for i, (h, p) in enumerate(zip(host, path)):
                for s in suffixes(h, index.labels) if h else ():
                    for n in index.path_lengths:
                        if n <= len(p) and len(s) + n <= index.longest:
                            keys.append(s + p[:n])
                            rows.append((i, len(s) + n, len(s)))
            best: dict[int, tuple[int, int, int]] = {}
            found = index.find(keys)
            for k in np.flatnonzero(found >= 0):
                i, total, of_host = rows[k]
                best[i] = max(best.get(i, (0, 0, 0)), (total, of_host, int(found[k])))
            rule = [index.text(best[i][2]) if i in best else None for i in range(len(host))]
            verdict = [("block" if index.actions[best[i][2]] else "allow") if i in best else default for i in range(len(host))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[key, "host", "path", "rule", "verdict"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.mapInArrow(probe, f"`{key}` {kind}, host string, path string, rule string, verdict string")


def _match_by_join(pages: DataFrame, rules: DataFrame, key: str, default: str) -> DataFrame:
    """For rule sets too large for one file: candidate keys meet the rules in an equi-join on digest and string.

    Distinct (host, path) pairs are probed once, so that a host with a third of all rows is not a hot key.
    """
    labels_of = F.size(F.split(F.substring("rule", F.lit(1), F.col("host_length")), r"\."))
    lengths = F.broadcast(rules.groupBy().agg(F.collect_set("path_length").alias("_lengths"), F.max(labels_of).alias("_most")))  # one row; lengths are few
    kinds = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - F.col("_most") + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = (
        kinds.where("host <> ''")
        .join(lengths)
        .select("host", "path", F.explode(hosts).alias("_s"), "_lengths")
        .select("host", "path", "_s", F.explode("_lengths").alias("_n"))
        .where("_n <= length(path)")
        .select("host", "path", F.concat("_s", F.expr("substring(path, 1, _n)")).alias("rule"))
        .withColumn("digest", F.xxhash64("rule"))
    )
    best = probes.join(rules, ["digest", "rule"]).groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), "host_length", "rule", "action")).alias("_best"))
    return pages.join(best, ["host", "path"], "left").select(key, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict"))
