"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its word n-grams. Sets are dealt into bands of sizes; two sets whose Jaccard similarity reaches the
threshold and whose larger size lies in a band differ in at most k elements, k following from the band's upper size. The
feature domain is cut into k + 1 + s partitions, so the two agree in at least 1 + s of them; a signature is a hash of a set's
elements in one partition. Every set enumerates the signatures of its own band and of each larger band that a similar set may be in.

Signatures are ordered by how many sets share them. Of the 1 + s signatures that a pair has in common at least one is left when
either side leaves out its s most frequent ones, so every set keeps its k + 1 rarest. What still is shared by more than
``FREQUENT`` sets leads to a second, finer partitioning among the sets that have it, and only among those: elements that only one
of them has can't be matched, are left out, and are taken from its k, and again only the rarest signatures are kept. No link is lost.

Equal sets are one class from the start. Candidates of a signature are first its sets with its smallest one; what that links is
one component, and only pairs of sets in different components follow, since a link inside a component adds nothing.
Candidates are kept if the parities of their elements' counts in 512 buckets differ in no more places than the pair may differ in
elements (a lower bound of the difference), then their sets are compared exactly.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; a text with fewer words than n has
its whole sequence as one element; rows of one id count as one document, linked with itself; a row with a null id is not linked
and its component is null; an empty table gives no rows; other columns are kept by ``drop_near_duplicates``, whatever their names, and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard, small_batches, small_enough
from .components import components

WORDS, SIMILARITY = 5, (80, 100)
#: Upper sizes of neighbouring bands.
BAND_RATIO = 1.4
#: Sets that may share a signature before they are partitioned anew.
FREQUENT = 16
SKETCH = 8  # longs

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
LOW = np.uint64(0xFFFFFFFF)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ np.uint64(salt)) * ODD[0]
    x = (x ^ x >> np.uint64(32)) * ODD[1]
    return x ^ x >> np.uint64(29)


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words, A-Z in lower case."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    m = min(n, len(w))
    h = np.zeros(len(w) - m + 1, np.uint64)
    for i in range(m):
        h = mixed(h + w[i : len(w) - m + 1 + i], i + 1)
    return np.unique(h) if m == n else mixed(h, 1000 + m)


def parts_for(k: int, fine: bool) -> int:
    return 4 * (k + 1) if fine else k + 1 + max(1, k // 5)


class Bands:
    """Bands of set sizes for a similarity of top / bottom, and what each asks for."""

    def __init__(self, similarity: tuple[int, int]) -> None:
        self.top, self.bottom = similarity
        self.upper = [1]

    def reach(self, size: int) -> None:
        while self.upper[-1] < size:
            self.upper.append(max(self.upper[-1] + 1, int(self.upper[-1] * BAND_RATIO)))

    def of(self, size: int, fine: bool = False) -> list[tuple[int, int, int]]:
        """(band, partitions, slack) of each band in which a set of ``size`` may meet a similar one at least as large, or is the largest."""
        most = size * self.bottom // self.top  # the largest similar set
        self.reach(most)
        out = []
        for b in range(int(np.searchsorted(self.upper, size)), int(np.searchsorted(self.upper, most)) + 1):
            k = 2 * self.upper[b] * (self.bottom - self.top) // (self.bottom + self.top)
            if k:  # else only equal sets are similar, and they are one class
                slack = parts_for(k, fine) - k - 1
                out.append((b, k + 1 + slack, slack))
        return out


def signatures(h: np.ndarray, band: int, parts: int) -> np.ndarray:
    """A hash of the set's elements in each of ``parts`` partitions of the domain."""
    part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    m = mixed(h, 77)
    low = np.bincount(part, (m & LOW).astype(np.float64), parts).astype(np.uint64)
    high = np.bincount(part, (m >> np.uint64(32)).astype(np.float64), parts).astype(np.uint64)
    return mixed(low + (high << np.uint64(32)), 0) + mixed(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32), 99)


def sketch(h: np.ndarray) -> np.ndarray:
    odd = np.bincount((h & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """id and the sorted element hashes, for the rows given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                found = [shingles(t, n) for t in b.column(1).cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]
                ends = np.cumsum([0, *map(len, found)])
                values = pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["id", "elements"])

    return small_batches(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))).mapInArrow(run, "id long, elements array<long>")


def describe(docs: DataFrame, doc_id: str, text: str, n: int, similarity: tuple[int, int]) -> DataFrame:
    """id, set size, set hash (f1, f2), sketch and the signatures of each row, by band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(similarity)
        kind = pa.list_(pa.struct([("band", pa.int32()), ("slack", pa.int32()), ("sigs", pa.list_(pa.int64()))]))
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                sizes, f1, f2, sketches, groups = [], [], [], [], []
                for t in b.column(1).cast(pa.large_string()).cast(pa.large_binary()).to_pylist():
                    h = shingles(t, n)
                    sizes.append(len(h))
                    f1.append(int(mixed(h, 11).sum(dtype=np.uint64).view(np.int64)))
                    f2.append(int(mixed(h, 13).sum(dtype=np.uint64).view(np.int64)))
                    sketches.append(sketch(h))
                    groups.append([{"band": band, "slack": slack, "sigs": signatures(h, band, parts).view(np.int64)} for band, parts, slack in bands.of(len(h))] if len(h) else [])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(groups, kind)], names=["id", "n", "f1", "f2", "sketch", "groups"])

    return small_batches(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))).mapInArrow(run, "id long, n int, f1 long, f2 long, sketch array<long>, groups array<struct<band:int,slack:int,sigs:array<long>>>")


def _rarest(flat: DataFrame, tag: str) -> DataFrame:
    """Rows of signatures that several sets have (with their number, size), without each set's ``slack`` most frequent ones."""
    groups = cut(flat.groupBy("sig").agg(F.count("*").alias("size")).where("size > 1"), f"jaccard-{tag}-groups")
    order = Window.partitionBy("id", "band").orderBy(F.desc("size"), F.desc("sig"))
    return cut(flat.join(groups, "sig").withColumn("_rank", F.row_number().over(order)).where("_rank > slack").drop("_rank"), f"jaccard-{tag}")


def _fine_signatures(docs: DataFrame, heavy: DataFrame, doc_id: str, text: str, n: int, similarity: tuple[int, int]) -> DataFrame:
    """Signatures of the finer partitioning, for the (id, band) in ``heavy``: id, own (elements no other one has), band, slack, sig."""
    wanted = cut(heavy.groupBy("id").agg(F.collect_set("band").alias("bands")), "jaccard-heavy")  # a few bands each
    chosen = docs.join(small_enough(wanted.select(F.col("id").alias("_id"))), F.col(doc_id).cast("long") == F.col("_id"), "left_semi")
    # rows of one id may have different sets: each is kept, told apart by its hashes
    keyed = _sets(chosen, doc_id, text, n).withColumn("f1", F.xxhash64("elements")).withColumn("f2", F.xxhash64(F.lit(1), "elements"))
    sets = cut(keyed.dropDuplicates(["id", "f1", "f2"]), "jaccard-heavy-sets")
    alone = sets.select(F.struct("id", "f1", "f2").alias("of"), F.explode("elements").alias("e")).groupBy("e").agg(F.count("*").alias("c"), F.min("of").alias("of")).where("c = 1")
    alone = alone.groupBy("of.id", "of.f1", "of.f2").agg(F.collect_list("e").alias("alone"))
    ready = sets.join(wanted, "id").join(alone, ["id", "f1", "f2"], "left").select("id", F.size("elements").alias("n"), F.coalesce(F.size("alone"), F.lit(0)).alias("own"), "bands", F.expr("if(alone IS NULL, elements, array_except(elements, alone))").alias("elements"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Bands(similarity)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                out: list[list] = [[], [], [], [], [], []]
                for i, size, own, bands, elements in zip(*[c.to_pylist() for c in b.columns[:4]], b.column(4)):
                    h = elements.values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for band, parts, slack in levels.of(size, fine=True):
                        if band in bands and own <= parts - slack - 1:
                            for column, value in zip(out, (i, size, own, band, slack + own, (signatures(h, band, parts) ^ np.uint64(1)).view(np.int64))):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int64())))], names=["id", "n", "own", "band", "slack", "sigs"])

    found = cut(small_batches(ready).mapInArrow(run, "id long, n int, own int, band int, slack int, sigs array<long>"), "jaccard-fine-sets")
    return found.select("id", "own", "band", "slack", F.explode("sigs").alias("sig"))


def _may_differ(similarity: tuple[int, int]) -> str:
    top, bottom = similarity
    return f"(a_n + b_n) * {bottom - top} div {bottom + top}"


def _near(similarity: tuple[int, int]) -> str:
    """What the sizes and sketches of a linked pair fulfil."""
    top, bottom = similarity
    differ = " + ".join(f"bit_count(a_sketch[{i}] ^ b_sketch[{i}])" for i in range(SKETCH))
    return f"a_n * {top} <= b_n * {bottom} AND b_n * {top} <= a_n * {bottom} AND {differ} <= {_may_differ(similarity)}"


def _verified(near: DataFrame, docs: DataFrame, doc_id: str, text: str, n: int, similarity: tuple[int, int]) -> DataFrame:
    """The linked ones among the candidate pairs a, b."""
    top, bottom = similarity
    ids = cut(near.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "jaccard-ids")
    sets = cut(_sets(docs.join(small_enough(ids), F.col(doc_id).cast("long") == F.col("_id"), "left_semi"), doc_id, text, n), "jaccard-sets")
    one = sets.select(F.col("id").alias("a"), F.col("elements").alias("a_e"))
    two = sets.select(F.col("id").alias("b"), F.col("elements").alias("b_e"))
    same = F.size(F.array_intersect("a_e", "b_e"))
    linked = near.join(one, "a").join(two, "b").where(same * (top + bottom) >= (F.size("a_e") + F.size("b_e")) * top)
    links = cut(linked.select("a", "b").distinct(), "jaccard-links")
    discard(ids, sets)
    return links


def join_components(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of each row."""
    docs = docs.select(doc_id, text)
    described = cut(describe(docs, doc_id, text, words, similarity), "jaccard-described")
    rows = cut(described.select("id", "n", "f1", "f2"), "jaccard-rows")
    classes = cut(rows.where("n > 0 AND id IS NOT NULL").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "jaccard-classes")
    chosen = described.where("n > 0").join(classes.select(F.col("rep").alias("id"), "n", "f1", "f2"), ["id", "n", "f1", "f2"], "left_semi")
    chosen = cut(chosen.dropDuplicates(["id", "n", "f1", "f2"]), "jaccard-chosen")
    discard(described)
    facts = cut(chosen.select("id", "n", "sketch"), "jaccard-facts")
    flat = chosen.select("id", F.explode("groups").alias("g")).select("id", F.col("g.band").alias("band"), F.col("g.slack").alias("slack"), F.explode("g.sigs").alias("sig"))
    coarse = _rarest(flat.withColumn("own", F.lit(0)), "coarse")
    discard(chosen)
    heavy = coarse.where(F.col("size") > FREQUENT).select("id", "band").distinct()
    fine = _rarest(_fine_signatures(docs, heavy, doc_id, text, words, similarity), "fine")
    kept = cut(coarse.where(F.col("size") <= FREQUENT).select("sig", "id", "own").unionByName(fine.select("sig", "id", "own")), "jaccard-kept")
    pivots = kept.groupBy("sig").agg(F.min("id").alias("pivot"))
    one, two = (facts.select(*[F.col(c).alias(f"{p}_{c}") for c in ("id", "n", "sketch")]).withColumnRenamed(f"{p}_id", p) for p in "ab")
    first = kept.join(pivots, "sig").where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    first = cut(first.join(one, "a").join(two, "b").where(_near(similarity)).select("a", "b"), "jaccard-first")
    links = _verified(first, docs, doc_id, text, words, similarity)
    label = components(links)
    now = kept.join(label, "id", "left").select("sig", "id", "own", F.coalesce("label", "id").alias("label"))
    mixed_groups = now.groupBy("sig").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low <> _high").select("sig")
    now = now.join(mixed_groups, "sig", "left_semi").join(facts.select("id", "n", "sketch"), "id")
    now = cut(now, "jaccard-open")
    x, y = (now.select("sig", *[F.col(c).alias(f"{p}_{c}") for c in ("id", "n", "own", "label", "sketch")]) for p in "ab")
    alone = f"a_own + b_own + abs((a_n - a_own) - (b_n - b_own)) <= {_may_differ(similarity)}"
    rest = x.join(y, "sig").where(f"a_id < b_id AND a_label <> b_label AND {alone} AND {_near(similarity)}")
    rest = rest.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    links = links.unionByName(_verified(cut(rest, "jaccard-rest"), docs, doc_id, text, words, similarity))
    label = cut(components(links), "jaccard-labels")
    by_class = cut(classes.join(label, classes["rep"] == label["id"], "left").select("n", "f1", "f2", F.coalesce("label", "rep").alias("component_id")), "jaccard-result")
    discard(classes, facts, coarse, fine, kept, first, now)
    # rows of one id with different texts: the smallest of their classes
    out = rows.select("id", "n", "f1", "f2").join(by_class, ["n", "f1", "f2"], "left")
    return out.select(F.col("id").alias(doc_id), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component (the one with its smallest id), and the rows without an id; all columns."""
    found = cut(join_components(docs, words, similarity, doc_id, text).where(F.col(doc_id).isNotNull()), "jaccard-found")
    gone = cut(found.where(F.col(doc_id) != F.col("component_id")).select(F.col(doc_id).alias("_gone")).distinct(), "jaccard-gone")
    gone = small_enough(gone)
    kept = docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
    if found.count() == found.select(doc_id).distinct().count():
        return kept
    return kept.where(docs[doc_id].isNotNull()).dropDuplicates([doc_id]).unionByName(kept.where(docs[doc_id].isNull()))
