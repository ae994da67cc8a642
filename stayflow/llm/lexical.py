"""Ranked lexical search by presence masks: the best documents of each item under a tf-idf score of 64-bit integers.

1. Documents are read once for each block of items (`BLOCK_BYTES` of terms, broadcast): every document leaves its length and its
   counts of the block's terms (`postings`, written).
2. Document frequencies are summed over the postings; lengths give the number of documents and terms.
3. Each task goes through its postings in blocks of documents. For an item, bitmaps of its terms' documents are turned into a mask
   of matched terms for each document, and documents are grouped by mask. A mask's highest possible score comes from each term's
   highest contribution in the block; masks are evaluated from the highest down, until the item's best so far in the task beat
   all that is left. Bounds equal to the last of the best are evaluated too, so ties go by id.
4. The tasks' best rows are ranked for each item, at most ``top`` from a task.

Defined cases: a null or empty text has no terms and is not counted among the documents; an item without terms, or whose terms are in no
document, has no rows; rows of one item id are one item with the terms of all; rows of one document id are documents of their
own; a null document id comes after all others; other columns of any name are left out; empty tables give no rows. Texts are read as
bytes, so invalid UTF-8 does no harm. Sums pass 64 bits only for a document of n terms among N with 90 * n * N over 2^63.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, small_batches

#: Bytes of items and their terms in one broadcast block.
BLOCK_BYTES = 8 * 2**20
#: Documents of one round of grouping, and its cells (terms of an item times documents) at most.
ROUND, CELLS = 4096, 2**24
#: Documents that are evaluated together at least, so that small groups don't cost a step each.
STEP = 64

# Terms are runs of letters and digits of ASCII and of all other characters; the score's constants.
TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
IDF_SCALE, TF_SCALE, TF_STEP, LENGTH_WEIGHT, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 90


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms of a text in order, A-Z lower-cased."""
    return (text or b"").translate(TERM_BYTES).split()


def weight(documents: int, frequency: int) -> int:
    return math.floor(IDF_SCALE * math.log((2 * documents + 2) / (2 * frequency + 1)))


def contributions(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one occurrence count adds to a score, before the term's weight."""
    return (TF_SCALE * tf) // (TF_STEP * tf + LENGTH_WEIGHT * m)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """The distinct (item_id, term) of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, t) for i, x in enumerate(b.column(1).to_pylist()) for t in set(terms_of(x))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _ in found], pa.int64())), pa.array([t for _, t in found], pa.binary())], names=["item_id", "term"])

    kind = items.schema[item_id].dataType.simpleString()
    narrow = small_batches(items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("text")))
    return narrow.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """doc_id, n (all terms of the text), terms and tfs (packed numbers and counts of those in ``vocabulary``) of texts with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            at, n, terms, tfs = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                words = terms_of(t)
                if not words:
                    continue
                found = sorted((known[w], c) for w, c in Counter(words).items() if w in known)
                at.append(i)
                n.append(len(words))
                terms.append(np.array([x for x, _ in found], np.uint32).tobytes())
                tfs.append(np.array([c for _, c in found], np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], names=["doc_id", "n", "terms", "tfs"])

    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = small_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")))
    return narrow.mapInArrow(run, f"doc_id {kind}, n long, terms binary, tfs binary")


def frequencies(made: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the ``size`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for b in batches:
            held += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint32), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in made.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most a block's terms
        out[r["term"]] = r["df"]
    return out


def masks_of(presence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a bitmap of each term over the documents: the first document of each distinct mask of terms, and each document's mask number."""
    words = np.packbits(presence, axis=0)
    words = np.concatenate([words, np.zeros((-len(words) % 8, words.shape[1]), np.uint8)])
    group = np.zeros(words.shape[1], np.int64)
    for k in range(0, len(words), 8):
        _, part = np.unique(np.ascontiguousarray(words[k : k + 8].T).view(np.uint64).ravel(), return_inverse=True)
        _, group = np.unique(group * (int(part.max(initial=0)) + 1) + part, return_inverse=True)
    _, first = np.unique(group, return_index=True)
    return first, group


class Round:
    """The postings of some documents, by term."""

    def __init__(self, ids: list, lengths: np.ndarray, terms: list[bytes], tfs: list[bytes], weights: np.ndarray, documents: int, all_terms: int):
        counts = np.array([len(t) // 4 for t in terms], np.int64)
        doc = np.repeat(np.arange(len(ids)), counts)
        term, tf = np.frombuffer(b"".join(terms), np.uint32), np.frombuffer(b"".join(tfs), np.uint32).astype(np.int64)
        m = (100 - LENGTH_SHARE) + (LENGTH_SHARE * lengths * documents) // all_terms
        score = weights[term] * contributions(tf, m[doc])
        order = np.argsort(term, kind="stable")
        self.ids, self.doc, self.score = ids, doc[order], score[order]
        self.terms, at = np.unique(term[order], return_index=True)
        self.slices = [slice(a, b) for a, b in zip(at, [*at[1:], len(order)])]

    def best(self, terms: np.ndarray, top: int, found: list[tuple]) -> list[tuple]:
        """The ``top`` best (negative score, id is null, id) of ``found`` and of these documents for an item of these terms."""
        at = np.searchsorted(self.terms, terms)
        mine = [self.slices[a] for a, t in zip(at, terms) if a < len(self.terms) and self.terms[a] == t]
        if not mine:
            return found
        presence = np.zeros((len(mine), len(self.ids)), bool)
        for row, s in enumerate(mine):
            presence[row, self.doc[s]] = True
        first, group = masks_of(presence)
        highest = np.array([self.score[s].max() for s in mine], np.int64)
        bound = highest @ presence[:, first].astype(np.int64)
        order = np.argsort(-bound[group], kind="stable")  # documents, those of one mask together or among equal bounds
        bounds, at = bound[group][order], 0
        while at < len(order) and bounds[at] > 0 and (len(found) < top or bounds[at] >= -found[-1][0]):
            stop = max(int(np.searchsorted(-bounds, -bounds[at], "right")), min(at + STEP, len(order)))
            docs = np.sort(order[at:stop])
            total = np.zeros(len(docs), np.int64)
            for s in mine:
                here = self.doc[s]
                place = np.minimum(np.searchsorted(here, docs), len(here) - 1)
                total += np.where(here[place] == docs, self.score[s][place], 0)
            least = -found[-1][0] if len(found) == top else 1
            good = np.flatnonzero(total >= max(least, 1))
            new = [(-int(total[i]), self.ids[docs[i]] is None, self.ids[docs[i]]) for i in good]
            found = sorted(found + new, key=lambda x: x[:2] if x[1] else x)[:top]
            at = stop
        return found


def search(docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` documents of each item with a score above 0."""
    named = cut(item_terms(items, item_id, item_text), "lexical-items")
    size = named.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks, parts, totals = max(1, math.ceil(size / BLOCK_BYTES)), [], None
    for k in range(blocks):
        block = [(r[0], bytes(r[1])) for r in named.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()]
        vocabulary = {t: n for n, t in enumerate(sorted({t for _, t in block}))}
        made = cut(postings(docs, vocabulary, doc_id, text), "lexical-postings")
        totals = totals or made.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        parts.append(_block(made, block, vocabulary, frequencies(made, len(vocabulary)), totals, top, named.schema["item_id"].dataType))
    best = parts[0]
    for p in parts[1:]:
        best = best.unionByName(p)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score")


def _block(made: DataFrame, block: list[tuple], vocabulary: dict[bytes, int], df: np.ndarray, totals: tuple, top: int, kind: T.DataType) -> DataFrame:
    """item_id, doc_id, score of each task's best rows."""
    documents, all_terms = int(totals[0]), int(totals[1])
    weights = np.array([weight(documents, int(f)) for f in df], np.int64)
    wanted: dict = {}
    for item, term in block:
        wanted.setdefault(item, []).append(vocabulary[term])
    most = max(8, min(ROUND, CELLS // max([len(t) for t in wanted.values()], default=1)))
    shared = made.sparkSession.sparkContext.broadcast((weights, [(i, np.array(sorted(t), np.uint32)) for i, t in wanted.items()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted = shared.value
        found: list[list[tuple]] = [[] for _ in wanted]
        types: list = []

        def rounds() -> Iterator[list[tuple]]:
            rows: list[tuple] = []
            for b in batches:
                types[:] = [b.schema.field(0).type]
                rows += zip(*[c.to_pylist() for c in b.columns])
                while len(rows) >= most:
                    yield rows[:most]
                    rows = rows[most:]
            if rows:
                yield rows

        for rows in rounds():
            ids, n, terms, tfs = zip(*rows)
            part = Round(list(ids), np.array(n, np.int64), list(terms), list(tfs), weights, documents, all_terms)
            found = [part.best(t, top, f) for (_, t), f in zip(wanted, found)]
        out = [(i, f[2], -f[0]) for (i, _), fs in zip(wanted, found) for f in fs]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], to_arrow_type(kind)), pa.array([o[1] for o in out], types[0]), pa.array([o[2] for o in out], pa.int64())], names=["item_id", "doc_id", "score"])

    return small_batches(made).mapInArrow(run, f"item_id {kind.simpleString()}, doc_id {made.schema['doc_id'].dataType.simpleString()}, score long")
