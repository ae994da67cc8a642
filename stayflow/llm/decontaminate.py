"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared without case, white space and ASCII punctuation. An item of m bytes (a long item: each of its overlapping
windows) that lies in a document with at most e edits shares at least m + 1 - q * (e + 1) of its q-grams with it, on at most
e + 1 neighbouring diagonals (document position minus item position). The documents' q-grams are looked up in the
benchmark's; shared ones are counted in bands of 2 * (e + 1) diagonals that overlap by half, so every match lies inside one; bands
that reach the bound are verified by banded alignment with free ends in the document.

The benchmark is the query set: its index is broadcast in blocks of at most ``BLOCK_BYTES`` of text, one pass over the documents a
block; documents are never shuffled.

Every passage of an item of ``WINDOW`` + ``STEP`` - 1 compared bytes holds a whole window, so it is surely found if it has few edits; a
whole item of any length up to that is found too. Items under ``SHORTEST`` compared bytes are too short for edits: they match as whole words
that equal them, white space and punctuation aside.

Defined cases: null and empty texts match nothing, nor do items without a compared byte; an item with a null id matches under a null id;
repeated items are one; items that share an id are reported once; repeated documents each report; a document is reported once for each item, with its best region
(fewest edits, then first); matches never cross documents; long texts are searched in pieces, so a text of one repeated letter takes no
more memory than another; an empty table on either side gives no match; other columns are kept by ``drop_contaminated`` and not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches, small_enough

Q, EDIT_RATE, SHORTEST = 10, 0.08, 24
#: Compared bytes of a window, and the step from one to the next.
WINDOW, STEP = 100, 25
#: Bytes of items in one broadcast index, which takes some 50 times as many.
BLOCK_BYTES = 2_000_000
#: Documents whose texts are searched together.
ROWS, BYTES = 500, 1_000_000
#: Compared bytes of a longer text's pieces, and what they overlap by.
PIECE, OVERLAP = 125_000, 2 * WINDOW
#: Runs of shared q-grams that are looked at in one step.
POSTINGS = 250_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
KEPT = np.zeros(256, bool)
KEPT[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
BITS = 22


def compared(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8)
    return LOWER[a[KEPT[a]]]


def gram_keys(a: np.ndarray) -> np.ndarray:
    """A mixed 64-bit key of the Q bytes from each position on."""
    if len(a) < Q:
        return np.zeros(0, np.uint64)
    w = a.astype(np.uint64)
    two = w[:-1] | w[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    eight = four[:-4] | four[4:] << np.uint64(32)
    key = eight[: len(a) - Q + 1] * np.uint64(0x9E3779B97F4A7C15) + two[8 : len(a) - Q + 9] * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    return key * np.uint64(0xBF58476D1CE4E5B9)


def window_keys(a: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit key of the ``width`` bytes from each position on: those of two overlapping halves, from single bytes up."""
    if len(a) < width:
        return np.zeros(0, np.uint64)
    key, have = a.astype(np.uint64) + np.uint64(1), 1
    while have < width:
        step = min(have, width - have)
        key = key[:-step] * np.uint64(0x9E3779B97F4A7C15) + (key[step:] ^ key[step:] >> np.uint64(31)) * np.uint64(0xC2B2AE3D27D4EB4F)
        have += step
    return key


def edits_for(m: int) -> int:
    """The edit budget of m bytes: a share, and so few that the lemma still asks for a shared q-gram."""
    return max(0, min(math.floor(m * EDIT_RATE), m // Q - 1))


@dataclass
class Index:
    """Windows of the items: texts and item numbers; and runs of consecutive places (window, first place, length) by q-gram key.

    short: the items that are too short for the lemma, {bytes: {text: item numbers}}.
    """

    ids: list
    texts: list[np.ndarray]
    items: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    windows: np.ndarray
    places: np.ndarray
    lengths: np.ndarray
    table: np.ndarray
    short: dict[int, dict[bytes, list[int]]]


def build_index(items: list[tuple[int | None, str | None]]) -> Index:
    ids: dict = {}
    texts, of, short = [], [], {}
    for item, text in items:
        a = compared((text or "").encode("utf-8", "surrogatepass"))
        if not len(a):
            continue
        n = ids.setdefault(item, len(ids))
        if len(a) < SHORTEST:
            short.setdefault(len(a), {}).setdefault(a.tobytes(), []).append(n)
            continue
        for i in [0] if len(a) <= WINDOW else [*range(0, len(a) - WINDOW, STEP), len(a) - WINDOW]:
            texts.append(a[i : i + WINDOW])
            of.append(n)
    per = [gram_keys(t) for t in texts]
    keys = np.concatenate(per) if per else np.zeros(0, np.uint64)
    windows = np.repeat(np.arange(len(per), dtype=np.int32), [len(p) for p in per])
    places = np.concatenate([np.arange(len(p), dtype=np.int16) for p in per]) if per else np.zeros(0, np.int16)
    order = np.argsort(keys, kind="stable")
    keys, windows, places = keys[order], windows[order], places[order]
    new = np.ones(len(keys), bool)  # the first posting of each run
    new[1:] = (keys[1:] != keys[:-1]) | (windows[1:] != windows[:-1]) | (places[1:] != places[:-1] + 1)
    first = np.flatnonzero(new)
    unique, starts = np.unique(keys[first], return_index=True)
    table = np.zeros(1 << BITS, bool)
    table[(unique >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return Index(list(ids), texts, np.array(of, np.int64), unique, np.append(starts, len(first)), windows[first], places[first], np.diff(np.append(first, len(keys))).astype(np.int16), table, short)


def align(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int] | None:
    """Fewest edits (at most ``most``) turning ``item`` into a stretch of ``region``, and where the first such stretch ends.

    The region is a band: the item's diagonals start within its first len(region) - len(item) places.
    """
    m, n = len(item), len(region)
    width = max(1, n - m + 2 * most + 1)
    # cell (i, j) of the band holds document position i + j - most
    far = most + 1
    row = np.where((np.arange(width) - most >= 0) & (np.arange(width) - most <= n), 0, far)
    steps = np.arange(width)
    padded = np.full(m + width + most + 2, 256, np.int16)
    room = min(n, len(padded) - most - 1)
    padded[most + 1 : most + 1 + room] = region[:room]
    for i in range(1, m + 1):
        here = padded[i : i + width]  # the byte just before position i + j - most
        match = row + (here != item[i - 1])
        drop = np.append(row[1:], far) + 1
        best = np.minimum(match, drop)
        best = np.minimum.accumulate(best - steps) + steps
        at = i + steps - most
        best[(at < 0) | (at > n)] = far
        row = np.minimum(best, far)
        if row.min() > most:
            return None
    j = int(row.argmin())
    return int(row[j]), m + j - most


def bands_of(index: Index, small: np.ndarray, live: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(window, half band) of the bands of ``small`` that hold as many shared q-grams as the lemma asks for.

    A half band is edits + 1 diagonals; a place of the text counts once for each half band that a run of item places puts it in.
    live: whether a window is looked for.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = gram_keys(small)
    at = np.flatnonzero(index.table[(keys >> np.uint64(64 - BITS)).astype(np.int64)])
    if not len(at) or not len(index.keys):
        return none
    found = np.searchsorted(index.keys, keys[at])
    found[found == len(index.keys)] = 0
    same = index.keys[found] == keys[at]
    at, found = at[same], found[same]
    number = index.starts[found + 1] - index.starts[found]
    sizes = np.array([len(t) for t in index.texts], np.int64)
    budget = np.array([edits_for(int(n)) for n in sizes], np.int64)
    span = 4 * len(small) + 8
    codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cuts = np.searchsorted(np.cumsum(number), np.arange(0, int(number.sum()), POSTINGS), "left") if len(number) else []
    for i, j in zip(cuts, [*cuts[1:], len(at)]):
        i = int(i)
        n = number[i:j]
        run = np.repeat(index.starts[found[i:j]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if j > i else np.zeros(0, np.int64)
        place = np.repeat(at[i:j], n)
        window = index.windows[run].astype(np.int64)
        if live is not None:
            run, place, window = (x[live[window]] for x in (run, place, window))
        high = place - index.places[run] + len(small)  # never negative
        low = (high - index.lengths[run] + 1) // (budget[window] + 1)
        several = high // (budget[window] + 1) - low + 1
        code = np.repeat(window * span + low, several) + np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several)
        code, count = np.unique(code, return_counts=True)
        codes.append(code)
        counts.append(count)
    code, back = np.unique(np.concatenate(codes), return_inverse=True)
    count = np.bincount(back, np.concatenate(counts), len(code))
    after = np.zeros_like(count)
    after[:-1] = np.where(code[1:] == code[:-1] + 1, count[1:], 0)  # bands are two halves
    need = sizes + 1 - Q * (budget + 1)
    return np.divmod(code[count + after >= need[code // span]], span)


def _parts(raws: list[bytes]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Compared texts in groups of about BYTES: (document, first place, bytes). A longer text is cut in pieces, a group each, that overlap by a match."""
    group, size = [], 0
    for doc, raw in enumerate(raws):
        a = compared(raw)
        if len(a) > PIECE:
            yield from ([(doc, i, a[i : i + PIECE + OVERLAP])] for i in range(0, len(a) - OVERLAP, PIECE))
            continue
        if group and size + len(a) > BYTES:
            yield group
            group, size = [], 0
        group.append((doc, 0, a))
        size += len(a)
    if group:
        yield group


def search(index: Index, raws: list[bytes]) -> list[tuple]:
    """(document number, item, first byte, byte after the last, edits) of each match, best per document and item."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    known: dict[tuple[int, bytes], tuple[int, int] | None] = {}
    budget = [edits_for(len(t)) for t in index.texts]
    for group in _parts(raws):
        whole = np.concatenate([x for _, _, a in group for x in (a, [np.uint8(0)])]).astype(np.uint8)
        ends = np.cumsum([len(a) + 1 for _, _, a in group])
        live = None
        if group[0][1]:  # an item found without edits before this piece can't be found better in it
            done = {i for (d, i), hit in best.items() if d == group[0][0] and not hit[0]}
            live = ~np.isin(index.items, list(done)) if done else None
        for w, h in zip(*(x.tolist() for x in bands_of(index, whole, live))):
            item, e, n = index.texts[w], budget[w], int(index.items[w])
            low = h * (e + 1) - len(whole)  # first diagonal of the band
            middle = min(max(low + e + len(item) // 2, 0), len(whole) - 1)
            k = int(np.searchsorted(ends, middle, "right"))
            doc, place, _ = group[k]
            first, last = (int(ends[k - 1]) if k else 0), int(ends[k]) - 1
            low, high = max(first, low), min(last, low + 2 * (e + 1) + len(item) + e)
            old = best.get((doc, n))
            if old and not old[0] and old[1] <= low - first + place:
                continue
            region = whole[low:high].tobytes()
            if (w, region) not in known:
                if len(known) > 50_000:
                    known.clear()
                exact = region.find(item.tobytes())
                known[w, region] = (0, exact + len(item)) if exact >= 0 else align(item, whole[low:high], e)
            if known[w, region] is not None:
                edits, stop = known[w, region]
                start = max(0, low + stop - len(item) - first)
                hit = (edits, start + place, max(start, low + stop - 1 - first) + place)
                best[doc, n] = min(old or hit, hit)
        for doc, n, start, stop in _short_matches(index, group, whole, ends, raws):
            best[doc, n] = min(best.get((doc, n), (0, start, stop)), (0, start, stop))
    out, at, place = [], -1, np.zeros(0, np.int64)
    for (doc, n), (edits, start, stop) in sorted(best.items()):
        if doc != at:
            at, place = doc, np.flatnonzero(KEPT[np.frombuffer(raws[doc], np.uint8)])
        out.append((doc, index.ids[n], int(place[start]), int(place[stop]) + 1, edits))
    return out


def _short_matches(index: Index, group: list[tuple[int, int, np.ndarray]], whole: np.ndarray, ends: np.ndarray, raws: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """Items under SHORTEST bytes: (document, item, first and last place) of each occurrence as whole words, without edits."""
    text, at, place = whole.tobytes() if index.short else b"", -1, np.zeros(0, np.int64)
    for length, items in index.short.items():
        keys = window_keys(whole, length)
        wanted = {k: window_keys(np.frombuffer(k, np.uint8), length)[0] for k in items}
        for i in np.flatnonzero(np.isin(keys, np.array(list(wanted.values()), np.uint64))).tolist():
            if (ns := items.get(text[i : i + length])) is None:
                continue
            k = int(np.searchsorted(ends, i, "right"))
            doc, offset, _ = group[k]
            start = i - (int(ends[k - 1]) if k else 0) + offset
            if doc != at:
                at, place = doc, np.flatnonzero(KEPT[np.frombuffer(raws[doc], np.uint8)])
            a, b = int(place[start]), int(place[start + length - 1])
            if (a == 0 or not KEPT[raws[doc][a - 1]]) and (b + 1 == len(raws[doc]) or not KEPT[raws[doc][b + 1]]):
                yield from ((doc, n, start, start + length - 1) for n in ns)


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """The number of blocks of about BLOCK_BYTES, and the items of each; the driver holds one block at a time."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    block = lambda k: [(r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()]
    return n, (block(k) for k in range(n))


def _pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of at most ROWS rows and, above one row, about BYTES of text."""
    for whole in batches:
        raw = whole.column(whole.schema.get_field_index(text)).cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
        at = 0
        while at < len(raw):
            stop, size = at, 0
            while stop < len(raw) and stop - at < ROWS and (stop == at or size < BYTES):
                size += len(raw[stop] or b"")
                stop += 1
            yield whole.slice(at, stop - at), [r or b"" for r in raw[at:stop]]
            at = stop


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start_byte, end_byte (in the text's UTF-8) and edits of each document's best match with each item."""
    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(doc_id, text)
    names = [doc_id, "item_id", "start_byte", "end_byte", "edits"]

    def hits(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, raws in _pieces(batches, text):
                hits = search(shared.value, raws)
                ids = b.column(0).take(pa.array([h[0] for h in hits], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([h[k] for h in hits], t) for k, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32()), (4, pa.int32()))]], names=names)

        return small_batches(narrow).mapInArrow(run, f"`{doc_id}` {kind}, item_id long, start_byte int, end_byte int, edits int")

    return _each_block(docs, benchmark, item_id, item_text, hits)


def _each_block(docs: DataFrame, benchmark: DataFrame, item_id: str, text: str, pass_: Callable[[Broadcast], DataFrame]) -> DataFrame:
    """The rows of all passes, one a block of the benchmark. With several blocks each is written before the next is broadcast, so a task holds one index."""
    n, items = _blocks(benchmark, item_id, text)
    parts = []
    for block in items:
        shared = docs.sparkSession.sparkContext.broadcast(build_index(block))
        parts.append(pass_(shared) if n == 1 else cut(pass_(shared), "contamination"))
        if n > 1:
            shared.unpersist()
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Rows go through Python once where the benchmark is one block; for a larger one only texts do, and leave the hashes of those that hold an item.
    """
    n, items = _blocks(benchmark, item_id, item_text)
    if n == 1:
        shared = docs.sparkSession.sparkContext.broadcast(build_index(next(items)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, raws in _pieces(batches, text):
                bad = {h[0] for h in search(shared.value, raws)}
                yield b if not bad else b.take(pa.array([i for i in range(b.num_rows) if i not in bad], pa.int64()))

        return small_batches(docs).mapInArrow(run, docs.schema)
    keys = [F.xxhash64(F.lit(seed), F.col(f"`{text}`")) for seed in (1, 2)]  # what a text holds depends on the text alone
    texts = docs.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").alias("_text"))

    def hits(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, raws in _pieces(batches, "_text"):
                bad = pa.array(sorted({h[0] for h in search(shared.value, raws)}), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(bad), b.column(1).take(bad)], names=["_k0", "_k1"])

        return small_batches(texts).mapInArrow(run, "_k0 long, _k1 long")

    bad = cut(_each_block(docs, benchmark, item_id, item_text, hits).distinct(), "contaminated")
    return docs.join(small_enough(bad), (keys[0] == bad["_k0"]) & (keys[1] == bad["_k1"]), "left_anti")
