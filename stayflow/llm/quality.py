"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score is logistic in w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j; the pairs cost linear time by
1/2 * sum over f of ((sum v_if x_i)^2 - sum (v_if x_i)^2). Inputs are the shares of the words (and of the runs of signs between
them) of the whole text in hashed buckets, statistics of its structure, and any numeric metadata columns named.

The model is fitted with Adagrad on a bounded sample of labelled rows (``ROWS_PER_CLASS``, ``SAMPLE_BYTES``) whose classes are
weighted back to their shares; its size is fixed by ``BUCKETS`` and ``RANK``. Scoring is one pass over whole texts without a shuffle.

Defined cases: a null text is an empty one; an empty text is scored on its (zero) statistics; null metadata counts as 0;
without labelled rows of both classes every score is the share of label 1 (0.5 without labels); repeated rows score alike; of a repeated id the
first different text by hash is learned from; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts_of
from .labelled import sample

ROWS_PER_CLASS, SAMPLE_BYTES = 2500, 24_000_000
BUCKETS, RANK, PASSES, BATCH = 1 << 14, 8, 12, 64
UNIT = re.compile(r"\w+|[^\w\s]+")
#: Units whose bucket a task remembers.
CACHE = 500_000

#: The class of each byte: 0 lower case, 1 upper case, 2 digit, 3 space, 4 line end, 5 mark of a sentence, 6 other sign, 7 beyond ASCII.
BYTE_CLASS = np.full(256, 6, np.intp)
BYTE_CLASS[ord("a") : ord("z") + 1] = 0
BYTE_CLASS[ord("A") : ord("Z") + 1] = 1
BYTE_CLASS[ord("0") : ord("9") + 1] = 2
BYTE_CLASS[[ord(" "), ord("\t")]] = 3
BYTE_CLASS[[ord("\n"), ord("\r")]] = 4
BYTE_CLASS[[ord(c) for c in ".,;:'\"-()"]] = 5
BYTE_CLASS[128:] = 7
STATISTICS = 16


def structure(text: str, units: Counter) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    share = np.bincount(BYTE_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / n
    words = sum(units.values())
    lines = text.count("\n") + 1
    once = sum(1 for c in units.values() if c == 1)
    return [*share, len(units) / max(1, words), once / max(1, words), max(units.values(), default=0) / max(1, words), math.log1p(words) / 5, math.log1p(n) / 8, min(3.0, words / lines / 20), min(3.0, n / max(1, words) / 6), float(words < 8)]


def inputs(text: str | None, meta: Sequence[float], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a document: buckets, then statistics and metadata."""
    text = text or ""
    units = Counter(UNIT.findall(text))
    if len(cache) > CACHE:
        cache.clear()
    for u in units:
        if u not in cache:
            cache[u] = zlib.crc32(u.lower().encode("utf-8", "surrogatepass")) % BUCKETS
    dense = structure(text, units) + [math.copysign(math.log1p(abs(m)), m) / 8 for m in meta]
    if not units:
        return np.arange(BUCKETS, BUCKETS + len(dense)), np.array(dense)
    places = np.fromiter(map(cache.__getitem__, units), np.int64, len(units))
    counts = np.bincount(places, np.fromiter(units.values(), np.float64, len(units)), BUCKETS)
    at = np.flatnonzero(counts)
    return np.concatenate((at, np.arange(BUCKETS, BUCKETS + len(dense)))), np.concatenate((np.sqrt(counts[at] / counts[at].sum()), dense))


@dataclass
class Model:
    bias: float
    w: np.ndarray
    v: np.ndarray
    constant: float | None = None

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        vx = self.v[at] * x[:, None]
        z = self.bias + self.w[at] @ x + 0.5 * float((vx.sum(0) ** 2 - (vx**2).sum(0)).sum())
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))


def fit(rows: Sequence[tuple], totals: dict[int, int], seed: int = 5) -> Model:
    """rows: (label, text, metadata...)."""
    rows = list({r[1:]: r for r in rows}.values())  # copies would weigh their words up
    y = np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        return Model(0.0, np.zeros(0), np.zeros((0, RANK)), totals.get(1, 0) / sum(totals.values()) if totals else 0.5)
    cache: dict[str, int] = {}
    data = [inputs(r[1], [float(m or 0) for m in r[2:]], cache) for r in rows]
    size = BUCKETS + STATISTICS + len(rows[0]) - 2
    rng = np.random.default_rng(seed)
    bias, w, v = 0.0, np.zeros(size), rng.normal(0, 0.05, (size, RANK))
    gb, gw, gv = 1e-3, np.full(size, 1e-3), np.full((size, RANK), 1e-3)
    weight = np.array([totals.get(int(k), 1) / (y == k).sum() for k in y])
    weight *= len(y) / weight.sum()
    for step in range(PASSES):
        order = rng.permutation(len(rows))
        rate = 0.1 / (1 + 0.2 * step)
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            lengths = np.array([len(data[k][0]) for k in part])
            at, x = np.concatenate([data[k][0] for k in part]), np.concatenate([data[k][1] for k in part])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            vx = v[at] * x[:, None]
            s = np.add.reduceat(vx, starts)
            z = bias + np.add.reduceat(w[at] * x, starts) + 0.5 * (s**2 - np.add.reduceat(vx**2, starts)).sum(1)
            g = weight[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            gx = np.repeat(g, lengths) * x
            used, where = np.unique(at, return_inverse=True)
            dw = np.bincount(where, gx, len(used)) + 1e-5 * w[used]
            full = gx[:, None] * (np.repeat(s, lengths, 0) - vx)
            dv = np.stack([np.bincount(where, full[:, f], len(used)) for f in range(RANK)], 1) + 1e-5 * v[used]
            gb += g.sum() ** 2
            bias -= rate * g.sum() / math.sqrt(gb)
            gw[used] += dw**2
            w[used] -= rate * dw / np.sqrt(gw[used])
            gv[used] += dv**2
            v[used] -= rate * dv / np.sqrt(gv[used])
    return Model(float(bias), w, v)


def train(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", metadata: Sequence[str] = ()) -> Model:
    rows, totals = sample(docs, labels, label, usable, ROWS_PER_CLASS, SAMPLE_BYTES, doc_id, [text, *metadata])
    return fit(rows, totals)


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", metadata: Sequence[str] = ()) -> DataFrame:
    """doc_id and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                meta = zip(*[c.to_pylist() for c in b.columns[2:]]) if b.num_columns > 2 else ((),) * b.num_rows
                scores = [model.score(*inputs(t, m, cache)) for t, m in zip(texts_of(b.column(1)), meta)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=[doc_id, "score"])

    numbers = [F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in metadata]
    return small_batches(docs.select(doc_id, text, *numbers)).mapInArrow(run, f"`{doc_id}` {kind}, score double")
