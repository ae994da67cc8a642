"""Toxicity: a linear-chain conditional random field tags toxic spans.

Labels are given for documents. Words and letter runs that stand out in toxic documents (a likelihood-ratio test on
document counts) label the tokens of the sample; the CRF learns from these token labels, with a word and its letter runs as
features and a transition matrix over the tags (other, toxic). Forward-backward marginals give each token's probability; a
document's score is a logistic function of the expected number of toxic tokens and of the two most toxic ones, fitted
on the document labels; the offending offsets are the runs of tokens with a marginal of at least one half.

The model is fitted on a bounded sample of labelled rows (``ROWS_PER_CLASS``, ``SAMPLE_BYTES``) and broadcast; its size is
bounded by ``MAX_FEATURES``. Scoring is one pass over whole texts without a shuffle.

Defined cases: a null or empty text, or one without letters, has no tokens and gets the score of a document without
toxic words; without labelled rows of both classes the score is the share of toxic labels (0 without any); repeated rows score alike; of a
repeated id the first different text by hash is learned from; an empty table gives no rows; other columns are kept by ``drop_toxic`` and not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts_of
from .labelled import sample

ROWS_PER_CLASS, SAMPLE_BYTES, MAX_FEATURES = 1500, 16_000_000, 200_000
TOKEN = re.compile(r"[^\W\d_]+")
#: Lengths of a word's letter runs that are features beside the word.
GRAMS = (4, 5, 6)
#: Tokens of a training segment, passes of training.
SEGMENT, PASSES = 64, 40
#: Toxic documents, and different neighbourhoods in them, that a telling feature must occur in.
LEAST = 8
#: Tokens of a long text whose chain is run as one of many pieces.
PIECE = 64
#: Words whose emission a task remembers.
CACHE = 150_000


def features_of(word: str) -> set[str]:
    word = word.lower()
    return {f"^{word}$", *(word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1))}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    #: log weights of tag transitions, [from, to]
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: logistic weights: constant, log(1 + expected toxic tokens), largest and second largest marginal
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))
    constant: float | None = None

    def emission(self, word: str) -> float:
        w = self.weights
        return self.bias + sum(w[f] for f in features_of(word) if f in w)

    def emissions(self, text: str | None, cache: dict[str, float]) -> np.ndarray:
        if len(cache) > CACHE:
            cache.clear()
        words = TOKEN.findall(text or "")
        for w in set(words):
            if w not in cache:
                cache[w] = self.emission(w)
        return np.fromiter(map(cache.__getitem__, words), np.float64, len(words))

    def score(self, facts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(facts), self.constant)
        z = self.document[0] + facts @ self.document[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def odds(weights: np.ndarray, lengths: np.ndarray, oo: float, ot: float, to: float, tt: float) -> np.ndarray:
    """The odds of the toxic tag at each token, from its weight and those of the tokens before it in its sequence.

    One step takes the odds r to weight * (ot + tt * r) / (oo + to * r). Steps compose like 2 x 2 matrices, so long sequences go in pieces
    of ``PIECE`` tokens: the pieces' matrices first, all at once, then the odds at their ends, then all tokens, so that one long
    text takes few steps in Python.
    """
    out = np.empty(len(weights))
    counts = -(-lengths // PIECE)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    of = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(of)) - first[of]
    begin = (np.cumsum(lengths) - lengths)[of] + nth * PIECE
    size = np.minimum(PIECE, lengths[of] - nth * PIECE)
    entry = np.zeros(len(of))  # odds at the end of the piece before
    whole = np.flatnonzero(nth + 1 < counts[of])  # pieces that another one follows
    if len(whole):
        head = nth[whole] == 0
        e = weights[begin[whole]]
        # the first token of a sequence has its weight for odds, whatever came before
        a, b = np.where(head, 0.0, e * tt), np.where(head, e, e * ot)
        c, d = np.where(head, 0.0, to), np.where(head, 1.0, oo)
        for t in range(1, PIECE):
            e = weights[begin[whole] + t]
            a, b, c, d = e * (tt * a + ot * c), e * (tt * b + ot * d), to * a + oo * c, to * b + oo * d
            most = np.maximum(np.maximum(a, b), np.maximum(c, d))
            a, b, c, d = a / most, b / most, c / most, d / most
        at = np.full(len(of), -1)
        at[whole] = np.arange(len(whole))
        for k in range(1, int(counts.max())):
            here = first[counts > k] + k
            m = at[here - 1]
            entry[here] = (a[m] * entry[here - 1] + b[m]) / (c[m] * entry[here - 1] + d[m])
    order = np.argsort(-size, kind="stable")
    begin, size, r, head = begin[order], size[order], entry[order], nth[order] == 0
    for t in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))  # pieces longer than t
        e, r = weights[begin[:n] + t], r[:n]
        r = e * (ot + tt * r) / (oo + to * r)
        if not t:
            r = np.where(head, e, r)
        out[begin[:n] + t] = r
    return out


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the tokens of all sequences: the probability of the toxic tag, and its odds from either side (each with the token itself)."""
    weights = np.exp(np.clip(emissions, -40, 40))
    oo, ot, to, tt = np.exp(transitions).ravel()
    left = odds(weights, lengths, oo, ot, to, tt)
    right = odds(weights[::-1], lengths[::-1], oo, to, ot, tt)[::-1]
    both = left * right
    return both / (weights + both), left, right


def expected_pairs(left: np.ndarray, right: np.ndarray, follow: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The expected number of each pair of tags [from, to] at the tokens ``follow`` and the one before each."""
    one = np.ones(len(follow))
    pair = np.stack((one, left[follow - 1]), 1)[:, :, None] * np.exp(transitions) * np.stack((one, right[follow]), 1)[:, None, :]
    return (pair / pair.sum((1, 2), keepdims=True)).sum(0)


def marginals(emissions: list[np.ndarray], transitions: np.ndarray) -> list[np.ndarray]:
    """The probability of the toxic tag at each token of each sequence."""
    lengths = np.array([len(e) for e in emissions], np.int64)
    flat = np.concatenate(emissions) if emissions else np.zeros(0)
    return np.split(forward_backward(flat, lengths, transitions)[0], np.cumsum(lengths)[:-1]) if emissions else []


def facts_of(p: np.ndarray) -> tuple[float, float, float]:
    if not len(p):
        return 0.0, 0.0, 0.0
    top = np.partition(p, -2)[-2:] if len(p) > 1 else np.array([0.0, p[0]])
    return float(np.log1p(p.sum())), float(top[1]), float(top[0])


def runs_of(word: str, length: int | None) -> set[str]:
    return {f"^{word}$"} if length is None else {word[i : i + length] for i in range(len(word) - length + 1)}


def telling_features(vocabulary: list[str], seen: np.ndarray, around: np.ndarray, n: list[int]) -> set[str]:
    """Features that occur in far more toxic documents than others, by a likelihood-ratio test.

    seen: documents of either class with each word; around: its different neighbourhoods in toxic documents. Near copies and
    shared passages repeat a word with its neighbours; only different neighbours count as evidence.
    """
    out: set[str] = set()
    for length in (None, *GRAMS):  # one length at a time, to hold little
        count: dict[str, list[int]] = {}
        for i in np.flatnonzero(seen[1]):
            for f in runs_of(vocabulary[i], length):
                c = count.setdefault(f, [0, 0, 0])
                c[1] += int(seen[1, i])
                c[2] += int(around[i])
        count = {f: c for f, c in count.items() if min(c[1:]) >= LEAST}
        for i in np.flatnonzero(seen[0]):
            for f in runs_of(vocabulary[i], length) & count.keys():
                count[f][0] += int(seen[0, i])
        for f, (b, a, c) in count.items():
            a, b = min(a, c, n[1]), min(b, n[0])
            p, q, r = a / n[1], b / n[0], (a + b) / sum(n)
            if q < 0.1 * p and 2 * (a * np.log(p / r) + (b * np.log(q / r) if b else 0)) > 2 * LEAST:
                out.add(f)
    return out


def fit(rows: list[tuple[int, str]], totals: dict[int, int]) -> Model:
    rows = list({x: (y, x) for y, x in reversed(rows)}.values())  # copies would make chance words look telling
    y = np.array([r[0] for r in rows], float)
    if set(y) != {0, 1}:
        return Model(constant=totals.get(1, 0) / max(1, sum(totals.values())))
    ids: dict[str, int] = {}
    docs = [np.fromiter((ids.setdefault(w.lower(), len(ids)) for w in TOKEN.findall(x or "")), np.int32) for _, x in rows]
    seen = np.zeros((2, len(ids)), np.int32)
    for k, d in zip(y, docs):
        seen[int(k), np.unique(d)] += 1
    triples = [np.stack((np.append(-1, d[:-1]), d, np.append(d[1:], -1)), 1) for k, d in zip(y, docs) if k and len(d)]
    around = np.bincount(np.unique(np.concatenate(triples), axis=0)[:, 1], minlength=len(ids)) if triples else np.zeros(len(ids), int)
    telling = telling_features(list(ids), seen, around, [int((y == k).sum()) for k in (0, 1)])
    # every word without a telling feature has the tag's bias alone
    number: dict[str, int] = {f: i for i, f in enumerate(sorted(telling))}
    pairs = [(i, number.setdefault(f, len(number))) for i, w in enumerate(ids) if (own := features_of(w) & telling) for f in (*own, f"^{w}$")]
    of_word, of_feature = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    names = list(number)
    toxic_word = np.zeros(len(ids), bool)
    toxic_word[of_word] = True
    # segments: those with a toxic token, and as many others
    pieces = [(toxic_word[d[i : i + SEGMENT]] & (k == 1), d[i : i + SEGMENT]) for k, d in zip(y, docs) for i in range(0, len(d), SEGMENT)]
    hot = [s for s in pieces if s[0].any()]
    cold = [s for s in pieces if not s[0].any()]
    pieces = hot + cold[:: max(1, len(cold) // max(1, 2 * len(hot)))]
    model = Model()
    if hot:
        w, b, tr = np.zeros(len(names)), -2.0, np.zeros((2, 2))
        gw, gb, gt = np.full(len(names), 1e-2), 1e-2, np.full((2, 2), 1e-2)
        tags, words = np.concatenate([s[0] for s in pieces]).astype(float), np.concatenate([s[1] for s in pieces])
        lengths = np.array([len(s[1]) for s in pieces])
        inner = np.ones(len(words), bool)
        inner[np.cumsum(lengths) - lengths] = False
        follow = np.flatnonzero(inner)
        seen_pairs = np.bincount((2 * tags[follow - 1] + tags[follow]).astype(int), minlength=4).reshape(2, 2)
        for _ in range(PASSES):
            per_word = b + np.bincount(of_word, w[of_feature], len(ids))
            p, left, right = forward_backward(per_word[words], lengths, tr)
            miss = tags - p
            by_word = np.bincount(words, miss, len(ids))
            g = np.bincount(of_feature, by_word[of_word], len(names)) - 0.02 * w
            gw += g**2
            w += 0.5 * g / np.sqrt(gw)
            d = miss.sum()
            gb += d**2
            b += 0.5 * d / np.sqrt(gb)
            grad = seen_pairs - expected_pairs(left, right, follow, tr) - 0.1 * tr
            gt += grad**2
            tr += 0.1 * grad / np.sqrt(gt)
        top = np.argsort(-np.abs(w), kind="stable")[:MAX_FEATURES]
        model = Model({names[i]: float(w[i]) for i in top if abs(w[i]) > 0.02}, float(b), tr)
    cache: dict[str, float] = {}
    facts = np.array([facts_of(p) for p in marginals([model.emissions(x, cache) for _, x in rows], model.transitions)])
    known = {k: max(1, (y == k).sum()) for k in (0, 1)}
    weight = np.array([totals.get(int(k), 1) / known[int(k)] for k in y])
    model.document = logistic(facts, y, weight / weight.sum())
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    x = np.column_stack((np.ones(len(x)), x))
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-6] + [1e-4] * (x.shape[1] - 1))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - np.array([1e-6] + [1e-4] * (x.shape[1] - 1)) * b)
        b += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return b


def train(docs: DataFrame, labels: DataFrame, usable, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    rows, totals = sample(docs, labels, label, usable, ROWS_PER_CLASS, SAMPLE_BYTES, doc_id, [text])
    return fit(rows, totals)


def _scored(batches: Iterator[pa.RecordBatch], text: str, model: Model) -> Iterator[tuple[pa.RecordBatch, list, list[np.ndarray], np.ndarray]]:
    """Slices of rows with their texts, marginals and scores."""
    cache: dict[str, float] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            texts = texts_of(b.column(b.schema.get_field_index(text)))
            ps = marginals([model.emissions(t, cache) for t in texts], model.transitions)
            yield b, texts, ps, model.score(np.array([facts_of(p) for p in ps]).reshape(-1, 3))


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and spans: start, end (code points) and score of each run of toxic tokens."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts, ps, scores in _scored(batches, "_text", shared.value):
            found = [spans_of(t, p) if len(p) and p.max() >= 0.5 else [] for t, p in zip(texts, ps)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(span))], names=[doc_id, "score", "spans"])

    return small_batches(docs.select(doc_id, F.col(text).alias("_text"))).mapInArrow(run, f"`{doc_id}` {kind}, score double, spans array<struct<start:int,end:int,score:double>>")


def drop_toxic(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score under ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, _, scores in _scored(batches, text, shared.value):
            yield b.filter(pa.array(scores < threshold))

    return small_batches(docs).mapInArrow(run, docs.schema)


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    out: list[dict] = []
    for i, m in enumerate(TOKEN.finditer(text)):
        if p[i] >= 0.5:
            if out and out[-1]["_i"] == i - 1:
                out[-1] |= {"end": m.end(), "_i": i, "score": max(out[-1]["score"], float(p[i]))}
            else:
                out.append({"start": m.start(), "end": m.end(), "_i": i, "score": float(p[i])})
    return [{k: v for k, v in s.items() if k != "_i"} for s in out]
