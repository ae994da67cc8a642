"""Phrase mining against plain counting of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, same
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, edge_documents

from stayflow.llm import collocations as C
from stayflow.llm import queries

FOLDER = "/root/testdata/sf0.001"


def pieces(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def plain(docs, least, top, cover=(50, 100)):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in (1, 2, 3):
                f.update((lang, tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    covered = {(lang, part) for (lang, ws), a in found.items() if len(ws) == 3 for part in (ws[:2], ws[1:]) if cover[1] * a >= cover[0] * f[lang, part]}
    out = {}
    for (lang, ws), a in found.items():
        if (lang, ws) not in covered:
            score, k = min((10**6 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
            out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "É", "x-1", "Z\x00", "a", "b"]
    texts = [(rng.choice(["en", "de", None, "und", ""]), " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ", ", "\t", "\n"]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return [*texts, *[("en", "New York City hall")] * 12, ("en", None), ("en", ""), ("fr", "! ?"), *[(None, "same row same row")] * 30]


def run(spark, docs, **kw):
    df = spark.createDataFrame([(i, t, lang, *[None] * 4) for i, (lang, t) in enumerate(docs)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in C.mine(df, **kw).collect())


@pytest.mark.parametrize("seed", range(3))
def test_mining_equals_plain_counting(spark, monkeypatch, seed):
    docs = corpus(seed) + [(r[2], r[1]) for r in edge_documents()]
    if seed == 2:
        monkeypatch.setattr(C, "BLOCK_WORDS", 50)
        monkeypatch.setattr(C, "BITS", 64)  # nearly everything is a false hit
    assert run(spark, docs) == plain(docs, 10, 2000)
    assert run(spark, docs, least=3, top=7, cover=(90, 100)) == plain(docs, 3, 7, (90, 100))


def test_border_failures_are_counted_in_further_passes(spark, monkeypatch):
    docs = corpus(5)
    passes = []
    count = C.count_phrases
    monkeypatch.setattr(C, "count_phrases", lambda texts, seed, known, before, longest=3: passes.append(sorted(known)) or count(texts, seed, known, before, longest))
    # a sample of no text proposes no pair: all of them fail, and a second pass counts what they allow
    assert run(spark, docs, sample_of=10**9) == plain(docs, 10, 2000)
    assert passes == [[1], [1, 2], [2]]
    passes.clear()
    assert run(spark, docs, sample_of=1) == plain(docs, 10, 2000)
    assert passes == [[1], [1, 2]]


def test_a_shared_hash_takes_the_next_seed(spark, monkeypatch):
    real = C.word_hashes
    monkeypatch.setattr(C, "count_words", lambda texts, seed, f=C.count_words: f(texts, seed).withColumn("h1", F.lit(7).cast("long")) if seed == 0 else f(texts, seed))
    docs = corpus(1)
    assert real([("en", b"a")], 0)[1] != real([("en", b"a")], 1)[1] and run(spark, docs) == plain(docs, 10, 2000)


def test_bitmap_positions_agree_with_columns(spark):
    h = np.random.default_rng(1).integers(-(2**63), 2**63, (3, 200), dtype=np.int64)
    df = spark.createDataFrame([tuple(map(int, r)) for r in h.T], "h1 long, h2 long, h3 long")
    assert [r[0] for r in df.select(C.folded_column(C.HASHES)).collect()] == C.folded(list(h)).view(np.int64).tolist()
    assert C._holds(C.bitmap(df, 3), C.folded(list(h))).all()


def test_empty_table_and_texts_that_are_not_utf8(spark):
    assert run(spark, []) == [] and run(spark, [("en", None)]) == []
    raw = spark.createDataFrame([(b"\xff b",)] * 10, "raw binary").selectExpr("cast(raw as string) text", "'en' lang")
    assert [(r["a"], r["score"]) for r in C.mine(raw).collect()] == [(10, 10**6)]


def test_large_counts_are_exact(spark):
    phrases = spark.createDataFrame([(1, 2, 0, 10**14)], "h1 long, h2 long, h3 long, n long")
    words = spark.createDataFrame([("en", b"a", 1, 10**15 - 1), ("en", b"b", 2, 10**14 + 7)], "lang string, word binary, h1 long, n long")
    assert C.scored(phrases, words, (50, 100)).first()["score"] == 10**6 * 10**28 // ((10**15 - 1) * (10**14 + 7))


def test_block_numbers():
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en"]), pa.array([b"A b,a", b"a", None], pa.binary())], names=["lang", "text"])
    (words, x), = C.blocks([batch], (100, 100))
    assert words == [("en", b"a"), ("en", b"b"), ("de", b"a")] and x.tolist() == [1, 2, 0, 1, 0, 3, 0, 0]


def test_query_equals_its_sql(spark):
    assert {t for c, t in queries.op13_collocations(spark, FOLDER).dtypes if c not in ("lang", "phrase")} == {"bigint"}
    same(queries.op13_collocations(spark, FOLDER), connect(FOLDER), queries.oracle_sql()["op13_collocations"])
