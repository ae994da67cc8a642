"""Ranked lexical search against a plain scoring of every document for every item."""

import math
import random
import re

import numpy as np
import pytest
from compare import connect, same
from test_llm_operators import SCHEMA, edge_documents

from stayflow.llm import lexical, queries

FOLDER = "/root/testdata/sf0.001"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text):
    return re.findall(TERM, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top):
    """Every document scored for every item."""
    read = [(d, ts) for d, ts in ((d, lowered(t)) for d, t in docs) if ts]
    n, words = len(read), sum(len(ts) for _, ts in read)
    out = []
    by_id = {}
    for i, t in items:
        by_id.setdefault(i, set()).update(lowered(t))
    for i, terms in by_id.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t in terms if (df := sum(t in ts for _, ts in read))}
        scores = []
        for d, ts in read:
            m = 10 + 90 * len(ts) * n // words
            score = sum(w[t] * ((10**9 * ts.count(t)) // (1000 * ts.count(t) + 8 * m)) for t in w if t in ts)
            scores += [(-score, d is None, d or 0, d)] if score > 0 else []
        out += [(i, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def test_terms():
    text = "Café-au LAIT, x_1\x00Ünïted ÉÀ 日本 9"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == lowered(text) == ["café", "au", "lait", "x", "1", "Ünïted ÉÀ", "日本", "9"]
    assert lexical.terms_of(None) == lexical.terms_of(b"") == lexical.terms_of(b" .,") == []


@pytest.mark.parametrize("terms", [3, 8, 64, 65, 200])
def test_masks(terms):
    presence = np.random.default_rng(terms).random((terms, 500)) < 0.02
    first, group = lexical.masks_of(presence)
    want = {}
    for i in range(500):
        want.setdefault(presence[:, i].tobytes(), []).append(i)
    assert sorted(np.flatnonzero(group == g).tolist() for g in range(len(first))) == sorted(want.values())
    assert all(i == min(np.flatnonzero(group == group[i])) for i in first)


@pytest.mark.parametrize("rounds", [lexical.ROUND, 8])
def test_search_equals_plain_scoring(spark, monkeypatch, rounds):
    rng = random.Random(rounds)
    docs = [(r[0], r[1]) for r in edge_documents()] + [(1000 + i, " ".join(rng.choice("a b c d e ab ac the of x1".split()) for _ in range(rng.randint(1, 30)))) for i in range(300)]
    docs += [(None, "the of x1"), (None, "the of x1"), (7, "the of x1"), (7, "the of x1"), (3, "A_a B"), (4, "!!")]
    items = [(1, docs[0][1]), (2, "the of the x1"), (3, None), (4, ""), (5, "nowhere"), (6, " ".join(t for _, t in docs[:12] if t)), (1, "x1 a"), (None, "b c"), (8, docs[20][1])]
    spark_docs = spark.createDataFrame([(d, t, *[None] * 5) for d, t in docs], SCHEMA).repartition(3)
    spark_items = spark.createDataFrame([(*i, "clash") for i in items], "item_id int, text string, doc_id string")
    monkeypatch.setattr(lexical, "ROUND", rounds)
    for block in (lexical.BLOCK_BYTES, 300):  # 300: several blocks of items
        monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
        for top in (10, 3):
            assert sorted(map(tuple, lexical.search(spark_docs, spark_items, top=top).collect()), key=str) == plain(docs, items, top)


def test_low_masks_are_left_out():
    """Once the best are found, documents of lower masks are not evaluated."""
    n = 2000
    docs = [np.array([0, 1] if i < 20 else [1], np.uint32).tobytes() for i in range(n)]
    tfs = [np.array([1] * (len(d) // 4), np.uint32).tobytes() for d in docs]
    part = lexical.Round(list(range(n)), np.full(n, 10, np.int64), docs, tfs, np.array([5000, 1]), n, 10 * n)
    looked = []
    part.ids = type("Ids", (list,), {"__getitem__": lambda self, i: looked.append(i) or list.__getitem__(self, i)})(part.ids)
    best = part.best(np.array([0, 1], np.uint32), 10, [])
    assert [b[2] for b in best] == list(range(10)) and len(set(looked)) <= lexical.STEP


def test_empty_tables_and_broken_text(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r)[:3] for r in lexical.search(docs, items).collect()] == [(1, 1, 1)]
    assert lexical.search(docs.limit(0), items).collect() == lexical.search(docs, items.limit(0)).collect() == []
    broken = spark.createDataFrame([(1, b"a \xff\xe2 b"), (2, b"\xff")], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) text")
    assert [r["doc_id"] for r in lexical.search(broken, items).collect()] == [1]
    named = lexical.search(spark.createDataFrame([("k", "a b")], "key string, body string"), spark.createDataFrame([("i", "b")], "q string, words string"), doc_id="key", text="body", item_id="q", item_text="words")
    assert named.columns == ["q", "rank", "key", "score"] and named.count() == 1


def test_query_equals_its_sql(spark):
    same(queries.op12_lexical_search(spark, FOLDER), connect(FOLDER), queries.oracle_sql()["op12_lexical_search"])
