"""Long documents, large numbers, large benchmarks and broken texts."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, edge_documents, prose

from stayflow.llm import ann, decontaminate, langid, mixing, quality, toxicity
from stayflow.llm.common import held_out


def missed(lengths, counts, budget):
    lengths, counts = np.array(lengths), np.array(counts)
    take = mixing.fit_budget(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    return abs(int((lengths * take).sum()) - budget)


@pytest.mark.parametrize("long_share", [0.2, 0.3, 0.45, 0.6, 0.7])
@pytest.mark.parametrize("budget_share", [0.5, 0.6, 0.7, 0.8, 0.9])
@pytest.mark.parametrize("copies", [3, 20, 200])
def test_budgets_with_a_long_document(long_share, budget_share, copies):
    lengths = list(range(10, 400))
    others = sum(lengths) * copies
    longest = round(others * long_share / (1 - long_share))
    budget = round((others + longest) * budget_share)
    gap = max(0, min(budget - others, longest - budget))  # what no choice can reach: more than the others, less than the long one
    assert missed([*lengths, longest], [copies] * len(lengths) + [1], budget) <= gap + 10


def test_budgets_with_several_long_documents():
    lengths, counts = [7, 50_000, 80_001, 900_000, 2_000_003], [1000, 3, 2, 2, 1]
    for target in (50_000 * 2 + 80_001, 900_000 + 80_001 + 70, 2_000_003 + 900_000 * 2 + 50_000 * 3, 900_000 * 2 + 7 * 500):
        assert missed(lengths, counts, target) <= 7


def test_a_budget_takes_memory_for_the_budget_not_for_the_longest_text():
    tracemalloc.start()
    assert missed([5, 7, 20_000_000], [100, 100, 1], 500) == 0
    assert missed([5, 7, 20_000_000], [100, 100, 1], 15_000_000) == 5_000_000
    assert tracemalloc.get_traced_memory()[1] < 200 * 2**20
    tracemalloc.stop()


@pytest.mark.parametrize("size", [1e-30, 1.0, 1e18, 1e19, 1e25, 1e30, 1e38])
def test_neighbours_of_large_and_small_vectors(size):
    rng = np.random.default_rng(3)
    x = (rng.uniform(-1, 1, (60, 8)) * size).astype(np.float32)
    row, at, score = ann.best_pairs(x, np.arange(60), x[:3], 5)
    exact = x.astype(np.float64)
    for q in range(3):
        products = (exact[q] * exact).sum(1)
        want = np.lexsort((np.arange(60), -products))[:5]
        assert at[row == q].tolist() == want.tolist() and np.array_equal(score[row == q], products[want])


def test_search_of_large_vectors(spark):
    rng = np.random.default_rng(5)
    x = (rng.uniform(-1, 1, (60, 8)) * 1e25).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in ann.search(table, F.col("vec_id") % 20 == 0, k=5).collect()}
    exact = x.astype(np.float64)
    for q in (0, 20, 40):
        order = [i for i in np.lexsort((np.arange(60), -(exact[q] * exact).sum(1))) if i != q][:5]
        assert [got[q, k + 1] for k in range(5)] == order


def benchmark_and_documents(spark):
    import random

    rng = random.Random(9)
    items = [(i, prose(rng, 40)) for i in range(30)]
    docs = [(i, prose(rng, 60) + " " + items[i][1] + " " + prose(rng, 20) if i % 3 == 0 else prose(rng, 80)) for i in range(30)]
    docs += [(None, docs[0][1]), (3, docs[1][1]), (50, None), (51, "")]
    return spark.createDataFrame([(*d, *[None] * 5) for d in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string")


def test_a_benchmark_of_several_blocks(spark, monkeypatch):
    docs, items = benchmark_and_documents(spark)
    one = [sorted(map(str, df.collect())) for df in (decontaminate.find_contamination(docs, items), decontaminate.drop_contaminated(docs, items))]
    plans = []
    write = decontaminate.cut
    monkeypatch.setattr(decontaminate, "cut", lambda df, tag: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, tag))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    frames = [decontaminate.find_contamination(docs, items), decontaminate.drop_contaminated(docs, items)]
    assert [sorted(map(str, df.collect())) for df in frames] == one and len(plans) >= 7
    # one Python node a pass, and none is left in what comes after
    assert max(p.count("MapInArrow") for p in plans) == 1 and not any("MapInArrow" in df._jdf.queryExecution().executedPlan().toString() for df in frames)


def test_texts_that_are_not_utf8_are_scored(spark):
    rows = [(i, f"good words here {i} and there " * 5, 1, 0) for i in range(8)] + [(100 + i, f"badword awful {i} junk " * 5, 0, 1) for i in range(8)]
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(r[0], r[1].encode() + (b"\xff\xe2 x" if r[0] % 2 else b"")) for r in rows] + [(200, b"\xff\xfe"), (201, None)], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) AS text", "'en' AS lang")
    model = quality.train(docs, labels, ~held_out("doc_id", 3, 1))
    assert quality.score_documents(docs, model).count() == 18
    tagger = toxicity.train(docs, labels, ~held_out("doc_id", 4, 2))
    assert toxicity.score_documents(docs, tagger).count() == 18 and toxicity.drop_toxic(docs, tagger, 0.3).count() <= 18
    pages = docs.selectExpr("doc_id AS page_id", "'http://a.com/' AS url", "text AS html")
    assert langid.identify(pages, langid.fit_text(docs)).count() == 18


def test_edge_documents_pass_the_changed_filters(spark):
    docs = spark.createDataFrame(edge_documents(), SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count() and decontaminate.find_contamination(docs, none).count() == 0
