"""Extra columns with the operators' own names, and repeated rows."""

import random

import pytest
from pyspark.sql import functions as F
from test_llm_operators import FOLDER, prose

from stayflow.llm import ann, decontaminate, langid, quality, toxicity, url_filter
from stayflow.llm.common import held_out

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block")]


def told(df):
    return sorted(map(str, df.collect()))


def with_clashes(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


def test_search_of_vectors_with_extra_columns(spark):
    rng = random.Random(2)
    table = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)], "vec_id long, embedding array<float>")
    clashing = with_clashes(table, "query_id", "rank", "score", "id", "v", "q", "e", "ids", "asked", "o", "key", "at", "b", "r", "raw")
    asked = F.col("vec_id") % 20 == 0
    assert told(ann.search(clashing, asked, k=3)) == told(ann.search(table, asked, k=3))


def test_repeated_rows_of_vectors(spark):
    table = spark.createDataFrame([(i % 40, [float(i % 40), 1.0]) for i in range(80)], "vec_id long, embedding array<float>")
    assert told(ann.search(table, F.col("vec_id") % 20 == 0, k=3)) == told(ann.search(table.distinct(), F.col("vec_id") % 20 == 0, k=3))


def test_pages_with_extra_columns_and_repeated_rows(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").limit(60)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    model = langid.fit_text(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    for run, names in ((lambda p: langid.identify(p, model), ("host", "declared", "suffix", "lang", "_text", "_n", "_up")), (lambda p: url_filter.match_urls(p, rules), ("host", "path", "rule", "verdict", "action", "text"))):
        plain = run(pages)
        assert told(run(with_clashes(pages, *names)).select(*plain.columns)) == told(plain)
    assert told(url_filter.match_urls(pages.unionByName(pages), rules)) == sorted(told(url_filter.match_urls(pages, rules)) * 2)
    assert langid.identify(pages.unionByName(pages), model).count() == 2 * pages.count()


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, 40)) for i in range(5)]
    docs = [(i, prose(rng, 50) + (" " + items[i % 5][1] if i % 4 == 0 else "") + (" awful badword" * 3 if i % 2 else " fine")) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), labels


def test_repeated_documents(spark, tables):
    docs, items, labels = tables
    twice = docs.unionByName(docs)
    assert told(decontaminate.find_contamination(twice, items)) == sorted(told(decontaminate.find_contamination(docs, items)) * 2)
    assert told(decontaminate.drop_contaminated(twice, items)) == sorted(told(decontaminate.drop_contaminated(docs, items)) * 2)
    good = quality.train(docs, labels, ~held_out("doc_id", 3, 1))
    assert told(quality.score_documents(twice, good)) == sorted(told(quality.score_documents(docs, good)) * 2)
    bad = toxicity.train(docs, labels, ~held_out("doc_id", 4, 2))
    assert told(toxicity.score_documents(twice, bad)) == sorted(told(toxicity.score_documents(docs, bad)) * 2)
    assert told(toxicity.drop_toxic(twice, bad, 0.3)) == sorted(told(toxicity.drop_toxic(docs, bad, 0.3)) * 2)


def test_documents_with_extra_columns(spark, tables):
    docs, items, labels = tables
    names = ("item_id", "start_byte", "end_byte", "edits", "score", "spans", "_text", "_k0", "_k1", "label")
    more = with_clashes(docs, *names)
    assert told(decontaminate.find_contamination(more, items)) == told(decontaminate.find_contamination(docs, items))
    kept = decontaminate.drop_contaminated(more, items)
    assert kept.columns == more.columns and told(kept.select("doc_id", "text")) == told(decontaminate.drop_contaminated(docs, items))
    bad = toxicity.train(docs, labels, ~held_out("doc_id", 4, 2))
    assert told(toxicity.score_documents(more, bad)) == told(toxicity.score_documents(docs, bad))
    good = quality.train(docs, labels, ~held_out("doc_id", 3, 1))
    assert told(quality.score_documents(more, good)) == told(quality.score_documents(docs, good))


def test_a_large_benchmark_with_extra_columns(spark, tables, monkeypatch):
    docs, items, _ = tables
    whole = told(decontaminate.drop_contaminated(docs, items))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    more = with_clashes(docs, "_text", "_k0", "_k1")
    assert told(decontaminate.drop_contaminated(more, items).select("doc_id", "text")) == whole
