"""The training-data operators against plain versions and on edge cases."""

import random
import re
import string
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from compare import connect, rows, same
from pyspark.sql import functions as F

from stayflow.llm import ann, components, decontaminate, jaccard, langid, mixing, quality, queries, sharding, suffix_dedup, toxicity, url_filter
from stayflow.llm.common import held_out

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_bytes string, _row int"


def prose(rng, n):
    return " ".join("".join(rng.choice(string.ascii_lowercase[:6]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edge_documents():
    """Copies, near copies, shared passages, repeated lines, empty and null values, repeated rows, names that clash."""
    rng = random.Random(4)
    base = [prose(rng, rng.randint(5, 120)) for _ in range(12)]
    texts = [*base, base[0], base[0], base[1] + " x", "y " + base[2], base[3][: len(base[3]) // 2] + " q " + base[3][len(base[3]) // 2 :]]
    shared = prose(rng, 70)
    texts += [prose(rng, 20) + " " + shared + " " + prose(rng, 10) for _ in range(3)]
    texts += [None, "", "   ", "one", "one two three", "é" * 150 + " ü " + "é" * 150, "ab" * 400, (prose(rng, 60) + "\n") * 4, prose(rng, 3000)]
    out = [(i, t, "en" if i % 3 else None, ["b", "a", None, "é"][i % 4], None if t is None else len(t), "clash", i) for i, t in enumerate(texts)]
    return [*out, out[5]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_documents(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# mixing


def test_targets_are_reshared():
    assert mixing.reshare([100, 100, 100], [3, 1, 2], 450, 2) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.reshare([0, 10], [3, 1], 15, 2) == [0.0, 15.0]


@pytest.mark.parametrize("seed", range(20))
def test_knapsack_is_as_near_as_any_choice(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(0, 30), 4)))
    counts = np.array([rng.randint(0, 3) for _ in lengths])
    budget = rng.randint(0, int((lengths * counts).sum()) + 3)
    sums = {0}
    for x, n in zip(lengths, counts):
        sums = {s + k * int(x) for s in sums for k in range(n + 1)}
    take = mixing.fit_budget(lengths, counts, budget)
    assert (take <= counts).all() and abs(int((take * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_mix_of_all_documents(spark, docs, empty):
    found = mixing.mix_sources(docs).collect()
    assert rows((r["doc_id"], r["size"]) for r in found) == rows((r[0], brute.words(r[1])) for r in edge_documents())
    order = ["a", "b", "é", None]
    size = {s: sum(brute.words(r[1]) for r in edge_documents() if r[3] == s) for s in order}
    target = dict(zip(order, mixing.reshare([size[s] for s in order], [3, 1, 2, 3], 1.5 * sum(size.values()), 2)))
    for s in order:
        mine = [r for r in found if r["source"] == s]
        assert all(r["source_size"] == size[s] and r["target"] == pytest.approx(target[s]) and r["taken"] <= 2 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(r["size"] for r in mine) / 2  # no subset is nearer than this allows
    assert rows(map(tuple, found)) == rows(map(tuple, mixing.mix_sources(docs).collect()))
    assert mixing.mix_sources(empty).count() == 0


def test_taken_rows_keep_their_columns(docs):
    more = docs.withColumn("_id", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    taken = mixing.take_mix(more)
    assert taken.columns == more.columns
    copies = mixing.mix_sources(docs)
    assert taken.count() == copies.agg(F.sum("copies")).first()[0]
    assert rows(map(tuple, taken.select("doc_id").collect())) == rows((r["doc_id"],) for r in copies.collect() for _ in range(r["copies"]))


def test_one_id_in_many_rows_is_mixed_exactly(spark):
    data = [(7, "a b c", "x")] * 90 + [(None, "a b c", "x")] * 30 + [(i, "a b c", "y") for i in range(100, 130)] + [(i, "a " * (i % 5), "z") for i in range(40)]
    d = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix_sources(d).collect()
    assert len(found) == len(data)
    for s in "xyz":
        mine = [r for r in found if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1.5 and {r["copies"] for r in mine} <= {0, 1, 2}
    assert rows(map(tuple, mixing.mix_sources(d.repartition(2)).collect())) == rows(map(tuple, found))


# sharding


def test_shards_fit_and_only_large_buckets_split(spark, docs, empty):
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    found = sharding.assign_shards(many, 3000, keep=many.columns).collect()
    assert len(found) == many.count()
    shards = {}
    for r in found:
        shards.setdefault(r["shard_id"], []).append(r)
    for name, own in shards.items():
        assert sum(r["n_bytes"] for r in own) == own[0]["shard_bytes"] and (own[0]["shard_bytes"] <= 3000 or len(own) == 1)
        assert all(a == name or not a.startswith(name) for a in shards)
        if name and "." not in name:
            inside = sum(r["n_bytes"] for r in found if r["shard_id"].startswith(name[:-1]))
            assert inside > 3000
    assert sharding.assign_shards(empty, 100).count() == 0


def test_equal_ids_are_dealt_into_parts(spark):
    same_id = spark.createDataFrame([(7, "x" * 60)] * 9 + [(None, "y" * 90)] * 2 + [(7, f"{i:030}") for i in range(20)] + [(8, "z" * 500), (9, "")], "doc_id long, text string")
    found = sharding.assign_shards(same_id, 130).collect()
    held = {}
    for r in found:
        held.setdefault(r["shard_id"], []).append(r["n_bytes"])
    assert len(found) == 33 and all(sum(held[r["shard_id"]]) == r["shard_bytes"] for r in found)
    assert all(sum(v) <= 130 or len(v) == 1 for v in held.values()) and [500] in held.values()
    again = sharding.assign_shards(same_id.repartition(3), 130).collect()
    assert rows(map(tuple, again)) == rows(map(tuple, found))


# decontamination


def edit_distance_inside(item, text):
    before = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        now = [i]
        for j, y in enumerate(text, 1):
            now.append(min(before[j - 1] + (x != y), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def test_banded_alignment_equals_full_alignment():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.choice(b"abc") for _ in range(rng.randint(5, 25))]
        text = [rng.choice(b"abc") for _ in range(rng.randint(0, 5))] + [c for c in item if rng.random() > 0.1] + [rng.choice(b"abc") for _ in range(rng.randint(0, 6))]
        most = rng.randint(0, 4)
        want, got = edit_distance_inside(item, text), decontaminate.align(np.array(item, np.uint8), np.array(text, np.uint8), most)
        assert (got[0] if got else None) == (want if want <= most else None)


def windows_of(text):
    """The windows of an item, made independently of the index."""
    kept = bytes(c for c in (text or "").encode().lower() if chr(c).isalnum() and c < 128 or c >= 128)
    return [kept] if len(kept) <= 100 else [kept[i : i + 100] for i in sorted({*range(0, len(kept) - 99, 25), len(kept) - 100})]


def test_contamination_equals_brute_force(spark, docs, empty):
    rng = random.Random(9)
    items = [prose(rng, 12), prose(rng, 30), prose(rng, 90), "short one", None, "", "?!", "x" * 24]
    edited = items[1].replace(" a", " A,", 1)[:-1] + "zz"
    texts = [prose(rng, 30) + items[0].upper() + prose(rng, 5), edited, "x " + items[2][20:] + " y", prose(rng, 200), items[1][:30], None, "", items[0] + "\n" + items[1]]
    texts += ["a SHORT, one!", "ashort one", "short ones", "short  (one) short one", "Short", "x" * 23, "x" * 24, "x" * 40 + " short-one"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame([*enumerate(items), (None, items[0]), (1, items[1])], "item_id long, text string")
    want = {(8, 3), (11, 3), (15, 3)}
    for i, t in enumerate(texts):
        text = decontaminate.compared((t or "").encode())
        for k, x in enumerate(items):
            if any(len(w) >= 24 and edit_distance_inside(list(w), list(text)) <= decontaminate.edits_for(len(w)) for w in windows_of(x)):
                want.add((i, k))
    want |= {(i, None) for i, k in want if k == 0}
    found = decontaminate.find_contamination(d, b).collect()
    assert len(found) == len(want) and {(r["doc_id"], r["item_id"]) for r in found} == want and {(0, 0), (1, 1), (2, 2), (7, 0), (7, 1), (14, 7), (13, 7)} <= want
    first = next(r for r in found if r["doc_id"] == 0)
    assert texts[0].encode()[first["start_byte"] : first["end_byte"]].decode() == items[0].upper()
    third = next(r for r in found if r["doc_id"] == 11)
    assert texts[11].encode()[third["start_byte"] : third["end_byte"]].decode() == "short  (one"
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(d, b).collect()) == sorted(set(range(len(texts))) - {i for i, _ in want})
    assert decontaminate.find_contamination(empty, b).count() == 0 and decontaminate.find_contamination(d, b.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, b).columns == docs.columns


def test_any_long_passage_of_an_item_is_found():
    rng = random.Random(12)
    item = "".join(rng.choice(string.ascii_lowercase) for _ in range(390))
    index = decontaminate.build_index([(5, item)])
    for start in range(390 - 124 + 1):
        text = ("".join(rng.choice(string.ascii_lowercase) for _ in range(50)) + item[start : start + 124] + "q" * 30).encode()
        assert [h[:2] for h in decontaminate.search(index, [b"", text])] == [(1, 5)]


def test_long_texts_of_few_different_grams(monkeypatch):
    items = [(1, "a" * 300), (2, "a" * 40 + "b" + "a" * 40), (3, "ab" * 60), (4, "the quick brown fox jumps over it")]
    index = decontaminate.build_index(items)
    long = b"a" * 2_000_000
    assert decontaminate.search(index, [long]) == [(0, 1, 0, 100, 0), (0, 2, 0, 80, 1)]  # the b is dropped
    late = b"a b" * 500_000 + b" the quick brown fox jumps over it"
    found = {h[1]: h for h in decontaminate.search(index, [b"x", late])}
    assert found[3][4] == 0 and found[4] == (1, 4, 1_500_001, len(late), 0)
    rng = random.Random(3)
    raws = [prose(rng, 400).encode() + b" the quick brown fox JUMPS over it" for _ in range(3)]
    whole = decontaminate.search(index, raws)
    monkeypatch.setattr(decontaminate, "PIECE", 300)
    assert decontaminate.search(index, raws) == whole and len(whole) == 3


# Jaccard join


@pytest.mark.parametrize("words, top", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, docs, words, top):
    texts = {r[0]: r[1] for r in edge_documents()}
    rng = random.Random(2)
    seed = prose(rng, 160).split()
    for i in range(60):  # near copies of all degrees, enough to make signatures frequent
        copy = list(seed)
        for _ in range(i % 9):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(5)}"
        texts[1000 + i] = " ".join(copy)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute.components(texts, words, top, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(d, words, (top, 100)).collect()}
    assert got == want
    kept = jaccard.drop_near_duplicates(d, words, (top, 100)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, (_, c) in want.items() if i == c)


def test_jaccard_edges(spark, docs, empty):
    assert jaccard.join_components(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    assert rows(map(tuple, jaccard.join_components(nulls).collect())) == rows([(None, 2, None), (3, 2, 3), (3, 2, 3)])
    assert rows((r["doc_id"],) for r in jaccard.drop_near_duplicates(nulls).collect()) == rows([(None,), (3,)])
    assert jaccard.drop_near_duplicates(docs).columns == docs.columns


def test_no_text_of_a_repeated_id_loses_its_links(spark):
    rng = random.Random(5)
    seed = prose(rng, 160).split()
    near = {}
    for i in range(80):
        copy = list(seed)
        copy[rng.randrange(len(copy))] = f"w{i}"
        near[i] = " ".join(copy)
    other = [(i, prose(rng, 150)) for i in near]
    want = brute.components(near, 4, 85, 100)
    d = spark.createDataFrame([*other, *near.items()], "doc_id long, text string").coalesce(1)
    got = {}
    for r in jaccard.join_components(d, 4, (85, 100)).collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert got == {i: {c} for i, (_, c) in want.items()} and {c for _, c in want.values()} == {0}


def test_long_chains_are_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(900, 901)], "a long, b long"))
    assert {r["label"] for r in components.components(links).collect()} == {0, 900}


# nearest neighbours


def test_hilbert_keys_are_a_path():
    cells = np.array([(x, y) for x in range(32) for y in range(32)])
    keys = ann.hilbert_key(cells[:, 0], cells[:, 1], 5)
    assert sorted(keys) == list(range(1024)) and np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_search_with_copies_and_broken_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 6)).astype(np.float32)
    x[20:80] = x[0]
    data = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    broken = [(500, None), (520, [0.0] * 6), (540, [float("nan")] + [1.0] * 5), (560, [None] + [1.0] * 5), (580, [1.0]), (None, [1.0] * 6), data[3]]
    t = spark.createDataFrame(data + broken, "vec_id long, embedding array<float>")
    got = ann.search(t, F.col("vec_id") % 20 == 0, k=20).collect()
    s = x.astype(float) @ x.astype(float).T
    for q in range(0, 150, 20):
        order = sorted((i for i in range(150) if i != q), key=lambda i: (-round(s[q, i], 9), i))[:20]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["vec_id"] for r in own] == order and np.allclose([r["score"] for r in own], s[q, order])
    assert {r["query_id"] for r in got} == set(range(0, 150, 20))
    assert ann.search(t.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def nearest(x, queries, k=20):
    """{query: its k nearest other rows}, by brute force in blocks."""
    out = {}
    for q in queries:
        near = -x @ x[q]
        near[q] = np.inf
        out[q] = set(np.argsort(near, kind="stable")[:k].tolist())
    return out


def found_by(t, **how):
    got = {}
    for r in ann.search(t, F.col("vec_id") % 20 == 0, **how).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    return got


def vectors(spark, x):
    items = pa.array(x.ravel())
    return spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], np.int32), items)}))


def test_windows_reach_as_far_as_their_share_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "RUN", 300)
    x = np.random.default_rng(2).normal(size=(2000, 16))
    got = found_by(vectors(spark, x), count=1, used=8, share=2.0)  # all rows to either side, all planes
    assert got == nearest(x, range(0, 2000, 20))


@pytest.mark.parametrize("block, run", [(ann.BLOCK, ann.RUN), (200, 1000)])
def test_recall_on_many_vectors_without_clusters(spark, monkeypatch, block, run):
    """The shipped windows, on vectors that no index can help much with; and with blocks that make a window many blocks, as on large tables."""
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "RUN", run)
    x = np.random.default_rng(8).normal(size=(30_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = found_by(vectors(spark, x))
    want = nearest(x, range(0, 30_000, 200))
    assert len(got) == 1500 and np.mean([len(got[q] & want[q]) for q in want]) / 20 >= 0.93


def test_ties_of_many_go_to_the_smaller_ids(spark):
    x = np.eye(64, dtype=np.float32)[np.arange(64)]
    got = ann.search(vectors(spark, x), F.col("vec_id") % 20 == 0).collect()
    for q in range(0, 64, 20):
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [i for i in range(64) if i != q][:20]


def test_recall_on_the_test_table(spark):
    folder = "/root/testdata/sf0.1"
    t = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = {}
    for r in queries.op6_ann(spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    e = sorted((r["vec_id"], r["embedding"]) for r in t.collect())
    x = np.array([v for _, v in e], float)
    hit = [len(got[q] & {e[i][0] for i in np.argsort(np.where(np.arange(len(e)) == k, 9, -x @ x[k]))[:20]}) for k, (q, _) in enumerate(e) if q % 20 == 0]
    assert np.mean(hit) / 20 >= 0.9


# repeated bytes


def test_removed_bytes_equal_brute_force(spark, docs, empty):
    d = [(r[0], r[1]) for r in edge_documents()]
    d.append((None, d[9][1]))
    found = suffix_dedup.remove_repeats(spark.createDataFrame(d, "doc_id long, text string"))
    assert rows(tuple(r)[:5] for r in found.collect()) == rows(brute.repeats(d))
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_one_row_many_times_and_texts_over_a_piece(spark):
    rng = random.Random(31)
    long, shared = prose(rng, 700), prose(rng, 120)
    d = [(1, long)] * 300 + [(2, shared + " x " + prose(rng, 90)), (3, prose(rng, 90) + shared), (None, long[:900]), (4, "ab" * 900), (5, long + shared)]
    big = prose(rng, 330_000)  # over a MiB, with a copy of the bytes around the first piece's end
    d += [(6, big), (7, "y" * 10 + big[suffix_dedup.PIECE - 400 : suffix_dedup.PIECE + 500])]
    assert len(big) > suffix_dedup.PIECE + 1000
    found = suffix_dedup.remove_repeats(spark.createDataFrame(d, "doc_id long, text string")).collect()
    assert rows(tuple(r)[:5] for r in found) == rows(brute.repeats(d))


def test_pieces_of_long_texts(monkeypatch):
    raw = np.frombuffer((prose(random.Random(3), 900)).encode(), np.uint8)
    first, n, anchor, place = suffix_dedup.runs_of(raw)
    assert n.sum() == len(raw) - 199 and (np.diff(first) == n[:-1]).all() and ((place >= first + n - 1) & (place <= first + 168)).all()
    assert [len(a) for _, a in suffix_dedup.pieces(b"x" * (suffix_dedup.PIECE + 300))] == [suffix_dedup.PIECE + 199, 300]


# classifiers


def labelled(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")


def test_toxicity_on_held_out_documents(spark):
    found = queries.op9_toxicity(spark, "/root/testdata/sf0.1").join(labelled(spark, "labels"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in found) / len(found)
    toxic, called = [r for r in found if r["toxic"]], [r for r in found if r["predicted"]]
    assert right >= 0.95 and all(0 <= r["score"] <= 1 for r in found)
    # about one of eight toxic labels here is on a text without any toxic word
    assert sum(r["predicted"] for r in toxic) / len(toxic) >= 0.8 and sum(r["toxic"] for r in called) / len(called) >= 0.9
    assert any(r["spans"] != "[]" for r in called)


def test_quality_on_held_out_documents(spark):
    found = queries.op4_quality(spark, "/root/testdata/sf0.1").join(labelled(spark, "labels"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) / len(found) >= 0.95


@pytest.mark.parametrize("piece", [2, 3, 64])
def test_marginals_and_pairs_equal_enumeration(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    rng = np.random.default_rng(2)
    tr = rng.normal(size=(2, 2))
    sequences = [rng.normal(size=n) * 3 for n in (1, 4, 8, 0, 3, 7)]
    lengths = np.array([len(e) for e in sequences])
    _, left, right = toxicity.forward_backward(np.concatenate(sequences), lengths, tr)
    begin = np.cumsum(lengths) - lengths
    for e, p, start in zip(sequences, toxicity.marginals(sequences, tr), begin):
        total, on, pairs = 0.0, np.zeros(len(e)), np.zeros((2, 2))
        for code in range(2 ** len(e)):
            tags = [code >> i & 1 for i in range(len(e))]
            w = np.exp(sum(x for x, t in zip(e, tags) if t) + sum(tr[a, b] for a, b in zip(tags, tags[1:])))
            total += w
            on += w * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                pairs[a, b] += w
        assert np.allclose(p, on / total)
        assert np.allclose(toxicity.expected_pairs(left, right, np.arange(start + 1, start + len(e)), tr), pairs / total)


def test_transition_gradient_equals_a_numeric_one():
    rng = np.random.default_rng(4)
    e, tags, tr = rng.normal(size=9), rng.integers(0, 2, 9), rng.normal(size=(2, 2))

    def log_likelihood(tr):
        weight = lambda t: sum(x for x, on in zip(e, t) if on) + sum(tr[a, b] for a, b in zip(t, t[1:]))
        return weight(tags) - np.log(sum(np.exp(weight([c >> i & 1 for i in range(9)])) for c in range(512)))

    _, left, right = toxicity.forward_backward(e, np.array([9]), tr)
    seen = np.bincount(2 * tags[:-1] + tags[1:], minlength=4).reshape(2, 2)
    got = seen - toxicity.expected_pairs(left, right, np.arange(1, 9), tr)
    for a in (0, 1):
        for b in (0, 1):
            step = np.zeros((2, 2))
            step[a, b] = 1e-5
            assert got[a, b] == pytest.approx((log_likelihood(tr + step) - log_likelihood(tr - step)) / 2e-5, abs=1e-6)


def test_one_long_text_and_extreme_weights():
    e = np.random.default_rng(6).normal(size=200_000) * 20
    p, q = toxicity.marginals([e, e[:1000]], np.array([[1.0, -2.0], [-2.0, 1.0]]))
    assert np.isfinite(p).all() and (p >= 0).all() and (p <= 1).all() and np.allclose(p[:900], q[:900])


def test_toxic_spans_and_edges(spark, docs, empty):
    rng = random.Random(5)
    train = [(i, prose(rng, 40) + (f" vilest {prose(rng, 3)} vilest" if i % 2 else "")) for i in range(120)]
    model = toxicity.fit([(i % 2, t) for i, t in train], {0: 60, 1: 60})
    d = spark.createDataFrame([(1, "aa Vilest, bb vilest"), (2, "aa bb"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(d, model).collect()}
    assert got[1]["score"] > 0.5 > got[2]["score"] and got[3]["score"] == got[4]["score"]
    assert [(s["start"], s["end"]) for s in got[1]["spans"]] == [(3, 9), (14, 20)]
    assert toxicity.score_documents(empty, model).count() == 0
    assert toxicity.drop_toxic(docs, model, 0.3).columns == docs.columns
    assert sorted(r["doc_id"] for r in toxicity.drop_toxic(d, model, 0.5).collect()) == [2, 3, 4]
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), ~held_out("doc_id", 4, 2))
    assert {r["score"] for r in toxicity.score_documents(docs, none).collect()} == {0.0}


def test_factorisation_equals_all_pairs(spark, docs, empty):
    rng = np.random.default_rng(3)
    at, x = np.array([3, 7, 11]), np.array([0.5, -1.0, 2.0])
    m = quality.Model(0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    z = 0.3 + m.w[at] @ x + sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert m.score(at, x) == pytest.approx(1 / (1 + np.exp(-z)))
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"), ~held_out("doc_id", 3, 1), metadata=["n_chars"])
    assert {r["score"] for r in quality.score_documents(docs, none, metadata=["n_chars"]).collect()} == {0.5}
    fitted = quality.fit([(i % 2, "word " * (5 + i) if i % 2 else "### " * (5 + i), 5.0) for i in range(40)], {0: 20, 1: 20})
    got = quality.score_documents(docs, fitted, metadata=["n_chars"])
    assert got.count() == docs.count() and all(0 <= r["score"] <= 1 for r in got.collect()) and quality.score_documents(empty, fitted, metadata=["n_chars"]).count() == 0


# language


def test_language_of_pages(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op7_langid(spark, folder).join(labelled_pages(spark, folder), "page_id").collect()
    assert len(found) == 250 and sum(r["lang"] == r["path_lang"] for r in found) >= 0.95 * len(found)


def labelled_pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet").select("page_id", F.regexp_extract("url", r"://[^/]*/(\w\w)/", 1).alias("path_lang"))


def test_language_evidence_and_edges(spark):
    texts = [(i, "the cat and the dog " * 5 if i % 2 else "der hund und die katze " * 5, "en" if i % 2 else "de") for i in range(20)]
    model = langid.fit_text(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    pages = [(i, "http://a.b.de/x", "<html lang=de><body>der hund und die katze</body></html>") for i in range(8)] + [(10, "http://a.b.de/y", ""), (11, None, None), (12, "http://q.com/", "<html lang='en'><p>the cat and the dog</p>"), (12, "http://q.com/", "<html lang='en'><p>the cat and the dog</p>")]
    p = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.identify(p, model).collect()}
    assert len(got) == 11 and got[10]["lang"] == "de" and got[12]["lang"] == "en" and 0 < got[11]["confidence"] <= 1 and got[11]["host"] == ""
    assert langid.identify(p.limit(0), model).count() == 0
    assert langid.identify(p, langid.TextModel([], np.zeros((1, 1)))).where("lang IS NULL").count() == len(pages)
    assert langid.declared_language("<HTML class=x LANG='FR-ca'>") == "fr" and langid.visible_text("<script>a</script>b&amp;<!-- c -->") .split() == ["b&"]


def fused_plainly(pages, model):
    """{page: (lang, confidence)} of (page_id, url, html), step by step with dictionaries."""
    n, k = len(model.languages), langid.KAPPA
    facts = []
    for key, url, page in pages:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        logs = model.log_likelihood(langid.visible_text(page or ""))
        e = np.exp(logs - logs.max())
        parts = host.split(".")
        facts.append((key, host, ".".join(parts[-2:]), parts[-1], langid.declared_language(page or ""), logs, e / e.sum()))

    def sums(i):
        out = {}
        for f in facts:
            out[f[i]] = out.get(f[i], np.zeros(n)) + f[6]
        return out

    def toward(own, up):
        return (own + k * up) / (own.sum() + k)

    hosts, domains, suffixes, declared = (sums(i) for i in (1, 2, 3, 4))
    top = toward(sum(f[6] for f in facts), np.full(n, 1 / n))
    given = lambda table: {key: np.log((v + 1) / (sum(table.values()) + len(table))) for key, v in table.items()}
    of_suffix, of_declared = given(suffixes), given(declared)
    out = {}
    for key, host, domain, suffix, said, logs, _ in facts:
        prior = toward(hosts[host], toward(domains[domain], toward(suffixes[suffix], top)))
        z = logs + np.log(prior) + of_declared[said] + 0.5 * of_suffix[suffix]
        q = np.exp(z - z.max())
        q /= q.sum()
        out[key] = (model.languages[int(q.argmax())], float(q.max()))
    return out


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_fused_evidence_equals_a_plain_version(spark, folder):
    model = langid.fit_text(spark.read.parquet(f"{folder}/documents.parquet"))
    pages = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    want = fused_plainly(pages, model)
    got = {r["page_id"]: (r["lang"], r["confidence"]) for r in queries.op7_langid(spark, folder).collect()}
    assert got.keys() == want.keys() and all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)


def test_text_model_equals_plain_counts(spark):
    docs = [(i, t, la) for i, (t, la) in enumerate([("abcd", "x"), ("abcd abcd", "x"), ("zz", "y"), (None, "y"), ("qq", None), ("", "y")])]
    model = langid.fit_text(spark.createDataFrame([*docs, docs[0]], "doc_id long, text string, lang string"))
    for k, name in enumerate(("x", "y")):
        counts = np.ones(langid.BUCKETS)
        for _, t, la in docs:
            if la == name and t is not None:
                for g in langid.grams(t):
                    counts[g] += 1
        assert np.allclose(model.table[:, k], np.log(counts / counts.sum()), atol=1e-5)


def test_broken_pages_take_linear_time():
    began = time.time()
    for page in ("<" * 400_000, "<!--" * 100_000, "<script>" * 100_000, "<html " * 100_000, "<meta content-language " * 50_000, "<style><script>" * 50_000 + "</style>"):
        langid.visible_text(page), langid.declared_language(page)
    assert time.time() - began < 20
    assert langid.visible_text("a<!-- b --><script>c</script>d<style>e<b>f").split() == ["a", "d", "e", "f"]


def test_long_document_does_not_void_its_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 4000)
    texts = [(i, "the cat and the dog " * 5 if i % 2 else "der hund und die katze " * 5, "en" if i % 2 else "de") for i in range(20)]
    texts = [(100, "x y z " * 900, "en"), *texts]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_text(frame(texts))
    de, en = model.log_likelihood("the cat and the dog")
    assert model.languages == ["de", "en"] and en > de
    again = langid.fit_text(frame(texts[::-1]).repartition(3))
    assert np.array_equal(model.table, again.table)
    only = langid.fit_text(frame([(1, "the cat and the dog " * 900, "en"), *[t for t in texts if t[2] == "de"]]))
    de, en = only.log_likelihood("the cat and the dog")
    assert en > de
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        langid.fit_text(frame(texts))


# urls


def test_urls_by_both_ways_and_edges(spark):
    urls = ["http://WWW.Example.com/en/1", "https://x.example.com/en/2?q", "http://com/", "a.com/x", None, "", "http://", "http://n.net/es/", "http://n.net/ES/", "ftp://net/fr", "http://net/fr/#x", "http://examplexcom/en/", "http://a.com?x://b.net/es/"]
    p = spark.createDataFrame([*enumerate(urls), (None, urls[0])], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    got = url_filter.match_urls(p, rules).collect()
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and by[1] == ("x.example.com", "/en/2", "example.com/en/", "block")
    assert by[3] == ("", "", None, "allow") and by[4] == ("", "", None, "allow") and by[7][2:] == ("net/es/", "block") and by[8][2:] == (None, "allow")
    assert by[12] == ("a.com", "", None, "allow") and by[11] == ("examplexcom", "/en/", None, "allow")
    assert rows(map(tuple, got)) == rows(map(tuple, url_filter.match_urls(p, rules, max_rules=2).collect()))
    assert url_filter.match_urls(p.limit(0), rules).count() == 0 and url_filter.match_urls(p, rules.limit(0), default="block").where("verdict = 'block'").count() == len(urls) + 1


def test_long_hosts_take_no_more_keys_than_rules_have_labels():
    host = "a." * 200_000 + "www.example.com"
    assert url_filter.suffixes(host, 3) == ["com", "example.com", "www.example.com"] and url_filter.suffixes("com", 3) == ["com"] and url_filter.suffixes("a.b", 0) == []


def test_equal_digests_are_told_apart_by_their_strings(tmp_path):
    index = url_filter.Index(np.array([url_filter.xxhash.xxh64_intdigest("a", url_filter.SEED)] * 2, np.uint64), np.array([0, 1, 2], np.uint64), np.zeros(2, np.uint8), np.frombuffer(b"ba", np.uint8), [1], 1, 1)
    assert index.find(["a", "b"]).tolist() == [1, -1]


# long texts and empty tables


def test_every_operator_takes_long_texts(spark):
    rng = random.Random(77)
    long = prose(rng, 500_000) + " "
    texts = [(1, long), (2, long + "end"), (3, "x" * 3_000_000), (4, "short one"), (5, "<" * 1_500_000)]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i, _ in texts], "doc_id long, quality int, toxic int")
    assert {r["component_id"] for r in jaccard.join_components(d).collect()} == {1, 3, 4, 5}
    assert mixing.mix_sources(d).count() == 5 and sharding.assign_shards(d, 1_000_000).count() == 5
    bench = spark.createDataFrame([(9, long[600_000:600_300])], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.find_contamination(d, bench).collect()} == {1, 2}
    model = toxicity.train(d, labels, F.lit(True))
    assert toxicity.score_documents(d, model).count() == 5
    model = quality.train(d, labels, F.lit(True), metadata=["n_chars"])
    assert quality.score_documents(d, model, metadata=["n_chars"]).count() == 5
    pages = d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://"), "text").alias("url"), F.col("text").alias("html"))
    assert langid.identify(pages, langid.fit_text(d)).where("lang = 'en'").count() == 5
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    assert url_filter.match_urls(pages, rules).count() == 5


def test_empty_tables_all_the_way(spark, empty, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(empty, toxicity.train(empty, labels, F.lit(True))).count() == 0
    assert quality.score_documents(empty, quality.train(empty, labels, F.lit(True))).count() == 0
    assert langid.fit_text(empty).languages == [] and mixing.take_mix(empty).count() == 0 and jaccard.drop_near_duplicates(empty).count() == 0
    import corpus_pipeline as P

    empty.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


# registry and pipeline


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same(queries.queries()[name](spark, FOLDER), connect(FOLDER), queries.oracle_sql()[name])


def test_pipeline_equals_its_stages_done_plainly(spark):
    import corpus_pipeline as P

    folder = FOLDER
    result = P.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = {r["doc_id"]: r["text"] for r in P.drop_toxic(spark, docs, folder).collect()}
    scores = {r["doc_id"]: r["predicted"] for r in queries.op9_toxicity(spark, folder).collect()}
    assert set(clean) == {i for i, p in scores.items() if not p}
    unique = {i: clean[i] for i, (_, c) in brute.components(clean, 5, 80, 100).items() if i == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    ids = sorted(unique)
    bad = {ids[h[0]] for h in decontaminate.search(decontaminate.build_index(items), [unique[i].encode() for i in ids])}
    left = spark.createDataFrame([(i, unique[i], "x") for i in ids if i not in bad], "doc_id long, text string, source string").drop("source").join(docs.select("doc_id", "source"), "doc_id")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(left).collect() if r["copies"]}
    assert rows((r["doc_id"],) for r in result) == rows((i,) for i, n in copies.items() for _ in range(n))
    assert set(docs.columns) < set(result[0].asDict()) and {name for name, _ in P.STAGES} == {"toxicity", "near_duplicates", "decontamination", "mixing", "sharding"}
