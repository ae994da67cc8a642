"""SentencePiece encoding by distinct words against the library on whole texts."""

import hashlib
import random
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from test_llm_operators import SCHEMA, edge_documents

from stayflow.llm import pieces, queries

FOLDER = "/root/testdata/sf0.001"
MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
PARTS = [b" ", b" ", b"a", b"th", b"the", b"\xe2\x96\x81", "é".encode(), b"\xe2", b"\x96", b"\n", b"\t", b"\x00", b"12", b"<s>", b"<0x41>", "漢字".encode(), b"\xff", "🎉".encode(), "́".encode(), "　".encode()]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def test_words_and_their_ids_are_those_of_the_whole_text(library):
    rng = random.Random(1)
    for _ in range(3000):
        text = b"".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        made, texts = pieces.segment(library, pieces.words_of(text))
        want = library.encode(text)
        assert [i for ids in made for i in ids] == want, text
        assert b" ".join(texts).decode("utf-8", "replace") == library.decode(want), text


@pytest.mark.parametrize("head_words", [pieces.HEAD_WORDS, 3, 0])
def test_encoding_equals_the_library(spark, library, head_words):
    rows = [*edge_documents(), (90, " a  b ", *[None] * 5), (91, "▁▁", *[None] * 5), (None, "no id", *[None] * 5), (None, "no id", *[None] * 5), (92, "x" * 30000, *[None] * 5), (93, "a " * 20000, *[None] * 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in pieces.encode(docs, MODEL, head_words=head_words).collect())
    want = sorted((str(r[0]), ids := library.encode(r[1] or ""), library.decode(ids)) for r in rows)
    assert got == want


def test_texts_that_are_not_utf8(spark, library):
    raw = [b"ab\xff \xe2\x96 c", b"\xe2", b" \xf0\x9f\x8e"]
    docs = spark.createDataFrame(list(enumerate(raw)), "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) text")
    for head_words in (100, 0):
        got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in pieces.encode(docs, MODEL, head_words=head_words).collect()}
        assert got == {n: (ids := library.encode(t), library.decode(ids)) for n, t in enumerate(raw)}


def test_empty_table_decoding_and_other_names(spark, library):
    docs = spark.createDataFrame([("k", "two words", 1)], "key string, body string, word int")
    made = pieces.encode(docs, MODEL, doc_id="key", text="body", head_words=1)
    assert [tuple(r) for r in made.collect()] == [("k", library.encode("two words"), "two words")]
    assert pieces.encode(docs.limit(0), MODEL, doc_id="key", text="body").collect() == []
    back = pieces.decode(made.select("ids").unionByName(spark.createDataFrame([(None,)], "ids array<int>")), MODEL)
    assert [r["decoded"] for r in back.collect()] == ["two words", ""]


def test_query_equals_the_library_on_whole_documents(spark, library):
    want = {}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[r["doc_id"]] = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
    assert {r[0]: tuple(r)[1:] for r in queries.op11_sentencepiece(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want
