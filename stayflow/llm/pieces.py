"""SentencePiece encoding and decoding: each distinct marked word is segmented once and its ids join back by position.

A model whose pieces never hold a white space marker after another character can't merge across the start of a marked word, so
a text is the sequence of its marked words and each distinct one needs one segmentation. The corpus is read three times:

1. words are counted in each task, then over all tasks, and each distinct word is segmented and decoded (`word_table`);
2. words below the frequent ones (`HEAD_WORDS`, a fixed bound that is broadcast) are joined with the table by a row for each
   (document, place among its rare words), and come back as one row a document;
3. compressed documents meet the row of their own rare words, sorted before them, and put the ids of all words in the order of the text.

If no word is rare, the last two are one pass without a shuffle.

Defined cases: a null or empty text has no ids and an empty decoded text; bytes that are not UTF-8 are encoded as the library does
it (U+FFFD for each); rows that are alike each have a row; other columns of any name are left out; an empty table gives no rows;
long texts are encoded whole, and memory is bounded by one text besides the broadcast words. A model that can merge across markers,
or that rewrites texts before it segments them, raises.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, discard, small_batches

#: White space marker of the pieces, as text and as bytes.
MARK = "▁"
MARK_BYTES = MARK.encode()

#: Words that are broadcast at most, and their bytes with those of their ids.
HEAD_WORDS, HEAD_BYTES = 2**19, 48 * 2**20

#: Words and bytes that a task counts before it hands them on.
FLUSH_WORDS, FLUSH_BYTES = 400_000, 32 * 2**20

KEYED = (pa.int64(), pa.int64(), pa.binary())

_HEADS: dict[str, dict[bytes, tuple]] = {}


def processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> sentencepiece.SentencePieceProcessor:
    """The model's processor, if words can be segmented on their own."""
    sp = processor(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("pieces cross white space markers, so words can't be segmented one by one")
    probe = "  AÅ ﬁ　½  "
    if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError("the model rewrites texts before it segments them")
    return sp


def words_of(text: bytes) -> list[bytes]:
    """The marked words of a text, each without its first marker: what stands after a space, with further spaces before it."""
    if not text:
        return []
    text = text.replace(MARK_BYTES, b" ")
    if b"  " in text or text[:1] == b" " or text[-1:] == b" ":
        return [w[1:] for w in re.findall(rb" +[^ ]*", b" " + text)]
    return text.split(b" ")


def segment(sp: sentencepiece.SentencePieceProcessor, words: list[bytes]) -> tuple[list[list[int]], list[bytes]]:
    """Ids of marked words, given without their first markers, and the texts of those ids without it."""
    ids = [i or [sp.piece_to_id(MARK)] for i in sp.encode(words, num_threads=1)]  # the processor adds that marker, but not to an empty text
    return ids, [d.encode() for d in sp.decode(ids, num_threads=1)]


def _id_type(model: bytes) -> str:
    return "<u2" if processor(model).get_piece_size() <= 2**16 else "<u4"


def word_table(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """word, n, ids (packed) and decoded (null if it is the word itself) of every distinct marked word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        size = 0
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(words_of(t or b""))
                size += len(t or b"")
                if len(seen) >= FLUSH_WORDS or size >= FLUSH_BYTES and sum(map(len, seen)) >= FLUSH_BYTES:
                    yield told(seen)
                    seen, size = Counter(), 0
        yield told(seen)

    def told(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    shared, kind = docs.sparkSession.sparkContext.broadcast(model), _id_type(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(shared.value)
        for b in batches:
            words = b.column(0).to_pylist()
            made, texts = segment(sp, words)
            ids = [np.array(i, kind).tobytes() for i in made]
            odd = [None if d == w else d for w, d in zip(words, texts)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary()), pa.array(odd, pa.binary())], names=["word", "n", "ids", "decoded"])

    counted = small_batches(docs.select(F.col(text).cast("binary").alias("text"))).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(encode, "word binary, n long, ids binary, decoded binary")


def _head(table: DataFrame, most: int) -> tuple[Column, list[tuple]]:
    """The condition for a word of ``table`` to be frequent, and those words: at most ``most`` and HEAD_BYTES."""
    size = F.octet_length("word") + F.octet_length("ids") + F.coalesce(F.octet_length("decoded"), F.lit(0))
    level = F.least(F.col("n"), F.lit(2**20))  # so there are few levels
    rows = table.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum(size).alias("bytes")).orderBy(F.desc("level")).toLocalIterator()
    least, words, used = 2**62, 0, 0
    for r in rows:
        words, used = words + r["words"], used + r["bytes"]
        if words > most or used > HEAD_BYTES:
            break
        least = r["level"]
    frequent = level >= least
    return frequent, [tuple(r) for r in table.where(frequent).select("word", "ids", "decoded").toArrow().to_pandas().itertuples(index=False)]


def _known(token: str, head: list[tuple]) -> dict[bytes, tuple]:
    """The broadcast words as a mapping, made once in a worker."""
    if token not in _HEADS:
        _HEADS.clear()
        _HEADS[token] = {w: (ids, None if d is None else bytes(d)) for w, ids, d in head}
    return _HEADS[token]


def _assemble(words: list[bytes], known: Callable, kind: str) -> tuple[np.ndarray, str]:
    """Ids and decoded text of a text's words in their order."""
    parts = [known(w) for w in words]
    ids = np.frombuffer(b"".join([p[0] for p in parts]), kind)
    return ids, b" ".join([w if p[1] is None else p[1] for w, p in zip(words, parts)]).decode("utf-8", "replace")


def _rare(words: list[bytes], known: dict[bytes, tuple]) -> list[bytes]:
    """The distinct words that are not broadcast, in the order of their first places."""
    return list(dict.fromkeys(w for w in words if w not in known))


def _rows(name: str, doc_ids: list, id_type: pa.DataType, made: list[tuple[np.ndarray, str]]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in made])]).astype(np.int32)
    flat = np.concatenate([ids for ids, _ in made]).astype(np.int32) if made else np.zeros(0, np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, id_type), ids, pa.array([d for _, d in made], pa.string())], names=[name, "ids", "decoded"])


def encode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, ids (array of int) and decoded (text) of each row of ``docs``, in no given order."""
    check_model(model)
    context, kind, token = docs.sparkSession.sparkContext, _id_type(model), uuid.uuid4().hex
    table = cut(word_table(docs, model, text), "pieces-words", "zstd")
    frequent, head = _head(table, head_words)
    shared = context.broadcast(head)
    id_kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {id_kind}, ids array<int>, decoded string"
    # two hashes of id and text name a document; rows that are alike share their rare words' row
    keys = [F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), text).alias(name) for seed, name in ((1, "k1"), (2, "k2"))]
    narrow = docs.select(*keys, F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(token, shared.value)
        for b in batches:
            yield _rows(doc_id, b.column(2).to_pylist(), b.schema.field(2).type, [_assemble(words_of(t), known.__getitem__, kind) for t in b.column(3).to_pylist()])

    rare = table.where(~frequent)
    if rare.isEmpty():
        discard(table)
        return small_batches(narrow).mapInArrow(whole, schema)

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(token, shared.value)
        for b in batches:
            at, nth, found = [], [], []
            for i, t in enumerate(b.column(3).to_pylist()):
                mine = _rare(words_of(t), known)
                at += [i] * len(mine)
                nth += range(len(mine))
                found += mine
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(nth, pa.int32()), pa.array(found, pa.binary())], names=["k1", "k2", "nth", "word"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segmentations of each document's rare words in their order, in one row."""
        names = ["k1", "k2", "text"]
        now, own = None, {}
        for b in batches:
            done = []
            for k1, k2, n, ids, odd in zip(*[c.to_pylist() for c in b.columns]):
                if (k1, k2) != now:
                    done += [(*now, pickle.dumps(list(own.values())))] if now else []
                    now, own = (k1, k2), {}
                own[n] = (ids, odd)  # rows that are alike bring theirs several times
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), KEYED)], names=names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*now, pickle.dumps(list(own.values()))), KEYED)], names=names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([press.compress(t) for t in b.column(3).to_pylist()], pa.binary())], names=["k1", "k2", "doc_id", "text"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, unpress = _known(token, shared.value), zstandard.ZstdDecompressor()
        now, own = None, []
        for b in batches:
            made, ids = [], []
            for k1, k2, is_text, d, t in zip(*[c.to_pylist() for c in b.columns]):
                if not is_text:
                    now, own = (k1, k2), pickle.loads(t)
                    continue
                words = words_of(unpress.decompress(t))
                mine = dict(zip(_rare(words, known), own if now == (k1, k2) else []))
                ids.append(d)
                made.append(_assemble(words, lambda w, mine=mine: known.get(w) or mine[w], kind))
            if made:
                yield _rows(doc_id, ids, b.schema.field(3).type, made)

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = small_batches(narrow).mapInArrow(rare_words, "k1 long, k2 long, nth int, word binary")
    joined = cut(pairs.join(rare.select("word", "ids", "decoded"), "word").select("k1", "k2", "nth", "ids", "decoded"), "pieces-joined", "zstd")
    discard(table)
    sorted_ = joined.repartition(partitions, "k1").sortWithinPartitions("k1", "k2", "nth")
    lists = cut(sorted_.mapInArrow(listed, "k1 long, k2 long, text binary"), "pieces-rare", "zstd")
    discard(joined)
    lists = lists.select("k1", "k2", F.lit(False).alias("is_text"), F.lit(None).cast(id_kind).alias("doc_id"), "text")
    texts = small_batches(narrow).mapInArrow(packed, f"k1 long, k2 long, doc_id {id_kind}, text binary").select("k1", "k2", F.lit(True).alias("is_text"), "doc_id", "text")
    met = lists.unionByName(texts).repartition(partitions, "k1").sortWithinPartitions("k1", "k2", "is_text")
    return small_batches(met).mapInArrow(placed, schema)


def decode(ids: DataFrame, model: bytes, column: str = "ids", to: str = "decoded") -> DataFrame:
    """``ids`` with the text of each array of ids; a null array has the empty text."""
    shared = ids.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(shared.value)
        for b in batches:
            at = b.schema.get_field_index(column)
            texts = [sp.decode(i or []) for i in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, to])

    return small_batches(ids).mapInArrow(run, T.StructType([*ids.schema.fields, T.StructField(to, T.StringType())]))
