"""Phrase collocation mining by Toivonen's sampling: exact counts of frequent phrases, scored by their weakest cut.

1. Every word of every language is counted over all texts; a word's 64-bit hash stands for it from then on, after a check that no two
   words of the corpus share one (else the next seed is taken).
2. A sample of the texts (one of `SAMPLE_OF` by hash) proposes phrases: those that reach a lowered count there.
3. A full pass counts proposals and their negative border exactly: every phrase whose parts without the last and without the first
   word are both proposed (of single words: frequent), be it proposed itself or not.
4. A frequent phrase of the border that the sample missed is a border failure. Failures become proposals, and another pass counts
   what they newly allow, until none fails. Each phrase is counted in one pass only.

Proposals travel as bitmaps of a fixed size (`BITS`); a false hit has an infrequent phrase counted in vain and changes no result. Counts
are added up in each task over blocks of texts before they are shuffled, so a phrase that is everywhere costs a row a block.

Defined cases: null and empty texts hold nothing; a null language is `und`; rows that are alike count each; words are bytes, so invalid
UTF-8 does no harm; other columns of any name are left out; empty tables give no rows; equal scores go by count, then by the
phrase's bytes. Counts may reach 10^15; products are decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard, small_batches

#: One of so many texts is in the sample, and the share of the expected count that a phrase needs there.
SAMPLE_OF, LOWERED = 4, 0.8
#: Bits of a bitmap of proposals.
BITS = 2**26
#: Words, and distinct words, of a block of texts.
BLOCK_WORDS, BLOCK_DISTINCT = 1_000_000, 300_000
#: Rows of an Arrow batch of counts.
ROWS = 100_000
#: Parts of a language whose best rows are found on their own first.
PARTS = 64

# What parts pieces, and white space between words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
BREAK = b","
TABLE = bytes(ord(BREAK) if b in PIECE_ENDS else 32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Words of the longest phrase; the columns of a phrase's word hashes (0 where it has none).
LONGEST = 3
HASHES = [f"h{i}" for i in range(1, LONGEST + 1)]


def words_of(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a text in order, with BREAK between pieces."""
    return (text or b"").translate(TABLE).replace(BREAK, b" " + BREAK + b" ").split()


class Numbers(dict):
    """Numbers of a language's words in a block; BREAK has 0."""

    def __init__(self, lang: str, all_words: list[tuple[str, bytes]]):
        super().__init__({BREAK: 0})
        self.lang, self.all_words = lang, all_words

    def __missing__(self, word: bytes) -> int:
        self.all_words.append((self.lang, word))
        self[word] = n = len(self.all_words)
        return n


def blocks(batches: Iterator[pa.RecordBatch], most: tuple[int, int]) -> Iterator[tuple[list[tuple[str, bytes]], np.ndarray]]:
    """The words of a block of (language, text) rows, and its texts as their numbers from 1, with 0 where a piece or text ends.

    most: words, and distinct words, from which on a block ends.
    """
    all_words, langs, parts, size = [], {}, [], 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = words_of(text)
            if lang not in langs:
                langs[lang] = Numbers(lang, all_words)
            words.append(BREAK)
            parts.append(np.fromiter(map(langs[lang].__getitem__, words), np.int64, len(words)))
            size += len(words)
            if size >= most[0] or len(all_words) >= most[1]:
                yield all_words, np.concatenate(parts)
                all_words, langs, parts, size = [], {}, [], 0
    if parts:
        yield all_words, np.concatenate(parts)


def word_hashes(words: list[tuple[str, bytes]], seed: int) -> np.ndarray:
    """Signed 64-bit hashes of (language, word), never 0; [0] is for a break."""
    out = [0] + [xxhash.xxh3_64_intdigest(b"%d:%b%b" % (len(lang.encode()), lang.encode(), w), seed) or 1 for lang, w in words]
    return np.array(out, np.uint64).view(np.int64)


def folded(hashes: list[np.ndarray]) -> np.ndarray:
    """One number of a phrase's word hashes, by which it is looked up in a bitmap."""
    out = hashes[0].view(np.uint64)
    for h in hashes[1:]:
        out = ((out << np.uint64(21)) | (out >> np.uint64(43))) ^ h.view(np.uint64)
    return out


def folded_column(columns: list[str]) -> Column:
    """`folded` as an expression."""
    out = F.col(columns[0])
    for c in columns[1:]:
        out = F.shiftleft(out, 21).bitwiseOR(F.shiftrightunsigned(out, 43)).bitwiseXOR(F.col(c))
    return out


def bitmap(phrases: DataFrame, words: int) -> np.ndarray:
    """The bitmap of the phrases of that many words; a row of 64 bits at most for each of BITS / 64 places comes to the driver."""
    at = folded_column(HASHES[:words]).bitwiseAND(F.lit(BITS - 1))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    rows = phrases.where(_length() == words).select(at.alias("at")).select(F.shiftright("at", 6).alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return out


def _holds(bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    code = code & np.uint64(64 * len(bits) - 1)
    return (bits.view(np.uint64)[(code >> np.uint64(6)).astype(np.int64)] >> (code & np.uint64(63))) & np.uint64(1) != 0


def _length() -> Column:
    return sum((F.when(F.col(h) != 0, 1).otherwise(0) for h in HASHES), F.lit(0))


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """lang, word, h1 and n of every word of (lang, text)."""

    most = BLOCK_WORDS, BLOCK_DISTINCT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, x in blocks(batches, most):
            n, h = np.bincount(x, minlength=len(words) + 1)[1:], word_hashes(words, seed)[1:]
            for a in range(0, len(words), ROWS):
                part = words[a : a + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in part], pa.string()), pa.array([w[1] for w in part], pa.binary()), pa.array(h[a : a + ROWS]), pa.array(n[a : a + ROWS])], names=["lang", "word", "h1", "n"])

    return texts.mapInArrow(run, "lang string, word binary, h1 long, n long").groupBy("lang", "word", "h1").agg(F.sum("n").alias("n"))


def count_phrases(texts: DataFrame, seed: int, known: dict[int, np.ndarray], before: dict[int, np.ndarray], longest: int = LONGEST) -> DataFrame:
    """h1, h2, h3 and n of phrases of two words and more whose two parts shorter by a word are both in ``known`` and not both in ``before``.

    Both hold bitmaps by the number of words; a length that ``known`` does not hold is not extended, one that ``before`` does not hold is new.
    """
    shared, most = texts.sparkSession.sparkContext.broadcast((known, before)), (BLOCK_WORDS, BLOCK_DISTINCT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, before = shared.value
        for words, x in blocks(batches, most):
            h, base = word_hashes(words, seed), len(words) + 1
            ended = np.concatenate([x, np.zeros(longest - 1, np.int64)])
            at = [ended[k : k + len(x)] for k in range(longest)]
            for size in range(2, longest + 1):
                if size - 1 not in known:
                    continue
                whole = np.flatnonzero(np.logical_and.reduce([a > 0 for a in at[:size]]))
                first, last = (folded([h[a[whole]] for a in part]) for part in (at[: size - 1], at[1:size]))
                chosen = _holds(known[size - 1], first) & _holds(known[size - 1], last)
                if size - 1 in before:
                    chosen &= ~(_holds(before[size - 1], first) & _holds(before[size - 1], last))
                whole = whole[chosen]
                code = at[0][whole]
                for a in at[1:size]:
                    code = code * base + a[whole]
                code, n = np.unique(code, return_counts=True)
                columns = []
                for _ in range(size):
                    code, word = np.divmod(code, base)
                    columns.insert(0, h[word])
                columns += [np.zeros(len(n), np.int64)] * (LONGEST - size)
                for a in range(0, len(n), ROWS):
                    yield pa.RecordBatch.from_arrays([*[pa.array(c[a : a + ROWS]) for c in columns], pa.array(n[a : a + ROWS])], names=[*HASHES, "n"])

    return texts.mapInArrow(run, "h1 long, h2 long, h3 long, n long").groupBy(*HASHES).agg(F.sum("n").alias("n"))


def frequent_words(texts: DataFrame, least: int, seeds: int = 4) -> tuple[DataFrame, DataFrame, int]:
    """The words of at least ``least`` occurrences, each language's number of words, and the seed of the hashes, which are one to one."""
    for seed in range(seeds):
        words = cut(count_words(texts, seed), "collocations-words")
        if words.groupBy("h1").count().where("count > 1").isEmpty():
            frequent = cut(words.where(F.col("n") >= least).select("*", *[F.lit(0).cast("long").alias(h) for h in HASHES[1:]]), "collocations-frequent")
            totals = cut(words.groupBy("lang").agg(F.sum("n").alias("total")), "collocations-totals")
            discard(words)
            return frequent, totals, seed
        discard(words)
    raise ValueError("two words share a hash under every seed")


def frequent_phrases(texts: DataFrame, words: DataFrame, seed: int, least: int, sample_of: int = SAMPLE_OF) -> DataFrame:
    """h1, h2, h3, n of all phrases of 2 to LONGEST words with at least ``least`` occurrences."""
    known = {1: bitmap(words, 1)}
    lowered = max(1, int(least / sample_of * LOWERED))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(sample_of)) == 0)
    for size in range(2, LONGEST):
        seen = count_phrases(sample, seed, {size - 1: known[size - 1]}, {}, size).where((F.col("n") >= lowered) & (_length() == size))
        known[size] = bitmap(seen, size)
    found, new_at, before = None, dict(known), {}
    while True:
        new = cut(count_phrases(texts, seed, new_at, before).where(F.col("n") >= least), "collocations-phrases")
        found = new if found is None else found.unionByName(new)
        failed = {size: bits for size in range(2, LONGEST) if (bits := bitmap(new, size) & ~known[size]).any()}
        if not failed:
            return found
        before = {size: known[size] for size in failed}
        known |= {size: known[size] | bits for size, bits in failed.items()}
        new_at = {size: known[size] for size in failed}


def scored(phrases: DataFrame, words: DataFrame, cover: tuple[int, int]) -> DataFrame:
    """lang, phrase, a, l, r and score of the phrases that no longer one covers by ``cover`` (a share: part, whole)."""
    spelled = lambda i: words.select(F.col("h1").alias(f"h{i}"), F.col("n").alias(f"n{i}"), F.col("word").alias(f"w{i}"), F.col("lang").alias(f"lang{i}"))
    pairs, triples = (phrases.where(_length() == k).withColumnRenamed("n", "a") for k in (2, 3))
    part = lambda a, b, n: phrases.where(_length() == 2).select(F.col("h1").alias(f"h{a}"), F.col("h2").alias(f"h{b}"), F.col("n").alias(n))
    inside = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a")).groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    kept = pairs.join(inside, ["h1", "h2"], "left").where(F.coalesce(cover[1] * F.col("longer") < cover[0] * F.col("a"), F.lit(True)))
    kept = kept.join(spelled(1), "h1").join(spelled(2), "h2")
    a = F.col("a").cast("decimal(18,0)")
    fit = lambda l, r: F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), F.col(l).cast("decimal(18,0)") * F.col(r).cast("decimal(18,0)"))
    two = kept.select("lang1", F.concat_ws(" ", F.col("w1").cast("string"), F.col("w2").cast("string")).alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"), fit("n1", "n2").alias("score"))
    longer = triples.join(part(1, 2, "n12"), ["h1", "h2"]).join(part(2, 3, "n23"), ["h2", "h3"]).join(spelled(1), "h1").join(spelled(2).drop("n2", "lang2"), "h2").join(spelled(3), "h3")
    longer = longer.withColumns({"s1": fit("n1", "n23"), "s2": fit("n12", "n3")})
    late = F.col("s2") < F.col("s1")
    three = longer.select("lang1", F.concat_ws(" ", *[F.col(f"w{i}").cast("string") for i in (1, 2, 3)]).alias("phrase"), "a", F.when(late, F.col("n12")).otherwise(F.col("n1")).alias("l"), F.when(late, F.col("n3")).otherwise(F.col("n23")).alias("r"), F.least("s1", "s2").alias("score"))
    return two.unionByName(three).withColumnRenamed("lang1", "lang")


def mine(docs: DataFrame, least: int = 10, top: int = 2000, cover: tuple[int, int] = (50, 100), lang: str = "lang", text: str = "text", sample_of: int = SAMPLE_OF) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of two to three words with at least ``least`` occurrences."""
    texts = small_batches(docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")))
    words, totals, seed = frequent_words(texts, least)
    found = scored(frequent_phrases(texts, words, seed, least, sample_of), words, cover)
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("_part")
    first = found.select("*", part).withColumn("_nth", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).where(F.col("_nth") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
