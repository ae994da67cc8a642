"""Language ID of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in each page's posterior: the likelihood of its visible text (naive Bayes over the byte 3- and
4-grams of lower-cased text, tempered, as grams overlap), the language its markup declares, its address suffix, and a prior of
its host. What a declaration or a suffix says about a language, and the host priors, are grouped sums over all pages of the
posterior from text alone; a host's prior is smoothed towards its domain's, that towards its suffix's, and that towards all
pages' (``KAPPA`` pseudo-pages at each step), so a host with few pages borrows strength.

The text model is fitted on a bounded sample of documents with a known language (``ROWS_PER_LANGUAGE``, ``SAMPLE_BYTES``);
everything else is a grouped aggregation. The tables of declarations, suffixes and hosts are joined back, by broadcast only
when counted small; hosts are pre-aggregated, so a host with a third of all pages is one row of its table.

Every language with a document is known, up to ``MAX_LANGUAGES`` (more raise).

Defined cases: a null or empty page has no text evidence and gets what its other evidence says; a null url has the host "";
an undeclared language is a declaration of its own; ties go to the language first in code point order; without any
known language the result has a null lang; repeated rows are judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, small_enough, texts_of
from .url_filter import host_of

ROWS_PER_LANGUAGE, SAMPLE_BYTES, MAX_LANGUAGES = 1500, 24_000_000, 200
BUCKETS = 1 << 16
#: Grams overlap and repeat, so each counts as this share of an independent one.
TEMPER = 0.05
KAPPA = 20.0

OPENED = re.compile(r"(?i)<!--|<(script|style|noscript|template)\b")
CLOSED = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript", "template")} | {"": re.compile("-->")}
TAG = re.compile(r"<[^<>]*>")
#: Attributes are looked for in the first 2,000 characters of a tag, so that a page of unclosed tags takes no longer than another.
DECLARED = re.compile(r"(?i)<html\b[^<>]{0,2000}?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b|<meta\b[^<>]{0,2000}?content-language[^<>]{0,200}?content\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def visible_text(page: str) -> str:
    """The page without comments, hidden elements and tags; what is opened and never closed stays text. One pass."""
    out, at, look, endless = [], 0, 0, set()
    while m := OPENED.search(page, look):
        look = m.end()
        kind = (m[1] or "").lower()
        if kind in endless:
            continue
        if end := CLOSED[kind].search(page, m.end()):
            out.append(page[at : m.start()])
            at = look = end.end()
        else:
            endless.add(kind)
    out.append(page[at:])
    return html.unescape(TAG.sub(" ", " ".join(out)))


def declared_language(page: str) -> str:
    m = DECLARED.search(page)
    return (m[1] or m[2]).lower() if m else ""


def grams(text: str) -> np.ndarray:
    """The bucket of each 3- and 4-gram of bytes, white space runs being one space."""
    raw = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    three = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    four = three[:-1] ^ raw[3:] << 24
    mixed = np.concatenate((three * np.uint32(2654435761), four * np.uint32(2246822519)))
    return (mixed >> np.uint32(16)).astype(np.int64)


@dataclass
class TextModel:
    languages: list[str]
    #: log likelihood of each bucket under each language
    table: np.ndarray

    def log_likelihood(self, text: str) -> np.ndarray:
        at = grams(text)
        if not len(at) or not self.languages:
            return np.zeros(len(self.languages))
        return TEMPER * np.bincount(at, minlength=BUCKETS)[np.unique(at)] @ self.table[np.unique(at)]


def fit_text(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> TextModel:
    """Naive Bayes from a bounded sample: of each language the first different (id, text) in the order of their hashes.

    A document that does not fit in what is left of its language's bytes is passed over; if none fits, the first one's start is taken.
    More than ``MAX_LANGUAGES`` languages raise, as the table has a column for each.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    hashed = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string")).alias("_h"), F.xxhash64(text).alias("_t"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "_t"))
    ids = cut(hashed.select("lang", "_h", "_t").distinct().withColumn("_nth", nth).where(F.col("_nth") <= ROWS_PER_LANGUAGE), "lang-sample")
    languages = sorted(r[0] for r in ids.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.ones((BUCKETS, max(1, len(languages))))
    most = SAMPLE_BYTES // max(1, len(languages))
    # of a text that can't fit only the start can be of use
    picked = hashed.join(F.broadcast(ids.drop("_nth")), ["lang", "_h", "_t"], "left_semi").dropDuplicates(["lang", "_h", "_t"])  # bounded: the rows of MAX_LANGUAGES
    picked = picked.select("lang", "_h", "_t", F.octet_length("text").alias("size"), F.when(F.octet_length("text") <= most, F.col("text")).otherwise(F.substring("text", 1, most)).alias("text"))
    used, start = dict.fromkeys(languages, 0), dict.fromkeys(languages, "")
    for r in picked.orderBy("lang", "_h", "_t").toLocalIterator():
        name = r["lang"]
        if used[name] + r["size"] > most:
            start[name] = start[name] or r["text"].encode()[:most].decode("utf-8", "ignore")
            continue
        used[name] += r["size"]
        counts[:, languages.index(name)] += np.bincount(grams(r["text"]), minlength=BUCKETS)
    for k, name in enumerate(languages):
        if not used[name]:
            counts[:, k] += np.bincount(grams(start[name]), minlength=BUCKETS)
    return TextModel(languages, np.log(counts / counts.sum(0)).astype(np.float32))


def read_pages(pages: DataFrame, model: TextModel, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, host, declared and the log likelihood of the visible text under each language."""
    kind = pages.schema[key].dataType.simpleString()
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                found = [p or "" for p in texts_of(b.column(2))]
                logs = [model.log_likelihood(visible_text(p)).tolist() for p in found]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([declared_language(p) for p in found], pa.string()), pa.array(logs, pa.list_(pa.float64()))], names=[key, "host", "declared", "_text"])

    return small_batches(pages.select(key, F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"), page)).mapInArrow(run, f"`{key}` {kind}, host string, declared string, _text array<double>")


def _normal(logs: Column) -> Column:
    """Probabilities from log weights."""
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int) -> list[Column]:
    return [F.sum(F.get("_p", F.lit(i))).alias(f"_{i}") for i in range(n)]


def _table(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys and the summed posterior of each language."""
    return df.groupBy(*keys).agg(*_sums(n)).select(*keys, F.array(*[f"_{i}" for i in range(n)]).alias("_n"))


def _toward(own: str, prior: str) -> Column:
    """A level's shares, smoothed towards the level above."""
    total = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(own, prior, lambda x, q: (x + KAPPA * q) / (total + KAPPA))


def _given_language(table: DataFrame, key: str, n: int) -> DataFrame:
    """log P(key | language), add-one smoothed over the keys seen."""
    size = table.count()
    all_ = table.agg(*[F.sum(F.get("_n", F.lit(i))).alias(f"_{i}") for i in range(n)]).select(F.array(*[f"_{i}" for i in range(n)]).alias("_all"))
    return table.join(F.broadcast(all_)).select(key, F.zip_with("_n", "_all", lambda x, a: F.log((x + 1.0) / (a + float(size)))).alias(f"_{key}"))


def identify(pages: DataFrame, model: TextModel, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, host, declared, lang, confidence (its posterior) and text_lang (what the text alone says)."""
    n = len(model.languages)
    if not n:
        kind = pages.schema[key].dataType.simpleString()
        return pages.select(F.col(key).cast(kind), host_of(F.col(url)).alias("host"), *[F.lit(None).cast("string").alias(c) for c in ("declared", "lang")], F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"))
    read = read_pages(pages, model, key, url, page)
    labels = F.split("host", r"\.")
    size = F.size(labels)
    read = read.withColumn("suffix", F.element_at(labels, -1)).withColumn("domain", F.array_join(F.slice(labels, F.greatest(size - 1, F.lit(1)), F.lit(2)), "."))
    read = cut(read.withColumn("_p", _normal(F.col("_text"))), "lang-pages")
    hosts = cut(_table(read, ["host", "domain", "suffix"], n), "lang-hosts")
    up = hosts.withColumnRenamed("_n", "_p")
    domains, suffixes, declared = _table(up, ["domain", "suffix"], n), _table(up, ["suffix"], n), _table(read, ["declared"], n)
    total = up.agg(*_sums(n)).select(F.array(*[F.coalesce(f"_{i}", F.lit(0.0)) for i in range(n)]).alias("_all"))
    flat = F.array(*[F.lit(1.0 / n)] * n)
    top = total.select(_toward("_all", flat).alias("_top"))
    suffix_prior = suffixes.join(F.broadcast(top)).select("suffix", _toward("_n", "_top").alias("_up"))
    domain_prior = domains.join(suffix_prior, "suffix").select("domain", "suffix", _toward("_n", "_up").alias("_up"))
    # the suffix is evidence of its own and must not count again through the prior it smooths
    host_prior = hosts.join(domain_prior, ["domain", "suffix"]).select("host", _toward("_n", "_up").alias("_prior"))
    by_suffix = _given_language(cut(suffixes, "lang-suffixes"), "suffix", n)
    host_table = cut(host_prior.join(hosts.select("host", "suffix"), "host").join(by_suffix, "suffix").select("host", "_prior", "_suffix"), "lang-priors")
    declared_table = cut(_given_language(cut(declared, "lang-declared"), "declared", n), "lang-declarations")
    joined = read.join(small_enough(host_table), "host").join(small_enough(declared_table), "declared")
    # a suffix says little beyond its hosts; half its weight keeps the two from counting twice
    logs = F.expr("zip_with(zip_with(zip_with(_text, _prior, (t, p) -> t + ln(p)), _declared, (t, d) -> t + d), _suffix, (t, s) -> t + 0.5 * s)")
    names = F.array(*[F.lit(x) for x in model.languages])
    posterior = joined.withColumn("_q", _normal(logs))
    best = lambda c: F.get(names, F.array_position(c, F.array_max(c)).cast("int") - 1)
    return posterior.select(key, "host", "declared", best(F.col("_q")).alias("lang"), F.array_max("_q").alias("confidence"), best(F.col("_p")).alias("text_lang"))
