"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocations, decontaminate, jaccard, langid, lexical, mixing, pieces, quality, sharding, suffix_dedup, toxicity, url_filter
from .common import documents, held_out

#: (host, path, action) of the url filter's rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Bytes of text that a shard holds at most, and the directory's first size in bits.
SHARD_BYTES, SHARD_BITS = 2**20, 0
SMALL_SHARD_BYTES = 160 * 2**10

#: Score from which a document counts as toxic.
TOXIC = 0.3


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir), SHARD_BYTES, SHARD_BITS)


def shard_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a limit so small that even small tables have shards of several depths."""
    return sharding.assign_shards(documents(spark, sf_dir), SMALL_SHARD_BYTES)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, ~held_out("doc_id", 3, 1), metadata=["n_chars"])
    scored = quality.score_documents(docs, model, metadata=["n_chars"])
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(documents(spark, sf_dir), words=4, similarity=(85, 100))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), langid.fit_text(documents(spark, sf_dir)))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("spans")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~held_out("doc_id", 4, 2))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), F.to_json("spans").alias("spans"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.match_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only here, so that the other queries don't need it

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    made = pieces.encode(documents(spark, sf_dir), model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


def queries() -> dict:
    return {"op1_mixing": op1_mixing, "op2_sharding": op2_sharding, "shard_depths": shard_depths, "op3_decontamination": op3_decontamination, "op4_quality": op4_quality, "op5_jaccard_join": op5_jaccard_join, "op6_ann": op6_ann, "op7_langid": op7_langid, "op8_suffix_dedup": op8_suffix_dedup, "op9_toxicity": op9_toxicity, "op10_url_filter": op10_url_filter, "op11_sentencepiece": op11_sentencepiece, "op12_lexical_search": op12_lexical_search, "op13_collocations": op13_collocations}


def oracle_sql() -> dict[str, str]:
    return {"op2_sharding": sharding_sql(SHARD_BYTES, SHARD_BITS), "shard_depths": sharding_sql(SMALL_SHARD_BYTES, 0), "op5_jaccard_join": JACCARD_SQL, "op8_suffix_dedup": REPEATS_SQL, "op10_url_filter": URL_SQL, "op12_lexical_search": LEXICAL_SQL, "op13_collocations": PHRASES_SQL}


def sharding_sql(limit: int, start: int) -> str:
    return f"""
WITH p AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place FROM documents),
s AS (SELECT d.depth, place >> (60 - d.depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS n
      FROM p, (SELECT CAST(unnest(range({start}, 61)) AS INTEGER) AS depth) d GROUP BY ALL),
l AS (SELECT p.doc_id, p.place, min(p.n_bytes) AS n_bytes, min(s.depth) AS depth FROM p JOIN s ON p.place >> (60 - s.depth) = s.prefix
      WHERE s.shard_bytes <= {limit} OR s.n = 1 GROUP BY p.doc_id, p.place)
SELECT l.doc_id, l.n_bytes, right(lpad(bin(l.place >> (60 - l.depth)), 60, '0'), l.depth) AS shard_id, l.depth AS shard_depth, s.shard_bytes
FROM l JOIN s ON s.depth = l.depth AND s.prefix = l.place >> (60 - l.depth)"""


URL_SQL = """
WITH r(host_rule, path_rule, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                                ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT p.page_id, max(row(length(host_rule || path_rule), host_rule || path_rule, action)) AS best
      FROM p JOIN r ON (p.host = host_rule OR ends_with(p.host, '.' || host_rule)) AND starts_with(p.path, path_rule) GROUP BY 1)
SELECT p.page_id, p.host, p.path, m.best[2] AS rule, coalesce(m.best[3], 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
c AS (SELECT doc_id, count(*) AS size FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * same >= 85 * (ca.size + cb.size - same)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other)
SELECT d.doc_id, coalesce(c.size, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN c USING (doc_id) JOIN (SELECT id, min(other) AS component_id FROM r GROUP BY 1) m ON m.id = d.doc_id"""

REPEATS_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM t)),
rep AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM win WHERE m IN (SELECT m FROM win GROUP BY 1 HAVING count(*) > 1)),
runs AS (SELECT doc_id, i, sum(CASE WHEN gap <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM rep),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(max(h), 2 * max(b) + 1) AS hex FROM cuts JOIN t USING (doc_id) GROUP BY 1)
SELECT t.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.hex, t.h))) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)"""

LEXICAL_SQL = r"""
WITH terms AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT r, doc_id, len(ts) AS n, ts FROM terms WHERE len(ts) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), total),
s AS (SELECT q.item_id, d.r, d.doc_id, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * d.n * docs) // words)))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (r), total GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 10"""

PHRASES_SQL = r"""
WITH pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
                FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
longer AS (SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE k = 3) GROUP BY ALL),
parts AS MATERIALIZED (SELECT c.lang, c.phrase, c.a, j, array_to_string(ws[1:j], ' ') AS p1, array_to_string(ws[j + 1:], ' ') AS p2 FROM c JOIN (VALUES (1), (2)) v(j) ON j < k
         LEFT JOIN longer ON longer.lang = c.lang AND longer.part = c.phrase WHERE NOT coalesce(100 * longer.a >= 50 * c.a, false)),
needed AS MATERIALIZED (SELECT lang, phrase, f FROM f WHERE (lang, phrase) IN (SELECT lang, p1 FROM parts UNION SELECT lang, p2 FROM parts)),
firsts AS MATERIALIZED (SELECT parts.*, f AS l FROM parts JOIN needed ON needed.lang = parts.lang AND needed.phrase = p1),
cuts AS (SELECT firsts.lang, firsts.phrase, a, j, l, f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * f) AS BIGINT) AS score
         FROM firsts JOIN needed ON needed.lang = firsts.lang AND needed.phrase = p2),
lowest AS (SELECT lang, phrase, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM lowest JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1) t USING (lang) QUALIFY rank <= 2000"""
