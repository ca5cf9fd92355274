"""The registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm import collocations, exact_dedup, html_text, lexical, line_dedup, metric_tree, mixing, near_dedup, packing, quality, secret_scan, sharding, substring_dedup
from brooklet.llm.common import digest, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHARDS = 40


@query()
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards by jump consistent hashing of its id."""
    text = text_or_empty("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign_shards(docs, "doc_id", SHARDS, "shard", grown="grown_shard")
    slots = sharding.number_slots(placed, "shard", ["doc_id", "text_crc32", "size"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SEQUENCE, END_ID = 2048, 1


def tokenizer_definition(path: str | None = None) -> str:
    """The JSON text of the tokenizer at a path of the driver's; tasks get the text itself."""
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_definition(), SEQUENCE, END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body FROM documents),
     g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY body) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal but for white space, and the one that stays."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


@query("""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     e AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM s),
     k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
     c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
     m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the long lines that five documents share."""
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", digest(F.col("text")).alias("kept_sha256"))


@query()
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    documents, taken = mixing.mix(table(spark, sf_dir, "documents"))
    words = taken.groupBy(F.col("row").alias("of")).agg(F.sum("words").alias("words"))
    return documents.join(words, F.col("row") == F.col("of"), "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, by the fixed patterns and by the Markov models."""
    docs = table(spark, sf_dir, "documents")
    spans = F.col("spans")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    base = secret_scan.of_kind(spans, *secret_scan.PATTERNS)
    return found.select(
        "doc_id", *[F.size(secret_scan.of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in secret_scan.PATTERNS],
        digest(secret_scan.joined(base)).alias("base_sha256"), secret_scan.joined(spans).alias("spans"))


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels nothing is learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


@query()
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from the labels that are not held out."""
    scored = quality.score(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from=~held_out(F.col("doc_id")))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("""
WITH RECURSIVE w AS (
       SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
     s AS (SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
             ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)]) END) AS shingle FROM w),
     n AS (SELECT doc_id, count(shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY doc_id),
     p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
     l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
     r AS (SELECT doc_id AS u, doc_id AS v FROM n UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v)
SELECT n.doc_id, n.n AS n_shingles, min(r.v) AS component_id, n.doc_id = min(r.v) AS kept
FROM n JOIN r ON r.u = n.doc_id GROUP BY n.doc_id, n.n
""")
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component, and whether it stays."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, part=85, whole=100, rows=3)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of every twentieth vector, by inner product."""
    return metric_tree.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, factor=64)


@query("""
WITH t AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
     d AS (SELECT *, len(terms) AS n FROM t WHERE len(terms) > 0),
     a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
     e AS (SELECT row, doc_id, n, unnest(terms) AS term FROM d),
     c AS (SELECT row, doc_id, n, term, count(*) AS tf FROM e GROUP BY ALL),
     w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, a GROUP BY term, docs),
     q AS (SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
     s AS (SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
           FROM q JOIN c USING (term) JOIN w USING (term), a GROUP BY ALL),
     r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
     q AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
     u AS (SELECT lang, piece, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM q),
     w AS (SELECT lang, word AS x, lead(word, 1) OVER v AS y, lead(word, 2) OVER v AS z FROM u WINDOW v AS (PARTITION BY piece ORDER BY pos)),
     f AS MATERIALIZED (SELECT lang, 1 AS size, [x] AS parts, count(*) AS f FROM w GROUP BY lang, x
           UNION ALL SELECT lang, 2, [x, y], count(*) FROM w WHERE y IS NOT NULL GROUP BY lang, x, y
           UNION ALL SELECT lang, 3, [x, y, z], count(*) FROM w WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10),
     n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
     c AS (SELECT * FROM f WHERE size >= 2 AND f >= 10),
     h AS (SELECT c.*, array_to_string(parts, ' ') AS phrase, k, parts[:k] AS first, parts[k + 1:] AS rest FROM c, range(1, 3) t(k) WHERE k < size),
     k AS (SELECT h.*, a.f AS l, b.f AS r, (1000000::HUGEINT * h.f * h.f // (a.f::HUGEINT * b.f))::BIGINT AS score
           FROM h JOIN f a ON a.lang = h.lang AND a.parts = h.first JOIN f b ON b.lang = h.lang AND b.parts = h.rest),
     s AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     g AS (SELECT lang, array_to_string(parts[x:x + 1], ' ') AS phrase, max(f) AS longer FROM c, range(1, 3) t(x) WHERE size = 3 GROUP BY ALL),
     r AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, f DESC, s.phrase) AS rank
           FROM s LEFT JOIN g ON g.lang = s.lang AND g.phrase = s.phrase AND s.size = 2
           WHERE longer IS NULL OR 100 * longer < 50 * f)
SELECT lang, rank, phrase, f AS a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language whose words keep together most."""
    return collocations.mine_phrases(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
     p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
     w AS (SELECT *, CASE WHEN count(*) OVER v = 20 THEN string_agg(word, ' ') OVER v END AS win
           FROM p WINDOW v AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
     f AS (SELECT *, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS again FROM w),
     c AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM f)
SELECT d.doc_id, count(pos) AS n_words, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id
""")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that stand earlier."""
    kept = substring_dedup.drop_repeated_passages(table(spark, sf_dir, "documents"), size=20)
    return kept.select("doc_id", "n_words", "n_removed", digest(F.col("text")).alias("kept_sha256"))
