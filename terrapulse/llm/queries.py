"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapulse.llm import alignment, contamination, hamming, langid, lexsearch, lmscore, mixing, neardup, pii, quality, sharding, substrings, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = hamming.binary_codes(table(spark, sf_dir, "embeddings"))
    return hamming.search(codes, codes.where("id % 100 = 0"), k=10)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.digest(contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_groups(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of good quality; background: all documents."""
    docs = table(spark, sf_dir, "documents")
    return lmscore.score(docs, lmscore.train(docs, table(spark, sf_dir, "labels").where("quality = 1")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_hamming_top_k, op2_decontamination, op3_repeated_substrings, op4_near_duplicates, op5_pii, op6_quality, op7_lm_score, op8_toxicity, op9_source_mix, op10_language_id, op11_ranked_search, op12_token_alignment, op13_sharding)}

_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = {
    "op1_hamming_top_k": """
WITH c AS (SELECT vec_id AS id, array_to_string([CASE WHEN embedding[i] > 0 THEN '1' ELSE '0' END FOR i IN range(1, 65)], '') AS code FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT q.id AS query_id, r.id AS neighbour_id, CAST(hamming(q.code, r.code) AS INTEGER) AS hamming FROM c q JOIN c r ON q.id <> r.id WHERE q.id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, hamming FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hamming, neighbour_id) AS rank FROM p) WHERE rank <= 10""",
    "op2_decontamination": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, unnest([array_to_string(w[k:k + least(13, len(w)) - 1], ' ') FOR k IN range(1, len(w) - least(13, len(w)) + 2)]) AS s FROM i WHERE len(w) > 0),
lens AS (SELECT DISTINCT m FROM p),
dw AS (SELECT doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') AS s FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, lens WHERE len(w) >= m)),
h AS (SELECT dw.doc_id, dw.k, dw.m, p.item_id FROM dw JOIN p ON dw.m = p.m AND dw.s = p.s),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS x FROM h) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op3_repeated_substrings": """
WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
w AS (SELECT doc_id, s, substring(h, 2 * s + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS k FROM w),
m AS (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 OR lag(s) OVER (PARTITION BY doc_id ORDER BY s) IS NULL THEN 1 ELSE 0 END AS new FROM f WHERE k > 1),
r AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM m) GROUP BY doc_id, g),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
k AS (SELECT doc_id, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(b) AS last, sum(b - a) AS n_removed, count(*) AS n_spans FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op9_source_mix": r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(rank - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS want FROM s),
l AS (SELECT *, (want - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
lv AS (SELECT level FROM l WHERE level <= cap / weight ORDER BY cap / weight, rank LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM lv) * weight, cap)) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(2, CAST(floor(floor(target) / source_size) AS BIGINT)) ELSE 0 END AS epochs FROM t),
c AS (SELECT d.*, source_size, target, epochs, CAST(floor(target) AS BIGINT) - epochs * source_size AS rest, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target, CAST(epochs AS BIGINT) AS epochs, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM c""",
    "op11_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(text="text")} AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_WORDS.format(text="text")}) AS term FROM benchmark WHERE text IS NOT NULL),
t AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
m AS (SELECT rid, doc_id, 100 - 90 + ((90 * len(w)::BIGINT * n) // l) AS m FROM d, s WHERE len(w) > 0),
p AS (SELECT item_id, doc_id, rid, CAST(sum(CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
FROM q JOIN f USING (term) JOIN t USING (term) JOIN m USING (rid), s GROUP BY ALL)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM p WHERE score > 0) WHERE r <= 10""",
    "op13_sharding": """
WITH crc AS (SELECT list(list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
d AS (SELECT doc_id, source, coalesce('0' || source, '1') AS stratum, hex(encode(coalesce(text, ''))) AS h, md5('29:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id) - 1 AS rank, count(*) OVER (PARTITION BY stratum) AS n FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * rank + 1)::DOUBLE / (2 * n)::DOUBLE, stratum, key, doc_id) - 1 AS place, count(*) OVER () AS total FROM r),
s AS (SELECT *, 24 * place // total AS shard FROM p)
SELECT doc_id, source, CAST(len(h) // 2 + 8 AS BIGINT) AS size,
CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substring(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32,
'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(place - row_number_before AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM (SELECT *, (shard * total + 23) // 24 AS row_number_before FROM s), crc""",
}
