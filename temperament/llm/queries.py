"""The registered queries of the operators, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.llm import bpe, language, personal_data, quality, query, token_files
from temperament.llm.exact_duplicates import exact_duplicates
from temperament.llm.fixity import audit
from temperament.llm.mixing import mix
from temperament.llm.near_duplicates import near_duplicates
from temperament.llm.vector_search import top_k, whole_vectors
from temperament.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _left_over(parts: int) -> Column:
    """crc32 of doc_id as text, modulo `parts`; null without doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def _replica(pages: DataFrame) -> DataFrame:
    """A second copy of the pages with damage that follows from the url: some bodies changed, some pages lost."""
    mark = F.substring(F.md5("url"), 1, 2)
    damaged = F.when(mark == "00", F.concat(F.lit("~"), F.substring("html", 2, F.length("html").cast("int")))).otherwise(F.col("html"))
    return pages.where(F.coalesce(mark != "01", F.lit(True))).select("page_id", "url", damaged.alias("html"))


_OFFSETS = """CAST(coalesce(sum(length) OVER (PARTITION BY page_id // 4096 ORDER BY page_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at"""
_LENGTH = """CAST(strlen('WARC/1.0WARC-Type: resourceWARC-Target-URI: Content-Length: ') + strlen(url)
        + strlen(CAST(strlen(html) AS VARCHAR)) + strlen(html) + 14 AS BIGINT) AS length"""
OP1_SQL = f"""
WITH originals AS (SELECT page_id, url, html FROM pages), copies AS (
    SELECT page_id, url, CASE WHEN substr(md5(url), 1, 2) = '00' THEN '~' || substr(html, 2) ELSE html END AS html
    FROM pages WHERE substr(md5(url), 1, 2) <> '01'
), kept AS (
    SELECT *, {_OFFSETS} FROM (SELECT *, {_LENGTH} FROM originals)
), copied AS (
    SELECT *, {_OFFSETS} FROM (SELECT *, {_LENGTH} FROM copies)
)
SELECT a.page_id, CASE WHEN b.page_id IS NULL THEN 'missing' ELSE 'changed' END AS status, a.page_id // 4096 AS file_no,
    a.at AS record_offset, a.length AS record_length, b.at AS replica_offset, b.length AS replica_length
FROM kept a LEFT JOIN copied b ON a.page_id = b.page_id
WHERE b.page_id IS NULL OR a.html <> b.html
"""


@query("op1_fixity_audit", OP1_SQL)
def op1_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return audit(pages, _replica(pages))


OP2_SQL = """
WITH sized AS (
    SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), shared AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
            ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS open,
        CAST(sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
    FROM sources
), marked AS (
    SELECT *, 3 * source_size * weights <= open * weight AS is_full FROM shared
), targets AS (
    SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
        ELSE CAST(max(CASE WHEN NOT is_full THEN open END) OVER () * weight AS DOUBLE)
            / max(CASE WHEN NOT is_full THEN weights END) OVER () END AS target
    FROM marked
), expected AS (
    SELECT doc_id, sized.source, size, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS copies,
        (CAST(CAST('0x' || substr(sha256(concat_ws('|', 42, doc_id, sha256(coalesce(text, '')))), 1, 12) AS BIGINT) AS DOUBLE)
            + 0.5) / 281474976710656.0 AS u
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), ranked AS (
    SELECT *, floor(copies) AS certain, CASE WHEN copies > floor(copies)
        THEN u / (1 - u) * (1 - (copies - floor(copies))) / (copies - floor(copies)) END AS odds
    FROM expected
), running AS (
    SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS budget,
        sum(size) OVER (PARTITION BY source ORDER BY odds NULLS LAST) AS reached,
        sum(size) OVER (PARTITION BY source, odds) AS tied
    FROM ranked
)
SELECT doc_id, size, source_size, target,
    CAST((certain + CASE WHEN odds IS NOT NULL AND reached - tied / 2 <= budget THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM running
"""


@query("op2_mix_sources", OP2_SQL)
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = """
WITH RECURSIVE sequences AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END)) AS shingle
    FROM sequences
), sizes AS (
    SELECT doc_id, count(shingle) AS n FROM sequences LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), rare AS (
    SELECT doc_id, shingle, row_number() OVER (PARTITION BY doc_id ORDER BY holders, shingle) AS place
    FROM shingles JOIN (SELECT shingle, count(*) AS holders FROM shingles GROUP BY shingle) USING (shingle)
), candidates AS (
    SELECT DISTINCT a.doc_id AS one, b.doc_id AS two
    FROM rare a JOIN rare b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    WHERE a.place <= p.n - ceil(0.75 * p.n) + 1 AND b.place <= q.n - ceil(0.75 * q.n) + 1
), links AS (
    SELECT one, two FROM (
        SELECT one, two, count(*) AS common FROM candidates
        JOIN shingles a ON a.doc_id = one JOIN shingles b ON b.doc_id = two AND a.shingle = b.shingle GROUP BY one, two)
    JOIN sizes p ON p.doc_id = one JOIN sizes q ON q.doc_id = two
    WHERE 100 * common >= 75 * (p.n + q.n - common)
), ways AS (
    SELECT one, two FROM links UNION ALL SELECT two, one FROM links
), reach AS (
    SELECT doc_id, doc_id AS reached FROM documents
    UNION
    SELECT doc_id, two FROM reach JOIN ways ON one = reached
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""


@query("op3_near_duplicates", OP3_SQL)
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.train(docs, _left_over(3) != 1)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(_left_over(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


OP5_SQL = """
WITH numbers AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vector
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.vector, v.vector) AS BIGINT) AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.vector, v.vector) DESC, v.vec_id) AS rank
    FROM numbers q JOIN numbers v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op5_top_vectors", OP5_SQL)
def op5_top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whole_vectors(_table(spark, folder, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = personal_data.find(docs, personal_data.train(docs))
    counts = [F.size(f"base_{kind}").cast("long").alias(f"n_{kind}") for kind in personal_data.KINDS]
    base = F.sha2(personal_data.span_list(found, "base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, personal_data.span_list(found, "spans").alias("spans"))


@query("op7_bpe_round_trip")
def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), _vocabulary())


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(_table(spark, folder, "documents"), path, _vocabulary())
    return token_files.with_checksums(token_files.read_tokens(spark, path))


OP9_SQL = """
WITH plain AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
    sha256(text) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY text)
"""


@query("op9_exact_duplicates", OP9_SQL)
def op9_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    kept = exact_duplicates(_table(spark, folder, "documents"))
    return kept.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op10_quality")
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality.train(docs, _table(spark, folder, "labels"), _left_over(4) != 2)
    scored = quality.rank(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(_left_over(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
