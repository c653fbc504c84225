"""The registered queries of the audits over whole corpora: vocabulary, benchmark passages, manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.llm import manifest, query
from temperament.llm.divergence import divergence
from temperament.llm.postings import contamination

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


OP11_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS number, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), words AS (SELECT number, lang, source, unnest(words) AS term FROM docs
), kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT number) >= 3
), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
    SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 1) // (coalesce(n, 0) + v) AS p
    FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes ON sizes.lang = g.lang
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), common AS (
    SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(c) + 1) // (sum(sum(c)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q
    FROM shares GROUP BY lang, term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY a.lang, a.source, b.source
), terms AS (
    SELECT s.lang, s.source, s.term AS item, (p - q) * (p - q) // q AS value FROM shares s JOIN common USING (lang, term) WHERE c > 0 AND p > q
), listed AS (
    SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' FROM terms
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM listed QUALIFY part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", OP11_SQL)
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(_table(spark, folder, "documents"))


OP12_SQL = f"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS width, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 10 THEN [array_to_string(words, ' ')]
        ELSE [array_to_string(words[i:i + 9], ' ') FOR i IN range(1, len(words) - 8)] END) AS phrase
    FROM item_words
), runs AS (
    SELECT doc_id, width, unnest([struct_pack(first := i, phrase := array_to_string(words[i:i + width - 1], ' '))
        FOR i IN range(1, len(words) - width + 2)]) AS run
    FROM doc_words, (SELECT DISTINCT width FROM windows)
), matches AS (
    SELECT DISTINCT doc_id, item_id, runs.run.first AS start, windows.width FROM runs JOIN windows
    ON runs.width = windows.width AND runs.run.phrase = windows.phrase
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
        SELECT doc_id, unnest(range(start, start + width)) AS place FROM matches) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op12_benchmark_decontamination", OP12_SQL)
def op12_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def _field(name: str) -> str:
    return f"coalesce(CAST(strlen(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


OP13_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('1' || lang, '0') AS tree,
        sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} || {_field('text')}) AS leaf,
        sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('(n_chars + 1)')} || {_field('text')}) AS changed,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
    FROM documents
), checks AS (
    -- crc32 by its definition, bit by bit over the digits of doc_id
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS digits, 1 AS i, CAST(4294967295 AS BIGINT) AS sum FROM documents
    UNION ALL
    SELECT doc_id, digits, i + 1, list_reduce([xor(sum, CAST(ascii(substr(digits, i, 1)) AS BIGINT))] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda s, _: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)
    FROM checks WHERE i <= len(digits)
), tampered AS (
    SELECT doc_id, xor(sum, 4294967295) % 7 = 0 AS is_tampered FROM checks WHERE i > len(digits)
), trees AS (
    SELECT tree, 0 AS level, pos, leaf AS hash FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM trees) WHERE nodes > 1 GROUP BY tree, level, pos // 2
), subroots AS (
    SELECT tree, max(level) AS height, max_by(hash, level) AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank FROM trees GROUP BY tree
), above AS (
    SELECT 0 AS level, rank AS pos, subroot AS hash FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS nodes FROM above) WHERE nodes > 1 GROUP BY level, pos // 2
), climb AS (
    SELECT doc_id, leaves.tree, leaf, 0 AS level, pos, CASE WHEN is_tampered THEN changed ELSE leaf END AS folded, '' AS proof
    FROM leaves JOIN tampered USING (doc_id)
    UNION ALL
    SELECT doc_id, climb.tree, leaf, climb.level + 1, climb.pos // 2,
        sha256(CASE WHEN climb.pos % 2 = 1 THEN coalesce(s.hash, '') || folded ELSE folded || coalesce(s.hash, '') END), proof || coalesce(s.hash, '')
    FROM climb JOIN subroots ON climb.tree = subroots.tree AND climb.level < height
    LEFT JOIN trees s ON s.tree = climb.tree AND s.level = climb.level AND s.pos = xor(climb.pos, 1)
), tops AS (SELECT max(level) AS height, max_by(hash, level) AS root FROM above
), last AS (
    SELECT doc_id, climb.tree, leaf, 0 AS level, rank AS pos, folded, proof FROM climb JOIN subroots ON climb.tree = subroots.tree AND climb.level = height
    UNION ALL
    SELECT doc_id, tree, leaf, last.level + 1, last.pos // 2,
        sha256(CASE WHEN last.pos % 2 = 1 THEN coalesce(s.hash, '') || folded ELSE folded || coalesce(s.hash, '') END), proof || coalesce(s.hash, '')
    FROM last JOIN tops ON last.level < height LEFT JOIN above s ON s.level = last.level AND s.pos = xor(last.pos, 1)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM last JOIN tops ON last.level = height JOIN subroots USING (tree)
"""


@query("op13_dataset_manifest", OP13_SQL)
def op13_dataset_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return manifest.verify(manifest.build(manifest.leaves(docs, tampered)))
