"""Registered queries of this package and the SQL they must agree with, where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from liftworks.llm import (
    bpe, chat, langid, maxent, ordinal, packing, periodic, rollups, rules, simhash, suffixes, syncmers, vector_codes,
)

QUERIES: dict = {}
ORACLES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


@query
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.replay(table(spark, sf_dir, "documents"))


ORACLES["op4_rollups"] = r"""
WITH d AS (
    SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents
), c AS (
    SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS words, length(t)::BIGINT AS chars,
        min(doc_id) OVER (PARTITION BY t) AS first_id
    FROM d
), k AS (
    SELECT * FROM c WHERE first_id IS NULL OR doc_id = first_id
)
SELECT source, lang, 'v1' AS version, count(*) AS n_docs,
    sum(CASE WHEN words > 1000 THEN words + 1 ELSE words END)::BIGINT AS n_tokens, sum(chars)::BIGINT AS n_chars
FROM k GROUP BY source, lang
UNION ALL
SELECT source, lang, 'v2', count(*), sum((chars + 3) // 4)::BIGINT, sum(chars)::BIGINT
FROM k GROUP BY source, lang
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(table(spark, sf_dir, "documents"), path)


@query
def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _round(k: int) -> str:
    """Assigning to the entries of ``c{k}``, and the entries after it."""
    apart = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])"
    return f"""
m{k} AS (
    SELECT row, vec_id, label, part, min({apart} * 64 + entry)::BIGINT AS best
    FROM p JOIN c{k} USING (part) GROUP BY row, vec_id, label, part
), s{k} AS (
    SELECT part, entry, i, count(*) AS n, sum(v)::BIGINT AS total FROM (
        SELECT part, best % 64 AS entry, unnest(range(len(x))) AS i, unnest(x) AS v
        FROM m{k} JOIN p USING (row, part)
    ) GROUP BY part, entry, i
), u{k} AS (
    SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY part, entry
), c{k + 1} AS (
    SELECT part, entry, coalesce(u{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN u{k} USING (part, entry)
)"""


ORACLES["op13_vector_codes"] = f"""
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id, label,
        [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e
    FROM embeddings
    WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
    SELECT row, vec_id, label, part, e[part * (len(e) // 16) + 1 : (part + 1) * (len(e) // 16)] AS x
    FROM v, range(16) AS t(part)
), f AS (
    SELECT row, row_number() OVER (ORDER BY vec_id, e) - 1 AS entry FROM v QUALIFY entry < 64
), c0 AS (
    SELECT part, entry, x AS c FROM p JOIN f USING (row)
), {_round(0)}, {_round(1)}, {_round(2)}, codes AS (
    SELECT row, vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code,
        sum(best // 64)::BIGINT AS error
    FROM m2 GROUP BY row, vec_id, label
), sums AS (
    SELECT label, sum(error)::BIGINT AS label_error FROM codes GROUP BY label
), flat AS (
    SELECT string_agg(array_to_string(c, ','), ',' ORDER BY part, entry) AS numbers FROM c2
)
SELECT vec_id, code, error, label_error, sha256(numbers) AS codebooks_sha256
FROM codes JOIN sums ON codes.label IS NOT DISTINCT FROM sums.label, flat
"""


@query
def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))
