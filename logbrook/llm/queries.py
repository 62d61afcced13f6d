"""The queries of this subpackage on the test tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logbrook.llm import archives, collocations, embeddings, licenses, packing, periodic, personal, quality, sampling, secret_scan, simhash, token_files, toxicity
from logbrook.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = toxicity.learned(documents, _table(spark, folder, "labels"))
    return toxicity.scored(documents, model)


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_copies(_table(spark, folder, "documents"))
    return groups.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_copies(_table(spark, folder, "embeddings"))


def _secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.found(_table(spark, folder, "documents"))


def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.found(_table(spark, folder, "documents"))


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(_table(spark, folder, "documents")))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(_table(spark, folder, "documents"))


def _token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(_table(spark, folder, "documents"), work_dir(spark, "token-files"))
    return token_files.read(spark, files)


def _sampling(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.digests(_table(spark, folder, "documents"))


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    arc = archives.write_arc(_table(spark, folder, "pages"), work_dir(spark, "arc"))
    return archives.read_warc(spark, archives.convert(spark, arc, work_dir(spark, "warc")))


def _collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.ranked(_table(spark, folder, "documents"))


def _personal(spark: SparkSession, folder: str) -> DataFrame:
    return personal.found(_table(spark, folder, "documents"))


def looped(key: int | None, n: int) -> np.ndarray | None:
    """For one id in ten, the words from some place on as a repetition of the first few of them."""
    code = 0 if key is None else zlib.crc32(str(key).encode())
    if key is None or code % 10 or not n:
        return None
    seed = code // 10
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    order = np.arange(n)
    order[start:] = start + (order[start:] - start) % period
    return order


def _periodic(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.found(_table(spark, folder, "documents"), reread=looped)


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": _toxicity,
        "op2_simhash": _simhash,
        "op3_embeddings": _embeddings,
        "op4_secrets": _secrets,
        "op5_licenses": _licenses,
        "op6_packing": _packing,
        "op7_quality": _quality,
        "op8_token_files": _token_files,
        "op9_sampled_pieces": _sampling,
        "op10_archives": _archives,
        "op11_collocations": _collocations,
        "op12_personal": _personal,
        "op13_periodic": _periodic,
    }


def oracle_sql() -> dict[str, str]:
    # The larger id of equal payloads answers; smaller payloads all do.
    archives_sql = """WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
          FROM pages),
        kept AS (
          SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS kept
          FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> kept THEN kept END AS refers_to
        FROM kept"""
    # Phrases of all lengths, counted; each cut; what longer phrases hold; the first of each language.
    collocations_sql = """WITH p AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents WHERE text IS NOT NULL),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS a FROM p),
        g AS (
          SELECT lang, size, unnest(list_transform(range(1, len(a) - size + 2), lambda i: array_to_string(a[i : i + size - 1], ' '))) AS phrase
          FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(a) >= size),
        f AS (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 30),
        total AS (SELECT lang, CAST(sum(len(a)) AS BIGINT) AS n FROM w GROUP BY lang),
        s AS (SELECT lang, size, phrase, n, string_split(phrase, ' ') AS a FROM f),
        k AS (SELECT *, unnest(range(1, size)) AS k FROM s WHERE size > 1),
        cuts AS (
          SELECT k.lang, k.phrase, k.n AS a, k.k, l.n AS l, r.n AS r, CAST(2000000 * CAST(k.n AS HUGEINT) // (l.n + r.n) AS BIGINT) AS score
          FROM k JOIN f AS l ON l.lang = k.lang AND l.phrase = array_to_string(k.a[1 : k.k], ' ')
          JOIN f AS r ON r.lang = k.lang AND r.phrase = array_to_string(k.a[k.k + 1 :], ' ')),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_of AS (SELECT lang, n, a, unnest(range(2, size)) AS m, size FROM s WHERE size > 2),
        held AS (
          SELECT lang, phrase, max(n) AS held FROM (
            SELECT lang, n, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(a[i : i + m - 1], ' '))) AS phrase FROM inner_of)
          GROUP BY ALL)
        SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank,
               lowest.phrase, a, l, r, total.n, score
        FROM lowest JOIN total USING (lang) LEFT JOIN held ON held.lang = lowest.lang AND held.phrase = lowest.phrase
        WHERE held IS NULL OR 100 * held < 80 * a
        QUALIFY rank <= 2000"""
    return {"op10_archives": archives_sql, "op11_collocations": collocations_sql}
