"""One query per operator, over its whole table and with production parameters, and SQL where SQL can say it."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from daytally.llm import (
    bpe, clusters, exact_dup, leaks, licences, lm, near_dup, pii, quality, secrets, training_order, warc, whitening,
)
from daytally.llm.shared import read_table, stored
from daytally.llm.warc import BASE32
from daytally.session import shared_folder


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards, and returns where each sequence is in them."""
    numbered = training_order.sequences(read_table(spark, sf_dir, "documents"))
    layout = training_order.write(numbered, f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}")
    return training_order.index(numbered, layout)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(read_table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), with_ids=False)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives, and returns what reading them back tells of each page."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(read_table(spark, sf_dir, "pages"), folder, least_bytes=0)
    records = stored(warc.read(spark, folder, with_payload=False))
    found = warc.pages(warc.captures(records))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=4)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(read_table(spark, sf_dir, "embeddings"), clusters=16, rounds=3, seed="1")


QUERIES = {f.__name__: f for f in (
    op1_training_order, op2_exact_dedup, op3_secret_scan, op4_decontamination, op5_pii, op6_quality,
    op7_minhash_near_dup, op8_licence_scan, op9_lm_score, op10_bpe, op11_warc,
    op12_whitening, op13_clusters)}

def _rounds(rounds: int) -> str:
    """Common tables of the clustering: ``c0, a0, c1, a1, ...``, centroids and assignments in turn."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS (
            SELECT k, vec_id, x, c, list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
            FROM v, c{r} QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, c) = 1)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS (
            SELECT c, list(f ORDER BY place) AS y FROM (
                SELECT c, place, CAST(floor(sum(e) / count(*)) AS BIGINT) AS f
                FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS place FROM a{r}) GROUP BY c, place) GROUP BY c
            UNION ALL SELECT c, y FROM c{r} WHERE c NOT IN (SELECT c FROM a{r}))""")
    return ", ".join(parts)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_minhash_near_dup": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM words),
        sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * c >= 85 * (a.n + b.n - c)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT doc_id, doc_id AS other FROM sizes
            UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x)
        SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op11_warc": f"""
        WITH p AS (SELECT *, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        d AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1 + CAST(
            (CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31
            AS BIGINT), 1)), '') AS digest, min(page_id) OVER (PARTITION BY body) AS original FROM p)
        SELECT page_id, strlen(body) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to FROM d
    """,
    "op13_clusters": f"""
        WITH v AS (
            SELECT row_number() OVER () AS k, vec_id,
                   list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), x) - 1 AS c, x AS y
               FROM v QUALIFY c < 16),
        {_rounds(3)}
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(y, ',')) AS centroid_sha256 FROM a3 JOIN c3 USING (c)
    """,
}
