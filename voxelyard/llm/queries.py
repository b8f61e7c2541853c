"""The queries of the ten operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelyard.llm.common import read, scratch


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.ann import nearest

    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.licenses import scan

    return scan(read(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.simhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4).select(
        "doc_id", "fingerprint", "component_id"
    )


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.warc import archived

    return archived(read(spark, sf_dir, "pages"), scratch(spark, "warc"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.bpe import encode_decode

    return encode_decode(read(spark, sf_dir, "documents"), _tokenizer(), keep_ids=False)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm import tokens

    path = scratch(spark, "tokens")
    tokens.write(read(spark, sf_dir, "documents"), path, _tokenizer(), end_id=2)
    return tokens.read_checked(spark, path)


def op7_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.mixing import mix

    return mix(read(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.langid import fit, identify

    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit(docs), with_spans=False)


def op9_chroma_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no recordings: each embedding is played as a melody, decoded on the fly."""
    from voxelyard.llm.chroma import align, melody

    return align(read(spark, sf_dir, "embeddings"), F.col("rec_id") % 20 == 0, "vec_id", "embedding", decode=melody)


def op10_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelyard.llm.quality import fit, score

    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_block_matrix_ann, op2_license_scan, op3_simhash_near_dedup, op4_warc_archive, op5_bpe_round_trip,
        op6_token_files, op7_source_mixture, op8_language_id, op9_chroma_alignment, op10_quality_fm,
    )
}

SQL: dict[str, str] = {
    "op1_block_matrix_ann": """
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        ), n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS len FROM v),
        p AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   greatest(-1.0, least(1.0, list_inner_product(q.e, c.e) / (q.len * c.len))) AS score
            FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 AND q.len > 0 AND c.len > 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM p
        )
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5""",
    "op4_warc_archive": """
        WITH p AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
}
