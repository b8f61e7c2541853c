"""The corpus pipeline: quality, language, near duplicates, mixture, tokens.

Part of the training-data operators (voxelyard.llm). Each stage takes (spark, docs, sf_dir), works on
all that the stage before kept, and returns a DataFrame; run() writes each as Parquet in the shared
folder and reads it again as the next one's docs. The first four return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxelyard.llm import bpe, langid, mixing, quality, simhash
from voxelyard.llm.common import drop, read, stage

#: A document goes if the classifier gives it less: operator 10's own threshold. Of 990 held-out labels of the
#: 0.1 tables it takes 135 of 136 documents of label 0 and none of 854 of label 1 (none lies between 0.4 and 0.7).
LEAST_QUALITY = 0.7
#: A document goes if fewer of its words fit the language it is given, or if it has no letter. Clean documents of
#: the 0.1 tables have 0.35 at least (one in a hundred has less than 0.92), noise and unlearned scripts about 0.
LEAST_LANGUAGE = 0.25


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the classifier rejects go.

    Null and empty texts are judged by their statistics; repeated rows are judged alike and stay or go
    together; other columns, of any names, come along; where no label is known, nothing is rejected.
    """
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.keep(docs, model, LEAST_QUALITY)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents without a letter (null and empty texts too), and those whose words fit no
    learned language, go. Repeated rows are judged alike; other columns, of any names, come along; where no
    language is known, nothing goes."""
    return langid.keep(docs, langid.fit(docs), LEAST_LANGUAGE)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of near duplicates (five words, similarity 0.8) that with the
    smallest doc_id stays; of rows that repeat it, one."""
    return simhash.keep_first(docs, simhash.similar(docs, shingle=5, similarity=0.8))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: each document as often as the mixture takes it (0 to 2 times). Empty texts are taken 0
    times, null sources are one source; rows that repeat an id and a text share out its copies."""
    return mixing.apply(docs, mixing.mix(docs))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: doc_id, n_tokens and digests of ids and decoded text, a row for each copy. Null texts
    are empty ones; null ids stay null."""
    import public_tokenizers

    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", dedup_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: No stage but the last filter is expressible in SQL (trained models, fingerprints, random draws).
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop(spark, before)  # the next stage's table is whole
        before = docs
    return docs
