"""A corpus pipeline of four stages over ``documents``: quality, near copies, repeated passages, packing.

Every stage works on all rows that the one before it kept, written as Parquet and read again. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import chunks, packing, simhash, subword
from statloom.llm.common import col, free_name, maybe_among, read, settle, told_apart
from statloom.llm.queries import vocabulary_path
from statloom.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL = None  # no stage is expressible in SQL; tests compare with brute force


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier predicts as good; it learns from ``labels``.

    A NULL or empty text gets the score of the bias alone; every row is judged by its own text, repeated
    ids and rows included. Without usable labels every score is one half and no document stays.
    """
    model = subword.fit(docs, read(spark, sf_dir, "labels"))
    score = subword.scorer(docs, model)
    return docs.where(score(col("text")) >= subword.KEEP)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near copies, that with the smallest doc_id.

    Texts meet by their SimHash fingerprints within two bits, found by the ring, and where copies are further
    apart by their least shingle hashes; whoever meets is decided by the exact shingle sets.
    NULL and empty texts are one group. Rows equal in doc_id and text are one document, of which a row
    stays. Different texts that share a doc_id, and rows without one, are documents of their own behind
    all others: they go only if their own text is like one that stays.
    """
    key = free_name(docs, "_statloom_document")
    keyed = told_apart(docs, key)
    groups = simhash.similar_groups(keyed, key)
    facts = groups.groupBy("doc_id").agg(F.max(F.expr("doc_id <> component_id")).alias("leaves"), F.count("*").alias("n"))
    facts = settle(facts.where("leaves or n > 1").select(F.col("doc_id").alias(key), "leaves"), "leaving")
    # texts that are surely in no group stay where they are
    mark = free_name(docs, "_statloom_maybe")
    marked = maybe_among(keyed, key, facts.select(key), mark)
    kept = marked.where(F.col(mark)).join(facts.where("leaves"), key, "left_anti")
    # rows of one document are equal in id and text: one stays
    out = marked.where(~F.col(mark)).unionByName(kept.dropDuplicates([key]))
    return out.select(*[col(c) for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document holds; a document left without words goes.

    NULL and empty texts stay as they are. Texts that share a doc_id lose their own passages only.
    """
    out = chunks.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 4096 tokens.

    A NULL or empty text is its end mark alone; rows that repeat an id are packed each.
    """
    pieces = packing.pack(docs, vocabulary_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near copies", near_copies),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    path = new_folder(spark, "packing")
    STAGES[-1][1](spark, docs, sf_dir).write.parquet(path)
    return spark.read.parquet(path)
