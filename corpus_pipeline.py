"""The corpus pipeline: documents -> packed training sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what the next one gets, after it was written as Parquet and read
again.  All but the last return the columns of ``documents``.

A row is known by its doc_id and text: of rows alike in both, the stages that
leave out copies keep one, and the filters treat each alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionkit.llm import language_id, quality
from sessionkit.llm.common import keep_rows, read_table, share_package
from sessionkit.llm.exact_dedup import exact_duplicates
from sessionkit.llm.packing import pack
from sessionkit.llm.queries import vocabulary
from sessionkit.llm.simhash import near_duplicates
from sessionkit.session import materialize

#: Under this posterior no language of those learned is likely enough.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learned languages stay; those
    without text or letters, undecided ones, and those far less likely in their
    language than any labelled text, go."""
    share_package(spark)
    held = language_id.held_out("doc_id")
    model = language_id.fit(docs.filter(~held), vocabulary("piece_bpe_32k.model"))
    model = language_id.with_floors(model, docs.filter(~held))
    return language_id.identified(docs, model, MIN_LANGUAGE_SCORE)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts stay."""
    share_package(spark)
    return quality.accepted(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    share_package(spark)
    kept = exact_duplicates(docs).filter("kept")
    return keep_rows(docs, kept.select("doc_id", F.col("text_sha256").alias("text_key")),
                     F.sha2(F.coalesce("text", F.lit("")), 256))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id stays (nulls
    last; of several, the one with the smallest text hash)."""
    share_package(spark)
    found = near_duplicates(docs, radius=3, width=3, seed=42)
    first = found.groupBy("group").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")) \
        .select("first.doc_id", "first.text_key")
    return keep_rows(docs, first, F.xxhash64("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents left, packed into sequences."""
    share_package(spark)
    return pack(docs, vocabulary("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the trained stages nor the packing; tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
