"""From raw documents to packed training sequences, in five stages.

Each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs.  All but the last return the columns of
``docs``.  What the stages do with nulls, empty and very long texts, repeated rows,
empty tables and further columns is said in the modules they call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.llm import language, near_duplicates, packing, quality, substrings
from cargolens.llm.common import Scratch, unused

LEAST_SCORE = 0.3


def _with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with another text, and its length in ``n_chars`` if there is such a column."""
    return docs.select(
        *[
            text.alias(c) if c == "text"
            else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and texts of no clear language.

    The model learns from the documents that are not held out, as in the query.
    """
    labelled = docs.where(~language.held_out(F.col("doc_id")))
    model = language.fit(*language.training_sample(labelled))
    (found,) = unused(docs, "found")
    named = docs.withColumn(found, language.language(spark, model, F.col("text")))
    clear = (F.col(found)["lang_pred"] != language.UNKNOWN) & (F.col(found)["score"] >= LEAST_SCORE)
    return named.where(clear).select(*docs.columns)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality rules reject, and failing lines of the others."""
    (q,) = unused(docs, "q")
    # As a generator the verdict is computed once for both the filter and the text.
    kept = F.filter(F.array(quality.judge(F.col("text"))), lambda x: x["kept"])
    judged = docs.select("*", F.explode(kept).alias(q))
    out = _with_text(judged, F.col(q)["clean_text"])
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    found = near_duplicates.near_duplicates(docs.select("doc_id", "text"))
    (gone,) = unused(docs, "gone")
    dropped = found.where("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col(gone), "left_anti")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds out of later ones."""
    (cut,) = unused(docs, "cut")
    out = _with_text(substrings.remove_repeats(docs, cut), F.col(cut)["text"])
    return out.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its sequence and its place there."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("quality", clean_lines),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Language models, chunk cuts and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
