"""The corpus pipeline: toxicity, exact copies, near copies, repeated passages,
packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages
the rows are written as Parquet below the shared checkpoint folder and read
again.  All stages but the last return the columns of ``documents``.

Every stage takes any rows: null ids, texts and other columns stay as they are (a
null text has no toxic hit, is a copy of the empty text, near nothing, and has no passage);
repeated rows are copies, of which one stays; an empty table stays empty, and the
last stage then has no pieces; texts of any length are read whole; further columns
are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import exact_dedup, near_dedup, packing, substring_dedup, toxicity
from quarry.plans.materialize import materialize
from quarry.plans.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold stay.  Labels are learned from
    the stage's own documents, by the folds of the toxicity query."""
    model = toxicity.fit(toxicity.labelled_sample(
        docs, table(spark, sf_dir, "labels"), lambda c: F.expr(f"crc32(cast({c} AS string)) % 4 != 2")))
    scored = toxicity.score(docs, model, score_col="__q_score", quoted_col="__q_quoted")
    return scored.filter(F.col("__q_score") < toxicity.THRESHOLD).select(*[F.col(c) for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id stays."""
    return near_dedup.keep_one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; words of repeated windows are cut out."""
    return substring_dedup.remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and offset."""
    return packing.pack(docs, special=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Learned scores, similarity components and the packing are beyond SQL; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
