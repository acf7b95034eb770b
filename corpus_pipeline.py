"""The stages of a training corpus, from raw documents to pieces.

Each stage gets the documents that the one before has kept, as a stored table, and returns them with the
same columns; the last one returns their pieces.

Defined cases: null and empty texts are no reason for any stage to drop a row; they end without pieces. Rows
that repeat an id are one document from ``near_dedup`` on, which keeps one of them; of equal texts (ties) the one with the
smallest id stays. Rows without an id are kept by every stage. A very long text is handled whole. An empty
table, or one without labels or test items, passes through. Further columns, whatever their names, are kept by
all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.llm.decontaminate import drop_leaking
from orebelt.llm.near_dedup import drop_near_duplicates
from orebelt.llm.pieces import encode, load_pieces
from orebelt.llm.repeats import with_repeats_removed
from orebelt.llm.toxicity import drop_toxic
from orebelt.session import stage

# A passage of over 50 words that stands elsewhere, too, goes from every text.
PASSAGE_WORDS = 51

# No SQL: the first stage is a trained model, the others are no relational queries.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose what stands elsewhere, too; every document stays."""
    return with_repeats_removed(docs, words=PASSAGE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaking(docs, _table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_pieces, text)``: the pieces of every text, and the text that they give back."""
    coded = encode(docs, load_pieces(), decoded=True)
    return coded.select("doc_id", "ids", F.size("ids").alias("n_pieces"), "text")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is stored and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
