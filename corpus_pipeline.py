"""From raw documents to a mixed training corpus, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame. All but the last return the
columns of ``docs``; the last adds how much of each document the mix takes.

Defined results: NULL texts count as empty, stay NULL, and pass every stage but the last, which
takes nothing of a text without words. NULL ids, sources and other columns are kept as they are.
If no label of one of the classes belongs to a document, nothing is known of toxicity and all
documents stay; with an empty benchmark nothing is contaminated. An empty table gives an empty
result. Documents may have further columns of any name: where one is called like a column that
the last stage adds, that one gets underscores before its name. Very long texts are taken whole.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.decontaminate import drop_contaminated
from sluiceway.llm.frames import Scratch, fresh
from sluiceway.llm.line_dedup import drop_repeated_lines
from sluiceway.llm.minhash_forest import drop_near_duplicates
from sluiceway.llm.mixing import mix_sources
from sluiceway.llm.toxicity import drop_toxic
from sluiceway.queries.inputs import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a classifier trained on the labelled ones rejects."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that a document with a smaller id has; the count of characters follows."""
    kept = drop_repeated_lines(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which a twentieth or more are benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with ``size, source_size, target, taken``
    (words, repeats counted)."""
    mixed = mix_sources(docs, weights=(1, 2, 3), repeats=3, keep=tuple(docs.columns))
    added = [F.col(name).alias(fresh(docs, name)) for name in ("size", "source_size", "target", "taken")]
    return mixed.where("taken > 0").select(*(F.col("kept").getField(c).alias(c) for c in docs.columns), *added)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier and the near-duplicate search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is kept as Parquet."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
