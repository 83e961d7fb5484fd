"""Corpus pipeline: documents to packed training sequences.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auric.llm import line_dedup, mixing, packing, quality_rules, simhash
from auric.llm.common import Scratch, saved, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return quality_rules.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines like an earlier one; emptied documents go."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHashes (4-word shingles) link at 4 or
    fewer differing bits."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated or left out."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("mixing", mix), ("packing", sequences)]

# Neither the budget fitting nor the tokeniser can be written in SQL; the tests
# hold run() against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read again. What a stage reads and what it writes on the way is
    deleted once its result is written, so only the last result's table stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        result = Scratch(spark)
        with Scratch(spark) as made:
            out = stage(spark, docs, sf_dir)
            with result:
                docs = saved(out, "pipeline")
        made.delete()
        if before is not None:
            before.delete()
        before = result
    return docs
