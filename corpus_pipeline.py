"""From raw documents to shards of a training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read
back before the next one starts, so a stage sees all its predecessor kept and nothing of
how that came about. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontaminate, hilbert, mixing, simhash, toxicity
from lotwise.llm.common import fold, table
from lotwise.workspace import stored


def toxic_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go.

    It learns, as the query ``op7_toxicity``, from labels of ids outside one hashed fifth.
    """
    train = F.coalesce(fold("doc_id", 5) != 0, F.lit(True))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.filter(train), labels.filter(train))
    return toxicity.remove_toxic(docs, model)


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return simhash.keep_one(docs)


def contaminated_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with 5 per cent or more of their words in passages of test items go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is repeated, kept or left out as its source's target asks for."""
    return mixing.mixed(docs)


def curve_sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards along a Hilbert curve over language, source and size; adds ``shard``."""
    return hilbert.sharded(docs)


STAGES = [
    ("toxicity", toxic_removed),
    ("simhash_near_dedup", near_duplicates_removed),
    ("benchmark_decontamination", contaminated_removed),
    ("mixing", sources_mixed),
    ("sharding", curve_sharded),
]

# the classifier and the fingerprints have no form in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
