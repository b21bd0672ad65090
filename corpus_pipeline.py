"""A training corpus from raw documents: rules, near-duplicates, benchmarks, personal data, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm import decontaminate, minhash, mixing, pii, quality
from spindrel.llm.common import finished, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep. Null and empty texts go; repeated rows stay or go together; a
    null doc_id may stay; other columns stay as they are; an empty table stays empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least doc_id of each group of near-duplicates. Null, empty and wordless
    texts are in no group and stay; rows that repeat a doc_id that stays do, too; a null doc_id
    stays only where its whole group has none; an empty table stays empty."""
    kept = minhash.near_duplicates(docs, words=5, percent=80).where("kept").select("doc_id").distinct()
    return docs.alias("d").join(kept.alias("k"), F.expr("d.doc_id <=> k.doc_id"), "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark. Null and empty texts hold none; repeated rows
    stay or go together; an empty table stays empty."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data masked; n_chars counts the masked text, and is null where that
    is. Repeated rows are masked alike; an empty table stays empty."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities of source, language and topic. Nulls of these count
    as ''; wordless texts have the plain rate; rows of one doc_id are drawn together; an empty
    table stays empty. Adds `probability`."""
    return mixing.sample(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", sanitise),
    ("mixing", mix),
]

#: Not expressible in SQL (learned model, minhash, alignment); tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again. What a stage wrote on its way
    is deleted when its result is there."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = finished(step, spark, docs, sf_dir)
    return STAGES[-1][1](spark, docs, sf_dir)
