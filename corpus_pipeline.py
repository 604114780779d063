"""From raw documents to a training mix: filter, de-duplicate, decontaminate, mask, mix.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. The first four give back the columns of their input; the last adds `copy`.
Nulls, empty tables and extra columns are treated as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webcorpus.llm import decontaminate, jaccard, mixing, pii, quality
from webcorpus.llm.queries import TEST_KEY
from webcorpus.session import new_folder

#: Session setting that holds the key of the pseudonyms.
KEY_SETTING = "spark.webcorpus.pseudonyms.key"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select_kept(docs, quality.fit_ratios(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.select_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go."""
    return decontaminate.select_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become pseudonyms under the key of KEY_SETTING.

    Without the setting the key is the one for tests, which is no secret.
    """
    key = spark.conf.get(KEY_SETTING, None)
    return pii.mask_texts(docs, key.encode() if key else TEST_KEY)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.take_mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("source_mixing", source_mixing),
]

#: Signatures, alignments and keyed permutations are no SQL; tests/llm has a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
