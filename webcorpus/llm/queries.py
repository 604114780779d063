"""The operators' queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm import (
    align,
    brown,
    decontaminate,
    fixity,
    jaccard,
    mixing,
    pii,
    quality,
    resample,
    rules,
    suffix,
    tokencount,
    toxicity,
)

#: For the registered query, whose result is to be compared; real data need a secret.
TEST_KEY = b"a key for tests, known to all"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(function):
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = quality.fit_ratios(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, ratios)


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_rule_ensemble")
def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_merkle_audit")
def op7_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC files, against a replica with changed and lost records.

    The replica is laid out on its own: what follows a lost record has moved.
    """
    records = fixity.warc_records(table(spark, sf_dir, "pages"))
    changed = F.concat(F.expr("substring(record, 1, length - 1)"), F.lit(b"\0"))
    rotten = records.withColumn(
        "record", F.when(F.col("record_id") % 97 == 13, changed).otherwise(F.col("record"))
    )
    lost = F.coalesce(F.col("record_id") % 101 == 7, F.lit(False))
    first, second = (
        fixity.laid_out(fixity.hashed(side)) for side in (records, rotten.filter(~lost))
    )
    return fixity.audit(first, second)


@query("op5_pii_pseudonyms")
def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), TEST_KEY)


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_jaccard_join")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


@query("op11_resampling")
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_brown_scores")
def op12_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"))
