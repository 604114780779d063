"""Seeds and allow-domains, from a `;` list in the settings or a column of lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.text import strip
from webcorpus.functions.urls import host_key


def _entries(spec: Column) -> Column:
    trimmed = F.transform(F.split(spec, ";"), strip)
    return F.filter(trimmed, lambda entry: entry != "")


def spec_table(spark: SparkSession, spec: str) -> DataFrame:
    """A settings string as a one-row table, for the functions below."""
    return spark.range(1).select(F.lit(spec).alias("spec"))


def seeds_from(specs: DataFrame, spec: str = "spec") -> DataFrame:
    """One row per seed URL: split at `;`, trimmed, blanks dropped."""
    return specs.select(F.explode(_entries(F.col(spec))).alias("seed"))


def allow_domains(
    specs: DataFrame, seeds: DataFrame, spec: str = "spec", strict: bool = False
) -> DataFrame:
    """Distinct domains of the lists and hosts of the seeds.

    Hosts are compared without `www.`; an entry written with it would match
    nothing, so it is cut here too. `strict` leaves entries as written.
    """
    listed = specs.select(F.explode(_entries(F.lower(spec))).alias("domain"))
    if not strict:
        listed = listed.select(
            F.regexp_replace("domain", r"^www\.", "").alias("domain")
        )
    return listed.unionByName(seeds.select(host_key("seed").alias("domain"))).distinct()
