"""What fetch attempts came to: usable responses, 404s, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.urls import sanitize, url_part

# Reasons that reports carry.
NO_USABLE_ATTEMPT = "All fetch attempts failed or invalid HTML"
GET_MARK = "(GET)"


def _usable() -> Column:
    """An answer that ends the attempts: no error, not throttled, no server fault."""
    status = F.col("status")
    return F.coalesce(
        F.col("error").isNull() & (status != 429) & (status < 500), F.lit(False)
    )


def _made(retry_count: int | None) -> Column:
    """Attempts that count: all, or the first `retry_count`."""
    return F.lit(True) if retry_count is None else F.col("attempt") <= retry_count


def first_usable(attempts: DataFrame, retry_count: int | None = None) -> DataFrame:
    """One row per URL: its first usable attempt, nulls when it has none.

    Taken as an aggregate, so that each task hands on one row per URL however
    many attempts a URL has.
    """
    fields = [c for c in attempts.columns if c != "url"]
    usable = _usable() & _made(retry_count)
    best = F.min_by(F.when(usable, F.struct(*fields)), F.when(usable, F.col("attempt")))
    return (
        attempts.groupBy("url")
        .agg(best.alias("_best"))
        .select("url", *[F.col(f"_best.{name}").alias(name) for name in fields])
    )


def classify(attempts: DataFrame, retry_count: int | None = None) -> DataFrame:
    """First usable attempt per URL with `outcome` (ok, not_found, failure) and `reason`."""
    status = F.col("status")
    outcome = (
        F.when(status.isNull(), "failure")
        .when(status == 404, "not_found")
        .when(status >= 400, "failure")
        .otherwise("ok")
    )
    reason = F.when(status.isNull(), NO_USABLE_ATTEMPT).when(
        (status >= 400) & (status != 404),
        F.concat(F.lit("HTTP "), status.cast("string")),
    )
    return first_usable(attempts, retry_count).select(
        "*", outcome.alias("outcome"), reason.alias("reason")
    )


def failures(outcomes: DataFrame) -> DataFrame:
    """(url, reason) of the URLs that failed."""
    return outcomes.filter("outcome = 'failure'").select("url", "reason")


def not_found_records(
    outcomes: DataFrame, save_404: bool = True, norm_url: str = "url"
) -> DataFrame:
    """(blob_name, id, url, content, status) of the pages that are gone."""
    ident = F.md5(F.col(norm_url))
    slug = sanitize(url_part(norm_url, "path"))
    return outcomes.filter(F.lit(save_404) & (F.col("outcome") == "not_found")).select(
        F.concat(F.lit("404_"), slug, F.lit("_"), ident, F.lit(".json")).alias("blob_name"),
        ident.alias("id"),
        F.col(norm_url).alias("url"),
        F.lit("").alias("content"),
        F.lit(404).alias("status"),
    )


def pdf_ok() -> Column:
    """A PDF answer: status 200 and a content type that names pdf."""
    return F.coalesce(
        (F.col("status") == 200) & F.lower("content_type").contains("pdf"), F.lit(False)
    )


def pdf_successes(attempts: DataFrame, retry_count: int | None = None) -> DataFrame:
    """(url, attempt) of the first PDF answer of each URL."""
    return (
        attempts.filter(pdf_ok() & _made(retry_count))
        .groupBy("url")
        .agg(F.min("attempt").alias("attempt"))
    )


def pdf_failures(attempts: DataFrame, retry_count: int | None = None) -> DataFrame:
    """(url, attempt, reason) of every attempt that gave no PDF."""
    reason = F.when(
        F.col("error").isNotNull(), F.concat(F.lit("PDF GET error: "), "error")
    ).otherwise(
        F.concat(F.lit("PDF HTTP "), F.col("status").cast("string"), F.lit(f" {GET_MARK}"))
    )
    return attempts.filter(~pdf_ok() & _made(retry_count)).select(
        "url", "attempt", reason.alias("reason")
    )


def reconcile(failed: DataFrame, successes: DataFrame) -> DataFrame:
    """(url, reason): failures left after successes.

    A URL that succeeded loses its status failures; its connection errors stay.
    Attempts after the success were never made.
    """
    joined = failed.join(
        successes.select("url", F.col("attempt").alias("_success")), "url", "left"
    )
    stays = F.col("_success").isNull() | (
        (F.col("attempt") < F.col("_success")) & ~F.col("reason").contains(GET_MARK)
    )
    return joined.filter(stays).select("url", "reason")


def latest_per_key(df: DataFrame, key: str, *newest_first: str) -> DataFrame:
    """One row per key, the one with the greatest order values.

    The rank limit also runs before the shuffle, so a hot key leaves each task
    as one row.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in newest_first])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
