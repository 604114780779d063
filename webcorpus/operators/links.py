"""Links of pages: extraction, resolution, filtering, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.urls import directory_base, normalize_url, real_links, url_part
from webcorpus.operators.extract import parse_pages
from webcorpus.operators.policy import allow_domain_semi, apply_skip
from webcorpus.operators.rows import exploded


def extract_links(pages: DataFrame, *keep: str) -> DataFrame:
    """(url, *keep, href): the distinct hrefs of each page's anchors."""
    return exploded(page_hrefs(pages, *keep), ["url", *keep], F.col("hrefs"), "href")


def union_links(*raw: DataFrame) -> DataFrame:
    """Union of raw link sets."""
    union = raw[0]
    for more in raw[1:]:
        union = union.unionByName(more)
    return union.distinct()


def page_hrefs(pages: DataFrame, *keep: str) -> DataFrame:
    """(url, *keep, hrefs): the same with the hrefs of a page in one array."""
    named = F.filter("hrefs", lambda h: h != "")
    return parse_pages(pages.select("url", *keep, "html")).select(
        "url", *keep, F.array_distinct(named).alias("hrefs")
    )


def resolve_links(linked: DataFrame, *keep: str, positions: bool = False) -> DataFrame:
    """(src_url, *keep, src_norm, dst_url, dst_norm, fragment), distinct per page.

    `linked` has (url, *keep, hrefs). Links are resolved and made distinct
    inside the row of their page, so nothing is shuffled. With `positions` also
    `pos`, a link's place on its page.
    """
    source = [F.col("url").alias("src_url"), *keep, normalize_url("url").alias("src_norm")]
    targets = real_links(directory_base("url"), "hrefs")
    more = ["pos"] if positions else []
    return exploded(linked, source, targets, "dst_url", *more).select(
        "src_url",
        *keep,
        "src_norm",
        "dst_url",
        normalize_url("dst_url").alias("dst_norm"),
        url_part("dst_url", "fragment").alias("fragment"),
        *more,
    )


def filter_links(
    links: DataFrame,
    domains: DataFrame | Sequence[str],
    skip_patterns: Sequence[str] = (),
) -> DataFrame:
    """Links to allowed domains that no skip pattern catches."""
    return apply_skip(
        allow_domain_semi(links, "dst_url", domains), "dst_url", skip_patterns
    )


def page_links(
    pages: DataFrame,
    domains: DataFrame | Sequence[str],
    skip_patterns: Sequence[str] = (),
) -> DataFrame:
    """Crawlable links of pages: extract, resolve, distinct, filter."""
    return filter_links(resolve_links(page_hrefs(pages)), domains, skip_patterns)


def distinct_links(links: DataFrame, *columns: str) -> DataFrame:
    return links.select(*(columns or ("src_url", "dst_url"))).distinct()


def link_counts(
    raw: DataFrame, filtered: DataFrame, key: str = "src_url"
) -> DataFrame:
    """(key, raw_links, kept_links) per page.

    `raw` has (key, href) and `filtered` has (key, dst_url), both distinct, so
    both sides are plain counts that combine before the one shuffle.
    """
    tagged = raw.select(key, F.lit(0).alias("_kept")).unionByName(
        filtered.select(key, F.lit(1).alias("_kept"))
    )
    return tagged.groupBy(key).agg(
        F.count_if(F.col("_kept") == 0).alias("raw_links"),
        F.count_if(F.col("_kept") == 1).alias("kept_links"),
    )
