"""Sitemap files as tables of locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.operators.rows import exploded

_SHAPE = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>"
_OPTIONS = {"ignoreNamespace": "true"}
# The namespace whose `loc` elements count, and the index's root.
NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
_ROOT = r"^(?:\uFEFF)?\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<(?:[\w.\-]+:)?([\w.\-]+)"


def _locs(entries: Column) -> Column:
    return F.transform(
        F.filter(entries, lambda e: F.coalesce(e["loc"], F.lit("")) != ""),
        lambda e: e["loc"],
    )


def sitemap_locs(sitemaps: DataFrame) -> DataFrame:
    """(sitemap_url, kind, pos, loc) of the sitemaps received.

    `kind` is index, whose locations are further sitemaps, or urlset. A file
    that is no XML, that has another namespace, or that was not received gives
    no rows.
    """
    root = F.regexp_extract("xml", f"(?s){_ROOT}", 1)
    parsed = (
        sitemaps.filter((F.col("status") == 200) & F.col("xml").contains(NAMESPACE))
        .select(
            "sitemap_url",
            root.alias("_root"),
            F.from_xml("xml", _SHAPE, _OPTIONS).alias("_doc"),
        )
        .select(
            "sitemap_url",
            F.when(F.col("_root").endswith("sitemapindex"), "index")
            .otherwise("urlset")
            .alias("kind"),
            F.concat(
                F.coalesce(_locs(F.col("_doc.sitemap")), F.array().cast("array<string>")),
                F.coalesce(_locs(F.col("_doc.url")), F.array().cast("array<string>")),
            ).alias("_locs"),
        )
    )
    return exploded(parsed, ["sitemap_url", "kind"], F.col("_locs"), "loc", "pos")
