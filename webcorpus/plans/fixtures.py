"""Inputs that the tables do not hold, worked out from them row by row.

Robots files, sitemaps, fetch attempts, office files: each grows with the table
it comes from. Only the registered queries and the tests use this module.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.markup import hrefs
from webcorpus.functions.urls import host_key, normalize_url
from webcorpus.sources.sitemaps import NAMESPACE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_rows(documents: DataFrame) -> DataFrame:
    """Documents as (url, text, last_modified)."""
    return documents.select(
        F.format_string("https://corpus.example/%s/%d", "source", "doc_id").alias("url"),
        "text",
        F.concat(F.lit("v"), (F.col("doc_id") % 3).cast("string")).alias("last_modified"),
    )


def page_edges(pages: DataFrame, position: str | None = None) -> DataFrame:
    """(src_norm, dst_url, dst_norm): page n links to pages 2n+1 and 3n+2 (mod count).

    With `position` also the page's URL as src_url and the link's place on it.
    """
    total = pages.agg(F.count(F.lit(1))).scalar()
    numbered = pages.select("page_id", "url", total.alias("_n"))
    target = F.posexplode(
        F.array(
            (F.col("page_id") * 2 + 1) % F.col("_n"), (F.col("page_id") * 3 + 2) % F.col("_n")
        )
    ).alias("_pos", "_target")
    wanted = numbered.select(
        normalize_url("url").alias("src_norm"), F.col("url").alias("src_url"), target
    ).withColumnRenamed("_target", "page_id")
    more = ["src_url", F.col("_pos").alias(position)] if position else []
    return wanted.join(
        pages.select("page_id", F.col("url").alias("dst_url")), "page_id"
    ).select("src_norm", "dst_url", normalize_url("dst_url").alias("dst_norm"), *more)


def host_seeds(pages: DataFrame) -> DataFrame:
    """(seed): the smallest URL of each host."""
    return (
        pages.groupBy(host_key("url").alias("host"))
        .agg(F.min("url").alias("seed"))
        .select("seed")
    )


def sitemap_rows(pages: DataFrame) -> DataFrame:
    """(sitemap_url, kind, pos, loc): one index per top-level domain that lists
    itself and the sitemap of each host; a host's sitemap lists its pages."""
    hosted = pages.select("page_id", "url", host_key("url").alias("host"))
    host_map = F.concat(F.lit("https://"), "host", F.lit("/sitemap.xml"))
    top_map = F.concat(
        F.lit("https://index.example."), F.substring_index("host", ".", -1), F.lit("/sitemap.xml")
    )
    leaves = hosted.select(
        host_map.alias("sitemap_url"),
        F.lit("urlset").alias("kind"),
        F.col("page_id").alias("pos"),
        F.col("url").alias("loc"),
    )
    listed = hosted.select(
        top_map.alias("sitemap_url"),
        F.explode(F.array(top_map, host_map)).alias("loc"),
    ).distinct()
    index = listed.select(
        "sitemap_url", F.lit("index").alias("kind"), F.lit(0).cast("long").alias("pos"), "loc"
    )
    return leaves.unionByName(index)


def sitemap_files(pages: DataFrame) -> DataFrame:
    """(sitemap_url, status, xml): each page's hrefs as a sitemap file.

    Odd pages use a namespace prefix, every third file is an index, every
    fifth was not received, every seventh is cut off.
    """
    odd, third = F.col("page_id") % 2 == 1, F.col("page_id") % 3 == 0
    prefix = F.when(odd, "sm:").otherwise("")
    declaration = F.when(odd, f'xmlns:sm="{NAMESPACE}"').otherwise(f'xmlns="{NAMESPACE}"')
    root = F.when(third, "sitemapindex").otherwise("urlset")
    item = F.when(third, "sitemap").otherwise("url")
    escaped = F.transform(
        hrefs(F.col("html")),
        lambda h: F.replace(
            F.replace(h, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")
        ),
    )
    entries = F.transform(
        escaped,
        lambda loc: F.concat(
            F.lit("<"), prefix, item, F.lit("><"), prefix, F.lit("loc>"), loc,
            F.lit("</"), prefix, F.lit("loc></"), prefix, item, F.lit(">"),
        ),
    )
    body = F.concat(
        F.lit('<?xml version="1.0"?>\n<'), prefix, root, F.lit(" "), declaration, F.lit(">"),
        F.array_join(entries, ""), F.lit("</"), prefix, root, F.lit(">"),
    )
    return pages.select(
        "page_id", F.col("url").alias("sitemap_url"), body.alias("xml")
    ).select(
        "sitemap_url",
        F.when(F.col("page_id") % 5 == 4, 404).otherwise(200).alias("status"),
        F.when(F.col("page_id") % 7 == 6, F.expr("left(xml, length(xml) - 12)"))
        .otherwise(F.col("xml"))
        .alias("xml"),
    )


def robots_files(pages: DataFrame) -> DataFrame:
    """(base, status, body): a robots file per host, shaped by its pages.

    Statuses vary with the length of the host: received, gone, forbidden,
    failing, never received.
    """
    number = F.regexp_extract("url", "/([0-9]+)", 1)
    hosts = pages.groupBy(host_key("url").alias("host")).agg(
        F.min(number).alias("low"), F.max(number).alias("high")
    )
    kind = F.length("host") % 6
    body = F.concat(
        F.lit("# rules of "), "host",
        F.lit("\nUser-agent: OtherBot\nDisallow: /\n\nUser-agent: Mozilla # browser\n"),
        F.lit("User-Agent: second\nCrawl-delay: 2\nAllow: /en/"), "low",
        F.lit("\nDisallow: /en/\ndisallow:/de/"), "high",
        F.lit("\nSitemap: https://"), "host",
        F.lit("/sitemap.xml\n\nDisallow: /lost\nUser-agent: *\nDisallow: /f%72/\n"),
        F.when(F.length("host") % 2 == 0, "User-agent: late\nDisallow:\n").otherwise(""),
    )
    return hosts.select(
        F.concat(F.lit("https://"), "host").alias("base"),
        F.when(kind == 0, 404)
        .when(kind == 1, 403)
        .when(kind == 2, F.lit(None).cast("int"))
        .when(kind == 3, 503)
        .otherwise(200)
        .alias("status"),
        body.alias("body"),
    )


def fetch_attempts(events: DataFrame) -> DataFrame:
    """(url, attempt, status, content_type, error): events as fetch attempts.

    Three events in a row are the attempts of one URL; statuses follow the
    event number.
    """
    n = F.col("event_id")
    status = (
        F.when(n % 13 < 5, 200)
        .when(n % 13 == 5, 404)
        .when(n % 13 == 6, 403)
        .when(n % 13 < 9, 429)
        .when(n % 13 < 11, 503)
    )
    return events.select(
        F.format_string("https://fetch.example/%s/%d", "event_type", F.floor(n / 3)).alias(
            "url"
        ),
        (n % 3 + 1).cast("int").alias("attempt"),
        status.alias("status"),
        F.when(n % 4 == 0, "text/html").otherwise("application/PDF").alias("content_type"),
        F.when(status.isNull(), "timed out").alias("error"),
    )


# --- office files, one per document row ---------------------------------------

_W_NS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_S_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_R_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_P_NS = "http://schemas.openxmlformats.org/package/2006/relationships"


def _zip(parts: dict[str, str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def docx_bytes(paragraphs: list[str]) -> bytes:
    """A Word file with these paragraphs."""
    body = "".join(
        f'<w:p><w:r><w:t xml:space="preserve">{escape(p)}</w:t></w:r></w:p>'
        for p in paragraphs
    )
    document = f'<w:document xmlns:w="{_W_NS}"><w:body>{body}</w:body></w:document>'
    return _zip({"word/document.xml": document})


def xlsx_bytes(sheets: list[list[list[str]]]) -> bytes:
    """An Excel file with these sheets of rows of cells."""
    names, relations, parts = [], [], {}
    for number, rows in enumerate(sheets, 1):
        names.append(f'<sheet name="s{number}" sheetId="{number}" r:id="rId{number}"/>')
        relations.append(
            f'<Relationship Id="rId{number}" Target="worksheets/sheet{number}.xml"/>'
        )
        data = "".join(
            "<row>"
            + "".join(f'<c t="inlineStr"><is><t>{escape(c)}</t></is></c>' for c in row)
            + "</row>"
            for row in rows
        )
        parts[f"xl/worksheets/sheet{number}.xml"] = (
            f'<worksheet xmlns="{_S_NS}"><sheetData>{data}</sheetData></worksheet>'
        )
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{_S_NS}" xmlns:r="{_R_NS}"><sheets>{"".join(names)}</sheets></workbook>'
    )
    parts["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="{_P_NS}">{"".join(relations)}</Relationships>'
    )
    return _zip(parts)


def _docx_of(text: str) -> bytes:
    return docx_bytes(text.split("\n"))


def _xlsx_of(text: str) -> bytes:
    return xlsx_bytes([[["name", "value"]] + [[line, "x"] for line in text.split("\n")]])


def office_files(documents: DataFrame, kind: str) -> DataFrame:
    """(doc_id, content): each document as a Word or Excel file, line by line."""
    make = {"docx": _docx_of, "xlsx": _xlsx_of}[kind]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "content": [make(t) for t in batch["text"]]}
            )

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, content binary")
