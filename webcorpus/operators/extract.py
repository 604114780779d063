"""Page text and panes.

Two routes give the main text. The column route is one projection inside the
JVM. The tree route walks the elements in Arrow batches and follows id and
class selectors and nested elements exactly; it reads each page once for text,
links and panes together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.markup import visible_text
from webcorpus.functions.text import (
    clean_lines,
    last_mark,
    mark_lines,
    non_blank,
    truncate_text,
    unblocked_lines,
)
from webcorpus.functions.urls import resolve
from webcorpus.operators.dom import walk
from webcorpus.operators.ordered import carry_forward, ordered_concat
from webcorpus.operators.rows import exploded, small_batches
from webcorpus.session import ddl, materialize


def main_text_column(html: Column | str, drop_language_blocks: bool = True) -> Column:
    """Main text of a page by the column route."""
    text = visible_text(F.col(html) if isinstance(html, str) else html)
    return clean_lines(text) if drop_language_blocks else text


def parse_pages(
    pages: DataFrame,
    article_first: bool = True,
    all_panes: bool = False,
    drop_language_blocks: bool = True,
) -> DataFrame:
    """Replace `html` by `text`, `hrefs` and `panes` (id, text), tree route.

    `panes` has the elements that the page's own `#id` links point to, or all
    elements with an id. A page that the parser gives up on has an empty text,
    no links and panes, and says why in `parse_error`, which is null elsewhere.
    `drop_language_blocks` applies `clean_lines`, which can drop prose too. A task
    holds what it made of some pages at a time, however many a batch has.
    """
    kept = [f for f in pages.schema.fields if f.name != "html"]

    def parsed_page(html: str | None) -> tuple:
        try:
            return (*walk(html or "", article_first, all_panes), None)
        except Exception as error:  # noqa: BLE001 - one bad page is one failure row
            return "", [], [], f"{type(error).__name__}: {error}"

    names = [f.name for f in kept]
    pane = pa.struct([("id", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            walked = [parsed_page(html.as_py()) for html in batch["html"]]
            panes = [[{"id": ident, "text": text} for ident, text in page[2]] for page in walked]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[name] for name in names],
                    pa.array([page[0] for page in walked], pa.string()),
                    pa.array([page[1] for page in walked], pa.list_(pa.string())),
                    pa.array(panes, pa.list_(pane)),
                    pa.array([page[3] for page in walked], pa.string()),
                ],
                names=[*names, "text", "hrefs", "panes", "parse_error"],
            )

    made = (
        "text string, hrefs array<string>, panes array<struct<id:string,text:string>>, "
        "parse_error string"
    )
    schema = f"{ddl(kept)}, {made}" if kept else made
    parsed = pages.select(*names, "html").mapInArrow(run, schema)
    return parsed.withColumn("text", clean_lines("text")) if drop_language_blocks else parsed


def main_text(
    pages: DataFrame,
    route: str = "tree",
    max_chars: int | None = None,
    drop_language_blocks: bool = True,
) -> DataFrame:
    """Replace `html` by the main text: the whole of it, or `max_chars` at most."""
    if route == "column":
        text = main_text_column("html", drop_language_blocks)
        texts = pages.withColumn("text", text).drop("html")
    elif route == "tree":
        parsed = parse_pages(pages, drop_language_blocks=drop_language_blocks)
        texts = parsed.drop("hrefs", "panes", "parse_error")
    else:
        raise ValueError(f"route must be tree or column, not {route}")
    if max_chars is None:
        return texts
    return texts.withColumn("text", truncate_text("text", max_chars))


def filter_lines(
    df: DataFrame, keys: Sequence[str], text: str = "text", order: str | None = None
) -> DataFrame:
    """Language-block filter: (keys, text) of what is left.

    Without `order` every row is a whole text and is filtered in place. With it a
    text is cut over several rows, and the integer `order` gives their sequence:
    each row is read once and says how it leaves the state, in block or not; the
    state before it follows from a scan over these short rows, in blocks of
    positions, so no key is worked on in one task. A key of which nothing is left
    gives no row.
    """
    marked = df.filter(F.col(text).isNotNull()).select(
        *keys, *([order] if order else []), mark_lines(text).alias("_marked")
    )
    if order is None:
        kept = marked.select(*keys, unblocked_lines(F.col("_marked")).alias("_lines"))
        return kept.filter(F.size("_lines") > 0).select(
            *keys, F.array_join("_lines", "\n").alias(text)
        )
    rows = materialize(marked.withColumn("_event", last_mark(F.col("_marked"))), "marked")
    before = carry_forward(rows.select(*keys, order, "_event"), keys, order, "_event", "_state")
    inside = F.coalesce(F.col("_state") == 1, F.lit(False))
    kept = (
        rows.select(*keys, order, "_marked")
        .join(before.select(*keys, order, inside.alias("_inside")), [*keys, order])
        .select(*keys, order, unblocked_lines(F.col("_marked"), F.col("_inside")).alias("_lines"))
        .filter(F.size("_lines") > 0)
        .select(*keys, order, F.array_join("_lines", "\n").alias(text))
    )
    return ordered_concat(kept, keys, order, text, "\n")


def panes_of(parsed: DataFrame, *keep: str) -> DataFrame:
    """(*keep, id, text): the elements with an id and some text, one row each."""
    return parsed.select(*keep, F.explode("panes").alias("_pane")).select(
        *keep, F.col("_pane.id").alias("id"), F.col("_pane.text").alias("text")
    )


def fragment_docs(
    links: DataFrame, panes: DataFrame, key: str = "page_id", base: str = "src_url"
) -> DataFrame:
    """Panes that an in-page link points to, each as a document `base#fragment`.

    `links` has (key, base, fragment); a fragment linked twice counts once.
    """
    wanted = links.filter("fragment <> ''").select(key, base, "fragment").distinct()
    return (
        wanted.join(
            panes.select(key, F.col("id").alias("fragment"), "text"), [key, "fragment"]
        )
        .filter(non_blank("text"))
        .select(key, resolve(base, F.concat(F.lit("#"), "fragment")).alias("url"), "text")
    )


def fragment_docs_in_row(
    parsed: DataFrame, base: Column, wanted: Column, *keep: str
) -> DataFrame:
    """The same for parsed pages, whose links and panes are in one row: no join."""
    hits = F.filter("panes", lambda p: F.array_contains(wanted, p["id"]))
    return (
        exploded(parsed, [*keep, base.alias("_base")], hits, "_pane")
        .select(
            *keep,
            resolve(F.col("_base"), F.concat(F.lit("#"), F.col("_pane.id"))).alias("url"),
            F.col("_pane.text").alias("text"),
        )
        .filter(non_blank("text"))
    )
