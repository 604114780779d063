"""Word and Excel files to text, and PDF pages through a reader the caller gives.

One file is one row and one text: files are decoded where they were read and
nothing is shuffled.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import non_blank
from webcorpus.session import ddl

# XML names of the two formats.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_RUN_TEXT = {f"{_W}tab": "\t", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}


def _run_text(run: ElementTree.Element) -> str:
    pieces = []
    for node in run:
        if node.tag == f"{_W}t":
            pieces.append(node.text or "")
        elif node.tag == f"{_W}br":
            pieces.append("\n" if node.get(f"{_W}type", "textWrapping") == "textWrapping" else "")
        else:
            pieces.append(_RUN_TEXT.get(node.tag, ""))
    return "".join(pieces)


def docx_paragraphs(content: bytes) -> list[str]:
    """Text of the paragraphs that lie directly in the body, in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    texts = []
    for paragraph in body.findall(f"{_W}p"):
        runs = (
            run
            for child in paragraph
            for run in ([child] if child.tag == f"{_W}r" else child.findall(f"{_W}r"))
            if child.tag in (f"{_W}r", f"{_W}hyperlink")
        )
        texts.append("".join(map(_run_text, runs)))
    return texts


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _cell_text(cell: ElementTree.Element, shared: list[str]) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_S}t"))
    value = cell.findtext(f"{_S}v") or ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    return value


def _sheet_rows(root: ElementTree.Element, shared: list[str]) -> list[list[str]]:
    """Rows as lists of equal length, gaps as empty text, empty end rows cut."""
    rows: dict[int, dict[int, str]] = {}
    for at, row in enumerate(root.iter(f"{_S}row")):
        number = int(row.get("r", at + 1)) - 1
        cells = rows.setdefault(number, {})
        for position, cell in enumerate(row.findall(f"{_S}c")):
            where = cell.get("r")
            cells[_column_index(where) if where else position] = _cell_text(cell, shared)
    filled = [n for n, cells in rows.items() if any(cells.values())]
    if not filled:
        return []
    width = 1 + max(c for cells in rows.values() for c in cells)
    return [
        [rows.get(n, {}).get(c, "") for c in range(width)] for n in range(max(filled) + 1)
    ]


def xlsx_lines(content: bytes) -> list[str]:
    """Rows of all sheets, cells joined by a blank, first row of each sheet left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = set(archive.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            table = ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))
            shared = [
                "".join(t.text or "" for t in item.iter(f"{_S}t"))
                for item in table.findall(f"{_S}si")
            ]
        targets = {
            rel.get("Id"): rel.get("Target")
            for rel in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
        }
        book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
        lines = []
        for sheet in book.iter(f"{_S}sheet"):
            target = targets[sheet.get(_REL)]
            part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            rows = _sheet_rows(ElementTree.fromstring(archive.read(part)), shared)
            lines.extend(" ".join(row) for row in rows[1:])
    return lines


def decode(
    files: DataFrame,
    reader: Callable[[bytes], Iterable[str | None]],
    separator: str,
    label: str,
) -> DataFrame:
    """Replace `content` by `text` and `error`, with a reader that gives the parts.

    A file that cannot be read gives a null text and the reason.
    """
    kept = [field for field in files.schema.fields if field.name != "content"]

    def one(content: bytes) -> tuple[str | None, str | None]:
        try:
            return separator.join(part or "" for part in reader(content)), None
        except Exception as error:  # noqa: BLE001 - any broken file is a failure row
            return None, f"{label} parse error: {error}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns="content")
            decoded = [one(content) for content in batch["content"]]
            out["text"] = [text for text, _ in decoded]
            out["error"] = [error for _, error in decoded]
            yield out

    return files.select(*[f.name for f in kept], "content").mapInPandas(
        run, f"{ddl(kept)}, text string, error string"
    )


def documents_of(decoded: DataFrame) -> DataFrame:
    """Decoded files with some text in them."""
    return decoded.filter(non_blank("text")).drop("error")


def failures_of(decoded: DataFrame, url: str = "url") -> DataFrame:
    return decoded.filter(F.col("error").isNotNull()).select(
        F.col(url).alias("url"), F.col("error").alias("reason")
    )


def docx_text(files: DataFrame) -> DataFrame:
    return decode(files, docx_paragraphs, "\n", "DOCX")


def xlsx_text(files: DataFrame) -> DataFrame:
    return decode(files, xlsx_lines, "\n", "XLSX")


def pdf_binary_text(
    files: DataFrame, reader: Callable[[bytes], Iterable[str | None]]
) -> DataFrame:
    """PDF files to text; `reader` gives the texts of the pages in order."""
    return decode(files, reader, "", "PDF")
