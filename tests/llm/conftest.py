import pytest

ODD_COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
    "score double, size long, copy int, class_id string, spans int, cid int, component int"
)


def row(doc_id, text, source="a"):
    size = None if text is None else len(text)
    return (doc_id, text, "en", source, size, True, 9.0, -1, 7, "x", 3, 4, 5)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) with extra columns that clash with results."""

    def make(rows):
        return spark.createDataFrame([row(*r) for r in rows], ODD_COLUMNS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and blank texts, a null id, repeated rows, a very long text."""
    prose = "one two three four five six seven eight nine ten " * 6
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "tiny"),
        (None, prose + "with no id", None),
        (5, prose + "tail"),
        (5, prose + "tail"),
        (6, "wörter 日本 \U0001f600 " * 30, None),
        (7, " ".join(f"word{k % 9001}" for k in range(30_000)), "b"),
        (8, "x" * 5_000, "b"),
    ]


@pytest.fixture(scope="session")
def make_labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
