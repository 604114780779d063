import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webcorpus.functions import text as X
from webcorpus.operators.extract import filter_lines
from webcorpus.operators.ordered import carry_forward, join_cells, join_pages, join_parts

ALPHABET = st.sampled_from(
    ["a", "longword", " ", "\n", "\r\n", "\u00a0", "\u2028", "select language", "powered by translate", "\u00e9."]
)
TEXTS = st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=1, max_size=20)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column).first()[0]


def _filtered(text):
    kept, inside = [], False
    for line in text.splitlines():
        low = line.lower()
        if "select language" in low or (
            len(line) > 40 and sum(len(word) > 5 for word in line.split()) > 4
        ):
            inside = True
        elif inside:
            inside = not ("powered by translate" in low or not line.strip())
        else:
            kept.append(line)
    return "\n".join(kept)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_line_filter_forms_agree(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    rows = df.select("k", X.drop_language_blocks("text").alias("f")).collect()
    array = {r.k: r.f for r in rows}
    assert array == {k: _filtered(t) for k, t in enumerate(texts)}
    window = {r.k: r.text for r in filter_lines(df, ["k"]).collect()}
    assert {k: window.get(k, "") for k in array} == array


def test_line_filter_over_rows_in_order(spark):
    rows = [(1, 2, "powered by translate\nz"), (1, 0, "a\nselect language"), (1, 1, "x\ny")]
    df = spark.createDataFrame(rows, "k int, at int, text string")
    assert filter_lines(df, ["k"], order="at").first().text == "a\nz"


def test_line_filter_of_a_key_with_a_million_lines(spark):
    """Cut over rows of several lines: each row is read once, the key is not sorted in one task."""
    lines = ["plain", "select language", "inside", "", "after", "more"]
    rows, per = 25_000, 40
    cut = spark.range(rows, numPartitions=4).select(
        F.lit("hot").alias("k"), F.col("id").cast("int").alias("at"),
        F.expr(f"array_join(transform(sequence(0, {per - 1}), j -> element_at(array({', '.join(repr(x) for x in lines)}), cast((id * {per} + j) div 7 % 6 + 1 as int))), chr(10))").alias("text"),
    )
    got = filter_lines(cut, ["k"], order="at")
    pieces = [[lines[(at * per + j) // 7 % 6] for j in range(per)] for at in range(rows)]
    # A line break at the end of a row opens no further line.
    every = "\n".join(line for piece in pieces for line in (piece if piece[-1] else piece[:-1]))
    assert got.count() == 1 and got.first().text == _filtered(every)


def test_short_remainder_falls_back(spark):
    for length, kept in ((200, False), (201, True)):
        body = "x" * length + "\nselect language"
        assert (one(spark, body, X.clean_lines("t")) == "x" * length) is kept


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("abcdefgh", "abcde"),
        (".bcdefgh", ".bcde"),
        ("abcd.fgh", "abcd."),
        ("ab de gh", "ab"),
        ("abcde", "abcde"),
        ("a\n\u00a0b efg", "a\n\u00a0b"),
    ],
)
def test_truncate(spark, text, expected):
    assert one(spark, text, X.truncate_text("t", 5)) == expected


@pytest.mark.parametrize("count", [0, 1, 9, 10, 11, 70, 71])
def test_windows_cover_and_overlap(spark, count):
    words = [f"w{i} " for i in range(count)]
    windows = one(spark, "".join(words), X.token_windows(X.tokenize("t"), 10, 3))
    assert windows == ["".join(words[i : i + 10]) for i in range(0, count, 7)]


def test_window_overlap_must_be_smaller_than_size():
    with pytest.raises(ValueError):
        X._step(5, 5)


def test_tokens_give_the_text_back(spark):
    for text in ("  a b\n\nc ", " ", "a", "é ü\tz"):
        assert "".join(one(spark, text, X.tokenize("t"))) == text


def test_headers_and_dates(spark):
    df = spark.sql(
        "select map('LAST-modified', 'x') h, timestamp'2024-01-02 03:04:05' t"
        " union all select null, timestamp'2024-01-02 03:04:05'"
    )
    got = [r[0] for r in df.select(X.last_modified("h", "t")).collect()]
    assert sorted(got) == ["2024-01-02T03:04:05Z", "x"]


def test_ordered_concat_crosses_blocks(spark):
    rows = [("u", i, str(i)) for i in range(9999, -1, -1)]
    df = spark.createDataFrame(rows, "url string, part_no int, text string")
    assert join_parts(df).first().text == "\n".join(map(str, range(10000)))
    pages = spark.createDataFrame([("u", 1, None), ("u", 2, "b"), ("u", 0, "a")], "url string, page_no int, text string")
    assert join_pages(pages).first().text == "ab"
    cells = spark.createDataFrame(
        [("u", s, r, c, f"{s}{r}{c}") for s in (0, 1) for r in (0, 1, 2) for c in (0, 1)],
        "url string, sheet_no int, row_no int, col_no int, value string",
    )
    assert join_cells(cells).first().text == "010 011\n020 021\n110 111\n120 121"


def test_carry_forward_crosses_blocks(spark):
    rows = [("k", i, {3: "x", 17: "y"}.get(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, at int, e string")
    got = {r.at: r.s for r in carry_forward(df, ["k"], "at", "e", "s", block=4).collect()}
    assert got == {i: None if i <= 3 else "x" if i <= 17 else "y" for i in range(40)}
