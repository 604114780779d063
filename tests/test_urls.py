from urllib.parse import urljoin

from pyspark.sql import functions as F

from webcorpus.functions import urls as U

URLS = [
    "http://WWW.Ex.com:80/a/b;p=1/c;q?x#f",
    "example.com/x",
    "mailto:q@z",
    "",
    "/",
    "https://mywww.x/",
    "//h/x//",
    "  https://a/b\n",
    "HTTP://u:p@WWW.h/P//?q",
    "tel:123",
    "https://ex.com/Größe und mehr/",
]
BASES = [
    "https://ex.com/a/b",
    "https://ex.com/a/b/",
    "https://ex.com/a/b/?q=1",
    "https://ex.com?q",
    "http://h/x;p/y;z",
    "https://ex.com/a//b/c",
    "https://u@ex.com:8080/a",
]
HREFS = [
    "c", "#f", "?p=2", "../../../x", "//cdn.com/z", "./x/../y/", "mailto:q@z", "/p", "/p/../q",
    "..", ".", "./", "../", "g;x=1/./y", "a//b", "/a//b", "https:foo", "http://o/x?y#z", "", "/",
    "x y", "?q#f", "a/./b", "...", "/..",
]


def _map(spark, values, column):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, u string")
    return [r[0] for r in df.orderBy("i").select(column.alias("x")).collect()]


NORMAL = [
    "https://ex.com:80/a/b;p=1/c",
    "https:example.com/x",
    "https:q@z",
    "https://",
    "https://",
    "https://myx",
    "https://h/x",
    "https://a/b",
    "https://u:p@h/P",
    "https:123",
    "https://ex.com/Größe und mehr",
]


def test_normalize_cases(spark):
    assert _map(spark, URLS, U.normalize_url("u")) == NORMAL


def test_normalize_is_idempotent(spark):
    once = [n for n in _map(spark, URLS, U.normalize_url("u")) if ";" not in n]
    assert _map(spark, once, U.normalize_url("u")) == once


def test_resolve_equals_standard_library(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    got = spark.createDataFrame(pairs, "b string, h string").select(
        "b", "h", U.resolve("b", "h").alias("r")
    )
    for row in got.collect():
        assert row.r == urljoin(row.b, row.h), (row.b, row.h)


def test_real_link_cases(spark):
    cases = {
        None: None,
        "": None,
        "   ": "https://ex.com/a",
        "#": "https://ex.com/a/",
        " #x ": "https://ex.com/a/#x",
        "?q": "https://ex.com/a",
        "//H/p/": "https://h/p",
        "../p#f": "https://ex.com/p",
        "javascript:window.open('a.pdf')": "https://ex.com/a/a.pdf",
        'JavaScript:window.open("/d/B.Docx","w")': "https://ex.com/d/B.Docx",
        "javascript:window.open('a.pdf\")": None,
        "javascript:window.open('a.doc')": None,
        "javascript:window.open('a.xls')": None,
        "javascript:void(0)": None,
    }
    got = _map(spark, list(cases), U.real_link(F.lit("https://ex.com/a/"), "u"))
    assert got == list(cases.values())


def test_real_links_are_distinct_and_keep_order(spark):
    df = spark.createDataFrame([(["b", "b/", None, "javascript:x", "#t"],)], "h array<string>")
    got = df.select(U.real_links(F.lit("https://ex.com/a/"), "h")).first()[0]
    assert got == ["https://ex.com/a/b", "https://ex.com/a/#t"]


def test_blob_names(spark):
    names = _map(spark, ["https://ex.com", "https://ex.com/", "https://EX.com/A-b/#S 1"], U.blob_stem("u"))
    assert names == ["root", "", "a_b_s_1"]
    first, second = _map(spark, ["https://www.Ex.com/a/", "https://ex.com/a"], U.blob_name("u", F.lit(2)))
    assert first == second and first.startswith("a_2_") and first.endswith(".json")


def test_directory_base(spark):
    cases = {
        "http://x/a": "http://x/a/",
        "http://x/a/": "http://x/a/",
        "http://x/a.html": "http://x/a.html",
        "http://x": "http://x/",
        "http://x/a?q=1": "http://x/a?q=1/",
    }
    assert _map(spark, list(cases), U.directory_base("u")) == list(cases.values())
