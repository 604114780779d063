import io
import time
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webcorpus.config import CrawlConfig
from webcorpus.functions import markup as M
from webcorpus.operators import chunks as C
from webcorpus.operators import extract, keyed, links, store
from webcorpus.operators.dom import walk
from webcorpus.operators.rows import small_batches
from webcorpus.plans import corpus
from webcorpus.plans import fixtures as I
from webcorpus.plans.corpus import RECORD, CrawlInputs, run_crawl
from webcorpus.plans.queries import QUERIES
from webcorpus.sources import office
from webcorpus.sources.pages import read_binary, size_cut
from webcorpus.sources.state import read_seen
from webcorpus.streaming import ingest as S

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<body><nav>n</nav>a<b>b</b> c <!-- x -->d</body>", "a\nb\nc\nd"),
        ("<title>t</title>x", "t\nx"),
        ("<title>t</title><body>x<main>m</main></body>", "m"),
        ("<body>x<div id='main-content'>m</div></body>", "m"),
        ("<body>x<div class='a content'>m<div>n</div></div>y</body>", "m\nn"),
        ("<body><aside>q<aside>r</aside>s</aside>t</body>", "t"),
        ("<body><p class='cookie-bar'>q</p><p id='x-lang'>r</p><p class='sidebar x'>s</p>t</body>", "t"),
        ("<body class='lang-en'>x</body>", ""),
        ("<body>a<article>b<header>h</header><main>m</main></article></body>", "m"),
        ("<body>a<article>b<p>c<p>d</article>e</body>", "b\nc\nd"),
        ("<body><main></main>x<main>y</main></body>", ""),
        ("a &amp;amp; b&nbsp;<br/>&copy;<script>s</script><noscript>n</noscript>", "a &amp; b\n©"),
        ("<body>x</i></b>y<b>z", "xy\nz"),
        ("<body>unclosed <form>f", "unclosed"),
        ("", ""),
    ],
)
def test_main_text(html, text):
    assert walk(html)[0] == text


def test_links_and_panes_of_a_page():
    html = (
        "<body><a href='#p'>1</a><a href=' #q '>2</a><a href=''>3</a><a>4</a><a href='/x?a=1&amp;b=2'>5</a>"
        "<noscript><a href='/no'>n</a></noscript><nav id='p'>nav<i>i</i></nav><p id='p'>second</p>"
        "<p id='q'> </p><p id='r'>r</p></body>"
    )
    text, hrefs, panes = walk(html)
    assert hrefs == ["#p", " #q ", "/x?a=1&b=2"]
    assert panes == [("p", "nav\ni")]
    assert walk(html, all_panes=True)[2] == [("p", "nav\ni"), ("r", "r")]


def test_routes_agree(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html")
    column = extract.main_text(pages, "column").withColumnRenamed("text", "column")
    tree = extract.main_text(pages, "tree").withColumnRenamed("text", "tree")
    both = column.join(tree, "page_id")
    assert both.count() == 250 and both.filter("column <> tree").count() == 0
    parsed = extract.parse_pages(pages)
    found = pages.select("page_id", M.hrefs(F.col("html")).alias("h")).join(parsed, "page_id")
    assert found.filter("array_sort(h) <> array_sort(hrefs)").count() == 0


def test_bad_pages_become_errors(spark):
    pages = [
        ("bad", "<![foo[x]]>a"),
        ("nested", "<nav>a<nav>b</nav>c</nav><p>kept</p>"),
        ("cookie", '<div class="cookie">eat</div><p>kept</p>'),
        ("entities", "<p>caf&eacute; it&#8217;s</p>"),
        ("forms", "<form>" * 16_000 + "x"),
        ("null", None),
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    start = time.perf_counter()
    found = {r.url: r for r in extract.parse_pages(df).collect()}
    assert time.perf_counter() - start < 20
    assert found["bad"].text == "" and "Error" in found["bad"].parse_error
    assert all(r.parse_error is None for u, r in found.items() if u != "bad")
    assert found["nested"].text == found["cookie"].text == "kept"
    assert found["entities"].text == "caf\u00e9 it\u2019s"
    assert links.extract_links(df).count() == 0


def test_whole_texts_unless_limited(spark):
    df = spark.createDataFrame([("<p>" + "word " * 120_000 + "last</p>",)], "html string")
    assert extract.main_text(df).first().text.endswith("last")
    assert len(extract.main_text(df, max_chars=1_000).first().text) <= 1_000


def test_anchor_forms(spark):
    html = "<a href=/a>1</a><A class=x HREF='/b'>2</a><a data-href='/c'>3</a><!-- <a href='/d'> --><a\nhref = \"/e&amp;f\">"
    df = spark.createDataFrame([("https://x/y/", html)], "url string, html string")
    assert sorted(r.href for r in links.extract_links(df).collect()) == ["/a", "/b", "/e&f"]
    got = links.page_links(df, ["x"], ["/b$"])
    assert sorted(r.dst_url for r in got.collect()) == ["https://x/a", "https://x/e&f"]


def test_links_and_chunks_do_not_shuffle(spark):
    pages = I.table(spark, SF, "pages")
    for df in (links.page_links(pages, ["example.com"]), C.emit_chunks(I.document_rows(I.table(spark, SF, "documents")), 50, 10)):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        assert "Exchange" not in df._jdf.queryExecution().explainString(mode)


def _docx(body):
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{ns}"><w:body>{body}</w:body></w:document>')
    return buffer.getvalue()


def test_office_files(spark, tmp_path):
    paragraphs = (
        "<w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/></w:r><w:hyperlink><w:r><w:t>c</w:t></w:r></w:hyperlink></w:p>"
        "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>table</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p/><w:p><w:r><w:t>d</w:t></w:r></w:p>"
    )
    (tmp_path / "a.docx").write_bytes(_docx(paragraphs))
    (tmp_path / "b.docx").write_bytes(b"no zip")
    (tmp_path / "c.docx").write_bytes(_docx("<w:p/>"))
    (tmp_path / "d.xlsx").write_bytes(I.xlsx_bytes([[["h", "k"], ["1"], [], ["", "2"]], [["only"]], [["h"], ["3"]]]))
    read = office.docx_text(read_binary(spark, str(tmp_path), "docx"))
    assert [r.text for r in office.documents_of(read).collect()] == ["a\tb\nc\n\nd"]
    broken = office.failures_of(read, "path").collect()
    assert len(broken) == 1 and broken[0].reason.startswith("DOCX parse error: ")
    sheets = office.xlsx_text(read_binary(spark, str(tmp_path), "xlsx"))
    assert [r.text for r in sheets.collect()] == ["1 \n \n 2\n3"]
    assert office.pdf_binary_text(read_binary(spark, str(tmp_path), "xlsx"), lambda b: ["x", None, "y"]).first().text == "xy"
    limited = read_binary(spark, str(tmp_path), max_bytes=10)
    assert [r.length for r in limited.select("length").collect()] == [6]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert "LessThanOrEqual(length,10)" in limited._jdf.queryExecution().explainString(mode)
    sized = spark.createDataFrame([(1,), (None,), (5,)], "length int")
    assert size_cut(sized, 4).count() == 2


def test_whole_run(spark, tmp_path):
    long_text = "word " * 60
    html = {
        "https://x.org/": "<body><a href='/p'>p</a><a href='q.html#z'>q</a><a href='/d.docx'>d</a><a href='/f.pdf'>f</a>"
        "<a href='https://other.net/'>o</a><a href='#tab'>t</a><a href='/gone'>g</a><div id='tab'>pane text</div></body>",
        "https://x.org/p": f"<body><a href='/deep'>d</a>{long_text}</body>",
        "https://www.x.org/q.html": "<body>Q page</body>",
        "https://x.org/deep": "<body><a href='/deeper'>d</a>deep</body>",
        "https://x.org/deeper": "<body>never</body>",
    }
    rows = [(u, 1, 200, {"last-modified": "v1"}, h, None) for u, h in html.items()]
    rows.append(("https://x.org/gone", 1, 404, None, "gone", None))
    schema = "url string, attempt int, status int, headers map<string,string>, html string, error string"
    fetches = spark.createDataFrame(rows, schema).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    files = spark.createDataFrame(
        [("https://x.org/d.docx", 9, bytearray(I.docx_bytes(["one", "two"])), None)],
        "url string, length long, content binary, headers map<string,string>",
    ).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    pdf_pages = spark.createDataFrame([("https://x.org/f.pdf", 0, "pdf "), ("https://x.org/f.pdf", 1, "text")], "url string, page_no int, text string")
    pdf_fetches = spark.createDataFrame(
        [("https://x.org/f.pdf", 1, 403, None, None, 8, None), ("https://x.org/f.pdf", 2, 200, "application/pdf", {"Last-Modified": "v1"}, 8, None)],
        "url string, attempt int, status int, content_type string, headers map<string,string>, length long, error string",
    ).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    robots = spark.createDataFrame([("https://x.org", 200, "User-agent: *\nDisallow: /q")], "base string, status int, body string")
    config = CrawlConfig(base_urls="https://x.org/", max_depth=2, save_404=True, embedding_token_limit=140, token_overlap=10)
    inputs = CrawlInputs(fetches, robots=robots, files=files, pdf_pages=pdf_pages, pdf_fetches=pdf_fetches)
    out = str(tmp_path / "out")

    def client():
        return lambda texts: [[float(len(t))] for t in texts]

    result = run_crawl(spark, config, inputs, out, 0, client)
    got = {(r.url, r.chunk_index): r.content.strip() for r in result.written.collect()}
    assert got.pop(("https://x.org/p", 1)).startswith("d\nword word")
    assert got.pop(("https://x.org/p", 2)).endswith("word")
    assert got.pop(("https://x.org/p", 3)) == "word"
    assert got.pop(("https://x.org", 1)).endswith("pane text")
    assert got == {
        ("https://x.org/#tab", 1): "pane text",
        ("https://x.org/d.docx", 1): "one\ntwo",
        ("https://x.org/f.pdf", 1): "pdf text",
        ("https://x.org/deep", 1): "d\ndeep",
    }
    depth = {r.norm_url: (r.depth, r.processed) for r in result.frontier.collect()}
    assert depth["https://x.org/q.html"] == (1, False) and depth["https://x.org/deeper"] == (3, False)
    assert result.failures.count() == 0 and result.not_found.count() == 1
    assert result.summary.first().visited == 8
    assert all(r.embedding == [float(len(r.content))] for r in result.written.collect())
    # The same data again: nothing is written, the store stays.
    again = run_crawl(spark, config, inputs, out, 1, client)
    assert again.written.count() == 0
    assert store.read_store(spark, f"{out}/store", RECORD).count() == 8
    assert read_seen(spark, f"{out}/logs/docs").count() == 0


def test_streams_equal_batches(spark, tmp_path):
    schema = "page_id long, url string, html string"
    pages = S.ingest(spark, SF, schema, "pages.parquet")
    texts = extract.main_text(pages, "column").select("url", "text", F.lit("v1").alias("last_modified"))
    record = "blob_name string, url string, title string, chunk_index int, chunk_total int, content string, last_modified string"
    chunks = C.emit_chunks(texts, 60, 10)
    path = str(tmp_path / "store")
    for state in ("one", "two"):
        S.stream_upsert(chunks, path, str(tmp_path / state)).awaitTermination()
    batch = C.emit_chunks(
        extract.main_text(I.table(spark, SF, "pages"), "column").select("url", "text", F.lit("v1").alias("last_modified")), 60, 10
    )
    stored = store.read_store(spark, path, record)
    assert stored.count() == batch.count() and stored.exceptAll(batch.select(stored.columns)).count() == 0


@pytest.mark.parametrize("files", [0, 3])
def test_stream_of_a_table_of_one_file_or_several(spark, tmp_path, files):
    rows = [(k, f"http://h.example/{'de/' if k % 4 else 'en/'}{k}", "<p>words of a page</p>") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    if files:
        pages.repartition(files).write.parquet(str(tmp_path / "pages.parquet"))
    else:
        pages.toPandas().to_parquet(tmp_path / "pages.parquet")
    for name in ("stream_ingest", "stream_dedup", "stream_upsert"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 40, name
    summary = QUERIES["stream_summary"](spark, str(tmp_path))
    assert {r.outcome: r.pages for r in summary.collect()} == {"skipped": 30, "visited": 10}


def test_stream_dedup_with_watermark(spark, tmp_path):
    spark.range(10).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("ts")).write.parquet(str(tmp_path / "in"))
    rows = S.ingest(spark, str(tmp_path / "in"), "k long, ts timestamp")
    S.write_table(S.stream_dedup(rows, ["k"], "ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


@pytest.mark.parametrize("route", ["tree", "column"])
def test_whole_prose_stays_without_the_language_filter(spark, route):
    prose = "Several ordinary sentences together contain considerably longer words"
    body = f"<p>{'short text ' * 30}</p><p>{prose}</p><p>the end</p>"
    pages = spark.createDataFrame([(f"<html><body>{body}</body></html>",)], "html string")
    assert prose not in extract.main_text(pages, route).first().text
    whole = extract.main_text(pages, route, drop_language_blocks=False).first().text
    assert prose in whole and whole.endswith("the end")


FETCHES = "url string, attempt int, status int, headers map<string,string>, html string, error string"


def fetched(spark, pages, version="v1"):
    rows = [(u, 1, 200, {"last-modified": version}, h, None) for u, h in pages.items()]
    return spark.createDataFrame(rows, FETCHES).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))


def test_runs_that_remember(spark, tmp_path):
    first = {"https://x.org/": "<body><a href='/p'>p</a>home</body>", "https://x.org/p": "<body>page</body>"}
    second = first | {"https://x.org/p": "<body><a href='/n'>n</a>changed</body>", "https://x.org/new": "<body><a href='/p'>p</a>new</body>"}
    seeds = spark.createDataFrame([("https://x.org/",), ("https://x.org/new",)], "seed string")
    out = str(tmp_path / "out")

    def run(batch, pages, version, **more):
        config = CrawlConfig(max_depth=2, embedding_token_limit=140, token_overlap=10, **more)
        result = run_crawl(spark, config, CrawlInputs(fetched(spark, pages, version), seeds=seeds), out, batch)
        return {r.norm_url for r in result.frontier.collect()}, {r.url: r.content.strip() for r in result.written.collect()}

    assert run(0, first, "v1")[0] == {"https://x.org", "https://x.org/p", "https://x.org/new"}
    # The next run leaves out what the first visited, also as a target of links.
    for _ in range(2):
        walked, written = run(1, second, "v2", skip_visited=True)
        assert (walked, written) == (set(), {})
    # Visited again, but chunks that were emitted stay out even when they changed.
    for _ in range(2):
        walked, written = run(1, second, "v2", skip_seen=True)
        assert "https://x.org/n" in walked and written == {"https://x.org/new": "p\nnew"}
    walked, written = run(2, second, "v3")
    assert written == {"https://x.org": "p\nhome", "https://x.org/p": "n\nchanged", "https://x.org/new": "p\nnew"}


def test_files_that_were_not_received(spark, tmp_path):
    home = "<body><a href='/a.docx'>a</a><a href='/b.docx'>b</a><a href='/c.xlsx'>c</a><a href='/d.xlsx'>d</a>home</body>"
    rows = [
        ("https://x.org/a.docx", bytearray(I.docx_bytes(["one"])), 200, None), ("https://x.org/b.docx", None, 404, None),
        ("https://x.org/c.xlsx", None, None, "timed out"), ("https://x.org/d.xlsx", bytearray(b"broken"), 200, None),
        ("https://x.org/never.docx", None, 500, None),
    ]
    files = spark.createDataFrame(rows, "url string, content binary, status int, error string").withColumns(
        {"headers": F.lit(None).cast("map<string,string>"), "fetched_at": F.lit("2024-01-01").cast("timestamp"), "length": F.lit(1)}
    )
    config = CrawlConfig(base_urls="https://x.org/", embedding_token_limit=140, token_overlap=10)
    inputs = CrawlInputs(fetched(spark, {"https://x.org/": home}), files=files)
    result = run_crawl(spark, config, inputs, str(tmp_path / "out"))
    assert {r.url for r in result.written.collect()} == {"https://x.org", "https://x.org/a.docx"}
    failed = {r.url[14:]: r.reason for r in result.failures.collect()}
    assert failed.pop("d.xlsx").startswith("XLSX parse error: ")
    assert failed == {"b.docx": "DOCX parse error: HTTP 404", "c.xlsx": "XLSX parse error: timed out"}


def test_a_run_repairs_missing_vectors(spark, tmp_path):
    pages = {"https://x.org/": "<body><a href='/p'>p</a>home</body>", "https://x.org/p": "<body>bad page</body>"}
    config = CrawlConfig(base_urls="https://x.org/", embedding_token_limit=140, token_overlap=10)
    out = str(tmp_path / "out")

    def client(broken):
        def call(texts):
            if broken and any("bad" in t for t in texts):
                raise ConnectionError("down")
            return [[1.0] for _ in texts]

        return lambda: call

    first = run_crawl(spark, config, CrawlInputs(fetched(spark, pages)), out, 0, client(True))
    assert [(r.url, r.reason) for r in first.not_embedded.collect()] == [("https://x.org/p", "ConnectionError: down")]
    assert {r.url: r.embedding for r in first.written.collect()} == {"https://x.org": [1.0], "https://x.org/p": None}
    for batch in (1, 1):
        second = run_crawl(spark, config, CrawlInputs(fetched(spark, pages)), out, batch, client(False))
        assert {r.url: r.embedding for r in second.written.collect()} == {"https://x.org/p": [1.0]}
    third = run_crawl(spark, config, CrawlInputs(fetched(spark, pages)), out, 2, client(False))
    assert third.written.count() == 0 and third.not_embedded.count() == 0


def test_one_of_many_variants_of_a_url_counts(spark, tmp_path):
    """A hot normal form: links lose their queries, so the smallest variant counts alone."""
    pages = {f"https://x.org/list?page={k}": f"<body><a href='/to{k}'>t</a>text {k}</body>" for k in range(300)}
    pages["https://x.org/"] = "<body><a href='/list?page=7'>l</a>home</body>"
    config = CrawlConfig(base_urls="https://x.org/", max_depth=2, embedding_token_limit=140, token_overlap=10)
    result = run_crawl(spark, config, CrawlInputs(fetched(spark, pages)), str(tmp_path / "out"))
    assert {r.url: r.content.strip() for r in result.written.collect()} == {"https://x.org": "l\nhome", "https://x.org/list": "t\ntext 0"}
    assert {r.norm_url for r in result.frontier.collect()} == {"https://x.org", "https://x.org/list", "https://x.org/to0"}


def test_texts_move_once_before_chunking(spark):
    schema = "url string, attempt int, last_modified string, text string, hrefs array<string>, panes array<struct<id:string,text:string>>"
    parsed = spark.createDataFrame([("https://x.org/a", 1, "v", "t", ["#p"], [("p", "pane")])], schema)
    chosen = spark.createDataFrame([("https://x.org/a", 1, "https://x.org/a", True)], "url string, attempt int, norm_url string, panes_allowed boolean")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chunks = C.emit_chunks(corpus.html_documents(parsed, chosen, CrawlConfig()), 100, 10)
        assert chunks.count() == 2
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        plan = chunks._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and "Window" not in plan  # the texts, and the narrow rows that choose


def progress(query):
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_stream_upsert_reads_no_earlier_batch(spark, tmp_path):
    record = "blob_name string, last_modified string, content string"
    path, source, state = (str(tmp_path / x) for x in ("store", "in", "state"))

    def arrive(k, rows):
        spark.createDataFrame(rows, record).coalesce(1).write.mode("append").parquet(source)

    def run():
        query = S.stream_upsert(S.ingest(spark, source, record), path, state)
        query.awaitTermination()
        return query

    batches = [
        [("a", "1", "x"), ("b", "1", "x"), ("b", "0", "old")], [("a", "1", "y"), ("b", "2", "y")], [("a", "1", "z"), ("b", "1", "z"), ("c", None, "z")],
        [("c", None, "w"), ("d", "", "w")], [("d", "", "v"), ("a", "1", "v")],
    ]
    written = [{"a", "b"}, {"b"}, {"b", "c"}, {"c", "d"}, {"d"}]
    for k, rows in enumerate(batches):
        arrive(k, rows)
        query = run()  # a new query each time: what is known comes from the checkpoint
        assert {r.blob_name for r in store.read_batch(spark, path, record, k).collect()} == written[k]
        (last,) = progress(query)
        assert last["stateOperators"][0]["numRowsUpdated"] <= len(rows)
    assert {r.blob_name: r.content for r in store.read_store(spark, path, record).collect()} == {"a": "x", "b": "z", "c": "w", "d": "v"}


def test_stream_upsert_onto_an_earlier_store(spark, tmp_path):
    record = "blob_name string, last_modified string, content string"
    path, source = str(tmp_path / "store"), str(tmp_path / "in")
    store.write_batch(spark.createDataFrame([("a", "1", "run"), ("b", "1", "run")], record), path, 0)
    spark.createDataFrame([("a", "1", "x"), ("b", "2", "x"), ("c", "1", "x")], record).write.parquet(source)
    S.stream_upsert(S.ingest(spark, source, record), path, str(tmp_path / "state"), first=1).awaitTermination()
    assert {r.blob_name: r.content for r in store.read_store(spark, path, record).collect()} == {"a": "run", "b": "x", "c": "x"}


def test_stream_distinct_with_bounded_state(spark, tmp_path):
    """Fifty batches an hour apart: state stays small, and late repeats are known."""
    schema, n = "k string, arrived timestamp", 50
    source = tmp_path / "in"
    for hour in range(n):
        keys = [f"new{hour}-{j}" for j in range(4)] + ["often", f"new{hour // 2}-1", f"new{max(0, hour - 30)}-2", "often"]
        rows = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("arrived", F.timestamp_seconds(F.lit((hour + 500_000) * 3600)))
        rows.coalesce(1).write.parquet(str(source / f"h{hour:02}"))
    stream = S.ingest(spark, str(source / "*"), schema, max_files=1)
    query = S.stream_distinct(stream, ["k"], str(tmp_path / "out"), str(tmp_path / "state"), "arrived", "2 hours")
    query.awaitTermination()
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in progress(query)]
    assert len(sizes) >= 45 and max(sizes[10:]) <= 30
    table = keyed.read_batches(spark, str(tmp_path / "out"), schema, ["k"])
    found = [r.k for r in table.collect()]
    assert sorted(found) == sorted({"often"} | {f"new{h}-{j}" for h in range(n) for j in range(4)})


def _outputs(monkeypatch, rows, make, column):
    """Row counts of the batches that `make` makes of one batch with all `rows`."""
    found = {}

    def taken(self, run, schema):
        found["run"] = run
        return self

    monkeypatch.setattr(type(rows), "mapInArrow", taken)
    try:
        make(rows)
    except Exception:  # noqa: BLE001 - what comes after it lacks the columns
        pass
    names = [column, *[c for c in rows.columns if c != column]]
    batch = rows.select(*names).toArrow().combine_chunks().to_batches()[0]
    return [out.num_rows for out in found["run"](iter([batch]))]


def test_pages_are_parsed_some_at_a_time(spark, monkeypatch):
    pages = spark.range(1000).select("id", F.concat(F.lit("<a href='/x'>"), F.repeat(F.lit("word "), 1000)).alias("html"))
    counts = _outputs(monkeypatch, pages, extract.parse_pages, "html")
    assert sum(counts) == 1000 and max(counts) <= 256


def test_long_and_null_values_in_small_batches():
    values = [None, "a" * 50, "", "b" * 500, None, "c", "d" * 99]
    batch = pa.RecordBatch.from_pydict({"k": list(range(7)), "t": values})
    parts = [p.column("t").to_pylist() for p in small_batches([batch, batch.slice(7)], "t", size=100, rows=3)]
    assert [v for p in parts for v in p] == values
    assert parts == [values[:3], values[3:4], [None, "c", "d" * 99]]


def test_codec_holds_the_tokens_of_one_text(spark):
    class Codec:
        held = 0

        def encode(self, text):
            self.held += 1
            assert self.held == 1, "tokens of several texts"
            return list(text)

        def decode(self, tokens):
            self.held = 0
            return "".join(tokens)

    rows = [(k, f"text number {k} " * 3) for k in range(200)]
    docs = spark.createDataFrame(rows, "k long, text string").coalesce(1)
    got = C.codec_windows(docs, Codec, 10, 2, "k").groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {k: len(range(0, len(t), 8)) for k, t in rows}
