import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from webcorpus.operators import chunks as C
from webcorpus.operators import fetch, frontier, keyed, report, store
from webcorpus.operators.embed import embed, embed_guard
from webcorpus.session import bucketed
from webcorpus.sources.sitemaps import sitemap_locs
from webcorpus.sources.state import read_seen

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def _links(spark, edges):
    rows = [(f"https://x/{a}", f"https://x/{b}", f"https://x/{b}") for a, b in edges]
    return spark.createDataFrame(rows, "src_norm string, dst_url string, dst_norm string")


@pytest.mark.parametrize("ranked", [False, True])
def test_walk_depth_is_minimal(spark, ranked):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "e"), ("e", "f"), ("s", "z"), ("b", "s")]
    seeds = spark.createDataFrame([("http://www.x/a/?q",), ("https://x/a",)], "url string")
    walked = frontier.crawl_frontier(seeds, _links(spark, edges), 2, ["/s$"], ranked=ranked)
    got = {r.norm_url[10:]: (r.depth, r.processed) for r in walked.collect()}
    assert got == {"a": (0, True), "b": (1, True), "c": (1, True), "d": (2, True), "s": (2, False), "e": (3, False)}
    pages = spark.createDataFrame([("https://x/a",), ("https://x/d/",)], "url string")
    assert {r.norm_url[10:] for r in frontier.pending(walked, pages).collect()} == {"b", "c", "s", "e"}


def test_walk_leaves_out_earlier_runs(spark):
    visited = spark.createDataFrame([("https://x/b",)], "norm_url string")
    seeds = spark.createDataFrame([("https://x/a",)], "url string")
    walked = frontier.crawl_frontier(seeds, _links(spark, [("a", "b"), ("b", "c"), ("a", "d")]), 3, visited=visited)
    assert {r.norm_url[10:] for r in walked.collect()} == {"a", "d"}


def test_sitemaps(spark):
    def urlset(*locs, prefix=""):
        ns = NS.replace("xmlns", "xmlns:sm") if prefix else NS
        body = "".join(f"<{prefix}url><{prefix}loc>{loc}</{prefix}loc></{prefix}url>" for loc in locs)
        return f"<?xml version='1.0'?><{prefix}urlset {ns}>{body}</{prefix}urlset>"

    def index(*locs):
        body = "".join(f"<sitemap><loc>{loc}</loc></sitemap>" for loc in locs)
        return f"<!-- i --><sitemapindex {NS}>{body}</sitemapindex>"

    rows = [
        ("r", 200, index("r", "m", "n", "gone", "bad", "plain")),
        ("m", 200, index("u", "r")),
        ("n", 200, urlset("https://x/1", "https://x/1", "ftp://x", "https://x/a.css", prefix="sm:")),
        ("u", 200, urlset("https://x/2&amp;3")),
        ("gone", 404, urlset("https://x/4")),
        ("bad", 200, urlset("https://x/5")[:-4]),
        ("plain", 200, "<urlset><url><loc>https://x/6</loc></url></urlset>"),
    ]
    files = spark.createDataFrame(rows, "sitemap_url string, status int, xml string")
    roots = spark.createDataFrame([("r",), ("u",), ("none",)], "root string")
    got = frontier.expand_sitemaps(sitemap_locs(files), roots, [r"\.css$"])
    found = sorted((r.root, r.sitemap_url, r.loc) for r in got.collect())
    assert found == [
        ("r", "n", "https://x/1"),
        ("r", "n", "https://x/1"),
        ("r", "u", "https://x/2&3"),
        ("u", "u", "https://x/2&3"),
    ]


def test_shared_sitemaps_are_followed_once(spark, monkeypatch):
    """Many seeds whose sitemaps list one index: each level has every sitemap once."""
    n = 40
    rows = [(f"https://s{k}/sitemap.xml", "index", 0, "https://shared/index") for k in range(n)]
    rows += [("https://shared/index", "index", k, f"https://shared/{k % 3}") for k in range(4)]
    rows += [("https://shared/1", "index", 0, "https://shared/index")]
    rows += [("https://shared/0", "urlset", k, f"https://x/{k % 5}") for k in range(7)]
    rows += [("https://shared/2", "urlset", 0, "https://x/a.css"), ("https://e/sitemap.xml", "index", 0, "https://nowhere")]
    locs = spark.createDataFrame(rows, "sitemap_url string, kind string, pos int, loc string")
    seeds = spark.createDataFrame([(f"https://s{k}/",) for k in range(n)] + [("https://e/",), ("https://f",)], "seed string")
    sizes = []
    kept = frontier.materialize

    def counted(df, label):
        out = kept(df, label)
        if label == "sitemaps-reached":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(frontier, "materialize", counted)
    starts = frontier.sitemap_starts(seeds, locs, [r"\.css$"])
    assert sorted(r.url for r in starts.collect()) == sorted([f"https://x/{k}" for k in range(5)] + ["https://e/", "https://f"])
    assert sizes == [n + 2, 2, 3, 0]
    leaves = frontier.expand_sitemaps(locs, seeds.select(frontier.sitemap_of("seed").alias("root")), [r"\.css$"])
    assert {r.url for r in frontier.sitemap_or_seed(seeds, leaves).collect()} == {r.url for r in starts.collect()}


def test_sitemap_or_seed(spark):
    seeds = spark.createDataFrame([("https://a/",), ("https://b",)], "seed string")
    leaves = spark.createDataFrame([("https://a/sitemap.xml", "https://a/1"), ("https://a/sitemap.xml", "https://a/2")], "root string, loc string")
    got = sorted((r.seed, r.url, r.from_sitemap) for r in frontier.sitemap_or_seed(seeds, leaves).collect())
    assert got == [("https://a/", "https://a/1", True), ("https://a/", "https://a/2", True), ("https://b", "https://b", False)]


def queue_walk(seeds, pages, max_depth):
    """The walk as a queue that takes one page after the other."""
    known, queue, out = set(), deque(), []
    for url in seeds:
        if url not in known:
            known.add(url)
            queue.append((url, 0))
    while queue:
        url, depth = queue.popleft()
        out.append((url, depth))
        if depth <= max_depth:
            for target in pages.get(url, []):
                if target not in known:
                    known.add(target)
                    queue.append((target, depth + 1))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_is_the_place_in_the_queue(spark, seed):
    rng = random.Random(seed)
    pages = {f"https://x/{k}": [f"https://x/{rng.randrange(60)}" for _ in range(rng.randrange(6))] for k in range(60)}
    rows = [(page, target, target, page, pos) for page, targets in pages.items() for pos, target in enumerate(targets)]
    links = spark.createDataFrame(rows, "src_norm string, dst_url string, dst_norm string, src_url string, pos int")
    starts = ["https://x/9", "https://x/3", "https://x/9", "https://x/41"]
    seeds = spark.createDataFrame(list(enumerate(starts)), "pos int, url string")
    walked = frontier.crawl_frontier(seeds, links.repartition(5), 3, ranked=True)
    got = [(r.norm_url, r.depth, r["rank"]) for r in frontier.ordered(walked).collect()]
    assert got == [(url, depth, k) for k, (url, depth) in enumerate(queue_walk(starts, pages, 3))]


def test_one_page_counts_for_a_normalised_url(spark):
    rows = [
        ("https://x/a", "https://x/a?1", "https://x/one"), ("https://x/a", "https://x/a?2", "https://x/two"),
        ("https://x/b", "https://x/b?1", "https://x/three"), ("https://x/b", "https://x/b?2", "https://x/four"),
    ]
    links = spark.createDataFrame([(n, u, t, t) for n, u, t in rows], "src_norm string, src_url string, dst_url string, dst_norm string")
    seeds = spark.createDataFrame([("https://x/a?2",), ("https://x/b",)], "url string")
    walked = frontier.crawl_frontier(seeds, links, 1).filter("depth = 1").collect()
    assert {r.norm_url for r in walked} == {"https://x/two", "https://x/three"}


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode).splitlines()


def below(lines, at):
    """Operators of the right branch that ends in line `at`, up to the join above."""
    up = list(reversed(lines[:at]))
    branch = up[: next(k for k, line in enumerate(up) if "Join" in line)]
    return [line for line in branch if ":" not in line.split("- ")[0]]


def test_levels_move_neither_links_nor_earlier_levels(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = frontier.adjacency(_links(spark, [(str(i), str(j)) for i in range(50) for j in range(5)]))
        level = pages.select(F.col("src_norm").alias("norm_url"), F.col("src_norm").alias("url"), F.lit(1).alias("rank"))
        path = str(tmp_path / "known")
        for depth in (0, 1):
            rows = level.select("norm_url", "url", F.lit(depth).alias("depth"), F.lit(True).alias("processed"), F.lit(0).cast("long").alias("rank"))
            keyed.write_batch(rows, path, depth, ["norm_url"], 4)
        known = keyed.read_batches(spark, path, frontier._VISITED, ["norm_url"], buckets=4)
        with bucketed(pages, ("src_norm",), "t", 4) as table:
            reached = frontier.expand(known.filter("batch = 1"), table)
            assert reached.count() == 250
            lines = plan_of(reached)
            assert not any("Exchange" in line for line in lines)
        left = frontier.drop_visited(level.repartition(4, "norm_url"), known)
        assert left.count() == 0
        lines = plan_of(left)
        at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        assert not any("Exchange" in line for line in below(lines, at))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SCHEMA = "blob_name string, last_modified string, content string"


def test_upsert(spark):
    old = spark.createDataFrame([("a", "1", "old"), ("b", "1", "old"), ("c", None, "old"), ("d", "", "old"), ("z", "1", "old")], SCHEMA)
    new = spark.createDataFrame([("a", "1", "new"), ("b", "0", "new"), ("c", None, "new"), ("d", "", "new"), ("e", "1", "new")], SCHEMA)
    actions = {r.blob_name: r.action for r in store.upsert_actions(new, old).collect()}
    assert actions == {"a": "skip", "b": "update", "c": "update", "d": "update", "e": "insert"}
    merged = store.upsert(old, new)
    assert {r.blob_name: r.content for r in merged.collect()} == {"a": "old", "b": "new", "c": "new", "d": "new", "e": "new", "z": "old"}
    assert report.emitted_docs(store.upsert_actions(new, old)).count() == 4


def test_upsert_again_skips_everything(spark):
    new = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], SCHEMA)
    merged = store.upsert(spark.createDataFrame([], SCHEMA), new)
    assert {r.action for r in store.upsert_actions(new, merged).collect()} == {"skip"}


def test_stored_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    assert store.read_store(spark, path, SCHEMA).count() == 0
    store.write_batch(spark.createDataFrame([("a", "1", "x"), ("b", "1", "x")], SCHEMA), path, 0)
    for content in ("y", "z"):
        store.write_batch(spark.createDataFrame([("b", "2", content)], SCHEMA), path, 1)
    assert [tuple(r) for r in store.read_index(spark, path).orderBy("blob_name").collect()] == [("a", "1", 0), ("b", "2", 1)]
    current = {r.blob_name: r.content for r in store.read_store(spark, path, SCHEMA).collect()}
    assert current == {"a": "x", "b": "z"}
    assert {r.content for r in store.read_store(spark, path, SCHEMA, before=1).collect()} == {"x"}
    # A repeat without rows takes the batch's rows away.
    store.write_batch(spark.createDataFrame([], SCHEMA), path, 1)
    assert {r.content for r in store.read_store(spark, path, SCHEMA).collect()} == {"x"}
    store.write_batch(spark.createDataFrame([("b", "2", "z")], SCHEMA), path, 1)
    store.compact(spark, path, str(tmp_path / "compact"), SCHEMA)
    assert store.read_store(spark, str(tmp_path / "compact"), SCHEMA).count() == 2


def test_changed_rows_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    store.write_batch(spark.createDataFrame([("a", "1", "x"), ("b", "1", "x"), ("d", "", "x")], SCHEMA), path, 0)
    rows = [("a", "1", "new"), ("b", "0", "old"), ("b", "2", "y"), ("b", "2", "y"), ("c", "1", "z"), ("c", None, "w"), ("d", "", "v")]
    for _ in range(2):
        fresh = store.changed_rows(spark.createDataFrame(rows, SCHEMA).repartition(3), path, 1, "last_modified")
        assert sorted(tuple(r) for r in fresh.collect()) == [("b", "2", "y"), ("c", "1", "z"), ("d", "", "v")]
        store.write_batch(fresh, path, 1)
    again = store.changed_rows(spark.createDataFrame(rows, SCHEMA), path, 2, "last_modified")
    assert [r.blob_name for r in again.collect()] == ["d"]
    same = [store.changed_rows(spark.createDataFrame([("e", "1", c) for c in "xyz"], SCHEMA).repartition(n), path, 2, "last_modified").first() for n in (1, 3)]
    assert same[0] == same[1]


def test_many_batches_cost_one_pass_over_the_index(spark, tmp_path):
    path, n = str(tmp_path / "store"), 20
    for batch in range(n):
        rows = [(f"k{(batch + j) % 7}", f"v{batch}", "text") for j in range(3)]
        store.write_batch(spark.createDataFrame(rows, SCHEMA), path, batch, compact_every=4)
    expected = {}
    for batch in range(n):
        expected |= {f"k{(batch + j) % 7}": f"v{batch}" for j in range(3)}
    assert {r.blob_name: r.last_modified for r in store.read_store(spark, path, SCHEMA).collect()} == expected
    # Since the last whole batch, the rows read are the keys and a few batches' changes.
    assert store._index_batches(spark, path, None).count() <= 7 + 4 * 3
    # An earlier state is still there.
    assert {r.last_modified for r in store.read_index(spark, path, before=1).collect()} == {"v0"}
    # A repeat of an old batch and the ones after it gives the same.
    for batch in range(12, n):
        rows = [(f"k{(batch + j) % 7}", f"v{batch}", "text") for j in range(3)]
        store.write_batch(spark.createDataFrame(rows, SCHEMA), path, batch, compact_every=4)
    assert {r.blob_name: r.last_modified for r in store.read_index(spark, path).collect()} == expected


def test_the_index_is_not_exchanged(spark, tmp_path):
    path = str(tmp_path / "store")
    for batch in range(3):
        store.write_batch(spark.createDataFrame([(f"k{j}", f"v{batch}", "x" * 50) for j in range(40)], SCHEMA), path, batch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count = keyed.bucket_count(spark, f"{path}/index")
        incoming = spark.createDataFrame([("k1", "v9", "y")], SCHEMA).repartition(count, "blob_name")
        lines = plan_of(store.upsert_actions(incoming, store.read_index(spark, path)))
        at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        assert not any("Exchange" in line for line in below(lines, at))
        assert "content" not in lines[at]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_seen(spark, tmp_path):
    assert read_seen(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "docs.json").write_text('[{"url": "u"}, {"url": "u", "chunk_index": 2}, {"url": "u", "chunk_index": 1}]')
    seen = read_seen(spark, str(tmp_path / "docs.json"), multi_line=True)
    assert sorted(r.chunk_index for r in seen.collect()) == [1, 2]
    chunks = spark.createDataFrame([("u", i) for i in (1, 2, 3)], "url string, chunk_index int")
    assert [r.chunk_index for r in C.drop_seen(chunks, seen).collect()] == [3]


def test_fetch_sequences(spark):
    runs = {
        "ok": [200],
        "throttled": [429, 200],
        "late": [500, 429, 200],
        "too-late": [429, 429, 429, 200],
        "errors": [None, None, None],
        "gone": [404],
        "denied": [None, 403],
    }
    rows = [(u, i + 1, s, None if s else "boom") for u, codes in runs.items() for i, s in enumerate(codes)]
    attempts = spark.createDataFrame(rows, "url string, attempt int, status int, error string")
    outcomes = fetch.classify(attempts, retry_count=3)
    got = {r.url: (r.outcome, r.attempt, r.reason) for r in outcomes.collect()}
    assert got == {
        "ok": ("ok", 1, None),
        "throttled": ("ok", 2, None),
        "late": ("ok", 3, None),
        "too-late": ("failure", None, fetch.NO_USABLE_ATTEMPT),
        "errors": ("failure", None, fetch.NO_USABLE_ATTEMPT),
        "gone": ("not_found", 1, None),
        "denied": ("failure", 2, "HTTP 403"),
    }
    late = {r.url: r.outcome for r in fetch.classify(attempts).collect()}
    assert late["too-late"] == "ok"  # all attempts count unless a number is given
    assert {r.url for r in fetch.failures(outcomes).collect()} == {"too-late", "errors", "denied"}
    assert fetch.not_found_records(outcomes).count() == 1
    assert fetch.not_found_records(outcomes, save_404=False).count() == 0
    summary = report.run_summary(outcomes, fetch.failures(outcomes)).first()
    assert (summary.status, summary.visited, summary.failed) == ("ok", 7, 3)


def test_pdf_reconcile(spark):
    rows = [
        ("a", 1, 403, "application/pdf", None), ("a", 2, None, None, "reset"), ("a", 3, 200, "Application/PDF", None),
        ("b", 1, 200, "text/html", None), ("b", 2, 404, None, None),
    ]
    attempts = spark.createDataFrame(rows, "url string, attempt int, status int, content_type string, error string")
    left = fetch.reconcile(fetch.pdf_failures(attempts), fetch.pdf_successes(attempts))
    assert sorted((r.url, r.reason) for r in left.collect()) == [
        ("a", "PDF GET error: reset"), ("b", "PDF HTTP 200 (GET)"), ("b", "PDF HTTP 404 (GET)"),
    ]


def test_chunk_numbers_keep_gaps(spark):
    text = "a b c d" + " " * 3
    docs = spark.createDataFrame([("https://x/p", text, "v")], "url string, text string, last_modified string")

    class Characters:
        def encode(self, t):
            return [ord(c) for c in t]

        def decode(self, tokens):
            return "".join(map(chr, tokens))

    got = C.emit_chunks(docs, 4, 1, Characters).orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.chunk_total, r.content) for r in got] == [
        (1, 4, "a b "), (2, 4, " c d"), (3, 4, "d   "),
    ]
    assert C.with_ids(C.emit_chunks(docs, 4, 1), random=True).first().id != C.with_ids(C.emit_chunks(docs, 4, 1)).first().id


def test_codec_of_a_model(spark):
    tiktoken = pytest.importorskip("tiktoken")

    def codec():
        ranks = {bytes([i]): i for i in range(256)} | {b"th": 256, b"the": 257}
        return tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})

    text = "the thin thé " * 20
    docs = spark.createDataFrame([("u", text)], "url string, text string")
    got = [r.content for r in C.codec_windows(docs, codec, 12, 2, "url").orderBy("chunk_index").collect()]
    enc = codec()
    tokens = enc.encode(text)
    assert got == [enc.decode(tokens[i : i + 12]) for i in range(0, len(tokens), 10)]


def test_embedding(spark):
    def client():
        def call(texts):
            if any("bad" in t for t in texts):
                raise ValueError("service")
            return [[float(len(t))] for t in texts]

        return call

    rows = [(i, t) for i, t in enumerate(["a", "bad", "bb", " ", "one two three four", ""])]
    df = spark.createDataFrame(rows, "i int, content string").coalesce(1)
    got = {r.i: r.embedding for r in embed(df, client, 3, batch_size=4).collect()}
    assert got == {0: [1.0], 1: None, 2: [2.0], 3: None, 4: None, 5: None}
    assert df.filter(embed_guard("content", 4)).count() == 4


def test_embedding_errors_and_the_codecs_limit(spark):
    class Letters:
        """A codec with a token per letter."""

        def encode(self, text):
            return list(text)

    def client():
        def call(texts):
            if any("bad" in t for t in texts):
                raise ValueError("service")
            return [[float(len(t))] for t in texts]

        return call

    rows = [(0, "a bb"), (1, "bad"), (2, "far too long"), (3, " "), (4, None), (5, "five5")]
    df = spark.createDataFrame(rows, "i int, content string").coalesce(1)
    got = {r.i: (r.embedding, r.why) for r in embed(df, client, 5, 4, make_codec=Letters, errors="why").collect()}
    assert got == {
        0: ([4.0], None), 1: (None, "ValueError: service"), 2: (None, None), 3: (None, None), 4: (None, None), 5: ([5.0], None),
    }


def test_rows_to_retry_are_written_again(spark, tmp_path):
    path, schema = str(tmp_path / "store"), f"{SCHEMA}, why string"
    rows = spark.createDataFrame([("a", "1", "x", None), ("b", "1", "y", "service")], schema)
    store.write_batch(rows, path, 0, retry="why")
    again = store.changed_rows(rows.drop("why"), path, 1, "last_modified")
    assert [r.blob_name for r in again.collect()] == ["b"]
    store.write_batch(again.withColumn("why", F.lit(None).cast("string")), path, 1, retry="why")
    assert store.changed_rows(rows.drop("why"), path, 2, "last_modified").count() == 0
    assert {r.blob_name: r.content for r in store.read_store(spark, path, SCHEMA).collect()} == {"a": "x", "b": "y"}


def test_latest_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("blob_name"), "id")
    latest = fetch.latest_per_key(df, "blob_name", "id")
    assert sorted(r.id for r in latest.collect()) == [997, 998, 999]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def test_intermediate_folders_can_be_removed(spark, tmp_path, monkeypatch):
    import os

    from webcorpus import session

    monkeypatch.setattr(session, "_made", {})
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    kept = session.materialize(spark.range(10), "some")
    assert kept.count() == 10 and len(os.listdir(tmp_path)) == 1
    assert session.remove_intermediates(spark) == 1
    assert os.listdir(tmp_path) == [] and session.remove_intermediates(spark) == 0
