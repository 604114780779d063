"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.config import CrawlConfig
from webcorpus.functions import text as X
from webcorpus.functions import urls as U
from webcorpus.operators import chunks as C
from webcorpus.operators import (
    extract,
    fetch,
    frontier,
    keyed,
    links,
    ordered,
    policy,
    report,
    store,
)
from webcorpus.operators.embed import embed, embed_guard
from webcorpus.operators.rows import exploded
from webcorpus.plans import fixtures as I
from webcorpus.plans.corpus import CrawlInputs, CrawlResult, run_crawl
from webcorpus.session import ddl, materialize, new_folder
from webcorpus.sinks.files import write_chunks
from webcorpus.sources import office
from webcorpus.sources.pages import read_pages, size_cut
from webcorpus.sources.robots import robots_rules
from webcorpus.sources.seeds import allow_domains, seeds_from
from webcorpus.sources.sitemaps import sitemap_locs
from webcorpus.sources.state import read_seen, seen_keys
from webcorpus.streaming import ingest as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the queries; the oracles use the same values.
SIZE, OVERLAP, TEXT_LIMIT, GUARD = 100, 30, 500, 120
DEPTH = 3
DOMAINS = ["example.com", "blog.example.org", "spam-farm.example.org"]
SKIP = [r"utm_source=", r"/de/\d+", r"\.html$"]
LINK_SKIP = [r"/the\b", r"\.$"]
MAX_LENGTH = 2000
HREFS = [
    "c",
    "/p/q",
    "?p=2",
    "#f",
    "//cdn.example.com/z",
    "https://other.example.org/x",
    "mailto:q@z",
    "../x",
    "./y/",
]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


# --- URLs ---------------------------------------------------------------------


@query
def url_normalize(spark, sf):
    return _pages(spark, sf).select("page_id", U.normalize_url("url").alias("norm_url"))


@query
def url_normalize_keep_query(spark, sf):
    return _pages(spark, sf).select(
        "page_id", U.normalize_url("url", keep_query=True).alias("norm_url")
    )


@query
def url_sanitize_title(spark, sf):
    return _pages(spark, sf).select(
        "page_id", U.sanitize("url").alias("slug"), U.title("url").alias("title")
    )


@query
def url_blob_name(spark, sf):
    return _pages(spark, sf).select(
        "page_id",
        U.blob_name("url").alias("doc_name"),
        U.blob_name("url", F.col("page_id") % 7 + 1).alias("chunk_name"),
    )


@query
def url_parts_host(spark, sf):
    parts = ("scheme", "netloc", "path", "query", "fragment")
    return _pages(spark, sf).select(
        "page_id",
        *[U.url_part("url", part).alias(part) for part in parts],
        U.host_key("url").alias("host"),
    )


@query
def url_directory_base(spark, sf):
    return _pages(spark, sf).select("page_id", U.directory_base("url").alias("base"))


@query
def url_resolve(spark, sf):
    return (
        _pages(spark, sf)
        .select(
            "page_id", "url", F.explode(F.array(*map(F.lit, HREFS))).alias("href")
        )
        .select("page_id", "href", U.resolve("url", "href").alias("resolved"))
    )


def _script_links(pages: DataFrame) -> DataFrame:
    slug = U.title("url")
    forms = [
        F.concat(F.lit("javascript:window.open('"), slug, F.lit(".pdf')")),
        F.concat(F.lit('JavaScript:window.open("/d/'), slug, F.lit('.XLSX","w")')),
        F.concat(F.lit("javascript:window.open('"), slug, F.lit(".doc')")),
        F.concat(F.lit("javascript:window.open('"), slug, F.lit('.docx")')),
        F.concat(F.lit("javascript:show('"), slug, F.lit("')")),
    ]
    return pages.select("page_id", "url", F.explode(F.array(*forms)).alias("href"))


@query
def js_open(spark, sf):
    return _script_links(_pages(spark, sf)).select(
        "page_id", "href", U.js_open_target("href").alias("target")
    )


@query
def real_link(spark, sf):
    pages = _pages(spark, sf)
    found = links.extract_links(pages, "page_id").select("page_id", "url", "href")
    fragment = pages.select(
        "page_id", "url", F.concat(F.lit(" #"), U.title("url")).alias("href")
    )
    raw = links.union_links(found, fragment, _script_links(pages))
    return raw.select(
        "page_id", "href", U.real_link(U.directory_base("url"), "href").alias("link")
    )


# --- links --------------------------------------------------------------------


@query
def links_extract(spark, sf):
    return links.extract_links(_pages(spark, sf), "page_id").select("page_id", "href")


@query
def links_filtered(spark, sf):
    return links.page_links(_pages(spark, sf), DOMAINS, LINK_SKIP).select(
        "src_url", "src_norm", "dst_url"
    )


@query
def links_per_page(spark, sf):
    # Pages are parsed once; both counts come from the narrow table of their hrefs.
    found = materialize(links.page_hrefs(_pages(spark, sf)), "hrefs")
    raw = exploded(found, [F.col("url").alias("src_url")], F.col("hrefs"), "href")
    kept = links.filter_links(links.resolve_links(found), DOMAINS, LINK_SKIP)
    return links.link_counts(raw, kept)


@query
def links_distinct(spark, sf):
    resolved = links.resolve_links(links.page_hrefs(_pages(spark, sf)))
    return links.distinct_links(resolved, "dst_norm")


# --- policy -------------------------------------------------------------------


@query
def filter_skip(spark, sf):
    pages = _pages(spark, sf).select("page_id", "url")
    raw = policy.apply_skip(pages, "url", SKIP)
    normal = policy.apply_skip(
        pages.withColumn("url", U.normalize_url("url")), "url", SKIP
    )
    return raw.select("page_id", F.lit("raw").alias("stage"), "url").unionByName(
        normal.select("page_id", F.lit("normal").alias("stage"), "url")
    )


def _suffixed(pages: DataFrame) -> DataFrame:
    suffix = F.element_at(
        F.array(*map(F.lit, [".pdf", ".DOCX", ".xlsx", ".doc", ".xls", "", ".pdf?x=1"])),
        (F.col("page_id") % 7 + 1).cast("int"),
    )
    return pages.select("page_id", U.normalize_url(F.concat("url", suffix)).alias("url"))


@query
def route_documents(spark, sf):
    pages = _pages(spark, sf).withColumn("url", U.normalize_url("url"))
    return _suffixed(pages).select(
        "page_id",
        "url",
        policy.route("url").alias("route"),
        policy.route("url", ("docx", "xlsx")).alias("route_no_pdf"),
    )


@query
def allow_domain_semi(spark, sf):
    pages = _pages(spark, sf).select("page_id", "url")
    domains = pages.filter(F.col("url").startswith("http://")).select(
        F.regexp_extract(U.host_key("url"), r"([^.]+\.example\..*)$", 1).alias("domain")
    )
    return policy.allow_domain_semi(pages, "url", domains.distinct())


@query
def allow_domain_list(spark, sf):
    return policy.allow_domain_semi(
        _pages(spark, sf).select("page_id", "url"), "url", DOMAINS
    )


# --- seeds and sitemaps ---------------------------------------------------------


@query
def seed_list(spark, sf):
    specs = _pages(spark, sf).select(
        "page_id",
        F.concat(F.lit(" "), "url", F.lit(" ;; https://"), U.host_key("url"), F.lit("/ ;")).alias(
            "spec"
        ),
    )
    return seeds_from(specs)


@query
def allow_list(spark, sf):
    pages = _pages(spark, sf)
    host = U.host_key("url")
    specs = pages.select(
        F.concat(F.upper(F.substring_index(host, ".", 2)), F.lit(" ;; www."), host).alias(
            "spec"
        )
    )
    return allow_domains(specs, I.host_seeds(pages))


@query
def sitemap_or_seed(spark, sf):
    pages = _pages(spark, sf).select("page_id", "url")
    seeds = I.host_seeds(pages)
    leaves = pages.filter(F.col("url").contains(".html")).select(
        U.host_key("url").alias("host"), F.col("url").alias("loc")
    )
    rooted = leaves.join(
        seeds.select(U.host_key("seed").alias("host"), frontier.sitemap_of("seed").alias("root")),
        "host",
    )
    return frontier.sitemap_or_seed(seeds, rooted)


@query
def sitemap_expand(spark, sf):
    rows = I.sitemap_rows(_pages(spark, sf))
    return frontier.expand_sitemaps(
        rows, rows.select(F.col("sitemap_url").alias("root")).distinct(), SKIP
    )


@query
def sitemap_xml(spark, sf):
    return sitemap_locs(I.sitemap_files(_pages(spark, sf)))


# --- frontier -------------------------------------------------------------------


def _frontier(spark: SparkSession, sf: str) -> DataFrame:
    """Walk over the numbered page graph and the pages' own links."""
    pages = _pages(spark, sf)
    own = links.resolve_links(links.page_hrefs(pages))
    graph = I.page_edges(pages).unionByName(own.select("src_norm", "dst_url", "dst_norm"))
    seeds = I.host_seeds(pages).select(F.col("seed").alias("url"))
    return frontier.crawl_frontier(seeds, graph, DEPTH, SKIP)


@query
def bfs_frontier(spark, sf):
    return _frontier(spark, sf).select("norm_url", "depth", "processed")


@query
def bfs_order(spark, sf):
    """Queue order of the walk over the numbered page graph."""
    pages = _pages(spark, sf)
    seeds = I.host_seeds(pages).select(F.col("seed").alias("url"))
    walked = frontier.crawl_frontier(seeds, I.page_edges(pages, "pos"), DEPTH, SKIP, ranked=True)
    return frontier.ordered(walked).select("rank", "norm_url", "url", "depth", "processed")


@query
def bfs_visited_count(spark, sf):
    return _frontier(spark, sf).groupBy("depth", "processed").agg(
        F.count(F.lit(1)).alias("urls")
    )


@query
def bfs_pending(spark, sf):
    left = frontier.pending(_frontier(spark, sf), _pages(spark, sf))
    return frontier.ordered(left).select("norm_url", "depth")


# --- text -----------------------------------------------------------------------


@query
def main_text_column(spark, sf):
    return extract.main_text(_pages(spark, sf).select("page_id", "html"), "column")


@query
def main_text_dom(spark, sf):
    return extract.main_text(_pages(spark, sf).select("page_id", "html"))


@query
def lang_block_filter(spark, sf):
    docs = I.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text")
    return extract.filter_lines(docs, ["key"])


@query
def lang_block_conversations(spark, sf):
    turns = I.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return extract.filter_lines(turns, ["conv_id"], order="turn")


@query
def lang_block_array(spark, sf):
    docs = I.table(spark, sf, "documents").select(
        "doc_id", "text", X.drop_language_blocks("text").alias("filtered")
    )
    return docs.select(
        "doc_id",
        "filtered",
        X.prefer_filtered(F.col("filtered"), F.col("text")).alias("text"),
    )


@query
def truncate_text(spark, sf):
    return I.table(spark, sf, "documents").select(
        "doc_id", X.truncate_text("text", TEXT_LIMIT).alias("text")
    )


@query
def non_blank_lines(spark, sf):
    lines = I.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "[.,]")).alias("pos", "part")
    )
    return lines.filter(X.non_blank("part")).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("parts")
    )


def _paned(pages: DataFrame) -> DataFrame:
    """Pages whose article and body have ids; the article's is linked to."""
    html = F.replace(
        F.replace("html", F.lit("<article>"), F.lit('<article id="top">')),
        F.lit("<body>"),
        F.lit('<body id="all"><a href="#top">up</a>'),
    )
    return pages.select("page_id", "url", html.alias("html"))


@query
def panes_dom(spark, sf):
    parsed = extract.parse_pages(_paned(_pages(spark, sf)))
    return extract.panes_of(parsed, "page_id")


@query
def fragment_docs_dom(spark, sf):
    parsed = extract.parse_pages(_paned(_pages(spark, sf)))
    return extract.fragment_docs_in_row(
        parsed, U.directory_base("url"), F.array(F.lit("top")), "page_id"
    )


@query
def fragment_docs(spark, sf):
    wanted = _pages(spark, sf).select(
        "page_id", "url", U.url_part("url", "fragment").alias("fragment")
    )
    panes = I.table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"),
        F.when(F.col("doc_id") % 4 == 3, "end").otherwise("top").alias("id"),
        "text",
    )
    return extract.fragment_docs(wanted, panes, base="url")


# --- chunks ---------------------------------------------------------------------


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return I.document_rows(I.table(spark, sf, "documents"))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return C.emit_chunks(_documents(spark, sf), SIZE, OVERLAP)


@query
def token_counts(spark, sf):
    return I.table(spark, sf, "documents").select(
        "doc_id", X.token_count("text").alias("tokens")
    )


@query
def token_windows(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text")
    return C.word_windows(docs, SIZE, OVERLAP, "doc_id")


@query
def codec_windows(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text")
    return C.codec_windows(docs, CharacterCodec, 700, 100, "doc_id")


class CharacterCodec:
    """One token per character; stands for a model's codec."""

    def encode(self, text: str) -> list[int]:
        return [ord(char) for char in text]

    def decode(self, tokens: Sequence[int]) -> str:
        return "".join(map(chr, tokens))


@query
def chunk_totals(spark, sf):
    return C.chunk_total(_documents(spark, sf), SIZE, OVERLAP)


@query
def chunk_records(spark, sf):
    return _chunks(spark, sf)


@query
def chunk_ids(spark, sf):
    return C.with_ids(_chunks(spark, sf)).select("id", "url", "chunk_index")


@query
def page_chunk_records(spark, sf):
    """Flagship: pages to chunk records in one pass, without a shuffle."""
    texts = extract.main_text(_pages(spark, sf).select("url", "html"))
    docs = texts.select(
        U.normalize_url("url").alias("url"), "text", F.lit("v1").alias("last_modified")
    )
    return C.emit_chunks(docs, SIZE, OVERLAP)


@query
def chunks_json(spark, sf):
    packed = F.to_json(F.struct("url", "chunk_index", "content"))
    return (
        _chunks(spark, sf)
        .select(packed.alias("doc"))
        .select(
            F.from_json("doc", "url string, chunk_index int, content string").alias("d")
        )
        .select("d.*")
    )


# --- embedding --------------------------------------------------------------------


@query
def embed_guarded(spark, sf):
    return I.table(spark, sf, "documents").select(
        "doc_id", embed_guard("text", GUARD).alias("embeddable")
    )


def letter_counts() -> Callable[[Sequence[str]], list[list[float]]]:
    """Stands for a model: how often three letters occur."""
    return lambda texts: [[float(t.count(letter)) for letter in "aen"] for t in texts]


@query
def embed_chunks(spark, sf):
    vectors = embed(_chunks(spark, sf), letter_counts, SIZE)
    parts = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(3)]
    return vectors.select("url", "chunk_index", *parts)


# --- store ------------------------------------------------------------------------


def _stored_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks as a table, for queries that read them more than once."""
    return materialize(_chunks(spark, sf), "chunks")


def _store(chunks: DataFrame) -> DataFrame:
    """What an earlier run left: a third unchanged, a third older, a third absent,
    and one chunk more of every unchanged document."""
    third = F.col("chunk_index") % 3
    kept = chunks.filter(third != 2).withColumn(
        "last_modified", F.when(third == 1, F.col("last_modified")).otherwise("v-old")
    )
    stale = chunks.filter("chunk_index = 1").withColumn(
        "blob_name", F.concat(F.lit("stale_"), "blob_name")
    )
    return kept.unionByName(stale)


@query
def seen_anti(spark, sf):
    chunks = _stored_chunks(spark, sf)
    seen = seen_keys(
        chunks.filter(F.col("chunk_index") % 3 == 1).select(
            "url", F.nullif("chunk_index", F.lit(1)).alias("chunk_index")
        )
    )
    return C.drop_seen(chunks, seen).select("url", "chunk_index", "content")


@query
def seen_files(spark, sf):
    """Records written by one run and read by the next as what it need not emit."""
    chunks = _stored_chunks(spark, sf)
    folder = new_folder(spark, "records")
    write_chunks(chunks.filter(F.col("chunk_index") % 3 == 1), folder, "json")
    return C.drop_seen(chunks, read_seen(spark, folder)).select("url", "chunk_index", "content")


@query
def upsert_actions(spark, sf):
    chunks = _stored_chunks(spark, sf)
    return store.upsert_actions(chunks, _store(chunks)).select(
        "blob_name", "last_modified", "action"
    )


@query
def upsert_merged(spark, sf):
    chunks = _stored_chunks(spark, sf)
    return store.upsert(_store(chunks), chunks)


@query
def upsert_stored(spark, sf):
    """Two runs into a stored table: the second writes changed chunks only."""
    path = new_folder(spark, "store")
    chunks = _stored_chunks(spark, sf)
    store.write_batch(_store(chunks), path, 0)
    record = ddl(chunks.schema.fields)
    current = store.read_store(spark, path, record, before=1)
    store.write_batch(store.changed(store.upsert_actions(chunks, current)), path, 1)
    return store.read_store(spark, path, record)


@query
def latest_version(spark, sf):
    return fetch.latest_per_key(
        I.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"),
        "user_id",
        "ts",
        "event_id",
    )


# --- fetch outcomes -----------------------------------------------------------------


def _attempts(spark: SparkSession, sf: str) -> DataFrame:
    return I.fetch_attempts(I.table(spark, sf, "events"))


@query
def fetch_outcomes(spark, sf):
    return fetch.classify(_attempts(spark, sf)).select(
        "url", "attempt", "status", "outcome", "reason"
    )


@query
def failures(spark, sf):
    return fetch.failures(fetch.classify(_attempts(spark, sf), 2))


@query
def not_found(spark, sf):
    return fetch.not_found_records(fetch.classify(_attempts(spark, sf)))


@query
def pdf_accepted(spark, sf):
    return _attempts(spark, sf).filter(fetch.pdf_ok()).select("url", "attempt")


@query
def pdf_retry_reconcile(spark, sf):
    attempts = _attempts(spark, sf)
    return fetch.reconcile(fetch.pdf_failures(attempts), fetch.pdf_successes(attempts))


@query
def pdf_size_cut(spark, sf):
    declared = I.table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 > 0, F.col("n_chars")).alias("length")
    )
    return size_cut(declared, MAX_LENGTH)


@query
def header_lookup(spark, sf):
    n = F.col("event_id")
    name = (
        F.when(n % 4 == 0, "last-modified")
        .when(n % 4 == 1, "Last-Modified")
        .otherwise("Expires")
    )
    headers = F.create_map(F.lit("X-Type"), "event_type", name, F.col("user_id").cast("string"))
    return I.table(spark, sf, "events").select(
        "event_id",
        X.header(headers, "x-type").alias("x_type"),
        X.last_modified(headers, "ts").alias("last_modified"),
    )


# --- reports ------------------------------------------------------------------------


@query
def emitted_urls(spark, sf):
    return report.emitted_urls(_chunks(spark, sf))


@query
def emitted_urls_distinct(spark, sf):
    return report.emitted_urls(_chunks(spark, sf), distinct=True)


@query
def emitted_docs(spark, sf):
    chunks = _stored_chunks(spark, sf)
    return report.emitted_docs(store.upsert_actions(chunks, _store(chunks))).select(
        "blob_name", "url", "chunk_index", "content"
    )


@query
def run_summary(spark, sf):
    outcomes = fetch.classify(_attempts(spark, sf))
    return report.run_summary(outcomes, fetch.failures(outcomes))


# --- robots -------------------------------------------------------------------------


@query
def robots_rules_table(spark, sf):
    return robots_rules(I.robots_files(_pages(spark, sf))).select(
        "base",
        "group_no",
        F.array_join("agents", " ").alias("agents"),
        "rule_no",
        "allow",
        "prefix",
    )


@query
def robots_allowed(spark, sf):
    pages = _pages(spark, sf)
    files = I.robots_files(pages)
    policies = policy.robots_policies(files, robots_rules(files))
    urls = pages.select("page_id", U.normalize_url("url").alias("url"))
    return policy.robots_allowed(urls, "url", policies)


# --- office documents -----------------------------------------------------------------


@query
def docx_assemble(spark, sf):
    turns = I.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("url"), F.col("turn").alias("part_no"), "text"
    )
    return ordered.join_parts(turns)


@query
def xlsx_assemble(spark, sf):
    words = I.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("url"),
        (F.col("turn") % 2).alias("sheet_no"),
        F.floor(F.col("turn") / 2).alias("row_no"),
        F.posexplode(F.split("text", " ")).alias("col_no", "value"),
    )
    return ordered.join_cells(words)


@query
def pdf_assemble(spark, sf):
    turns = I.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("url"),
        F.col("turn").alias("page_no"),
        F.when(F.col("turn") % 3 < 2, F.col("text")).alias("text"),
    )
    return ordered.join_pages(turns)


def _office(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return I.office_files(I.table(spark, sf, "documents"), kind)


@query
def docx_binary(spark, sf):
    return office.documents_of(office.docx_text(_office(spark, sf, "docx")))


@query
def xlsx_binary(spark, sf):
    return office.documents_of(office.xlsx_text(_office(spark, sf, "xlsx")))


# --- streaming ------------------------------------------------------------------------

_PAGE_SCHEMA = "page_id long, url string, html string"


def _page_stream(spark: SparkSession, sf: str) -> DataFrame:
    # One file or a folder of files, all of which count, as in a batch read. Only as a
    # pattern may a stream's path be a file.
    return S.ingest(spark, f"{sf}/[p]ages.parquet", _PAGE_SCHEMA, "*")


def _streamed(df: DataFrame, mode: str = "append") -> DataFrame:
    path = new_folder(df.sparkSession, "stream")
    S.write_table(df, f"{path}/table", f"{path}/state", mode).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/table")


@query
def stream_ingest(spark, sf):
    return _streamed(
        _page_stream(spark, sf).select("page_id", U.normalize_url("url").alias("norm_url"))
    )


@query
def stream_dedup(spark, sf):
    path = new_folder(spark, "stream-urls")
    urls = _page_stream(spark, sf).select(
        U.normalize_url("url").alias("norm_url"), F.current_timestamp().alias("arrived")
    )
    S.stream_distinct(
        urls, ["norm_url"], f"{path}/table", f"{path}/state", "arrived", "1 hour"
    ).awaitTermination()
    return keyed.read_batches(
        spark, f"{path}/table", ddl(urls.schema.fields), ["norm_url"]
    ).select("norm_url")


@query
def stream_upsert(spark, sf):
    path = new_folder(spark, "stream-store")
    texts = extract.main_text(_page_stream(spark, sf)).select(
        U.normalize_url("url").alias("url"), "text", F.lit("v1").alias("last_modified")
    )
    chunks = C.emit_chunks(texts, SIZE, OVERLAP)
    S.stream_upsert(
        chunks, f"{path}/store", f"{path}/state", ("last_modified", "content")
    ).awaitTermination()
    return store.read_store(spark, f"{path}/store", ddl(chunks.schema.fields))


@query
def stream_summary(spark, sf):
    skipped = policy.should_skip("url", SKIP)
    outcomes = _page_stream(spark, sf).select(
        F.when(skipped, "skipped").otherwise("visited").alias("outcome")
    )
    return _streamed(S.stream_summary(outcomes), "complete")


# --- a whole run ------------------------------------------------------------------------


def _crawl(spark: SparkSession, sf: str) -> CrawlResult:
    """A run over all pages as fetched ones.

    A page gets links to two other pages and every third one to a PDF, whose
    pages are the halves of a document. Sitemaps list all pages of a site, robots
    files come from the pages too. Attempts fail, are repeated and end for good
    by the number of the page.
    """
    pages = _pages(spark, sf)
    anchors = (
        I.page_edges(pages, "pos")
        .groupBy(F.col("src_url").alias("_url"))
        .agg(F.concat_ws("", F.collect_set(_anchor("dst_url"))).alias("_anchors"))
    )
    number = F.col("page_id")
    last = number % 20
    first = (
        F.when(number % 10 == 3, 503).when(number % 10 == 7, 429)
        .when(last == 5, 404).when(last == 15, 403).when(number % 10 != 9, 200)
    )
    second = F.when(last == 13, 404).when(last == 17, 403).when(last == 19, 500).otherwise(200)
    again = (number % 10).isin(3, 7, 9)
    attempts = F.filter(
        F.array(
            F.struct(F.lit(1).alias("attempt"), first.alias("status")),
            F.struct(F.lit(2).alias("attempt"), F.when(again, second).otherwise(-1).alias("status")),
        ),
        lambda a: a["status"].isNull() | (a["status"] >= 0),
    )
    pdf = F.when(
        number % 3 == 0, _anchor(F.concat(F.lit("/files/"), number.cast("string"), F.lit(".pdf")))
    ).otherwise("")
    fetches = (
        pages.join(anchors, F.col("url") == F.col("_url"))
        .select("url", F.concat("_anchors", pdf, "html").alias("html"), F.explode(attempts).alias("_a"))
        .select(
            "url", "_a.attempt", "_a.status", "html",
            F.lit(None).cast("map<string,string>").alias("headers"),
            F.when(F.col("_a.status").isNull(), "timed out").alias("error"),
            F.timestamp_seconds(F.lit(0)).alias("fetched_at"),
        )
    )
    base = F.concat(F.lit("https://"), U.host_key("url"), F.lit("/files/"))
    pdfs = pages.filter(number % 3 == 0).select(
        "page_id", F.concat(base, number.cast("string"), F.lit(".pdf")).alias("url")
    )
    pdf_attempts = F.array(
        F.struct(F.lit(1).alias("attempt"), F.when(number % 2 == 1, 403).otherwise(200).alias("status")),
        F.struct(F.lit(2).alias("attempt"), F.when(number % 5 == 4, 404).otherwise(200).alias("status")),
    )
    pdf_fetches = pdfs.select("url", F.inline(pdf_attempts)).select(
        "url", "attempt", "status", F.lit("application/pdf").alias("content_type"),
        F.lit(None).cast("map<string,string>").alias("headers"), F.lit(1).alias("length"),
        F.lit(None).cast("string").alias("error"), F.timestamp_seconds(F.lit(0)).alias("fetched_at"),
    )
    halves = F.array(F.expr("left(text, 500)"), F.expr("substring(text, 501)"))
    texts = I.table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), "text")
    pdf_pages = pdfs.join(texts, "page_id").select(
        "url", F.posexplode(halves).alias("page_no", "text")
    )
    config = CrawlConfig(
        allow_domains="example.com;example.org;example.net",
        skip_regexes=";".join(SKIP),
        embedding_token_limit=SIZE + 100,
        token_overlap=OVERLAP,
    )
    inputs = CrawlInputs(
        fetches=fetches,
        robots=I.robots_files(pages),
        sitemaps=_site_sitemaps(pages),
        pdf_pages=pdf_pages,
        pdf_fetches=pdf_fetches,
        seeds=pages.select(
            F.concat(F.substring_index("url", "/", 3), F.lit("/")).alias("seed")
        ).distinct(),
    )
    return run_crawl(spark, config, inputs, new_folder(spark, "crawl"))


@query
def crawl_run(spark, sf):
    written = _crawl(spark, sf).written
    return written.select("url", "chunk_index", "chunk_total", "content", "blob_name")


@query
def crawl_failures(spark, sf):
    return _crawl(spark, sf).failures


def _anchor(url: Column | str) -> Column:
    return F.concat(
        F.lit('<a href="'), F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit('">x</a>')
    )


def _sitemap_file(rows: DataFrame, root: str, order: str) -> DataFrame:
    """Rows (sitemap_url, entry) as one file per sitemap_url."""
    joined = ordered.ordered_concat(rows, ["sitemap_url"], order, "entry", "")
    head = f'<{root} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    return joined.select(
        "sitemap_url",
        F.lit(200).alias("status"),
        F.concat(F.lit(head), "entry", F.lit(f"</{root}>")).alias("xml"),
    )


def _site_sitemaps(pages: DataFrame) -> DataFrame:
    """An index per host; its sitemaps list at most 50,000 pages each."""
    site = F.substring_index("url", "/", 3)
    block = F.floor(F.col("page_id") / 50_000)
    part = F.concat(site, F.lit("/part"), block.cast("string"), F.lit(".xml"))
    escaped = F.replace("url", F.lit("&"), F.lit("&amp;"))
    pages = pages.select(
        "page_id",
        site.alias("site"),
        block.alias("block"),
        part.alias("part"),
        F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc></url>")).alias("entry"),
    )
    leaves = pages.select(F.col("part").alias("sitemap_url"), "page_id", "entry")
    listed = pages.select("site", "block", "part").distinct().select(
        F.concat("site", F.lit("/sitemap.xml")).alias("sitemap_url"),
        "block",
        F.concat(F.lit("<sitemap><loc>"), "part", F.lit("</loc></sitemap>")).alias("entry"),
    )
    return _sitemap_file(leaves, "urlset", "page_id").unionByName(
        _sitemap_file(listed, "sitemapindex", "block")
    )
