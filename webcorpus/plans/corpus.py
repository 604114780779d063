"""One crawl run over fetched data: from seeds to chunk records and run logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.config import CrawlConfig
from webcorpus.functions.text import last_modified, non_blank, strip, truncate_text
from webcorpus.functions.urls import directory_base, normalize_url, resolve
from webcorpus.operators import chunks as C
from webcorpus.operators import fetch, report, store
from webcorpus.operators.embed import Embedder, embed
from webcorpus.operators.extract import parse_pages
from webcorpus.operators.frontier import (
    adjacency,
    crawl_frontier,
    sitemap_starts,
)
from webcorpus.operators.links import filter_links, resolve_links
from webcorpus.operators.ordered import join_pages
from webcorpus.operators.policy import allow_domain_semi, robots_policies, route, should_skip
from webcorpus.operators.rows import exploded
from webcorpus.session import materialize
from webcorpus.sinks.files import (
    write_chunks,
    write_emitted_docs,
    write_emitted_urls,
    write_failures,
)
from webcorpus.sources.office import documents_of, docx_text, failures_of, xlsx_text
from webcorpus.sources.pages import size_cut
from webcorpus.sources.robots import robots_rules
from webcorpus.sources.seeds import allow_domains, seeds_from, spec_table
from webcorpus.sources.sitemaps import sitemap_locs
from webcorpus.sources.state import remember, seen_before, seen_keys, visited_before

RECORD = (
    "id string, url string, title string, chunk_index int, chunk_total int, "
    "content string, last_modified string, embedding array<float>, blob_name string"
)
# Why a stored chunk has no vector.
ERROR = "embedding_error"


@dataclass(frozen=True)
class CrawlInputs:
    """Fetched data. Only `fetches` is needed.

    fetches    url, attempt, status, headers, html, error, fetched_at
    robots     base, status, body
    sitemaps   sitemap_url, status, xml
    files      url, length, content, headers, fetched_at and optionally status, error;
               Word and Excel files
    pdf_pages  url, page_no, text
    pdf_fetches url, attempt, status, content_type, headers, length, error, fetched_at
    seen       url, chunk_index of chunks never to be emitted again
    seeds      seed URLs, when there are more than settings can list
    """

    fetches: DataFrame
    robots: DataFrame | None = None
    sitemaps: DataFrame | None = None
    files: DataFrame | None = None
    pdf_pages: DataFrame | None = None
    pdf_fetches: DataFrame | None = None
    seen: DataFrame | None = None
    seeds: DataFrame | None = None


@dataclass(frozen=True)
class CrawlResult:
    frontier: DataFrame
    written: DataFrame
    failures: DataFrame
    not_found: DataFrame
    summary: DataFrame
    not_embedded: DataFrame


def start_urls(
    seeds: DataFrame, config: CrawlConfig, sitemaps: DataFrame | None
) -> DataFrame:
    """URLs the walk starts from: sitemap locations per seed, or the seed."""
    if sitemaps is None:
        return seeds.select(F.col("seed").alias("url"))
    return sitemap_starts(seeds, sitemap_locs(sitemaps), config.skip_patterns)


Domains = DataFrame | list[str]


def seeds_and_domains(
    spark: SparkSession, config: CrawlConfig, seeds: DataFrame | None
) -> tuple[DataFrame, Domains]:
    """Seeds, and the domains of the settings and the seeds.

    Domains of the settings are a list as long as the settings are; with a
    table of seeds they stay a table.
    """
    listed = spec_table(spark, config.allow_domains)
    if seeds is not None:
        seeds = seeds.select("seed")
        return seeds, materialize(allow_domains(listed, seeds), "domains")
    seeds = seeds_from(spec_table(spark, config.base_urls))
    return seeds, [row.domain for row in allow_domains(listed, seeds).collect()]


def parsed_fetches(fetches: DataFrame, config: CrawlConfig) -> tuple[DataFrame, DataFrame]:
    """(outcomes, parsed): the outcome per URL, and text, links and panes per attempt.

    The markup is read once and goes no further than the task that parses it;
    outcomes and pages are matched on narrow rows.
    """
    outcomes = materialize(
        fetch.classify(
            fetches.select("url", "attempt", "status", "error"), config.retry_count
        ).withColumn("norm_url", normalize_url("url")),
        "outcomes",
    )
    usable = fetches.filter(
        F.col("error").isNull() & (F.col("status") < 400) & F.col("html").isNotNull()
    )
    parsed = materialize(
        parse_pages(
            usable.select(
                "url",
                "attempt",
                last_modified("headers", "fetched_at").alias("last_modified"),
                "html",
            ),
            drop_language_blocks=config.drop_language_blocks,
        ),
        "parsed",
    )
    return outcomes, parsed


def page_links(
    parsed: DataFrame, outcomes: DataFrame, domains: Domains, skip_patterns: Sequence[str]
) -> DataFrame:
    """(src_norm, src_url, links): the crawlable links of every page that was received."""
    good = outcomes.filter("outcome = 'ok'").select("url", "attempt")
    received = parsed.select("url", "attempt", "hrefs").join(good, ["url", "attempt"], "left_semi")
    # `pos` is the first place of a link on its page.
    resolved = resolve_links(received.select("url", "hrefs"), positions=True)
    return adjacency(filter_links(resolved, domains, skip_patterns))


def chosen_pages(outcomes: DataFrame, processed: DataFrame, domains: Domains) -> DataFrame:
    """(url, attempt, norm_url, panes_allowed): the attempt that counts per walked URL.

    Of several received URLs with one normal form the walked one counts, else the
    smallest. All columns are narrow, and every task hands on one row per URL.
    """
    received = outcomes.filter("outcome = 'ok'").select("norm_url", "url", "attempt")
    wanted = processed.filter("kind = 'html'").select("norm_url", F.col("url").alias("_walked"))
    best = F.min(F.struct(F.col("url") != F.col("_walked"), "url", "attempt")).alias("_best")
    chosen = received.join(wanted, "norm_url").groupBy("norm_url").agg(best).select(
        "_best.url", "_best.attempt", "norm_url"
    )
    chosen = materialize(chosen, "chosen")
    # A pane has the host of its page.
    allowed = allow_domain_semi(chosen, "url", domains).select("url", F.lit(True).alias("panes_allowed"))
    return chosen.join(allowed, "url", "left")


def html_documents(parsed: DataFrame, chosen: DataFrame, config: CrawlConfig) -> DataFrame:
    """(url, text, last_modified) of the chosen pages and of their linked panes.

    Texts move once, to the narrow rows that choose them; page and panes then
    come out of one row.
    """
    base = directory_base("url")
    wanted = F.transform(
        F.filter("hrefs", lambda h: strip(h).startswith("#")),
        lambda h: F.substring(strip(h), 2, 2**31 - 1),
    )
    hits = F.when(
        F.col("panes_allowed"), F.filter("panes", lambda p: F.array_contains(wanted, p["id"]))
    ).otherwise(F.filter("panes", lambda p: F.lit(False)))
    page = F.struct(F.lit(None).cast("string").alias("id"), F.col("text"))
    rows = exploded(
        parsed.join(chosen, ["url", "attempt"]),
        ["norm_url", base.alias("_base"), "last_modified"],
        F.concat(F.array(page), hits),
        "_part",
    )
    pane = F.col("_part.id").isNotNull()
    url = F.when(pane, resolve(F.col("_base"), F.concat(F.lit("#"), "_part.id"))).otherwise(
        F.col("norm_url")
    )
    text = F.col("_part.text")
    limit = config.max_content_chars
    whole = text if limit is None else F.when(pane, text).otherwise(truncate_text(text, limit))
    kept = ~pane | (non_blank(text) & ~should_skip(url, config.skip_patterns))
    return rows.filter(kept).select(url.alias("url"), whole.alias("text"), "last_modified")


def file_documents(
    files: DataFrame, processed: DataFrame, config: CrawlConfig
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Documents and failures of the walked Word and Excel files.

    Files may have `status` and `error`: one that was not received is a failure.
    """
    kinds = {"docx": docx_text, "xlsx": xlsx_text}
    keyed = files.withColumn("norm_url", normalize_url("url"))
    reason = F.lit(None).cast("string")
    if "status" in files.columns:
        status = F.col("status")
        reason = F.when(status >= 400, F.concat(F.lit("HTTP "), status.cast("string")))
    if "error" in files.columns:
        reason = F.coalesce(F.col("error"), reason)
    documents, failed = [], []
    for kind, reader in kinds.items():
        if kind not in config.routes:
            continue
        of_kind = F.lower("norm_url").endswith(f".{kind}")
        walked = processed.filter(F.col("kind") == kind).select("norm_url")
        mine = keyed.filter(of_kind).join(walked, "norm_url", "left_semi")
        decoded = materialize(
            reader(
                mine.filter(reason.isNull()).select(
                    "url",
                    "norm_url",
                    last_modified("headers", "fetched_at").alias("last_modified"),
                    "content",
                )
            ),
            f"decoded-{kind}",
        )
        documents.append(
            documents_of(decoded).select(
                F.col("norm_url").alias("url"), "text", "last_modified"
            )
        )
        failed.append(failures_of(decoded))
        label = F.lit(f"{kind.upper()} parse error: ")
        failed.append(
            mine.filter(reason.isNotNull()).select("url", F.concat(label, reason).alias("reason"))
        )
    return documents, failed


def pdf_documents(
    inputs: CrawlInputs, processed: DataFrame, config: CrawlConfig
) -> tuple[DataFrame, DataFrame]:
    """Documents and failures of the walked PDFs, from page texts."""
    walked = processed.filter("kind = 'pdf'").select("norm_url")
    wanted = inputs.pdf_fetches.withColumn("norm_url", normalize_url("url")).join(
        walked, "norm_url", "left_semi"
    )
    attempts, left_out = wanted, []
    if config.max_pdf_bytes is not None:
        attempts = size_cut(wanted, config.max_pdf_bytes)
        size = F.col("length").cast("string")
        left_out = [
            wanted.filter(F.col("length") > config.max_pdf_bytes).select(
                "url", F.concat(F.lit("PDF too large: "), size, F.lit(" bytes")).alias("reason")
            )
        ]
    successes = fetch.pdf_successes(attempts, config.retry_count)
    stamped = attempts.select(
        "url",
        "attempt",
        "norm_url",
        last_modified("headers", "fetched_at").alias("last_modified"),
    )
    good = stamped.join(successes, ["url", "attempt"], "left_semi")
    # Only the pages of documents that count are joined to texts.
    walked_pages = inputs.pdf_pages.join(good.select("url").distinct(), "url", "left_semi")
    documents = (
        join_pages(walked_pages)
        .join(good, "url")
        .select(F.col("norm_url").alias("url"), "text", "last_modified")
    )
    failed = fetch.reconcile(fetch.pdf_failures(attempts, config.retry_count), successes)
    for more in left_out:
        failed = failed.unionByName(more)
    return documents, failed


def run_crawl(
    spark: SparkSession,
    config: CrawlConfig,
    inputs: CrawlInputs,
    out: str,
    batch: int = 0,
    make_embedder: Callable[[], Embedder] | None = None,
    make_codec: Callable[[], C.Codec] | None = None,
) -> CrawlResult:
    """Run one crawl into `out`/store and `out`/logs; a batch may be run again.

    Visited URLs and emitted chunks of every batch stay below `out`/state. With
    `skip_visited` and `skip_seen` in the settings a run leaves out those of the
    batches before it, so a repeat of a batch gives the same.
    """
    seeds, domains = seeds_and_domains(spark, config, inputs.seeds)
    outcomes, parsed = parsed_fetches(inputs.fetches, config)
    links = page_links(parsed, outcomes, domains, config.skip_patterns)
    policies = None
    if config.respect_robots and inputs.robots is not None:
        policies = materialize(
            robots_policies(inputs.robots, robots_rules(inputs.robots), config.user_agent),
            "policies",
        )
    visited = f"{out}/state/visited"
    frontier = crawl_frontier(
        start_urls(seeds, config, inputs.sitemaps),
        links,
        config.max_depth,
        config.skip_patterns,
        policies,
        visited_before(spark, visited, batch) if config.skip_visited else None,
    )
    processed = frontier.filter("processed").withColumn(
        "kind", route("norm_url", config.routes)
    )
    chosen = materialize(chosen_pages(outcomes, processed, domains), "chosen")

    documents = [html_documents(parsed, chosen, config)]
    failed = [
        fetch.failures(outcomes.join(processed.select("norm_url"), "norm_url", "left_semi")),
        parsed.filter("parse_error is not null")
        .join(chosen, ["url", "attempt"], "left_semi")
        .select("url", F.concat(F.lit("HTML error: "), "parse_error").alias("reason")),
    ]
    if inputs.files is not None:
        more, broken = file_documents(inputs.files, processed, config)
        documents += more
        failed += broken
    if inputs.pdf_pages is not None and inputs.pdf_fetches is not None:
        more, broken = pdf_documents(inputs, processed, config)
        documents.append(more)
        failed.append(broken)

    all_documents = documents[0]
    for more in documents[1:]:
        all_documents = all_documents.unionByName(more)
    emitted = C.emit_chunks(
        all_documents,
        config.window_size,
        config.token_overlap,
        make_codec,
    )
    if inputs.seen is not None:
        emitted = C.drop_seen(emitted, seen_keys(inputs.seen))
    seen = f"{out}/state/seen"
    if config.skip_seen:
        emitted = C.drop_seen(emitted, seen_before(spark, seen, batch))
    incoming = materialize(emitted, "chunks")
    fresh = C.with_ids(store.changed_rows(incoming, f"{out}/store", batch, "last_modified"))
    if make_embedder is None:
        none = {"embedding": F.lit(None).cast("array<float>"), ERROR: F.lit(None).cast("string")}
        fresh = fresh.withColumns(none)
    else:
        limit = config.embedding_token_limit
        fresh = embed(fresh, make_embedder, limit, make_codec=make_codec, errors=ERROR)
    # Chunks without a vector because of an error are written again by the next run.
    store.write_batch(fresh, f"{out}/store", batch, retry=ERROR)
    stored = store.read_batch(spark, f"{out}/store", f"{RECORD}, {ERROR} string", batch)
    written = stored.drop(ERROR)
    not_embedded = stored.filter(F.col(ERROR).isNotNull()).select(
        store.KEY, "url", "chunk_index", F.col(ERROR).alias("reason")
    )

    all_failures = failed[0]
    for more in failed[1:]:
        all_failures = all_failures.unionByName(more)
    all_failures = materialize(all_failures, "failures")
    gone = fetch.not_found_records(
        outcomes.join(processed.select("norm_url"), "norm_url", "left_semi"),
        config.save_404,
        "norm_url",
    )
    if config.save_404:
        write_chunks(gone, f"{out}/not_found/batch={batch}", "json")
    write_failures(all_failures, f"{out}/logs/failed_urls")
    write_emitted_urls(report.emitted_urls(written), f"{out}/logs/sitemap")
    write_emitted_docs(written.drop("blob_name"), f"{out}/logs/docs")
    remember(frontier, written, visited, seen, batch)
    return CrawlResult(
        frontier,
        written,
        all_failures,
        gone,
        report.run_summary(frontier, all_failures),
        not_embedded,
    )
