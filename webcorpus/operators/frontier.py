"""Graph traversal: the depth-limited crawl frontier and sitemap expansion.

The driver only counts levels. Each level is a join, a pre-aggregated
de-duplication and an anti-join, written to the shared folder as a batch of the
visited URLs, so that a lost executor re-reads files and the lineage does not grow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.urls import normalize_url
from webcorpus.operators import keyed
from webcorpus.operators.ordered import positions
from webcorpus.operators.policy import robots_allowed, should_skip
from webcorpus.operators.rows import exploded
from webcorpus.session import bucketed, materialize, new_folder

# Links in one bucket of the link table, on average.
LINKS_PER_BUCKET = 2_000_000

# A visited URL; the batch of its row is its depth.
_VISITED = "norm_url string, url string, depth int, processed boolean, rank long"


def distinct_targets(candidates: DataFrame, norm: str, url: str, order: str | None = None) -> DataFrame:
    """One row per normalised URL, with the raw URL that leads to it.

    That is the smallest, or with `order` the one that was found first, whose
    place is kept as `found`.
    """
    if order is None:
        return candidates.groupBy(F.col(norm).alias("norm_url")).agg(F.min(url).alias("url"))
    return candidates.groupBy(F.col(norm).alias("norm_url")).agg(
        F.min_by(url, F.struct(order, url)).alias("url"), F.min(order).alias("found")
    )


def drop_visited(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Candidates whose normalised URL was not visited."""
    return candidates.join(visited.select("norm_url"), "norm_url", "left_anti")


def expand(level: DataFrame, pages: DataFrame) -> DataFrame:
    """(dst_norm, dst_url, found) that the pages of a level link to.

    `level` has (norm_url, url, rank); `pages` has (src_norm, src_url, links), a
    row per page. Of several pages with one normalised URL the one that was
    walked counts, else the smallest. `found` is the place of the link in the
    walk: the rank of its page, and its position there.
    """
    other = F.col("src_url") != F.col("url")
    linked = (
        level.select("norm_url", "url", "rank")
        .join(pages, F.col("norm_url") == F.col("src_norm"))
        .groupBy("norm_url")
        .agg(F.first("rank").alias("rank"), F.min_by("links", F.struct(other, "src_url")).alias("links"))
    )
    return exploded(linked, ["rank"], F.col("links"), "_link").select(
        "_link.dst_norm", "_link.dst_url", F.struct("rank", F.col("_link.pos")).alias("found")
    )


def minus(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner in `right`."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def adjacency(links: DataFrame) -> DataFrame:
    """(src_norm, src_url, links): the links of each page as one array, in order.

    `links` has (src_norm, dst_url, dst_norm) and optionally `src_url` and `pos`,
    the link's position on its page; without one, links are in order of URL.
    """
    position = F.col("pos").cast("long") if "pos" in links.columns else F.lit(0).cast("long")
    source = "src_url" if "src_url" in links.columns else "src_norm"
    target = F.struct(position.alias("pos"), "dst_url", "dst_norm")
    return (
        links.groupBy("src_norm", F.col(source).alias("_url"))
        .agg(F.array_sort(F.collect_list(target)).alias("links"))
        .select("src_norm", F.col("_url").alias("src_url"), "links")
    )


def _bucket_count(pages: DataFrame) -> int:
    """Buckets for a link table of any size."""
    found = pages.agg(F.sum(F.size("links"))).first()[0] or 0
    least = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-found // LINKS_PER_BUCKET))


def crawl_frontier(
    seeds: DataFrame,
    links: DataFrame,
    max_depth: int,
    skip_patterns: Sequence[str] = (),
    policies: DataFrame | None = None,
    visited: DataFrame | None = None,
    ranked: bool = False,
) -> DataFrame:
    """Breadth-first walk: (norm_url, url, depth, processed), with `rank` if asked for.

    `seeds` has `url` and optionally `pos`; `links` is already filtered and has a
    row per link or, as `adjacency` gives it, per page. Every normalised URL
    appears once, at its smallest depth. URLs at depth `max_depth` + 1 and URLs
    that policy rejects are visited but not processed. `visited` holds URLs
    (norm_url) of earlier runs. `rank` is the place in the queue of a walk that
    takes pages one by one and follows their links in order.

    Links and visited URLs are bucketed alike. A level's candidates move to them;
    neither links nor earlier levels move again.
    """
    spark = seeds.sparkSession
    pages = materialize(links if "links" in links.columns else adjacency(links), "links")
    count = _bucket_count(pages)
    known = new_folder(spark, "visited")
    place = F.col("pos") if "pos" in seeds.columns else F.lit(0)
    seed = F.struct(F.lit(0).cast("long").alias("rank"), place.cast("long").alias("pos"))
    reached = seeds.select(
        normalize_url("url").alias("dst_norm"), F.col("url").alias("dst_url"), seed.alias("found")
    )
    total = 0
    with bucketed(pages, ("src_norm",), "adjacency", count) as table:
        for depth in range(max_depth + 2):
            candidates = distinct_targets(reached, "dst_norm", "dst_url", "found" if ranked else None)
            candidates = candidates.repartition(count, "norm_url")
            if depth:
                candidates = drop_visited(candidates, walked)
            if visited is not None:
                candidates = drop_visited(candidates, visited)
            level = _admit(candidates, depth, max_depth, skip_patterns, policies)
            if ranked:
                level = positions(level, ["found", "url"], "rank", total)
            else:
                level = level.withColumn("rank", F.lit(None).cast("long"))
            names = ["norm_url", "url", "depth", "processed", "rank"]
            keyed.write_batch(level.select(*names), known, depth, ["norm_url"], count)
            walked = keyed.read_batches(spark, known, _VISITED, ["norm_url"], buckets=count)
            level = walked.filter(F.col("batch") == depth)
            size = level.count()
            total += size
            if not size:
                break
            reached = expand(level.filter("processed"), table)
    return walked.drop("batch") if ranked else walked.drop("batch", "rank")


def _admit(
    candidates: DataFrame,
    depth: int,
    max_depth: int,
    skip_patterns: Sequence[str],
    policies: DataFrame | None,
) -> DataFrame:
    wanted: Column = F.lit(depth <= max_depth) & ~should_skip("norm_url", skip_patterns)
    if policies is not None:
        candidates = robots_allowed(candidates, "norm_url", policies)
        wanted = wanted & F.col("allowed")
    return candidates.select(
        *[c for c in ("norm_url", "url", "found") if c in candidates.columns],
        F.lit(depth).alias("depth"),
        wanted.alias("processed"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def ordered(frontier: DataFrame) -> DataFrame:
    """Listing of a frontier in queue order if it is ranked, else level by level."""
    return frontier.orderBy("rank") if "rank" in frontier.columns else frontier.orderBy("depth", "norm_url")


def pending(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Visited URLs whose page was never fetched; `pages` has `url`."""
    fetched = pages.select(normalize_url("url").alias("norm_url")).distinct()
    return frontier.join(fetched, "norm_url", "left_anti")


# --- sitemaps ---------------------------------------------------------------


def sitemap_children(reached: DataFrame, index: DataFrame) -> DataFrame:
    """(root, sitemap_url) of the sitemaps that the indexes just reached list."""
    return (
        reached.join(index, "sitemap_url")
        .select("root", F.col("loc").alias("sitemap_url"))
        .distinct()
    )


def expand_sitemaps(
    locs: DataFrame, roots: DataFrame, skip_patterns: Sequence[str] = ()
) -> DataFrame:
    """Leaf locations below each root sitemap: (root, sitemap_url, pos, loc).

    `locs` has (sitemap_url, kind, pos, loc) and `roots` has `root`. Below one
    root every listed sitemap is followed once. Duplicates in a urlset stay.
    """
    locs = materialize(locs, "sitemap-locs")
    index = locs.filter("kind = 'index'").select("sitemap_url", "loc")
    reached = roots.select("root", F.col("root").alias("sitemap_url")).distinct()
    level = materialize(reached, "sitemap-level")
    levels = [level]
    while True:
        fresh = minus(
            sitemap_children(level, index), _union(levels), ["root", "sitemap_url"]
        )
        level = materialize(fresh, "sitemap-level")
        if level.isEmpty():
            break
        levels.append(level)
    leaves = locs.filter("kind = 'urlset'").select("sitemap_url", "pos", "loc")
    found = _union(levels).join(leaves, "sitemap_url")
    return found.filter(~should_skip("loc", skip_patterns)).select(
        "root", "sitemap_url", "pos", "loc"
    )


def _closure(start: DataFrame, steps: DataFrame, label: str) -> DataFrame:
    """(sitemap_url) of `start` and what (sitemap_url, next) steps lead to, each once."""
    level = materialize(start.distinct(), label)
    levels = [level]
    while True:
        reached = level.join(steps, "sitemap_url").select(F.col("next").alias("sitemap_url"))
        level = materialize(minus(reached.distinct(), _union(levels), ["sitemap_url"]), label)
        if level.isEmpty():
            return _union(levels)
        levels.append(level)


def sitemap_starts(
    seeds: DataFrame, locs: DataFrame, skip_patterns: Sequence[str] = ()
) -> DataFrame:
    """(url): the locations below the seeds' sitemaps, and the seeds that have none.

    Every sitemap is followed once, whatever the number of seeds that share it:
    downwards from the seeds' sitemaps for the locations, and upwards from the
    sitemaps with locations for the seeds that reach one.
    """
    locs = materialize(locs, "sitemap-locs")
    index = locs.filter("kind = 'index'")
    leaves = locs.filter((F.col("kind") == "urlset") & ~should_skip("loc", skip_patterns))
    rooted = materialize(seeds.select("seed", sitemap_of("seed").alias("sitemap_url")), "seeds")
    down = index.select("sitemap_url", F.col("loc").alias("next"))
    up = index.select(F.col("loc").alias("sitemap_url"), F.col("sitemap_url").alias("next"))
    reached = _closure(rooted.select("sitemap_url"), down, "sitemaps-reached")
    useful = _closure(leaves.select("sitemap_url"), up, "sitemaps-useful")
    found = leaves.join(reached, "sitemap_url", "left_semi").select(F.col("loc").alias("url"))
    bare = rooted.join(useful, "sitemap_url", "left_anti").select(F.col("seed").alias("url"))
    return found.unionByName(bare).distinct()


def sitemap_of(seed: Column | str) -> Column:
    """Where a seed's sitemap is."""
    seed = F.col(seed) if isinstance(seed, str) else seed
    return F.concat(F.rtrim(seed, F.lit("/")), F.lit("/sitemap.xml"))


def sitemap_or_seed(seeds: DataFrame, leaves: DataFrame) -> DataFrame:
    """(seed, url, from_sitemap): a seed's sitemap locations, or the seed itself.

    `leaves` has (root, loc) where root is the seed's sitemap.
    """
    rooted = seeds.select("seed", sitemap_of("seed").alias("root"))
    return rooted.join(leaves.select("root", "loc"), "root", "left").select(
        "seed",
        F.coalesce("loc", "seed").alias("url"),
        F.col("loc").isNotNull().alias("from_sitemap"),
    )
