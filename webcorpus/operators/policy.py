"""Which URLs may be crawled, and what kind of document each one is."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.config import DEFAULT_USER_AGENT
from webcorpus.functions.urls import host_key, url_part

# Statuses of a robots file that forbid a whole site.
DENYING_STATUSES = (401, 403)
# What routing returns for each kind of document.
ROUTES = ("pdf", "docx", "xlsx")
UNSUPPORTED = ("doc", "xls")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def java_pattern(pattern: str) -> str:
    """Python regex to Java regex: the named-group and end-of-text spellings."""
    named = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", pattern)
    named = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", named)
    return re.sub(r"(?<!\\)((?:\\\\)*)\\Z", r"\1\\z", named)


def should_skip(url: Column | str, patterns: Sequence[str] = ()) -> Column:
    """Not http or https, or some pattern is found in the URL."""
    skip = ~url_part(url, "scheme").isin("http", "https")
    for pattern in patterns:
        skip = skip | _col(url).rlike(java_pattern(pattern))
    return skip


def apply_skip(df: DataFrame, url: str, patterns: Sequence[str] = ()) -> DataFrame:
    return df.filter(~should_skip(url, patterns))


def route(url: Column | str, include: Sequence[str] = ROUTES) -> Column:
    """Kind of document by the suffix of a normalised URL; html when none fits."""
    lowered = F.lower(_col(url))
    branch = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind in ROUTES:
        if kind in include:
            branch = branch.when(lowered.endswith(f".{kind}"), kind)
    for kind in UNSUPPORTED:
        branch = branch.when(lowered.endswith(f".{kind}"), "unsupported")
    return branch.otherwise("html")


def allowed_host(host: Column, domains: Sequence[str]) -> Column:
    """The host is one of a configured list of domains or lies below one.

    One set lookup per suffix of the host, whatever the length of the list.
    """
    return F.arrays_overlap(
        host_suffixes(host),
        F.array(*[F.lit(d) for d in domains]).cast("array<string>"),
    )


def host_suffixes(host: Column) -> Column:
    """`a.b.c` gives `a.b.c`, `b.c` and `c`."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def allow_domain_semi(
    df: DataFrame, url: str, domains: DataFrame | Sequence[str]
) -> DataFrame:
    """Rows whose host is an allowed domain or lies below one.

    A list is tested in place. A table of domains of any size is matched
    against the distinct hosts by equi-join on host suffixes; the rows
    themselves then take one semi-join on the host.
    """
    if not isinstance(domains, DataFrame):
        return df.filter(allowed_host(host_key(url), domains))
    hosted = df.withColumn("_host", host_key(url))
    allowed = (
        hosted.select("_host")
        .distinct()
        .select("_host", F.explode(host_suffixes(F.col("_host"))).alias("domain"))
        .join(domains.select("domain"), "domain", "left_semi")
        .select("_host")
        .distinct()
    )
    return hosted.join(allowed, "_host", "left_semi").drop("_host")


# --- robots -----------------------------------------------------------------


def number_groups(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `group_no` and `in_group` to classified robots lines.

    `kind` is agent, rule, blank or other and `line_no` gives the order. An
    agent line opens a group unless the line before it (others left out) is
    also an agent line. A blank line closes the group; rules outside a group
    do not count. One partition of the window is one robots file, which is one
    row of the table read.
    """
    significant = lines.filter(F.col("kind") != "other")
    ordered = Window.partitionBy(*keys).orderBy("line_no")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    opener = (F.col("kind") == "agent") & (
        F.coalesce(F.lag("kind").over(ordered), F.lit("blank")) != "agent"
    )
    boundary = F.when(F.col("kind").isin("agent", "blank"), F.col("kind"))
    return (
        significant.withColumn("_opens", opener.cast("int"))
        .withColumn("_last", F.last(boundary, ignorenulls=True).over(before))
        .withColumn(
            "group_no",
            F.sum("_opens").over(
                ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .withColumn(
            "in_group",
            (F.col("kind") == "agent")
            | ((F.col("kind") == "rule") & (F.coalesce("_last", F.lit("")) == "agent")),
        )
        .drop("_opens", "_last")
    )


def robots_policies(
    robots: DataFrame, rules: DataFrame, agent: str = DEFAULT_USER_AGENT
) -> DataFrame:
    """One row per site: the rules that bind `agent`, in file order.

    The first group that names a part of the agent's product token binds,
    else the first group for everyone. 401, 403 and 5xx deny the site; other
    4xx and a file that was never received leave it open.
    """
    token = agent.split("/")[0].lower()
    everyone = F.array_contains("agents", "*")
    named = F.exists("agents", lambda a: F.lit(token).contains(F.lower(a)))
    groups = (
        rules.groupBy("base", "group_no")
        .agg(
            F.first("agents").alias("agents"),
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("prefix").isNotNull(), F.struct("rule_no", "allow", "prefix")
                    )
                )
            ).alias("rules"),
        )
        .withColumn("_rank", F.when(everyone, 1).when(named, 0))
        .filter("_rank is not null")
    )
    binding = groups.groupBy("base").agg(
        F.min_by("rules", F.struct("_rank", "group_no")).alias("rules")
    )
    # Same choice as of the rules: one file per base, so that a URL stays one row.
    from webcorpus.sources.robots import latest_robots

    status = F.col("status")
    denied = status.isin(*DENYING_STATUSES) | (status >= 500)
    return (
        latest_robots(robots)
        .filter("status is not null")
        .select("base", F.coalesce(denied, F.lit(False)).alias("deny_all"))
        .join(binding, "base", "left")
    )


def first_match(rules: Column, path: Column) -> Column:
    """`allow` of the first rule in file order whose prefix fits; null if none does.

    Prefixes are literal: a `*` in one stands for itself.
    """
    fitting = F.filter(rules, lambda r: path.startswith(r["prefix"]))
    return F.get(fitting, F.lit(0))["allow"]


def unquote(text: Column) -> Column:
    """Percent-decode; text that cannot be decoded stays as it is."""
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text.contains("%"), F.coalesce(decoded, text)).otherwise(text)


#: Rules of one site up to which its URLs look through them all.
MANY_RULES = 256


def rule_index(policies: DataFrame, many: int = MANY_RULES) -> DataFrame:
    """(base, prefix, rule_no, allow) of the sites with many rules, a row per prefix.

    Of rules with one prefix only the first can decide.
    """
    rule = F.explode("rules").alias("_rule")
    first = F.min(F.struct("_rule.rule_no", "_rule.allow")).alias("_first")
    return (
        policies.filter(F.size("rules") > many)
        .select("base", rule)
        .groupBy("base", F.col("_rule.prefix").alias("prefix"))
        .agg(first)
        .select("base", "prefix", "_first.rule_no", "_first.allow")
    )


def indexed_match(targets: DataFrame, index: DataFrame) -> DataFrame:
    """(base, path, allow): the first rule that fits, for distinct (base, path).

    A path is looked up once for each length that the prefixes of its site have,
    however many rules there are. No row: no rule fits.
    """
    lengths = index.groupBy("base").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    probes = (
        targets.join(lengths, "base")
        .select("base", "path", F.explode("lengths").alias("_n"))
        .filter(F.col("_n") <= F.length("path"))
        .withColumn("prefix", F.left("path", F.col("_n")))
    )
    first = F.min(F.struct("rule_no", "allow")).alias("_first")
    return (
        probes.join(index, ["base", "prefix"])
        .groupBy("base", "path")
        .agg(first)
        .select("base", "path", F.col("_first.allow").alias("allow"))
    )


def robots_allowed(
    df: DataFrame, url: str, policies: DataFrame, many: int = MANY_RULES
) -> DataFrame:
    """Add `allowed` to rows of normalised URLs.

    The rules of a site arrive as one array with the row, so a URL is never
    multiplied by them. The rules of sites that have many are an index instead,
    in which a path is looked up. The policy side has one row per site: a hot
    site skews only the URL side, which adaptive execution splits.
    """
    target = url_part(url, "target")
    path = unquote(F.when(target == "", F.lit("/")).otherwise(target))
    base = F.concat(url_part(url, "scheme"), F.lit("://"), url_part(url, "netloc"))
    short = F.when(F.size("rules") <= many, F.col("rules")).alias("_rules")
    matched = first_match(F.col("_rules"), F.col("_path"))
    rows = df.withColumns({"_base": base, "_path": path}).join(
        policies.select(F.col("base").alias("_base"), F.col("deny_all").alias("_deny"), short),
        "_base",
        "left",
    )
    if not policies.filter(F.size("rules") > many).isEmpty():
        targets = rows.filter("_rules is null and not _deny").select(
            F.col("_base").alias("base"), F.col("_path").alias("path")
        )
        found = indexed_match(targets.distinct(), rule_index(policies, many)).select(
            F.col("base").alias("_base"), F.col("path").alias("_path"), F.col("allow").alias("_found")
        )
        rows = rows.join(found, ["_base", "_path"], "left")
        matched = F.coalesce("_found", matched)
    verdict = F.when(F.col("_deny"), F.lit(False)).otherwise(F.coalesce(matched, F.lit(True)))
    return rows.withColumn("allowed", verdict).select(*df.columns, "allowed")
