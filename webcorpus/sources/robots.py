"""Robots files as tables of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import LINE_BREAK, strip
from webcorpus.operators.policy import number_groups, unquote
from webcorpus.operators.rows import exploded

# Fields of a robots file; the last two bind nothing but belong
# to a group like any rule.
RULE_FIELDS = ("allow", "disallow", "crawl-delay", "request-rate")


def latest_robots(robots: DataFrame) -> DataFrame:
    """One file per base: the newest by `fetched_at` where there is such a column.

    Of equally new files an answered one counts before one never received, then
    the greater status and text, so that the choice does not depend on order.
    """
    newest = [F.col("fetched_at")] if "fetched_at" in robots.columns else []
    order = F.struct(*newest, F.col("status"), F.coalesce("body", F.lit("")))
    fields = [c for c in robots.columns if c != "base"]
    return (
        robots.groupBy("base")
        .agg(F.max_by(F.struct(*fields), order).alias("_file"))
        .select("base", *[F.col(f"_file.{c}").alias(c) for c in fields])
    )


def robots_lines(robots: DataFrame) -> DataFrame:
    """(base, line_no, kind, field, value) of every line of the files received."""
    lines = F.split(F.coalesce("body", F.lit("")), LINE_BREAK)
    received = latest_robots(robots).filter("status = 200")
    raw = exploded(received, ["base"], lines, "line", "line_no")
    bare = strip(F.regexp_replace("line", "#.*$", ""))
    field = F.when(
        bare.contains(":"), F.lower(strip(F.regexp_extract(bare, "^([^:]*):", 1)))
    )
    value = unquote(strip(F.regexp_extract(bare, "^[^:]*:(.*)$", 1)))
    kind = (
        F.when(F.col("line") == "", "blank")
        .when(F.col("field") == "user-agent", "agent")
        .when(F.col("field").isin(*RULE_FIELDS), "rule")
        .otherwise("other")
    )
    return raw.select(
        "base", "line_no", "line", field.alias("field"), value.alias("value")
    ).select("base", "line_no", kind.alias("kind"), "field", "value")


def robots_rules(robots: DataFrame) -> DataFrame:
    """(base, group_no, agents, rule_no, allow, prefix), one row per rule.

    `agents` lists the agents of the group the rule is in. Fields that bind
    nothing give a row without `allow` and `prefix`, so that their group is
    known. An empty `Disallow` allows everything.
    """
    lines = number_groups(robots_lines(robots), ["base"]).filter("in_group")
    agents = (
        lines.filter("kind = 'agent'")
        .groupBy("base", "group_no")
        .agg(F.array_sort(F.collect_set("value")).alias("agents"))
    )
    binds = F.col("field").isin("allow", "disallow")
    rules = lines.filter("kind = 'rule'").select(
        "base",
        "group_no",
        F.col("line_no").alias("rule_no"),
        F.when(binds, (F.col("field") == "allow") | (F.col("value") == "")).alias("allow"),
        F.when(binds, F.col("value")).alias("prefix"),
    )
    return agents.join(rules, ["base", "group_no"]).select(
        "base", "group_no", "agents", "rule_no", "allow", "prefix"
    )
