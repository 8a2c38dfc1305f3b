"""Robots files to rules, and the allow test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.columns import as_col
from gondola.functions.urls import url_host, url_path
from gondola.session import materialise


def _unquoted(c: Column) -> Column:
    # a plus sign is literal in a path
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def robots_lines(files: DataFrame) -> DataFrame:
    """Lines of robots files ``(host, body)`` as ``(host, line_no, field, value)``.

    An empty line has the field ``''``; comments and lines that say nothing are left out.
    """
    lines = files.select("host", F.posexplode(F.split("body", r"\r\n|\r|\n")).alias("line_no", "line"))
    bare = F.trim(F.regexp_replace("line", r"#.*$", ""))
    lines = lines.withColumn("bare", bare).filter((F.col("line") == "") | F.contains("bare", F.lit(":")))
    return lines.select(
        "host",
        "line_no",
        F.lower(F.trim(F.regexp_extract("bare", r"^([^:]*)", 1))).alias("field"),
        _unquoted(F.trim(F.regexp_extract("bare", r"^[^:]*:(.*)$", 1))).alias("value"),
    )


def robots_rules(files: DataFrame) -> DataFrame:
    """one row per agent and rule: ``host, group_no, agent, rule_no, prefix, allow``.

    Consecutive agent lines share a group; an empty line ends it. Rules outside a group are
    ignored, and so are groups without any. Windows run within one robots file.
    """
    in_file = Window.partitionBy("host").orderBy("line_no")
    so_far = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_agent = F.col("field") == "user-agent"
    # crawl-delay and request-rate take a rule's place without ruling out any path
    is_rule = F.col("field").isin("allow", "disallow", "crawl-delay", "request-rate")
    events = robots_lines(files).filter(is_agent | is_rule | (F.col("field") == ""))
    follows_agent = F.coalesce(F.lag("field").over(in_file), F.lit("")) == "user-agent"
    opener = F.last(F.when(is_agent | (F.col("field") == ""), F.col("field")), ignorenulls=True)
    grouped = events.select(
        "*",
        F.sum((is_agent & ~follows_agent).cast("int")).over(so_far).alias("group_no"),
        F.coalesce(opener.over(so_far) == "user-agent", F.lit(False)).alias("in_group"),
    ).filter("in_group")
    rule = F.struct(
        F.col("line_no").alias("rule_no"),
        F.when(F.col("field").isin("allow", "disallow"), F.col("value")).alias("prefix"),
        # an empty Disallow allows everything
        ((F.col("field") == "allow") | (F.col("value") == "")).alias("allow"),
    )
    # a group is a part of one file, and already in one place
    groups = grouped.groupBy("host", "group_no").agg(
        F.collect_set(F.when(is_agent, F.lower("value"))).alias("agents"),
        F.collect_list(F.when(is_rule, rule)).alias("rules"),
    )
    per_agent = groups.select("host", "group_no", F.explode("agents").alias("agent"), "rules")
    return per_agent.select("host", "group_no", "agent", F.inline("rules"))


def robots_sitemaps(files: DataFrame) -> DataFrame:
    """the Sitemap lines."""
    lines = robots_lines(files).filter(F.col("field") == "sitemap")
    return lines.select("host", "line_no", F.col("value").alias("sitemap_url"))


def host_policies(rules: DataFrame, user_agent: str) -> DataFrame:
    """The rules that apply to one agent, as one short row per host.

    The first group that names the agent counts, else the first group for ``*``. A group that
    has ``*`` among its agents is a group for ``*`` only.

    The table is written: it serves several joins, and a join that reads it from a table lets
    Spark broadcast it by its known size or split the URLs of a busy host.
    """
    token = user_agent.split("/")[0].lower()
    names_agent = F.contains(F.lit(token), F.col("agent"))
    groups = rules.groupBy("host", "group_no").agg(
        F.bool_or(F.col("agent") == "*").alias("for_all"),
        F.bool_or(names_agent).alias("for_agent"),
        F.array_sort(F.collect_set(F.struct("rule_no", "prefix", "allow"))).alias("rules"),
    )
    specific = F.col("for_agent") & ~F.col("for_all")
    rank = F.struct(F.when(specific, 0).otherwise(1), "group_no")
    usable = groups.filter(specific | F.col("for_all"))
    return materialise(usable.groupBy("host").agg(F.min_by("rules", rank).alias("rules")), "policies")


def with_allowed(urls: DataFrame, policies: DataFrame, url: str = "url") -> DataFrame:
    """Add ``allowed``. Only the path is tested; the first matching rule decides.

    One row per host joins the URLs, so no URL is multiplied by rules.
    """
    path = _unquoted(url_path(as_col(url)))
    keyed = urls.withColumn("_host", url_host(url)).withColumn("_path", path)
    joined = keyed.join(policies.withColumnRenamed("host", "_host"), "_host", "left")
    # an empty Allow or Disallow is a prefix of every path; "*" is no wildcard and matches none
    applies = lambda r: F.startswith(F.col("_path"), r["prefix"])
    allowed = F.get(F.filter("rules", applies), F.lit(0))["allow"]
    return joined.withColumn("allowed", F.coalesce(allowed, F.lit(True))).select(*urls.columns, "allowed")
