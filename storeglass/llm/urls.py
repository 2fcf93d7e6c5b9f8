"""URL filter by a tree of path templates (operator 7). Built-in functions only.

Urls become (host, shape): digit runs of a path segment turn into `#`. From the root down, the branches of every node of
a host's tree are compared by what is known of them: urls that a rule decides are labelled by it. However many they
are, a branch stays on its own only where its share of blocked labels differs clearly from its siblings', and the others
merge into `*`. A template is rejected if its share of
blocked labels, smoothed by that of its host and that by the share everywhere, is high enough.

The tree is built on distinct (host, shape) with counts, which are summed within tasks first: a host with a third of
all urls is a few rows. Each level is one grouping and one join, stored before the next.

Odd rows: a null url, or one without `://`, has an empty host and path, fits no rule and is judged like any other
template; null page_ids are kept; repeated rows are judged and counted each; an empty table gives an empty result; other
columns are ignored. Segments beyond MAX_DEPTH form one last segment.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from storeglass.llm.common import stored

#: (verdict, host, start of the path). The longest that fits decides.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MAX_DEPTH = 8
#: Branches of a node that are compared: any number.
MAX_BRANCHES = float("inf")
#: Standard errors by which a branch's share has to differ.
DEVIATION = 3.0
#: Labels that the smoothing adds, and the share from which a template is rejected.
PRIOR = 10.0
REJECT_FROM = 0.8

_PARTS = "(?s)^(.*?)://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, _PARTS, 2), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(whole, _PARTS, 3)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(of + start)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def segments(path: Column) -> Column:
    """Generalised segments; those beyond MAX_DEPTH as one."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/")
    return F.when(
        F.size(parts) > MAX_DEPTH,
        F.concat(F.slice(parts, 1, MAX_DEPTH - 1),
                 F.array(F.array_join(F.slice(parts, MAX_DEPTH, F.greatest(F.size(parts), F.lit(1))), "/"))),
    ).otherwise(parts)


def templates(shapes: DataFrame) -> DataFrame:
    """(host, shape, template) for stored rows (host, shape: array, n_block, n_allow)."""
    depth = shapes.agg(F.max(F.size("shape")).alias("d")).first()["d"] or 0
    tree = shapes.select("*", F.lit("").alias("template"))
    for level in range(depth):
        here = tree.withColumn("branch", F.get("shape", level))
        node = ["host", "template"]
        branches = here.filter("branch IS NOT NULL").groupBy(*node, "branch").agg(
            F.sum("n_block").alias("b"), F.sum(F.col("n_block") + F.col("n_allow")).alias("l"))
        whole = branches.groupBy(*node).agg(
            F.count("*").alias("kids"), F.sum("b").alias("all_b"), F.sum("l").alias("all_l"))
        rest = F.col("all_l") - F.col("l")
        share = F.col("all_b") / F.col("all_l")
        apart = F.abs(F.col("b") / F.col("l") - (F.col("all_b") - F.col("b")) / rest)
        error = F.sqrt(share * (1 - share) * (1 / F.col("l") + 1 / rest))
        alone = (F.col("kids") == 1) | (
            (F.col("l") > 0) & (rest > 0)
            & F.when((F.col("l") > 0) & (rest > 0), apart > DEVIATION * error).otherwise(False))
        named = branches.join(whole, node).select(
            *node, "branch", F.when(alone, F.col("branch")).otherwise("*").alias("name"))
        tree = stored(
            here.join(named, [*node, "branch"], "left").select(
                "host", "shape", "n_block", "n_allow",
                F.when(F.col("name").isNull(), F.col("template"))
                .otherwise(F.concat("template", F.lit("/"), "name")).alias("template")),
            f"level{level}")
    return tree


def smoothed(tree: DataFrame) -> DataFrame:
    """(host, template, purity): share of blocked labels, drawn towards the host's and that towards everybody's."""
    counts = lambda: (F.sum("n_block").alias("b"), F.sum(F.col("n_block") + F.col("n_allow")).alias("l"))
    every = tree.agg(*counts()).select(F.when(F.col("l") > 0, F.col("b") / F.col("l")).otherwise(0.0).alias("every"))
    hosts = tree.groupBy("host").agg(*counts()).join(F.broadcast(every)).select(  # one row
        "host", ((F.col("b") + PRIOR * F.col("every")) / (F.col("l") + PRIOR)).alias("of_host"))
    return tree.groupBy("host", "template").agg(*counts()).join(hosts, "host").select(
        "host", "template", ((F.col("b") + PRIOR * F.col("of_host")) / (F.col("l") + PRIOR)).alias("purity"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, reject_from: float = REJECT_FROM) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every page."""
    host, path = host_and_path(pages["url"].cast("string"))
    split = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    text, says = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = stored(split.select(
        "*", text.alias("rule"), says.alias("says"), segments(F.col("path")).alias("shape")), "urls")
    shapes = stored(ruled.groupBy("host", "shape").agg(
        F.count(F.when(F.col("says") == "block", 1)).alias("n_block"),
        F.count(F.when(F.col("says") == "allow", 1)).alias("n_allow")), "shapes")
    tree = templates(shapes)
    judged = stored(tree.select("host", "shape", "template").join(smoothed(tree), ["host", "template"]), "templates")
    own = F.when(F.col("purity") >= reject_from, F.lit("block")).otherwise("allow")
    return ruled.join(judged, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "template", "purity")
