"""Verdicts on URLs: listed rules first, then a tree of path templates per host.

The tree starts from paths whose variable segments (numbers, long identifiers) are
wildcards. Level by level, from the root, the children of a node are compared with the node as a whole:
one whose next segments are spread alike, or no further apart than chance makes so few pages, and whose share of
good pages doesn't differ significantly is merged into a wildcard branch, however many siblings it has. Levels go on
until no two paths part any more; those that part nowhere below a node are left out of the rest. What remains are templates. A template is rejected if its share of good pages, smoothed towards the
share of all, lies significantly below that share and below ``PUREST``.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .common import read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEW = 3  # labelled pages below which a child's share of good ones says nothing
SPREAD = 0.3  # greatest distance between distributions that counts as alike
CHANCE = 1.22  # distance times root of pages that draws exceed their mean by in one of 20 cases
SIGNIFICANT = 1.96  # standard errors
SMOOTHING = 10.0  # pages of the overall share added to every template
PUREST = 0.75  # purity from which a template is allowed, whatever the share of all
DOUBT = 2.58  # standard errors by which a rejected template falls short


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in ASCII lower case and path; both empty for null and for texts without ``://``."""
    parts = r"(?s)://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER), F.regexp_extract(url, parts, 2)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """``action, rule, rule_host, rule_path`` of rules like ``("block", "net/es/")``."""
    rows = [(action, rule, rule.partition("/")[0], rule[len(rule.partition("/")[0]) :]) for action, rule in rules]
    return spark.createDataFrame(rows, "action string, rule string, rule_host string, rule_path string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: those of each host and its parent domains, longest rule first."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = hosts.select("host", F.explode(parents).alias("rule_host")).join(rules, "rule_host")
    entry = F.struct(
        (-F.length("rule")).alias("order"), (-F.length("rule_host")).alias("host_order"), "rule", "rule_path", "action"
    )
    return fitting.groupBy("host").agg(F.array_sort(F.collect_set(entry)).alias("rules"))


def general_segments(path: Column) -> Column:
    """Segments of a path with numbers as ``#`` and long identifiers as ``*``."""

    def level(segment: Column) -> Column:
        opaque = segment.rlike("^(?=.*[0-9])[0-9A-Fa-f-]{16,}$") | (F.length(segment) > 64)
        return F.when(opaque, F.lit("*")).otherwise(F.regexp_replace(segment, "[0-9]+", "#"))

    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), level)


def parting(tree: DataFrame, depth: int) -> DataFrame:
    """The tree with ``parts``: the first level beyond ``depth`` at which paths of a row's node part, null if they don't.

    Paths that are the same from there on, or end, part nowhere.
    """
    prefix = F.array_join(F.slice("segments", 1, depth), "/") if depth else F.lit("")
    placed = tree.withColumn("prefix", prefix)
    ends = placed.where(F.size("segments") > depth).groupBy("host", "prefix").agg(F.min("segments").alias("least"), F.max("segments").alias("most"))
    levels = F.sequence(F.lit(1), F.greatest(F.size("least"), F.size("most")))
    apart = F.array_min(F.filter(levels, lambda i: ~F.get("least", i - 1).eqNullSafe(F.get("most", i - 1))))
    nodes = ends.where("least != most").select("host", "prefix", apart.alias("parts"))
    going = F.when(F.size("segments") > depth, F.col("parts")).alias("parts")
    return placed.join(nodes, ["host", "prefix"], "left").select("host", "general", "segments", "pages", "labelled", "good", going)


def merge_level(tree: DataFrame, depth: int) -> DataFrame:
    """The tree with the ``depth``-th segments generalised where branches are alike.

    ``tree`` has ``host, general, segments, pages, labelled, good``; only ``segments`` change.
    """
    node = ["host", "prefix"]
    placed = tree.select(
        "*",
        F.array_join(F.slice("segments", 1, depth - 1), "/").alias("prefix"),
        F.try_element_at("segments", F.lit(depth)).alias("child"),
        F.coalesce(F.try_element_at("segments", F.lit(depth + 1)), F.lit("/")).alias("next"),
    )
    inner = placed.where(F.col("child").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "good")]
    by_next = inner.groupBy(*node, "child", "next").agg(*sums)
    by_child = by_next.groupBy(*node, "child").agg(*sums)
    parents = by_child.groupBy(*node).agg(
        F.count("*").alias("children"), *[F.sum(c).alias(f"all_{c}") for c in ("pages", "labelled", "good")]
    )
    pooled = by_next.groupBy(*node, "next").agg(F.sum("pages").alias("next_pages"))
    square = F.sum(F.col("next_pages").cast("double") * F.col("next_pages"))
    kinds = pooled.groupBy(*node).agg(F.count("*").alias("kinds"), square.alias("squares"))
    shares = (
        by_next.select(*node, "child", "next", F.col("pages").alias("here"))
        .join(pooled, [*node, "next"])
        .join(by_child.select(*node, "child", "pages"), [*node, "child"])
        .join(parents.select(*node, "all_pages"), node)
    )
    own, whole = F.col("here") / F.col("pages"), F.col("next_pages") / F.col("all_pages")
    apart = shares.groupBy(*node, "child").agg(((F.sum(F.abs(own - whole)) + 1 - F.sum(whole)) / 2).alias("apart"))
    rate, others = F.try_divide("good", "labelled"), F.col("all_labelled") - F.col("labelled")
    other_rate = F.try_divide(F.col("all_good") - F.col("good"), others)
    pool = F.try_divide("all_good", "all_labelled")
    error = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1), "labelled") + F.try_divide(F.lit(1), others)))
    same_rate = F.when((F.col("labelled") >= FEW) & (others > 0), F.abs(rate - other_rate) <= SIGNIFICANT * error).otherwise(True)
    # as many pages drawn from the whole node are this far from it, on average at most and then by chance
    uneven = F.greatest(F.lit(0.0), 1 - F.col("squares") / F.col("all_pages") / F.col("all_pages"))
    chance = (F.sqrt(F.col("kinds") * uneven) / 2 + CHANCE) / F.sqrt("pages")
    alike = (F.col("children") > 1) & (F.col("apart") <= F.greatest(F.lit(SPREAD), chance)) & same_rate
    merged = (
        by_child.join(parents.join(kinds, node), node).join(apart, [*node, "child"])
        .where(alike)
        .select(*node, "child", F.lit("*").alias("wildcard"))
    )
    chosen = placed.join(merged, [*node, "child"], "left")
    replaced = F.transform("segments", lambda s, i: F.when((i == depth - 1) & F.col("wildcard").isNotNull(), "*").otherwise(s))
    return chosen.select("host", "general", replaced.alias("segments"), "pages", "labelled", "good")


def template_tree(pages: DataFrame) -> DataFrame:
    """``host, general, template, purity, pure`` for rows of ``host, general, good`` (1, 0, null: not labelled).

    Not ``pure`` are templates that fall significantly short of the share of all, or of ``PUREST`` if that is less;
    one without labels has the share of all and is pure.
    """
    counted = pages.groupBy("host", "general").agg(
        F.count("*").alias("pages"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good")
    )
    tree = stage(counted.withColumn("segments", F.col("general")))
    settled, depth = [], 0
    while True:
        marked = stage(parting(tree, depth))
        settled.append(marked.where("parts IS NULL").drop("parts"))
        depth = marked.agg(F.min("parts")).first()[0]
        if depth is None:
            break
        tree = stage(merge_level(marked.where("parts IS NOT NULL").drop("parts"), depth))
    tree = reduce(DataFrame.unionByName, settled)
    template = F.concat(F.lit("/"), F.array_join("segments", "/")).alias("template")
    overall = tree.agg(F.sum("good") / F.nullif(F.sum("labelled"), F.lit(0))).first()[0]
    overall = 1.0 if overall is None else overall
    purity = (F.sum("good") + SMOOTHING * overall) / (F.sum("labelled") + SMOOTHING)
    error = F.sqrt(F.lit(overall * (1 - overall)) / (F.sum("labelled") + SMOOTHING))
    pure = (F.sum("labelled") == 0) | (purity + DOUBT * error >= min(PUREST, overall))
    templates = tree.select("*", template).groupBy("host", "template").agg(purity.alias("purity"), pure.alias("pure"))
    return tree.select("host", "general", template).join(templates, ["host", "template"])


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every row of ``(page_id, url, good)``.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest
    wins. ``verdict`` is the rule's, else that of the path's template. ``good`` is 1 or 0 on labelled pages,
    null on others; without any label every template is pure. Repeated rows are judged each; null
    urls have an empty host and path and are judged like any.
    """
    host, path = host_and_path(F.col("url"))
    parsed = stage(
        pages.select("page_id", host.alias("host"), path.alias("path"), F.col("good").cast("double").alias("good")).withColumn(
            "general", general_segments(F.col("path"))
        )
    )
    listed = host_rules(parsed.select("host").distinct(), rules)
    # every kind of path once, then the pages: a common host meets few rows on the other side
    judged = parsed.join(template_tree(parsed), ["host", "general"]).join(listed, "host", "left")
    won = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0))
    by_template = F.when(F.col("pure"), "allow").otherwise("block")
    return judged.withColumn("won", won).select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.action", by_template).alias("verdict"), "template", "purity"
    )


RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op3_path_template_tree(spark, sf_dir):
    """Verdicts on all pages; a page is labelled by the document whose number its path ends in."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(host_and_path(F.col("url"))[1], r"([0-9]{1,18})[^0-9]*$", 1)
    rated = (F.col("quality") == 1) & (F.col("toxic") == 0)
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.avg(rated.cast("double")).alias("good"))
    labels = labels.where(F.col("doc_id") >= 0).withColumnRenamed("doc_id", "number")
    # pages without a number meet no label, and are dealt by numbers that no label has
    unnumbered = -1 - F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40))
    numbered = pages.withColumn("number", F.coalesce(number.try_cast("bigint"), unnumbered))
    return judge_urls(numbered.join(labels, "number", "left"), rule_table(spark, RULES))
