"""URL filters: rules for hosts and paths, then a tree of path templates learned per host.

Paths become templates: at every node of a host's tree, from the root down, segments that vary turn into wildcards
(numbers, long hexadecimals and, where a node has too many different values for the number of its pages, those with
few labelled pages), and the remaining branches are merged where their share of bad labels does not differ from the node's by more than chance would have it. A
template is rejected if its smoothed purity is too low: labels of its own pages count fully, then those of its
host and of all pages as much as ``PRIOR`` pages.

Pages are first counted by host and path with numbers replaced; the tree is built on these counts, level by level, by
aggregations and joins that carry one row for each branch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesship.llm.common import ascii_lower, cut

#: (rule, allow); a rule is a host, then a path.
RULES = (
    ("org/", True),
    ("example.org/es/", False),
    ("example.org/en/1", False),
    ("com/fr/", True),
    ("com/de/", False),
)
#: A node varies if it has this many values, and this many for each page.
VALUES, VARIETY = 20, 0.3
#: Branches are like their node within so many standard errors. Purity under LEAST rejects; PRIOR pages smooth it.
Z, LEAST, PRIOR = 1.96, 0.5, 10.0
#: The last of so many segments takes all deeper ones with it.
DEPTH = 12
_END = "\x00"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, bool]] = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts with the rule's. Else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    """Segments with what always varies replaced: numbers, with their ending, and hexadecimals of 8 and more."""

    def general(s: Column) -> Column:
        s = F.regexp_replace(s, r"\A[0-9]+(\.[A-Za-z0-9]{1,5})?\z", "{n}$1")
        return F.regexp_replace(s, r"\A(?=[a-f-]*[0-9])[0-9a-f-]{8,}(\.[A-Za-z0-9]{1,5})?\z", "{h}$1")

    return F.transform(F.split(path, "/", DEPTH), general)


def templates(pages: DataFrame) -> DataFrame:
    """(host, raw, template, labelled, bad, purity) of ``pages`` (host, path, bad: 1, 0 or null)."""
    raw = F.array_join(_segments(F.col("path")), "/")
    counted = pages.groupBy("host", raw.alias("raw")).agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    tree = cut(counted.withColumns({"segments": F.split("raw", "/", DEPTH), "template": F.lit("")}))
    depth = tree.agg(F.coalesce(F.max(F.size("segments")), F.lit(0))).first()[0]
    for level in range(depth):
        tree = tree.withColumn("segment", F.coalesce(F.get("segments", F.lit(level)), F.lit(_END)))
        branches = cut(tree.groupBy("host", "template", "segment").agg(F.sum("n").alias("bn"), F.sum("labelled").alias("bl"), F.sum("bad").alias("bb")))
        inner = F.col("segment") != _END
        nodes = branches.groupBy("host", "template").agg(
            F.sum(F.when(inner, F.col("bn"))).alias("nn"), F.count(F.when(inner, 1)).alias("values"),
            F.sum(F.when(inner, F.col("bl"))).alias("nl"), F.sum(F.when(inner, F.col("bb"))).alias("nb"),
        )
        share = F.col("nb") / F.greatest(F.col("nl"), F.lit(1))
        error = F.sqrt(share * (1 - share) / F.greatest(F.col("bl"), F.lit(1)))
        alike = (F.col("bl") == 0) | (F.abs(F.col("bb") / F.col("bl") - share) <= Z * error)
        varies = (F.col("values") >= VALUES) & (F.col("values") > VARIETY * F.col("nn"))
        step = (
            F.when(F.col("segment") == _END, F.lit(""))
            .when(F.col("segment").rlike(r"\A\{[nh]\}"), F.concat(F.lit("/"), F.col("segment")))
            .when(varies & (F.col("bl") < PRIOR), F.lit("/*"))
            .when((F.col("segment") == "") & (F.col("template") == ""), F.lit(""))
            .when(alike, F.lit("/(alike)"))
            .otherwise(F.concat(F.lit("/"), F.col("segment")))
        )
        named = branches.join(nodes, ["host", "template"]).select("host", "template", "segment", step.alias("step"))
        tree = tree.join(named, ["host", "template", "segment"])
        tree = cut(tree.select("host", "raw", "n", "labelled", "bad", "segments", F.concat("template", "step").alias("template")))

    whole = tree.agg(F.coalesce(F.sum("labelled"), F.lit(0)).alias("al"), F.coalesce(F.sum("bad"), F.lit(0)).alias("ab")).first()
    overall = (whole["al"] - whole["ab"] + PRIOR) / (whole["al"] + PRIOR)
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("bad").alias("hb"))
    hosts = hosts.select("host", ((F.col("hl") - F.col("hb") + PRIOR * overall) / (F.col("hl") + PRIOR)).alias("host_purity"))
    own = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    own = own.join(hosts, "host")
    purity = (F.col("labelled") - F.col("bad") + PRIOR * F.col("host_purity")) / (F.col("labelled") + PRIOR)
    own = own.withColumn("purity", purity).drop("host_purity")
    return cut(tree.select("host", "raw", "template").join(own, ["host", "template"]))


def judge(pages: DataFrame, rules: Sequence[tuple[str, bool]] = RULES) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url, bad): host, path, rule, verdict, template and its purity.

    ``bad`` is a label: 1, 0, or null for none. A null URL and one without ``://`` have an empty host and path; they
    share one tree. With no labels at all everything is allowed that no rule blocks. Repeated rows count and are
    answered each; no rows give no rows; other columns are ignored.
    """
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("bad").cast("long").alias("bad"))
    learned = templates(pages).select(F.col("host").alias("of_host"), F.col("raw").alias("of_raw"), "template", "purity")
    pages = pages.withColumn("raw", F.array_join(_segments(F.col("path")), "/")).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    out = pages.join(learned, (F.col("host") == F.col("of_host")) & (F.col("raw") == F.col("of_raw")), "left")
    allowed = [rule for rule, allow in rules if allow]
    verdict = F.when(F.col("rule").isNotNull(), F.col("rule").isin(allowed)).otherwise(F.coalesce(F.col("purity") >= LEAST, F.lit(True)))
    return out.select("page_id", "host", "path", "rule", F.when(verdict, "allow").otherwise("block").alias("verdict"), "template", "purity")
