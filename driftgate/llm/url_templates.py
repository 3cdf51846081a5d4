"""URL filters: a path-template tree per host, learned from rule-labelled urls.

Everything is a function of (host, path), so distinct pairs are counted first
and joined back last.  Per host and number of segments, a path position is
variable if most of its values are distinct; there, and for values with fewer
than ``least_count`` urls at any position, the segment becomes a wildcard.  A
value counts by its own urls, however many its host has.  Templates that differ
only in their last literal segment are branches of one node: a branch merges
with its siblings if both sides have at least ``least_labelled`` labelled urls
and the branch's share of blocked ones is not significantly different from the
siblings' pooled share (two-proportion z test).  A branch that cannot be tested
stays by itself, so that labels never decide urls they were not compared with.
This is done ``levels`` times, so merged nodes are branches of the nodes above.
A template is rejected if it has ``least_labelled`` labelled urls and its purity,
their blocked share smoothed towards its host's share (and that towards the
whole table's), reaches ``reject``.

Labels come from the rules: a rule is a host and a path prefix, fits the host
and its subdomains, and the longest fitting rule decides its urls itself.

DataFrame functions only; url pairs, branches and each level are checkpointed in
the shared folder.  Defined cases: a null url, or one without "://", has
an empty host and path and forms a template like any other; paths without a
segment have the template "/"; repeated rows and null ids are judged row by
row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed

#: (verdict, rule)
Rules = list[tuple[str, str]]

WILD = "*"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(raw, upper, upper.lower())
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(rules: Rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        of, _, start = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit(f".{of}"))) & F.startswith(path, F.lit(f"/{start}"))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame,
    rules: Rules,
    id_col: str = "page_id",
    url: str = "url",
    distinct_share: float = 0.5,
    least_count: int = 3,
    levels: int = 2,
    z: float = 1.96,
    least_labelled: int = 5,
    weight: float = 4.0,
    reject: float = 0.5,
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, template and purity."""
    host, path = url_parts(F.col(url).cast("string"))
    src = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    paths = src.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).select("host", "path", "n", rule.alias("rule"), verdict.alias("rule_verdict"))
    paths = paths.withColumn("parts", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("deep", F.size("parts"))

    # segments of the tree: which are variable, which values are frequent
    seg = paths.where("deep > 0").select("host", "path", "n", "deep", F.posexplode("parts").alias("pos", "value"))
    values = seg.groupBy("host", "deep", "pos", "value").agg(F.sum("n").alias("c"))
    spots = values.groupBy("host", "deep", "pos").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
    literal = (
        values.join(spots, ["host", "deep", "pos"])
        .where((F.col("kinds") <= F.col("total") * distinct_share) & (F.col("c") >= least_count))
        .select("host", "deep", "pos", "value", F.lit(True).alias("literal"))
    )
    general = seg.join(literal, ["host", "deep", "pos", "value"], "left").groupBy("host", "path")
    shaped = general.agg(F.sort_array(F.collect_list(F.struct("pos", F.when(F.col("literal"), F.col("value")).otherwise(WILD).alias("s")))).alias("segs"))
    shaped = shaped.select("host", "path", F.col("segs.s").alias("segs"))
    paths = paths.join(shaped, ["host", "path"], "left").withColumn("segs", F.coalesce("segs", F.array().cast("array<string>")))
    # written: branches, levels and verdicts read it, and plans stay small
    paths = checkpointed(paths.select("host", "path", "n", "rule", "rule_verdict", "segs", _name(F.col("segs")).alias("template")))

    # labelled urls by branch, merged node, host and all
    labelled = F.coalesce(F.sum(F.when(F.col("rule").isNotNull(), F.col("n"))), F.lit(0)).alias("labelled")
    blocked = F.coalesce(F.sum(F.when(F.col("rule_verdict") == "block", F.col("n"))), F.lit(0)).alias("blocked")
    branches = checkpointed(paths.groupBy("host", "template").agg(F.first("segs").alias("segs"), labelled, blocked))
    hosts = branches.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    every = branches.agg(F.coalesce(F.sum("labelled"), F.lit(0)).alias("all_labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("all_blocked"))
    b = branches.withColumn("merged", F.col("segs"))
    for _ in range(levels):
        b = checkpointed(_merged_once(b, z, least_labelled))
    b = b.withColumn("merged", _name(F.col("merged")))
    merged = b.groupBy("host", "merged").agg(F.sum("labelled").alias("m_labelled"), F.sum("blocked").alias("m_blocked"))
    b = b.select("host", "template", "merged").join(merged, ["host", "merged"]).join(hosts, "host")
    # one number: the whole table's share
    all_share = every.select((F.col("all_blocked") + 0.0) / (F.col("all_labelled") + weight)).scalar()
    host_share = (F.col("host_blocked") + weight * all_share) / (F.col("host_labelled") + weight)
    b = b.withColumn("purity", (F.col("m_blocked") + weight * host_share) / (F.col("m_labelled") + weight))
    verdicts = paths.select("host", "path", "template", "rule", "rule_verdict").join(b.select("host", "template", "merged", "m_labelled", "purity"), ["host", "template"])
    made = F.when((F.col("m_labelled") >= least_labelled) & (F.col("purity") >= reject), "block").otherwise("allow")
    verdicts = verdicts.select("host", "path", "rule", F.coalesce("rule_verdict", made).alias("verdict"), F.col("merged").alias("template"), "purity")
    return src.join(verdicts, ["host", "path"]).select(id_col, "host", "path", "rule", "verdict", "template", "purity")


def _name(segs: Column) -> Column:
    return F.concat(F.lit("/"), F.array_join(segs, "/"))


def _merged_once(b: DataFrame, z: float, least_labelled: int) -> DataFrame:
    """The branches with ``merged``, the segments of their present node, one level up the tree where the test allows it."""
    merged = F.col("merged")
    # the node above the last literal: that literal as a wildcard
    last = F.size(merged) - F.array_position(F.transform(F.reverse(merged), lambda s: s != WILD), True)
    node = F.transform(merged, lambda s, i: F.when(F.exists(merged, lambda x: x != WILD) & (i == last), F.lit(WILD)).otherwise(s))
    now = b.groupBy("host", "merged").agg(F.sum("labelled").alias("t_labelled"), F.sum("blocked").alias("t_blocked")).withColumn("node", node)
    nodes = now.groupBy("host", "node").agg(F.sum("t_labelled").alias("node_labelled"), F.sum("t_blocked").alias("node_blocked"))
    own_n, own_b = F.col("t_labelled"), F.col("t_blocked")
    rest_n, rest_b = F.col("node_labelled") - own_n, F.col("node_blocked") - own_b
    pooled = F.col("node_blocked") / F.col("node_labelled")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / own_n + 1 / rest_n))
    tellable = (own_n >= least_labelled) & (rest_n >= least_labelled)
    # F.when guards the divisions: ANSI mode has no division by zero
    alike = F.when(tellable, F.abs(own_b / own_n - rest_b / rest_n) <= z * spread).otherwise(False)
    step = now.join(nodes, ["host", "node"]).select("host", "merged", F.when(alike, F.col("node")).otherwise(merged).alias("up"))
    return b.join(step, ["host", "merged"]).drop("merged").withColumnRenamed("up", "merged")
