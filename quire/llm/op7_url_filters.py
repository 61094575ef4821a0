"""URL filters, DataFrame operations only: fixed rules, then a path-template
tree that learns from the pages that the rules decide.

1. Each url gives host and path. A rule fits its host and all subdomains if
   the path starts with the rule's path; the longest fitting rule wins.
2. *Wildcards.* Per host, runs of digits in a path segment become ``{n}``;
   a node with more than ``max_children`` distinct children, none of which has
   a tenth of its pages, has variable children, which become ``*``, however
   often their pages were crawled. Segments beyond ``depth`` are one segment.
3. *Merging.* Children of a node are compared by structure first: what mostly
   follows them (nothing, a number, a word) and how deep their pages go.
   Children of one structure whose share of blocked pages does not differ
   significantly from theirs together (|z| under ``z_merge``) become one branch,
   and children without labelled pages join the branch of their structure.
4. *Purity.* A share of blocked pages is smoothed towards that of the group of
   like children that it belongs to, level by level up to the host's, and that
   towards the share of all labelled pages (one half at most, so a host without
   labels is never rejected). Templates at or over ``reject`` are rejected:
   pages that no rule decides take the verdict of their template, that is of the
   labelled pages of like structure beside them before that of their host.

Everything is an aggregation over templates: pages are counted per (host,
template) first, so a host with a third of all pages is small before any
shuffle by host.

Nulls and edge cases: a null url, or one without ``://``, has empty host and
path, fits no rule and is a template of its own like any other. Repeated
rows count as often as they occur. Null page ids are judged like others. An
empty table gives an empty result; without labelled pages nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, column, scratch, table

#: Verdict, host and path prefix of each rule.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DEPTH, MAX_CHILDREN, Z_MERGE, PRIOR, REJECT = 4, 30, 2.0, 5.0, 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to / ? # or the end, lower-cased (A-Z); and
    from there up to ? # or the end. Both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, as host + path, and its verdict; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):   # the longest is tested first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def segments(path: Column, depth: int) -> Column:
    """Path segments with runs of digits generalised; what lies beyond
    ``depth`` is joined into the last."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "{n}"), "/")
    head, tail = F.slice(parts, 1, depth - 1), F.slice(parts, depth, F.lit(1 << 20))
    return F.when(F.size(parts) < depth, parts).otherwise(F.concat(head, F.array(F.concat_ws("/", tail))))


def template_tree(counts: DataFrame, depth: int = DEPTH, max_children: int = MAX_CHILDREN, z_merge: float = Z_MERGE,
                  prior: float = PRIOR) -> DataFrame:
    """``host, segs, template, purity, evidence`` for ``host, segs, n,
    labelled, bad`` (one row for each distinct pair of host and segments);
    ``evidence``: labelled pages of the template, or of the
    deepest group of like branches on its way that has any."""
    whole = counts.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(0.0))).first()[0]
    whole = min(whole or 0.0, 0.5)             # a host without labelled pages is not rejected for other hosts

    def smooth(bad: Column, labelled: Column, towards: Column) -> Column:
        return (bad + prior * towards) / (labelled + prior)
    hosts = counts.groupBy("host").agg(smooth(F.sum("bad"), F.sum("labelled"), F.lit(whole)).alias("belief"), F.sum("labelled").alias("near"))
    cur = counts.join(broadcast_if_small(hosts), "host").withColumn("node", F.lit("")).withColumn("near", F.lit(0).cast("bigint"))
    for d in range(depth):
        seg, after = F.get("segs", F.lit(d)), F.get("segs", F.lit(d + 1))
        kids = cur.where(seg.isNotNull()).groupBy("host", "node", "belief", seg.alias("kid")).agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"),
            F.sum(F.when(after.isNull(), F.col("n")).otherwise(0)).alias("ends"),
            F.sum(F.when(after.contains("{n}"), F.col("n")).otherwise(0)).alias("numbers"),
            F.sum(F.col("n") * (F.size("segs") - d)).alias("levels"))
        follows = F.when(F.col("ends") * 2 >= F.col("n"), ".").when(F.col("numbers") * 2 >= F.col("n"), "{n}").otherwise("w")
        depth_of = F.call_function("div", F.col("levels") * 2 + F.col("n"), F.col("n") * 2).cast("string")     # rounded
        kids = scratch(kids.withColumn("like", F.concat(follows, depth_of)))
        nodes = kids.groupBy("host", "node").agg(
            F.count(F.lit(1)).alias("n_kids"), F.sum("n").alias("pages"), F.max("n").alias("top"),
            F.sum("labelled").alias("nl"), F.sum("bad").alias("nb"))
        groups = kids.groupBy("host", "node", "like").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        p = F.col("b") / F.nullif("l", F.lit(0))
        spread = F.sqrt(F.col("labelled") * p * (1 - p))
        z = (F.col("bad") - F.col("labelled") * p) / F.nullif(spread, F.lit(0.0))
        variable = (F.col("n_kids") > max_children) & (F.col("top") * 10 < F.col("pages"))
        alike = (F.col("labelled") == 0) | (F.coalesce(F.abs(z), F.lit(0.0)) < z_merge)
        group = smooth(F.col("b"), F.col("l"), F.col("belief"))
        named = kids.join(nodes, ["host", "node"]).join(groups, ["host", "node", "like"]).select(
            F.col("host").alias("_h"), F.col("node").alias("_n"), F.col("kid").alias("_k"),
            F.when(variable, F.lit("*")).when(alike, F.concat(F.lit("{like "), "like", F.lit("}"))).otherwise(F.col("kid")).alias("_name"),
            F.when(variable, smooth(F.col("nb"), F.col("nl"), F.col("belief"))).when(alike, group)
            .otherwise(smooth(F.col("bad"), F.col("labelled"), group)).alias("_belief"),
            F.when(variable, F.col("nl")).otherwise(F.col("l")).alias("_near"))
        cur = cur.join(named, (F.col("host") == F.col("_h")) & (F.col("node") == F.col("_n")) & (seg == F.col("_k")), "left").select(
            "host", "segs", "n", "labelled", "bad", F.coalesce("_belief", "belief").alias("belief"),
            F.when(F.col("_near") > 0, F.col("_near")).otherwise(F.col("near")).alias("near"),
            F.when(F.col("_name").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), F.col("_name"))).alias("node"))
        cur = scratch(cur)
    templates = cur.groupBy("host", "node", "belief").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l"), F.max("near").alias("m")).select(
        F.col("host").alias("_h"), F.col("node").alias("_n"), F.col("belief").alias("_b"),
        smooth(F.col("b"), F.col("l"), F.col("belief")).alias("purity"), F.greatest("l", "m").alias("evidence"))
    return cur.join(templates, (F.col("host") == F.col("_h")) & (F.col("node") == F.col("_n")) & (F.col("belief") == F.col("_b"))).select(
        "host", "segs", F.col("node").alias("template"), "purity", "evidence")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, reject: float = REJECT,
               depth: int = DEPTH, **options) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity, evidence`` of each
    row."""
    host, path = host_and_path(F.col("_url"))
    src = pages.select(column(id_col).alias("page_id"), column(url_col).alias("_url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    src = src.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), segments(F.col("path"), depth).alias("segs"))
    counts = scratch(src.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("bad")))
    tree = template_tree(counts, depth, **options).select(
        F.col("host").alias("_h"), F.col("segs").alias("_s"), "template", "purity", "evidence")
    judged = src.join(broadcast_if_small(scratch(tree)), (F.col("host") == F.col("_h")) & (F.col("segs") == F.col("_s")))
    return judged.select("page_id", "host", "path", "rule", F.coalesce(
        "ruled", F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "template", "purity", "evidence")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return judge_urls(table(spark, sf_dir, "pages"))
