"""URL filters: written rules, and for all other urls a tree of path templates learned per host.

Template tree. A node holds pages of one host whose paths begin alike. While the labels of a node's pages that go on hold
both kinds and at least ``2 * MIN_ROWS`` pages, it is split at the first segment where one of its values is worth a
branch of its own: at least ``MIN_ROWS`` pages of those that reach the segment, but not all, and either ``MIN_SHARE`` of
them or a labelled share that differs significantly from that of the others. Other values of that segment become ``*``.
Segments before it stay as they are where all pages agree and become ``*`` elsewhere. Where the labels give no reason to
split, all further segments become ``*``, or stay where all pages of a node with labels of both kinds agree. Leaves under
the same split whose labelled shares do not differ significantly are merged: they are ordered by share, and a new branch
starts where two neighbours fail a two-proportion test. A branch is rejected when its labelled purity, smoothed towards
the share over all labelled pages, reaches ``REJECT``.

All segments of a node are counted in one grouped aggregate, so there are as many rounds as splits lie inside each other,
however deep the paths are. Everything is a column expression, a grouped aggregate or an equi-join; hot hosts are
pre-aggregated on the map side, and the joins back to the pages are plain shuffle joins that adaptive execution splits
when a host is hot.

Defined cases: a null url or one without ``://`` has empty host and path and belongs to the host ``""``; a host without
labelled pages gets the overall share; repeated rows are judged one by one; an empty table gives no rows; further
columns are ignored, whatever their names; empty segments (``//``) do not count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, stored

MIN_ROWS = 5
MIN_SHARE = 0.01
Z = 1.96
WEIGHT = 10.0
REJECT = 0.5

SPLIT_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path, like ``example.net/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        here = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return here & F.startswith(path, F.lit(self.path))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty where there is no ``://``."""
    whole = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(whole, SPLIT_URL, 1)), F.regexp_extract(whole, SPLIT_URL, 2)


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fitting = [F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    best = F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")
    return best["rule"], best["verdict"]


def stands_out() -> Column:
    """Whether the labelled share of a child (``_seen``, ``_bad``) differs from that of the rest of its parent."""
    seen, bad, rest_seen, rest_bad = F.col("_seen"), F.col("_bad"), F.col("_all_seen") - F.col("_seen"), F.col("_all_bad") - F.col("_bad")
    pooled = F.try_divide(F.col("_all_bad"), F.col("_all_seen"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), seen) + F.try_divide(F.lit(1), rest_seen)))
    differs = F.abs(F.try_divide(bad, seen) - F.try_divide(rest_bad, rest_seen)) > Z * spread
    return F.coalesce((seen >= MIN_ROWS) & differs, F.lit(False))


NODE = ["host", "template"]


def label_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.count("bad").alias("_seen"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("_bad")]


def split_nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round. Input: pages with ``host``, ``template`` (their node), ``_segments``, ``_at`` (segments the template
    has) and ``bad``. Output: per node that has labels to split by, the segment to split at (``_split``, counted from 1;
    null: none) and for each further segment whether all pages agree (``_common``); and the values that stay (``_value``
    at ``_split``)."""
    mixed = (rows.where(F.col("_at") < F.size("_segments")).groupBy(*NODE).agg(*label_counts())
             .where((F.col("_seen") >= 2 * MIN_ROWS) & (F.col("_bad") > 0) & (F.col("_bad") < F.col("_seen"))).select(*NODE))
    further = F.slice("_segments", F.col("_at") + 1, F.greatest(F.size("_segments") - F.col("_at"), F.lit(0)))
    values = (rows.join(mixed, NODE, "left_semi").select(*NODE, "bad", "_at", F.posexplode(further).alias("_from", "_value"))
              .withColumn("_place", F.col("_from") + F.col("_at") + 1)
              .groupBy(*NODE, "_place", "_value").agg(*label_counts()))
    place = [*NODE, "_place"]
    totals = values.groupBy(*place).agg(F.sum("_n").alias("_all"), F.sum("_seen").alias("_all_seen"), F.sum("_bad").alias("_all_bad"))
    frequent = values.where(F.col("_n") >= MIN_ROWS).join(totals, place)
    own = (F.col("_n") < F.col("_all")) & ((F.col("_n") >= MIN_SHARE * F.col("_all")) | stands_out())
    literal = frequent.where(own).select(*place, "_value")
    agreed = values.groupBy(*place).agg(F.count(F.lit(1)).alias("_values")).select(*place, (F.col("_values") == 1).alias("_agreed"))
    splits = literal.groupBy(*NODE).agg(F.min("_place").alias("_split"))
    # one entry per segment of the node's longest path
    common = agreed.groupBy(*NODE).agg(F.sort_array(F.collect_list(F.struct("_place", "_agreed"))).alias("_places"))
    nodes = common.join(splits, NODE, "left").select(*NODE, "_split", F.transform("_places", lambda x: x["_agreed"]).alias("_common"))
    return nodes, literal.withColumnRenamed("_place", "_split")


def templated(urls: DataFrame) -> DataFrame:
    """``urls`` (page_id, host, path, bad) with ``template`` and ``parent``, the node whose last split made the leaf."""
    columns = [*urls.columns, "template", "parent"]
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = urls.withColumns({"_segments": segments, "_at": F.lit(0), "template": F.lit(""), "parent": F.lit(None).cast("string")})
    done = []
    while True:
        nodes, literal = split_nodes(rows)
        nodes, literal = stored(nodes, "url-nodes"), stored(literal, "url-values")
        at, length = F.col("_at"), F.size("_segments")
        value = F.get("_segments", F.col("_split") - 1)
        seen = rows.join(nodes, NODE, "left").withColumn("_value", value)
        seen = seen.join(literal.withColumn("_stays", F.lit(True)), [*NODE, "_split", "_value"], "left")
        ahead = F.slice("_segments", at + 1, F.greatest(F.least(length, F.coalesce(F.col("_split") - 1, length)) - at, F.lit(0)))
        shown = F.transform(ahead, lambda s, i: F.when(F.get("_common", i), s).otherwise("*"))
        branch = F.when(F.col("_value").isNotNull(), F.array(F.when(F.col("_stays"), F.col("_value")).otherwise("*")))
        added = F.concat(shown, F.coalesce(branch, F.array().cast("array<string>")))
        parts = F.transform(added, lambda s: F.concat(F.lit("/"), s))
        seen = seen.select(
            *urls.columns, F.concat("template", F.array_join(parts, "")).alias("template"),
            F.when(F.col("_value").isNotNull(), F.concat("template", F.lit("#"), F.col("_split"))).otherwise(F.col("parent")).alias("parent"),
            "_segments", F.coalesce(F.when(F.col("_value").isNotNull(), F.col("_split")), length).alias("_at"))
        seen = stored(seen, "url-round")
        further = F.col("_at") < F.size("_segments")
        done.append(seen.where(~further).select(*columns))
        rows = seen.where(further)
        if rows.isEmpty():
            break
    out = reduce(DataFrame.unionByName, done)
    return out.withColumns({"template": F.when(F.col("template") == "", "/").otherwise(F.col("template")),
                            "parent": F.coalesce("parent", F.lit(""))})


def template_purity(pages: DataFrame) -> DataFrame:
    """Branches of the tree: ``host``, ``parent``, ``template``, ``branch`` (its number among the leaves of its parent),
    labelled ``seen`` and ``bad`` of the branch, smoothed ``purity``. Input: ``host``, ``parent``, ``template`` and
    ``bad`` (null: no label)."""
    leaves = pages.groupBy("host", "parent", "template").agg(
        F.count("bad").alias("seen"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
    overall = leaves.agg((F.sum("bad") / (F.sum("seen") + 1)).alias("base"))
    leaves = leaves.join(F.broadcast(overall))  # one row
    leaves = leaves.withColumn("share", (F.col("bad") + WEIGHT * F.col("base")) / (F.col("seen") + WEIGHT))
    siblings = Window.partitionBy("host", "parent").orderBy("share", "template")
    seen, bad = F.col("seen") + 1, F.col("bad") + F.col("base")
    before_seen, before_bad = F.lag(seen).over(siblings), F.lag(bad).over(siblings)
    pooled = (bad + before_bad) / (seen + before_seen)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / seen + 1 / before_seen))
    differs = F.abs(bad / seen - before_bad / before_seen) > Z * spread
    branch = F.sum(F.coalesce(differs.cast("int"), F.lit(0))).over(siblings)
    leaves = leaves.withColumn("branch", branch)
    merged = leaves.groupBy("host", "parent", "branch").agg(
        F.sum("seen").alias("seen"), F.sum("bad").alias("bad"), F.first("base").alias("base"))
    merged = merged.withColumn("purity", (F.col("bad") + WEIGHT * F.col("base")) / (F.col("seen") + WEIGHT)).drop("base")
    return leaves.select("host", "parent", "template", "branch").join(merged, ["host", "parent", "branch"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               bad_col: str | None = None) -> DataFrame:
    """Per page: id, host, path, rule (null: none fits), verdict, template, purity. ``bad_col`` holds labels: true for
    pages that should go, null for unlabelled ones."""
    host, path = url_parts(F.col(url_col))
    bad = F.col(bad_col).cast("boolean") if bad_col else F.lit(None).cast("boolean")
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), bad.alias("bad"))
    urls = templated(stored(parts, "url-parts"))
    branches = template_purity(urls).select("host", "parent", "template", "purity")
    judged = urls.drop("bad").join(branches, ["host", "parent", "template"], "left")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return judged.select(F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, learned).alias("verdict"), "template", "purity")


def labelled_pages(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Pages with ``bad`` from the labels of the document whose number ends the url's path: low quality or toxic."""
    _, path = url_parts(F.col(url_col))
    digits = F.regexp_extract(path, r"([0-9]+)[^0-9]*$", 1)
    judged = labels.groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    numbered = pages.select(F.col(id_col), F.col(url_col), digits.try_cast("bigint").alias("_doc"))
    return numbered.join(judged.withColumnRenamed("doc_id", "_doc"), "_doc", "left").drop("_doc")
