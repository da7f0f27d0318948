"""URL verdicts from host and path rules, spread to aliases over redirect and canonical-link edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import store
from wardline.llm.components import components

# (verdict, host, path)
Rule = tuple[str, str, str]

LINK_TAG = r"(?i)<link\b[^>]*>"
REFRESH_TAG = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
BASE_TAG = r"(?i)<base\b[^>]*>"
REFRESH_TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"
CANONICAL = r"(?i)(^|\s)canonical(\s|$)"
# A scheme of its own: such a target is not relative.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
# Fixed value: the ways an ampersand is written in an attribute.
AMPERSANDS = "&(amp|#38|#x26);"


def attribute(name: str) -> str:
    """Pattern of an attribute's value in a tag; one of its three groups holds it."""
    return rf"""(?i)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _value(tag: Column, name: str) -> Column:
    return F.concat(*[F.regexp_extract(tag, attribute(name), k) for k in (1, 2, 3)])


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """What identifies a page: host, path and query, without scheme and fragment. Null without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.concat(host_of(url), rest))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule], of: int) -> Column:
    """Of the longest rule that fits: its text (of=1) or verdict (of=0); null if none fits.

    Of rules of the same length an allowing one goes first, then the smaller text.
    """
    out = F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(
        rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1] + r[2]), reverse=True
    ):
        fits = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        text = (verdict, rule_host + rule_path)[of]
        out = F.when(fits & F.startswith(path, F.lit(rule_path)), F.lit(text)).otherwise(out)
    return out


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    # A dot segment at the end stands for a folder.
    closed = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)

    def step(acc: Column, s: Column) -> Column:
        up = F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
        return F.when(s == ".", acc).when(s == "..", up).otherwise(F.array_append(acc, s))

    left = F.aggregate(F.slice(closed, F.lit(2), F.size(closed)), F.array(F.get(parts, F.lit(0))), step)
    return F.array_join(left, "/")


def absolute(target: Column, base: Column) -> Column:
    """A link's target as seen from the page ``base``, as the URL standard resolves it; null without a target."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, r"(?s)^.*?://([^/?#]*)", 1))
    path = F.concat(F.lit("/"), F.regexp_replace(path_of(base), "^/", ""))
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    query = F.regexp_extract(base, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)", 1)
    return (
        F.when(F.coalesce(target, F.lit("")) == "", None)
        .when(F.rlike(target, F.lit(SCHEME)), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, without_dots(own), rest))
        .when(F.startswith(target, F.lit("?")), F.concat(root, path, target))
        .when(F.startswith(target, F.lit("#")), F.concat(root, path, query, target))
        .otherwise(F.concat(root, without_dots(F.concat(folder, own)), rest))
    )


def _decoded(target: Column) -> Column:
    return F.trim(F.regexp_replace(target, AMPERSANDS, "&"))


def link_edges(pages: DataFrame) -> DataFrame:
    """url, target: all canonical links and refresh redirects in the pages' HTML, seen from the page's ``base`` element if it has one."""
    html = F.coalesce("html", F.lit(""))
    links = F.filter(F.regexp_extract_all(html, F.lit(LINK_TAG), F.lit(0)), lambda t: F.rlike(_value(t, "rel"), F.lit(CANONICAL)))
    moved = F.transform(F.regexp_extract_all(html, F.lit(REFRESH_TAG), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH_TARGET, 1))
    found = F.concat(F.transform(links, lambda t: _value(t, "href")), moved)
    shift = absolute(_decoded(_value(F.regexp_extract(html, BASE_TAG, 0), "href")), F.col("url"))
    rows = pages.where("url IS NOT NULL").select("url", F.coalesce(shift, "url").alias("_base"), F.explode(found).alias("_target"))
    rows = rows.select("url", "_base", _decoded(F.col("_target")).alias("_target")).where("_target <> ''")
    return rows.select("url", absolute(F.col("_target"), F.col("_base")).alias("target"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    A page with a fitting rule keeps that rule's verdict. Pages and link targets joined by
    canonical links, refresh redirects or rows of ``redirects`` (url, target) are aliases: a page
    without a rule is blocked if an alias is blocked by a rule and none is allowed by one, else allowed.
    A null url, or one without ``://``, has empty host and path, fits only rules for an empty host,
    and has no aliases. Null html has no links. Repeated rows stay; empty tables give no rows; other columns are not looked at.
    Aliases reach pages over a join on a stored table of the nodes that have links.
    """
    base = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    base = base.select(
        "page_id", "host", "path", node_of(F.col("url")).alias("_node"),
        fitting_rule(host, path, rules, 1).alias("rule"), fitting_rule(host, path, rules, 0).alias("_own"),
    )
    links = link_edges(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    url, target = F.col("url"), F.col("target")
    links = store(
        links.where(node_of(url).isNotNull() & node_of(target).isNotNull())
        .select(node_of(url).alias("url_node"), node_of(target).alias("target_node"), "url", "target")
        .where("url_node <> target_node").groupBy("url_node", "target_node")
        .agg(F.min("url").alias("url"), F.min("target").alias("target")),
        "links",
    )
    out = ["page_id", "host", "path", "rule"]
    if links.isEmpty():
        return base.select(*out, F.coalesce("_own", F.lit("allow")).alias("verdict"))
    groups = store(
        components(links.select(F.xxhash64("url_node").alias("a"), F.xxhash64("target_node").alias("b"))), "aliases"
    )
    ends = links.select(url, F.col("url_node").alias("node")).unionByName(
        links.select(target.alias("url"), F.col("target_node").alias("node"))
    )
    own = fitting_rule(host_of(url), path_of(url), rules, 0)
    nodes = store(
        ends.groupBy("node").agg(F.min("url").alias("url")).withColumn("own", own).withColumn("id", F.xxhash64("node"))
        .join(groups.withColumnRenamed("node", "id"), "id").select("node", "own", "component"),
        "alias-nodes",
    )
    groups = nodes.groupBy("component").agg(
        F.coalesce(F.bool_or(F.col("own") == "block"), F.lit(False)).alias("blocked"),
        F.coalesce(F.bool_or(F.col("own") == "allow"), F.lit(False)).alias("allowed"),
    )
    blocked = store(
        nodes.join(store(groups.where("blocked AND NOT allowed"), "alias-groups"), "component").select(F.col("node").alias("_node"), F.lit("block").alias("_alias")),
        "alias-blocks",
    )
    return base.join(blocked, "_node", "left").select(*out, F.coalesce("_own", "_alias", F.lit("allow")).alias("verdict"))
