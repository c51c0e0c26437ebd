"""Report-only accessibility detectors: findings, never edits.

Each detector gives (page_id, rule_id, pre, summary, detail); ``findings`` unions
the enabled ones. Rules are data: only rules present in the rule table run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeloom.functions import text as fx
from nodeloom.operators.shred import elements
from nodeloom.operators.tables import features, previous_heading

#: Characters of a context; addresses, links and sources are kept whole.
PREVIEW = 240


def _finding(df: DataFrame, rule: str, summary: Column, detail: Column) -> DataFrame:
    return df.select("page_id", F.lit(rule).alias("rule_id"), "pre", summary.alias("summary"), detail.alias("detail"))


def links(nodes: DataFrame) -> DataFrame:
    """page_id, pre, href, label of every link."""
    return elements(nodes, "a").select("page_id", "pre", "post_end", "parent", F.coalesce(F.col("attrs")["href"], F.lit("")).alias("href"), F.coalesce("text", F.lit("")).alias("label"))


def caption_missing(nodes: DataFrame, outline: DataFrame | None = None) -> DataFrame:
    any_heading = previous_heading(nodes if outline is None else outline, ("h1", "h2", "h3", "h4", "h5", "h6"), blank=True)
    f = features(nodes).join(any_heading, ["page_id", "table"], "left").withColumn("pre", F.col("table"))
    return _finding(f.where("captions = 0 or caption_blank"), "HTML-R-15", F.lit("caption missing"), F.substring(F.coalesce("heading", F.lit("")), 1, 80))


def merged_cells(nodes: DataFrame) -> DataFrame:
    return _finding(features(nodes).where("merged > 0").withColumn("pre", F.col("table")), "HTML-R-16", F.lit("merged cells"), F.lit(""))


def vague_links(nodes: DataFrame) -> DataFrame:
    found = links(nodes).where((F.col("href") != "") & F.lower(F.trim("label")).isin(*fx.VAGUE_LINKS))
    parents = nodes.where("kind = 'element'").select("page_id", F.col("pre").alias("parent"), F.substring("brief", 1, PREVIEW).alias("context"))
    return _finding(found.join(parents, ["page_id", "parent"], "left"), "LINK-R-02", F.col("label"), F.coalesce("context", F.lit("")))


def mail_labels(nodes: DataFrame) -> DataFrame:
    """mailto links whose label is the address itself."""
    address = F.regexp_extract("label", fx.EMAIL, 0)
    own = F.when(address != "", address).otherwise(F.regexp_extract("href", r"(?i)^mailto:([^?]*)", 1))
    return _finding(links(nodes).where(F.lower("href").startswith("mailto:") & (F.trim("label") == own) & (own != "")), "LINK-R-04", F.lit("mail label"), own)


def raw_addresses(nodes: DataFrame) -> DataFrame:
    """Addresses in running text: text nodes whose parent is an element other than a link."""
    texts = nodes.where("kind = 'text' and parent is not null and parent_tag <> 'a'").withColumn("address", F.explode(F.regexp_extract_all("text", F.lit(fx.EMAIL), F.lit(0))))
    return _finding(texts, "LINK-R-04", F.lit("raw address"), F.col("address"))


def in_page_links(nodes: DataFrame) -> DataFrame:
    ids = nodes.where("kind = 'element' and attrs['id'] is not null").select("page_id", F.col("attrs")["id"].alias("fragment")).distinct().withColumn("there", F.lit(True))
    found = links(nodes).where("length(href) > 1 and href like '#%'").withColumn("fragment", F.expr("substring(href, 2)"))
    return _finding(found.join(ids, ["page_id", "fragment"], "left"), "LINK-R-09", F.when(F.coalesce("there", F.lit(False)), "target_exists").otherwise("target_missing"), F.col("href"))


def cross_page_links(nodes: DataFrame, base_url: str = "") -> DataFrame:
    host, path = fx.url_host(F.col("href")), fx.url_path(F.col("href"))
    other = (fx.url_fragment(F.col("href")) != "") & ~F.col("href").startswith("#") & ((host != "") | (path != "")) & (path != fx.url_path(F.lit(base_url)))
    return _finding(links(nodes).where(other), "LINK-R-08", F.lit("cross-page fragment"), F.col("href"))


def linked_images(nodes: DataFrame) -> DataFrame:
    imgs = elements(nodes, "img").where("a_pre is not null")
    return _finding(imgs, "IMG-R-05", F.coalesce(F.col("attrs")["alt"], F.lit("")), F.coalesce(F.col("attrs")["src"], F.lit("")))


def zoom_links(nodes: DataFrame) -> DataFrame:
    imgs = elements(nodes, "img").where("a_pre is not null").select("page_id", "pre", F.col("a_pre"))
    found = imgs.join(links(nodes).select("page_id", F.col("pre").alias("a_pre"), "href"), ["page_id", "a_pre"]).where(fx.url_path(F.col("href")).rlike(fx.IMAGE_LINK))
    return _finding(found, "IMG-R-09", F.lit("zoom link"), F.col("href"))


DETECTORS = {
    "HTML-R-15": (caption_missing,), "HTML-R-16": (merged_cells,), "LINK-R-02": (vague_links,), "LINK-R-04": (mail_labels, raw_addresses), "LINK-R-09": (in_page_links,),
    "LINK-R-08": (cross_page_links,), "IMG-R-05": (linked_images,), "IMG-R-09": (zoom_links,),
}


def findings(nodes: DataFrame, rules=tuple(DETECTORS)) -> DataFrame:
    """Findings of all enabled rules. Repeated rule ids are an error."""
    if len(set(rules)) < len(tuple(rules)):
        raise ValueError("duplicate rule ids")
    parts = [f(nodes) for r in rules for f in DETECTORS.get(r, ())]
    out = parts[0] if parts else caption_missing(nodes).limit(0)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def per_rule(found: DataFrame) -> DataFrame:
    """rule_id (null for the total), n."""
    return found.rollup("rule_id").agg(F.count("*").alias("n"))
