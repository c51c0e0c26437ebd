"""Quality audit of output pages: issues with severity, table metrics, repeated noise, verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeloom.functions import text as fx
from nodeloom.operators.detect import links
from nodeloom.operators.shred import elements, visible
from nodeloom.operators.tables import features, members, scope

SEVERITIES = ("Critical", "High", "Medium")
SIZE_LIMIT = 500_000
#: Closing tags that were escaped or never existed (fixed value).
FRAGMENT = r"(?iU)&lt;\s*/\s*(?:tr|td|th|table)\s*&gt;|</\s*(?:row|cell)\s*>"
#: Sources of images that decorate (fixed value).
ICONS = "(?i)icon|ico|pdf|external|blank|arrow"
#: What to do about each rule, in our words.
SUGGESTIONS = {
    "OUT-TABLE-001": "write table, tr, td and th", "OUT-TABLE-002": "look at how table fragments are cut and put back", "OUT-TABLE-003": "give the table a caption that names its purpose", "OUT-TABLE-004": "mark head cells as th with a scope",
    "OUT-TABLE-005": "look for HTML that was inserted as text", "OUT-TABLE-006": "say what the table shows", "OUT-TABLE-007": "look for lost cells and wrong spans", "OUT-EXTRACT-001": "narrow the extracted part of the page",
    "OUT-CMS-001": "drop the CMS parts", "OUT-CMS-002": "drop repeated navigation", "OUT-ENC-001": "read the page in its own encoding", "OUT-ALT-001": "leave the alt of decoration empty", "OUT-LINK-001": "say where the link leads", "OUT-SIZE-001": "look for repeated parts",
}


def _issue(df: DataFrame, rule: str, severity: str, message: Column) -> DataFrame:
    line = F.col("line") if "line" in df.columns else F.lit(None).cast("int")
    return df.select("page_id", F.lit(severity).alias("severity"), F.lit(rule).alias("rule_id"), line.alias("line"), message.alias("message"))


def table_issues(nodes: DataFrame) -> DataFrame:
    """Issues of tables. A th without a scope counts for each table around it, as do rows for the widths of a table."""
    f = features(nodes)
    out = _issue(elements(nodes, "row", "cell"), "OUT-TABLE-001", "Critical", F.col("tag"))
    out = out.unionByName(_issue(elements(nodes, "tr", "td", "th").where(F.size("tables") == 0), "OUT-TABLE-002", "Critical", F.col("tag")))
    # one pass over the tables: each gives the issues that hold
    found = lambda rule, severity, holds, message, line: F.when(holds, F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule_id"), line.alias("line"), message.alias("message")))
    own = F.col("line")
    per_table = F.array(
        found("OUT-TABLE-003", "High", F.col("captions") == 0, F.lit("no caption"), own),
        found("OUT-TABLE-006", "High", fx.strip(F.coalesce("caption", F.lit(""))).isin(*fx.GENERIC_CAPTIONS), F.col("caption"), F.col("caption_line")),
        found("OUT-TABLE-004", "Medium", F.col("n_th") == 0, F.lit("no th"), own),
        found("OUT-TABLE-007", "High", ragged(), F.lit("ragged"), own),
    )
    out = out.unionByName(f.select("page_id", F.explode(F.filter(per_table, lambda x: x.isNotNull())).alias("i")).select("page_id", "i.severity", "i.rule_id", "i.line", "i.message"))
    bare = members(nodes.where((F.col("tag") == "th") & (scope() == "")))
    return out.unionByName(_issue(bare, "OUT-TABLE-004", "Medium", F.lit("th without scope")))


def ragged() -> Column:
    """Of features: three rows or more whose numbers of own cells differ by three or more; rows without cells count."""
    return (F.col("n_tr") >= 3) & (F.col("widest") - F.col("narrowest") >= 3)


def escaped_fragments(pages: DataFrame) -> DataFrame:
    """Escaped or pseudo closing tags in the raw text, with their lines."""
    found = pages.where(F.col("html").rlike(FRAGMENT)).select("page_id", F.explode(fx.lines_of(F.col("html"), F.lit(FRAGMENT))).alias("line"))
    return _issue(found, "OUT-TABLE-005", "Critical", F.lit("broken closing fragment"))


def phrase_counts(docs: DataFrame, id_column: str, text_column: str, phrases: dict[str, tuple[str, ...]]) -> DataFrame:
    """id, rule_id, phrase, n of each phrase that occurs: the pattern list is a literal table, so texts are read once and not joined."""
    table = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(p).alias("phrase")) for r, ps in phrases.items() for p in ps])
    text = F.coalesce(F.col(text_column), F.lit(""))
    n = lambda p: ((F.length(text) - F.length(F.replace(text, p, F.lit("")))) / F.length(p)).cast("long")
    counted = F.filter(F.transform(table, lambda p: F.struct(p["rule_id"].alias("rule_id"), p["phrase"].alias("phrase"), n(p["phrase"]).alias("n"))), lambda p: p["n"] > 0)
    return docs.select(id_column, F.explode(counted).alias("p")).select(id_column, "p.rule_id", "p.phrase", "p.n")


def text_issues(pages: DataFrame) -> DataFrame:
    """One issue with its line for each occurrence of a non-body or CMS phrase, and of damaged encoding; five back links are one more."""
    lists = {"OUT-EXTRACT-001": fx.NON_BODY, "OUT-CMS-001": fx.CMS_PHRASES, "OUT-ENC-001": ("���", "�")}
    table = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(p).alias("phrase")) for r, ps in lists.items() for p in ps])
    there = pages.where(F.col("html").isNotNull()).select("page_id", "html", F.explode(F.filter(table, lambda p: F.contains(F.col("html"), p["phrase"]))).alias("p"))
    each = there.select("page_id", F.lit("High").alias("severity"), "p.rule_id", F.explode(fx.lines_of(F.col("html"), fx.quoted(F.col("p.phrase")))).alias("line"), F.col("p.phrase").alias("message"))
    back = back_links(pages).where("n >= 5")
    return each.unionByName(_issue(back, "OUT-CMS-002", "High", F.concat(F.lit("back links: "), F.col("n").cast("string"))))


def back_links(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.regexp_count(F.coalesce("html", F.lit("")), F.lit("先頭に(?:もどる|戻る)")).cast("long").alias("n"))


def alt_issues(nodes: DataFrame) -> DataFrame:
    """Images of decoration, or any, that say too much: an alt of 20 characters, or any alt on an icon."""
    alt, src = F.coalesce(F.col("attrs")["alt"], F.lit("")), F.coalesce(F.col("attrs")["src"], F.lit(""))
    return _issue(elements(nodes, "img").where((alt != "") & ((F.length(alt) >= 20) | src.rlike(ICONS))), "OUT-ALT-001", "Medium", alt)


def link_issues(nodes: DataFrame) -> DataFrame:
    label = fx.strip(F.col("label"))
    lined = links(nodes).join(elements(nodes, "a").select("page_id", "pre", "line"), ["page_id", "pre"])
    return _issue(lined.where(label.isin(*fx.AUDIT_VAGUE_LINKS) | label.rlike(r"(?U)^https?://\S+$")), "OUT-LINK-001", "Medium", label)


def size_issues(pages: DataFrame, limit: int = SIZE_LIMIT) -> DataFrame:
    return _issue(pages.where(F.octet_length("html") > limit), "OUT-SIZE-001", "Medium", F.octet_length("html").cast("string"))


def audit(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """All issues of pages and their nodes."""
    out = table_issues(nodes)
    for part in (escaped_fragments(pages), text_issues(pages), alt_issues(nodes), link_issues(nodes), size_issues(pages)):
        out = out.unionByName(part)
    return out


def table_metrics(nodes: DataFrame) -> DataFrame:
    """page_id, tables, with_caption, with_thead, with_th, unscoped_th, ragged."""
    n = lambda c: F.sum(c.cast("long"))
    return features(nodes).groupBy("page_id").agg(F.count("*").alias("tables"), n(F.col("captions") > 0).alias("with_caption"), n(F.col("theads") > 0).alias("with_thead"), n(F.col("n_th") > 0).alias("with_th"), F.sum("bare_th").alias("unscoped_th"), n(ragged()).alias("ragged"))


def verdict(issues: DataFrame) -> DataFrame:
    """page_id (null for the total), Critical, High, Medium, verdict."""
    count = [F.sum((F.col("severity") == s).cast("long")).alias(s) for s in SEVERITIES]
    return issues.rollup("page_id").agg(*count).withColumn("verdict", F.when(F.col("Critical") + F.col("High") > 0, "FAIL").otherwise("PASS"))


def rank() -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity")).cast("int")


def report_order(issues: DataFrame) -> DataFrame:
    """Issues in the order of the report: severity, page, line (none first), rule."""
    return issues.orderBy(rank(), "page_id", F.coalesce("line", F.lit(0)), "rule_id", "message")


def report(issues: DataFrame, pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """file, severity, rule_id, line, message, snippet (the line, 240 characters), suggestion: the rows of the audit report.

    names: page_id, file; without it the file is the page's id.
    """
    table = F.create_map(*[F.lit(x) for kv in SUGGESTIONS.items() for x in kv])
    whole = issues.join(pages.select("page_id", "html"), "page_id", "left")
    line = F.substring(fx.strip(F.coalesce(F.get(F.split("html", r"\r\n|\n|\r"), F.col("line") - 1), F.lit(""))), 1, 240)
    whole = whole.join(names, "page_id", "left") if names is not None else whole.withColumn("file", F.col("page_id").cast("string"))
    return whole.select("file", "severity", "rule_id", "line", "message", F.when(F.col("line").isNotNull(), line).otherwise(F.substring(fx.collapse(F.col("message")), 1, 240)).alias("snippet"), F.coalesce(table[F.col("rule_id")], F.lit("")).alias("suggestion"))


def repeated_noise(pages: DataFrame, nodes: DataFrame, least: int = 2) -> DataFrame:
    """page_id, noise, n: what the audit counts and finds at least so often on a page: back links from five on, and one alt (40 characters) of icons."""
    alts = alt_issues(nodes).groupBy("page_id", F.concat(F.lit("icon_alt:"), F.substring("message", 1, 40)).alias("noise")).agg(F.count("*").alias("n"))
    back = back_links(pages).where("n >= 5").select("page_id", F.lit("back_links").alias("noise"), "n")
    return alts.unionByName(back).where(F.col("n") >= least)


def repeated_texts(nodes: DataFrame, least: int = 2) -> DataFrame:
    """page_id, noise, n: visible texts that occur at least so often on a page."""
    return visible(nodes).groupBy("page_id", fx.collapse(F.col("text")).alias("noise")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
