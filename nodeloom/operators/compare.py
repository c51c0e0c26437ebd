"""Versions of a page side by side: metrics in long form and a verdict for each."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeloom.functions import text as fx
from nodeloom.operators.shred import elements, shred, visible

#: metric -> substring that is counted in the lower-cased raw text, and texts that are looked for as they are (fixed values).
SUBSTRINGS = {"h3_count": "<h3", "h4_count": "<h4", "table_count": "<table", "thead_count": "<thead", "caption_count": "<caption", "scope_col_count": 'scope="col"', "scope_row_count": 'scope="row"', "th_count": "<th", "rgb_fullwidth": "rgb（", "caption_id_count": 'id="caption'}
PHRASES = {"intro_text": "休日（日曜日または祝日）在宅当番医について", "doctor_info_text": "日曜・祝日在宅当番医情報", "consultation_hours_text": "診療時間", "update_line": "更新："}
#: Kinds of metrics, each with its verdict; the others are texts (fixed values).
KINDS = {
    "count": ("h3_count", "h4_count", "table_count"), "structure": ("thead_count", "caption_count", "scope_col_count", "scope_row_count", "th_count"),
    "absence": ("menu_present", "pagetop_present", "footer_present"), "increase": ("rgb_fullwidth", "caption_id_count", "caption_id_duplicates"),
}
#: Signs of menus and page-top links in ids, classes, targets and labels, and the texts that are nothing else (fixed values).
MENU, PAGETOP = r"(?:^|[-_#/:])menu(?:$|[-_#/:])", r"page[-_]?top|#top|to[-_]?top"
MENU_TEXTS, PAGETOP_TEXTS = ("menu", "メニュー"), ("pagetop", "page top", "ページトップ", "ページの先頭へ", "先頭へ戻る")


def _caption_ids(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit("(?i)id=[\"'](caption[^\"']*)[\"']"), F.lit(1))


def _raw_values(phrases: dict[str, str] = PHRASES) -> dict[str, Column]:
    """metric -> value of ``html``: substring counts whatever their case, 0 or 1 for phrases and a footer, ids of captions that are used again."""
    low = F.lower("html")
    out = {m: (F.length(low) - F.length(F.replace(low, F.lit(s), F.lit("")))) / len(s) for m, s in SUBSTRINGS.items()}
    out |= {m: F.contains("html", F.lit(p)) for m, p in phrases.items()}
    out |= {"footer_present": F.contains(low, F.lit("<footer")), "caption_id_duplicates": F.size(_caption_ids(F.col("html"))) - F.size(F.array_distinct(_caption_ids(F.col("html"))))}
    return {m: v.cast("long") for m, v in out.items()}


def _long(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """keys, metric, value of columns of values."""
    table = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()])
    return df.select(*keys, F.explode(table).alias("m")).select(*keys, "m.metric", "m.value")


def raw_metrics(pages: DataFrame, keys: list[str], phrases: dict[str, str] = PHRASES) -> DataFrame:
    """keys, metric, value of the metrics of the raw text."""
    return _long(pages.withColumn("html", F.coalesce("html", F.lit(""))), keys, _raw_values(phrases))


#: What common_parts reads of nodes, and of which.
PARTS, SIGNS = ("page_id", "kind", "tag", "attrs", "text", "up"), "signs"


def common_parts(nodes: DataFrame) -> DataFrame:
    """page_id, menu_present, pagetop_present, footer_present from ids, classes, targets, labels and the texts outside head, script, style and title."""
    element = F.col("kind") == "element"
    named = lambda pattern: reduce(or_, [F.coalesce(element & F.lower(F.trim(F.col("attrs")[a])).rlike(pattern), F.lit(False)) for a in ("id", "class", "href", "aria-label")])
    said = F.when((F.col("kind") == "text") & ~F.arrays_overlap("up", F.array(*map(F.lit, ("head", "script", "style", "title")))), F.lower(fx.collapse(F.col("text"))))
    any_ = lambda c: F.coalesce(F.max(c.cast("long")), F.lit(0))
    texts = lambda values: F.coalesce(F.col("said").isin(*values), F.lit(False))
    return nodes.withColumn("said", said).groupBy("page_id").agg(any_(named(MENU) | texts(MENU_TEXTS)).alias("menu_present"), any_(named(PAGETOP) | texts(PAGETOP_TEXTS)).alias("pagetop_present"), any_(F.coalesce(F.col("tag") == "footer", F.lit(False))).alias("footer_present"))


SPLITS = ("previous", "current", "gold")
#: All 18 metrics of a version.
METRICS = (*SUBSTRINGS, *PHRASES, "footer_present", "caption_id_duplicates", "menu_present", "pagetop_present")


def version_values(versions: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """page_id and a column for each metric of each version, ``{split}_{metric}``, of versions (split, page_id, html); null where a version is missing.

    Values stay in columns: a page is one row from the reading of its versions on, and no row is made for a metric.
    Each version is parsed as a page of its own, if its raw text holds any of the words (or a character reference) without which it has no menu and no page-top link.
    """
    n = len(splits)
    number = (F.array_position(F.array(*map(F.lit, splits)), F.col("split")) - 1).cast("int")
    may = F.lower("html").rlike("menu|メニュー|top|先頭へ|&")
    none = {m: F.lit(0).cast("long") for m in ("menu_present", "pagetop_present")}
    raw = versions.withColumn("html", F.coalesce("html", F.lit(""))).select("page_id", number.alias("_split"), *[v.alias(m) for m, v in (_raw_values() | none).items()])
    parts = common_parts(shred(versions.where(may).select((F.col("page_id") * n + number).alias("page_id"), "html"), *PARTS, only=SIGNS))
    found = parts.select(F.floor(F.col("page_id") / n).cast("long").alias("page_id"), F.pmod(F.col("page_id"), F.lit(n)).cast("int").alias("_split"), *[(F.col(m) if m in none else F.lit(None)).cast("long").alias(m) for m in METRICS])
    both = raw.select("page_id", "_split", *METRICS).unionByName(found)
    return both.groupBy("page_id").agg(*[F.max(F.when(F.col("_split") == i, F.col(m))).alias(f"{s}_{m}") for i, s in enumerate(splits) for m in METRICS])


def version_metrics(versions: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """split, page_id, metric, value: all 18 metrics of versions (split, page_id, html)."""
    wide = version_values(versions, splits)
    out = [_long(wide, ["page_id"], {m: F.col(f"{s}_{m}") for m in METRICS}).where("value is not null").select(F.lit(s).alias("split"), "page_id", "metric", "value") for s in splits]
    return reduce(DataFrame.unionByName, out)


def compare_versions(versions: DataFrame) -> DataFrame:
    """page_id, metric, previous, current, gold, verdict of versions (split, page_id, html)."""
    table = F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(f"{s}_{m}").alias(s) for s in SPLITS]) for m in METRICS])
    out = version_values(versions).select("page_id", F.explode(table).alias("m")).select("page_id", "m.*")
    return out.withColumn("verdict", verdict(F.col("metric"), F.col("previous"), F.col("current"), F.col("gold")))


def duplicate_caption_ids(pages: DataFrame) -> DataFrame:
    """page_id, id, n of every id that begins with "caption" and is used again, from the raw text."""
    return pages.select("page_id", F.explode(_caption_ids(F.coalesce("html", F.lit("")))).alias("id")).groupBy("page_id", "id").agg(F.count("*").alias("n")).where("n > 1")


def verdict(metric: Column, p: Column, c: Column, g: Column) -> Column:
    """Verdict of the current version against previous and gold."""
    same, closer = c == g, F.abs(c - g) - F.abs(p - g)
    count = F.when(closer < 0, "improved").when(closer > 0, "regressed").otherwise("stable")
    structure = F.when((p < g) & (c > p), F.when(c <= g, "improved").otherwise("warning")).when(p == c, "stable").when((c < p) & (g >= p), "regressed").otherwise(count)
    absence = F.when((p > 0) & (c == 0), "improved").when((p == 0) & (c > 0), "regressed").when((p == 0) & (c == 0), "stable").otherwise("warning")
    increase = F.when(c < p, "improved").when(c > p, "warning").otherwise("stable")
    text = F.when(same & (p != g), "improved").when(~same & (p == g), "regressed").when(c == p, "stable").otherwise("changed")
    first = F.when(metric.isin(*KINDS["absence"]), F.when(c > 0, "warning").otherwise("matches_gold")).when(metric.isin(*KINDS["increase"]), F.when(c > g, "warning").otherwise("matches_gold")).otherwise(F.when(same, "matches_gold").otherwise("differs_from_gold"))
    known = F.when(metric.isin(*KINDS["count"]), count).when(metric.isin(*KINDS["structure"]), structure).when(metric.isin(*KINDS["absence"]), absence).when(metric.isin(*KINDS["increase"]), increase).otherwise(text)
    return F.when(p.isNull(), first).otherwise(known)


def compare(metrics: DataFrame, key: str) -> DataFrame:
    """Long metrics (split previous/current/gold, key, metric, value) to one row per key and metric with its verdict."""
    wide = metrics.groupBy(key, "metric").pivot("split", ["previous", "current", "gold"]).agg(F.max("value"))
    return wide.withColumn("verdict", verdict(F.col("metric"), F.col("previous"), F.col("current"), F.col("gold")))


def run_status(compared: DataFrame, key: str) -> DataFrame:
    """key, regressed, warnings, status."""
    n = lambda v: F.sum((F.col("verdict") == v).cast("long"))
    return compared.groupBy(key).agg(n("regressed").alias("regressed"), n("warning").alias("warnings"), F.bool_or(F.col("previous").isNull()).alias("new")).withColumn("status", F.when(F.col("new"), "WARNING").when(F.col("regressed") > 0, "FAIL").otherwise("PASS")).drop("new")


def verdict_summary(compared: DataFrame) -> DataFrame:
    """verdict, n over all pages and metrics."""
    return compared.groupBy("verdict").agg(F.count("*").alias("n"))


# -- page regression checks


def target_table(nodes: DataFrame, caption_words: tuple[str, ...], header_words: tuple[str, ...]) -> DataFrame:
    """page_id, table: the table checked, by priority: caption, all headers, any structure, first."""
    from nodeloom.operators.tables import cells, features

    heads = cells(nodes).where("row_ix = 0").groupBy("page_id", "table").agg(F.array_join(F.collect_list("text"), " ").alias("head"))
    f = features(nodes).join(heads, ["page_id", "table"], "left")
    has = lambda c, ws: F.lit(True) if not ws else F.expr("true") & F.forall(F.array(*map(F.lit, ws)), lambda w: F.contains(F.coalesce(c, F.lit("")), w))
    priority = F.when(F.lit(bool(caption_words)) & has(F.col("caption"), caption_words), 0).when(F.lit(bool(header_words)) & has(F.col("head"), header_words), 1).when((F.col("captions") > 0) | (F.col("theads") > 0) | (F.col("n_th") > 0), 2).otherwise(3)
    return f.groupBy("page_id").agg(F.min(F.struct(priority.alias("p"), F.col("table").alias("table")))["table"].alias("table"))


def text_before(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """page_id, before: visible text earlier in document order than the target table."""
    early = visible(nodes).join(targets, "page_id").where(F.col("pre") < F.col("table"))
    parts = F.array_sort(F.collect_list(F.struct("pre", F.trim("text").alias("t"))))
    return targets.select("page_id").join(early.groupBy("page_id").agg(F.array_join(F.transform(parts, lambda x: x["t"]), " ").alias("before")), "page_id", "left").fillna("", ["before"])


def row_scopes(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """page_id, ok: from the second body row on, each first cell is a row header."""
    from nodeloom.operators.tables import cells

    body = cells(nodes).join(targets, ["page_id", "table"]).where("section = 'tbody' and col_ix = 0")
    first = body.groupBy("page_id", "table").agg(F.min("row_ix").alias("first"))
    late = body.join(first, ["page_id", "table"]).where(F.col("row_ix") > F.col("first"))
    return late.groupBy("page_id").agg(F.bool_and((F.col("tag") == "th") & (F.coalesce("scope", F.lit("")) == "row")).alias("ok"), F.count("*").alias("n_rows"))


def checks(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """page_id, check, level: structural checks of a page as rows."""
    from nodeloom.operators.tables import features

    f = features(nodes).join(targets, ["page_id", "table"]).select("page_id", "captions", "theads", "scoped")
    heads = elements(nodes, "h3", "h4").groupBy("page_id").agg(F.max((F.col("tag") == "h3").cast("int")).alias("h3"), F.max((F.col("tag") == "h4").cast("int")).alias("h4"))
    wide = f.join(heads, "page_id", "left").join(common_parts(nodes), "page_id", "left").join(row_scopes(nodes, targets), "page_id", "left")
    named = {"h3": F.coalesce("h3", F.lit(0)) > 0, "h4": F.coalesce("h4", F.lit(0)) > 0, "caption": F.col("captions") > 0, "thead": F.col("theads") > 0, "scopes": F.col("scoped") > 0, "row_scopes": F.coalesce("ok", F.lit(True)), "no_menu": F.coalesce("menu_present", F.lit(0)) == 0, "no_footer": F.coalesce("footer_present", F.lit(0)) == 0}
    return wide.select("page_id", F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.when(v, "PASS").otherwise("FAIL").alias("level")) for k, v in named.items()])).alias("c")).select("page_id", "c.check", "c.level")


#: Files that the page checks are meant for (fixed values).
TARGETS = {"ai": ("sg02395_0820.html",), "gold": ("sg02395.html",)}


def check_targets(files: DataFrame, targets: dict[str, tuple[str, ...]] = TARGETS, always: str = "14256.html") -> DataFrame:
    """files (path) with ``target``: whether the file's name is listed for one of the folders above it, or is the one that always counts."""
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    listed = [F.array_contains(F.slice(parts, 1, F.size(parts) - 1), folder) & name.isin(*names) for folder, names in targets.items()]
    target = name == always
    for one in listed:
        target = target | one
    return files.withColumn("target", target)


def check_summary(files: DataFrame, results: DataFrame) -> DataFrame:
    """One row: files, checked, passed, failed, warnings, skipped, exit_code of files (path, target) and results (path, level). Nothing checked, or a failure, exits with 1."""
    per = results.groupBy("path").agg(F.max((F.col("level") == "FAIL").cast("int")).alias("bad"), F.sum((F.col("level") == "WARNING").cast("long")).alias("warned"))
    joined = files.join(per, "path", "left")
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    bad = F.coalesce(F.col("bad"), F.lit(0)) == 1
    out = joined.agg(F.count("*").alias("files"), n(F.col("target")).alias("checked"), n(F.col("target") & ~bad).alias("passed"), n(F.col("target") & bad).alias("failed"), F.coalesce(F.sum(F.when(F.col("target"), F.col("warned"))), F.lit(0)).alias("warnings"), n(~F.col("target")).alias("skipped"))
    return out.withColumn("exit_code", ((F.col("failed") > 0) | (F.col("checked") == 0)).cast("int"))
