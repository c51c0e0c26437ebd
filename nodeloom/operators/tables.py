"""Table rules over nodes: shapes, layout and data tables, header direction, captions, row headers.

All operators group by (page_id, table): ``table`` is the preorder number of the
table element. The table node itself is in its group (``members``), so tables without
content need no join. Rows of nested tables count for each enclosing table where the rule
tests descendants; cells belong to their nearest table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeloom.functions import text as fx
from nodeloom.operators.shred import elements, shred


def members(nodes: DataFrame) -> DataFrame:
    """Each node once for every table around it, a table also for itself (``own``)."""
    own = F.coalesce(F.col("tag") == "table", F.lit(False))
    around = F.when(own, F.concat("tables", F.array("pre"))).otherwise(F.col("tables"))
    out = nodes.where((F.size("tables") > 0) | own).withColumn("table", F.explode(around))
    return out.withColumn("own", F.coalesce(F.col("tag") == "table", F.lit(False)) & (F.col("table") == F.col("pre")))


def _span(name: str) -> Column:
    return F.greatest(F.lit(1), F.coalesce(F.col("attrs")[name].try_cast("int"), F.lit(1)))


def nearest() -> Column:
    """The nearest table around a node, null outside tables."""
    return F.get("tables", F.size("tables") - 1)


def scope() -> Column:
    return F.lower(F.coalesce(F.col("attrs")["scope"], F.lit("")))


def cells(nodes: DataFrame) -> DataFrame:
    """page_id, table, row_ix, col_ix, tag, text, colspan, rowspan, scope, section, grid_row, grid_cols, part, row_nth, pre: cells of the nearest table. A filter: the parser has placed them."""
    own = nodes.where("col_ix is not null")
    return own.select("page_id", nearest().alias("table"), "row_ix", "col_ix", "tag", F.coalesce("text", F.lit("")).alias("text"), _span("colspan").alias("colspan"), _span("rowspan").alias("rowspan"), scope().alias("scope"), "section", "grid_row", "grid_cols", "part", "row_nth", "pre")


#: Columns of nodes that the rules of this module read: features, shapes, cells, headings, and features with head cells.
FEATURES = ("page_id", "pre", "parent", "kind", "tag", "attrs", "text", "tables", "line", "n_cells")
SHAPES = ("page_id", "pre", "tag", "attrs", "text", "tables", "n_cells", "col_ix", "row_ix")
CELLS = ("page_id", "pre", "tag", "attrs", "text", "tables", "up", "row_ix", "col_ix", "section", "grid_row", "grid_cols", "part", "row_nth")
OUTLINE = ("page_id", "pre", "kind", "tag", "text")
HEADS = (*FEATURES, "up", "col_ix", "grid_row")


def shapes(nodes: DataFrame) -> DataFrame:
    """page_id, table, n_rows, min_cols, max_cols, blanks, total_colspan (of the first row), over the rows of the nearest table; rows without cells have width 0."""
    near = nodes.where(F.coalesce(F.col("tag").isin("table", "tr"), F.lit(False)) | F.col("col_ix").isNotNull())
    near = near.withColumn("table", F.when(F.col("tag") == "table", F.col("pre")).otherwise(nearest())).where("table is not null")
    row, cell = (F.col("tag") == "tr") & F.col("row_ix").isNotNull(), F.col("col_ix").isNotNull()
    blank = cell & (fx.squeeze(F.col("text")) == "")
    none = lambda c: F.coalesce(c, F.lit(0))
    return near.groupBy("page_id", "table").agg(
        F.sum(row.cast("long")).alias("n_rows"), none(F.min(F.when(row, F.col("n_cells")))).alias("min_cols"), none(F.max(F.when(row, F.col("n_cells")))).alias("max_cols"),
        F.sum(blank.cast("long")).alias("blanks"), none(F.sum(F.when(cell & (F.col("row_ix") == 0), _span("colspan")))).alias("total_colspan"),
    )


def features(nodes: DataFrame, **more: Column) -> DataFrame:
    """One row a table with the counts that the predicates read, and ``more`` sums over its members, from one grouping.

    Sums are numbers, so that they are hashed and not sorted; only ``caption``, the text of the first one, is not.
    """
    within = ~F.col("own")
    is_ = lambda *tags: (within & F.coalesce(F.col("tag").isin(*tags), F.lit(False))).cast("long")
    th = F.coalesce(F.col("tag") == "th", F.lit(False))
    href = F.coalesce(F.col("attrs")["href"], F.lit(""))
    file_link = F.coalesce((F.col("tag") == "a") & (href.rlike(fx.FILE_LINK) | F.contains(F.lower(F.coalesce(F.col("attrs")["type"], F.lit(""))), F.lit("pdf"))), F.lit(False))
    ui = F.coalesce((F.col("kind") == "text") & fx.contains_any(F.col("text"), fx.UI_WORDS), F.lit(False))
    digits = lambda a: F.coalesce(F.col("attrs")[a].rlike("^[0-9]+$") & (F.col("attrs")[a].try_cast("long") > 1), F.lit(False))
    merged = within & (digits("colspan") | digits("rowspan"))
    row = (F.col("tag") == "tr") & F.col("n_cells").isNotNull()
    names = {
        "captions": is_("caption"), "theads": is_("thead"), "n_tr": is_("tr"), "n_th": is_("th"), "scoped": (th & scope().isin("col", "row")).cast("long"), "bare_th": (th & (scope() == "")).cast("long"),
        "iframes": is_("iframe"), "imgs": is_("img"), "files": file_link.cast("long"), "controls": is_("a", "img", "br", "iframe", "button", "input", "select"), "media": is_("a", "img", "br", "iframe"),
        "ui": ui.cast("long"), "merged": merged.cast("long"), "direct_theads": (within & (F.col("tag") == "thead") & (F.col("parent") == F.col("table"))).cast("long"),
    }
    is_caption = F.col("tag") == "caption"
    caption = F.when(is_caption, F.struct("pre", F.coalesce("text", F.lit("")).alias("text"), F.col("line").alias("at")))
    out = members(nodes).groupBy("page_id", "table").agg(
        F.max(F.when(F.col("own"), F.col("line"))).alias("line"), *[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in names.items()], F.min(caption).alias("c"),
        F.min(F.when(within & (F.col("tag") == "thead"), F.col("pre"))).alias("head"), F.min(F.when(within & (F.col("tag") == "tbody"), F.col("pre"))).alias("body"),
        F.coalesce(F.min(F.when(row, F.col("n_cells"))), F.lit(0)).alias("narrowest"), F.coalesce(F.max(F.when(row, F.col("n_cells"))), F.lit(0)).alias("widest"),
        F.min_by(F.trim(F.coalesce("text", F.lit(""))) == "", F.when(is_caption, F.col("pre"))).alias("caption_blank"), *[v.alias(k) for k, v in more.items()],
    )
    return out.withColumns({"caption": F.col("c.text"), "caption_line": F.col("c.at")}).drop("c")


def layout_reason(f: DataFrame) -> DataFrame:
    """features with ``layout`` and the rule that decided."""
    small = F.col("n_tr").between(1, 12) & (F.col("n_th") <= 1) & ((F.col("controls") >= F.greatest(F.lit(2), F.col("n_tr"))) | (F.col("ui") > 0))
    reason = F.when(F.col("captions") > 0, "caption").when(F.col("theads") > 0, "thead").when(F.col("scoped") >= 2, "scoped").when(F.col("iframes") > 0, "iframe").when(F.col("imgs") > 0, "img").when(F.col("files") > 0, "file").when(small, "controls").otherwise("none")
    return f.withColumn("reason", reason).withColumn("layout", reason.isin("iframe", "img", "file", "controls"))


def data_like(f: DataFrame) -> DataFrame:
    """features with ``data_like``."""
    return f.withColumn("data_like", (F.col("captions") > 0) | ((F.col("theads") > 0) & (F.col("scoped") >= 1)) | ((F.col("n_th") >= 2) & (F.col("n_tr") >= 3) & (F.col("media") < F.greatest(F.lit(3), F.col("n_tr")))))


def scores(grid: DataFrame) -> DataFrame:
    """page_id, table, n_rows, n_cols, blank, has_th, col_score, row_score, turned_col, turned_row of every table with cells in its body grid, from nodes with their cells."""
    text = F.coalesce("text", F.lit(""))
    first_row, first_col = F.col("grid_row") == 0, F.col("col_ix") == 0
    own = grid.where("col_ix is not null and grid_row >= 0").select("page_id", nearest().alias("table"), "tag", "grid_row", "grid_cols", "col_ix", text.alias("text"), fx.squeeze(text).alias("bare"))
    own = own.withColumn("own", F.when(first_row | first_col, fx.squeezed_score(F.col("bare"))))
    cut = F.col("col_ix") < F.col("grid_cols")
    on = lambda at, v: F.when(cut & at, v)

    def data(at):
        raw = F.col("text")
        marks = [F.avg(on(at, fx.digit_share(raw))) >= 0.2, F.avg(on(at, F.length(raw).cast("double"))) > 10, F.bool_or(on(at, raw.rlike(fx.PHONE))), F.bool_or(on(at, raw.rlike("住所|所在地")))]
        return sum((F.coalesce(m, F.lit(False)).cast("double") * 0.5 for m in marks[1:]), F.coalesce(marks[0], F.lit(False)).cast("double") * 0.5)

    return own.groupBy("page_id", "table").agg(
        (F.max(F.when(cut, F.col("grid_row"))) + 1).cast("long").alias("n_rows"), F.max(F.when(cut, F.col("grid_cols"))).cast("long").alias("n_cols"), F.avg(F.when(cut, (F.col("bare") == "").cast("double"))).alias("blank"),
        F.bool_or(on(first_row | first_col, F.col("tag") != "td")).alias("has_th"), (F.avg(on(first_row, F.col("own"))) + data(F.col("grid_row") == 1)).alias("col_score"), (F.avg(on(first_col, F.col("own"))) + data(F.col("col_ix") == 1)).alias("row_score"),
        F.sum(first_row.cast("long")).alias("turned_col"), F.sum(first_col.cast("long")).alias("turned_row"),
    )


def directed(f: DataFrame, grid: DataFrame) -> DataFrame:
    """Features with layout, and the scores of their cells, orient, direction and delta; tables without a cell in their body grid have no n_rows."""
    out = layout_reason(f).join(scores(grid), ["page_id", "table"], "left").withColumn("delta", F.col("col_score") - F.col("row_score"))
    direction = (
        F.when(F.col("direct_theads") > 0, "thead").when(F.col("n_rows") < 2, "few_rows").when(F.col("layout"), "layout").when(F.col("n_cols") < 2, "few_cols").when(F.col("has_th"), "not_td").when(F.col("blank") > 0.5, "blank")
        .when((F.col("col_score") >= 2.5) & (F.col("delta") >= 1), "col").when((F.col("row_score") >= 2.5) & (F.col("delta") <= -1), "row").otherwise("unclear")
    )
    return out.withColumns({"direction": direction, "orient": F.when(F.col("n_rows").isNotNull() & direction.isin("col", "row"), direction).otherwise("none")})


def orientation(nodes: DataFrame, grid: DataFrame | None = None) -> DataFrame:
    """page_id, table, orient, reason, n_rows, n_cols, col_score, row_score, delta of every table with cells in its body grid.

    The grid holds the rows that stand in the table or its tbody and have cells, cut to the
    narrowest. Tables with a thead of their own and layout tables are skipped, as the fix passes them over. grid: the cells, where they are read apart.
    """
    out = directed(features(nodes), nodes if grid is None else grid)
    return out.where("n_rows is not null").select("page_id", "table", "orient", F.col("direction").alias("reason"), "n_rows", "n_cols", *[F.bround(c, 3).alias(c) for c in ("col_score", "row_score", "delta")])


def previous_heading(nodes: DataFrame, levels=("h2", "h3", "h4"), blank: bool = False) -> DataFrame:
    """page_id, table, heading: nearest earlier heading, blank ones passed over unless asked for."""
    marks = elements(nodes, "table", *levels)
    heading = F.when(F.col("tag") != "table", F.coalesce("text", F.lit("")) if blank else F.when(fx.collapse(F.col("text")) != "", F.col("text")))
    before = F.last(heading, True).over(Window.partitionBy("page_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1))
    return marks.select("page_id", F.col("pre").alias("table"), "tag", before.alias("heading")).where("tag = 'table'").drop("tag")


def _column_head() -> Column:
    """A first row's cell that is marked as the head of its column already."""
    return (F.col("row_nth") == 0) & (F.col("tag") == "th") & (F.col("scope") == "col")


def _wants_col() -> Column:
    """A th under a thead that is to get a column's scope."""
    return (F.col("tag") == "th") & F.array_contains("up", "thead") & (scope() != "col")


def header_plan(nodes: DataFrame, grid: DataFrame | None = None, outline: DataFrame | None = None) -> DataFrame:
    """page_id, table, orient, caption_added, target, promote, body (pre of the first tbody), repeat_ratio, and what is edited: what the header rules decide for each table.

    Closed form of the repeated passes: direction first, captions next, then targets with the new captions.
    Edits are counted for each direction that a table may get, so nodes never meet their plan. grid, outline: cells and headings, where they are read apart.
    """
    grid, outline = nodes if grid is None else grid, nodes if outline is None else outline
    sums = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))
    turned = {"none": F.lit(False), "col": F.col("col_ix").isNotNull() & (F.coalesce("grid_row", F.lit(-1)) == 0), "row": F.coalesce("grid_row", F.lit(-1)) >= 0}
    head = F.coalesce(_wants_col() & (F.col("table") == nearest()), F.lit(False))
    f = features(nodes, **{f"head_{k}": sums(head & ~(F.coalesce(t & ((F.col("col_ix") == 0) if k == "row" else F.lit(True)), F.lit(False)))) for k, t in turned.items()})
    # cells by the part that holds their row and, of first cells that may name their row, by text
    own = grid.where("col_ix is not null and part is not null").withColumns({"table": nearest(), "colspan": _span("colspan"), "scope": scope(), "said": fx.collapse(F.col("text"))})
    named = (F.col("col_ix") == 0) & ~_column_head() & fx.collapsed_row_header(F.col("said"))
    own = own.withColumns({"name": F.when(named, F.col("said")), "first": F.when(F.col("section") == "thead", F.when(F.col("said").rlike(fx.ROW_HEADER_HINT), 1).otherwise(0) + 2 * F.col("pre").cast("long"))})
    edited = F.col("name").isNotNull() & ~((F.col("tag") == "th") & (F.col("scope") == "row")) & ~_wants_col()
    rows = {f"rows_{k}": sums(edited & ~t) for k, t in turned.items()}
    parts = own.groupBy("page_id", "table", "section", "part", "name").agg(F.count("name").alias("named"), F.sum(F.when(F.col("row_nth") == 0, F.col("colspan"))).alias("span"), F.min("first").alias("first"), *[v.alias(k) for k, v in rows.items()])
    parts = parts.groupBy("page_id", "table", "section", "part").agg(F.count("name").alias("kinds"), F.min("first").alias("first"), *[F.sum(c).alias(c) for c in ("named", "span", *rows)])
    # the first thead and the first tbody that have cells; they count if no part of their kind comes before
    of = lambda tag, c: F.min_by(c, F.when(F.col("section") == tag, F.col("part")))
    in_head, in_body = ("span", "first"), ("named", "kinds", *rows)
    told = parts.groupBy("page_id", "table").agg(*[of("thead", c).alias(a) for c, a in (("part", "in_head"), *zip(in_head, in_head))], *[of("tbody", c).alias(a) for c, a in (("part", "in_body"), *zip(in_body, in_body))])
    f = directed(f, grid).join(previous_heading(outline), ["page_id", "table"], "left").join(told, ["page_id", "table"], "left")
    for part, at, columns in (("head", "in_head", in_head), ("body", "in_body", in_body)):
        f = f.withColumns({c: F.when(F.col(at) == F.col(part), F.col(c)) for c in columns})
    f = f.withColumn("caption_added", F.when((F.col("captions") == 0) & ~F.col("layout") & F.col("heading").isNotNull(), F.concat("heading", F.lit("一覧"))))
    target = ((F.col("captions") > 0) | F.col("caption_added").isNotNull()) & (F.col("theads") > 0) & ~F.col("layout") & (F.coalesce("span", F.lit(0)) >= 2)
    ratio = F.when(F.coalesce("named", F.lit(0)) > 0, 1 - F.col("kinds") / F.col("named")).otherwise(0.0)
    promote = target & ((F.coalesce("first", F.lit(0)) % 2 == 1) | (ratio >= 0.25))
    by = lambda name: F.when(F.col("orient") == "col", F.col(f"{name}_col")).when(F.col("orient") == "row", F.col(f"{name}_row")).otherwise(F.col(f"{name}_none"))
    counts = {"col_scopes_added": F.when(target, by("head")), "row_headers": F.when(promote, by("rows")), "oriented": F.when(F.col("orient") == "col", F.col("turned_col")).when(F.col("orient") == "row", F.col("turned_row"))}
    return f.select("page_id", "table", "orient", "caption_added", target.alias("target"), promote.alias("promote"), "body", F.bround(ratio, 3).alias("repeat_ratio"), *[F.coalesce(v, F.lit(0)).cast("long").alias(k) for k, v in counts.items()])


#: What the repair of a table's nodes needs of its plan.
_PLANNED = ("orient", "caption_added", "target", "promote", "body")


def _edits(nodes: DataFrame, plan: DataFrame) -> DataFrame:
    """nodes with the plan of their nearest table and ``edit``."""
    table = F.when(F.col("tag") == "table", F.col("pre")).otherwise(nearest())
    return _edited(nodes.withColumn("_table", table).join(plan.select("page_id", F.col("table").alias("_table"), *_PLANNED), ["page_id", "_table"], "left"))


def _edited(planned: DataFrame) -> DataFrame:
    """nodes beside their plan with ``edit``: the scope that a cell gets (col or row), null where it keeps its own."""
    cell, own = F.col("col_ix").isNotNull(), F.col("scope")
    turned = F.when((F.col("orient") == "col") & (F.col("grid_row") == 0), "col").when((F.col("orient") == "row") & (F.col("grid_row") >= 0) & (F.col("col_ix") == 0), "row")
    head = F.col("target") & _wants_col()
    first = F.col("promote") & (F.col("part") == F.col("body")) & (F.col("col_ix") == 0) & ~_column_head() & fx.row_header_text(F.col("text")) & ~((F.col("tag") == "th") & (own == "row"))
    kind = F.when(cell & turned.isNotNull(), F.concat(F.lit("orient_"), turned)).when(head, "head_col").when(cell & first, "body_row")
    return planned.withColumn("scope", scope()).withColumn("edit", kind)


def _repaired(edited: DataFrame) -> DataFrame:
    to = F.when(F.col("edit").endswith("col"), "col").when(F.col("edit").endswith("row"), "row")
    attrs = F.when(to.isNotNull(), F.map_concat(F.map_filter("attrs", lambda k, _: k != "scope"), F.create_map(F.lit("scope"), F.coalesce(to, F.lit(""))))).otherwise(F.col("attrs"))
    return edited.withColumns({"attrs": attrs, "tag": F.when(to.isNotNull(), "th").otherwise(F.col("tag")), "inserted": F.when(F.col("tag") == "table", F.col("caption_added"))})


def fix_headers(nodes: DataFrame) -> DataFrame:
    """nodes with headers repaired: promoted cells are ``th`` with their attributes and a scope; ``inserted`` holds the caption that a table gets as its first child."""
    return _repaired(_edits(nodes, header_plan(nodes))).select(*nodes.columns, "inserted")


def header_nodes(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What header_plan reads of pages: nodes in tables, cells, headings."""
    return shred(pages, *HEADS, only="inside"), shred(pages, *CELLS, only="cells"), shred(pages, *OUTLINE, only="outline")


def with_plans(pages: DataFrame, plan: DataFrame) -> DataFrame:
    """pages with ``facts``: the plans of their tables that change anything. One row a page meets one row a page."""
    some = plan.where((F.col("orient") != "none") | F.col("target") | F.col("caption_added").isNotNull())
    return pages.join(some.groupBy("page_id").agg(F.collect_list(F.struct("table", *_PLANNED)).alias("facts")), "page_id", "left")


def planned(nodes: DataFrame) -> DataFrame:
    """nodes of with_plans with headers repaired, as fix_headers does, node by node."""
    return _repaired(_edited(nodes.withColumns({c: F.col("fact")[c] for c in _PLANNED}))).select(*[c for c in nodes.columns if c != "fact"], "inserted")


def header_fix(nodes: DataFrame, grid: DataFrame | None = None, outline: DataFrame | None = None) -> DataFrame:
    """page_id, table, caption_added, col_scopes_added, row_headers, oriented, repeat_ratio: what the header rules change."""
    return header_plan(nodes, grid, outline).select("page_id", "table", "caption_added", "col_scopes_added", "row_headers", "oriented", "repeat_ratio")


def table_identity(nodes: DataFrame) -> DataFrame:
    """page_id, table, identity: id=..., else the first data attribute with a value, else dom_index=... (place among the page's tables, from 1)."""
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("pre"))
    data = F.get(F.filter(F.map_entries("attrs"), lambda e: e["key"].startswith("data-") & (e["value"] != "")), 0)
    by_id = F.when(F.coalesce(F.col("attrs")["id"], F.lit("")) != "", F.concat(F.lit("id="), F.col("attrs")["id"]))
    return elements(nodes, "table").select("page_id", F.col("pre").alias("table"), F.coalesce(by_id, F.concat(data["key"], F.lit("="), data["value"]), F.concat(F.lit("dom_index="), nth.cast("string"))).alias("identity"))
