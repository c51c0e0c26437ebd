"""HTML pages shredded once into a relational table of nodes.

Every page is parsed by one pass of the standard tree rules used by all operators:
an end tag closes the nearest open element of its name, unmatched end tags are
ignored, void elements never open. Nodes carry an interval (pre, post_end), so
"descendant" is a range test, and the enclosing tables, row and link, so that most
containment joins become plain grouping. What one pass knows about a table cell is
kept with it (row, column, section, part and place of its row, place in the body grid), so table rules need no
windows. ``up`` holds the distinct names of the open elements, not the path, and
``brief`` the first BRIEF characters of an element's text: both stay short however
deep a page nests. Only elements that rules read whole (WITH_TEXT) keep their text.

Pages of one template differ in their texts alone. What the parser makes of a page's markup is kept
(``Template``) and taken again for every page with the same markup, so that such a page
costs one pass of a pattern. Columns that a rule does not read are not made.

Null html gives no nodes. A page that cannot be parsed gives one node of kind
``error`` instead of failing the job.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without content (fixed values, HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose whole text is kept with them; none of them nests in practice but through missing end tags.
WITH_TEXT = frozenset("a button caption figcaption h1 h2 h3 h4 h5 h6 label option summary td th title".split())
#: Elements that hold a page's main text; nodes know the nearest one around them.
BLOCKS = frozenset("article main section div td body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters of an element's text that are kept with it (one more tells that there is more); contexts read 240 and 250.
BRIEF = 250

SCHEMA = (
    "page_id long, pre int, post_end int, parent int, depth int, elem_ix int, top_ix int, kind string, tag string, attrs map<string,string>, text string, parent_tag string, "
    "up array<string>, tables array<int>, row_pre int, a_pre int, line int, brief string, row_ix int, col_ix int, section string, n_cells int, grid_row int, grid_cols int, block_pre int, part int, row_nth int, a_href string"
)
_ARROW = pa.schema(
    [("page_id", pa.int64()), *[(c, pa.int32()) for c in ("pre", "post_end", "parent", "depth", "elem_ix", "top_ix")], ("kind", pa.string()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())),
     ("text", pa.string()), ("parent_tag", pa.string()), ("up", pa.list_(pa.string())), ("tables", pa.list_(pa.int32())), ("row_pre", pa.int32()), ("a_pre", pa.int32()), ("line", pa.int32()), ("brief", pa.string()),
     ("row_ix", pa.int32()), ("col_ix", pa.int32()), ("section", pa.string()), *[(c, pa.int32()) for c in ("n_cells", "grid_row", "grid_cols", "block_pre", "part", "row_nth")], ("a_href", pa.string())]
)
_PLACE = {f.name: i for i, f in enumerate(_ARROW)}
_TAG, _TEXT, _UP, _TABLES, _BRIEF, _CELLS, _GRID = (_PLACE[c] for c in ("tag", "text", "up", "tables", "brief", "n_cells", "grid_row"))


class Shredder(HTMLParser):
    """Collects rows of one page; ``open`` is the stack of open elements as indexes into rows."""

    def __init__(self, page_id: int | None):
        super().__init__(convert_charrefs=True)
        self.page_id, self.rows, self.open = page_id, [], []
        self.texts: dict[int, list[str]] = {}
        self.briefs: dict[int, list] = {}  # open elements that take more text yet: length so far and parts
        self.children: dict[int, int] = {-1: 0}
        self.trs: dict[int, int] = {}  # table -> rows so far
        self.grids: dict[int, list[int]] = {}  # table -> rows of its body grid that have cells
        self.tops = 0

    def add(self, kind: str, tag: str | None, attrs: dict[str, str], text: str | None) -> int:
        parent = self.open[-1] if self.open else -1
        over = self.rows[parent] if parent >= 0 else None
        pre, inside = len(self.rows), over is not None
        if parent < 0:
            self.tops += 1
        ix = self.children[parent]
        if kind == "element":
            self.children[parent] = ix + 1
        up = (over[_UP] if over[_TAG] in over[_UP] else over[_UP] + [over[_TAG]]) if inside else []
        tables = (over[_TABLES] + [parent] if over[_TAG] == "table" else over[_TABLES]) if inside else []
        row = (parent if over[_TAG] == "tr" else over[_PLACE["row_pre"]]) if inside else None
        link = (parent if over[_TAG] == "a" else over[_PLACE["a_pre"]]) if inside else None
        href = None if link is None else dict(self.rows[link][_PLACE["attrs"]]).get("href") if link == parent else over[-1]
        block = (parent if over[_TAG] in BLOCKS else over[_PLACE["block_pre"]]) if inside else None
        row_ix = col_ix = section = cells = grid = part = nth = None
        if tag == "tr" and tables:
            row_ix, cells = self.trs.get(tables[-1], 0), 0
            self.trs[tables[-1]] = row_ix + 1
        elif tag in ("td", "th") and inside and over[_TAG] == "tr" and tables:
            row_ix, col_ix, section = over[_PLACE["row_ix"]], over[_CELLS], over[_PLACE["parent_tag"]]
            part, nth = over[3], over[5]
            over[_CELLS] += 1
            if section in ("table", "tbody"):
                rows = self.grids.setdefault(tables[-1], [])
                if not col_ix:
                    over[_GRID] = len(rows)
                    rows.append(parent)
                grid = over[_GRID]
        self.rows.append([self.page_id, pre, pre, parent if inside else None, len(self.open), ix, over[6] if inside else self.tops - 1, kind, tag, list(attrs.items()), text, over[_TAG] if inside else None, up, tables, row, link, self.getpos()[0],
                          None, row_ix, col_ix, section, cells, grid, None, block, part, nth, href])
        return pre

    def handle_starttag(self, tag, attrs):
        pre = self.add("element", tag, {k: v or "" for k, v in attrs}, None)
        self.children[pre] = 0
        if tag in WITH_TEXT:
            self.texts[pre] = []
        if tag not in VOID:
            self.open.append(pre)
            self.briefs[pre] = [0, []]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def shut(self, pres: list[int]) -> None:
        for pre in pres:
            self.rows[pre][2] = len(self.rows) - 1
            held = self.briefs.pop(pre, None)
            if held and held[1]:
                self.rows[pre][_BRIEF] = " ".join(held[1])[: BRIEF + 1]

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[at]][_TAG] == tag:
                self.shut(self.open[at:])
                del self.open[at:]
                return

    def handle_data(self, data):
        said = data.strip()
        if said:
            self.add("text", None, {}, data)
            if self.texts:
                for pre in self.open:
                    if pre in self.texts:
                        self.texts[pre].append(said)
            full = []
            for pre, held in self.briefs.items():
                held[0] += len(said) + bool(held[1])
                held[1].append(said[: BRIEF + 1])
                if held[0] > BRIEF:
                    full.append(pre)
            for pre in full:  # an element that has enough is not met again
                self.rows[pre][_BRIEF] = " ".join(self.briefs.pop(pre)[1])[: BRIEF + 1]

    def handle_comment(self, data):
        self.add("comment", None, {}, data)

    def handle_decl(self, decl):
        self.add("doctype", None, {}, decl)

    def finish(self) -> list[list]:
        self.close()
        self.shut(self.open)
        for pre, parts in self.texts.items():
            self.rows[pre][_TEXT] = " ".join(parts)
        columns = {table: min(self.rows[r][_CELLS] for r in rows) for table, rows in self.grids.items()}
        for row in self.rows:
            if row[_PLACE["col_ix"]] is not None and row[_GRID] is not None:
                row[_PLACE["grid_cols"]] = columns[row[_TABLES][-1]]
        return self.rows


def parse(page_id: int | None, html: str) -> list[list]:
    shredder = Shredder(page_id)
    try:
        shredder.feed(html)
        return shredder.finish()
    except Exception as e:  # noqa: BLE001  one bad page is a row, not a failed job
        return [[page_id, 0, 0, None, 0, 0, 0, "error", None, [], repr(e)[:200], None, [], [], None, None, 1, *[None] * 11]]


#: A text between two tags, without a reference and on one line: nothing but itself follows from it.
_PLAIN = re.compile(r">([^<>&\n]*[^<>&\s][^<>&\n]*)(?=<)")
#: Stands for such a text in a page's markup.
_SLOT = "\ue000"
#: Nodes of templates that a worker keeps, pages that it looks at before it judges them, and nodes of one batch.
HELD_NODES, TRIAL, BATCH_NODES = 200_000, 2_000, 8_192
_GIVEN = ("page_id", "text", "brief")


#: Nodes that a rule may ask for: all, tables with what is in them, with their rows and cells, cells alone, tables and headings, elements, and texts with what names a part of a page.
_NAMING = frozenset(("id", "class", "href", "aria-label"))
KEPT = {
    "every": lambda r: True, "inside": lambda r: bool(r[_TABLES]) or r[_TAG] == "table",
    "grid": lambda r: r[_TAG] in ("table", "tr") or r[_PLACE["col_ix"]] is not None, "cells": lambda r: r[_PLACE["col_ix"]] is not None, "outline": lambda r: r[_TAG] == "table" or r[_TAG] in HEADINGS, "elements": lambda r: r[_PLACE["kind"]] == "element",
    "signs": lambda r: r[_PLACE["kind"]] == "text" or r[_TAG] == "footer" or any(k in _NAMING for k, _ in r[_PLACE["attrs"]]),
}


class Template:
    """The nodes of all pages of one markup: every column but the texts, and of which texts each node's own is made."""

    def __init__(self, rows: list[list]):
        self.n = len(rows)
        self.fixed = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW) if f.name not in _GIVEN]
        self.kept = {name: np.flatnonzero([keep(r) for r in rows]) for name, keep in KEPT.items()}
        texts = [at for at, r in enumerate(rows) if r[_PLACE["kind"]] == "text"]
        self.said = [None if rows[at][_TEXT] == _SLOT else rows[at][_TEXT] for at in texts]
        self.slots = [k for k, t in enumerate(self.said) if t is None]
        self.text = [None if r[_PLACE["kind"]] in ("text", "element") else r[_TEXT] for r in rows]
        self.texts = texts
        elements = [at for at, r in enumerate(rows) if r[_PLACE["kind"]] == "element"]
        ends = {at: (bisect_left(texts, at), bisect_left(texts, rows[at][2] + 1)) for at in elements}
        self.whole = [(at, *ends[at]) for at in elements if rows[at][_TAG] in WITH_TEXT]
        self.briefs = [(at, *ends[at]) for at in elements if ends[at][0] < ends[at][1]]

    def column(self, name: str, texts: list[str]) -> list[str | None]:
        """The text or brief column of a page with these texts."""
        said = texts
        if len(self.slots) < len(self.said):
            said = list(self.said)
            for k, t in zip(self.slots, texts):
                said[k] = t
        if name == "text":
            out = list(self.text)
            for at, t in zip(self.texts, said):
                out[at] = t
            bare = [t.strip() for t in said]
            for at, a, b in self.whole:
                out[at] = bare[a] if b == a + 1 else " ".join(bare[a:b])
        else:
            out = [None] * self.n
            bare = [t.strip() for t in said]
            for at, a, b in self.briefs:  # a text has a character and a space at least
                out[at] = " ".join(bare[a : min(b, a + BRIEF // 2 + 1)])[: BRIEF + 1]
        return out


class Templates:
    """Templates of a worker by their markup. A markup is kept when it is met again; where hardly any is, none is looked for any more."""

    def __init__(self):
        self.by_markup: dict[str, Template | None] = {}
        self.nodes = self.looked = self.hits = self.size = 0

    def find(self, html: str) -> tuple[Template | None, list[str]]:
        if self.looked >= TRIAL and self.hits * 4 < self.looked or _SLOT in html:
            return None, []
        self.looked += 1
        markup, n = _PLAIN.subn(f">{_SLOT}", html)
        if markup not in self.by_markup:
            self.size += len(markup)
            if self.nodes > HELD_NODES or self.size > 100 * HELD_NODES:
                self.by_markup, self.nodes, self.size = {}, 0, len(markup)
            self.by_markup[markup] = None
            return None, []
        found = self.by_markup[markup]
        if found is None:
            rows = parse(None, markup)
            # each slot must be the whole of a text node, none may stand in a comment, script or attribute
            whole = sum(r[_PLACE["kind"]] == "text" and r[_TEXT] == _SLOT for r in rows)
            found = self.by_markup[markup] = Template(rows) if rows and whole == n and rows[0][_PLACE["kind"]] != "error" else False
            self.nodes += len(rows)
        if not found:
            return None, []
        self.hits += 1
        return found, _PLAIN.findall(html)


_TEMPLATES = Templates()


def _gathered(held: list, columns: tuple[str, ...], only: str) -> pa.RecordBatch:
    """One batch of nodes of pages (page_id, template, texts)."""
    kinds = list({id(t): t for _, t, _ in held}.values())
    at, begin = {}, 0
    for t in kinds:
        at[id(t)] = begin
        begin += t.n
    masks = {id(t): t.kept[only] for t in kinds}
    picked = pa.array(np.concatenate([masks[id(t)] + at[id(t)] for _, t, _ in held]))
    names = [f.name for f in _ARROW if f.name not in _GIVEN]
    out = []
    for name in columns:
        if name == "page_id":
            n = [len(masks[id(t)]) for _, t, _ in held]
            out.append(pa.array([p for p, _, _ in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(held)), n))))
        elif name in _GIVEN:
            if only == "every":
                values = [x for _, t, texts in held for x in t.column(name, texts)]
            else:
                values = [c[i] for _, t, texts in held for c in (t.column(name, texts),) for i in masks[id(t)].tolist()]
            out.append(pa.array(values, pa.string()))
        else:
            i = names.index(name)
            out.append(pa.concat_arrays([t.fixed[i] for t in kinds]).take(picked))
    return pa.RecordBatch.from_arrays(out, schema=pa.schema([_ARROW.field(c) for c in columns]))


def _of_rows(rows: list[list], columns: tuple[str, ...], only: str) -> pa.RecordBatch:
    rows = [r for r in rows if KEPT[only](r)]
    return pa.RecordBatch.from_arrays([pa.array([r[_PLACE[c]] for r in rows], _ARROW.field(c).type) for c in columns], schema=pa.schema([_ARROW.field(c) for c in columns]))


def _shredded(ids: list, htmls: list, columns: tuple[str, ...], only: str) -> Iterator[pa.RecordBatch]:
    held, rows, n = [], [], 0
    for page, html in zip(ids, htmls):
        if not html:
            continue
        found, texts = _TEMPLATES.find(html)
        if found is None:
            rows += parse(page, html)
        else:
            held.append((page, found, texts))
            n += found.n
        if n >= BATCH_NODES:
            yield _gathered(held, columns, only)
            held, n = [], 0
        if len(rows) >= BATCH_NODES:
            yield _of_rows(rows, columns, only)
            rows = []
    if held:
        yield _gathered(held, columns, only)
    if rows:
        yield _of_rows(rows, columns, only)


def _told(out: pa.RecordBatch, ids: pa.Array, facts: pa.ListArray, names: tuple[str, ...]) -> pa.RecordBatch:
    """Nodes whose page_id is the place of their page in ``ids``, with its own page_id and the fact of their nearest table (a table: its own)."""
    column = {f.name: out.column(i) for i, f in enumerate(out.schema)}
    place, lists = column["page_id"].to_numpy(), column["tables"]
    ends, inner = lists.offsets.to_numpy(), lists.values.to_numpy()
    near = np.where(np.diff(ends) > 0, np.append(inner, -1)[ends[1:] - 1], -1)
    key = np.where(pc.fill_null(pc.equal(column["tag"], "table"), False).to_numpy(zero_copy_only=False), column["pre"].to_numpy(), near).astype(np.int64)
    flat = facts.flatten()
    owner = np.repeat(np.arange(len(facts)), pc.fill_null(pc.list_value_length(facts), 0).to_numpy())
    known = (owner << 32) | flat.field("table").to_numpy().astype(np.int64)
    order = np.argsort(known)
    wanted = (place << 32) | key
    at = np.searchsorted(known[order], wanted)
    order = np.append(order, 0)
    found = (key >= 0) & (np.append(known, -1)[order[at]] == wanted) & (at < len(known))
    column |= {"page_id": ids.take(column["page_id"]), "fact": flat.take(pa.array(order[at], mask=~found))}
    return pa.RecordBatch.from_arrays([column[c] for c in (*names, "fact")], names=[*names, "fact"])


def shred(pages: DataFrame, *columns: str, only: str = "every") -> DataFrame:
    """nodes of pages (page_id, html), all columns or those named, every node or those of one name of KEPT. Pages stay where they are read: no shuffle.

    What is known of a page's tables may come with the page (``facts``, an array of structs with ``table``); each node then has the one of its nearest
    table, ``fact``. So a page meets its facts once, and its nodes are never joined. The nodes of a page follow each other in document order.
    """
    columns = tuple(f.name for f in _ARROW if not columns or f.name in columns)
    schema = ", ".join(part for part in SCHEMA.split(", ") if part.split(" ")[0] in columns)
    pages = pages.withColumn("page_id", F.col("page_id").cast("long"))
    if "facts" not in pages.columns:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1_024):
                    yield from _shredded(*(c.to_pylist() for c in batch.slice(at, 1_024).columns), columns, only)

        return pages.select("page_id", "html").mapInArrow(run, schema)
    made = tuple(f.name for f in _ARROW if f.name in columns or f.name in ("page_id", "pre", "tag", "tables"))

    def run_told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                ids, htmls, facts = batch.slice(at, 1_024).columns
                for out in _shredded(range(len(ids)), htmls.to_pylist(), made, only):
                    yield _told(out, ids, facts, columns)

    return pages.select("page_id", "html", "facts").mapInArrow(run_told, f"{schema}, fact {pages.schema['facts'].dataType.elementType.simpleString()}")


def shared_folder(spark) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset, a local folder in local mode and an error elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{tempfile.gettempdir()}/nodeloom-checkpoints"
    return root.rstrip("/")


def materialise(nodes: DataFrame) -> DataFrame:
    """Nodes (or pages, which are parsed again faster than their nodes are written) as a Parquet table in the shared checkpoint folder: rules with several branches parse each page once and read only their columns. It goes when the session's JVM ends."""
    spark = nodes.sparkSession
    path = f"{shared_folder(spark)}/nodes-{uuid.uuid4().hex}"
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(held)
    nodes.write.parquet(path)
    return spark.read.parquet(path)


def elements(nodes: DataFrame, *tags: str) -> DataFrame:
    return nodes.where((F.col("kind") == "element") & F.col("tag").isin(*tags))


def visible(nodes: DataFrame) -> DataFrame:
    """Text nodes that a reader sees."""
    return nodes.where((F.col("kind") == "text") & ~F.arrays_overlap("up", F.array(*map(F.lit, ("script", "style", "noscript", "template", "title")))))


def page_text(nodes: DataFrame) -> DataFrame:
    """page_id, text: stripped text nodes in document order, joined by one space."""
    parts = F.array_sort(F.collect_list(F.struct("pre", F.btrim(F.col("text"), F.lit(" \t\n\r")).alias("t"))))
    return visible(nodes).groupBy("page_id").agg(F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("text"))
