"""Where named queries are kept, and the tables and renderings that they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nodeloom.operators import tables
from nodeloom.operators.shred import materialise, shred
from nodeloom.plans import render

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_nodes(spark, sf_dir):
    return shred(table(spark, sf_dir, "pages"))


def order_nodes(spark, sf_dir, *columns, only="every", held=False):
    """Nodes of the order tables: the columns and kinds of nodes that a rule reads, written once (``held``) for rules that read them several times."""
    nodes = shred(render.order_tables(spark, sf_dir), *columns, only=only)
    return materialise(nodes) if held else nodes


def header_nodes(pages):
    """What the header rules read of pages, which are written once and parsed for each."""
    return tables.header_nodes(materialise(pages))


def link_nodes(spark, sf_dir):
    return materialise(shred(render.part_links(spark, sf_dir)))


#: Pages without what scripts, styles and comments hold.
BARE = "select page_id, url, html, regexp_replace(regexp_replace(html, '<(script|style)>.*?</(script|style)>', '', 'gs'), '<!--.*?-->', '', 'gs') as bare from pages"
HREFS = f"select page_id, unnest(regexp_extract_all(bare, '<a href=\"([^\"]*)\"', 1)) as href from ({BARE})"
#: Orders with the number of their lines, of returned and of open ones.
ROWS = "select o_orderkey, o_orderpriority p, o_orderstatus st, count(l_orderkey) n, count(*) filter (where l_returnflag = 'R') r, count(*) filter (where l_linestatus = 'O') o, first(l_linestatus order by l_linenumber, l_returnflag, l_linestatus, l_quantity) first_status from orders left join lineitem on l_orderkey = o_orderkey group by all"
