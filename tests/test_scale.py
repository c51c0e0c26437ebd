"""Steps whose cost must not grow faster than the tables: pages of one markup, versions of a page, edits of headers."""

import random

import pytest
from pyspark.sql import functions as F

from nodeloom.operators import clean, compare, shred, tables

COLUMNS = tuple(f.name for f in shred._ARROW)


def nodes(ids, htmls, only="every"):
    return sorted(tuple(repr(v) for v in r.values()) for b in shred._shredded(ids, htmls, COLUMNS, only) for r in b.to_pylist())


def test_pages_of_one_markup_are_parsed_once(monkeypatch):
    monkeypatch.setattr(shred, "_TEMPLATES", shred.Templates())
    calls, parse = [], shred.parse
    monkeypatch.setattr(shred, "parse", lambda page, html: calls.append(html) or parse(page, html))
    pages = [f"<h2>Title {i}</h2><table><tr><td>{i} x</td><td> <b>y</b>{'z' * (i + 1)}</td></tr></table>" for i in range(300)]
    found = nodes(list(range(300)), pages)
    assert len(calls) == 2
    assert found == sorted(tuple(map(repr, r)) for i, h in enumerate(pages) for r in parse(i, h))


@pytest.mark.parametrize("only", shred.KEPT)
def test_templates_give_the_nodes_of_the_parser(monkeypatch, only):
    monkeypatch.setattr(shred, "_TEMPLATES", shred.Templates())
    monkeypatch.setattr(shred, "TRIAL", 10**9)
    rng = random.Random(7)
    parts = '<div>|</div>|<p class="a>b<c">|</p>|text|  x y |<td>|<tr>|<table>|</table>|</td>|&amp;|a > b|\n|<br>|<!-- a>b<c -->|<script>|</script>|v>w<u|<a href="x">|</a>|<caption>|</caption>|<title>|</title>|<th scope=col>|　|<thead>|<tbody>|</tr>|<h3>|</h3>|<td/>|<|<textarea>|</textarea>|</ >t<'.split("|") + ["long " * 70]
    pages = []
    for _ in range(400):
        some = [rng.choice(parts) for _ in range(rng.randint(1, 14))]
        pages += ["".join(x if x[0] in "<&\n" else x + rng.choice(["", "q", "zz z"]) for x in some) for _ in range(3)]
    expected = sorted(tuple(map(repr, r)) for i, h in enumerate(pages) if h for r in shred.parse(i, h) if shred.KEPT[only](r))
    assert nodes(list(range(len(pages))), pages, only) == expected
    assert shred._TEMPLATES.hits > 100


def test_edits_are_counted_as_they_are_made(spark):
    rng = random.Random(3)
    cell = lambda: rng.choice(['<td>電話</td>', "<td>12</td>", "<td>内科</td>", '<th scope="row">区分</th>', "<th>備考</th>", '<td colspan="2">0952-12-3456</td>', "<td><table><thead><tr><th>a</th></tr></thead></table></td>", "<td></td>"])
    row = lambda: "<tr>" + "".join(cell() for _ in range(rng.randint(0, 3))) + "</tr>"
    part = lambda tag: f"<{tag}>{''.join(row() for _ in range(rng.randint(0, 3)))}</{tag}>"
    pages = [(i, rng.choice(["", "<h3>お知らせ</h3>"]) + "<table>" + rng.choice(["", "<caption>c</caption>"]) + "".join(rng.choice([part("thead"), part("tbody"), row()]) for _ in range(rng.randint(1, 4))) + "</table>") for i in range(400)]
    whole = shred.shred(spark.createDataFrame(pages, "page_id long, html string")).localCheckpoint()
    edits = tables._edits(whole, tables.header_plan(whole)).where("edit is not null")
    made = {(r.page_id, r["_table"], r.edit): r.n for r in edits.groupBy("page_id", "_table", "edit").agg(F.count("*").alias("n")).collect()}
    found = {}
    for r in tables.header_fix(whole).collect():
        for kind, n in (("head_col", r.col_scopes_added), ("body_row", r.row_headers), ("orient", r.oriented)):
            if n:
                found[r.page_id, r.table, kind] = n
    assert found == {(p, t, k.split("_")[0] if k.startswith("orient") else k): n for (p, t, k), n in made.items()}
    assert {k for _, _, k in found} == {"head_col", "body_row", "orient"}


def test_repair_joins_pages_not_nodes(spark):
    pages = spark.createDataFrame([(i, f"<h3>h{i}</h3><table><thead><tr><th>時間</th><th>b</th></tr></thead><tbody><tr><td>a</td><td><table><tr><td>x</td></tr></table></td></tr></tbody></table><p>{i}</p>") for i in range(50)] + [(99, "<p>none</p>"), (None, "<b>x</b>")], "page_id long, html string")
    plan = tables.header_plan(*tables.header_nodes(pages))
    written = clean.serialise(clean.marked(tables.planned(shred.shred(tables.with_plans(pages, plan), *clean.REPAIRED))), ordered=True)
    tree = written._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tree[: tree.index("Join")]  # what stands above the join of pages
    expected = clean.serialise(clean.marked(tables.fix_headers(shred.shred(pages))))
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(written) == key(expected)


def test_versions_are_compared_in_one_row_a_page(spark):
    pages = [("previous", 1, "<h3>a</h3>"), ("current", 1, "<h3>a</h3><h3>b</h3><a href='#menu'>m</a>"), ("gold", 1, "<h3>a</h3><h3>b</h3>"), ("current", 2, None), ("gold", 2, "<footer>x</footer>")]
    versions = spark.createDataFrame(pages, "split string, page_id long, html string")
    wide = {r.page_id: r for r in compare.version_values(versions).collect()}
    assert (wide[1].previous_h3_count, wide[1].current_h3_count, wide[1].current_menu_present, wide[1].gold_menu_present) == (1, 2, 1, 0)
    assert (wide[2].previous_h3_count, wide[2].current_h3_count, wide[2].gold_footer_present) == (None, 0, 1)
    long = compare.compare(compare.version_metrics(versions), "page_id")
    key = lambda df: sorted(map(tuple, df.select("page_id", "metric", "previous", "current", "gold", "verdict").collect()), key=repr)
    assert key(compare.compare_versions(versions)) == key(long)


@pytest.mark.parametrize("bounded", [False, True])
def test_pages_are_cleaned_as_their_nodes_are(spark, bounded):
    rng = random.Random(11)
    some = [
        "<p>更新：2024年1月2日</p>", "<div>更新：2024年1月2日<b></b></div>", '<a href="x.pdf">a [PDF：12KB]  b</a>', "<p>BASIC_PARTS_SET note</p>", '<img src="i.png" style="width: 3px; color: red" border=0>', "<graphic>g</graphic>", "PageTop", "<div id='bg'>x<p>y</p></div>",
        "<h3>電話</h3>", "<table><tr><td><img src=a></td><td>更新：2024年1月2日</td></tr></table>", "<table><thead><tr><th>時間</th><th>b</th></tr></thead><tbody><tr><td>a</td><td><table border=1><tr><td><img></td></tr></table></td></tr></tbody></table>", "<ul><li>footer", "text &amp; more", "<!-- c -->",
        "<table><tr><td>診療科</td><td>電話</td></tr><tr><td>内科</td><td>0952-12-3456</td></tr></table>", "<table><tr><td colspan=2><iframe src=v></iframe><table><tr><th>q</th></tr></table></td></tr></table>",
    ]
    pages = spark.createDataFrame([(i, "".join(rng.choice(some) for _ in range(rng.randint(1, 6)))) for i in range(300)] + [(1000, None), (1001, "")], "page_id long, html string")
    base = F.lit("http://h/b/c.html") if bounded else None
    nodes = shred.shred(pages).localCheckpoint()
    expected = clean.serialise(clean.clean_page(nodes, base) if bounded else clean.pre_clean(nodes))
    found = clean.clean_pages(pages, base, bounded)
    tree = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tree[: tree.index("Join")]  # nothing is shuffled above the join of pages
    key = lambda df: {r.page_id: r.html for r in df.collect()}
    assert key(found) == key(expected)


def test_references_without_a_semicolon_are_text(spark, tmp_path):
    import duckdb

    from nodeloom.plans.queries import ORACLE_SQL, QUERIES

    pages = [(1, "u", "<p>token = &quot Ones &amp more &amp; &quot;x&quot; &copy; &middot</p>"), (2, "u", "<p>a&am</p><p>&copy2024 &q"), (3, "u", '<a href="/x?a=1&copy=2">&middot; b</a>')]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert {r.page_id: r.text for r in QUERIES["q64_page_text"](spark, str(tmp_path)).collect()} == dict(c.execute(ORACLE_SQL["q64_page_text"]).fetchall())
