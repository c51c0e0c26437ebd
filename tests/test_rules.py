"""Rules on small snippets: detectors, header direction, replies, audit, cleaning, blocks, sources."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from nodeloom.functions import text as fx
from nodeloom.operators import audit, blocks, clean, compare, detect, extract, fixtures, replies, tables
from nodeloom.operators.shred import page_text, parse, shred
from nodeloom.sources import registry


def nodes(spark, *htmls):
    return shred(spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string"))


def test_tree_rules():
    rows = parse(1, "<div><p>a<br>b</div>c</b><!-- x --><img src=a alt>")
    kinds = [(r[7], r[8], r[3]) for r in rows]
    assert kinds == [("element", "div", None), ("element", "p", 0), ("text", None, 1), ("element", "br", 1), ("text", None, 1), ("text", None, None), ("comment", None, None), ("element", "img", None)]
    assert rows[0][2] == 4 and dict(rows[7][9]) == {"src": "a", "alt": ""}


def test_null_and_empty_pages(spark):
    assert nodes(spark, None, "").count() == 0
    assert detect.findings(nodes(spark, None)).count() == 0


SNIPPETS = {
    "HTML-R-15": "<h2>Hours</h2><table><tr><td>x</td></tr></table>", "HTML-R-16": "<table><caption>c</caption><tr><td colspan=2>x</td></tr></table>", "LINK-R-02": '<p><a href="/x">こちら</a></p>',
    "LINK-R-04": '<p>mail a@b.org</p>', "LINK-R-09": '<a href="#top">up</a>', "LINK-R-08": '<a href="/other.html#top">x</a>', "IMG-R-05": '<a href="/x"><img src="i.png" alt=""></a>', "IMG-R-09": '<a href="/big.JPG?x=1"><img src="i.png"></a>',
}


@pytest.mark.parametrize("rule", SNIPPETS)
def test_detectors(spark, rule):
    found = {r.rule_id for r in detect.findings(nodes(spark, SNIPPETS[rule])).collect()}
    assert rule in found


def test_detector_details(spark):
    n = nodes(spark, '<h2>A</h2><table><caption> </caption></table><a href="mailto:a@b.org">a@b.org</a><a href="#q">x</a><i id="q"></i>')
    assert detect.caption_missing(n).first().detail == "A"
    assert detect.mail_labels(n).count() == 1 and detect.raw_addresses(n).count() == 0
    assert detect.in_page_links(n).first().summary == "target_exists"
    with pytest.raises(ValueError):
        detect.findings(n, ("HTML-R-15", "HTML-R-15"))
    long_link = "/" + "x" * 400 + "#end"
    assert detect.cross_page_links(nodes(spark, f'<a href="{long_link}">y</a>'), "http://h/p").first().detail == long_link  # values are kept whole


def grid(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def test_orientation(spark):
    columns = grid(["医療機関名", "診療科", "電話", "所在地", "受付"], ["中央病院クリニック本院", "内科", "0952-11-2222", "中央町一丁目二番三号", "9:00"], ["東", "外科", "0952-33-4444", "東町", "10:00"])
    blank = grid(["&nbsp;", "&nbsp;"], ["&nbsp;", "x"])
    found = {r.page_id: r for r in tables.orientation(nodes(spark, columns, blank)).collect()}
    assert found[0].orient == "col" and found[0].delta >= 1
    assert (found[1].orient, found[1].reason) == ("none", "blank")


def test_layout_and_nested(spark):
    n = nodes(spark, "<table><tr><td><table><caption>c</caption><tr><td>x</td></tr></table></td></tr></table>", '<table><tr><td><a href="/x.pdf">f</a></td></tr></table>', "<table><tr><td>申し込み</td></tr></table>")
    found = {(r.page_id, r.table): r.reason for r in tables.layout_reason(tables.features(n)).collect()}
    assert found == {(0, 0): "caption", (0, 3): "caption", (1, 0): "file", (2, 0): "controls"}


TABLE = "<table><caption>a caption of some length here</caption><tr><td>x</td></tr></table>"
REPLIES = {TABLE: "accepted", "<table></table>": "short_output", TABLE + "&lt;/</tr>": "broken_escaped_closing_fragment_found", TABLE + "<row>": "pseudo_row_cell_tags_found", TABLE + TABLE: "table_count", TABLE + "<td>": "table_row_or_cell_outside_table", TABLE + " done": "visible_outside_table", "<table><caption>a caption of quite some length in here</caption></table>": "no_row", "<html><body>" + TABLE + "</body></html>": "accepted", None: "short_output"}


def test_replies(spark):
    d = spark.createDataFrame([(k, v) for k, v in REPLIES.items()], "text string, expected string").withColumn("original", F.lit("<table>o</table>"))
    for r in replies.accept(d).collect():
        assert r.reason == r.expected, r.text
        assert r.html == (TABLE if r.reason == "accepted" else "<table>o</table>")


def test_audit(spark):
    htmls = ["<row>x</row>", "<td>x</td>", "<table><tr><th>a</th></tr></table>", "a\n&lt;/td&gt;", "サイト内検索", '<img src="/icon.png" alt="a">', '<a href="/x">PDF</a>', "<table><caption>表</caption><tr><th scope=col>a</th></tr><tr><td>1</td></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"]
    pages = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")
    found = {(r.page_id, r.rule_id) for r in audit.audit(pages, shred(pages)).collect()}
    assert found >= {(0, "OUT-TABLE-001"), (1, "OUT-TABLE-002"), (2, "OUT-TABLE-003"), (2, "OUT-TABLE-004"), (3, "OUT-TABLE-005"), (4, "OUT-EXTRACT-001"), (5, "OUT-ALT-001"), (6, "OUT-LINK-001"), (7, "OUT-TABLE-006"), (7, "OUT-TABLE-007")}
    assert audit.escaped_fragments(pages.where("page_id = 3")).first().line == 2
    verdicts = {r.page_id: r.verdict for r in audit.verdict(audit.audit(pages, shred(pages))).collect()}
    assert verdicts[None] == "FAIL" and verdicts[6] == "PASS"


@pytest.mark.parametrize(("metric", "p", "c", "g", "expected"), [
    ("intro_text", 0, 1, 1, "improved"), ("intro_text", 1, 0, 1, "regressed"), ("intro_text", 1, 1, 1, "stable"), ("h3_count", 0, 1, 2, "improved"), ("h3_count", 2, 1, 2, "regressed"), ("th_count", 1, 5, 3, "warning"), ("th_count", 3, 1, 3, "regressed"),
    ("menu_present", 1, 0, 0, "improved"), ("menu_present", 1, 1, 0, "warning"), ("rgb_fullwidth", 0, 1, 0, "warning"), ("rgb_fullwidth", None, 1, 0, "warning"), ("h3_count", None, 2, 2, "matches_gold"),
])
def test_verdicts(spark, metric, p, c, g, expected):
    d = spark.createDataFrame([(metric, p, c, g)], "m string, p long, c long, g long")
    assert d.select(compare.verdict(*map(F.col, "mpcg")).alias("v")).first().v == expected


def test_page_checks(spark):
    n = nodes(spark, '<h3>a</h3><h4>b</h4><p>before</p><table><caption>c</caption><thead><tr><th scope="col">x</th></tr></thead><tbody><tr><td>1</td></tr><tr><th scope="row">2</th></tr></tbody></table>')
    target = compare.target_table(n, ("c",), ())
    assert {r.check: r.level for r in compare.checks(n, target).collect()} == dict.fromkeys(["h3", "h4", "caption", "thead", "scopes", "row_scopes", "no_menu", "no_footer"], "PASS")
    assert compare.text_before(n, target).first().before == "a b before"


def test_cleaning(spark):
    html = '<div><graphic>keep</graphic><p style="width: 10px">更新：2024年1月2日</p><p style="width:5px; color:red">text</p><table border="1"><tr><td align="left"><img src="a.png" border="0"></td></tr></table></div>'
    once = clean.serialise(clean.pre_clean(nodes(spark, html))).first().html
    assert once == '<div>keep<p style="color:red">text</p><div class="layout-table"><div><div><img src="a.png"></div></div></div></div>'
    twice = clean.serialise(clean.pre_clean(nodes(spark, once))).first().html
    assert twice == once


def test_trim_keeps_a_prefix(spark):
    n = clean.trim_after_marker(clean.marked(nodes(spark, "<p>a</p><div><b>PageTop</b></div>tail<p>z</p>")))
    assert clean.serialise(n).first().html == "<p>a</p>tail"
    d = clean.marked(nodes(spark, '<p>a</p><div id="footer"><i>x</i></div>'))
    assert clean.serialise(clean.remove_subtrees(d, clean.common_roots(d))).first().html == "<p>a</p>"


def test_page_text(spark):
    assert page_text(nodes(spark, "<title>t</title><p> a <b>b</b>&amp;</p><script>x</script>")).first().text == "a b &"


def test_packing(spark):
    d = spark.createDataFrame([(["aaa", "bb", "", "cccccccccccc", "d"],)], "pieces array<string>")
    assert d.select(blocks.pack(F.col("pieces"), 5).alias("c")).first().c == ["aaabb", "ccccc", "ccccc", "ccd"]


def cut(spark, html, limit):
    return [r.html for r in blocks.structural(nodes(spark, html), limit).orderBy("block_no").collect()]


def test_structural_chunks(spark):
    table = "<table><caption>c</caption><tr><td>1</td></tr></table>"
    assert cut(spark, f"<head><title>t</title></head><body><p>a</p><p>更新：2024年01月02日</p><p>b</p><h4>d</h4>{table}<h4>e</h4>{table}<p>z</p></body>", len(table) + 11) == ["<p>a</p><p>b</p>", f"<h4>d</h4>{table}", f"<h4>e</h4>{table}", "<p>z</p>"]
    # opened elements lose their tag, their children are packed apart from what stands around; long leaves are sliced
    assert cut(spark, "<i>1</i><div><p>aaaa</p><p>bbbb</p>cc</div><i>2</i>", 22) == ["<i>1</i>", "<p>aaaa</p><p>bbbb</p>", "cc", "<i>2</i>"]
    assert cut(spark, "<p>abcdefghijklm</p>x", 5) == ["abcde", "fghij", "klm", "x"]
    assert cut(spark, "", 5) == []
    assert cut(spark, "<p>a&amp;b</p><!-- c --><br>", 100) == ["<p>a&amp;b</p><!-- c --><br>"]


def test_structural_chunks_keep_the_text(spark):
    html = "<div>" + "".join(f'<section id="s&quot;{i}"><h3>h{i} &lt;</h3><p>{"w" * (7 * i)}</p><ul><li>{i}</li><li>x</li></ul></section>' for i in range(30)) + "</div>"
    n = nodes(spark, html)
    whole = clean.serialise(clean.marked(n)).first().html
    assert {r.page_id: r.size for r in clean.written_length(n).where("pre = 0").collect()} == {0: len(whole)}
    words = lambda h: "".join(r[10] for r in parse(0, h) if r[7] == "text")
    for limit in (60, 900):
        parts = cut(spark, html, limit)
        assert max(map(len, parts)) <= limit
        assert "".join(words(p) for p in parts) == words(html)


def test_absolute_urls(spark):
    cases = [("/a", "https://h.org/d/p.html?q#f", "https://h.org/a"), ("b.html", "https://h.org/d/p.html", "https://h.org/d/b.html"), ("//x/y", "https://h.org/", "https://x/y"), ("#f", "https://h.org/p", "https://h.org/p#f"), ("mailto:a@b", "https://h.org/p", "mailto:a@b"), ("", "https://h.org/p", "")]
    for r in spark.createDataFrame(cases, "u string, b string, e string").withColumn("got", fx.absolute(F.col("u"), F.col("b"))).collect():
        assert r.got == r.e


def test_registry(spark, tmp_path):
    (tmp_path / "r.csv").write_text("municipality,url,filename,xpath,status,a,b,c,d,e,vision,f,g\nm, http://x ,,,,,,,,, on ,,\nm,http://y,y.html,,完了 ok,,,,,,,,\nm,,,,,,,,,,,,\n")
    rows = registry.pending(registry.read_registry(spark, str(tmp_path / "r.csv")), F.lit(2)).collect()
    assert [(r.url, r.filename, r.vision_flag) for r in rows] == [("http://x", "output_2.html", True)]


def test_workbook(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="対象ページ" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>URL</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row><c r="A1"><v>7</v></c></row><row><c r="A2" t="inlineStr"><is><t>No.</t></is></c><c r="C2" t="s"><v>0</v></c></row><row><c r="A3"><v>1</v></c><c r="C3" t="inlineStr"><is><t>http://x</t></is></c></row></sheetData></worksheet>')
    (tmp_path / "a.xlsx").write_bytes(out.getvalue())
    found = registry.to_records(registry.read_workbook(spark, str(tmp_path / "*.xlsx")), ["No.", "URL"]).collect()
    assert [(r["No."], r["URL"]) for r in found] == [("1", "http://x")]


def test_rules_file(spark, tmp_path):
    keys = registry.RULE_KEYS
    line = "{" + ", ".join(f'"{k}": "{{}}"' for k in keys) + "}"
    (tmp_path / "r.jsonl").write_text(line + "\n")
    assert registry.read_rules(spark, str(tmp_path / "r.jsonl")).count() == 1
    (tmp_path / "s.jsonl").write_text('{"id": "x"}\n')
    with pytest.raises(Exception, match="rule without"):
        registry.read_rules(spark, str(tmp_path / "s.jsonl")).collect()


def test_iframe_titles(spark):
    yt = "https://www.youtube.com/embed/video_"
    rows = [(1, 0, yt + "a", ""), (1, 1, yt + "b", "player"), (1, 2, "http://m", "player"), (1, 3, yt + "c", "Good（YouTube）"), (1, 4, yt + "z", "")]
    titles = spark.createDataFrame([(yt + "a", "Film - YouTube"), (yt + "b", "B"), ("http://m", "Map  page")], "src string, title string")
    found = {r.pre: (r.decision, r.new_title) for r in replies.iframe_titles(spark.createDataFrame(rows, "page_id int, pre int, src string, title string"), titles, cap=2).collect()}
    assert found == {0: ("video", "Film（YouTube）"), 1: ("video", "B（YouTube）"), 2: ("page_title", "Map page"), 3: ("kept", "Good（YouTube）"), 4: ("capped", "")}


def test_extract(spark):
    long_ = "word " * 60
    htmls = [f'<div id="x"><!-- c --><script>s</script><p>{long_}</p></div><p>no</p>', f"<body><nav><a>{long_}</a></nav><article><p>{long_}</p></article></body>", "<p>short</p>", None]
    pages = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")
    found = {r.page_id: (r.method, r.html) for r in extract.extract(pages, shred(pages), "//*[@id='x']").collect()}
    assert found == {0: ("xpath", f"<p>{long_}</p>"), 1: ("density", f"<p>{long_}</p>"), 2: ("full", "<p>short</p>"), 3: ("full", "")}
    with pytest.raises(ValueError):
        extract.parse_path("html/body[1]")


def test_fixture_checks(spark):
    files = spark.createDataFrame([("old", "b.html"), ("old", "a.html"), ("gold", "a.html")], "split string, file_name string")
    assert {r.split: (r.n, r.ok, r.first_names) for r in fixtures.inventory(files, 2).collect()} == {"old": (2, True, ["a.html", "b.html"]), "gold": (1, False, ["a.html"])}
    cases = spark.createDataFrame([("c", ["x"], ["x"], ["y"])], "id string, old_contains array<string>, gold_not_contains array<string>, required_texts array<string>")
    assert all(r.ok for r in fixtures.manifest_checks(cases, "x", "y").collect())
    rules = spark.createDataFrame([("a",), ("b",)], "id string")
    assert fixtures.rule_table_checks(rules, spark.createDataFrame([(True,)], "parses boolean"), 2).first().ok


def html_of(frame):
    return {r.page_id: r.html for r in frame.collect()}


def test_header_repair_keeps_attributes_and_is_stable(spark):
    column = "<table><tr><td class='k'>診療科</td><td>電話</td><td>住所</td></tr>" + "<tr><td>内科</td><td>0952-12-3456</td><td>市内1丁目2番</td></tr>" * 2 + "</table>"
    row = "<table>" + "".join(f"<tr><td>{w}</td><td>本文のない長い説明の文章です</td></tr>" for w in ("電話", "住所", "備考")) + "</table>"
    blank = "<table><tr><td>&nbsp;</td><td>a</td></tr><tr><td> </td><td></td></tr></table>"
    pages = [(1, column), (2, row), (3, blank), (4, "<h3> </h3><h2>News</h2><table><thead><tr><th>区分</th><th>b</th></tr></thead><tbody><tr><td>x</td><td>1</td></tr><tr><td>12</td><td>2</td></tr></tbody></table>")]
    once = html_of(clean.serialise(clean.marked(tables.fix_headers(shred(spark.createDataFrame(pages, "page_id long, html string"))))))
    assert once[1].count('scope="col"') == 3 and '<th class="k" scope="col">診療科</th>' in once[1]
    assert once[2].count('<th scope="row">') == 3 and once[3] == blank.replace("&nbsp;", "").replace("<td> </td>", "<td></td>")
    assert once[4] == '<h3></h3><h2>News</h2><table><caption>News一覧</caption><thead><tr><th scope="col">区分</th><th scope="col">b</th></tr></thead><tbody><tr><th scope="row">x</th><td>1</td></tr><tr><td>12</td><td>2</td></tr></tbody></table>'
    again = html_of(clean.serialise(clean.marked(tables.fix_headers(shred(spark.createDataFrame(list(once.items()), "page_id long, html string"))))))
    assert again == once


def test_audit_lines_and_report(spark, tmp_path):
    from nodeloom.sources import outputs

    html = "a\n本文へスキップ b 本文へスキップ\n\n<img src='x/Blank.gif' alt='z'>\n<a>PDF</a> � " + "先頭に戻る" * 5
    pages = spark.createDataFrame([(1, html), (2, "<table><caption>List</caption><tr><th scope='col'>a</th></tr></table>"), (3, None)], "page_id long, html string")
    n = shred(pages)
    issues = audit.audit(pages, n)
    found = sorted((r.rule_id, r.line) for r in issues.collect() if r.line)
    assert found == [("OUT-ALT-001", 4), *[("OUT-CMS-001", 5)] * 5, ("OUT-ENC-001", 5), *[("OUT-EXTRACT-001", 2)] * 2, ("OUT-LINK-001", 5)]
    metrics = audit.table_metrics(n).withColumn("file", F.col("page_id").cast("string")).drop("page_id")
    noise = audit.repeated_noise(pages, n).withColumn("file", F.col("page_id").cast("string"))
    status = outputs.write_audit(audit.report(issues, pages), metrics, noise, f"file://{tmp_path}/r/a.md", f"{tmp_path}/r/a.csv")
    lines = (tmp_path / "r/a.csv").read_text().splitlines()
    assert status == "FAIL" and lines[0].startswith("file,severity,rule_id") and len(lines) == issues.count() + 1 and lines[1].startswith("1,High")
    md = (tmp_path / "r/a.md").read_text()
    assert "- status: FAIL" in md and "- 1: back_links x 5" in md and "| 本文へスキップ b 本文へスキップ |" in md


def test_pages_registry_and_usage_are_written(spark, tmp_path):
    from nodeloom.operators import sidebar
    from nodeloom.sources import outputs, registry

    cleaned = spark.createDataFrame([("anjo", "a.html", "<p>é</p>"), ("anjo", "../b.html", ""), (None, "c.html", None)], "municipality string, filename string, html string")
    assert not any(r.written for r in outputs.write_pages(cleaned, f"{tmp_path}/out", dry_run=True).collect())
    assert all(r.written for r in outputs.write_pages(cleaned, f"{tmp_path}/out").collect())
    assert (tmp_path / "out/anjo/a.html").read_text() == "<p>é</p>" and (tmp_path / "out/anjo/.._b.html").exists()
    assert not any(r.written for r in outputs.write_pages(cleaned, f"{tmp_path}/out", overwrite=False).collect())
    assert not list((tmp_path / "out").rglob("_tmp*"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src/安城市.csv").write_text("\ufeffNo.,URL,ページ名,ランク\n1,http://a/1,x,A\n2.0, ,y,B\n3,http://a/1,z,\n", encoding="utf-8")
    rows = registry.collect_sources(spark, [f"{tmp_path}/src/安城市.csv"])
    assert {(r.kind, r.subject, r.n) for r in registry.source_warnings(rows).collect()} == {("empty_url", "安城市", 1), ("duplicate_url", "http://a/1", 2), ("rows", "安城市", 2), ("total", "", 2)}
    (tmp_path / "map.json").write_text('{"安城市": "//main"}', encoding="utf-8")
    slugs = spark.createDataFrame(list(registry.SLUGS.items()), "municipality string, slug string")
    outputs.write_registry(registry.registry_rows(registry.build_registry(rows, slugs), registry.read_xpath_map(spark, f"{tmp_path}/map.json")), f"{tmp_path}/registry.csv")
    text = (tmp_path / "registry.csv").read_text(encoding="utf-8")
    assert text.startswith("\ufeff自治体名,URL") and "安城市,http://a/1,anjo_003.html,//main,未完了" in text
    with pytest.raises(ValueError):
        registry.read_source(spark, f"{tmp_path}/x.txt")
    answers = spark.createDataFrame([("c", "R", "success", 5)], "candidate_id string, rule_id string, status string, totalTokenCount long")
    outputs.append_usage(sidebar.usage_entries(answers, F.current_timestamp()), f"{tmp_path}/log")
    outputs.append_usage(sidebar.usage_entries(answers, F.current_timestamp()), f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 2 and len(log.columns) == 26 and log.first().ruleId == "R"
    assert sidebar.save_settings(spark, apiKey="secret", model="m")["hasApiKey"] and "secret" not in str(sidebar.settings(spark)) and not sidebar.forget_key(spark)["hasApiKey"]


def test_paths_of_several_steps(spark):
    n = nodes(spark, "<html><body><div id='a'><p>1</p><div class='x main'><p>2</p><p>3</p></div></div><div><p>4</p></div></body></html>")
    text = lambda path: [r.brief for r in extract.matches(n, path).join(n.select("page_id", "pre", "brief"), ["page_id", "pre"]).orderBy("pre").collect()]
    assert text("/html/body/div[2]/p") == ["4"] and text("//div[@id='a']//p") == ["1", "2", "3"] and text("//div//div/p[last()]") == ["3"]
    assert text('//*[contains(@class, "main")]/p[1]') == ["2"] and text("//div[@id and starts-with(@id,'a')]/p") == ["1"] and text("//p[1]") == ["1", "2", "4"] and text("/p") == []
    assert extract.table_only(n, extract.first_match(n, "//body")).first().table_only is False
    t = nodes(spark, "<div id='t'><table><tr><td>a</td></tr></table><p> </p></div>")
    assert extract.table_only(t, extract.first_match(t, "//div")).first().table_only is True


def test_page_run_with_captured_replies(spark):
    from nodeloom.operators import process, prompts

    para = "<p>" + "本文です。" * 60 + "</p>"
    table = "<table><caption>C</caption><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>"
    pages = [(1, "http://h/x/p.html", f"<html><body><main>{para}<div id='footer'>f</div><a href='../q'>続き</a>{table}</main></body></html>"), (2, "http://h/p", f"<main>{para}<p>INDEX PAGE ITEM</p><p>{'後ろ' * 20}</p></main>"), (3, "http://h/p", None), (4, "http://h/p", f"<main>{para}<div><p>PageTop</p></div><p>z</p><img src='/i.png' alt=''></main>")]
    d = spark.createDataFrame(pages, "page_id long, url string, html string")
    fixed = table.replace("<th>", '<th scope="col">')
    reply = fixed.replace(">1<", ">one<")
    prompt = spark.range(1).select(prompts.table_prompt(F.lit(fixed)).alias("p")).first().p
    captured = spark.createDataFrame([(prompt, "```html\n" + reply + "\n```", 11)], "prompt string, text string, tokens long").select(F.sha2("prompt", 256).alias("prompt_sha256"), "text", "tokens")
    seen = spark.createDataFrame([("http://h/i.png", "絵", 5)], "src string, text string, tokens long")
    found = {r.page_id: r for r in process.process(d, "//main", captured, descriptions=seen, limit=310).collect()}
    assert ">one<" in found[1].html and found[1].tokens == 11 and 'href="http://h/q"' in found[1].html and 'id="footer"' not in found[1].html
    assert found[2].trimmed == "block" and "後ろ" not in found[2].html and "本文です" in found[2].html and found[2].dropped >= 1
    assert found[3].html == "" and found[3].n_blocks == 0
    assert found[4].trimmed == "page" and "PageTop" not in found[4].html and "z" not in found[4].html.replace("<p>", "")


def test_deep_and_unclosed_pages_stay_small(spark):
    deep = "<div>" * 3000 + "x" * 300 + "<p>y" * 3000
    n = shred(spark.createDataFrame([(1, deep)], "page_id long, html string"))
    assert n.agg(F.max(F.size("up"))).first()[0] <= 2 and n.agg(F.max(F.length("brief"))).first()[0] <= 251


def test_reply_scanner_handles_nested_commented_and_upper_case(spark):
    ok = "<TABLE><caption>a caption that is long enough</caption><TR><TD>x &amp; y</TD></TR></TABLE>"
    cases = [(ok, "accepted"), (f"<!-- <table> -->{ok}", "accepted"), (ok.replace("x", "<table></table>"), "table_count"), (f"<title>t</title>{ok}", "visible_outside_table"), (f"{ok}</td>", "table_row_or_cell_outside_table"), (f"{ok}&nbsp;", "visible_outside_table"), (None, "short_output")]
    d = spark.createDataFrame([(i, t, "o") for i, (t, _) in enumerate(cases)], "i int, text string, original string")
    found = {r.i: r for r in replies.accept(d).collect()}
    assert [found[i].reason for i in range(len(cases))] == [e for _, e in cases]
    assert found[0].html == "<table><caption>a caption that is long enough</caption><tr><td>x &amp; y</td></tr></table>" and found[6].html == "o"


def test_captured_pages_manifest_and_results(spark, tmp_path):
    from nodeloom.operators import process

    (tmp_path / "html/sub").mkdir(parents=True)
    (tmp_path / "html/a.html").write_text("<p>a</p>\n<p>b</p>", encoding="utf-8")
    (tmp_path / "html/sub/b.htm").write_text("<p>c</p>", encoding="utf-8")
    (tmp_path / "html/c.txt").write_text("no", encoding="utf-8")
    assert {r.file_name: r.html for r in registry.read_pages(spark, f"{tmp_path}/html").collect()} == {"a.html": "<p>a</p>\n<p>b</p>", "b.htm": "<p>c</p>"}
    (tmp_path / "manifest.json").write_text('{\n "fixture": "f",\n "cases": [{"id": "1", "required_texts": ["a", "z"]}]\n}', encoding="utf-8")
    cases = registry.read_manifest(spark, f"{tmp_path}/manifest.json")
    assert [(r.id, r.text, r.ok) for r in fixtures.manifest_checks(cases, "", "abc").orderBy("text").collect()] == [("1", "a", True), ("1", "z", False)]
    done = spark.createDataFrame([(3, 10, 2, 1, 0.0)], "page_id long, tokens long, vision_tokens long, vision_calls long, cost double")
    sheet = spark.createDataFrame([(3, *["" for _ in range(8)], "ON"), (4, *["" for _ in range(8)], "OFF")], "sheet_row long, status string, started_at string, ended_at string, total_tokens string, cost string, version string, vision_tokens string, vision_calls string, vision_flag string")
    back = {r.sheet_row: r for r in registry.write_back(sheet, process.finished(done, sheet, "v", F.lit("s"), F.lit("e"))).collect()}
    assert (back[3].status, back[3].total_tokens, back[3].vision_flag, back[4].status) == ("完了", "12", "ON", "")


def test_report_order_and_urls(spark):
    d = spark.createDataFrame([(1, "Medium", "B", 1, ""), (2, "Critical", "C", 9, ""), (1, "High", "A", None, ""), (1, "High", "B", 1, "")], "page_id long, severity string, rule_id string, line int, message string")
    assert [(r.severity, r.page_id, r.line) for r in audit.report_order(d).collect()] == [("Critical", 2, 9), ("High", 1, None), ("High", 1, 1), ("Medium", 1, 1)]
    from urllib.parse import urljoin

    base = "http://h/a/b/c.html?q=1#g"
    for ref in ("x", "./x", "../x?y#z", "../../../x", "/w/./y/..", "//o/p", "#f", "?z", "..", ".", "a/../b/", "mailto:x@y", "", "http://z/../k"):
        found = spark.range(1).select(fx.absolute(F.lit(ref), F.lit(base)).alias("u")).first().u
        assert found == (urljoin(base, ref) if ref else ""), ref
