"""Named queries over repairs, runs, reports, prompts, sources and the review of single candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from nodeloom.operators import clean, compare, extract, fixtures, process, prompts, replies, sidebar, tables
from nodeloom.operators.shred import materialise, shred
from nodeloom.plans import render
from nodeloom.plans.catalog import BARE, ROWS, header_nodes, order_nodes, page_nodes, query, table
from nodeloom.sources import outputs, registry

_KINDS = "select o_orderkey as page_id, o_orderkey % 4 as k, n from (select o_orderkey, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by 1)"


@query("q68_header_direction", f"""
    with t as ({_KINDS})
    select page_id, case k when 0 then case when n > 0 then 'col' else 'few_rows' end when 1 then case when n > 1 then 'row' else 'few_rows' end when 2 then case when n > 1 then 'blank' else 'few_rows' end else 'thead' end as reason,
           round_even(case k when 0 then case when n > 0 then 5.0 else 4.0 end when 1 then case when n > 1 then 3.0 else 2.5 end when 2 then 2.0 / 3 else case when n > 0 then 1.5 + case when n > 1 then 0.5 else 0 end end end, 3)::double as col_score,
           round_even(case k when 0 then case when n > 0 then (4.0 + 2 * n) / (n + 1) + 1.0 + case when n > 4 then 0.5 else 0 end else 4.0 end when 1 then 4.5 when 2 then 2.0 else 2.0 + 0.5 end, 3)::double as row_score
    from t where n > 0 or k = 0
""")
def header_direction(spark, sf_dir):
    """Direction of the headers of tables without scopes, with both scores."""
    return tables.orientation(*header_nodes(render.header_tables(spark, sf_dir))[:2]).select("page_id", "reason", "col_score", "row_score")


@query("q69_header_repair", f"""
    with t as ({_KINDS})
    select page_id, (case when k = 0 and n > 0 then 3 when k = 3 then 1 else 0 end)::bigint as cols, (case when k = 1 and n > 1 or k = 3 then n else 0 end)::bigint as rows, case when k = 3 then 'お知らせ一覧' else '' end as caption,
           (case when k = 3 then n else 0 end)::bigint as kept_classes from t
""")
def header_repair(spark, sf_dir):
    """Tables after repair, as written HTML: promoted cells with their scopes and attributes, inserted captions."""
    pages = materialise(render.header_tables(spark, sf_dir))
    nodes = shred(tables.with_plans(pages, tables.header_plan(*tables.header_nodes(pages))), *clean.REPAIRED)
    written = clean.serialise(clean.marked(tables.planned(nodes)), ordered=True)
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    return written.select("page_id", n('<th scope="col">').alias("cols"), n('<th[^>]* scope="row"[^>]*>').alias("rows"), F.regexp_extract("html", "<caption>([^<]*)</caption>", 1).alias("caption"), n('<th class="f" scope="row">').alias("kept_classes"))


@query("q70_table_identity", "select o_orderkey as page_id, case o_orderkey % 3 when 0 then 'id=t' || o_orderkey when 1 then 'data-key=k' || o_orderkey else 'dom_index=2' end as identity from orders union all select o_orderkey, 'dom_index=1' from orders where o_orderkey % 3 = 2")
def table_identity(spark, sf_dir):
    key, k = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    html = F.when(k == 0, F.concat(F.lit('<table id="t'), key, F.lit('" data-x="1"></table>'))).when(k == 1, F.concat(F.lit('<table class="c" data-key="k'), key, F.lit('"></table>'))).otherwise("<table id=''></table><table data-a></table>")
    return tables.table_identity(shred(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html")))).select("page_id", "identity")


@query("q71_page_run")
def page_run(spark, sf_dir):
    """The whole run over pages: main content, chunks, cleaning, end trim, merge, totals. Held against single pages in the tests."""
    out = process.process(table(spark, sf_dir, "pages"), "//article", limit=2000)
    return out.select("page_id", "method", "n_blocks", "dropped", "trimmed", "calls", "tokens", F.length("html").cast("long").alias("n_chars"), "cost")


@query("q72_paths", f"""
    select page_id, case when contains(bare, '<article>') then len(regexp_extract_all(regexp_extract(bare, '<article>(.*)$', 1, 's'), '<p>'))::bigint end as paragraphs, len(regexp_extract_all(regexp_extract(bare, '<nav>(.*?)</nav>', 1, 's'), '<li>'))::bigint as items, 1::bigint as first_item, 1::bigint as last_item from ({BARE})
""")
def paths(spark, sf_dir):
    """Elements that paths of several steps select, with positions."""
    n = materialise(page_nodes(spark, sf_dir))
    counted = lambda path, name: extract.matches(n, path).groupBy("page_id").agg(F.count("*").alias(name))
    out = n.select("page_id").distinct()
    for path, name in (("//article//p", "paragraphs"), ("//nav/ul/li", "items"), ("//nav/ul/li[1]", "first_item"), ("//nav/ul/li[last()]", "last_item")):
        out = out.join(counted(path, name), "page_id", "left")
    return out


@query("q73_needs_normalising", "select event_id, event_type <> 'view' or user_id % 10 in (0, 1, 3) as needs from events")
def needs_normalising(spark, sf_dir):
    """Which texts hold notation that is to be normalised."""
    t, k = F.col("event_type"), F.col("user_id") % 10
    one = F.when(k == 0, "at 9:30 h").when(k == 1, "2024/1/2").when(k == 2, "a:30 9:3").when(k == 3, "（月）").otherwise("plain 2024-01-02")
    text = F.when(t == "view", one).when(t == "click", "５階").when(t == "error", "日　時").when(t == "signup", "（R6.1.2） ㎡").otherwise("PDF ファイル：")
    return table(spark, sf_dir, "events").select("event_id", prompts.needs_normalising(text).alias("needs"))


@query("q74_image_kinds", "select p_partkey, case p_partkey % 4 when 0 then 'image/png' when 1 then 'image/webp' when 2 then 'image/gif' else 'image/jpeg' end as mime from part")
def image_kinds(spark, sf_dir):
    ending = F.element_at(F.array(*map(F.lit, (".PNG", ".webp", ".Gif", ".png?v=1"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", replies.image_mime(F.concat(F.lit("http://h/"), "p_name", ending)).alias("mime"))


@query("q75_applied_alts", "select s_nationkey::bigint as page_id, string_agg('<img src=\"/i' || s_suppkey || '.png\" alt=\"' || case when s_suppkey % 3 = 0 then 'old' else s_name || '。' end || '\">', '' order by s_suppkey) as html from supplier group by 1")
def applied_alts(spark, sf_dir):
    """Captured descriptions written into pages; images without one keep their text."""
    key = F.col("s_suppkey").cast("string")
    img = F.concat(F.lit('<img src="/i'), key, F.lit('.png" alt="old">'))
    s = table(spark, sf_dir, "supplier")
    pages = s.groupBy(F.col("s_nationkey").cast("long").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", img.alias("img")))), lambda x: x["img"]), "").alias("html"))
    nodes = materialise(shred(pages))
    told = s.where("s_suppkey % 3 <> 0").select(F.concat(F.lit("/i"), key, F.lit(".png")).alias("src"), F.concat(F.lit('"'), "s_name", F.lit('"')).alias("text"), F.lit(7).alias("tokens"))
    seen = replies.described(replies.image_targets(nodes, per_page=10_000), told)
    return clean.serialise(clean.marked(replies.apply_alts(nodes, seen.where("new_alt is not null").select("page_id", "img_index", F.col("new_alt").alias("alt")))))


@query("q76_reply_details", """
    select s_suppkey, 'tables_found=' || case s_suppkey % 3 when 0 then 1 else 0 end || ' has_non_table_elements=' || case s_suppkey % 3 when 1 then 'Y' else 'N' end || ' non_table_tags_sample=' || case s_suppkey % 3 when 1 then 'p,b' else '' end
           || ' non_table_text_len=' || case s_suppkey % 3 when 0 then 0 when 1 then length(s_name) else 1 end || ' table_shape_ok=' || case s_suppkey % 3 when 0 then 'Y' else 'N' end
           || ' unsafe_reason=' || ' stray_table_cell_tags=' || case s_suppkey % 3 when 2 then 'td,th' else '' end || ' raw_head=' || case s_suppkey % 3 when 0 then '<table><tr><th>' || s_name || '</th></tr></table>' when 1 then '<p><b>' || s_name || '</b></p>' else '<th>x</td>' end as detail from supplier
""")
def reply_details(spark, sf_dir):
    k = F.col("s_suppkey") % 3
    text = F.when(k == 0, F.concat(F.lit("<table><tr><th>"), "s_name", F.lit("</th></tr></table>"))).when(k == 1, F.concat(F.lit("<p><b>"), "s_name", F.lit("</b></p>"))).otherwise("<th>x</td>")
    s = replies.scanned(table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")))
    return s.select("s_suppkey", replies.reply_detail(F.col("scan"), F.lit(""), F.col("text")).alias("detail"))


@query("q77_page_summary", "select page_id, step, calls, tokens, row_number() over (partition by page_id order by tokens desc, step)::int as place from (select user_id as page_id, event_type as step, count(*)::bigint as calls, sum(event_id)::bigint as tokens from events group by all) where tokens > 0")
def page_summary(spark, sf_dir):
    """Steps of each page by their tokens."""
    usage = table(spark, sf_dir, "events").select(F.col("user_id").alias("page_id"), F.col("event_type").alias("step"), F.lit(1).cast("long").alias("calls"), F.col("event_id").cast("long").alias("tokens"))
    return outputs.page_summary(usage)


@query("q78_check_summary", """
    with f as (select c_custkey, c_custkey % 3 as k, c_mktsegment = 'BUILDING' as bad, c_acctbal < 0 as warned from customer)
    select count(*)::bigint as files, count(*) filter (where k < 2)::bigint as checked, count(*) filter (where k < 2 and not bad)::bigint as passed, count(*) filter (where k < 2 and bad)::bigint as failed, count(*) filter (where k < 2 and warned)::bigint as warnings, count(*) filter (where k = 2)::bigint as skipped,
           (count(*) filter (where k < 2 and bad) > 0)::int as exit_code from f
""")
def check_summary(spark, sf_dir):
    """Files that page checks are meant for, their outcome, and the exit code."""
    key = F.col("c_custkey").cast("string")
    k = F.col("c_custkey") % 3
    path = F.when(k == 0, F.concat(F.lit("x"), key, F.lit("/ai/y/sg02395_0820.html"))).when(k == 1, F.concat(F.lit("x"), key, F.lit("/14256.html"))).otherwise(F.concat(F.lit("x"), key, F.lit("/old/sg02395.html")))
    c = table(spark, sf_dir, "customer").withColumn("path", path)
    results = c.select("path", F.when(F.col("c_mktsegment") == "BUILDING", "FAIL").otherwise("PASS").alias("level")).unionByName(c.where("c_acctbal < 0").select("path", F.lit("WARNING").alias("level")))
    return compare.check_summary(compare.check_targets(c.select("path")), results)


@query("q79_source_warnings", """
    with s as (select s_nationkey::varchar as m, case when s_suppkey % 7 = 0 then '' else 'u' || (s_suppkey % 50) end as url from supplier)
    select 'empty_url' as kind, m as subject, count(*)::bigint as n from s where url = '' group by m union all select 'duplicate_url', url, count(*)::bigint from s where url <> '' group by url having count(*) > 1
    union all select 'rows', m, count(*)::bigint from s where url <> '' group by m having count(*) <> 3 union all select 'total', '', count(*)::bigint from s where url <> '' having count(*) <> 250
""")
def source_warnings(spark, sf_dir):
    """What is odd about source sheets; no row is dropped for it but those without a URL."""
    url = F.when(F.col("s_suppkey") % 7 == 0, " ").otherwise(F.concat(F.lit("u"), (F.col("s_suppkey") % 50).cast("string")))
    return registry.source_warnings(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("municipality"), F.col("s_suppkey").alias("no"), url.alias("url")), each=3)


@query("q80_registry_rows", """
    select n_name as municipality, 'http://h/' || s_suppkey as url, 'n' || s_nationkey || '_' || lpad(s_suppkey::varchar, greatest(3, length(s_suppkey::varchar))::int, '0') || '.html' as filename, case when s_nationkey % 2 = 0 then '//main' else '//body' end as xpath, '未完了' as status, 'ON' as vision
    from supplier join nation on n_nationkey = s_nationkey
""")
def registry_rows(spark, sf_dir):
    """Registry rows built from sources, slugs and a map of paths."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("municipality"))
    slugs = nation.select("municipality", F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("slug"))
    rows = table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select("municipality", F.col("s_suppkey").alias("no"), F.concat(F.lit("http://h/"), F.col("s_suppkey").cast("string")).alias("url"))
    xpaths = nation.where("s_nationkey % 2 = 0").select("municipality", F.lit("//main").alias("xpath"))
    out = registry.registry_rows(registry.build_registry(rows, slugs), xpaths, "//body", "ON")
    h = registry.REGISTRY_HEADERS
    return out.select(*[F.col(f"`{h[i]}`").alias(a) for i, a in ((0, "municipality"), (1, "url"), (2, "filename"), (3, "xpath"), (4, "status"), (10, "vision"))])


@query("q81_write_back", """
    select c_custkey as sheet_row, case when c_custkey % 2 = 0 then '完了' else '未完了' end as status, case when c_custkey % 2 = 0 then '¥' || (c_custkey % 100)::varchar else '' end as cost, case when c_acctbal > 0 then 'ON' else 'OFF' end as vision_flag, case when c_custkey % 2 = 0 then c_nationkey::varchar else '' end as vision_calls from customer
""")
def write_back(spark, sf_dir):
    """Results written back onto their registry rows; rows without a result and the flag for images stay."""
    c = table(spark, sf_dir, "customer")
    blank = F.lit("")
    sheet = c.select(F.col("c_custkey").alias("sheet_row"), F.lit(registry.OPEN).alias("status"), *[blank.alias(n) for n in ("started_at", "ended_at", "total_tokens", "cost", "version", "vision_tokens", "vision_calls")], F.when(F.col("c_acctbal") > 0, "ON").otherwise("OFF").alias("vision_flag"))
    done = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("sheet_row"), F.lit(registry.DONE).alias("status"), *[blank.alias(n) for n in ("started_at", "ended_at", "total_tokens", "version", "vision_tokens")], F.concat(F.lit("¥"), (F.col("c_custkey") % 100).cast("string")).alias("cost"), F.col("c_nationkey").cast("string").alias("vision_calls"))
    return registry.write_back(sheet, done).select("sheet_row", "status", "cost", "vision_flag", "vision_calls")


@query("q82_rule_table", """
    select * from (values ('HTML-R-08', 1, 'detect-only', 'medium', true), ('HTML-R-15', 2, 'review-candidate', 'low', true), ('HTML-R-16', 3, 'detect-only', 'high', true), ('HTML-W-02', 4, 'detect-only', 'high', true), ('HTML-R-21', 5, 'detect-only', 'medium', true),
        ('LINK-R-02', 6, 'review-candidate', 'medium', true), ('LINK-R-03', 7, 'not-implemented', 'medium', false), ('LINK-R-04', 8, 'review-candidate', 'medium', true), ('LINK-R-06', 9, 'detect-only', 'medium', true), ('LINK-R-08', 10, 'review-candidate', 'low', true),
        ('LINK-R-09', 11, 'review-candidate', 'low', true), ('IMG-R-05', 12, 'review-candidate', 'medium', true), ('IMG-W-01', 13, 'manual-llm', 'medium', true), ('IMG-W-02', 14, 'review-candidate', 'low', true), ('IMG-R-09', 15, 'review-candidate', 'medium', true), ('SKIP-04', 16, 'review-candidate', 'high', true)
    ) t(id, place, mode, risk, enabled)
""")
def rule_table(spark, sf_dir):
    """The sidebar's rules with order, state and what they ask for."""
    return sidebar.rules(spark).select("id", F.col("order").alias("place"), "mode", "risk", "enabled")


@query("q83_rule_targets", f"""
    with n as (select sum(len(regexp_extract_all(bare, '<table[ >]')))::bigint as t, sum(len(regexp_extract_all(bare, '<a[ >]')))::bigint as a, sum(len(regexp_extract_all(bare, '<img[ >]')))::bigint as i, sum(len(regexp_extract_all(bare, '<iframe[ >]')))::bigint as f, count(*)::bigint as b from ({BARE}))
    select id, case target when 'table' then t when 'a' then a when 'body' then b when 'iframe' then f when 'img' then i else 0 end as n
    from n, (values ('HTML-R-08', 'body'), ('HTML-R-15', 'table'), ('HTML-R-16', 'table'), ('HTML-W-02', 'table'), ('HTML-R-21', 'body'), ('LINK-R-02', 'a'), ('LINK-R-03', 'a'), ('LINK-R-04', 'a'), ('LINK-R-06', 'a'), ('LINK-R-08', 'a'), ('LINK-R-09', 'a'),
        ('IMG-R-05', 'a img'), ('IMG-W-01', 'img'), ('IMG-W-02', 'iframe'), ('IMG-R-09', 'a'), ('SKIP-04', 'body')) r(id, target)
""")
def rule_targets(spark, sf_dir):
    """How many elements each rule's target names over all pages."""
    return sidebar.tag_counts(page_nodes(spark, sf_dir), sidebar.rules(spark))


@query("q84_manual_prompts", """
    select s_suppkey, 'Improve the accessibility candidate below. Answer with JSON only, with short texts and never with a whole page.' || chr(10) || 'Rule: ' || r || chr(10) || 'Input: {"text":"' || s_name || '"}' || chr(10)
           || 'Output: {"ruleId":"' || r || '","replacementText":"optional","alt":"optional","caption":"optional","title":"optional","altAssessment":"optional","suggestedAlt":"optional","reason":"required"}' as prompt
    from (select *, case s_suppkey % 2 when 0 then 'LINK-R-02' else 'UNKNOWN' end as r from supplier)
""")
def manual_prompts(spark, sf_dir):
    payload = F.to_json(F.struct(F.col("s_name").alias("text")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", sidebar.manual_prompt(F.when(F.col("s_suppkey") % 2 == 0, "LINK-R-02"), payload).alias("prompt"))


@query("q85_api_answers", """
    select conv_id * 1000 + turn as candidate_id, case turn % 6 when 0 then 'success' when 1 then 'validation_error' when 5 then 'success' else 'error' end as status,
           case turn % 6 when 0 then '' when 1 then 'wrong_rule' when 2 then 'response code 503' when 3 then 'no response' when 4 then 'unsupported rule' else '' end as error,
           case when turn % 6 in (0, 1, 5) then conv_id else -1 end as prompt_tokens, (case when turn % 6 in (0, 1, 5) then 3 else -1 end)::bigint as total_tokens from conversations
""")
def api_answers(spark, sf_dir):
    """Captured responses to single candidates: checked, with their usage."""
    k, key = F.col("turn") % 6, (F.col("conv_id") * 1000 + F.col("turn"))
    c = table(spark, sf_dir, "conversations").select(key.alias("candidate_id"), F.when(k == 4, "HTML-R-16").otherwise("IMG-R-05").alias("rule_id"), k.alias("k"), "conv_id")
    reply = F.when(F.col("k") == 1, '{"ruleId":"X","alt":"a"}').when(F.col("k") == 5, '```json\n{"ruleId":"IMG-R-05","caption":"a"}\n```').otherwise('{"ruleId":"IMG-R-05","alt":"a"}')
    usage = F.struct(F.col("conv_id").alias("promptTokenCount"), F.lit(1).alias("candidatesTokenCount"), F.lit(3).alias("totalTokenCount"))
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(reply.alias("text"))).alias("parts")).alias("content"))).alias("candidates"), usage.alias("usageMetadata"), F.lit("r1").alias("responseId")))
    responses = c.where("k <> 3").select("candidate_id", F.when(F.col("k") == 2, 503).otherwise(200).alias("code"), body.alias("body"))
    out = sidebar.answered(c.select("candidate_id", "rule_id"), responses)
    return out.select("candidate_id", "status", "error", F.coalesce("promptTokenCount", F.lit(-1)).alias("prompt_tokens"), F.coalesce("totalTokenCount", F.lit(-1)).alias("total_tokens"))


@query("q86_usage_cost", """
    select event_id, case event_type when 'view' then 'estimate made by hand' when 'click' then 'estimate made by hand' else 'pricing not configured' end as note,
           round(case event_type when 'view' then event_id / 1e6 * 0.3 + (user_id + 2) / 1e6 * 2.5 when 'click' then event_id / 1e6 * 0.1 + (user_id + 2) / 1e6 * 0.4 end, 9)::double as usd,
           round(case event_type when 'view' then event_id / 1e6 * 0.3 + (user_id + 2) / 1e6 * 2.5 when 'click' then event_id / 1e6 * 0.1 + (user_id + 2) / 1e6 * 0.4 end * 150, 6)::double as jpy, 0.0::double as free from events
""")
def usage_cost(spark, sf_dir):
    """Cost of calls by listed prices; models without a price stay blank, the free mode costs nothing."""
    t = F.col("event_type")
    model = F.when(t == "view", "gemini-2.5-flash").when(t == "click", "gemini-2.5-flash-lite").otherwise("other")
    usage = table(spark, sf_dir, "events").select("event_id", F.lit("gemini").alias("provider"), model.alias("model"), F.col("event_id").alias("promptTokenCount"), F.col("user_id").alias("candidatesTokenCount"), F.lit(2).cast("long").alias("thoughtsTokenCount"))
    prices = spark.createDataFrame(list(sidebar.PRICES), "provider string, model string, usd_in double, usd_out double")
    free = sidebar.priced(usage, prices, "free").select("event_id", F.col("estimatedUsd").alias("free"))
    return sidebar.priced(usage, prices).join(free, "event_id").select("event_id", "note", F.round("estimatedUsd", 9).alias("usd"), F.round("estimatedJpy", 6).alias("jpy"), "free")


@query("q87_image_parts", """
    select s_suppkey, case s_suppkey % 6 when 0 then 'text_only' when 1 then 'image_inline' when 2 then 'image_inline' when 3 then 'image_url' else 'image_unresolved' end as image_mode,
           case s_suppkey % 6 when 1 then 'image/gif' when 2 then 'image/svg+xml' when 3 then case when s_suppkey % 12 = 3 then 'image/png' else 'image/jpeg' end else '' end as image_mime,
           case s_suppkey % 6 when 1 then 'QUJD' when 2 then 'YSBi' when 3 then 'eHl6' end as image_base64 from supplier
""")
def image_parts(spark, sf_dir):
    """Images of candidates: none, data URIs, captured files, and what cannot be resolved."""
    k, key = F.col("s_suppkey") % 6, F.col("s_suppkey").cast("string")
    src = F.when(k == 1, "data:image/gif;base64,QUJD").when(k == 2, "data:image/svg+xml,a%20b").when(k == 3, F.concat(F.lit("i/"), key, F.lit(".jpg"))).when(k == 4, "nowhere.png").otherwise("")
    s = table(spark, sf_dir, "supplier").withColumn("src", src)
    c = s.select("s_suppkey", F.when(k == 0, "LINK-R-02").otherwise("IMG-W-01").alias("rule_id"), "src", F.lit("http://h/a/b.html").alias("base_url"))
    images = s.where("s_suppkey % 6 = 3").select(F.concat(F.lit("http://h/a/"), "src").alias("url"), F.when(F.col("s_suppkey") % 12 == 3, "image/png").otherwise("").alias("mime"), F.lit("xyz").cast("binary").alias("bytes"))
    return sidebar.image_part(c, images).select("s_suppkey", "image_mode", "image_mime", "image_base64")


@query("q88_usage_log", "select event_id::varchar as \"candidateId\", 'unknown' as \"userEmail\", event_type as status, user_id as \"promptTokenCount\", '' as error, 26 as columns from events")
def usage_log(spark, sf_dir):
    """Rows of the usage log with all its columns."""
    answers = table(spark, sf_dir, "events").select(F.col("event_id").alias("candidate_id"), F.col("event_type").alias("status"), F.col("user_id").alias("promptTokenCount"))
    log = sidebar.usage_entries(answers, F.lit("2024-01-02 03:04:05").cast("timestamp"))
    return log.select("candidateId", "userEmail", "status", "promptTokenCount", "error", F.lit(len(log.columns)).alias("columns"))


@query("q89_inventory", "select c_mktsegment as split, count(distinct c_custkey)::bigint as n, count(*) = 300 as ok, min('f' || lpad(c_custkey::varchar, 8, '0') || '.html') as first_name from customer group by 1")
def inventory(spark, sf_dir):
    files = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("split"), F.concat(F.lit("f"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit(".html")).alias("file_name"))
    return fixtures.inventory(files, 300).select("split", "n", "ok", F.col("first_names")[0].alias("first_name"))


@query("q90_dot_segments", "select s_suppkey, case s_suppkey % 5 when 0 then 'http://h/a/x' || s_suppkey when 1 then 'http://h/x?q' when 2 then 'http://h/a/b/#f' when 3 then 'http://h/y' else 'http://h/a/b/c.html?z=1' end as url from supplier")
def dot_segments(spark, sf_dir):
    """References joined to a base, with segments that lead up."""
    from nodeloom.functions import text as fx

    k, key = F.col("s_suppkey") % 5, F.col("s_suppkey").cast("string")
    ref = F.when(k == 0, F.concat(F.lit("../x"), key)).when(k == 1, "../../../x?q").when(k == 2, "./#f").when(k == 3, "/w/../y").otherwise("?z=1")
    return table(spark, sf_dir, "supplier").select("s_suppkey", fx.absolute(ref, F.lit("http://h/a/b/c.html?q=1#g")).alias("url"))


@query("q91_clean_whole_pages", f"""
    select o_orderkey as page_id, '<table class="t"><caption>c</caption><tbody>' || case when n > 0 then '<tr><td><a href="http://h/a/' || o_orderkey || '.html">' || n || '</a></td></tr>' else '' end || '</tbody></table>' as html from ({ROWS})
""")
def clean_whole_pages(spark, sf_dir):
    """Whole pages: common blocks, everything behind a page-top marker and relative links are dealt with."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    key = F.col("o_orderkey").cast("string")
    cell = F.when(F.col("n") > 0, F.concat(F.lit("<tr><td><a href='../a/"), key, F.lit(".html'>"), F.col("n").cast("string"), F.lit("</a></td></tr>"))).otherwise("")
    html = F.concat(F.lit("<div id='bg'>x</div><table class='t' border=1><caption>c</caption><tbody>"), cell, F.lit("</tbody></table><p class='a spm'>y</p><div><p>PageTop</p></div><p>z</p>"))
    pages = orders.join(lines, "o_orderkey", "left").select(F.col("o_orderkey").alias("page_id"), html.alias("html"))
    return clean.clean_pages(pages, F.lit("http://h/b/c.html"), bounded=True)


@query("q92_captured_replies", """
    select o_orderkey as page_id, case when o_orderkey % 2 = 0 then 'accepted' else 'short_output' end as reason, case when o_orderkey % 2 = 0 then o_orderkey else 0 end as tokens from orders where o_orderpriority = '1-URGENT'
""")
def captured_replies(spark, sf_dir):
    """Prompts for data tables, joined to captured replies by their hash."""
    data = tables.data_like(tables.features(order_nodes(spark, sf_dir, *tables.FEATURES, only="inside"))).where("data_like and theads > 0 and captions > 0").select("page_id")
    asked = prompts.table_prompts(data.withColumn("html", F.concat(F.lit("<table>"), F.col("page_id").cast("string"), F.lit("</table>"))))
    told = asked.where("page_id % 2 = 0").select("prompt_sha256", F.concat(F.lit("```html\n<table><caption>repaired "), F.col("page_id").cast("string"), F.lit("</caption><tr><td>x</td></tr></table>\n```")).alias("text"), F.col("page_id").alias("tokens"))
    return replies.accept(replies.with_replies(asked.drop("prompt_sha256"), told), original="html").select("page_id", "reason", "tokens")
