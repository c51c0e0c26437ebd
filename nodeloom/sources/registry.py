"""Page registry, captured pages, rule files and workbooks as sources; registry and report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REGISTRY = "municipality string, url string, filename string, xpath string, status string, started_at string, ended_at string, total_tokens string, cost string, version string, vision_flag string, vision_tokens string, vision_calls string"
#: Names that files and sheets use (fixed values): keys of a rule, the status of a finished row, headers of the source sheets and of the registry, slugs.
RULE_KEYS = ("id", "検出ID", "検出方式", "検出", "候補ペイロード", "LLMタスク", "修正プロンプト", "出力契約")
DONE, OPEN = "完了", "未完了"
SOURCE_HEADERS = ("No.", "URL", "ページ名", "ランク")
REGISTRY_HEADERS = ("自治体名", "URL", "保存ファイル名", "XPath", "ステータス", "開始日時", "完了日時", "消費トークン", "想定コスト(円)", "処理バージョン", "画像解析（Vision）", "VisionTokens", "VisionCalls")
SLUGS = {"安城市": "anjo", "浦添市": "urasoe", "弘前市": "hirosaki", "福山市": "fukuyama", "豊橋市": "toyohashi"}
#: Slug tables up to this many rows are broadcast.
BROADCAST_SLUGS = 100_000


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=REGISTRY)


def pending(registry: DataFrame, row: Column) -> DataFrame:
    """Rows still to do: sheet_row, municipality, url, filename, xpath, status, vision_flag. ``row`` is the row's number in the sheet."""
    bare = lambda c: F.coalesce(F.trim(c), F.lit(""))
    out = registry.select(row.cast("long").alias("sheet_row"), bare("municipality").alias("municipality"), bare("url").alias("url"), bare("filename").alias("filename"), bare("xpath").alias("xpath"), bare("status").alias("status"), (F.upper(bare("vision_flag")) == "ON").alias("vision_flag"))
    named = F.when(F.col("filename") == "", F.concat(F.lit("output_"), F.col("sheet_row").cast("string"), F.lit(".html"))).otherwise(F.col("filename"))
    return out.where((F.col("url") != "") & ~F.col("status").startswith(DONE)).withColumn("filename", named)


def write_back(registry: DataFrame, results: DataFrame, row: str = "sheet_row") -> DataFrame:
    """registry with status, times, tokens, cost and vision counts of finished rows; the vision flag is left alone."""
    new = ("status", "started_at", "ended_at", "total_tokens", "cost", "version", "vision_tokens", "vision_calls")
    done = results.select(row, *[F.col(c).alias(f"_{c}") for c in new])
    return registry.join(done, row, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in new else F.col(c) for c in registry.columns])


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """file_name, html of all HTML files under a folder."""
    return spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.htm*").select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("html"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule table from JSON lines; a broken line or a missing key fails the read."""
    schema = ", ".join(f"`{k}` string" for k in RULE_KEYS)
    rules = spark.read.schema(schema).json(path, mode="FAILFAST")
    missing = F.concat_ws(",", *[F.when(F.col(f"`{k}`").isNull(), F.lit(k)) for k in RULE_KEYS])
    return rules.where(F.when(missing == "", True).otherwise(F.raise_error(F.concat(F.lit("rule without "), missing))))


def contracts(rules: DataFrame) -> DataFrame:
    """id, parses, auto_fix: whether each rule's output contract is JSON, and what it says."""
    c = F.from_json("`出力契約`", "auto_fix boolean, html_changed boolean")
    return rules.select("id", c["auto_fix"].isNotNull().alias("parses"), c["auto_fix"].alias("auto_fix"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each case of a fixture manifest."""
    return spark.read.json(path, multiLine=True).select("fixture", F.explode("cases").alias("c")).select("fixture", "c.*")


def read_workbook(spark: SparkSession, path: str, sheet: str = "対象ページ") -> DataFrame:
    """path, row_ix, values of one sheet of .xlsx files, without any workbook library."""

    def run(batches):
        import io
        import re
        import zipfile
        from xml.etree import ElementTree as ET

        import pyarrow as pa

        ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"}
        text = lambda e: "".join(t.text or "" for t in e.iter(f"{{{ns['m']}}}t"))

        def column(ref):
            n = 0
            for c in re.match("[A-Z]+", ref)[0]:
                n = 26 * n + ord(c) - 64
            return n - 1

        for batch in batches:
            out = []
            for name, data in zip(*(c.to_pylist() for c in batch.columns)):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    shared = [text(s) for s in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
                    ids = {s.get("name"): s.get(ns["r"]) for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{{{ns['m']}}}sheet")}
                    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
                    at = targets[ids[sheet]].lstrip("/")
                    for i, row in enumerate(ET.fromstring(z.read(at if at.startswith("xl/") else f"xl/{at}")).iter(f"{{{ns['m']}}}row")):
                        values = []
                        for c in row.iter(f"{{{ns['m']}}}c"):
                            n = column(c.get("r"))
                            values += [""] * (n + 1 - len(values))
                            v = c.find("m:v", ns)
                            values[n] = text(c) if c.get("t") == "inlineStr" else shared[int(v.text)] if c.get("t") == "s" and v is not None else (v.text or "") if v is not None else ""
                        out.append((name, i, values))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.list_(pa.string())))], names=["path", "row_ix", "values"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, row_ix int, values array<string>")


def to_records(rows: DataFrame, headers: list[str]) -> DataFrame:
    """path and the named columns of the rows below the first row that holds all headers."""
    wanted = F.array(*map(F.lit, headers))
    head = rows.where(F.size(F.array_except(wanted, "values")) == 0).groupBy("path").agg(F.min(F.struct("row_ix", F.col("values").alias("names"))).alias("h"))
    below = rows.join(head, "path").where((F.col("row_ix") > F.col("h.row_ix")) & F.exists("values", lambda v: F.trim(v) != ""))
    return below.select("path", "row_ix", *[F.coalesce(F.get("values", F.array_position("h.names", h).cast("int") - 1), F.lit("")).alias(h) for h in headers])


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """path, and the source headers as columns, of one .xlsx or .csv file; other kinds and files without the headers are errors."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "xlsx":
        return to_records(read_workbook(spark, path), list(SOURCE_HEADERS)).drop("row_ix")
    if kind != "csv":
        raise ValueError(f"unsupported input file: {path}")
    rows = spark.read.csv(path, header=True, multiLine=True)
    rows = rows.toDF(*[c.lstrip("\ufeff") for c in rows.columns])
    missing = [h for h in SOURCE_HEADERS if h not in rows.columns]
    if missing:
        raise ValueError(f"{path}: required header missing: {', '.join(missing)}")
    return rows.select(F.col("_metadata.file_path").alias("path"), *[F.coalesce(F.trim(F.col(f"`{h}`")), F.lit("")).alias(h) for h in SOURCE_HEADERS])


def collect_sources(spark: SparkSession, paths: list[str]) -> DataFrame:
    """municipality (the file's stem), no, url of all source files; rows without a URL go."""
    out = None
    for path in sorted(paths):
        rows = read_source(spark, path).select(F.lit(path.rsplit("/", 1)[-1].rsplit(".", 1)[0]).alias("municipality"), F.floor(F.col("`No.`").cast("double")).cast("long").alias("no"), F.trim("URL").alias("url"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no .xlsx or .csv files")
    return out


def source_warnings(rows: DataFrame, each: int = 50, whole: int = 250) -> DataFrame:
    """kind, subject, n: rows without a URL, URLs that occur again, municipalities and a total of other than the planned size. All rows stay."""
    url = F.coalesce(F.trim("url"), F.lit(""))
    full = rows.where(url != "")
    empty = rows.where(url == "").groupBy(F.col("municipality").cast("string").alias("subject")).agg(F.count("*").alias("n")).select(F.lit("empty_url").alias("kind"), "subject", "n")
    again = full.groupBy(F.trim("url").alias("subject")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_url").alias("kind"), "subject", "n")
    sized = full.groupBy(F.col("municipality").cast("string").alias("subject")).agg(F.count("*").alias("n")).where(F.col("n") != each).select(F.lit("rows").alias("kind"), "subject", "n")
    total = full.agg(F.count("*").alias("n")).where(F.col("n") != whole).select(F.lit("total").alias("kind"), F.lit("").alias("subject"), "n")
    return empty.unionByName(again).unionByName(sized).unionByName(total)


def read_xpath_map(spark: SparkSession, path: str) -> DataFrame:
    """municipality, xpath of a JSON object of strings; anything else is an error."""
    entries = F.map_entries(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"}))
    return spark.read.text(path, wholetext=True).select(F.explode(entries).alias("e")).select(F.col("e.key").alias("municipality"), F.col("e.value").alias("xpath"))


def build_registry(rows: DataFrame, slugs: DataFrame, fail: bool = False) -> DataFrame:
    """rows (municipality, no, url) with filename, duplicate flags and problem: unknown slug or a repeated file name; ``fail`` raises on a problem."""
    slugs = F.broadcast(slugs) if slugs.count() <= BROADCAST_SLUGS else slugs
    named = rows.where(F.coalesce(F.trim("url"), F.lit("")) != "").join(slugs, "municipality", "left")
    named = named.withColumn("filename", F.format_string("%s_%03d.html", "slug", F.col("no").cast("int")))
    named = named.withColumn("url_count", F.count("*").over(Window.partitionBy("url"))).withColumn("file_count", F.count("*").over(Window.partitionBy("filename")))
    problem = F.when(F.col("slug").isNull(), "unknown_slug").when(F.col("file_count") > 1, "duplicate_file")
    out = named.withColumn("problem", problem)
    return out.where(F.when(F.col("problem").isNotNull(), F.raise_error("problem")).otherwise(True)) if fail else out


def registry_rows(built: DataFrame, xpaths: DataFrame, default_xpath: str = "", vision: str = "OFF") -> DataFrame:
    """The 13 columns of the registry for built rows; xpaths (municipality, xpath) or the default."""
    blank = F.lit("")
    joined = built.join(xpaths, "municipality", "left")
    values = (F.col("municipality").cast("string"), F.col("url"), F.col("filename"), F.coalesce("xpath", F.lit(default_xpath)), F.lit(OPEN), blank, blank, blank, blank, blank, F.lit(vision), blank, blank)
    return joined.select(*[v.alias(h) for v, h in zip(values, REGISTRY_HEADERS)])
