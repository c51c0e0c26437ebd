"""Review of single candidates: rule table, prompts, image parts, usage, prices and the usage log.

Calls to a model are captured tables here as well: a response is a row with a status code and a body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeloom.functions import text as fx
from nodeloom.operators.replies import reply_json

#: id, category, target, mode, risk of the sidebar's rules in their order (fixed values).
RULES = (
    ("HTML-R-08", "html", "body", "detect-only", "medium"), ("HTML-R-15", "table", "table", "review-candidate", "low"), ("HTML-R-16", "table", "table", "detect-only", "high"), ("HTML-W-02", "table", "table", "detect-only", "high"),
    ("HTML-R-21", "html", "body", "detect-only", "medium"), ("LINK-R-02", "link", "a", "review-candidate", "medium"), ("LINK-R-03", "link", "a", "not-implemented", "medium"), ("LINK-R-04", "link", "a", "review-candidate", "medium"),
    ("LINK-R-06", "link", "a", "detect-only", "medium"), ("LINK-R-08", "link", "a", "review-candidate", "low"), ("LINK-R-09", "link", "a", "review-candidate", "low"), ("IMG-R-05", "image", "a img", "review-candidate", "medium"),
    ("IMG-W-01", "image", "img", "manual-llm", "medium"), ("IMG-W-02", "iframe", "iframe", "review-candidate", "low"), ("IMG-R-09", "image", "a", "review-candidate", "medium"), ("SKIP-04", "skip", "body", "review-candidate", "high"),
)
#: Rules of the page detector's file, in its order (fixed values).
FILE_RULES = "HTML-R-08 HTML-R-15 HTML-R-16 HTML-W-02 IMG-W-01 IMG-W-02 LINK-R-02 LINK-R-04 LINK-R-08 LINK-R-09 IMG-R-05 IMG-R-09 SKIP-04 FORM-R-01 ARIA-R-01 HEAD-R-01".split()
#: Rules that a model may be asked about, and those among them that come with an image (fixed values).
ASKED = ("HTML-R-15", "LINK-R-02", "LINK-R-04", "IMG-R-05", "IMG-R-09", "IMG-W-02", "IMG-W-01")
WITH_IMAGE = ("IMG-R-05", "IMG-R-09", "IMG-W-01")
NOT_RUN = "未実行"
#: Columns of the usage log (fixed values).
USAGE = (
    "timestamp timestamp, userEmail string, provider string, model string, mode string, ruleId string, candidateId string, promptTokenCount long, candidatesTokenCount long, thoughtsTokenCount long, totalTokenCount long, inputUnitUsdPer1M double, outputUnitUsdPer1M double, "
    "estimatedUsd double, estimatedJpy double, currencyRateUsdJpy double, status string, error string, responseId string, modelVersion string, note string, imageMode string, imageSourceResolved string, imageMimeType string, altAssessment string, suggestedAlt string"
)
#: Prices in dollars for a million tokens, estimates made by hand (fixed values).
PRICES = (("gemini", "gemini-2.5-flash", 0.30, 2.50), ("gemini", "gemini-2.5-flash-lite", 0.10, 0.40))
SETTINGS = {"provider": "gemini", "model": "gemini-2.5-flash", "pricingMode": "unknown", "usdJpyRate": "150"}
SETTING_PREFIX, KEY_SETTING = "spark.nodeloom.sidebar.", "spark.nodeloom.sidebar.apiKey"


def rules(spark: SparkSession) -> DataFrame:
    """id, category, target, mode, risk, requires_llm, requires_network, requires_review, order, status, enabled: the rule table made ready for a client."""
    rows = [(*r, r[0] == "IMG-W-01", r[0] == "LINK-R-03", True, i, NOT_RUN, r[0] != "LINK-R-03") for i, r in enumerate(RULES, 1)]
    return spark.createDataFrame(rows, "id string, category string, target string, mode string, risk string, requires_llm boolean, requires_network boolean, requires_review boolean, `order` int, status string, enabled boolean")


def file_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r, i) for i, r in enumerate(FILE_RULES, 1)], "id string, `order` int")


def manual_prompt(rule: Column, payload: Column) -> Column:
    """Prompt that a person hands to a model: the rule, the candidate as JSON, and the JSON that must come back."""
    rule = F.coalesce(rule, F.lit("UNKNOWN"))
    contract = F.to_json(F.struct(rule.alias("ruleId"), *[F.lit("optional").alias(c) for c in ("replacementText", "alt", "caption", "title", "altAssessment", "suggestedAlt")], F.lit("required").alias("reason")))
    return F.concat(F.lit("Improve the accessibility candidate below. Answer with JSON only, with short texts and never with a whole page.\nRule: "), rule, F.lit("\nInput: "), F.coalesce(payload, F.lit("{}")), F.lit("\nOutput: "), contract)


def image_part(candidates: DataFrame, images: DataFrame, base: str = "base_url") -> DataFrame:
    """candidates (rule_id, src, base_url, ...) with image_mode, image_resolved, image_mime, image_base64.

    A data URI is decoded; another source is made absolute and looked up in captured images (url, mime, bytes). Rules without an image are text_only.
    """
    src = fx.strip(F.coalesce("src", F.lit("")))
    part = lambda i: F.regexp_extract(src, r"(?is)^data:([^;,]+)(;base64)?,(.*)$", i)
    inline = src.rlike(r"(?is)^data:[^;,]+(;base64)?,")
    url = F.when(src.rlike("(?i)^https?://"), src).otherwise(fx.absolute(src, F.coalesce(base, F.lit(""))))
    asked = F.col("rule_id").isin(*WITH_IMAGE)
    out = candidates.withColumn("_url", F.when(asked & (src != "") & ~src.rlike("(?i)^data:") & url.rlike("(?i)^https?://"), url)).join(images.select(F.col("url").alias("_url"), F.col("mime").alias("_mime"), F.col("bytes").alias("_bytes")), "_url", "left")
    mode = F.when(~asked, "text_only").when(inline, "image_inline").when(F.col("_bytes").isNotNull(), "image_url").otherwise("image_unresolved")
    data = F.when(part(2) != "", F.base64(F.try_to_binary(part(3), F.lit("base64")))).otherwise(F.base64(F.try_url_decode(part(3)).cast("binary")))
    out = out.withColumn("image_mode", mode)
    m = F.col("image_mode")
    mime = F.when(m == "image_inline", part(1)).when(m == "image_url", F.coalesce(F.when(F.col("_mime") != "", F.col("_mime")), guessed_mime(F.col("_url")))).otherwise("")
    return out.withColumns({"image_resolved": m.isin("image_inline", "image_url"), "image_mime": mime, "image_base64": F.when(m == "image_inline", data).when(m == "image_url", F.base64("_bytes"))}).drop("_url", "_mime", "_bytes")


def guessed_mime(url: Column) -> Column:
    """Kind of an image by the ending of its address; a stream of bytes without one."""
    ending = F.lower(F.regexp_extract(url, r"(?i)\.([a-z0-9]+)(?:\?|$)", 1))
    return F.when(ending == "", "application/octet-stream").when(ending == "jpg", "image/jpeg").otherwise(F.concat(F.lit("image/"), ending))


def parsed_usage(body: Column) -> list[Column]:
    """Token counts, response id and model version of a response body (JSON)."""
    n = lambda k: F.get_json_object(body, f"$.usageMetadata.{k}").cast("long").alias(k)
    s = lambda k: F.coalesce(F.get_json_object(body, f"$.{k}"), F.lit("")).alias(k)
    return [*map(n, ("promptTokenCount", "candidatesTokenCount", "thoughtsTokenCount", "totalTokenCount")), s("responseId"), s("modelVersion")]


def priced(usage: DataFrame, prices: DataFrame, mode: str = "listed", rate: float = 150.0) -> DataFrame:
    """usage (provider, model, token counts) with unit prices, estimatedUsd, estimatedJpy, note. Mode free costs nothing, mode unknown and models without a price stay blank (null)."""
    p = prices.select("provider", "model", F.col("usd_in").alias("_in"), F.col("usd_out").alias("_out"))
    joined = usage.join(p, ["provider", "model"], "left")
    unit = lambda c: F.lit(0.0) if mode == "free" else F.lit(None).cast("double") if mode == "unknown" else F.col(c)
    n = lambda c: F.coalesce(c, F.lit(0))
    note = F.lit("free mode") if mode == "free" else F.lit("unknown pricing") if mode == "unknown" else F.when(F.col("_in").isNull(), "pricing not configured").otherwise("estimate made by hand")
    out = joined.withColumns({"inputUnitUsdPer1M": unit("_in"), "outputUnitUsdPer1M": unit("_out"), "note": note}).drop("_in", "_out")
    usd = n("promptTokenCount") / 1e6 * F.col("inputUnitUsdPer1M") + (n("candidatesTokenCount") + n("thoughtsTokenCount")) / 1e6 * F.col("outputUnitUsdPer1M")
    return out.withColumn("estimatedUsd", usd).withColumn("estimatedJpy", F.col("estimatedUsd") * rate)


def answered(candidates: DataFrame, responses: DataFrame) -> DataFrame:
    """candidates (candidate_id, rule_id) with status (success, validation_error, error), error, reply and the usage of captured responses (candidate_id, code, body).

    Rules that no model is asked about, missing responses and codes outside 200 to 299 are errors.
    """
    text = F.array_join(F.transform(F.from_json(F.get_json_object("body", "$.candidates[0].content.parts"), "array<struct<text:string>>"), lambda p: F.coalesce(p["text"], F.lit(""))), "\n")
    bare = fx.strip(F.regexp_replace(F.regexp_replace(fx.strip(F.coalesce(text, F.lit(""))), r"^```json\s*", ""), "```$", ""))
    joined = candidates.join(responses.select("candidate_id", "code", "body"), "candidate_id", "left").withColumn("reply", bare)
    checked = reply_json(joined)
    failed = F.when(~F.col("rule_id").isin(*ASKED), "unsupported rule").when(F.col("code").isNull(), "no response").when(~F.col("code").between(200, 299), F.concat(F.lit("response code "), F.col("code").cast("string")))
    status = F.when(failed.isNotNull(), "error").when(F.col("check") != "ok", "validation_error").otherwise("success")
    usage = [F.when(failed.isNull(), c).alias(k) for c, k in zip(parsed_usage(F.col("body")), ("promptTokenCount", "candidatesTokenCount", "thoughtsTokenCount", "totalTokenCount", "responseId", "modelVersion"))]
    return checked.select(*candidates.columns, status.alias("status"), F.coalesce(failed, F.when(F.col("check") != "ok", F.col("check")), F.lit("")).alias("error"), "reply", *usage)


def usage_entries(answers: DataFrame, at: Column, user: str = "unknown") -> DataFrame:
    """Rows of the usage log, all its columns in order; what answers do not hold is empty."""
    names = {"ruleId": "rule_id", "candidateId": "candidate_id", "imageMode": "image_mode", "imageMimeType": "image_mime"}
    out = []
    for field in USAGE.split(", "):
        name, kind = field.split(" ")
        held = names.get(name, name)
        value = at if name == "timestamp" else F.lit(user) if name == "userEmail" else F.col(held) if held in answers.columns else F.lit("" if kind == "string" else None)
        out.append(value.cast(kind).alias(name))
    return answers.select(*out)


def save_settings(spark: SparkSession, **given) -> dict:
    """Keep settings in the session; a key is kept apart and never given back."""
    for name, usual in SETTINGS.items():
        spark.conf.set(SETTING_PREFIX + name, str(given.get(name) or usual))
    if given.get("apiKey"):
        spark.conf.set(KEY_SETTING, given["apiKey"])
    return settings(spark)


def settings(spark: SparkSession) -> dict:
    """provider, model, pricingMode, usdJpyRate, hasApiKey."""
    held = {name: spark.conf.get(SETTING_PREFIX + name, usual) for name, usual in SETTINGS.items()}
    return held | {"usdJpyRate": float(held["usdJpyRate"]), "hasApiKey": bool(spark.conf.get(KEY_SETTING, ""))}


def forget_key(spark: SparkSession) -> dict:
    spark.conf.unset(KEY_SETTING)
    return settings(spark)


def tag_counts(nodes: DataFrame, table: DataFrame) -> DataFrame:
    """id, n: elements that a rule's target names, over all pages ("a img": images inside a link)."""
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    own = F.col("kind") == "element"
    one = nodes.agg(n(own & (F.col("tag") == "table")).alias("table"), n(own & (F.col("tag") == "a")).alias("a"), n(own & (F.col("tag") == "img")).alias("img"), n(own & (F.col("tag") == "img") & F.col("a_pre").isNotNull()).alias("a img"), n(own & (F.col("tag") == "iframe")).alias("iframe"), F.count_distinct("page_id").alias("body"))
    counts = one.select(F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.coalesce(F.col(f"`{t}`"), F.lit(0)).alias("n")) for t in ("table", "a", "img", "a img", "iframe", "body")])).alias("c")).select("c.target", "c.n")
    return table.join(counts, "target", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
