"""Word lists, patterns and column expressions on texts, attributes and URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the published behaviour for the results to agree.
INTRO_KEYWORDS = ("休日", "夜間", "受診", "診療時間", "当番医", "在宅当番医", "受付", "保険証", "小児", "歯科", "特定健診", "お問い合わせ", "ご利用ください")
INTRO_HINT = "※|注記|注意|ください|しましょう|受付|診療時間"
HEADER_WORDS = ("診療科", "医療機関名", "電話", "TEL", "所在地", "住所", "時間", "受付", "区分", "内容", "対象", "備考", "特定健診", "診療", "休診", "曜日")
ROW_HEADER_HINT = "診療科|診療|科目|区分|分類|日付|曜日|時間|施設|会場|担当|当番|窓口|項目"
VAGUE_LINKS = ("こちら", "ここ", "詳細", "詳しくはこちら", "続き", "リンク", "more", "click here")
AUDIT_VAGUE_LINKS = ("こちら", "ここ", "詳細", "詳しくはこちら", "リンク", "PDF", "Excel")
UI_WORDS = ("にメールを送る", "メールを送る", "クリック", "詳細", "申し込み", "申込み", "予約", "送信", "問合せ", "問い合わせ")
END_MARKERS = r"INDEX\s*PAGE\s*ITEM|BASIC_PARTS_SET"
NOISE = r"footer\s*スマホメニュー|^bg_in$|^bg$"
TRIM_MARKERS = ("PageTop", "Menu", "## Menu", "メニュー", "ページトップ", "footer", "スマホメニュー", "スマホ固定メニュー")
NON_BODY = ("本文へスキップ", "このサイトではJavaScript", "サイト内検索", "ページID検索", "緊急情報", "パンくず", "印刷用ページ", "Adobe Reader")
CMS_PHRASES = ("EndClear", "ParentBack", "LTitle_cap", "Item end", "BrowserItemList", "先頭にもどる", "先頭に戻る")
GENERIC_CAPTIONS = ("表", "一覧", "テーブル", "table")
GENERIC_TITLES = ("youtube video player", "youtube", "video player", "player")
GENERIC_VIDEO_TITLES = ("video", "動画", "movie")
YOUTUBE_EMBED = r"(?i)^https?://(?:www\.)?(?:youtube\.com|youtube-nocookie\.com)/embed/([A-Za-z0-9_-]{6,})"
YOUTUBE_SUFFIX = "（YouTube）"
ROW_PHONE = r"^(?:\+?\d[\d\-()\s]{7,}|\d{2,4}-\d{2,4}-\d{3,4}$)"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"0\d{1,4}-\d{1,4}-\d{3,4}"
FILE_LINK = r"(?i)\.(pdf|doc|docx|xls|xlsx|ppt|pptx|zip|csv)$"
IMAGE_LINK = r"(?i)\.(jpg|jpeg|png|gif|webp|bmp|svg)$"
PX_STYLE = r"(?i)\b(width|height|min-width|min-height|max-width|max-height)\s*:\s*\d+(?:\.\d+)?px\s*;?"
UPDATE_LINE = r"^更新[:：]\d{4}年\d{1,2}月\d{1,2}日$"
#: Texts that ask for normalised notation: times, dates, weekdays, currency, unit signs, full-width letters, spaced words, era dates, PDF notes.
NORMALISE = r"(?U)\b\d{1,2}:\d{2}\b|\b\d{1,4}/\d{1,2}/\d{1,2}\b|（[日月火水木金土]）|[¥$]|[㎡㎝㎜㎞]|[０-９Ａ-Ｚａ-ｚ]|日　時|年　月|月　日|受　付|場　所|（R\d{1,2}\.\d{1,2}\.\d{1,2}）|(?:PDF|ＰＤＦ)\s*(?:ファイル)?\s*[:：]"
_OPEN, _CLOSE = r"[【\[\(（〔<＜]", r"[】\]\)）〕>＞]"
#: Notes on a file's kind, with its size or not.
FILEINFO = (
    rf"(?iU){_OPEN}\s*(?:PDF|ＰＤＦ|Word|Excel|PowerPoint|ファイル)\s*(?:ファイル)?\s*[:：]\s*.*?\d+(?:\.\d+)?\s*(?:B|KB|MB|GB|TB|バイト|bytes|キロバイト|メガバイト|ギガバイト|テラバイト)\s*.*?{_CLOSE}"
    rf"|{_OPEN}\s*(?:PDF|ＰＤＦ)\s*(?:ファイル)?\s*[:：].*?{_CLOSE}"
)
IFRAME_ATTRS = ("src", "title", "name", "width", "height", "loading", "referrerpolicy", "allow", "allowfullscreen", "sandbox", "scrolling", "style", "class", "id", "aria-label", "aria-labelledby", "aria-describedby")
DENIED_ATTRS = {
    "table": ("border", "cellpadding", "cellspacing", "width", "height", "align", "bgcolor", "valign", "rules", "frame", "summary"),
    "tr": ("align", "valign", "bgcolor", "height", "width"),
    "th": ("align", "valign", "bgcolor", "width", "height", "nowrap"),
    "td": ("align", "valign", "bgcolor", "width", "height", "nowrap"),
    "img": ("border", "hspace", "vspace", "align", "width", "height"),
    "a": ("size", "type"),
}


def collapse(text: Column) -> Column:
    """White space runs, full-width and no-break spaces included, to one space; ends bare."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s 　]+", " "))


def squeeze(text: Column) -> Column:
    """Text without any white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s 　]+", "")


def contains_any(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def digit_share(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"\p{Nd}")) / F.length(text)).otherwise(0.0)


def numericish(text: Column) -> Column:
    return squeeze(text).rlike(r"^[0-9０-９.,/\-+()％%:：]+$")


def header_score(text: Column) -> Column:
    """How much a cell looks like a header: short, few digits, header vocabulary; phone numbers and URLs count against."""
    return squeezed_score(squeeze(text))


def squeezed_score(t: Column) -> Column:
    """header_score of a text without white space."""
    known = contains_any(F.upper(t), [w.upper() for w in HEADER_WORDS])
    score = (F.length(t) <= 10).cast("int") + (digit_share(t) < 0.2).cast("int") + 2 * known.cast("int") - t.rlike(PHONE).cast("int") - t.rlike("https?://").cast("int")
    return F.when(t == "", 0).otherwise(F.greatest(score, F.lit(0)))


def row_header_text(text: Column) -> Column:
    return collapsed_row_header(collapse(text))


def collapsed_row_header(t: Column) -> Column:
    """row_header_text of a collapsed text."""
    return (t != "") & (F.length(t) <= 10) & ~numericish(t) & ~t.rlike(ROW_PHONE)


def is_intro(text: Column) -> Column:
    return (F.length(text) >= 30) & intro_keyword(text).isNotNull()


def intro_keyword(text: Column) -> Column:
    """First keyword in list order, else "hint", else null."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in INTRO_KEYWORDS], F.when(text.rlike(INTRO_HINT), F.lit("hint")))


def strip(text: Column) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def sanitised_alt(alt: Column) -> Column:
    """Straight quotes off the ends, white space collapsed, round brackets dropped, exactly one full stop at the end and none at the beginning."""
    bare = F.regexp_replace(F.regexp_replace(strip(F.coalesce(alt, F.lit(""))), '^"+|"+$', ""), "^'+|'+$", "")
    bare = strip(F.regexp_replace(F.regexp_replace(bare, r"(?U)\s+", " "), "[（）()]", ""))
    bare = F.regexp_replace(F.replace(bare, F.lit("。の写真。"), F.lit("の写真。")), "。。+", "。")
    bare = strip(F.regexp_replace(bare, "^。+", ""))
    return F.when((bare == "") | bare.endswith("。"), bare).otherwise(F.concat(bare, F.lit("。")))


def running_sum(values: Column) -> Column:
    """Sums of a bigint array up to each place, in passes that double their reach (no growing copies)."""
    shifts = F.filter(F.array(*[F.lit(1 << n) for n in range(30)]), lambda k: k < F.size(values))
    return F.aggregate(shifts, values, lambda sums, k: F.transform(sums, lambda x, j: F.when(j >= k, x + F.get(sums, j - k)).otherwise(x)))


def lines_of(text: Column, pattern: Column) -> Column:
    """Line numbers (from 1) at which the matches of a pattern that holds no line end itself begin, in order."""
    parts = F.split(text, pattern, -1)
    before = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.regexp_count(p, F.lit("\n")).cast("long"))
    return F.transform(running_sum(before), lambda n: (n + 1).cast("int"))


def quoted(literal: Column) -> Column:
    """A literal as a pattern."""
    return F.concat(F.lit("\\Q"), literal, F.lit("\\E"))


def url_path(url: Column) -> Column:
    """Path of an absolute or relative URL."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_fragment(url: Column) -> Column:
    return F.regexp_extract(url, r"#(.*)$", 1)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def without_dots(path: Column) -> Column:
    """A path with its "." and ".." segments resolved, as RFC 3986 does; what climbs above the root is dropped."""
    last = F.regexp_extract(path, "[^/]*$", 0)
    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda out, p: F.when(p == ".", out).when(p == "..", F.when(F.size(out) > 1, F.slice(out, 1, F.size(out) - 1)).otherwise(out)).otherwise(F.concat(out, F.array(p))))
    joined = F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def absolute(url: Column, base: Column) -> Column:
    """URL joined to its base: absolute, scheme-relative, root-relative, query, fragment and plain relative references, dot segments resolved. Empty stays empty."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(url_path(base), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    path, tail = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    return (
        F.when(F.coalesce(url, F.lit("")) == "", url)
        .when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), url))
        .when(url.startswith("/"), F.concat(origin, without_dots(path), tail))
        .when(url.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), url))
        .when(url.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), url))
        .otherwise(F.concat(origin, without_dots(F.concat(folder, path)), tail))
    )
