"""Personal data: base patterns, and terms that disclose them, in DataFrame operations only.

Base spans are found by four patterns with exact code point offsets: the pieces
between matches and the matches themselves add up to positions. The patterns are
written with possessive runs and look-behinds, so that long runs neither make the
matcher step back nor recurse.

Disclosure. An entity is a base match; its documents are counted by distinct text,
so copies are one piece of evidence. A term (word of at least ``term_length``
characters, marked outside base spans) reveals the entity by their pointwise mutual
information, as a share of the entity's information content:

    disclosure(e, t) = ln(N n(e,t) / (n(e) n(t))) / ln(N / n(e))

which is 1 when the term occurs in the entity's documents only. Terms at or above
``threshold``, seen with the entity in at least ``support`` distinct texts, become
``term`` spans of all documents that hold the term: where the entity is absent the
term reveals it all the same. Words of any length are terms. With the default support of 1
an entity of a single text is protected too: its terms are the words of that text
that stand in at most N ** (1 - threshold) texts. A higher ``support`` asks for
repeated evidence. An entity in every text tells nothing and adds no terms.
``sanitise`` generalises base spans to their kind and removes terms.

Counts are of distinct texts: copies and repeated rows are one piece of evidence, however
many they are. Ties do not arise, as a term passes the threshold or not.

Null texts count as empty. Rows that repeat id and text get the same result each. An empty table gives an
empty result, other columns are ignored. Texts of any length are read whole; positions follow from running
sums that double their reach, so the work on a text with n matches is n log n.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodeloom.llm.common import cut
from nodeloom.llm.orderminhash import let

SUPPORT, THRESHOLD, TERM_LENGTH = 1, 0.8, 1
#: Lists of term or text hashes up to this many rows are broadcast, larger ones joined by shuffle.
BROADCAST_TERMS = BROADCAST_TEXTS = 200_000
KINDS = ("email", "ip", "card", "phone")

_LOCAL = r"[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9-]"
#: The base patterns in possessive form: a match begins where a run begins or where the last match ended.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"[\p{L}\p{N}]+"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check digit test of a digit string."""
    places = F.sequence(F.lit(1), F.length(digits))
    digit = lambda i: F.substring(digits, -i, 1).cast("int")
    doubled = lambda i: digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)
    return F.aggregate(F.transform(places, lambda i: F.when(i % 2 == 0, doubled(i)).otherwise(digit(i))), F.lit(0), lambda a, x: a + x) % 10 == 0


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: F.when(F.length(q) > 3, False).otherwise(F.lpad(q, 3, "0").cast("int") <= 255))),
    "card": lambda m: let(_digits(m), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def running_sum(values: Column) -> Column:
    """Sums of an int array up to each place: every pass adds the value 1, 2, 4 ... places to the left."""
    shifts = F.filter(F.array(*[F.lit(1 << n) for n in range(30)]), lambda k: k < F.size(values))
    return F.aggregate(shifts, values, lambda sums, k: F.transform(sums, lambda x, j: F.when(j >= k, x + F.get(sums, j - k)).otherwise(x)))


def running_max(values: Column) -> Column:
    """Largest value of an int array up to each place, in the same way."""
    shifts = F.filter(F.array(*[F.lit(1 << n) for n in range(30)]), lambda k: k < F.size(values))
    return F.aggregate(shifts, values, lambda most, k: F.transform(most, lambda x, j: F.when(j >= k, F.greatest(x, F.get(most, j - k))).otherwise(x)))


def located(text: Column, pattern: str | Column, valid: Callable[[Column], Column] | None = None) -> Column:
    """All matches, or the valid ones, as array<struct<start, end, text>>, offsets in code points, end exclusive."""
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def placed(found: Column) -> Column:
        ends = lambda parts: running_sum(F.transform(found, lambda m, i: F.length(F.get(parts, i)) + F.length(m)))
        spans = lambda e: F.transform(found, lambda m, i: F.struct((F.get(e, i) - F.length(m)).alias("start"), F.get(e, i).alias("end"), m.alias("text")))
        return let(let(F.split(text, pattern, -1), ends), spans)

    def add(found: Column) -> Column:
        if valid is None:
            return F.when(F.size(found) > 0, placed(found)).otherwise(none)
        return F.when(F.exists(found, valid), F.filter(placed(found), lambda s: valid(s["text"]))).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), add)


def base_spans(text: Column) -> dict[str, Column]:
    """Valid matches of each kind. A cheap look for a character that each match must hold comes first."""
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    needs = {"email": "@", "ip": ".", "card": None, "phone": "+"}
    found = {}
    for kind in KINDS:
        spans = located(text, PATTERNS[kind], VALID[kind])
        may = F.contains(text, F.lit(needs[kind])) if needs[kind] else text.rlike(r"[0-9][0-9\x20-]{11,}[0-9]")
        may = may & text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]") if kind == "ip" else may
        found[kind] = F.when(may, spans).otherwise(none)
    return found


def _spelt(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def find_base(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), email, ip, card, phone (spans of each kind)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), *[c.alias(k) for k, c in base_spans(text).items()])


def _among(rows: DataFrame, keys: DataFrame, column: str, most: int) -> DataFrame:
    """Rows whose key is listed: by broadcast up to ``most`` keys, by shuffle beyond."""
    return rows.join(F.broadcast(keys) if keys.count() <= most else keys, column, "left_semi")


def distinct_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """h, text of each distinct text once. Only texts that have copies are shuffled, one of them from each task."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("h"), text.alias("text"))
    copied = cut(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    copied = F.broadcast(copied) if copied.count() <= BROADCAST_TEXTS else copied
    return rows.join(copied, "h", "left_anti").unionByName(rows.join(copied, "h", "left_semi").groupBy("h").agg(F.min("text").alias("text")))


def disclosing_terms(docs: DataFrame, found: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, term_length: int = TERM_LENGTH) -> tuple[DataFrame, DataFrame] | None:
    """(h, t) of all texts that hold a term that discloses some entity, as hashes, and (h, text) of each distinct text; None without entities."""
    values = F.flatten(F.array(*[F.transform(k, lambda s: F.concat(F.lit(k + ":"), F.lower(s["text"]))) for k in KINDS]))  # noqa: B023
    held = found.where(" or ".join(f"size({k}) > 0" for k in KINDS)).select("h", F.explode(F.array_distinct(values)).alias("entity")).select("h", F.xxhash64("entity").alias("e"))
    held = cut(held.distinct())
    known = cut(held.groupBy("e").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support))
    if known.isEmpty():
        return None
    held = cut(held.join(known, "e").select("h", "e", "n_e"))
    rows = distinct_texts(docs, found)
    own_text = cut(_among(rows, cut(held.select("h").distinct()), "h", BROADCAST_TEXTS))
    terms_of = lambda t: F.array_distinct(F.transform(F.filter(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.length(w) >= term_length), lambda w: F.xxhash64(F.lower(w))))
    own_terms = own_text.select("h", F.explode(terms_of(F.col("text"))).alias("t"))
    total = float(found.agg(F.count_distinct("h")).first()[0])
    # disclosure reaches the threshold only for terms in at most so many texts; those that are in more of these very texts need no further count
    at_most = F.col("n_et") * F.pow(F.lit(total) / F.col("n_e"), F.lit(1 - threshold)) * (1 + 1e-9)
    here = own_terms.groupBy("t").agg(F.count("*").alias("n_here"))
    pairs = held.join(own_terms, "h").groupBy("e", "n_e", "t").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support)
    pairs = cut(pairs.join(here, "t").where((F.col("n_here") <= at_most) & (F.col("n_e") < total)).select("e", "n_e", "t", "n_et"))
    # counts add up in the tasks, so that only sums are shuffled
    everywhere = rows.select("h", F.explode(terms_of(F.col("text"))).alias("t"))
    counts = cut(everywhere.groupBy("t").agg(F.count("*").alias("n_t")))
    share = F.log(F.lit(total) * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.log(F.lit(total) / F.col("n_e"))
    disclosing = cut(pairs.join(counts, "t").where(share >= threshold).select("t", "n_t").distinct())
    # terms of more texts than a BROADCAST_TERMS-th of all places are at most BROADCAST_TERMS: where they are read, the disclosing ones are
    # settled and the others go; only places of rarer words, a small share, are shuffled to be looked up
    common = (counts.agg(F.sum("n_t")).first()[0] or 0) / BROADCAST_TERMS
    often = counts.where(F.col("n_t") > common).join(disclosing.select("t", F.lit(True).alias("tells")), "t", "left").select("t", F.coalesce("tells", F.lit(False)).alias("tells"))
    settled = everywhere.join(F.broadcast(cut(often)), "t", "left")
    rare = _among(settled.where("tells is null").select("h", "t"), disclosing.where(F.col("n_t") <= common).select("t"), "t", BROADCAST_TERMS)
    return settled.where("tells").select("h", "t").unionByName(rare), rows


def term_spans(docs: DataFrame, found: DataFrame, **how) -> DataFrame:
    """h, term (array of spans in order of start) of the distinct texts that have any, whether or not they hold the entity."""
    evidence = disclosing_terms(docs, found, **how)
    none = "array<struct<start:int,end:int,text:string>>"
    if evidence is None:
        return docs.sparkSession.createDataFrame([], f"h long, term {none}")
    holding, rows = evidence
    wanted = cut(holding.groupBy("h").agg(F.collect_set("t").alias("ts")))
    # words inside a base span stay with it
    bases = found.where(" or ".join(f"size({k}) > 0" for k in KINDS)).dropDuplicates(["h"]).select("h", F.flatten(F.array(*KINDS)).alias("bases"))
    # the spellings of the terms in a text make the pattern that places them there
    forms = F.filter(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), lambda w: F.array_contains("ts", F.xxhash64(F.lower(w))))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    texts = rows.join(wanted, "h").join(bases, "h", "left").select("h", "text", F.coalesce("bases", F.array().cast(none)).alias("bases"), pattern.alias("pattern"))
    free = lambda s: ~F.exists("bases", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return texts.select("h", F.filter(located(F.col("text"), F.col("pattern")), free).alias("term")).where(F.size("term") > 0).dropDuplicates(["h"])


def find(docs: DataFrame, **how) -> DataFrame:
    """doc_id, h, and the spans of each kind, terms included."""
    found = cut(find_base(docs))
    terms = cut(term_spans(docs, found, **how))
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    return found.join(terms, "h", "left").select("doc_id", "h", *KINDS, F.coalesce("term", none).alias("term"))


def summary(docs: DataFrame, **how) -> DataFrame:
    """Counts and spelt spans of each row: base spans with commas between them, then each term with a comma before it."""
    base = F.flatten(F.array(*[_spelt(k, F.col(k)) for k in KINDS]))
    return find(docs, **how).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.concat(F.array_join(base, ","), F.array_join(F.transform(_spelt("term", F.col("term")), lambda s: F.concat(F.lit(","), s)), "")).alias("spans"),
    )


def sanitise(docs: DataFrame, **how) -> DataFrame:
    """doc_id, text: base spans generalised to [KIND], disclosing terms removed ([...]); of overlapping spans the first counts."""
    marked = F.flatten(F.array(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("[...]" if k == "term" else f"[{k.upper()}]").alias("by"))) for k in (*KINDS, "term")]))
    found = find(docs, **how).select("doc_id", "h", F.array_sort(marked).alias("marked")).dropDuplicates(["doc_id", "h"])
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    joined = rows.join(found, F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("h")))
    # where each span would begin to be copied: behind the furthest end so far; a span that begins before it is passed over
    reach = running_max(F.transform("marked", lambda s: s["end"]))
    free = lambda r: F.filter("marked", lambda s, i: (i == 0) | (s["start"] >= F.coalesce(F.get(r, i - 1), F.lit(0))))
    piece = lambda kept: F.transform(kept, lambda s, i: F.concat(F.substring(F.col("_text"), F.coalesce(F.get(kept, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(kept, i - 1)["end"], F.lit(0))), s["by"]))
    whole = lambda kept: F.concat(F.array_join(piece(kept), ""), F.substring(F.col("_text"), F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0)) + 1, F.length("_text")))
    return joined.select(F.col("_doc").alias("doc_id"), let(let(reach, free), whole).alias("text"))
