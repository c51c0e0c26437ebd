"""Order MinHash document fingerprints, in DataFrame operations only.

A k-mer is ``k`` consecutive words (fewer before the start of a text, so a text of n
words has n of them). Equal k-mers of a text are numbered in order of occurrence;
a hash of k-mer and number decides which are minimal. The hash range is cut into
``slots``: in each the ``take`` smallest hashes are selected, put back into text order,
and their k-mers hashed as a tuple. Signatures thus agree where two texts share
minimal k-mers in the same order, which follows edit distance rather than the mere
set of k-mers. One pass of hashing serves all slots (one-permutation hashing), so
the work is one sort of a text's k-mers.

Likeness is the share of equal signatures among the slots that either text fills;
two empty texts are alike (1), an empty and another text are not (0).

Null texts count as empty. Rows are ordered by doc_id, rows of one id by the hash of
their text, then the text; the row after the last is the first. A single row is followed by
itself. Null ids come first. An empty table gives an empty result, other columns are ignored.
Everything works within a row but for one shuffle of the texts, by ranges of that order,
that puts neighbours side by side. Ids of very many rows and null ids are cut into ranges
by the hash; only rows equal in id and text always share one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nodeloom.llm.common import SPACE_PATTERN, numbers, place_among

K, SLOTS, TAKE = 3, 64, 2
#: Low bits of a long that hold a word's place in its text; the others hold a hash. No string of Spark's (2 GB) has more words.
PLACE_BITS = 30
#: Ranges of doc_id that the neighbour search is dealt into, for each million rows, and at most.
RANGES_PER_MILLION, RANGES_LEAST, RANGES_MOST = 400, 32, 65_536
#: The least long: a bound that begins before any hash.
_LEAST = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _above(x: Column) -> Column:
    return x.bitwiseAND(F.lit(~((1 << PLACE_BITS) - 1)))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _kmers(words: Column, k: int) -> Column:
    """Hashes of the k words that end at each place; places before the first word are left out."""
    return F.transform(words, lambda w, i: _above(F.xxhash64(*[F.get(words, i - d) for d in range(k - 1, 0, -1)], w)))


def _occurrences(ordered: Column) -> Column:
    """Where the run of equal k-mers begins that each element of a sorted array (hash and place in one long) belongs to.

    Places that begin a run know it; the others take it from ever further left
    (1, 2, 4 ... places), so a run of any length is numbered in few passes.
    """
    first = F.transform(ordered, lambda x, j: F.when((j == 0) | (_above(F.get(ordered, j - 1)) != _above(x)), j))

    def widen(starts: Column, shift: Column) -> Column:
        wider = F.transform(starts, lambda x, j: F.when(x.isNotNull() | (j < shift), x).otherwise(F.get(starts, j - shift)))
        return F.when(F.exists(starts, lambda x: x.isNull()), wider).otherwise(starts)

    shifts = F.array(*[F.lit(1 << n) for n in range(30)])
    return F.aggregate(shifts, first, widen)


def signatures(text: Column, k: int = K, slots: int = SLOTS, take: int = TAKE) -> Column:
    """Ascending array of longs: slot in the upper, signature in the lower 32 bits; empty slots are left out."""
    bits = slots.bit_length() - 1
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_PATTERN))
    pack = lambda h, i: _above(h).bitwiseOR(i.cast("long"))
    slot = lambda x: F.shiftrightunsigned(x, 64 - bits)

    def numbered(kmers: Column) -> Column:
        plain = F.transform(kmers, lambda h, i: pack(F.xxhash64(h, F.lit(0)), i))
        counted = let(F.sort_array(F.transform(kmers, lambda h, i: pack(h, i))), lambda s: let(_occurrences(s), lambda f: F.transform(s, lambda x, j: pack(F.xxhash64(_above(x), j - F.get(f, j)), _place(x)))))
        return F.sort_array(F.when(F.size(F.array_distinct(kmers)) < F.size(kmers), counted).otherwise(plain))

    def of(kmers: Column) -> Column:
        # sorted as signed numbers the slots follow one another, each in one piece
        minimal = let(numbered(kmers), lambda s: F.filter(s, lambda x, j: (j < take) | (slot(F.get(s, j - take)) != slot(x))))
        in_order = F.sort_array(F.transform(minimal, lambda x: F.shiftleft(slot(x), PLACE_BITS).bitwiseOR(_place(x))))

        def tuples(s: Column) -> Column:
            same = lambda x, y: F.shiftrightunsigned(x, PLACE_BITS) == F.shiftrightunsigned(y, PLACE_BITS)
            kmer = lambda x: F.get(kmers, _place(x).cast("int"))
            own = lambda d, x, j: F.when(same(F.get(s, j + d), x), kmer(F.get(s, j + d)))
            signed = lambda x, j: F.shiftleft(F.shiftrightunsigned(x, PLACE_BITS), 32).bitwiseOR(F.xxhash64(kmer(x), *[own(d, x, j) for d in range(1, take)]).bitwiseAND(F.lit(0xFFFFFFFF)))
            return F.filter(F.transform(s, lambda x, j: F.when((j == 0) | ~same(F.get(s, j - 1), x), signed(x, j))), lambda x: x.isNotNull())

        return let(in_order, tuples)

    return let(let(words, lambda ws: _kmers(ws, k)), of)


def as_text(signature: Column) -> Column:
    """Ten hexadecimal digits for each filled slot: its number and its signature."""
    return F.array_join(F.transform(signature, lambda v: F.lower(F.lpad(F.hex(v), 10, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among slots that either fills."""
    slots = lambda s: F.transform(s, lambda v: F.shiftrightunsigned(v, 32))
    filled = F.size(F.array_union(slots(a), slots(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(filled, F.lit(1)))


def fingerprints(docs: DataFrame, k: int = K, slots: int = SLOTS, take: int = TAKE) -> DataFrame:
    """doc_id, text, signature of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), signatures(text, k, slots, take).alias("signature"))


def range_starts(keys: DataFrame) -> list[tuple[int, int, int]]:
    """Ascending keys (1 and doc_id, or 0 and 0 for null ids; hash) that begin the ranges; the first row of all begins the first.

    Quantiles of doc_id deal the ids. An id that several quantiles fall on, and null ids, hold
    whole ranges of rows: they are dealt by even steps of the hash, where rows are first seen.
    """
    n, ids, least = keys.agg(F.count("*"), F.count("doc_id"), F.min("doc_id")).first()
    if not n:
        return []
    per_range = n / max(RANGES_LEAST, min(RANGES_MOST, n * RANGES_PER_MILLION // 1_000_000))
    quantiles = []
    if ids:
        pieces = max(2, round(ids / per_range))
        quantiles = keys.agg(F.percentile_approx("doc_id", [i / pieces for i in range(1, pieces)], 20 * pieces)).first()[0]
    falls = Counter(quantiles)
    starts = [(1, i, _LEAST) for i in sorted({*falls, *([least] if ids else [])})]
    many = {(1, i): k for i, k in falls.items() if k > 1} | ({(0, 0): max(1, round((n - ids) / per_range))} if n > ids else {})
    if many:
        table = keys.sparkSession.createDataFrame([(a, i, float(k)) for (a, i), k in many.items()], "there int, id long, pieces double")
        hot = keys.select(F.col("doc_id").isNotNull().cast("int").alias("there"), F.coalesce("doc_id", F.lit(0)).alias("id"), "hash").join(F.broadcast(table), ["there", "id"])
        step = F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * F.col("pieces"))
        first = hot.groupBy("there", "id", step.alias("step")).agg(F.min("hash").alias("hash")).select("there", "id", "hash").collect()  # one row a range
        starts += [tuple(r) for r in first]
        starts = [s for s in starts if s[2] != _LEAST or s[:2] not in many]
    return sorted(starts)


def with_next(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """rows (doc_id, text, ...) with ``name``: the value of the row after it. One shuffle, by ranges in their order.

    A row that begins a range is also sent to the range before as a guard, the
    first row of all to the last range.
    """
    keyed = rows.withColumns({"_there": F.col("doc_id").isNotNull().cast("int"), "_id": F.coalesce("doc_id", F.lit(0)), "_hash": F.xxhash64("text")})
    starts = range_starts(keyed.select("doc_id", F.col("_hash").alias("hash")))
    if not starts:
        return rows.withColumn(name, value)
    there, ids, hashes = (numbers(list(c)) for c in zip(*starts))
    last = len(starts) - 1
    own_key = F.struct(F.col("_there").cast("long").alias("a"), F.col("_id").alias("b"), F.col("_hash").alias("c"))
    bound = lambda i: F.struct(F.get(there, i).alias("a"), F.get(ids, i).alias("b"), F.get(hashes, i).alias("c"))
    placed = keyed.withColumn("_range", F.greatest(place_among(len(starts), lambda i: bound(i) <= own_key), F.lit(0)))
    at = lambda c: F.get(c, F.col("_range"))
    begins = (at(there) == F.col("_there")) & (at(ids) == F.col("_id")) & at(hashes).isin(F.lit(_LEAST), F.col("_hash"))
    own = F.struct(F.col("_range").alias("range"), F.lit(0).alias("guard"))
    guard = F.struct(F.when(F.col("_range") == 0, F.lit(last)).otherwise(F.col("_range") - 1).alias("range"), F.lit(1).alias("guard"))
    spread = placed.withColumn("_to", F.explode(F.when(begins, F.array(own, guard)).otherwise(F.array(own)))).drop("_range").withColumns({"_range": F.col("_to.range"), "_guard": F.col("_to.guard")}).drop("_to")
    # each range is one task, whose size follows the range and not a setting of the session
    dealt = spread.repartitionById(len(starts), F.col("_range"))
    window = Window.partitionBy("_range").orderBy("_guard", "_there", "_id", "_hash", "text")
    return dealt.withColumn(name, F.lead(value).over(window)).where("_guard = 0").drop("_range", "_guard", "_there", "_id", "_hash")


def compare_neighbours(docs: DataFrame, k: int = K, slots: int = SLOTS, take: int = TAKE) -> DataFrame:
    """Fingerprint every text and its edited text: the second half replaced by the beginning of the next row's text."""
    rows = with_next(fingerprints(docs, k, slots, take), F.struct("text", "signature"), "_next")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("_next.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "signature", F.col("_next.signature").alias("next_signature"), edited.alias("edited"))
    rows = rows.withColumn("edited_signature", signatures(F.col("edited"), k, slots, take))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("signature")).alias("fingerprint"), as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"), likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
