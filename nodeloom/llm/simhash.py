"""SimHash near-dedup through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the number of bits set
in each segment makes a point in a 32-dimensional grid. Moving one bit moves one
coordinate by one, so the Manhattan distance of two points never exceeds the
Hamming distance of the fingerprints. The range join "Manhattan distance at most
d" uses the grid: the coordinates are dealt into d+k bands, at most d of which can
differ, so two points in range share a cell (all coordinates) of at least k bands.
Points meet in the cells of each choice of k bands (k is 3, up to 6 for very many
points), pairs out of Manhattan range are passed over, the others are verified on
the bits.

Rows of a cell are compared in sorted runs with vectorised arithmetic, and only
a spanning forest of a run's links leaves the task: components keep every link's
effect, but no group emits all its pairs. A link of the forest whose ends share an
earlier cell too is left to that one. A cell with more points than
``cell_rows`` is split into blocks, and each pair of blocks is a cell of its own.

Null texts count as empty, empty texts get fingerprint zero and link like any
other; equal ids with different texts are different rows of one node. Rows without an id
link to nothing and have no component, whatever their texts; ``keep_one`` keeps them all.
An empty table gives an empty result. Texts of any length are read whole, in blocks of shingles.

``near_duplicates`` answers on fingerprints alone: components of all links. ``keep_one`` answers on texts: its fingerprints
vote over the distinct word pairs of a text, which a changed word moves far less than its long shingles, so that
six bits reach most texts of a similarity of 0.8. Texts of the same words are one; their links within six bits make
groups, and within a group every two texts in range are compared: a row goes if and only if the exact Jaccard
similarity of its five-word shingles to those of some text of a smaller id within six bits is 0.8 or more. No
candidate is passed over: pairs are met inside the tasks, where a large group is split into blocks and each pair of
blocks is a piece of work of its own, so no row is made for each pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nodeloom.llm.common import bound_batches, by_batch, cut, fresh, join_split
from nodeloom.llm.components import connected_components

#: Points of one cell that are compared in one piece.
CELL_ROWS = 16_384
SEED = 42
#: Words of a fingerprint's features, differing bits, words of a shingle and similarity of ``keep_one``.
PAIR_WORDS, SIMILAR_BITS, SHINGLE, SIMILARITY = 2, 6, 5, 0.8
#: Texts and shingles of a block, two of which are compared in one piece.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 1 << 20
_EVEN = 0x5555555555555555


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a text, in blocks; fewer words than a shingle are one, none are none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        yield np.array([h(joined, SEED)], dtype="<u8")
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[: len(words) - shingle] + 1)).tolist()
    ends = ends[shingle - 1 :].tolist()
    for at in range(0, len(begins), 65_536):
        yield np.array([h(joined[a:b], SEED) for a, b in zip(begins[at : at + 65_536], ends[at : at + 65_536])], dtype="<u8")


def fingerprint(text: str | None, shingle: int = 4, distinct: bool = False) -> int:
    """Majority vote over the XXH64 of word shingles, repeats included unless ``distinct``."""
    votes, n = np.zeros(64, np.int64), 0
    blocks = shingle_hashes(text, shingle)
    for block in [shingle_set(text, shingle)] if distinct else blocks:
        n += len(block)
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little") if n else 0


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending."""
    blocks = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(blocks)) if blocks else np.empty(0, "<u8")


def fingerprints(docs: DataFrame, shingle: int = 4, distinct: bool = False) -> DataFrame:
    """doc_id, fp long (the 64 bits, signed)."""

    def work(columns):
        values = [fingerprint(t, shingle, distinct) for t in columns[1]]
        return [columns[0], [v - (1 << 64) if v >> 63 else v for v in values]]

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, fp long", work)


def embed(fp):
    """Counts of set bits per two-bit segment, side by side in one 64-bit value (0, 1 or 2 in each segment)."""
    low, high = fp.bitwiseAND(F.lit(_EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_EVEN))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _bands(n: int) -> list[int]:
    """Masks that deal the 32 segments into n bands."""
    return [sum(3 << 2 * s for s in range(k * 32 // n, (k + 1) * 32 // n)) for k in range(n)]


def shared_bands(points: int, most: int) -> int:
    """How many bands make a cell, 3 to 6: more for more points, so that a cell of unrelated points keeps to some dozens."""
    bits = -32 * math.log2(3 / 8)  # two points agree in a two-bit count with probability 3/8
    return next((k for k in range(3, 6) if points <= 64 * 2 ** (bits * k / (most + k))), 6)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _counts(x: np.ndarray) -> np.ndarray:
    """``embed`` of an array."""
    even = np.uint64(_EVEN)
    return (x & even) + (x >> np.uint64(1) & even)


def _near(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Pairs in Manhattan range of their embeddings and, verified, in Hamming range."""
    even = np.uint64(_EVEN)
    p, q = _counts(x), _counts(y)
    # per-segment |p - q| is 0, 1 or 2: equal parity leaves only the high bit to differ
    odd, high = (p ^ q) & even, (p ^ q) >> np.uint64(1) & even
    distance = np.bitwise_count(odd) + 2 * np.bitwise_count(high & ~odd)
    near = distance <= most
    near[near] = np.bitwise_count((x ^ y)[near]) <= most
    return near


def _joins(run: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """Places (i, j) of links that span what is linked within each run (rows of one run stand side by side)."""
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    sizes = np.diff(np.append(starts, len(run)))
    small = np.repeat(sizes <= 64, sizes)
    joins, root = [], np.arange(len(run))
    for k in range(1, min(64, int(sizes.max(initial=0)))):  # pairs of small runs, by their distance in the run
        i = np.flatnonzero((run[k:] == run[:-k]) & small[k:])
        if not len(i):
            break
        i = i[root[i] != root[i + k]]  # what is in one group already needs no further link
        i, before = i[_near(fp[i], fp[i + k], most)], len(joins)
        for x in i.tolist():
            a, b = x, x + k
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
                joins.append((x, x + k))
        while len(joins) > before and (root[root] != root).any():
            root = root[root]
    for s, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        x, group = fp[s : s + n], np.arange(n)
        for i in range(n - 1):
            other = np.flatnonzero(group[i + 1 :] != group[i]) + i + 1
            other = other[_near(np.broadcast_to(x[i], len(other)), x[other], most)]
            for g, j in zip(*(v.tolist() for v in np.unique(group[other], return_index=True))):
                joins.append((s + i, s + int(other[j])))
                group[group == g] = group[i]
    return np.array(joins, np.int64).reshape(-1, 2).T


def _links(cell: np.ndarray, kind: np.ndarray, own: np.ndarray, fp: np.ndarray, node: np.ndarray, most: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that, with those of the other runs, connect what is linked within each run of equal cells and kinds (sorted rows).

    Every link is followed. It is returned by the first run that its two points share: what a cell of an earlier kind
    connects, or the piece of one block alone (own is -1 there, the point's block in the pieces of two), is left to that one.
    """
    n = most + shared
    masks, kinds = np.array(_bands(n), np.uint64), list(combinations(range(n), shared))
    inside = np.array([[b in c for b in range(n)] for c in kinds])
    earlier = np.array([[b < c[-1] and b not in c for b in range(n)] for c in kinds])
    new = (cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])
    i, j = _joins(np.concatenate(([0], np.cumsum(new))), fp, most)
    agree = ((_counts(fp[i]) ^ _counts(fp[j]))[:, None] & masks) == 0
    elsewhere = (agree & earlier[kind[i]]).any(axis=1) | (own[i] >= 0) & (own[i] == own[j])
    mine = ~(elsewhere & (agree | ~inside[kind[i]]).all(axis=1))
    return node[i[mine]], node[j[mine]]


def links(points: DataFrame, most: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``most`` bits. points: distinct fp, node."""
    shared = shared_bands(points.count(), most)
    n = most + shared
    masks = _bands(n)
    point = points.where("node is not null").select("fp", "node", embed(F.col("fp")).alias("p"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.xxhash64(F.lit(k), F.col("p").bitwiseAND(F.lit(_signed(sum(masks[i] for i in c))))).alias("cell")) for k, c in enumerate(combinations(range(n), shared))])
    cells = point.select("fp", "node", F.explode(kinds).alias("c")).select("c.cell", "c.kind", F.lit(-1).alias("own"), "fp", "node")
    hot = cells.groupBy("cell").count().where(F.col("count") > cell_rows).select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("blocks"))
    hot = cut(hot)
    count = hot.count()
    if count:
        hot = F.broadcast(hot) if count <= 100_000 else hot
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
        piece = lambda j: F.struct(F.xxhash64("cell", F.least(own, j), F.greatest(own, j)).alias("cell"), F.when(own == j, -1).otherwise(own).alias("own"))
        spread = F.when(F.col("blocks").isNull(), F.array(F.struct("cell", "own"))).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), piece))
        cells = cells.join(hot, "cell", "left").select(F.explode(spread).alias("c"), "kind", "fp", "node").select("c.cell", "kind", "c.own", "fp", "node")
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "kind", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def out(block):
            cell, kind, own, fp, node = block
            a, b = _links(cell, kind, own, fp.view(np.uint64), node, most, shared)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            now = [batch.column(k).to_numpy() for k in range(5)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole:
                yield out([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held is not None and len(held[0]):
            yield out(held)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, most: int = 4, shingle: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links of at most ``most`` differing bits), one row per document."""
    marked = cut(fingerprints(docs, shingle))
    points = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")))
    groups = connected_components(links(points, most, cell_rows))
    of_point = cut(points.join(groups, "node", "left").select("fp", "n", F.coalesce("component", "node").alias("component_id")))
    found = join_split(marked, of_point, "fp", marked.count())
    return found.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def _marks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (which tells texts of one id apart), fp, words (a digest of the lower-cased words) of the rows with an id."""

    def work(columns):
        values = [fingerprint(t, PAIR_WORDS, True) for t in columns[2]]
        words = [hashlib.blake2b(b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split()), digest_size=16).digest() for t in columns[2]]
        return [columns[0], columns[1], [v - (1 << 64) if v >> 63 else v for v in values], words]

    return by_batch(_known(docs), "doc_id long, text_hash long, fp long, words binary", work)


def _known(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text of the rows with an id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").where("doc_id is not null")


def _sets(members: DataFrame, shingle: int) -> DataFrame:
    """group, node, text_hash, fp and, in place of text, shingles (distinct hashes)."""
    work = lambda c: [*c[:4], [shingle_set(t, shingle).view(np.int64) for t in c[4]]]
    return by_batch(members.select("group", "node", "text_hash", "fp", "text"), "group long, node long, text_hash long, fp long, shingles array<long>", work)


def _similar(node: np.ndarray, fp: np.ndarray, own: np.ndarray | None, ends: np.ndarray, shingles: np.ndarray, most: int, similarity: float) -> list[int]:
    """Places of the texts that are similar to a text of a smaller node; shingles ends[i] to ends[i + 1] are those of text i. own: blocks; given them, texts of one block are not compared."""
    sizes, found = np.diff(ends), []
    held, shingles = np.unique(shingles, return_inverse=True)
    mark = np.zeros(len(held), bool)
    for x in range(len(node)):
        bits = np.bitwise_count(fp ^ fp[x])
        near = (node < node[x]) & (bits <= most) & (np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x]))
        if own is not None:
            near &= own != own[x]
        near = np.flatnonzero(near)
        if not len(near):
            continue
        if not sizes[x]:  # only empty ones are near in size, and they are equal
            found.append(x)
            continue
        near = near[np.argsort(bits[near], kind="stable")]
        mark[shingles[ends[x] : ends[x + 1]]] = True
        for at, to in [(0, 8), *((k, k + 256) for k in range(8, len(near), 256))]:  # the nearest first, then all others
            part = near[at:to]
            both = np.concatenate([shingles[ends[y] : ends[y + 1]] for y in part.tolist()])
            common = np.add.reduceat(mark[both], np.cumsum(sizes[part]) - sizes[part], dtype=np.int64)
            if (common >= similarity * (sizes[part] + sizes[x] - common)).any():
                found.append(x)
                break
        mark[shingles[ends[x] : ends[x + 1]]] = False
    return found


def _compare(sets: DataFrame, most: int, similarity: float, block_rows: int) -> DataFrame:
    """node, text_hash of the texts that are similar to one of a smaller node of their group. A group of many texts or shingles is split into blocks, and each pair of blocks is compared in one piece."""
    size, count = F.sum(F.size("shingles")), F.count("*")
    blocks = F.ceil(F.greatest(size / BLOCK_SHINGLES, F.least(count / block_rows, F.greatest(F.lit(16.0), count / (16 * block_rows))))).cast("int")
    large = cut(sets.groupBy("group").agg(blocks.alias("blocks")).where("blocks > 1"))
    large = F.broadcast(large) if large.count() <= 100_000 else large
    own = F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("node", "text_hash"), F.col("blocks")).cast("int"))
    pieces = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda j: F.struct(F.least("own", j).alias("low"), F.greatest("own", j).alias("high")))
    dealt = sets.join(large, "group", "left").withColumn("own", own).withColumn("piece", F.explode(pieces))
    dealt = dealt.select("group", "piece.low", "piece.high", "own", "node", "text_hash", "fp", "shingles").repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            columns = [np.concatenate([p.column(k).to_numpy() for p in parts]) for k in range(1, 7)]
            low, high, own, node, text_hash, fp = columns
            sizes = np.concatenate([p.column(7).value_lengths().to_numpy(zero_copy_only=False) for p in parts]).astype(np.int64)
            shingles = np.concatenate([p.column(7).flatten().to_numpy() for p in parts])
            gone = _similar(node, fp.view(np.uint64), own if low[0] != high[0] else None, np.concatenate(([0], np.cumsum(sizes))), shingles, most, similarity)
            return pa.RecordBatch.from_arrays([pa.array(node[gone], pa.int64()), pa.array(text_hash[gone], pa.int64())], names=["node", "text_hash"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            starts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                if held and [held[0].column(k)[0].as_py() for k in range(3)] != key[:, a].tolist():
                    yield out(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield out(held)

    bound_batches(sets.sparkSession)
    return dealt.mapInArrow(run, "node long, text_hash long").distinct()


def similar_to_earlier(docs: DataFrame, most: int = SIMILAR_BITS, shingle: int = SHINGLE, similarity: float = SIMILARITY, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, text_hash of the rows whose shingles have at least this Jaccard similarity with those of any row of a smaller id whose fingerprint differs in at most ``most`` bits.

    Rows without an id take no part. Rows of one id are told apart by the hash of their texts.
    """
    marked = cut(_marks(docs))
    first = F.min(F.struct("doc_id", "text_hash"))
    texts = cut(marked.groupBy("words").agg(first.alias("first"), F.first("fp").alias("fp"), F.count("*").alias("n")).select("words", "first.*", "fp", "n").withColumnRenamed("doc_id", "node"))
    points = cut(texts.groupBy("fp").agg(F.count("*").alias("n")))
    groups = connected_components(links(points.select("fp", F.col("fp").alias("node")), most, cell_rows))
    groups = points.join(groups, points.fp == groups.node, "left").where("component is not null or n > 1").select("fp", F.coalesce("component", "fp").alias("group"), "n")
    members = cut(join_split(texts.select("node", "text_hash", "fp"), cut(groups), "fp", texts.count()))
    whole = _known(docs).withColumnRenamed("doc_id", "node").join(members, ["node", "text_hash"]).dropDuplicates(["node", "text_hash"])
    gone = cut(_compare(cut(_sets(whole, shingle)), most, similarity, block_rows))
    # of texts with the same words all but the first go, and with the first all
    settled = texts.join(gone.withColumn("gone", F.lit(True)), ["node", "text_hash"], "left").where("gone or n > 1")
    rows = join_split(marked.select("doc_id", "text_hash", "words"), cut(settled.select("words", "node", "gone", "n")), "words", marked.count())
    return rows.where("gone or doc_id > node").select("doc_id", "text_hash").distinct()


def keep_one(docs: DataFrame, most: int = SIMILAR_BITS, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of docs without those similar to an earlier document (``similar_to_earlier``), with all columns; of rows with one id and text, one.

    The first document of a group of near-duplicates stays, as each that goes is similar to one of a smaller id.
    Texts are shuffled once, by id and text. Rows of one id are told apart by their texts' 64-bit hashes.
    """
    known, missing, hashed, nth = fresh(docs, "_row_id", "_row_null", "_row_text", "_nth")
    gone = similar_to_earlier(docs, most, shingle, similarity).select(F.col("doc_id").alias(known), F.lit(False).alias(missing), F.col("text_hash").alias(hashed))
    keyed = docs.withColumns({known: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), missing: F.col("doc_id").isNull(), hashed: F.xxhash64("text")})
    kept = keyed.join(gone, [known, missing, hashed], "left_anti")
    first = F.row_number().over(Window.partitionBy(known, missing, hashed).orderBy("doc_id"))
    return kept.withColumn(nth, first).where(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
