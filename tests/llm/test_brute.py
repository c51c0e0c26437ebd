"""Brute-force versions of operators whose results SQL cannot give, and cases that once went wrong."""

import math
import random
import re
import struct
import time
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from nodeloom.llm import exactdedup, langid, license, mixing, orderminhash, pii, simhash, toxicity, warc
from nodeloom.llm.components import connected_components


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# -- Order MinHash by its definition


def xx(*values, seed=42):
    """Spark's xxhash64 of several columns: each is hashed with the hash before it as seed; nulls leave it as it is."""
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<i", v.n) if isinstance(v, Int) else struct.pack("<Q", v & (1 << 64) - 1), seed)
    return seed


class Int:
    def __init__(self, n):
        self.n = n


def order_minhash(text, k=3, slots=64, take=2):
    """Fingerprint of a text: {slot: signature} with 34-bit k-mer hashes, numbered, minimal, in text order."""
    above = lambda h: h >> 30 << 30
    words = re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\x0c\r")) if text.strip(" \t\n\x0b\x0c\r") else []
    kmers = [above(xx(*[words[i - d] if i >= d else None for d in range(k - 1, 0, -1)], words[i])) for i in range(len(words))]
    seen, numbered = {}, []
    for i, h in enumerate(kmers):
        n = seen[h] = seen.get(h, -1) + 1
        numbered.append((above(xx(h, Int(n))), i))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    out = {}
    for slot in range(slots):
        least = sorted((signed(h), i) for h, i in numbered if h >> 58 == slot)[:take]
        if least:
            out[slot] = xx(*[kmers[i] for i in sorted(i for _, i in least)]) & 0xFFFFFFFF
    return out


def test_order_minhash_equals_its_definition(spark):
    rng = random.Random(21)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "dé", "e"]) for _ in range(rng.randint(0, 400)))) for i in range(40)] + [(40, "x " * 300), (41, None), (42, "one"), (43, " two  words\n")]
    found = sorted(orderminhash.compare_neighbours(texts(spark, rows)).collect(), key=lambda r: r.doc_id)
    plain = [t or "" for _, t in rows]

    def like(a, b):
        return 1.0 if not a and not b else sum(a.get(s) == v for s, v in b.items()) / len({*a, *b})

    for r, t, n in zip(found, plain, plain[1:] + plain[:1]):
        half = len(t) // 2
        own, edited, after = order_minhash(t), order_minhash(t[: len(t) - half] + n[:half]), order_minhash(n)
        spell = lambda f: "".join(f"{s:02x}{v:08x}" for s, v in sorted(f.items()))
        assert (r.fingerprint, r.edited_fingerprint) == (spell(own), spell(edited))
        assert r.near_edited == pytest.approx(like(own, edited)) and r.near_next == pytest.approx(like(own, after))


def test_neighbours_over_hot_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(orderminhash, "RANGES_LEAST", 16)
    rng = random.Random(22)
    ids = [None] * 300 + [7] * 300 + [rng.randrange(-50, 500) for _ in range(300)]
    rows = [(i, f"text {n % 290}") for n, i in enumerate(ids)]
    keyed = texts(spark, rows).repartition(5)
    order = sorted(((i is not None, i or 0, xx(t) - (1 << 64) if xx(t) >> 63 else xx(t), t) for i, t in rows))
    expected = sorted((k[1] if k[0] else None, k[3], n[3]) for k, n in zip(order, order[1:] + order[:1]) if k[0])
    found = orderminhash.with_next(keyed, F.col("text"), "next").collect()
    assert sorted((r.doc_id, r.text, r.next) for r in found if r.doc_id is not None) == expected
    assert sorted((r.text, r.next) for r in found if r.doc_id is None) == sorted((k[3], n[3]) for k, n in zip(order, order[1:]) if not k[0])
    keys = keyed.select("doc_id", F.xxhash64("text").alias("hash"))
    assert len([s for s in orderminhash.range_starts(keys) if s[:2] == (1, 7)]) > 2  # the hot id is dealt out
    assert len([s for s in orderminhash.range_starts(keys) if not s[0]]) > 2  # and so are null ids


# -- SimHash and components


def test_rows_without_id_have_no_component(spark):
    d = texts(spark, [(5, "one two three four five"), (None, "one two three four five"), (None, "else"), (9, "one two three four five")])
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(d).collect()}
    assert found == {(5, 5), (9, 5), (None, None)}
    assert sorted((r.doc_id or 0) for r in simhash.keep_one(d).collect()) == [0, 0, 5]


def test_keep_one_drops_similar_texts_only(spark):
    rng = random.Random(28)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    rows = []
    for g in range(60):
        base = [word() for _ in range(rng.randint(40, 400))]
        rows.append(base)
        for _ in range(rng.choice((0, 1, 3, 12))):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            rows.append(copy)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)] + [(9000, ""), (9001, " "), (9002, None), (9003, "one two"), (9004, "ONE two"), (9005, "same id"), (9005, "other text"), (None, "one two")]
    sets = {(i, t): set(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    near = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    usual = sorted((k for k in sets if k[0] is not None and k[0] != 9005), key=lambda k: k[0])
    similar = {k for n, k in enumerate(usual) if any(near(sets[k], sets[j]) for j in usual[:n])}
    for cell_rows in (10_000, 30):
        gone = {r.doc_id for r in simhash.similar_to_earlier(texts(spark, rows), cell_rows=cell_rows).collect()}
        assert gone <= {i for i, _ in similar} and len(gone) >= 0.8 * len(similar)  # nothing but similar texts goes, and most of them do
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(texts(spark, rows + rows[:1])).collect()]
    assert sorted(map(str, kept)) == sorted(str((i, t)) for i, t in rows if i not in gone)


@pytest.mark.parametrize("cell_rows, block_rows", [(10_000, 256), (40, 6)])
def test_similar_to_earlier_tries_every_candidate(spark, cell_rows, block_rows):
    """Near copies whose similarity among each other lies about 0.8: the smallest and the nearest neighbours are often not similar, others are."""
    rng = random.Random(31)
    rows = [(20_000, ""), (20_001, " "), (20_002, None)]
    for g, (size, copies, changes) in enumerate([(150, 160, 14), (900, 40, 25), (40, 30, 2)]):
        base = [f"w{rng.randrange(4000)}" for _ in range(size)]
        for i in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, changes)):
                copy[rng.randrange(size)] = f"x{rng.randrange(4000)}"
            rows.append((1000 * g + i, " ".join(copy)))
            if i % 9 == 0:  # the same words again, under a later and under the same id
                rows += [(1000 * g + 500 + i, "  ".join(copy).upper()), (1000 * g + i, "\t".join(copy))]
            if i % 7 == 0:  # another text under the same id
                rows.append((1000 * g + i, " ".join(reversed(copy))))
    rows += rows[:40] + [(None, rows[5][1])]
    fp = {t: simhash.fingerprint(t, 2, True) for _, t in rows}
    sets = {t: set(simhash.shingle_set(t, 5).tolist()) for _, t in rows}
    near = lambda t, u: (fp[t] ^ fp[u]).bit_count() <= 6 and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u])
    known = [r for r in set(rows) if r[0] is not None]
    gone = {(i, t) for i, t in known if any(j < i and near(t, u) for j, u in known)}
    hashes = {(r.doc_id, r.h): r.text for r in texts(spark, rows).select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    found = simhash.similar_to_earlier(texts(spark, rows), cell_rows=cell_rows, block_rows=block_rows).collect()
    assert len(found) == len(gone) and {(r.doc_id, hashes[r.doc_id, r.text_hash]) for r in found} == gone
    kept = Counter((r.doc_id, r.text) for r in simhash.keep_one(texts(spark, rows)).collect())
    assert kept == Counter(set(rows) - gone)


def test_hub_components(spark):
    rng = random.Random(23)
    links = [(0, i) for i in range(1, 4000)] + [(10_000 + i, 10_001 + i) for i in range(50)] + [(rng.randrange(20_000, 21_000), rng.randrange(20_000, 21_000)) for _ in range(600)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[x] == root(x) for a, b in links if a != b for x in (a, b))


def test_exact_dedup_keeps_one_of_hot_texts_and_null_ids(spark):
    rows = [(i, "Hot text") for i in range(500)] + [(None, "hot TEXT")] * 3 + [(i, f"own {i % 40}") for i in range(1000, 1100)] + [(None, "only null")] * 2
    d = spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, row int, _row_id string")
    for support in (0.001, 0.3):
        kept = exactdedup.keep_one(d, support)
        assert kept.columns == d.columns
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in kept.collect()) == sorted([(499, "Hot text"), (-1, "only null")] + [(max(i for i, t in rows if t == x), x) for x in {f"own {k}" for k in range(40)}])


# -- language


def test_only_letters_make_words(spark):
    model = langid.build([("en", "<th", 9), ("en", "the", 9), ("en", "\0latin", 90), ("de", "<de", 9), ("de", "\0latin", 90)])
    labeller = langid.Labeller(model)
    for text in ("½ ②", "² ① Ⅷ", "12 ३", "__ !"):
        assert labeller.predict(text) == ("und", 0.0)
    assert langid.letter_runs("ab½cd ② Ⅷx") == ["ab", "cd", "x"]


def test_long_runs_are_read_whole(spark):
    rows = [(lang, g, n) for lang, word in (("aa", "a" * 9), ("bb", "b" * 9)) for g, n in [(g, 9) for g in langid.grams(word)] + [("\0latin", 99)]]
    labeller = langid.Labeller(langid.build(rows))
    assert labeller.predict("a" * 64 + "b" * 5000)[0] == "bb"
    assert [s[2] for s in labeller.spans("a" * 640 + "b" * 640)] == ["aa", "bb"]
    for n in (1, 63, 64, 65, 128, 129, 1000):
        run = "".join(random.Random(n).choice("abcdé") for _ in range(n))
        whole = [f"<{run}>"[i : i + 3] for i in range(n)]
        words, sizes = langid.units(run)
        assert sum(sizes) == n and [g for w in words for g in langid.grams(w)] == whole


def test_word_scores_are_sums_of_trigram_logs(spark):
    rows = [("en", "the", 5), ("en", "<th", 4), ("en", "\0latin", 50), ("de", "der", 6), ("de", "<de", 3), ("de", "\0latin", 50)]
    model, counts = langid.build(rows), {("en", "the"): 5, ("en", "<th"): 4, ("de", "der"): 6, ("de", "<de"): 3}
    kinds, total = {"en": 2, "de": 2}, {"en": 9, "de": 9}
    for word in ("the", "der", "xyz", "thede"):
        raw = {lang: sum(math.log((counts.get((lang, g), 0) + 0.5) / (total[lang] + 0.5 * kinds[lang] * 2 / 1 * 1 + 1)) for g in [f"<{word}>"[i : i + 3] for i in range(len(word))]) for lang in ("de", "en")}
        best = max(raw.values())
        assert model.word(word) == pytest.approx([max(raw[lang] - best, -20.0) for lang in ("de", "en")])


def test_fit_takes_each_text_once(spark):
    rows = [(i, "copy of one text", "en") for i in range(2000)] + [(5000 + i, f"word{chr(97 + i % 26)} other{chr(97 + i // 26)}", "en") for i in range(300)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=200)
    assert "<wo" in model.scores and "<ot" in model.scores  # copies do not fill the sample


# -- personal data


def test_located_is_fast_on_many_matches(spark):
    many = texts(spark, [(1, "4111 1111 1111 1111 x " + " a".join(map(str, range(40_000)))), (2, "a@b.co " * 20_000)])
    pii.find_base(many.limit(0)).collect()
    began = time.time()
    found = {r.doc_id: r for r in pii.find_base(many).collect()}
    assert time.time() - began < 30
    assert len(found[1].card) == 1 and len(found[2].email) == 20_000 and found[2].email[-1].start == 19_999 * 7


def test_repeated_rows_change_nothing(spark):
    rows = [(0, "Quimby writes from ann@x.org today"), (1, "Quimby came by")] + [(20 + i, f"she writes mail from home today {i}") for i in range(60)]
    once = {r.doc_id: r.spans for r in pii.summary(texts(spark, rows)).collect()}
    again = pii.summary(texts(spark, rows + [rows[1]] * 30)).collect()
    assert once[0].endswith(",term:0:6") and all(r.spans == once[r.doc_id] for r in again)


def test_disclosure_equals_its_formula(spark):
    rng = random.Random(24)
    words = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([rng.choice(words) for _ in range(rng.randint(3, 12))] + ([f"e{rng.randrange(6)}@x.org"] if i % 3 == 0 else []))) for i in range(120)]
    rows += rows[:10]
    plain = sorted({t for _, t in rows})
    mail = {t: set(re.findall(r"e\d@x\.org", t)) for t in plain}
    terms = {t: set(re.findall(r"[^\W_]+", t.lower())) for t in plain}
    n = len(plain)
    telling = set()
    for e in {e for t in plain for e in mail[t]}:
        with_e = [t for t in plain if e in mail[t]]
        for w in {w for t in with_e for w in terms[t]}:
            both, n_t = sum(w in terms[t] for t in with_e), sum(w in terms[t] for t in plain)
            if math.log(n * both / (len(with_e) * n_t)) / math.log(n / len(with_e)) >= pii.THRESHOLD:
                telling.add(w)
    for r in pii.summary(texts(spark, rows)).collect():
        text = dict(rows)[r.doc_id]
        inside = [(m.start(), m.end()) for m in re.finditer(r"e\d@x\.org", text)]
        expected = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W_]+", text) if m[0].lower() in telling and not any(a < m.end() and m.start() < b for a, b in inside)]
        assert [s for s in r.spans.split(",") if s.startswith("term")] == expected
    assert telling


# -- WARC


def test_warc_bounds_are_exact_and_files_roll(spark, tmp_path):
    rng = random.Random(25)
    ids = [rng.randrange(1000) for _ in range(500)] + [10**12 + k for k in range(300)] + [None] * 3
    pages = spark.createDataFrame([(i, None, "x" * rng.randrange(400), "extra", 1) for i in ids], "page_id long, url string, html string, digest string, range int")
    narrow = warc.measured(pages)
    bounds = warc.range_bounds(narrow, 2000)
    assert bounds == sorted(set(bounds)) and bounds[0] == min(i for i in ids if i is not None)
    sizes = [0] * len(bounds)
    rows = [(r.page_id, len(r.html)) for r in pages.collect() if r.page_id is not None]
    for i, n in rows:
        sizes[max(k for k, b in enumerate(bounds) if b <= i)] += n
    assert all(s <= 2000 or len({i for i, _ in rows if b <= i and (k + 1 == len(bounds) or i < bounds[k + 1])}) == 1 for k, (b, s) in enumerate(zip(bounds, sizes)))
    for k, d in enumerate((pages, pages.repartition(7))):
        assert warc.write(d, f"file://{tmp_path}/w{k}", range_bytes=2000, roll_bytes=300).agg(F.sum("records")).first()[0] == len(ids)
        assert warc.read(spark, f"file://{tmp_path}/w{k}").count() == len(ids)
    one, two = ({p.name: p.read_bytes() for p in (tmp_path / f"w{k}").glob("*.gz")} for k in range(2))
    assert one == two and max(sum(n.startswith(p) for n in one) for p in {n[:10] for n in one}) > 1


def test_warc_hot_payload_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "") for i in range(3000)] + [(5000 + i, "u", f"p{i // 2}") for i in range(20)] + [(1, "u", "")], "page_id long, url string, html string")
    found = warc.round_trip(pages).collect()
    assert sum(r.record_type == "revisit" for r in found) == 3000 + 10 and {r.refers_to for r in found if r.page_id < 3000} == {None, 0}
    warc.write(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").count() == 0


# -- mixing, licenses, toxicity


def test_mixing_takes_other_weights(spark):
    d = spark.createDataFrame([(i, "word " * 10, s, 100.0 if i % 2 else 0.01) for s in ("a", "b", "c") for i in range(100)], "doc_id long, text string, source string, w double")
    taken = mixing.mix(d, weights=(1.0,), share=0.5, weight=F.col("w")).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("n")).collect()
    assert {r.odd: r.n for r in taken} == {1: 1500, 0: 0}


def test_null_ids_draw_apart(spark):
    d = spark.createDataFrame([(None, f"text {i} " * (i % 9 + 1), "a") for i in range(300)], "doc_id long, text string, source string")
    assert mixing.sized(d).select("step").distinct().count() > 100


def test_license_form_does_not_depend_on_wrapping(spark):
    mit = license.KNOWN[0][1]
    words, rows = mit.split(), []
    for width in (20, 43, 60, 77, 100, 4000):
        lines, line = [], ""
        for w in words:
            if len(line) + len(w) + 1 > width:
                lines, line = [*lines, line], ""
            line = f"{line} {w}".strip()
        rows.append("Copyright 2019 Some Body\n" + "\n".join([*lines, line]))
    at = mit.index("COPYRIGHT HOLDERS")
    rows += [mit[:at] + "\n" + mit[at:], "(c) Some Body\n" + mit, "copyright Some Body\nAll rights reserved.\n" + mit, mit + " " * 5000, mit.replace("holders", "owners")]
    found = {r.doc_id: r for r in license.scan(texts(spark, list(enumerate(rows)))).collect()}
    assert all(found[i].license == "MIT" for i in range(len(rows)))
    assert found[len(rows) - 2].n_notices == 0
    one = " ".join(mit.split())
    lines = license.scan(texts(spark, [(1, "x\n" + one + " " * 6000 + "\ny"), (2, " ".join(["filler"] * 2000) + "\n# SPDX-License-Identifier: MIT")])).collect()
    assert {r.doc_id: r.notices for r in lines} == {1: "MIT", 2: "MIT"}


def test_adjacent_spellings_are_each_replaced(spark):
    d = texts(spark, [(1, "owner owner whilst whilst sub licence"), (2, "holder holder while while sublicense")])
    assert len({r.digest for r in license.scan(d).collect()}) == 1


def test_license_equals_sql(spark):
    import duckdb
    import pandas as pd

    from nodeloom.llm.license_sql import scan_sql

    rng, parts = random.Random(26), [t for _, t in license.KNOWN] + ["Copyright 2020 A", "copyright holders be liable", "(c) B", "copyright C D", "owner owner", "sub licence", "é non commercial", "", "  "]
    rows = [(i, "\n".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))) for i in range(300)] + [(300, None)] + [(400 + i, t) for i, (_, t) in enumerate(license.full_texts())]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841  read by the SQL
    expected = {r[0]: tuple(r[1:]) for r in duckdb.sql(scan_sql().replace("w.digest\n", "w.digest\n")).fetchall()}
    for r in license.scan(texts(spark, rows)).collect():
        assert tuple(r)[1:] == expected[r.doc_id]


def test_toxicity_features_and_score_by_hand(spark):
    model = toxicity.Model({"moron": False, "worthless": False}, (-2.0, 3.0, 2.5, 0.5, 0.1))
    own = toxicity.Automaton(toxicity.Lexicon(model.entries))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(27)
    for _ in range(200):
        words = [rng.choice(["you", "are", "moron", "m0ron", "worthless", "worthles", "wrthles", "fine", "said", "river"]) for _ in range(rng.randint(0, 40))]
        exact = near = told = 0
        for i, w in enumerate(words):
            d = [distance(w, e) for e in model.entries if distance(w, e) <= (1 if len(e) < 8 else 2)]
            if d and "said" in words[max(0, i - 3) : i]:
                told += 1
            elif d:
                exact, near = exact + (min(d) == 0), near + (min(d) > 0)
        x = (math.log1p(exact), math.log1p(near), math.log1p(told), 100 * exact / max(20, len(words)))
        assert toxicity.features(" ".join(words), own) == pytest.approx(x)
        assert model.score(x) == pytest.approx(1 / (1 + math.exp(-(-2 + 3 * x[0] + 2.5 * x[1] + 0.5 * x[2] + 0.1 * x[3]))))


AWKWARD_PAGES = [(1, "u", "a"), (1, "u", "a"), (2, None, None), (3, "u", ""), (None, None, "a"), (None, "v", None), (4, "u\r\nX: y", "é" * 100_000), (5, "u", "A")]


def test_warc_awkward_pages(spark):
    d = spark.createDataFrame([(i, u, h, 1, "x", "y") for i, u, h in AWKWARD_PAGES], "page_id long, url string, html string, kind int, digest string, refers_to string")
    found = warc.round_trip(d).collect()
    assert sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.record_type) for r in found) == sorted(
        [(1, 1, "response"), (1, 1, "response"), (2, 0, "response"), (3, 0, "revisit"), (-1, 1, "response"), (-1, 0, "response"), (4, 200_000, "response"), (5, 1, "response")]
    )
