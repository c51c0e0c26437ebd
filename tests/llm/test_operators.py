"""The ten operators against brute-force versions, and the awkward inputs each of them defines."""

import base64
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from nodeloom.llm import bpe, exactdedup, langid, license, mixing, orderminhash, pii, simhash, toxicity, warc
from nodeloom.llm.components import connected_components
from nodeloom.llm.queries import default_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, row int, _nth int, fp string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with those used inside the operators."""
    return spark.createDataFrame([(i, t, "en", s, 0, 1, "x", 2, 3, "y") for i, t, s in rows], SCHEMA)


AWKWARD = [(1, "Alpha beta gamma delta epsilon", "a"), (2, None, "a"), (3, "", None), (4, "ALPHA beta gamma delta epsilon", "b"), (4, "ALPHA beta gamma delta epsilon", "b"), (5, "x", None), (6, "word " * 30_000, "a"), (None, "null id", "c"), (7, " \t\n", "c")]
FUNCTIONS = {
    "bpe": lambda d: bpe.digests(d, default_tokenizer()), "orderminhash": orderminhash.compare_neighbours, "simhash": simhash.near_duplicates,
    "langid": lambda d: langid.identify(d, langid.build([("en", "<al", 5), ("de", "<ge", 5), ("en", "\0latin", 9), ("de", "\0latin", 9)])),
    "exact": exactdedup.exact_duplicates, "pii": pii.summary, "mixing": mixing.mix, "license": license.scan, "toxicity": lambda d: toxicity.score(d, toxicity.Model({"idiot": False}, (-3.0, 5.0, 3.0, 0.0, 1.0))),
}


@pytest.mark.parametrize("name", FUNCTIONS)
def test_awkward_and_empty_tables(spark, name):
    d = docs(spark, AWKWARD)
    assert FUNCTIONS[name](d).count() == len(AWKWARD)
    assert FUNCTIONS[name](d.limit(0)).count() == 0


@pytest.mark.parametrize("keep", [exactdedup.keep_one, simhash.keep_one, mixing.mixed, lambda d: langid.keep_known(d, langid.fit(d))])
def test_filters_keep_columns(spark, keep):
    d = docs(spark, AWKWARD)
    assert keep(d).columns == d.columns
    assert keep(d.limit(0)).count() == 0
    keep(d).collect()


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    library, own, rng = Tokenizer.from_file(default_tokenizer()), bpe.load(default_tokenizer()), random.Random(1)
    texts = ["", "inthear" * 900, "!" * 3000, "Don't <|endoftext|> 1234 ΣΑΣ é", "中" * 500]
    texts += ["".join(rng.choice("aabdeth  'streΣσé가\U0001f600中١\x85  \n!.<|") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in bpe.digests(d, default_tokenizer()).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(spark.createDataFrame([(1, "Héllo,  World 42 中文")], "doc_id long, text string"), default_tokenizer()), default_tokenizer()).collect()}
    assert back == {1: "héllo , world 4 2 中文"}
    assert own.lookahead >= own.longest


def test_bpe_window_stays_small():
    own = bpe.load(default_tokenizer())
    whole = own.merged("".join(chr(own.bytes_to_chars[b]) for b in b"thein" * 2000) + own.mark)
    pieces = list(own.tokens("thein" * 2000))
    assert [own.text_of[t] for p in pieces for t in p] == whole
    assert len(pieces) > 2


def test_order_minhash(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["same text here", "same text here", None]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(orderminhash.compare_neighbours(d).collect(), key=lambda r: r.doc_id)
    plain = [t or "" for t in texts]
    for r, t, n in zip(found, plain, plain[1:] + plain[:1]):
        half = len(t) // 2
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert found[60].near_next == 1 and found[60].fingerprint == found[61].fingerprint
    swapped = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "g h i j k l a b c d e f")], "doc_id long, text string")
    assert 0 < orderminhash.compare_neighbours(swapped).where("doc_id = 1").first().near_next < 1


def test_occurrences_number_repeats(spark):
    d = spark.createDataFrame([(1, "a " * n) for n in (5, 6)], "doc_id long, text string")
    a, b = (r.fingerprint for r in orderminhash.compare_neighbours(d).collect())
    assert a != b  # a set of k-mers would not tell them apart


def test_simhash_components(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    fps = {c for c in centres}
    for c in centres[:8]:
        for _ in range(30):
            x = c
            for _ in range(rng.randint(1, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    chain = centres[9]
    for _ in range(100):  # a long chain of near neighbours in one cell
        chain ^= 1 << rng.randrange(8)
        fps.add(chain)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    points = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, node long")
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    for cell_rows in (10_000, 20):
        found = {r.node: r.component for r in connected_components(simhash.links(points, 4, cell_rows)).collect()}
        assert [found.get(i, i) for i in range(len(fps))] == label


@pytest.mark.parametrize("size, cell_rows", [(60, 10_000), (300, 10_000), (60, 20)])
def test_simhash_links_grow_with_the_points(spark, size, cell_rows):
    """Two groups of near fingerprints: their links connect what all pairs connect, and are a few a point, not a number a pair."""
    rng = random.Random(33)
    fps = set()
    for centre in (rng.getrandbits(64), rng.getrandbits(64)):
        group = {centre}
        while len(group) < size:
            x = rng.choice(sorted(group)) if rng.random() < 0.1 else centre
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            group.add(x)
        fps |= group
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 6 and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    points = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, node long")
    found = simhash.links(points, 6, cell_rows).cache()
    pairs = [(r.a, r.b) for r in found.collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 6 for a, b in pairs) and len(pairs) <= 6 * len(fps)
    components = {r.node: r.component for r in connected_components(found).collect()}
    assert [components.get(i, i) for i in range(len(fps))] == label


def test_simhash_embedding_is_a_lower_bound(spark):
    rng = random.Random(4)
    rows = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(50)]
    out = spark.createDataFrame(rows, "a long, b long").select("a", "b", simhash.embed(F.col("a")).alias("p"), simhash.embed(F.col("b")).alias("q")).collect()
    for r in out:
        p, q = ([(x >> 2 * s) & 3 for s in range(32)] for x in (r.p & (1 << 64) - 1, r.q & (1 << 64) - 1))
        assert sum(p) == r.a.bit_count()
        assert sum(abs(x - y) for x, y in zip(p, q)) <= (r.a ^ r.b).bit_count()


def test_exact_dedup(spark):
    rows = [(i, ["Hot", "hOT", "é", "É", "", None][i % 6] if i % 7 else f"own {i}", "s") for i in range(300)]
    d = docs(spark, rows)
    plain = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for i, t, _ in rows}
    for support in (0.001, 0.2):
        found = exactdedup.exact_duplicates(d, support).collect()
        assert len(found) == 300
        for r in found:
            same = [i for i, t in plain.items() if t == plain[r.doc_id]]
            assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))
            assert r.text_sha256 == hashlib.sha256(plain[r.doc_id].encode()).hexdigest()
    assert exactdedup.keep_one(docs(spark, rows + rows)).count() == len(set(plain.values()))


def _luhn(d):
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".") if x.isdigit()), "card": 13 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                yield f"{kind}:{m.start()}:{m.end()}"


def test_pii_base(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aB1 2.3-+@45()9_%xé0.") for _ in range(120)) for _ in range(500)] + ["a@b.com_c@d.com 4111 1111-1111 1111 +49 (151) 123-4567 1.2.3.4.5.6.7.8 00.1.2.300", "1" * 5000 + " 1" * 5000, "x@" + "a." * 3000 + "b " + "a" * 50_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.summary(d).collect():
        expected = ",".join(base_spans(texts[r.doc_id]))
        assert r.spans.split(",term:")[0] == expected
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()


def test_pii_disclosure(spark):
    rows = [(i, f"note {i} Zanzibar mail bob@x.org filler{i % 3} word") for i in range(4)] + [(100 + i, f"plain filler{i % 3} word note text {i}") for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.summary(d).collect()}
    assert spans[0] == "email:21:30,term:7:15,term:16:20" and spans[100] == ""
    assert {r.doc_id: r.text for r in pii.sanitise(d).collect()}[0] == "note 0 [...] [...] [EMAIL] filler0 word"
    copies = spark.createDataFrame([(i, "one text with bob@x.org only") for i in range(50)], "doc_id long, text string")
    assert all("term" not in r.spans for r in pii.summary(copies).collect())  # copies are one piece of evidence


def test_pii_disclosure_of_rare_entities(spark):
    rows = [(0, "Quimby writes from ann@x.org today"), (1, "Tuttle mail bob@y.org today"), (2, "Tuttle writes bob@y.org today")] + [(10 + i, "he writes mail from home today") for i in range(2)] + [(20 + i, f"she writes mail from home today {i}") for i in range(30)]
    spans = {r.doc_id: r.spans for r in pii.summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[0] == "email:19:28,term:0:6"  # one text
    assert spans[1] == "email:12:21,term:0:6" and spans[2] == "email:14:23,term:0:6"  # two texts
    assert all(spans[i] == "" for i, _ in rows[3:])


def test_pii_terms_in_texts_without_the_entity(spark):
    rows = [(0, "Kim writes bob@x.org"), (1, "today 李雷 writes to ann@y.org"), (2, "😀 KIM came, 李雷 left; Kimono")] + [(10 + i, f"she writes to them and came and left today {i}") for i in range(60)]
    spans = {r.doc_id: r.spans for r in pii.summary(spark.createDataFrame(rows + [(3, rows[2][1])], "doc_id long, text string")).collect()}
    assert spans[0] == "email:11:20,term:0:3" and spans[1] == "email:19:28,term:6:8"
    assert spans[2] == spans[3] == ",term:2:5,term:12:14"
    assert all(spans[10 + i] == "" for i in range(60))


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", [None, "", "same", f"<p>é {i}</p>" * 50][i % 4]) for i in range(200)] + [(None, None, "no id")], "page_id long, url string, html string")
    rows = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    first = {}
    for i in sorted(rows, key=lambda x: (x is None, x)):
        first.setdefault(rows[i], i)
    for k in range(2):
        manifest = warc.write(pages, f"file://{tmp_path}/w{k}", roll_bytes=2000)
        assert manifest.agg(F.sum("records")).first()[0] == len(rows)
        found = warc.read(spark, f"file://{tmp_path}/w{k}").collect()
        assert len(found) == len(rows)
        for r in found:
            body = rows[r.page_id]
            own = first[body] == r.page_id
            assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if own else "revisit", None if own else first[body])
            assert r.html == (body.decode() if own else None)
    one, two = ({p.name: p.read_bytes() for p in (tmp_path / f"w{k}").glob("*.gz")} for k in range(2))
    assert one == two and len(one) > 4  # the same bytes again
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 50), rng.choice(["a", "b", "c", "é", None])) for i in range(2000)] + [(10_000 + i, "w " * 40, "big") for i in range(1000)]
    found = mixing.mix(docs(spark, rows)).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    total, taken, target, whole = sum(size.values()), {}, {}, {}
    for r in found:
        assert r.size == size[r.doc_id] and r.taken in (0, r.size, 2 * r.size)
        s = of[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        target[s], whole[s] = r.target, r.source_size
    weights = dict(zip(sorted(k for k in target if k) + [None], [5, 2, 1] * 9))
    expected, left, free = {}, 1.5 * total, set(target)
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * whole[s]}
        if not over:
            expected |= share
            break
        for s in over:
            expected[s] = 2.0 * whole[s]
        left, free = 1.5 * total - sum(expected.values()), free - over
    for s in target:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 50
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs(spark, rows).repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in found}
    assert mixing.mixed(docs(spark, rows)).count() == sum(r.times for r in found)


def test_license(spark):
    mit = license.KNOWN[0][1]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, mit.replace("sublicense", "sub-license")), (3, mit + " more"), (4, "text\nReleased under the MIT Licence.\nSPDX-License-Identifier: Apache-2.0"), (5, None)]
    found = {r.doc_id: (r.license, r.n_notices, r.notices) for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: ("MIT", 0, ""), 2: ("MIT", 0, ""), 3: (None, 0, ""), 4: (None, 2, "Apache-2.0,MIT"), 5: (None, 0, "")}


def test_license_full_texts_and_lines_without_the_word(spark):
    texts = dict(license.full_texts())
    one_line = lambda t: " ".join(t.split())
    isc, zero = license.KNOWN[2][1], license.KNOWN[3][1]
    rows = [(name, "Copyright 2020 Someone\n\n" + text) for name, text in license.full_texts()] + [("lines", f"readme\n# {one_line(isc)}\nother\n{one_line(zero)}"), ("long", "a\n" + one_line(texts["Apache-2.0"]))]
    found = {i: r for i, r in enumerate(license.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")).orderBy("doc_id").collect())}
    assert all(found[i].license == name for i, (name, _) in enumerate(rows[:-2]))
    assert found[len(rows) - 2].notices == "0BSD,ISC" and found[len(rows) - 1].notices == "Apache-2.0"
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "Unlicense"} <= set(texts)


def _labelled(spark, n=400):
    rng = random.Random(7)
    words = {"en": ["the", "there", "thing", "that", "with"], "de": ["der", "und", "nicht", "eine", "schon"]}
    rows = [(i, " ".join(rng.choice(words["en" if i % 2 else "de"]) for _ in range(30)), "en" if i % 2 else "de", "s", 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_language_held_out_and_spans(spark):
    d = _labelled(spark)
    model = langid.fit(d)
    found = {r.doc_id: r for r in langid.identify(d, model).collect()}
    assert all(found[i].lang_pred == ("en" if i % 2 else "de") for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0)
    labeller = langid.Labeller(model)
    assert [s[2] for s in labeller.spans("the there thing that with the there der und nicht eine schon der und nicht")] == ["en", "de"]
    assert labeller.predict("123 !") == ("und", 0.0) and labeller.predict(None) == ("und", 0.0)
    assert labeller.predict("the thing Ελλάδα")[0] == "en"


def test_unlearned_scripts_are_undetermined(spark):
    model = langid.fit(_labelled(spark))
    labeller = langid.Labeller(model)
    assert labeller.predict("Привет как дела") == labeller.predict("مرحبا") == labeller.predict("你好世界") == ("und", 0.0)
    assert labeller.predict("there Привет") == ("en", 5 / 11)
    assert labeller.spans("the there Привет that") == [(0, 2, "en"), (2, 3, "und"), (3, 4, "en")]
    d = spark.createDataFrame([(1, "Привет как дела"), (2, "the there Привет"), (3, "the Привет")], "doc_id long, text string")
    assert [r.doc_id for r in langid.keep_known(d, model).collect()] == [2]


def test_viterbi_is_exact():
    import numpy as np

    rng = np.random.default_rng(8)
    for _ in range(300):
        x = np.minimum(0, rng.normal(0, rng.choice([0.5, 5]), (rng.integers(1, 12), 3)))
        path = langid.viterbi(x, 3.0)
        score = lambda p: x[np.arange(len(x)), p].sum() - 3.0 * (np.diff(p) != 0).sum()  # noqa: B023, E731
        best = None
        for code in range(3 ** min(len(x), 8)):
            if len(x) <= 8:
                p = np.array([code // 3**k % 3 for k in range(len(x))])
                best = score(p) if best is None else max(best, score(p))
        if best is not None:
            assert score(path) == pytest.approx(best)


def test_toxicity(spark):
    rng = random.Random(9)
    clean = ["river", "house", "garden", "window", "letter", "morning", "silver", "bridge"]
    bad = ["moronic", "worthless", "scumbag"]
    text = lambda toxic: " ".join(rng.choice(clean) for _ in range(30)) + (" " + rng.choice(bad) if toxic else "")
    rows = [(i, text(i % 4 == 0)) for i in range(800)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(800)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, labels)
    assert set(model.entries) == set(bad)
    found = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
    assert all((found[i] >= 0.5) == (i % 4 == 0) for i in range(800))
    own = toxicity.Automaton(toxicity.Lexicon(model.entries))
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(500):
        w = list(rng.choice(bad))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "o"])
        w = "".join(w)
        near = [distance(w, b) for b in bad if distance(w, b) <= (1 if len(b) < 8 else 2)]
        assert own.edits(w) == (min(near) if near else -1)
    quoted = 'he said "you are worthless" to me and then we went'
    assert model.score(toxicity.features(quoted, own)) < 0.5 <= model.score(toxicity.features("you are worthless and we all know it", own))
    assert toxicity.fit(d, labels.limit(0)).weights == ()


def test_toxicity_misspelled_short_entries_and_beginnings(spark):
    own = toxicity.Automaton(toxicity.Lexicon({"scum": False, "moron": True, "moronic": False}))
    assert [own.edits(w) for w in ("scum", "scvm", "skum", "scvn", "moronish", "m0ronish", "m0r0nish", "moro", "mronic")] == [0, 1, 1, -1, 0, 1, -1, 1, 1]
    assert toxicity.lexicon({"moron" + toxicity.BEGINNING: 30, "moronic": 8, "moronish": 9}) == {"moron": True, "moronic": False, "moronish": False}
    words = spark.createDataFrame([("scvm", 0, 3), ("fooi", 9, 0), ("morun", 1, 0)], "entry string, clean long, toxic long")
    assert toxicity.blurred(words, {"scum": False, "fool": False, "moron": True}) == {"fool", "moron" + toxicity.BEGINNING}
