"""The pipeline against a plain Python version of its stages, and each stage on the columns it must keep."""

import hashlib
import math
import re
from collections import Counter

import pytest

import corpus_pipeline
from nodeloom.llm import langid, simhash
from nodeloom.llm.queries import QUERIES, default_tokenizer

SF = "/root/testdata/sf0.001"


def brute(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [r.asDict() for r in frame.collect()]
    labeller = langid.Labeller(langid.fit(frame))
    docs = [d for d in docs if (lambda p: p[0] != "und" and p[1] >= 0.5)(labeller.predict(d["text"]))]
    best = {}
    for d in docs:
        k = re.sub("[A-Z]", lambda m: m[0].lower(), d["text"])
        if k not in best or best[k]["doc_id"] < d["doc_id"]:
            best[k] = d
    docs = list(best.values())
    fp = [simhash.fingerprint(d["text"], 2, True) for d in docs]
    sets = [set(simhash.shingle_set(d["text"], 5).tolist()) for d in docs]
    order = sorted(range(len(docs)), key=lambda i: docs[i]["doc_id"])
    # every earlier neighbour is tried here; the operator proposes some of them in each cell
    gone = {i for k, i in enumerate(order) for j in order[:k] if (fp[i] ^ fp[j]).bit_count() <= 6 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    docs = [d for i, d in enumerate(docs) if i not in gone]
    out = []
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) for d in docs}
    sources = sorted({d["source"] for d in docs})
    weight = dict(zip(sources, [5, 2, 1] * 50))
    whole = Counter()
    for d in docs:
        whole[d["source"]] += size[d["doc_id"]]
    target, free, left = {}, set(sources), 1.5 * sum(whole.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * whole[s]} or None
        if over is None:
            target |= share
            break
        target |= {s: 2.0 * whole[s] for s in over}
        free -= over
        left = 1.5 * sum(whole.values()) - sum(target.values())
    for s in sources:
        epochs = math.floor(target[s] / whole[s] + 1e-12)
        rest, run = max(0.0, target[s] - epochs * whole[s]), 0
        keyed = []
        for d in docs:
            if d["source"] == s:
                u = (int(hashlib.sha256(f"{d['doc_id']}:17".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                n = size[d["doc_id"]]
                mean = len(d["text"]) / max(1, n)
                keyed.append((-math.log(u) / (1.0 if 3 <= mean <= 10 else 0.5 if 2 <= mean <= 20 else 0.25), d["doc_id"]))
        for _, i in sorted(keyed):
            run += size[i]
            out += [i] * (epochs + (epochs < 2 and rest > 0 and run - size[i] / 2 <= rest))
    texts = {d["doc_id"]: d["text"] for d in docs}
    return out, texts


def test_pipeline(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_tokenizer())
    expected, texts = brute(spark)
    found = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in found) == Counter(expected)
    for r in found:
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns(spark, k):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.STAGES[k][1](spark, docs, SF).columns == docs.columns


@pytest.mark.parametrize("name", QUERIES)
def test_queries_return_a_row_for_each_input(spark, name):
    table = "pages" if name.startswith("op7") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
