"""Toxicity scores: a Levenshtein automaton over a lexicon trie, read in context.

Fit (bounded sample). At most ``sample_rows`` labelled rows outside the held-out
fold, those with the smallest hash of their text, are read. Words and word
beginnings whose texts are mostly marked toxic form the lexicon; each text counts
once, and copies and most near copies (equal least shingle) as one text. An entry needs ``least_share`` of the
toxic texts, so that the private words of a group of near copies do not enter.

Match, over whole texts. The lexicon is a trie; the automaton that accepts all
words within a bounded number of edits of an entry is intersected with it and made
deterministic as it is used (states: sets of trie nodes with their errors). A word
is read once; misspelled entries are accepted with their number of edits: 2 from 8
characters on, else 1. Beginnings have 1, and words under them their own. Beginnings
and entries of 4 characters stay exact if their misspellings in the sample are not
clearly toxic. Terms under 4 characters never enter.

Score. Hits inside quotation marks or behind reporting words count as quoted, the
others as abuse. A logistic model over exact, misspelled and quoted hits gives the
score; it is fitted on the same sample.

Null and empty texts have no hits and get the model's base score. Without labelled
rows of both kinds every score is 0. Repeated rows are scored alike; an empty table gives an empty
result; other columns are ignored. Rows of the sample with equal hashes are taken in order of
their label.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeloom.llm.common import by_batch, crc_fold, cut

SAMPLE_ROWS = 12_000
LEAST_SHARE, LEAST_TEXTS, PRECISION = 0.01, 4, 0.9
#: Letters of the shortest entry, and of the longest word beginning that the fit counts (longer words enter whole).
SHORTEST, LONGEST_BEGINNING = 4, 11
#: Words on each side of a hit that are read for signs of quotation.
WINDOW = 5
MEMO_WORDS, MEMO_STATES = 200_000, 20_000

TOKEN = re.compile(r"\w[\w@$*]*")
OPENING, CLOSING = "\"“„«‹", "\"”“»›"
#: Words that announce a quotation, in four languages (fixed values).
REPORTING = frozenset("said says quote quoted quotes wrote writes called calls term word insult insults sagte sagt schrieb zitat zitiert wort nannte dit disait écrit cite citation mot appelé dijo dice escribió cita palabra llamó".split())


#: Marks a word beginning among counted words.
BEGINNING = "\x01"


@dataclass
class Lexicon:
    """Trie: node 0 is the root. An entry ends a node with its allowed edits; ``opens`` marks word beginnings."""

    entries: dict[str, bool]  # entry -> whether it is a word beginning
    exact: frozenset[str] = frozenset()  # entries, beginnings marked, that are matched as they are
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, int] = field(default_factory=dict)
    opens: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        for entry, opens in self.entries.items():
            node = 0
            for c in entry:
                if c not in self.children[node]:
                    self.children.append({})
                    self.children[node][c] = len(self.children) - 1
                node = self.children[node][c]
            if opens:
                self.opens[node] = 0 if entry + BEGINNING in self.exact else 1
            else:
                self.ends[node] = 0 if entry in self.exact else 1 if len(entry) < 8 else 2


class Automaton:
    """Lexicon trie x Levenshtein automaton, determinised on demand."""

    def __init__(self, lexicon: Lexicon):
        self.trie = lexicon
        self.most = max([0, *lexicon.ends.values(), *lexicon.opens.values()])
        self.start = self.close({0: 0})
        self.memo: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[frozenset] = [self.start]
        self.number = {self.start: 0}
        self.next: list[dict[str, int]] = [{}]
        self.final: list[int] = [self.accepted(self.start)]

    def close(self, state: dict[int, int]) -> frozenset:
        """Add nodes reached by leaving entry characters out, one error each."""
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            if e < self.most and node != -1:
                for child in self.trie.children[node].values():
                    if state.get(child, self.most + 1) > e + 1:
                        state[child] = e + 1
                        todo.append((child, e + 1))
        return frozenset(state.items())

    def accepted(self, state: frozenset) -> int:
        """Least edits of an entry that ends here, or -1."""
        return min((e for n, e in state if n == -1 or e <= max(self.trie.ends.get(n, -1), self.trie.opens.get(n, -1))), default=-1)

    def step(self, at: int, c: str) -> int:
        """Number of the state after c; -1 if nothing can match any more."""
        after: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self.most and after.get(node, self.most + 1) > e:
                after[node] = e

        for node, e in self.states[at]:
            if node == -1:
                reach(-1, e)
                continue
            reach(node, e + 1)
            for letter, child in self.trie.children[node].items():
                reach(child, e + (letter != c))
        state = self.close(after)
        read = [e for n, e in state if n != -1 and e <= self.trie.opens.get(n, -1)]
        if read:  # a beginning was read: whatever follows is accepted
            state = frozenset((dict(state) | {-1: min(read + [e for n, e in state if n == -1])}).items())
        if not state:
            return -1
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.next.append({})
            self.final.append(self.accepted(state))
        return self.number[state]

    def edits(self, word: str) -> int:
        """Least edits from an entry, -1 if none is near enough."""
        at = 0
        for c in word:
            to = self.next[at].get(c)
            if to is None:
                to = self.next[at][c] = self.step(at, c)
            if to < 0:
                return -1
            at = to
        return self.final[at]

    def hits(self, words: list[str]) -> list[int]:
        memo = self.memo
        new = set(words).difference(memo)
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = set(words)
        for w in new:
            if len(self.states) > MEMO_STATES:
                self.clear()
            memo[w] = self.edits(w)
        return [memo[w] for w in words]


def quoted(text: str, tokens: list[re.Match], i: int) -> bool:
    """Whether hit i stands inside quotation marks or behind a reporting word, as its window shows."""
    first, last = tokens[max(0, i - WINDOW)], tokens[min(len(tokens) - 1, i + WINDOW)]
    before, after = text[first.start() : tokens[i].start()], text[tokens[i].end() : last.end() + 1]
    straight = before.count('"') % 2 == 1 and '"' in after
    paired = any(before.rfind(a) > before.rfind(b) and b in after for a, b in zip(OPENING[1:], CLOSING[1:]))
    said = any(tokens[j].group().lower() in REPORTING for j in range(max(0, i - 3), i))
    return straight or paired or said


FEATURES = 4


def features(text: str | None, automaton: Automaton) -> tuple[float, ...]:
    """Damped counts: exact abuse, misspelled abuse, quoted hits, and abuse per hundred words."""
    low = (text or "").lower()
    words = TOKEN.findall(low)
    edits = automaton.hits(words) if words else []
    exact = near = told = 0
    if max(edits, default=-1) >= 0:
        tokens = list(TOKEN.finditer(low))
        for i, e in enumerate(edits):
            if e >= 0:
                if quoted(low, tokens, i):
                    told += 1
                elif e == 0:
                    exact += 1
                else:
                    near += 1
    return math.log1p(exact), math.log1p(near), math.log1p(told), 100 * exact / max(20, len(words))


@dataclass
class Model:
    entries: dict[str, bool]
    weights: tuple[float, ...]  # base, then features
    exact: frozenset[str] = frozenset()

    def score(self, x: tuple[float, ...]) -> float:
        if not self.weights:
            return 0.0
        z = self.weights[0] + sum(w * v for w, v in zip(self.weights[1:], x))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """text, toxic of a bounded number of labelled rows outside the held-out fold."""
    marked = labels.where(F.col("toxic").isNotNull() & (crc_fold(F.col("doc_id")) != 0)).select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = marked.select("_id", "toxic", F.xxhash64("_id", F.lit(5)).alias("h")).orderBy("h", "toxic").limit(sample_rows).select("_id", "toxic")
    chosen = cut(chosen)
    text = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    return text.join(F.broadcast(chosen), "_id").select("text", "toxic")


def alike(text: str | None) -> int:
    """Least hash of a text's four-word shingles: the same for copies and for most near copies, hardly ever for other texts."""
    words = (text or "").lower().split()
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    return min(map(xxhash.xxh64_intdigest, shingles)) >> 1


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    found = by_batch(sample(docs, labels, sample_rows), "text string, toxic int, alike long", lambda c: [c[0], c[1], list(map(alike, c[0]))])
    rows = cut(found.groupBy("alike").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return Model({}, ())

    def count(columns):
        tables = {0: Counter(), 1: Counter()}
        for text, toxic in zip(*columns):
            words = set(TOKEN.findall((text or "").lower()))
            starts = {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST_BEGINNING + 1))}
            tables[toxic].update(words)
            tables[toxic].update(s + BEGINNING for s in starts)
        found = [(k, n if t == 0 else 0, n if t == 1 else 0) for t, table in tables.items() for k, n in table.items()]
        return [list(c) for c in zip(*found)] if found else [[], [], []]

    need = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * totals[1]))
    table = by_batch(rows.select("text", "toxic"), "entry string, clean long, toxic long", count).groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    strong = table.where((F.col("toxic") >= need) & (F.col("toxic") * F.lit(totals[0] / totals[1]) >= F.lit(PRECISION / (1 - PRECISION)) * (F.col("clean") + 0.5)) & (F.col("toxic") >= F.lit(PRECISION) * (F.col("clean") + F.col("toxic"))))
    model = Model(lexicon({r["entry"]: r["toxic"] for r in strong.collect()}), ())  # each is in least_share of the toxic texts, so they are at most the entries of a text over that share
    model.exact = blurred(table, model.entries)
    automaton = {}

    def measure(columns):
        own = automaton.get("") or automaton.setdefault("", Automaton(Lexicon(model.entries, model.exact)))
        found = [features(t, own) for t in columns[0]]
        return [list(columns[1]), *[list(c) for c in zip(*found)]] if found else [[] for _ in range(FEATURES + 1)]

    seen = by_batch(rows.select("text", "toxic"), "toxic int, " + ", ".join(f"f{k} double" for k in range(FEATURES)), measure).toPandas().to_numpy(np.float64)
    return Model(model.entries, logistic(seen[:, 1:], seen[:, 0]), model.exact)


def blurred(table: DataFrame, entries: dict[str, bool]) -> frozenset[str]:
    """Beginnings (marked) and entries under 5 characters that stay exact, as words of the sample one edit away are not clearly toxic."""
    short = [e + BEGINNING * opens for e, opens in entries.items() if opens or len(e) < 5]
    if not short:
        return frozenset()
    words = table.where(~F.col("entry").endswith(BEGINNING)).select("entry", "clean", "toxic")

    def count(columns):
        own = {e: Automaton(Lexicon({e.rstrip(BEGINNING): e.endswith(BEGINNING)})) for e in short}
        found = [(e, clean, toxic) for e, a in own.items() for w, clean, toxic in zip(*columns) if a.edits(w) == 1]
        return [list(c) for c in zip(*found)] if found else [[], [], []]

    near = by_batch(words, "entry string, clean long, toxic long", count).groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    return frozenset(r["entry"] for r in near.where(F.col("toxic") < F.lit(PRECISION) * (F.col("clean") + F.col("toxic"))).collect())


def lexicon(strong: dict[str, int]) -> dict[str, bool]:
    """Entries from counted words and beginnings (marked): a beginning stands for its words if it is in clearly more texts than any longer entry under it."""
    starts = {k[:-1]: n for k, n in strong.items() if k.endswith(BEGINNING)}
    words = {k: n for k, n in strong.items() if not k.endswith(BEGINNING) and len(k) >= SHORTEST}
    chosen: dict[str, bool] = {}
    for s in sorted(starts, key=lambda k: (len(k), k)):
        if any(chosen.get(s[:n]) for n in range(SHORTEST, len(s))):
            continue
        under = max([n for w, n in words.items() if w.startswith(s)] + [0])
        if starts[s] > 1.5 * max(1, under):
            chosen[s] = True
    for w in sorted(words):
        if not chosen.get(w):  # words under a beginning keep their own edits
            chosen[w] = False
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; abuse cannot lower, nor quotation exceed abuse."""
    a = np.hstack((np.ones((len(x), 1)), x))
    w = np.zeros(a.shape[1])
    prior = np.array([0.0, 3.0, 2.0, 0.0, 0.0])  # where the sample is silent about a feature
    keep = np.diag([1e-6] + [ridge] * (a.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + keep + 1e-9 * np.eye(len(w)), a.T @ (y - p) - keep @ (w - prior))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w[1:3] = np.maximum(w[1:3], 0)
    w[3] = min(w[3], w[1])
    return tuple(w.tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    held: dict[str, Automaton] = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred entries

    def work(columns):
        own = held.get("") or held.setdefault("", Automaton(Lexicon(shared.value.entries, shared.value.exact)))
        return [columns[0], [shared.value.score(features(t, own)) for t in columns[1]]]

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, score double", work)
