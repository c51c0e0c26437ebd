"""Language identification of mixed text by script ranges and Viterbi spans.

Fit. Letters of labelled texts give, for every language, log frequencies of
letter trigrams (word ends included) and the scripts that it uses.
The fit reads at most ``sample_docs`` distinct labelled texts per language, those with the
smallest hash, and reads them whole; the bound is a parameter of the fit alone. Languages
are taken to be few enough for a table of them on the driver.

Prediction, over whole texts. Words are runs of letters (Unicode category L). A run of more
than ``LONG_RUN`` letters, as scripts without spaces have them, is read in pieces of that many
letters; every trigram counts, also those across pieces. The script range of a word's first
letter leaves the languages that use that script; the word's score for each of them is the sum
of the log-probabilities of its trigrams, relative to the best language. A Viterbi pass with a
switching penalty labels spans of words. Words in a script that no language uses are ``und``,
whatever surrounds them. The language with most letters in its spans is the
prediction (of equals the first by name), its share of all letters the score.

Null texts and texts without a letter, or without one in a learned script, are ``und`` with score 0. With no labelled
row at all every text is ``und``. Repeated rows are predicted alike; an empty table gives an empty result; other
columns, whatever their names, are left alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeloom.llm.common import bound_batches, by_batch, crc_fold

UNDETERMINED = "und"
SAMPLE_DOCS = 1_500
#: Letters of a run that are read as one word.
LONG_RUN = 64
SWITCH = 12.0
MEMO_WORDS = 400_000
ORDERS = (3,)

#: First code points of script blocks (fixed values, Unicode); a letter belongs to the last block that begins at or before it.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"),
    (0x0E00, "thai"), (0x0E80, "asian"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "asian"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0x10000, "other"), (0x20000, "han"),
)
_STARTS = [a for a, _ in SCRIPTS]
_ALPHANUMERIC = re.compile(r"[^\W\d_]+")
#: Marks a piece of a longer run among words; what follows is padded already.
_PIECE = "\0"


def letter_runs(text: str) -> list[str]:
    """Runs of letters (category L), lower case. Digits of every kind, fractions and circled numbers end a run."""
    words = _ALPHANUMERIC.findall(text.lower())
    if words and not "".join(words).isalpha():
        words = [x for w in words for x in ("".join(c if c.isalpha() else " " for c in w).split())]
    return words


def pieces(run: str) -> list[str]:
    """A run cut into pieces of LONG_RUN letters: each holds the padded letters of its own trigrams, one for each letter."""
    padded = f"<{run}>"
    return [_PIECE + padded[a : a + LONG_RUN + 2] for a in range(0, len(run), LONG_RUN)]


def padded(word: str) -> str:
    return word[1:] if word[0] == _PIECE else f"<{word}>"


def units(text: str) -> tuple[list[str], list[int]]:
    """Words, long ones in pieces, and the number of letters of each."""
    words = letter_runs(text)
    sizes = list(map(len, words))
    if sizes and max(sizes) > LONG_RUN:
        words = [x for w, n in zip(words, sizes) for x in (pieces(w) if n > LONG_RUN else [w])]
        sizes = [len(w) - 3 if w[0] == _PIECE else len(w) for w in words]
    return words, sizes


def script(letter: str) -> str:
    from bisect import bisect_right

    return SCRIPTS[bisect_right(_STARTS, ord(letter)) - 1][1]


def grams(word: str) -> list[str]:
    s = padded(word)
    return [s[i : i + n] for n in ORDERS for i in range(len(s) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    scores: dict[str, tuple[float, ...]]  # n-gram -> log-probability per language
    unseen: dict[int, tuple[float, ...]]
    scripts: dict[str, list[int]]
    switch: float

    def word(self, w: str) -> tuple[float, ...]:
        """Log-likelihood of a word for each language, relative to the best; languages that do not use its script get a floor."""
        s = padded(w)
        allowed = self.scripts.get(script(s[1]))
        if allowed is None:
            return (0.0,) * len(self.languages)
        seen = self.scores.get
        total = [sum(c) for c in zip(*[seen(s[i : i + n]) or self.unseen[n] for n in ORDERS for i in range(len(s) - n + 1)])]
        best = max(total)
        return tuple([max(v - best, -20.0) if k in allowed else -20.0 for k, v in enumerate(total)])


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, switch: float = SWITCH) -> Model:
    """Learn from rows with a lang, the held-out fold left out."""
    from pyspark.sql import Window

    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    # a bounded sample: distinct texts of each language by hash, thinned by a threshold on the hash before they are ranked
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    thin = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, 3 * sample_docs / n + 1e-6) * (1 << 30))) for k, n in counts.items()], F.lit(0.0)) if counts else F.lit(0.0)
    few = labelled.select("lang", "text", h.alias("h")).where(F.col("h") <= thin).groupBy("lang", "h").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    few = few.withColumn("nth", nth).where(F.col("nth") <= sample_docs).select("lang", "text")

    def count(columns):
        tables: dict[str, Counter] = {}
        for lang, text in zip(*columns):
            table = tables.setdefault(lang, Counter())
            for w, n in zip(*units(text)):
                table.update(grams(w))
                table["\0" + script(padded(w)[1])] += n
        rows = [(lang, g, n) for lang, table in tables.items() for g, n in table.items()]
        return [list(c) for c in zip(*rows)] if rows else [[], [], []]

    table = by_batch(few, "lang string, gram string, n long", count).groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    return build([tuple(r) for r in table.where((F.col("n") >= 2) | F.col("gram").startswith("\0")).select("lang", "gram", "n").toPandas().itertuples(index=False)], switch)


def build(rows: list[tuple[str, str, int]], switch: float = SWITCH) -> Model:
    languages = sorted({lang for lang, _, _ in rows})
    place = {lang: k for k, lang in enumerate(languages)}
    size = len(languages)
    counts: dict[str, list[int]] = {}
    scripts: dict[str, list[int]] = {}
    totals = {n: [0] * size for n in ORDERS}
    kinds = {n: set() for n in ORDERS}
    for lang, gram, n in rows:
        if gram[0] == "\0":
            scripts.setdefault(gram[1:], [0] * size)[place[lang]] += n
            continue
        counts.setdefault(gram, [0] * size)[place[lang]] += n
        totals[len(gram)][place[lang]] += n
        kinds[len(gram)].add(gram)
    letters = [sum(s[k] for s in scripts.values()) for k in range(size)]
    prior = 0.5
    under = {n: [t + prior * len(kinds[n]) + 1 for t in totals[n]] for n in ORDERS}
    scores = {g: tuple(math.log((c + prior) / under[len(g)][k]) for k, c in enumerate(v)) for g, v in counts.items()}
    unseen = {n: tuple(math.log(prior / under[n][k]) for k in range(size)) for n in ORDERS}
    used = {s: [k for k in range(size) if v[k] >= 0.005 * max(1, letters[k])] for s, v in scripts.items()}
    return Model(languages, scores, unseen, {s: v for s, v in used.items() if v}, switch)


def viterbi(x: np.ndarray, switch: float) -> np.ndarray:
    """Best language for each word: sums of scores, less ``switch`` at each change."""
    top = int(x.sum(axis=0).argmax())
    gain = np.cumsum(x - x[:, [top]], axis=0)
    low = np.minimum.accumulate(np.vstack((np.zeros((1, x.shape[1])), gain[:-1])), axis=0)
    # A stretch of another language pays one switch at least, a path without ``top`` one less than it has
    # stretches: if no stretch gains more than a switch, nor a prefix and a suffix together, staying is best.
    if (gain - low).max() <= switch and gain.max() + (gain[-1] - low).max() <= switch:
        return np.full(len(x), top)
    rows = x.tolist()
    best, steps = rows[0], []
    for row in rows[1:]:
        turn = max(best)
        steps.append((best, best.index(turn), turn - switch))
        turn -= switch
        best = [(b if b >= turn else turn) + v for b, v in zip(best, row)]
    k = best.index(max(best))
    path = [k]
    for before, other, turn in reversed(steps):
        k = k if before[k] >= turn else other
        path.append(k)
    return np.array(path[::-1])


class Labeller:
    def __init__(self, model: Model):
        self.model, self.row, self.table, self.used = model, {}, np.zeros((4096, max(1, len(model.languages)))), 0

    def scores(self, words: list[str]) -> np.ndarray:
        row = self.row
        if len(row) + len(words) > MEMO_WORDS and self.used:
            self.row = row = {}
            self.used = 0
        for w in set(words).difference(row):
            if self.used == len(self.table):
                self.table = np.vstack((self.table, np.zeros_like(self.table)))
            self.table[self.used] = self.model.word(w)
            row[w] = self.used
            self.used += 1
        return self.table[np.fromiter(map(row.__getitem__, words), np.int64, len(words))]

    def path(self, text: str | None) -> tuple[list[int], np.ndarray]:
        """Letters of each word and the place of its language, or the place behind the last language for words in unlearned scripts."""
        words, sizes = units(text or "")
        if not words or not self.model.languages:
            return [], np.empty(0, np.int64)
        scores = self.scores(words)
        path = viterbi(scores, self.model.switch)
        for i in np.flatnonzero(~scores.any(axis=1)).tolist():  # without any difference: of no learned script, or equally likely in all
            if script(padded(words[i])[1]) not in self.model.scripts:
                path[i] = len(self.model.languages)
        return sizes, path

    def predict(self, text: str | None) -> tuple[str, float]:
        sizes, path = self.path(text)
        if not sizes:
            return UNDETERMINED, 0.0
        letters = np.bincount(path, weights=np.array(sizes, np.float64), minlength=len(self.model.languages) + 1)
        k = int(letters[:-1].argmax())
        if not letters[k]:
            return UNDETERMINED, 0.0
        return self.model.languages[k], float(letters[k] / letters.sum())

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(first word, word after the last, language) of each span; pieces of a long run count as words."""
        _, path = self.path(text)
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)] if len(path) else [0]
        names = [*self.model.languages, UNDETERMINED]
        return [(a, b, names[int(path[a])]) for a, b in zip(cuts, cuts[1:])]


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    held: dict[str, Labeller] = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample of the fit

    def work(columns):
        labeller = held.get("") or held.setdefault("", Labeller(shared.value))
        found = [labeller.predict(t) for t in columns[1]]
        return [columns[0], [f[0] for f in found], [f[1] for f in found]]

    return by_batch(docs.select(F.col(id_column).cast("long").alias("doc_id"), "text"), "doc_id long, lang_pred string, score double", work)


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of docs in a learned language that covers at least ``least`` of their letters, with all their columns."""
    from pyspark.sql.types import StructType

    bound_batches(docs.sparkSession)
    schema = docs.schema
    at = docs.columns.index("text")
    held: dict[str, Labeller] = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        labeller = held.get("") or held.setdefault("", Labeller(shared.value))
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [labeller.predict(t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, StructType(schema.fields))
