"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

Encoding. A token sequence is the BPE encoding of its text exactly when each
adjacent pair of tokens is the encoding of its own two-token text. So tokens
can be chosen from left to right: take the longest token that is compatible
with the one before, and step back when nothing fits. How far a later character
can reach back is a property of the merge list alone; ``sufficient_lookahead``
computes a bound for it. A token is emitted once that many characters have
been read behind it, so the transducer holds a window of constant size however
long a word is. Words are the units between which nothing merges; short ones
are memoised in a table of bounded size.

Decoding. Ids give bytes, and an incremental UTF-8 automaton turns bytes into text as they
come; bytes of an unfinished character wait for the next id. ``SurfaceDecoder`` takes the
bytes of the tokens' spellings with spaces between, which is what a tokenizer file without a
decoder section stands for; ``TextDecoder`` the bytes that the spellings mean, a word end
becomes a space.

Nulls count as empty texts (no tokens); repeated rows and ids are encoded row by
row; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeloom.llm.common import by_batch

END = "</w>"
#: Characters of text normalised and split at a time; a longer stretch without white space is taken whole.
CHUNK = 1 << 16
BLANK = re.compile("[ \\t\\n\\r]")
#: Words kept in each worker's memo, and the longest word that may enter it.
MEMO_WORDS, MEMO_LENGTH = 250_000, 64


def byte_alphabet() -> dict[int, int]:
    """Byte -> printable character: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Characters after which no later text can change a token.

    More text on the right changes a token only by a chain of merges: a merge
    (u, v) takes u away from a merge of lower priority, further left, whose right
    part begins with u, and so on. The longest such chain, in characters, bounds
    the reach. Ranks fall along a chain, so one pass from the lowest priority up
    finds it.
    """
    reach: dict[str, int] = {}
    most = 1
    for u, v in reversed(merges):
        here = len(u) + reach.get(u, 0)
        most = max(most, here + len(v))
        for n in range(1, len(v) + 1):
            if reach.get(v[:n], 0) < here:
                reach[v[:n]] = here
    return most


class WordBpe:
    """Encoder and decoder for a tokenizer file: BPE with word ends, NFC, lower case, one digit per word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        mark = chr(0xE000)  # one character for the word end
        short = lambda s: s[: -len(END)] + mark if s.endswith(END) else s
        self.mark = mark
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocab = {short(k): v for k, v in model["vocab"].items() if k not in self.special}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        pairs = [(short(a), short(b)) for a, b in pairs]
        self.ranks = {p: i for i, p in reversed(list(enumerate(pairs)))}
        self.longest = max(map(len, self.vocab))
        self.lookahead = max(sufficient_lookahead(pairs), self.longest) + self.longest
        self.text_of = {v: k for k, v in self.vocab.items()}
        self.surface = {v: k for k, v in model["vocab"].items()} | {v: k for k, v in self.special.items()}
        self.surface_bytes = {k: v.encode("utf-8", "surrogatepass") for k, v in self.surface.items()}
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.bytes_to_chars = byte_alphabet()
        self.chars_to_bytes = {chr(c): b for b, c in self.bytes_to_chars.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        clitics = "'s|'t|'re|'ve|'m|'ll|'d"
        self.words = regex.compile(rf"{clitics}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+").findall
        self.ascii_words = re.compile(rf"{clitics}|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII).findall

    # -- encoding

    def merged(self, s: str) -> list[str]:
        """BPE of s by its definition: the pair of best rank merges, leftmost first, until none is left."""
        parts = list(s)
        if len(parts) > 1 and parts[-1] == self.mark:
            parts[-2:] = [parts[-2] + self.mark]
        while len(parts) > 1:
            ranked = [self.ranks.get(p, len(self.ranks)) for p in zip(parts, parts[1:])]
            best = min(ranked)
            if best == len(self.ranks):
                break
            i = ranked.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fit(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            x, y = self.text_of[a], self.text_of[b]
            if len(self.fits) >= MEMO_WORDS:
                self.fits.clear()
            known = self.fits[key] = self.merged(x + y) == [x, y]
        return known

    def tokens(self, word: str) -> Iterator[list[int]]:
        """The ids of one word in stable pieces; the window behind the reading head stays below the lookahead and one token."""
        s = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.bytes_to_chars) + self.mark
        ids: list[int] = []
        sizes: list[int] = []
        dead: set[int] = set()
        at, n, kept = 0, len(s), 0
        get, fit, longest = self.vocab.get, self.fit, self.longest
        last = -1  # the token before the window
        room = min(longest, n)
        while at < n:
            before = ids[-1] if ids else last
            for size in range(room, 0, -1):
                t = get(s[at : at + size])
                if t is not None and at + size not in dead and (before < 0 or fit(before, t)):
                    ids.append(t)
                    sizes.append(size)
                    at += size
                    break
            else:
                if not ids:
                    raise ValueError(f"no encoding within a lookahead of {self.lookahead} characters")
                dead.add(at)
                ids.pop()
                at -= sizes.pop()
            room = min(longest, n - at)
            if at - kept > 2 * self.lookahead:
                k = 0
                while at - kept - sizes[k] > self.lookahead:
                    kept += sizes[k]
                    k += 1
                yield ids[:k]
                last = ids[k - 1]
                del ids[:k], sizes[:k]
                dead = {p for p in dead if p > kept}
        yield ids

    def packed(self, word: str) -> bytes:
        known = self.memo.get(word)
        if known is None:
            known = array("I", [t for piece in self.tokens(word) for t in piece]).tobytes()
            if len(word) <= MEMO_LENGTH:
                if len(self.memo) >= MEMO_WORDS:
                    self.memo.clear()
                self.memo[word] = known
        return known

    def encode(self, text: str | None) -> Iterator[bytes]:
        """Ids of a text as little-endian unsigned 32-bit integers, piece by piece."""
        memo, packed = self.memo.get, self.packed
        for part in self.split_special.split(text or "") if self.split_special else [text or ""]:
            if part in self.special:
                yield array("I", [self.special[part]]).tobytes()
                continue
            for piece in self.pieces(part):
                if piece.isascii():
                    found = self.ascii_words(piece.lower())
                else:
                    lowered = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                    found = self.words(lowered)
                if max(map(len, found), default=0) <= MEMO_LENGTH:
                    yield b"".join([memo(w) or packed(w) for w in found])
                else:
                    for w in found:
                        if len(w) <= MEMO_LENGTH:
                            yield packed(w)
                        else:
                            for ids in self.tokens(w):
                                yield array("I", ids).tobytes()

    @staticmethod
    def pieces(text: str) -> Iterator[str]:
        """Cut before white space: neither NFC nor the word pattern looks across it."""
        at = 0
        while at < len(text):
            found = BLANK.search(text, at + CHUNK)
            to = found.start() if found else len(text)
            yield text[at:to]
            at = to


class SurfaceDecoder:
    """Tokens as the vocabulary spells them, joined by single spaces."""

    def __init__(self, bpe: WordBpe):
        self.bytes_of, self.begun, self.state = bpe.surface_bytes, False, codecs.getincrementaldecoder("utf-8")("surrogatepass")

    def feed(self, packed: bytes) -> str:
        ids = array("I")
        ids.frombytes(packed)
        if not ids:
            return ""
        data = b" ".join(map(self.bytes_of.__getitem__, ids))
        if self.begun:
            data = b" " + data
        self.begun = True
        return self.state.decode(data)


class TextDecoder:
    """Readable text: bytes pass through an incremental UTF-8 automaton, a word end gives a space."""

    def __init__(self, bpe: WordBpe):
        self.bpe, self.state = bpe, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, packed: bytes, final: bool = False) -> str:
        ids = array("I")
        ids.frombytes(packed)
        out = []
        for t in ids:
            s = self.bpe.text_of.get(t)
            if s is None:  # a special token ends what came before
                out.append(self.state.decode(b"", True) + self.bpe.surface[t] + " ")
                self.state.reset()
                continue
            ends = s.endswith(self.bpe.mark)
            raw = bytes(self.bpe.chars_to_bytes[c] for c in (s[:-1] if ends else s))
            out.append(self.state.decode(raw, ends) + " " * ends)
            if ends:
                self.state.reset()
        return "".join(out) + (self.state.decode(b"", True) if final else "")


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids array<int> of every text."""

    def work(columns):
        bpe = load(tokenizer)
        ids = []
        for text in columns[1]:
            a = array("I")
            for piece in bpe.encode(text):
                a.frombytes(piece)
            ids.append(a)
        return [columns[0], ids]

    return by_batch(docs.select("doc_id", "text"), "doc_id long, ids array<int>", work)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text: the readable text of ids (lower case, words apart by one space)."""

    def work(columns):
        bpe = load(tokenizer)
        return [columns[0], [TextDecoder(bpe).feed(array("I", ids or []).tobytes(), final=True).rstrip(" ") for ids in columns[1]]]

    return by_batch(encoded.select("doc_id", "ids"), "doc_id long, text string", work)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode every text in one streaming pass and keep digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def work(columns):
        bpe = load(tokenizer)
        counts, of_ids, of_texts = [], [], []
        for text in columns[1]:
            ids, decoded, decoder, n = hashlib.sha256(), hashlib.sha256(), SurfaceDecoder(bpe), 0
            for piece in bpe.encode(text):
                n += len(piece)
                ids.update(piece)
                decoded.update(decoder.feed(piece).encode("utf-8", "surrogatepass"))
            counts.append(n // 4)
            of_ids.append(ids.hexdigest())
            of_texts.append(decoded.hexdigest())
        return [columns[0], counts, of_ids, of_texts]

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)
