"""BPE encoding and decoding of whole texts by a prefix-sharing trie.

Byte-pair encoding of a string by merge ranks has two properties that the encoder rests on: each prefix
of a string has one encoding, so it is told by its last token and the encoding of what is before
it; and a token sequence is the encoding of its string if and only if each two neighbours are the
encoding of theirs. The words of a batch go into a trie; a depth-first walk gives each node the last token of
its prefix, found among the tokens that end there and fit the state at their start. Prefixes that words
share are encoded once."""

from __future__ import annotations

import gc
import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_texts, kept, release, slices
from .wordpieces import SPECIAL, byte_letters, words_of

#: distinct words in one trie
TRIE_WORDS = 5_000
#: words in use after which a worker lets those go that were not met since the last time; it holds twice as many at most,
#: besides those of the documents at hand
HELD_WORDS = 100_000
#: neighbours whose fit a worker remembers at most
HELD_PAIRS = 500_000
#: bytes of texts that are cut into words at once
WORD_CHARS = 1_000_000


class Vocabulary:
    """A tokenizer file's tokens, as strings of bytes in Latin-1 with and without the end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.end = model["end_of_word_suffix"]
        letters = byte_letters()
        to_byte = {c: chr(b) for b, c in enumerate(letters)}
        ids = model["vocab"]
        self.strings = {i: t for t, i in ids.items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.inner = {"".join(map(to_byte.get, t)): i for t, i in ids.items()
                      if not t.endswith(self.end) and all(c in to_byte for c in t)}
        self.final = {"".join(map(to_byte.get, t[:-len(self.end)])): i for t, i in ids.items()
                      if t.endswith(self.end) and all(c in to_byte for c in t[:-len(self.end)])}
        self.text = {i: (t, False) for t, i in self.inner.items()} | {i: (t, True) for t, i in self.final.items()}
        self.inner_sizes, self.final_sizes = _sizes(self.inner), _sizes(self.final)
        self.merged = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merged[ids[a], ids[b]] = (rank, ids[a + b])
        self.fits: dict[int, bool] = {}

    def merge(self, tokens: list[int]) -> list[int]:
        """Merges by rank, the leftmost first, until none applies."""
        while len(tokens) > 1:
            best = min((self.merged[p] for p in zip(tokens, tokens[1:]) if p in self.merged), default=None)
            if best is None:
                break
            out, i = [], 0
            while i < len(tokens):
                if i + 1 < len(tokens) and self.merged.get((tokens[i], tokens[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out
        return tokens

    def letters(self, token: int) -> list[int]:
        text, final = self.text[token]
        out = [self.inner[c] for c in text]
        if final:
            out[-1] = self.final[text[-1]]
        return out

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens, or the right one alone (left -1), are the encoding of their string."""
        key = (left + 1) << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > HELD_PAIRS:
                self.fits.clear()
            if left < 0:
                known = self.merge(self.letters(right)) == [right]
            else:
                known = self.merge(self.letters(left) + self.letters(right)) == [left, right]
            self.fits[key] = known
        return known

    def decode(self, ids) -> str:
        """Token strings with a blank between them, special tokens too: a file without a decoder has no other rule."""
        return " ".join([self.strings[i] for i in ids])


def _sizes(tokens: dict[str, int]) -> dict[str, tuple[int, ...]]:
    """The lengths, longest first, of the tokens of two bytes or more that end in the same three (or all) bytes."""
    out: dict[str, set[int]] = {}
    two = {t for t in tokens if len(t) == 2}
    for t in tokens:
        if len(t) > 1:
            out.setdefault(t[-3:], set()).add(len(t))
    for t, sizes in out.items():
        if t[-2:] in two:
            sizes.add(2)
    return {k: tuple(sorted(v, reverse=True)) for k, v in out.items()}


@kept
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _last_token(v: Vocabulary, tokens: dict[str, int], sizes: dict[str, tuple[int, ...]], prefix: str,
                last: list[int]) -> int:
    """The last token of the encoding of ``prefix`` among ``tokens``; ``last[d]`` is that of its first d bytes."""
    n = len(prefix)
    fits = v.fits
    for size in sizes.get(prefix[-3:]) or (2,):
        if size <= n:
            token = tokens.get(prefix[n - size:])
            if token is not None:
                left = last[n - size]
                known = fits.get((left + 1) << 32 | token)
                if known or known is None and v.fit(left, token):
                    return token
    return tokens[prefix[-1]]  # every byte is a token, and one of those that end here is the last


def encode_words(v: Vocabulary, words: list[str]) -> list[list[int]]:
    """Ids of distinct non-empty words, by one trie."""
    root: dict = {}
    raw = [w.encode("utf-8", "replace").decode("latin-1") for w in words]
    for i, w in enumerate(raw):
        node = root
        for c in w[:-1]:
            node = node.setdefault(c, {})
        node.setdefault(None, []).append((w[-1], i))
    out: list[list[int]] = [[] for _ in words]
    inner, final, text = v.inner, v.final, v.text
    last = [-1]                      # the state along the path: last token of each prefix
    stack = [("", root)]
    while stack:
        prefix, node = stack.pop()
        n = len(prefix)
        if n:
            del last[n:]
            last.append(_last_token(v, inner, v.inner_sizes, prefix, last))
        for c, below in node.items():
            if c is not None:
                stack.append((prefix + c, below))
                continue
            for end, i in below:
                word = prefix + end
                token, at = _last_token(v, final, v.final_sizes, word, last), n + 1
                ids = [token]
                at -= len(text[token][0])
                while at:
                    token = last[at]
                    ids.append(token)
                    at -= len(text[token][0])
                ids.reverse()
                out[i] = ids
    return out


class Encoder:
    """Encodings of words, kept from batch to batch and from task to task of a worker: ``held`` has those
    in use, ``before`` those in use until the last ``trim``."""

    def __init__(self, path: str):
        self.v, self.held, self.before = vocabulary(path), {}, {}

    def add(self, words) -> None:
        """Encodes those of ``words`` that are not held, neighbours in order in the same trie."""
        new = set().union(*words).difference(self.held)
        if self.before:
            self.held.update((w, self.before[w]) for w in new if w in self.before)
            new.difference_update(self.before)
        new = sorted(new)
        for w in [w for w in new if w in self.v.special]:
            self.held[w] = self.entry([self.v.special[w]])
        new = [w for w in new if w not in self.v.special]
        for at in range(0, len(new), TRIE_WORDS):
            part = new[at:at + TRIE_WORDS]
            self.held.update(zip(part, map(self.entry, encode_words(self.v, part))))

    def entry(self, ids: list[int]):
        return tuple(ids)

    def trim(self) -> None:
        if len(self.held) > HELD_WORDS:
            self.before, self.held = self.held, {}


@kept
def encoder(kind: type, path: str) -> Encoder:
    """A worker's encoder. The vocabulary's many small objects are kept out of later garbage collections."""
    out = kind(path)
    gc.collect()
    gc.freeze()
    return out


class DigestEncoder(Encoder):
    """Holds each word as its ids in decimals and its decoded text."""

    def entry(self, ids):
        return " ".join(map(str, ids)), self.v.decode(ids)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row of ``docs``: the ids of the whole text, without special tokens added
    (those that stand in a text are ids of their own). Null and empty texts have no ids; repeated rows
    give repeated rows, an empty table an empty result; other columns are not read. ``path`` is a
    tokenizer file that every worker can read."""
    path = path or default_path()

    def run(batches):
        release()
        enc = encoder(Encoder, path)
        for ids, texts in slices(batches, most=WORD_CHARS):
            words = [words_of(t, path) for t in texts]
            enc.add(words)
            out = [np.fromiter(chain.from_iterable(map(enc.held.__getitem__, ws)), np.int32) for ws in words]
            del words
            enc.trim()
            ends = np.cumsum([0, *map(len, out)])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(np.diff(ends), pa.int64()),
                                   pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out)))],
                                  ["doc_id", "n_tokens", "ids"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` for every row of ``tokens(doc_id, ids)``: token strings with blanks between them,
    special tokens included. Null or no ids give the empty text; an id outside the vocabulary is left out, as the
    library does."""
    path = path or default_path()

    def run(batches):
        strings = vocabulary(path).strings
        for batch in batches:
            out = [" ".join([strings[i] for i in ids or () if i in strings]) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return (tokens.select(tokens["doc_id"].cast("long").alias("doc_id"), tokens["ids"].cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``: SHA-256 of the decimal ids
    with blanks between them, and of the text decoded from them, in hex. Rows as in ``encode``. Words are
    encoded and decoded once a batch and joined, as neither crosses the end of a word."""
    path = path or default_path()

    def run(batches):
        release()
        enc = encoder(DigestEncoder, path)
        for ids, texts in slices(batches, most=WORD_CHARS):
            words = [words_of(t, path) for t in texts]
            enc.add(words)
            n, coded, decoded = [], [], []
            for ws in words:
                got = list(map(enc.held.__getitem__, ws))
                a = " ".join([g[0] for g in got])
                n.append(a.count(" ") + 1 if a else 0)
                coded.append(hashlib.sha256(a.encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join([g[1] for g in got]).encode()).hexdigest())
            enc.trim()
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(coded), pa.array(decoded)],
                                  ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
