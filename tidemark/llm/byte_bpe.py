"""Byte-level BPE of whole texts: ranked merges folded by Spark's higher-order functions.

A rank file gives each token (a byte string) its rank, which is also its id. A text is cut by the file's
pattern, and each piece is merged on its own: of the neighbours whose joined bytes are a token, the pair of
lowest rank, the leftmost first, becomes one, until none is left.

The merges run in the JVM, over arrays of distinct words: ``aggregate`` folds one merge a step over an
array that holds each token with the rank of its merge with the next one, looked up in a literal rank map.
Since a token's own merges are the same wherever its bytes are not yet joined with others, only the last pair of
each token's own encoding can ever make it; the map holds these pairs, as rows laid into one array by
displacement, so that a look-up is two array reads and a comparison.

The fold of a word that a task meets first begins after the merges that are certain: a pair whose rank is below that
of every merge that could take its left token to the left or its right one to the right, given the byte
before and after it, is merged at some time whatever else the word holds, and no sooner merge depends on it
(a token ranks above the tokens it is made of). Two rounds of them are made over the bytes of many words at once.

Python tasks around the fold cut texts into words and number them, then put the words' ids in the order of the
texts. Words that are tokens need no fold. The words of a bounded sample are folded first and broadcast
(at most ``KNOWN_WORDS``); all others are folded when a task first meets them and held until they are more than
``HELD_WORDS``. The sample changes no result, only how often a word is folded. Nothing is shuffled but the sample's word counts."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

from .common import doc_texts, slices

#: words folded ahead and broadcast at most, about 30 bytes each
KNOWN_WORDS = 400_000
#: words a task numbers before it begins anew
HELD_WORDS = 200_000
#: characters of the sample they come from, about
SAMPLE_CHARS = 64_000_000
#: documents of a slice: its row is held whole in the JVM, with what its fold leaves behind
CODED_DOCS = 100
#: words whose certain merges are made at once
CERTAIN_WORDS = 10_000
#: a token's place in a packed entry; the rank of its merge with the next token stands above it
BASE = 1 << 20
#: the packed rank of neighbours that do not merge
NONE = (BASE - 1) * BASE

_RANGE = [chr(c) for c in range(0x250)]
_L = "".join(re.escape(c) for c in _RANGE if unicodedata.category(c)[0] == "L")
_N = "".join(re.escape(c) for c in _RANGE if unicodedata.category(c)[0] == "N")
_S = "\t\n\x0b\x0c\r \x85\xa0"
_NEAR = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_FAR = re.compile("[^\x00-ɏ]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def words_of(text: str) -> list[str]:
    """The pieces of a text that are merged on their own. Texts of characters below U+0250 are cut by an
    equal pattern of ``re``, which is faster."""
    return _pattern().findall(text) if _FAR.search(text) else _NEAR.findall(text)


class Ranks:
    """A rank file and its merges as arrays."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.size = max(self.ranks.values()) + 1
        if self.size >= BASE - 1:
            raise ValueError(f"{path}: more tokens than {BASE - 2}")
        self.pieces = [b""] * self.size
        for token, r in self.ranks.items():
            self.pieces[r] = token
        self.whole = {}
        for token, r in self.ranks.items():
            try:
                self.whole[token.decode()] = r
            except UnicodeDecodeError:
                pass

    def merge(self, word: bytes, least: int = 1) -> list[bytes]:
        """Plain merges, down to ``least`` parts."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > least:
            rank, i = min((self.ranks.get(a + b, self.size), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == self.size:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    @cached_property
    def merges(self) -> list[tuple[int, int, int]]:
        """(left, right, rank) of the merge that makes each token of two bytes or more."""
        out = []
        for token, r in self.ranks.items():
            if len(token) > 1:
                parts = self.merge(token, 2)
                if len(parts) != 2:
                    raise ValueError(f"token {r} is not made by the merges of the file")
                out.append((*(self.ranks[p] for p in parts), r))
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """(displacement of a left token's row, packed entries, first ids of the 256 bytes): the merge of a and
        b is the entry at displacement[a] + b if its lower part is a."""
        rows: dict[int, list[tuple[int, int]]] = {}
        for left, right, r in self.merges:
            rows.setdefault(left, []).append((right, r))
        slots = 2 * len(self.ranks)
        entries = np.full(slots + self.size, NONE + BASE - 1)
        taken = np.zeros(len(entries), bool)
        start = np.zeros(self.size, np.int64)
        place = np.random.default_rng(0)
        for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
            rights = np.array([r for r, _ in row])
            at = int(place.integers(slots))
            while taken[at + rights].any():
                at = int(place.integers(slots))
            start[left] = at
            taken[at + rights] = True
            entries[at + rights] = [rank * BASE + left for _, rank in row]
        return start, entries, [self.ranks[bytes([i])] for i in range(256)]


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def _tables(path: str) -> tuple[np.ndarray, np.ndarray, list[int]]:
    return ranks(path).tables()


@lru_cache(maxsize=2)
def _literal(path: str) -> tuple[str, str, str]:
    return tuple(json.dumps([int(x) for x in t], separators=(",", ":")) for t in _tables(path))


class Certain:
    """Merges of tokens of one and two bytes that are made whatever else a word holds.

    ``before`` holds, by a token's row and the last byte of the token before it (256: none), the least rank of a merge that
    can take the token to the left; ``after`` the like by the first byte of the token after it."""

    def __init__(self, r: Ranks, tables: tuple[np.ndarray, np.ndarray, list[int]]):
        self.start, self.entries, first = tables
        self.first = np.array(first)
        self.head, self.last = (np.array([p[i] if p else 0 for p in r.pieces], np.uint8) for i in (0, -1))
        short = [i for i, p in enumerate(r.pieces) if 0 < len(p) < 3]
        self.row = np.zeros(r.size, np.int32)
        self.before, self.after = (np.full((len(short) + 1, 257), BASE - 1, np.int32) for _ in range(2))
        self.before[0] = self.after[0] = -1  # longer tokens: nothing is certain
        if all(x < rank or len(r.pieces[x]) == 1 for *parts, rank in r.merges for x in parts):
            self.row[short] = np.arange(1, len(short) + 1)
        for left, right, rank in r.merges:
            for table, token, byte in ((self.before, right, self.last[left]), (self.after, left, self.head[right])):
                if at := self.row[token]:
                    table[at, byte] = min(table[at, byte], rank)

    def entries_of(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the next token is of the same word, each token with the rank of its merge with that)."""
        inside = np.append(word[1:] == word[:-1], False)
        found = self.entries[self.start[ids] + np.append(ids[1:], 0)]
        return inside, np.where(inside & (found & (BASE - 1) == ids), found, ids + NONE)

    def merged(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and their words after the certain merges of a round; two of them never share a token."""
        inside, found = self.entries_of(ids, word)
        rank, right = found >> (BASE.bit_length() - 1), np.append(ids[1:], 0)
        left_byte = np.where(np.append(False, inside[:-1]), np.append(0, self.last[ids[:-1]]), 256)
        right_byte = np.where(np.append(inside[1:], False), np.append(self.head[right[1:]], 0), 256)
        sure = (rank < self.before[self.row[ids], left_byte]) & (rank <= self.after[self.row[right], right_byte])
        stay = ~np.append(False, sure[:-1])
        return np.where(sure, rank, ids)[stay], word[stay]

    def words(self, words: list[str]) -> pa.Array:
        """Entries of the tokens that words, none empty, consist of after two rounds."""
        parts = [pa.array([], pa.list_(pa.int64()))]
        for k in range(0, len(words), CERTAIN_WORDS):
            text = pa.array(words[k:k + CERTAIN_WORDS], pa.string())
            ends = np.frombuffer(text.buffers()[1], np.int32)[:len(text) + 1]
            ids = self.first[np.frombuffer(text.buffers()[2], np.uint8)[:ends[-1]]]
            word = np.repeat(np.arange(len(text)), np.diff(ends))
            for _ in range(2):
                ids, word = self.merged(ids, word)
            ends = np.searchsorted(word, np.arange(len(text) + 1)).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(self.entries_of(ids, word)[1])))
        return pa.concat_arrays(parts)


@lru_cache(maxsize=2)
def certain(path: str) -> Certain:
    return Certain(ranks(path), _tables(path))


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _token(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(BASE - 1).cast("long")).cast("int")


def _table(path: str) -> Column:
    start, entries, first = _literal(path)
    return F.struct(F.from_json(F.lit(start), "array<int>").alias("start"),
                    F.from_json(F.lit(entries), "array<long>").alias("entries"),
                    F.from_json(F.lit(first), "array<int>").alias("first"))


#: more items than an array has
_REST = 1 << 30


def _entry(t: Column, a: Column, b: Column) -> Column:
    """Token a with the rank of its merge with b."""
    found = F.get(t["entries"], F.get(t["start"], a) + b)
    return F.when(found.bitwiseAND(F.lit(BASE - 1).cast("long")) == a, found).otherwise(a + F.lit(NONE))


def _fold(t: Column, entries: Column, most: Column) -> Column:
    """Token ids of a word of ``most`` tokens at most, from the entries of its tokens: a merge a step."""

    def step(state: Column, _: Column) -> Column:
        def merged(least: Column) -> Column:
            new = F.shiftright(least, BASE.bit_length() - 1).cast("int")

            def at(i: Column) -> Column:
                before = (F.when(i > 1, F.array(_entry(t, _token(F.get(state, i - 2)), new)))
                          .otherwise(F.slice(state, F.lit(1), F.lit(0))))
                own = (F.when(i + 1 < F.size(state), _entry(t, new, _token(F.get(state, i + 1))))
                       .otherwise(new + F.lit(NONE)))
                return F.flatten(F.array(F.slice(state, F.lit(1), F.greatest(i - 2, F.lit(0))), before, F.array(own),
                                         F.slice(state, i + 2, F.lit(_REST))))

            place = F.array_position(state, least).cast("int")
            return F.when(least >= F.lit(NONE), state).otherwise(_let(place, at))

        return _let(F.array_min(state), merged)

    return F.transform(F.aggregate(F.sequence(F.lit(2), F.greatest(most, F.lit(2))), entries, step), _token)


def _each(words: Column, path: str, one) -> Column:
    """``one(table, word)`` of each item of an array."""
    return (F.when(F.size(words) == 0, F.array().cast("array<array<int>>"))
            .otherwise(_let(_table(path), lambda t: F.transform(words, lambda w: one(t, w)))))


def encode_words(words: Column, path: str) -> Column:
    """Token ids (array of arrays of int) of an array of words that are not empty. A word of n bytes takes up
    to n - 1 steps, each copying what is left of it: a run of 20,000 letters without a break takes seconds."""

    def one(t: Column, word: Column) -> Column:
        letters = F.split(F.decode(F.encode(word, "utf-8"), "ISO-8859-1"), "")
        ids = F.transform(letters, lambda c: F.get(t["first"], F.ascii(c)))

        def entries_of(p: Column) -> Column:
            return F.zip_with(p, F.slice(p, F.lit(2), F.lit(_REST)),
                              lambda a, b: F.when(b.isNull(), a + F.lit(NONE)).otherwise(_entry(t, a, b)))

        return _fold(t, _let(ids, entries_of), F.octet_length(word))

    return _each(words, path, one)


def encode_entries(words: Column, path: str) -> Column:
    """``encode_words`` of words that are given as the entries of their tokens (``Certain.words``)."""
    return _each(words, path, lambda t, entries: _fold(t, entries, F.size(entries)))


class _Known:
    """Codes of the words that every slice knows: tokens by their id, then the broadcast words."""

    def __init__(self, path: str, words: pa.Array, ids: pa.Array):
        self.words, self.ids, self.path = words, ids, path
        self.pieces = ranks(path).pieces
        self.count = len(self.pieces) + len(words)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all codes end to end, their starts, their numbers): made by the tasks that put ids in order alone.
        A worker takes either kind of task in turn and lets go of what the other kind needs."""
        self.__dict__.pop("codes", None)
        size, ends = len(self.pieces), self.ids.offsets.to_numpy()
        return (np.concatenate([np.arange(size, dtype=np.int32), self.ids.flatten().to_numpy()]),
                np.concatenate([np.arange(size), ends[:-1].astype(np.int64) - ends[0] + size]),
                np.concatenate([np.ones(size, np.int32), np.diff(ends)]))

    @cached_property
    def codes(self) -> dict[str, int]:
        """Made by the tasks that number words alone; those that put ids in order go without."""
        self.__dict__.pop("tables", None)
        r = ranks(self.path)
        codes = dict(r.whole)
        for i, w in enumerate(self.words.to_pylist(), r.size):
            codes.setdefault(w, i)
        return codes


_HELD: dict[str, _Known] = {}


def _known(path: str, sent) -> _Known:
    """The known words of this worker, made once for each broadcast."""
    key = f"{path}:{sent.value[0]}"
    if key not in _HELD:
        _HELD.clear()
        words, ids = pa.ipc.open_stream(sent.value[1]).read_all().columns
        # one batch, as it was sent, is read in place
        _HELD[key] = _Known(path, *(c.chunk(0) if c.num_chunks == 1 else c.combine_chunks() for c in (words, ids)))
    return _HELD[key]


class _Numbers(dict):
    """Codes of a task's words; those that are not known yet are numbered on. ``rare`` holds those of the slice at
    hand, ``held`` says how many came with the slices before it."""

    def __init__(self, known: _Known):
        super().__init__()
        self.known, self.first, self.held, self.rare = known.codes, known.count, 0, []

    def next_slice(self) -> None:
        self.held, self.rare = self.held + len(self.rare), []

    def __missing__(self, word: str) -> int:
        code = self.known.get(word)
        if code is None:
            code = self.first + self.held + len(self.rare)
            self.rare.append(word)
        self[word] = code
        return code


_SLICES = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("codes", pa.binary()),
                     ("held", pa.int64()), ("rare", pa.list_(pa.list_(pa.int64())))])
_SLICES_DDL = "doc_ids array<long>, n_words array<long>, codes binary, held long, rare array<array<long>>"


def _sample_words(docs: DataFrame, path: str) -> DataFrame:
    """(word, n) of the sample, without tokens."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    share = min(1.0, SAMPLE_CHARS / max(1, chars))
    part = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))

    def count(batches):
        whole = ranks(path).whole
        for _, texts in slices(batches):
            seen: dict[str, int] = {}
            for text in texts:
                for w in words_of(text):
                    seen[w] = seen.get(w, 0) + 1
            rare = [w for w in seen if w not in whole]
            yield pa.record_batch([pa.array(rare, pa.string()), pa.array([seen[w] for w in rare], pa.int64())], ["word", "n"])

    return part.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _broadcast_known(docs: DataFrame, path: str):
    """The most frequent words of the sample with their ids, as an Arrow stream: as many whole steps of frequency as fit KNOWN_WORDS."""
    spark = docs.sparkSession
    words = materialize(_sample_words(docs, path), "bpe-sample")
    least, total = None, 0
    for r in words.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        total += r["count"]
        if total > KNOWN_WORDS:
            break
        least = r["n"]
    chosen = words.where(F.col("n") >= F.lit(least)) if least is not None else words.limit(0)
    known = chosen.select("word", F.get(encode_words(F.array("word"), path), F.lit(0)).alias("ids")).toArrow()
    known = known.cast(pa.schema([("word", pa.string()), ("ids", pa.list_(pa.int32()))])).combine_chunks()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, known.schema) as w:
        w.write_table(known)
    data = out.getvalue().to_pybytes()
    return spark.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))


def _coded(docs: DataFrame, path: str, sent) -> DataFrame:
    """Slices: their documents, the codes of all words in order, and the ids of the words that were not known. Codes may
    stand for words of the ``held`` ones that came with earlier slices of the task (0: it begins anew)."""
    merges = docs.sparkSession.sparkContext.broadcast(certain(path))

    def number(batches):
        known, numbers = _known(path, sent), None
        for ids, texts in slices(batches, CODED_DOCS):
            if numbers is None or len(numbers) > HELD_WORDS:
                numbers = _Numbers(known)
            numbers.next_slice()
            codes, sizes = [], []
            for text in texts:
                words = words_of(text)
                sizes.append(len(words))
                codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([np.concatenate(codes).tobytes()], pa.binary()), pa.array([numbers.held], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(numbers.rare)], pa.int32()), merges.value.words(numbers.rare))],
                schema=_SLICES)

    return (docs.mapInArrow(number, _SLICES_DDL)
            .select("doc_ids", "n_words", "codes", "held", encode_entries(F.col("rare"), path).alias("rare_ids")))


def _documents(batches, known: _Known):
    """(doc_ids, ids of all words of a slice, the place after each document's last id) of a task's coded slices in order."""
    values, starts, sizes = known.tables
    for batch in batches:
        for i in range(batch.num_rows):
            doc_ids, n_words, codes, held, rare = (batch.column(c)[i] for c in range(5))
            if not held.as_py():
                values, starts, sizes = known.tables
            if len(sizes) - known.count != held.as_py():
                raise ValueError("a slice came without those before it")
            rare = rare.values
            places = rare.offsets.to_numpy()
            starts = np.concatenate([starts, places[:-1].astype(np.int64) - places[0] + len(values)])
            values = np.concatenate([values, rare.flatten().to_numpy()])
            sizes = np.concatenate([sizes, np.diff(places)])
            words = np.frombuffer(codes.as_buffer(), np.uint32)
            n = sizes[words]
            after = np.concatenate([[0], np.cumsum(n)])
            at = np.repeat(starts[words] - after[:-1], n)
            at += np.arange(after[-1])
            ids, ends = values[at], after[np.cumsum([0, *n_words.as_py()])]
            del words, n, after, at
            yield doc_ids.as_py(), ids, ends


def _per_document(docs: DataFrame, path: str | None, make, schema: str) -> DataFrame:
    """``make(doc_id, ids, pieces)`` of each document, as rows of ``schema``."""
    path = path or default_path()
    docs = doc_texts(docs)
    sent = _broadcast_known(docs, path)

    def rows(batches):
        known = _known(path, sent)
        for doc_ids, ids, ends in _documents(batches, known):
            for first in range(0, len(doc_ids), 500):
                part = range(first, min(first + 500, len(doc_ids)))
                yield _batch([make(doc_ids[k], ids[ends[k]:ends[k + 1]], known.pieces) for k in part], schema)

    return _coded(docs, path, sent).mapInArrow(rows, schema)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids of every whole text, as the tiktoken library's ``encode_ordinary`` gives them.

    A null or empty text has no ids; a null or repeated doc_id stands as it is, one row for each row; extra
    columns, whatever their names, are left out; an empty table gives an empty table. Texts of any length are encoded whole."""
    return _per_document(docs, path, lambda doc_id, ids, _: (doc_id, len(ids), ids.astype(np.int32)), "doc_id long, n_tokens long, ids array<int>")


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, bytes: the joined pieces of the ``ids`` of each row (null ids: null). Ids outside the rank file raise."""
    path = path or default_path()

    def join(batches):
        pieces = ranks(path).pieces
        for batch in batches:
            for first in range(0, batch.num_rows, 100):
                part = batch.slice(first, 100)
                joined = [None if ids is None else b"".join([pieces[i] for i in ids]) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(joined, pa.binary())], ["doc_id", "bytes"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(join, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and lowercase hex SHA-256 of the ids (little-endian unsigned 32-bit) and of the bytes
    decoded from them, for every document; nulls, empty texts and repeats as in ``encode``."""

    def row(doc_id, ids, pieces):
        return (doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(b"".join([pieces[i] for i in ids.tolist()])).hexdigest())

    return _per_document(docs, path, row, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
