"""Token ids as raw binary payloads in shards, with a minimal perfect hash from document keys to
offsets and stored fingerprints."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import default_path
from .common import GOLDEN, doc_texts, mix, slices
from .wordpieces import SPECIAL, tokenizer, word_tokenizer, words_of

#: ids and documents after which a shard is closed: 4 MB of payload unless one text has more
SHARD_IDS, SHARD_DOCS = 1_000_000, 4096
#: id that ends each document
END_ID = 1
#: words whose ids a task holds at most
HELD_WORDS = 1_000_000
#: shards whose bounds are searched at once in a lookup, 24 bytes each
LOOKUP_SHARDS = 2_000_000

SHARD_SCHEMA = ("part int, shard int, first_key long, last_key long, n_docs long, n_ids long, part_start long, "
                "width int, payload binary, keys binary, starts binary, seeds binary, slots binary")


# --- minimal perfect hash ----------------------------------------------------------

def _key_hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.view(np.uint64) + GOLDEN)


def _slot(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (mix(h ^ (seed.astype(np.uint64) * GOLDEN)) % np.uint64(n)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slot of each key) of a minimal perfect hash of distinct int64 keys: keys fall into buckets of
    four on average; the largest bucket first, each takes the least seed that sends its keys to free slots."""
    n = len(keys)
    h = _key_hash(keys)
    buckets = max(1, n // 4)
    of = (h >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of.astype(np.int64), minlength=buckets)
    start = np.cumsum(sizes) - sizes
    seeds, slots, free = np.zeros(buckets, np.uint32), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        own = order[start[b]:start[b] + sizes[b]]
        at = 0
        while True:
            trial = np.arange(at, at + 64)
            slot = _slot(h[own][None, :], trial[:, None], n)
            ok = free[slot].all(axis=1)
            if len(own) > 1:
                ranked = np.sort(slot, axis=1)
                ok &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if ok.any():
                k = int(ok.argmax())
                seeds[b], slots[own] = at + k, slot[k]
                free[slot[k]] = False
                break
            at += 64
    return seeds, slots


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(_key_hash(keys) + GOLDEN) >> np.uint64(32)).astype(np.uint32)


def find_slots(keys: np.ndarray, seeds: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where the fingerprint there is another's."""
    if not len(prints):
        return np.full(len(keys), -1)
    h = _key_hash(keys)
    slot = _slot(h, seeds[((h >> np.uint64(32)) % np.uint64(len(seeds))).astype(np.int64)], len(prints))
    return np.where(prints[slot] == fingerprints(keys), slot, -1)


#: a slot: fingerprint, number of the first document with the key, how many follow with it
SLOT = np.dtype([("print", "<u4"), ("first", "<u4"), ("count", "<u4")])


def shard_row(part: int, shard: int, keys: list[int], ids: list[bytes], width: int, part_start: int) -> tuple:
    """A shard of documents in order of their keys; equal keys follow each other and share a slot."""
    key = np.array(keys, np.int64)
    sizes = np.array([len(x) // width for x in ids], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    distinct, first, count = np.unique(key, return_index=True, return_counts=True)
    seeds, slot = build_hash(distinct)
    slots = np.zeros(len(distinct), SLOT)
    slots["print"][slot], slots["first"][slot], slots["count"][slot] = fingerprints(distinct), first, count
    return (part, shard, int(key[0]), int(key[-1]), len(key), int(starts[-1]), part_start, width, b"".join(ids),
            key.astype("<i8").tobytes(), starts.astype("<i8").tobytes(), seeds.astype("<u4").tobytes(), slots.tobytes())


class Shard:
    """Constant-time access to a shard row by key."""

    def __init__(self, row: dict):
        self.width = row["width"]
        self.payload = memoryview(row["payload"])
        self.starts = np.frombuffer(row["starts"], "<i8")
        self.seeds = np.frombuffer(row["seeds"], "<u4")
        self.slots = np.frombuffer(row["slots"], SLOT)

    def locate(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the first document and how many there are for each key; 0 where there is none."""
        slot = find_slots(keys, self.seeds, self.slots["print"])
        hit = self.slots[slot]
        return hit["first"].astype(np.int64), np.where(slot >= 0, hit["count"], 0).astype(np.int64)

    def ids(self, doc: int) -> np.ndarray:
        a, b = self.starts[doc:doc + 2] * self.width
        return np.frombuffer(self.payload[a:b], f"<u{self.width}").astype("<u4")


# --- writing -----------------------------------------------------------------------

#: words that go to the library in one text
TOGETHER = 200


class _Ids(dict):
    """Raw ids of words, encoded by the library once each. Many words go to it as one text with blanks between
    them; each word's ids end with a token that holds the end-of-word mark."""

    def __init__(self, path: str, width: int):
        super().__init__()
        self.tok, self.kind, self.width = word_tokenizer(path), f"<u{width}", width
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>") or SPECIAL.fullmatch(t)]] = True

    def add(self, words: list[list[str]]) -> None:
        new = list(set().union(*words).difference(self))
        parts = [new[i:i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        for part, e in zip(parts, self.tok.encode_batch_fast(list(map(" ".join, parts)), add_special_tokens=False)):
            ids = np.array(e.ids, self.kind)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.width).tolist()
            if len(cuts) == len(part):
                raw = ids.tobytes()
                self.update(zip(part, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))
            else:  # some word is not cut as it was: each for itself
                for w in part:
                    self[w] = np.array(self.tok.encode(w, add_special_tokens=False).ids, self.kind).tobytes()


@lru_cache(maxsize=2)
def _ids(path: str, width: int) -> _Ids:
    return _Ids(path, width)


def write(docs: DataFrame, to: str, path: str | None = None, partitions: int | None = None) -> None:
    """Writes the ids of every row of ``docs(doc_id, text)`` and an end id, by ascending doc_id, as a store at ``to``.

    A store is a table of shards by (part, shard): ``payload`` holds the raw little-endian ids (2 bytes each
    if the vocabulary allows, else 4), ``starts`` the offset of each document, ``seeds`` and ``slots`` the
    hash from keys to documents, with fingerprints; ``keys`` lists the keys for scans. Rows are dealt to parts
    by ranges of (doc_id, hash of text), so not even a doc_id that many rows share goes to one task; a
    null doc_id is written as key -2^63, null text as empty. Rows of one doc_id are ordered by text hash. An
    empty table gives an empty store."""
    path = path or default_path()
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 else 4
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (doc_texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
            .withColumn("h", F.xxhash64("text")))
    ordered = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    tagged = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        held = _ids(path, width)
        end = np.array([END_ID], f"<u{width}").tobytes()
        part, shard, done, keys, ids, size = None, 0, 0, [], [], 0

        def close():
            row = shard_row(part, shard, keys, ids, width, done)
            cols = [pa.array([v], k) for v, k in zip(row, [pa.int32()] * 2 + [pa.int64()] * 5 + [pa.int32()] + [pa.binary()] * 5)]
            return pa.record_batch(cols, [f.split()[0] for f in SHARD_SCHEMA.split(", ")])

        def numbered():
            nonlocal part
            for batch in batches:
                if batch.num_rows:
                    part = batch.column(2)[0].as_py()
                yield batch

        for some, texts in slices(numbered()):
            words = [words_of(t, path) for t in texts]
            held.add(words)
            for key, ws in zip(some, words):
                one = b"".join(map(held.__getitem__, ws)) + end
                keys.append(key)
                ids.append(one)
                size += len(one) // width
                if size >= SHARD_IDS or len(keys) >= SHARD_DOCS:
                    yield close()
                    shard, done, keys, ids, size = shard + 1, done + size, [], [], 0
            if len(held) > HELD_WORDS:
                held.clear()
        if keys:
            yield close()

    tagged.mapInArrow(run, SHARD_SCHEMA).write.parquet(to)


# --- reading -----------------------------------------------------------------------

def _part_bases(shards: DataFrame) -> DataFrame:
    """``part, base``: ids before each part. One row for each task that wrote, so the order over them is small."""
    from pyspark.sql import Window

    total = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return total.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a store: each shard's keys are looked up in its hash, and
    the payload is cut at the offsets found. ``start`` counts the ids of all documents before."""
    shards = spark.read.parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                keys = np.unique(np.frombuffer(row["keys"], "<i8"))
                first, count = shard.locate(keys)
                doc = np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)])
                got = [shard.ids(d) for d in doc]
                start = row["part_start"] + shard.starts[doc]
                yield pa.record_batch(
                    [pa.array(np.repeat(keys, count), pa.int64()), pa.array([row["part"]] * len(doc), pa.int32()),
                     pa.array(start, pa.int64()), pa.array([len(g) for g in got], pa.int64()),
                     pa.array([zlib.crc32(g.tobytes()) for g in got], pa.int64())],
                    ["doc_id", "part", "start", "n_tokens", "ids_crc32"])

    found = shards.mapInArrow(run, "doc_id long, part int, start long, n_tokens long, ids_crc32 long")
    return (found.join(F.broadcast(_part_bases(shards)), "part")
            .select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"),
                    (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"))


def _placed(wanted: DataFrame, shards: DataFrame) -> DataFrame:
    """``part, shard, key`` of the shards that may hold each of ``wanted(key)``. Shards lie in the order of their keys, so a
    search of their sorted bounds gives them; bounds of more than LOOKUP_SHARDS shards are searched in blocks, each against all keys."""
    bounds = shards.select("first_key", "last_key", "part", "shard")
    blocks = -(-bounds.count() // LOOKUP_SHARDS)
    out = None
    for b in range(blocks):
        mine = bounds.where(F.pmod(F.xxhash64("part", "shard"), F.lit(blocks)) == b).toArrow().sort_by([("first_key", "ascending"), ("last_key", "ascending")])
        held = wanted.sparkSession.sparkContext.broadcast([mine.column(c).to_numpy() for c in ("first_key", "last_key", "part", "shard")])

        def run(batches, held=held):
            first, last, part, shard = held.value
            for batch in batches:
                key = batch.column(0).to_numpy()
                lo, hi = np.searchsorted(last, key, "left"), np.searchsorted(first, key, "right")
                n = np.maximum(hi - lo, 0)
                at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.record_batch([pa.array(part[at], pa.int32()), pa.array(shard[at], pa.int32()), pa.array(np.repeat(key, n))],
                                      ["part", "shard", "key"])

        found = wanted.mapInArrow(run, "part int, shard int, key long")
        out = found if out is None else out.unionByName(found)
    return wanted.select(F.lit(0).alias("part"), F.lit(0).alias("shard"), "key").limit(0) if out is None else out


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` for the rows of a store whose doc_id is in ``keys(doc_id)``; keys that it does not hold give no
    row. A binary search of the shards' bounds gives each key its shard, and there one hash access finds the
    document; only shards that are asked for are read past their bounds."""
    spark = keys.sparkSession
    shards = spark.read.parquet(path)
    wanted = keys.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key")).distinct()
    asked = _placed(wanted, shards).groupBy("part", "shard").agg(F.collect_list("key").alias("asked"))  # SHARD_DOCS keys at most match
    full = asked.join(shards, ["part", "shard"]).select("asked", *[f.split()[0] for f in SHARD_SCHEMA.split(", ")])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard, want = Shard(row), np.array(row["asked"], np.int64)
                stored = np.frombuffer(row["keys"], "<i8")
                keys, ids = [], []
                for k, f, c in zip(want, *shard.locate(want)):
                    for d in range(f, f + c):
                        if stored[d] == k:  # a fingerprint of 32 bits can be met by chance
                            keys.append(int(k))
                            ids.append(shard.ids(d).astype(np.int64))
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return full.mapInArrow(run, "doc_id long, ids array<long>")


def store_and_read(docs: DataFrame) -> DataFrame:
    """Writes a store of ``docs`` into the session's shared folder and reads all documents back from it."""
    to = scratch_path(docs.sparkSession, "tokens")
    write(docs, to)
    return read(docs.sparkSession, to)
