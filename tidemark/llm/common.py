"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ids that may be broadcast: 2 million longs are 16 MB; beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
#: documents handled at once inside a task, whatever the size of an Arrow batch
SLICE_DOCS = 1000
#: characters after which a slice ends early, so that very long texts do not add up
SLICE_CHARS = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one: what else the
    input holds, under whatever names, is neither read nor shuffled."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def text_slices(batches, at: int, most: int = SLICE_CHARS, docs: int = SLICE_DOCS):
    """Parts of Arrow batches of at most ``docs`` rows and about ``most`` bytes of text in column ``at``; a longer text is a part alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(size, dtype=np.int64), 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = min(max(first + 1, int(np.searchsorted(ends, done + most, "right"))), first + docs)
            yield batch.slice(first, last - first)
            first = last
        del batch
        release()


def slices(batches, docs: int = SLICE_DOCS, most: int = SLICE_CHARS):
    """(ids, texts) lists of the ``text_slices`` of a ``mapInArrow`` over ``doc_texts``."""
    for part in text_slices(batches, 1, most, docs):
        ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
        del part  # else its batch stays while the next is read
        yield ids, texts


def with_ids(docs: DataFrame, ids: DataFrame, how: str, column: str = "doc_id") -> DataFrame:
    """``docs`` with (``left_semi``) or without (``left_anti``) the rows whose ``column`` is in
    the first column of ``ids`` (null equals null). The ids are counted: up to
    BROADCAST_IDS they are broadcast, so the texts stay where they are; more are joined by shuffle."""
    ids = ids.select(F.col(ids.columns[0]).alias("_key_of_ids"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[column].eqNullSafe(ids["_key_of_ids"]), how)


GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over a uint64 array (fixed public constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release() -> None:
    """Gives back the memory of Arrow batches that are gone, which Arrow's pool would hold for later ones."""
    pa.default_memory_pool().release_unused()


_KEPT: list = []


def kept(make):
    """What ``make`` gives for its arguments, kept by a worker from task to task (two at most) until ``let_go``."""
    out = lru_cache(maxsize=2)(make)
    _KEPT.append(out)
    return out


def let_go() -> None:
    """Frees what this worker kept for other operators: called first in tasks that keep nothing themselves, as a worker
    serves all operators of a session in turn and would hold the tables of all of them."""
    held = [x for x in _KEPT if x.cache_info().currsize]
    if held:
        for x in held:
            x.cache_clear()
        gc.unfreeze()
        gc.collect()
    release()


class Memo(dict):
    """Values of words, made on first use; emptied by ``trim`` once it has grown past ``most``."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        self[key] = value = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
