"""Importance resampling towards a target distribution, on Arrow kernels.

Texts are bags of hashed word n-grams. Two passes read the documents: the first adds up what each bucket holds in
all documents and in the target texts (10,000 numbers a task), the second takes each feature's gain, the
logarithm of how much more common its bucket is in the target. A document's score is its mean gain plus Gumbel noise
drawn from its id, and the highest scores are drawn: sampling without replacement in proportion to importance.

Inside a task a block of texts is lowered by ``ascii_lower``, cut by ``split_pattern_regex``, flattened and
dictionary-encoded; shifted indices form the pairs, whose codes are dictionary-encoded in turn, so that
each distinct word and pair of a block is hashed once; ``take`` and sums over segments give the documents' gains."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rolling import positions
from tidemark.session import materialize

from .common import SLICE_CHARS, doc_texts

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 25, 20, 7
#: bytes of text in one block of kernels, about; the last text of a block may be longer
BLOCK_BYTES = SLICE_CHARS
#: what stands between words: ASCII other than digits and lower-case letters
_BETWEEN = r"[\x00-/:-`{-\x7f]+"


def _blocks(texts: pa.Array):
    """(first, last) row ranges of about BLOCK_BYTES."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(ends):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")))
        yield first, last
        first = last


def _crc(strings: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, strings.cast(pa.binary()).to_pylist()), np.int64, len(strings))


def block_features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of the words in order, words of each text, buckets of the pairs in order, pairs of each text)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), _BETWEEN)
    words, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(pc.binary_length(words), 0)
    words, parent = words.filter(real), parent.filter(real).to_numpy(zero_copy_only=False)
    n_words = np.bincount(parent, minlength=len(texts))
    coded = words.dictionary_encode()
    vocabulary, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    word_bucket = (_crc(vocabulary) % buckets)[index]
    together = parent[1:] == parent[:-1]
    size = max(1, len(vocabulary))
    pairs = pa.array((index[:-1] * size + index[1:])[together]).dictionary_encode()
    code = pairs.dictionary.to_numpy(zero_copy_only=False)
    joined = pc.binary_join_element_wise(vocabulary.take(pa.array(code // size)), vocabulary.take(pa.array(code % size)), " ")
    pair_bucket = (_crc(joined) % buckets)[pairs.indices.to_numpy(zero_copy_only=False)]
    return word_bucket, n_words, pair_bucket, np.maximum(n_words - 1, 0)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for first, last in _blocks(batch.column(0)):
                words, _, pairs, _ = block_features(batch.column(0).slice(first, last - first), buckets)
                held += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        full = np.flatnonzero(held)
        yield pa.record_batch([pa.array(full, pa.int64()), pa.array(held[full], pa.int64())], ["bucket", "n"])

    rows = (doc_texts(docs.withColumn("doc_id", F.lit(0))).select("text").mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares of each bucket, floored."""
    b, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""

    def score(batches):
        for batch in batches:
            for first, last in _blocks(batch.column(1)):
                part = batch.slice(first, last - first)
                words, n_words, pairs, n_pairs = block_features(part.column(1), len(gain))
                total = _segments(gain[words], n_words) + _segments(gain[pairs], n_pairs)
                n = n_words + n_pairs
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                drawn = np.array([noise(i, seed) for i in part.column(0).to_pylist()], np.int64)
                yield pa.record_batch([part.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n, weight, weight + drawn))],
                                      ["doc_id", "n_words", "n_features", "weight", "score"])

    return doc_texts(docs).mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def _segments(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes, 0 for empty ones."""
    after = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return after[ends] - after[ends - sizes]


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document. Of the documents with at least ``min_words``
    words the given percentage (rounded down) is drawn by score; ``rank`` is 1 for the highest, null if not drawn.

    Ties go to the smaller doc_id, a null one first, then to more features. A null or empty text has no features and weight 0; a null doc_id
    draws its noise as an empty one; repeated rows are documents of their own; extra columns are not read;
    an empty table gives an empty table, an empty target leaves its shares to the smoothing."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = materialize(scores(docs, gain, seed), "scores")
    fit = scored.where(F.col("n_words") >= min_words)
    n = fit.count()
    ranked = positions(fit.withColumn("below", -F.col("score")).withColumn("fewer", -F.col("n_features")),
                       [], ["below", "doc_id", "fewer"], n=n, single_task_rows=0)
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.col("_rn").cast("long")
    drawn = ranked.select(*columns, F.when(rank <= percent * n // 100, rank).alias("rank"))
    return drawn.unionByName(scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))
