"""Importance resampling (op 13) against a plain version."""
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from awkward import none, odd, small  # noqa: F401
from conftest import SF001

from tidemark.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def plain(docs, target):
    docs = [(r.doc_id, *features(r.text)) for r in docs.collect()]
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for _, _, f in docs:
        np.add.at(s, f, 1)
    for r in target.collect():
        np.add.at(t, features(r.text)[1], 1)
    gain = [math.floor(1000 * math.log((int(b) + 1) * (int(s.sum()) + 10000) / ((int(a) + 1) * (int(t.sum()) + 10000)))) for a, b in zip(s, t)]
    out = []
    for i, w, f in docs:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, -r[2]))
    k = 25 * len(fit) // 100
    rows = [(*fit[n][:1], *fit[n][2:], n + 1 if n < k else None) for n in range(len(fit))] + [(r[0], *r[2:], None) for r in out if r[1] < 20]
    return sorted(rows, key=str)


def test_equals_plain(odd, small, spark):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    for docs in (small, odd):
        got = sorted((tuple(r) for r in resample.resample(docs, bench).collect()), key=str)
        assert got == plain(docs, bench)


def test_words():
    texts = ["", "A", " ab1 ÀB\x00c_d", "x" * 30, "漢字 Ⅷ\x7f\x80y", "a b a b a b", "\n", "é"]
    for size in (1, 1 << 20):
        resample.BLOCK_BYTES, held = size, resample.BLOCK_BYTES
        got = []
        for a, b in resample._blocks(pa.array(texts)):
            w, n, p, m = resample.block_features(pa.array(texts).slice(a, b - a), 10000)
            for k in range(b - a):
                got.append((list(w[n[:k].sum():n[:k + 1].sum()]), list(p[m[:k].sum():m[:k + 1].sum()])))
        resample.BLOCK_BYTES = held
        assert [a + b for a, b in got] == [features(t)[1] for t in texts]


def test_empty_tables(none, small, spark):
    empty = none.select("text")
    assert resample.resample(none, empty).collect() == []
    got = sorted((tuple(r) for r in resample.resample(small, empty).collect()), key=str)
    assert got == plain(small, empty)
