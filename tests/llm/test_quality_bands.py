"""Quality rules (op 8): Kneser-Ney values against a plain model, and what the bands reject."""
import math
from collections import Counter, defaultdict

import numpy as np
from awkward import none, odd, small  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import table

SF1 = "/root/testdata/sf0.1"


def plain_model(texts):
    """Modified Kneser-Ney over character 4-grams of words, by dictionaries: a function to log probabilities of words."""
    n = quality.ORDER
    counts = {n: Counter()}
    for t in texts:
        for w in quality.words_of(t):
            s = quality.START * (n - 1) + w + quality.END
            counts[n].update(s[i:i + n] for i in range(len(w) + 1))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, total, taken = {}, {}, {}
    for k in range(1, n + 1):
        few = Counter(counts[k].values())
        y = few[1] / max(few[1] + 2 * few[2], 1)
        d = {j: min(max(j - (j + 1) * y * few[j + 1] / max(few[j], 1), 0.1), j - 0.1) for j in (1, 2, 3)}
        total[k], taken[k] = defaultdict(float), defaultdict(float)
        for g, c in counts[k].items():
            cut[g] = d[min(c, 3)]
            total[k][g[:-1]] += c
            taken[k][g[:-1]] += cut[g]

    def p(g):
        if not g:
            return 1 / max(2, len(counts[1].keys() | total[2].keys()) + 1)  # all signs, the start sign among them, and an unknown one
        k, ctx = len(g), g[:-1]
        if ctx not in total[k]:
            return p(g[1:])
        own = (counts[k][g] - cut[g]) / total[k][ctx] if g in counts[k] else 0.0
        return own + taken[k][ctx] / total[k][ctx] * p(g[1:])

    def word(w):
        s = quality.START * (n - 1) + w + quality.END
        return sum(math.log(p(s[i:i + n])) for i in range(len(w) + 1))

    return word


def test_perplexity_equals_plain_model(spark, small):
    docs = small.where("length(text) < 3000").withColumn("lang", F.lit("x"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    word = plain_model(texts.values())
    got = {r.doc_id: r.perplexity for r in quality.quality(docs).collect()}
    for i, t in texts.items():
        ws = quality.words_of(t)
        if ws:
            want = math.exp(-sum(map(word, ws)) / (sum(map(len, ws)) + len(ws)))
            assert abs(got[i] / want - 1) < 1e-9
        else:
            assert got[i] is None


def test_bands_equal_plain_medians(spark, small):
    docs = small.withColumn("lang", F.lit("x"))
    rows = quality.quality(docs.unionByName(docs.where("doc_id < 30"))).collect()  # copies count once
    fit = {(r.n_words, r.word_chars, r.n_symbols, r.perplexity) for r in rows if r.perplexity and r.n_words >= 50}
    low = lambda v: sorted(v)[(len(v) + 1) // 2 - 1]
    middle = low([math.log(x[3]) for x in fit])
    spread = low([abs(math.log(x[3]) - middle) * math.sqrt(x[0] + x[1]) for x in fit])
    for r in rows:
        if r.n_words:
            reach = quality.REACH * max(spread, quality.LEAST_SPREAD) / math.sqrt(r.n_words + r.word_chars)
            assert abs(math.log(r.upper) - middle - reach) < 0.02 and abs(math.log(r.lower) - middle + reach) < 0.02
        inside = r.perplexity is not None and r.lower <= r.perplexity <= r.upper
        assert r.kept == (not r.base_failed and inside)


def test_bands_reject_labelled_junk(spark):
    kept = quality.quality(table(spark, SF1, "documents")).select("doc_id", "kept", "base_failed")
    share = {r.quality: (r.kept, r.base) for r in kept.join(table(spark, SF1, "labels"), "doc_id").groupBy("quality")
             .agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg((~F.col("base_failed")).cast("int")).alias("base")).collect()}
    assert share[0][0] <= 0.25 and share[0][1] > 0.45  # the base rules alone let half of the junk pass
    assert share[1][0] >= 0.93


def test_awkward_rows_have_a_verdict(odd, none):
    rows = quality.quality(odd).collect()
    assert len(rows) == odd.count() and all(r.kept is not None for r in rows)
    assert all(not r.kept and r.perplexity is None for r in rows if not r.n_words)
    assert quality.quality(none).collect() == [] and np.isfinite(quality.LEAST_SPREAD)
