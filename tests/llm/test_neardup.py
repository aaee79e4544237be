"""Near-duplicates (op 9) against brute force."""
import random
from collections import Counter
from itertools import combinations

import numpy as np
from awkward import none, odd, small  # noqa: F401

from tidemark.llm import neardup
from tidemark.llm.components import connected_components


def bag(text):
    w = text.split()
    return Counter(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """doc_id -> class by all pairs."""
    texts = sorted({" ".join((t or "").split()) for _, t in rows})
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in combinations(range(len(texts)), 2):
        both, all_ = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
        if all_ and 5 * both >= 4 * all_:
            parent[root(i)] = root(j)
    least = {}
    for d, t in rows:
        k = root(texts.index(" ".join((t or "").split())))
        least[k] = min(least.get(k, d), d)
    return {d: least[root(texts.index(" ".join((t or "").split())))] for d, t in rows}


def family(n, seed):
    """Copies of a base at growing distance, a hot group of exact copies, and texts that share a passage."""
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(40)]
    rows = []
    for i in range(n):
        w = list(base)
        for k in random.sample(range(120), i % 5):
            w[k] = word()
        rows.append(" ".join(w))
    rows += [" ".join(base)] * n
    rows += [" ".join(passage + [word() for _ in range(40)]) for _ in range(n)]
    return list(enumerate(rows))


def test_classes_equal_brute_force(spark, small):
    for rows in (family(60, 1), [(r.doc_id, r.text) for r in small.collect()]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        members, links = neardup.near_duplicates(docs)
        assert {r.doc_id: r.class_id for r in members.collect()} == brute(rows)
        assert all(r.similarity >= 0.8 for r in links.collect())
    assert neardup.drop_near_duplicates(docs).count() == len(set(brute(rows).values()))


def test_second_meeting_finds_what_the_star_leaves(spark):
    # the centre links all; two outer texts are near each other but not near the centre
    rows = family(0, 2)
    random.seed(9)
    base = ["w%d" % i for i in range(100)]
    far = base[:80] + ["x%d" % i for i in range(20)]
    rows = [(i, " ".join(base[:-1] + ["e%d" % i])) for i in range(30)] + [(100 + i, " ".join(far[:-1] + ["f%d" % i])) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members, _ = neardup.near_duplicates(docs)
    assert {r.doc_id: r.class_id for r in members.collect()} == brute(rows)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    elems = rng.integers(0, 2**63, 300).astype(np.uint64)
    wa, wb = rng.integers(1, 40, 300), rng.integers(1, 40, 300)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    sig = neardup.bag_signatures([(elems, wa), (elems, wb)], 4096)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04
    # a bag's signature does not depend on its neighbours
    assert (neardup.bag_signatures([(elems, wb)], 4096)[0] == sig[1]).all()


def test_awkward_rows(odd, none):
    members, links = neardup.near_duplicates(odd)
    rows = members.collect()
    assert len(rows) == odd.count() and links.count() == 0
    of = {r.doc_id: r.class_id for r in rows}
    assert of[8] == 1 and of[1] == 1 and of[3] == of[5] == of[2] == 2 and of[None] is None
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 4, 6, 7, 2**62]
    assert kept.where("doc_id IS NULL").count() == 1
    assert neardup.drop_near_duplicates(none).collect() == [] and neardup.near_duplicates(none)[0].collect() == []


def test_repeated_ids_with_other_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "h i j k l m n"), (0, "a b c d e f g"), (1, "h i j k l m n")],
                                 "doc_id long, text string")
    assert sorted(map(tuple, neardup.drop_near_duplicates(docs).collect())) == [(0, "a b c d e f g"), (1, "h i j k l m n")]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_second_meeting_loses_no_pair(spark):
    # 300 pairs of similarity 0.80 to 0.82 on one template: all meet in one crowd, none is linked before
    rng = np.random.default_rng(7)
    new = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    template, bags = new(60), []
    for i in range(300):
        n = int(rng.integers(100, 400))
        own, other = new(n - 60 if n % 2 else n), round(n * (0.25 - 0.014 * rng.random()) / 2)
        shared = np.concatenate((template, own)) if n % 2 else own
        bags += [np.sort(np.concatenate((shared, new(other)))), np.sort(np.concatenate((shared, new(other))))]
    alike = [len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for x, y in zip(bags[::2], bags[1::2])]
    want = {(2 * i, 2 * i + 1) for i, s in enumerate(alike) if s >= 0.8}
    assert len(want) > 250 and max(alike) < 0.83
    df = spark.createDataFrame([(i, bytearray(b.tobytes())) for i, b in enumerate(bags)], "node long, bag binary")
    links = spark.createDataFrame([], "a long, b long, similarity double")
    links, comps = neardup._second_meeting(df, links, connected_components(links), 0.8)
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in links.collect()} == want
    assert {r.node: r.comp for r in comps.collect()} == {x: min(p) for p in want for x in p}
    # the share of these pairs that has a common element in the prefixes does not depend on the order
    for often in (np.zeros(neardup.COUNTERS, np.int64), rng.integers(0, 9, neardup.COUNTERS)):
        keys = [set(neardup.prefix(b, often, 0.8).tolist()) for b in bags]
        assert all(keys[a] & keys[b] for a, b in want)


def test_link_column_says_what_it_counts(spark):
    from tidemark.llm.queries import op9_near_duplicates

    assert op9_near_duplicates(spark, "/root/testdata/sf0.001").columns == ["doc_id", "class_id", "class_size", "n_joining_links"]


def test_signatures_do_not_depend_on_the_bags_beside_them(monkeypatch):
    import pyarrow as pa
    texts = [" ".join(f"w{(i * j) % (i + 7)}" for j in range(5 + i * 3)) for i in range(60)]
    batch = pa.record_batch([pa.array(range(60), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(neardup, "SIGN_ELEMENTS", 1 << 40)
    at_once = next(neardup._sign(32, 6, 5)(iter([batch])))
    monkeypatch.setattr(neardup, "SIGN_ELEMENTS", 100)
    sizes, sign = [], neardup.bag_signatures
    monkeypatch.setattr(neardup, "bag_signatures", lambda bags, m: sizes.append(sum(len(e) for e, _ in bags)) or sign(bags, m))
    assert next(neardup._sign(32, 6, 5)(iter([batch]))).equals(at_once)
    assert len(sizes) > 10 and max(sizes) < 100 + 190


def test_a_worker_lets_go_of_the_vocabularies_of_other_operators():
    import pyarrow as pa
    from tidemark.llm import bpe
    bpe.encoder(bpe.Encoder, bpe.default_path())
    assert bpe.vocabulary.cache_info().currsize
    list(neardup._sign(32, 6, 5)(iter([pa.record_batch([pa.array([1], pa.int64()), pa.array(["a b"])], ["doc_id", "text"])])))
    assert not bpe.vocabulary.cache_info().currsize and not bpe.encoder.cache_info().currsize
