"""Trie BPE (op 5) and the token store (op 7) against the tokenizers library."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from awkward import none, odd, small  # noqa: F401
from conftest import SF001

from tidemark.llm import bpe, token_store
from tidemark.llm.wordpieces import tokenizer, words_of

PATH = bpe.default_path()


def library(texts):
    return [e.ids for e in tokenizer(PATH).encode_batch_fast(texts, add_special_tokens=False)]


def awkward_texts():
    random.seed(3)
    signs = [chr(c) for c in range(1, 0x250)] + list("ΣςİıﬁẞЖ漢ไทย्한🇩🇪́̈̇ 　\x1c\x85²Ⅷ") + [" ", "'s", "'RE", " the", "<|endoftext|>", "<|end"]
    return ["".join(random.choices(signs, k=random.randint(0, 50))) for _ in range(3000)] + ["", " \n", "a" * 3000]


def test_encoders_equal_library_on_awkward_texts():
    texts = awkward_texts()
    words = [words_of(t, PATH) for t in texts]
    enc, store = bpe.Encoder(PATH), token_store._Ids(PATH, 2)
    enc.add(words)
    store.add(words)
    for ws, ids in zip(words, library(texts)):
        assert [i for w in ws for i in enc.held[w]] == ids
        assert b"".join(store[w] for w in ws) == np.array(ids, "<u2").tobytes()


def test_trie_shares_prefixes_and_equals_merges():
    v = bpe.vocabulary(PATH)
    words = ["internationalization", "internationally", "international", "inter", "in", "i"]
    for w, ids in zip(words, bpe.encode_words(v, words)):
        assert ids == v.merge([v.inner[c] for c in w[:-1]] + [v.final[w[-1]]])


def test_digests_and_round_trip(spark, odd, small):
    for docs in (odd, small):
        tok = tokenizer(PATH)
        want = sorted((r.doc_id is None, r.doc_id or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
                      for r in docs.collect() for ids in [library([r.text or ""])[0]])
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect())
        assert got == want
    coded = bpe.encode(odd)
    back = sorted((r.doc_id or 0, r.text) for r in bpe.decode(coded).collect())
    assert back == sorted((r.doc_id or 0, tokenizer(PATH).decode(r.ids, skip_special_tokens=False)) for r in coded.collect())


def test_empty_tables(none):
    assert bpe.digests(none).collect() == [] and bpe.encode(none).collect() == []
    assert token_store.store_and_read(none).collect() == []


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(2).integers(-2**62, 2**62, 5000))
    seeds, slots = token_store.build_hash(keys)
    assert sorted(slots) == list(range(len(keys)))
    prints = np.zeros(len(keys), np.uint32)
    prints[slots] = token_store.fingerprints(keys)
    assert (token_store.find_slots(keys, seeds, prints) == slots).all()
    assert (token_store.find_slots(keys + 1, seeds, prints) < 0).mean() > 0.99


def store_rows(docs):
    start, out = 0, []
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in docs.collect())
    for (known, key), text in rows:
        ids = library([text])[0] + [1]
        out.append((key if known else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store_equals_library(spark, odd, small):
    assert sorted(map(tuple, token_store.store_and_read(small).collect())) == store_rows(small)
    # the rows of odd that share a doc_id are equal, so their order does not show
    got = [tuple(r) for r in token_store.store_and_read(odd).collect()]
    assert sorted(got, key=lambda r: r[1]) == store_rows(odd)


def test_lookup_of_keys(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_DOCS", 16)
    to = str(tmp_path / "store")
    token_store.write(small, to, partitions=3)
    keys = spark.createDataFrame([(5,), (17,), (17,), (10**9,), (None,)], "doc_id long")
    texts = {r.doc_id: r.text for r in small.collect()}
    got = {r.doc_id: list(r.ids) for r in token_store.lookup(keys, to).collect()}
    assert got == {k: library([texts[k]])[0] + [1] for k in (5, 17)}


def test_lookup_in_blocks_of_bounds(spark, odd, small, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_DOCS", 8)
    monkeypatch.setattr(token_store, "LOOKUP_SHARDS", 3)
    docs = small.select("doc_id", "text").union(odd.select("doc_id", "text"))
    to = str(tmp_path / "store")
    token_store.write(docs, to, partitions=4)
    got = sorted(((r.doc_id, list(r.ids)) for r in token_store.lookup(docs.select("doc_id"), to).collect()), key=str)
    want = sorted(((-(2**63) if r.doc_id is None else r.doc_id, library([r.text or ""])[0] + [1]) for r in docs.collect()), key=str)
    assert got == want


def test_queries_run(spark):
    from tidemark.llm.queries import QUERIES

    for name in ("op5_trie_bpe", "op7_token_store"):
        assert QUERIES[name](spark, SF001).count() == 200


@pytest.mark.parametrize("text", ["İ्", "ǅǅ Ə"])
def test_normalised_once(text):
    enc = token_store._Ids(PATH, 2)
    words = words_of(text, PATH)
    enc.add([words])
    assert b"".join(enc[w] for w in words) == np.array(library([text])[0], "<u2").tobytes()


def test_words_not_met_again_are_let_go(monkeypatch):
    coded, encode = [], bpe.encode_words
    monkeypatch.setattr(bpe, "HELD_WORDS", 50)
    monkeypatch.setattr(bpe, "encode_words", lambda v, words: coded.extend(words) or encode(v, words))
    enc = bpe.Encoder(PATH)
    for k in range(100):
        ws = ["common", *(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x{chr(97 + j)}" for j in range(10))]
        enc.add([ws])
        assert [list(enc.held[w]) for w in ws] == library(ws)
        enc.trim()
        assert len(enc.held) + len(enc.before) <= 2 * (50 + 11)
    assert coded.count("common") == 1 and len(coded) == 1001


def test_texts_are_cut_into_words_in_parts(monkeypatch):
    import pyarrow as pa
    sizes, add = [], bpe.Encoder.add
    monkeypatch.setattr(bpe.Encoder, "add", lambda self, words: sizes.append(sum(len(w) for ws in words for w in ws)) or add(self, words))
    monkeypatch.setattr(bpe, "doc_texts", lambda docs: type("Docs", (), {"mapInArrow": staticmethod(lambda run, schema: run)}))
    texts = [f"text {i} " * 400 for i in range(900)] + ["", " "]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    got = pa.Table.from_batches(bpe.encode(None)(iter([batch])))
    assert max(sizes) <= 1_000_000 and len(sizes) > 3
    assert got["doc_id"].to_pylist() == list(range(len(texts)))
    want = library(texts)
    assert got["ids"].to_pylist() == want and got["n_tokens"].to_pylist() == list(map(len, want))
    assert got.schema.field("ids").type == pa.list_(pa.int32())
