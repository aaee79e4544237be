"""Byte-level BPE (op 11) against the tiktoken library."""
import hashlib

import numpy as np
import public_tokenizers
import pytest
from awkward import none, odd, small  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe

PATH = byte_bpe.default_path()


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(PATH).ranks, special_tokens={})


def want(docs, library):
    out = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        out.append((r.doc_id is None, r.doc_id or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_words_equal_library(library):
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}\n{chr(c)} " for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    for t in texts:
        assert [i for w in byte_bpe.words_of(t) for i in library._encode_single_piece(w.encode())] == library.encode_ordinary(t), repr(t)


def test_near_pattern_equals_the_pattern():
    for c in range(0x250):
        for t in (f"x{chr(c)}", f"'{chr(c)}s", f" {chr(c)} {chr(c)}{chr(c)} ", f"1{chr(c)}2  {chr(c)}"):
            assert byte_bpe._NEAR.findall(t) == byte_bpe._pattern().findall(t)


def test_fold_equals_library(spark, library):
    words = ["x", " the", "ß", "漢字漢字", "🇩🇪🏽", "aaaaaaaaaaaaaaaaa", "=" * 97, "zq" * 700, "internationalizations", " ", "\n\n\n", "'s", "\x00\x01"]
    words += ["".join(np.random.default_rng(i).choice(list("etaoinshrdluéß "), 30)) for i in range(300)]
    df = spark.createDataFrame([(words,), ([],), (None,)], "w array<string>")
    a, b, c = [r.ids for r in df.select(byte_bpe.encode_words(F.col("w"), PATH).alias("ids")).collect()]
    assert a == [library._encode_single_piece(w.encode()) for w in words]
    assert b == [] and not c


@pytest.mark.parametrize("known", [400_000, 0])
def test_digests_equal_library(odd, small, library, monkeypatch, known):
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", known)
    for docs in (odd, small):
        assert got(byte_bpe.digests(docs)) == want(docs, library)


def test_round_trip(odd, library):
    coded = byte_bpe.encode(odd)
    texts = sorted((r.text or "").encode() for r in odd.collect())
    assert sorted(bytes(r.bytes) for r in byte_bpe.decode(coded).collect()) == texts
    assert sorted(list(r.ids) for r in coded.collect()) == sorted(library.encode_ordinary(t.decode()) for t in texts)


def test_empty_table(none):
    assert byte_bpe.digests(none).collect() == [] and byte_bpe.encode(none).collect() == []


def test_a_rare_word_is_folded_once_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 0)
    texts = [f"zqxvwjk{i % 40}zqx vwqkjzz{i}" for i in range(2500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = byte_bpe.default_path()
    sent = byte_bpe._broadcast_known(byte_bpe.doc_texts(docs), path)
    rows = byte_bpe._coded(byte_bpe.doc_texts(docs), path, sent).select("held", F.size("rare_ids").alias("n")).collect()
    words = {w for t in texts for w in byte_bpe.words_of(t)} - set(byte_bpe.ranks(path).whole)
    assert len(rows) > 1 and sum(r["n"] for r in rows) == len(words)
    assert [r["held"] for r in rows] == [sum(r["n"] for r in rows[:k]) for k in range(len(rows))]
    got = {r["doc_id"]: r["bytes"].decode() for r in byte_bpe.decode(byte_bpe.encode(docs)).collect()}
    assert got == dict(enumerate(texts))


def rank_file(path, merges):
    """All bytes, then tokens in order."""
    import base64

    tokens = [bytes([i]) for i in range(256)] + merges
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    return str(path)


def fold(r, parts):
    """Plain merges of a list of tokens."""
    while True:
        rank, i = min(((r.ranks.get(a + b, r.size), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(r.size, 0))
        if rank == r.size:
            return parts
        parts = parts[:i] + [parts[i] + parts[i + 1]] + parts[i + 2:]


def begun(r, words):
    """Tokens of words after the certain merges."""
    return [[r.pieces[e % byte_bpe.BASE] for e in w] for w in byte_bpe.Certain(r, r.tables()).words(words).to_pylist()]


def test_certain_merges_are_those_of_the_whole_word(tmp_path):
    from itertools import product

    words = ["".join(w) for n in range(1, 8) for w in product("abc", repeat=n)]
    fewer = 0
    for seed in range(12):
        draw = np.random.default_rng(seed)
        tokens = [b"a", b"b", b"c"]
        while len(tokens) < 20:
            new = tokens[draw.integers(len(tokens))] + tokens[draw.integers(len(tokens))]
            r = byte_bpe.Ranks(rank_file(tmp_path / "ranks", tokens[3:]))
            if new not in tokens and len(r.merge(new)) == 2:
                tokens.append(new)
        r = byte_bpe.Ranks(rank_file(tmp_path / "ranks", tokens[3:]))
        parts = begun(r, words)
        assert [fold(r, p) for p in parts] == [r.merge(w.encode()) for w in words]
        fewer += sum(len(p) < len(w) for p, w in zip(parts, words))
    assert fewer > len(words)


def test_no_merge_is_certain_where_a_part_outranks_its_token(tmp_path):
    r = byte_bpe.Ranks(rank_file(tmp_path / "ranks", [b"abc", b"ab"]))
    assert begun(r, ["abab", "xabc"]) == [[b"a", b"b", b"a", b"b"], [b"x", b"a", b"b", b"c"]]


def test_most_merges_of_a_rare_word_are_made_before_the_fold(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CERTAIN_WORDS", 7)
    draw = np.random.default_rng(0)
    words = [" " + "".join(draw.choice(["tion", "er", "en", "keit", "ción", "éou", "ing", "the", "qu"], 4)) for _ in range(200)]
    words += ["x", "aaaaaaaaa", "漢字漢字", "🇩🇪🏽", "=" * 97, "zq" * 700, "\x00\x01", " "]
    entries = byte_bpe.certain(PATH).words(words).to_pylist()
    assert sum(map(len, entries[:200])) < 0.6 * sum(len(w.encode()) for w in words[:200])
    ids = byte_bpe.encode_entries(F.col("w"), PATH)
    df = spark.createDataFrame([(entries,), ([],)], "w array<array<long>>")
    assert [r.ids for r in df.select(ids.alias("ids")).collect()] == [[library._encode_single_piece(w.encode()) for w in words], []]
