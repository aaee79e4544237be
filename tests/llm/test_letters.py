"""Language (op 6): letters are those of Unicode category L, found fast."""
import time
import unicodedata

from tidemark.llm import language


def test_words_are_runs_of_letters():
    for c in range(0x30000):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        want = [w for w in "".join(x if unicodedata.category(x)[0] == "L" else " " for x in low).split(" ") if w]
        assert language.words_of(chr(c)) == want, hex(c)
    assert language.words_of("a½b ² ① Ⅷ x1y") == ["a", "b", "x", "y"]


def test_number_signs_alone_are_no_language(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(8)] + [(100, "½ ² ①", None), (101, "٣٤ 12", None), (102, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert got[100] == got[101] == "und" and got[102] == "en"
    assert {r.doc_id for r in language.keep_identified(docs).collect()} == set(range(8)) | {102}


def test_words_take_little_time():
    text = "une élève très âgée était là où ½ " * 60_000
    began = time.time()
    assert len(language.words_of(text)) == 7 * 60_000
    assert time.time() - began < 3
