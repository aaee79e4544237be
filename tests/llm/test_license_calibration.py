"""Licences (op 3): held-out notices calibrate the classifier; very long and repeated notices."""
from awkward import none, odd, small  # noqa: F401

from tidemark.llm import licenses

PROSE = [["the", "cat", "sat", "on", "the", "mat"], ["a", "free", "program", "for", "all"], ["any", "license", "may", "do"]]


def test_held_out_notices_are_whole():
    rows = licenses._training(PROSE)
    held = {tuple(w) for w, _, n in rows if licenses._held_out(n)}
    fitted = {tuple(w) for w, _, n in rows if not licenses._held_out(n)}
    assert held and not held & fitted
    assert {k for _, k, n in rows if licenses._held_out(n)} > {0}


def test_foreign_licences_are_not_certain():
    model = licenses.train(PROSE, 200)
    for text in ("GNU Affero General Public License version 3", "Licensed under the ISC License.", "Artistic License", "Eclipse Public License"):
        p = model.chances(licenses.words_of(text))
        assert p[1:].max() < 0.9, (text, licenses.FAMILIES[p.argmax()], p.max())
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            p = model.chances(licenses.words_of(t))
            assert licenses.FAMILIES[p.argmax()] == family and p.max() > 0.5, (t, p.max())


def test_long_and_repeated_notices(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    long = "\n".join(["alpha beta gamma delta"] * 30_000 + [mit] + ["alpha beta gamma delta"] * 30_000)
    docs = spark.createDataFrame([(1, long), (1, long), (2, "\n".join([mit] * 500)), (3, " ".join([mit] * 300)), (4, None)], "doc_id long, text string")
    rows = [r for r in licenses.find(docs).collect() if r.confirmed]
    assert {r.family for r in rows} == {"MIT"}
    assert sum(r.doc_id == 1 for r in rows) == 2 and sum(r.doc_id == 2 for r in rows) == 500
    assert sum(r.doc_id == 3 for r in rows) > 50
