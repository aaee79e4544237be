"""WARC (op 1), chat templates (op 10), the queries' SQL and the pipeline."""
import base64
import hashlib
import os
import random
import sys

import pytest
from conftest import SF001

from tidemark.llm import chat, warc

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))
MARK = "\r\n\r\nWARC/1.1\r\n"


def test_chunks():
    random.seed(1)
    for n in (0, 1, 9, 200, 70000):
        p = bytes(random.choices(b"ab\r\nWARC/1.", k=n)) + MARK.encode() * (n % 3)
        coded = warc.encode_chunks(p, 64)
        assert warc.decode_chunks(coded) == p and warc.VERSION not in coded
    assert warc.decode_chunks(b"5;x=y\r\nhello\r\n0\r\nTrailer: 1\r\n\r\n") == b"hello"
    assert warc.decode_chunks(b"zz\r\n") is None and warc.decode_chunks(b"5\r\nhel") is None


@pytest.mark.parametrize("segment", [50, 8192])
def test_warc_round_trip(spark, tmp_path, segment):
    html = ["x" * 100, MARK + "é" + MARK, None, "", "x" * 100, "\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "0\r\n\r\n", "ab" * 9000]
    rows = [(i, "http://a/\r\nb c" if i % 2 else None, h) for i, h in enumerate(html)] + [(4, None, "x" * 100), (None, "u", "y"), (9, "u", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS sha", "3 AS last")
    to = str(tmp_path / "w")
    warc.write(pages, to, segment_bytes=segment)
    got = warc.pages_of(warc.reassemble(warc.read_records(spark, to))).collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        first = last[h or ""] == i
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first else "revisit", None if first else last[h or ""]))
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    assert all(r.digest_ok for r in got)
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} == {h or "" for _, _, h in rows}


def test_broken_segments_are_told(spark):
    rec = lambda fields, block: warc._record(fields, block)
    parts = [rec([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("WARC-Segment-Number", "1")], b"HTTP/1.1 200 OK\r\n\r\nab"),
             rec([("WARC-Type", "continuation"), ("WARC-Record-ID", "<a2>"), ("WARC-Segment-Origin-ID", "<a>"),
                  ("WARC-Segment-Number", "3"), ("WARC-Segment-Total-Length", "23")], b"cd")]
    to = os.path.join(str(spark.sparkContext.getCheckpointDir()).removeprefix("file:"), "broken")
    spark.createDataFrame([(p.decode(),) for p in parts], "value string").write.mode("overwrite").option("lineSep", warc.END).text(to)
    row, = warc.pages_of(warc.reassemble(warc.read_records(spark, to))).collect()
    assert not row.digest_ok and bytes(row.payload) == b"abcd"


def test_empty_archive(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none).collect() == []


def test_templates():
    t = chat.Template("{% for m in messages %}{% if 1 == 2 %}no{% endif %}{{ 'a' ~ 'b' | upper }}{{ loop.index0 }}:{{ m.text | trim }};{% endfor %}end")
    assert t.tree[0][3][0] == ("text", "aB") and t.per_message is None  # constants are folded, loop needs the whole
    assert t.render([{"text": " x "}, {"text": None}])[0] == "aB0:x;aB1:;end"
    t = chat.Template("{% set k = 2 %}{% if k > 1 and not (k in messages) %}{% generation %}é{% endgeneration %}!{% endif %}")
    assert t.render([]) == ("é!", [(0, 1)])
    for bad in ("{% for %}", "{{ a( }}", "{% if x %}", "{{ x | nothing }}", "{% import os %}", "{{ 'a }}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)
    # a dot reads keys and nothing else
    assert chat.Template("{{ messages.__class__ }}{{ 'a'.upper }}").render([])[0] == ""


def test_escapes_are_reversible():
    random.seed(1)
    bits = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "<<", "SYS>>", "a", " ", *chat.CONTROL]
    t = chat.Template(chat.DEFAULT)
    for _ in range(5000):
        x, r = "".join(random.choices(bits, k=random.randint(0, 8))), random.choice(["user", "assistant", "system", "a<<TEXT>>", ""])
        assert chat.unescape(chat.escape(x)) == x and not any(c in chat.escape(x) for c in chat.CONTROL)
        text, spans = t.render([{"role": r, "text": x}, {"role": "user", "text": x}])
        assert chat.turns_of(text) == [(r, x), ("user", x)]
        assert [chat.unescape(text[a:b]) for a, b in spans] == ([x] if r == "assistant" else [])


def test_chat_rows(spark):
    said = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, None, None), (2, None, "user", ""), (2, 0, "assistant", "</s>")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").selectExpr("*", "0 AS part", "1 AS loss")
    got = {r.conv_id: r for r in chat.round_trip(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\na\nassistant\nb\nassistant\nb\n") and got[1].loss_sha256 == sha("bb") and got[1].n_turns == 3
    assert got[None].turns_sha256 == sha("\n\n") and got[2].loss_chars == 4 and got[2].turns_sha256 == sha("user\n\nassistant\n</s>\n")
    assert chat.round_trip(df.limit(0)).collect() == []
    whole = {r.conv_id: r.formatted for r in chat.render(df, chat.DEFAULT).collect()}
    assert whole[1] == "[INST]a[/INST]<s>b</s><s>b</s>"


def test_oracles(spark):
    from oracle_check import compare, duck

    from tidemark.llm.oracles import ORACLE
    from tidemark.llm.queries import QUERIES

    con = duck(SF001)
    for name, sql in ORACLE.items():
        status, message = compare(spark, con, name, QUERIES[name], sql, SF001)
        assert status == "ok", message


def test_pipeline(spark):
    import corpus_pipeline
    from tidemark.llm import bpe, decontaminate, language, neardup, pii
    from tidemark.llm.common import table

    docs = table(spark, SF001, "documents")
    cols = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF001).cache()
        assert kept.columns == cols, name
    want = {r.doc_id for r in docs.collect()}
    want &= {r.doc_id for r in language.identify(docs).where("lang_pred <> 'und' AND score >= 0.4").collect()}
    one = docs.where(docs.doc_id.isin(sorted(want)))
    want &= {r.doc_id for r in neardup.near_duplicates(one)[0].where("is_first").collect()}
    want -= {r.doc_id for r in decontaminate.contaminated(docs, table(spark, SF001, "benchmark")).collect()}
    assert {r.doc_id for r in kept.collect()} == want
    assert not any(pii.base_spans(r.text) for r in kept.collect())
    out = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, out.select("doc_id", "n_tokens").collect())) == sorted(
        map(tuple, bpe.encode(kept).select("doc_id", "n_tokens").collect()))
