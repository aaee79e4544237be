"""DuckDB SQL for the queries whose results SQL can express over whole tables. The others are held against
the tokenizers library, brute force or held-out labels in the tests."""

from __future__ import annotations

from .chat import _MARKS

_PART = "lpad(upper(to_base(('0x' || substr(h, {at}, 10))::BIGINT, 32)), 8, '0')"
_BASE32 = "translate({}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')".format(
    " || ".join(_PART.format(at=k) for k in (1, 11, 21, 31)))

_SAID = "</s>[INST] ok [/INST]"
_MARKED = "length(regexp_extract_all({}, '" + _MARKS.pattern + "'))"

ORACLE: dict[str, str] = {
    "op1_warc_segments": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d""",
    "op10_chat_templates": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{_SAID}' UNION ALL SELECT -7, 1, 'assistant', '{_SAID}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(text) + {_MARKED.format('text')}
                + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
                  ELSE 25 + length(role) + {_MARKED.format('role')} END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
}
