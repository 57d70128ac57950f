"""Inputs that Spark derives from the given tables.

Each is one SQL text for Spark and DuckDB; only the function that turns text
into bytes differs.
"""

from __future__ import annotations

from workload.models import LABELS, OTHER_LABEL, OTHER_VERDICT, VERDICTS

SPARK_BYTES = "encode(text, 'UTF-8')"
DUCK_BYTES = "encode(text)"


def payloads(to_bytes: str) -> str:
    """Documents as images: a header by ``doc_id % 6``, then the whole text.

    PNG, JPEG, GIF, BMP, no image, empty.
    """
    return f"""
SELECT doc_id, CAST(doc_id AS STRING) AS id, source || '/' || lang AS file_path, w, h, doc_id % 6 AS kind,
  CASE WHEN doc_id % 6 = 5 THEN unhex('') ELSE unhex(CASE doc_id % 6
    WHEN 0 THEN '89504E470D0A1A0A0000000D49484452' || wb4 || hb4 || '0802000000'
    WHEN 1 THEN 'FFD8FFE0000400AAFFC0001108' || hb2 || wb2 || '03'
    WHEN 2 THEN '474946383961' || wl2 || hl2
    WHEN 3 THEN '424D' || repeat('00', 12) || '28000000' || wl2 || '0000' || hl2 || '0000'
    ELSE '68656C6C6F' END) || {to_bytes} END AS data
FROM (SELECT *,
    lpad(hex(w), 8, '0') AS wb4, lpad(hex(h), 8, '0') AS hb4,
    lpad(hex(w), 4, '0') AS wb2, lpad(hex(h), 4, '0') AS hb2,
    lpad(hex(w % 256), 2, '0') || lpad(hex(CAST(floor(w / 256) AS BIGINT)), 2, '0') AS wl2,
    lpad(hex(h % 256), 2, '0') || lpad(hex(CAST(floor(h / 256) AS BIGINT)), 2, '0') AS hl2
  FROM (SELECT *, 16 + doc_id % 1000 AS w, 16 + (doc_id * 7) % 500 AS h FROM documents) AS sized) AS coded"""


# Free-text verdicts; some carry the whole document.
VERDICT_ANSWERS = """
SELECT CAST(doc_id AS STRING) AS id,
  CASE doc_id % 10 WHEN 0 THEN 'YES' WHEN 1 THEN ' yes. ' || text WHEN 2 THEN 'NO'
    WHEN 3 THEN chr(10) || 'Yes, ' || text || chr(10) WHEN 4 THEN 'no, ' || text
    WHEN 5 THEN 'The answer is YES' WHEN 6 THEN 'YESTERDAY' WHEN 7 THEN ''
    WHEN 8 THEN '**YES** ' || text ELSE 'Y' END AS answer
FROM documents"""

_JSON_TEXT = "replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n')"

# Label answers; the description is the whole document.
LABEL_ANSWERS = f"""
SELECT CAST(doc_id AS STRING) AS id, CASE doc_id % 12
 WHEN 0 THEN '{{"category":"scenic","subcategory":"beach","description":"' || body || '","landmark":null,"city":"Nice","mood":"serene","is_professional":true,"has_text_overlay":false}}'
 WHEN 1 THEN '```json' || chr(10) || '{{"category":"food","subcategory":"street_food","description":"' || body || '","mood":"warm","is_professional":"Yes","has_text_overlay":"0"}}' || chr(10) || '```'
 WHEN 2 THEN 'Here you go: {{"category":"hotel","city":"Rome","description":"' || body || '","mood":"luxurious","is_professional":"TRUE"}} hope it helps'
 WHEN 3 THEN 'I cannot label this. ' || replace(replace(text, chr(123), '('), chr(125), ')')
 WHEN 4 THEN '{{"category":"museum","description":"' || body || '","mood":"gloomy","is_professional":false,"has_text_overlay":"1"}}'
 WHEN 5 THEN '{{"category": broken, ' || text || '}}'
 WHEN 6 THEN '[{{"category":"food","description":"' || body || '"}}'
 WHEN 7 THEN '[1,2]'
 WHEN 8 THEN '{{"category":"people","description":"' || body || '"}} {{"category":"food"}}'
 WHEN 9 THEN '```JSON {{"category":"transport","description":"' || body || '","mood":"cool"}}```'
 WHEN 10 THEN '{{}}'
 ELSE '"' || body || '"' END AS answer
FROM (SELECT *, {_JSON_TEXT} AS body FROM documents) AS escaped"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def answers_case(answers: dict[str, str], other: str, digit: str) -> str:
    """What the stand-in model answers, as SQL."""
    cases = " ".join(f"WHEN '{key}' THEN {_quoted(text)}" for key, text in answers.items())
    return f"CASE {digit} {cases} ELSE {_quoted(other)} END"


VERDICT_OF_DIGIT = answers_case(VERDICTS, OTHER_VERDICT, "digit")
LABEL_OF_DIGIT = answers_case(LABELS, OTHER_LABEL, "digit")

# File names as an exchange folder would hold them, one per document.
FILE_NAMES = """
SELECT 'data/' || lang || '/' || source || '/part-' || CAST(doc_id AS STRING)
    || CASE WHEN n_chars % 3 = 0 THEN '.json' ELSE '.parquet' END AS rel_path,
  n_chars AS length
FROM documents"""
