"""The same results as plain SQL, for an independent engine."""

from __future__ import annotations

from workload import fixtures as X
from workload.queries import BATCH_SIZE, FIRST_RUN_BATCHES, ROWS_PER_SHARD

ORACLES: dict[str, str] = {}

_PAYLOADS = X.payloads(X.DUCK_BYTES)
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UNICODE_WS = " || ".join(f"chr({ord(c)})" for c in map(chr, range(0x3001)) if c.isspace())

# ---- scans ----

ORACLES["scan_raw"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS payload_md5,
  row_number() OVER (ORDER BY doc_id) - 1 AS src_row, 'documents.parquet' AS file_name
FROM documents"""

ORACLES["extract_bytes"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS plain_md5,
  CASE n_chars % 3 WHEN 0 THEN md5(lang) WHEN 1 THEN md5('') ELSE md5(text) END AS both_md5,
  md5(text) AS data_only_md5,
  md5(unhex(lpad(hex(doc_id % 128), 2, '0') || lpad(hex(255 - n_chars % 100), 2, '0') || '00')) AS small_md5,
  CAST(NULL AS VARCHAR) AS characters_md5
FROM documents"""

ORACLES["extract_bytes_floats"] = "SELECT vec_id, true AS no_payload FROM embeddings"

ORACLES["read_pushdown"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE (l_quantity > 30 AND l_returnflag = 'R') OR l_discount >= 0.09"""

# ---- the stage table ----


def _verdict(answer: str) -> str:
    return f"CASE WHEN starts_with(upper(trim({answer}, {_WS})), 'YES') THEN 'YES' ELSE 'NO' END"


_FORMAT = "CASE kind WHEN 0 THEN 'PNG' WHEN 1 THEN 'JPEG' WHEN 2 THEN 'GIF' WHEN 3 THEN 'BMP' END"

_STAGE = f"""
SELECT id, id AS file_name, file_path, data,
  {_FORMAT} AS image_format,
  CAST(CASE WHEN kind < 4 THEN w END AS INTEGER) AS width,
  CAST(CASE WHEN kind < 4 THEN h END AS INTEGER) AS height,
  {_verdict(X.VERDICT_OF_DIGIT)} AS filter_result
FROM (SELECT *, substr(md5(data), 1, 1) AS digit FROM ({_PAYLOADS}) AS p) AS q"""

_KEPT_MD5 = "CASE WHEN filter_result = 'YES' THEN md5(data) END"

ORACLES["read_stage_yes"] = f"""
SELECT id, filter_result, md5(data) AS image_md5 FROM ({_STAGE}) AS s WHERE filter_result = 'YES'"""

ORACLES["read_stage_all"] = f"SELECT id, filter_result, {_KEPT_MD5} AS image_md5 FROM ({_STAGE}) AS s"

ORACLES["filter_output"] = f"""
SELECT id, file_name, file_path, {_KEPT_MD5} AS image_bytes, image_format, width, height, filter_result,
  CAST(NULL AS VARCHAR) AS error
FROM ({_STAGE}) AS s"""

ORACLES["verdict_routing"] = f"""
SELECT id, CASE filter_result WHEN 'YES' THEN 'kept' ELSE 'rejected' END AS route,
  filter_result = 'YES' AS has_bytes
FROM ({_STAGE}) AS s"""

ORACLES["image_metadata"] = f"""
SELECT id, width, height, image_format, image_format IS NOT NULL AS decodable FROM ({_STAGE}) AS s"""

ORACLES["image_metadata_one_format"] = f"""
SELECT id, CASE WHEN image_format IS NOT NULL THEN 'JPEG' END AS image_format FROM ({_STAGE}) AS s"""

ORACLES["image_inventory"] = f"""
SELECT image_format, count(*) AS rows, count(*) FILTER (image_format IS NULL) AS undecodable,
  count(*) FILTER (octet_length(data) = 0) AS without_bytes,
  min(octet_length(data)) AS min_bytes, max(octet_length(data)) AS max_bytes,
  round(avg(octet_length(data)), 3) AS avg_bytes
FROM ({_STAGE}) AS s GROUP BY image_format"""

_PAYLOAD_ERROR = """CASE WHEN octet_length(data) = 0 THEN 'no image data for id=' || id
    WHEN image_format IS NULL THEN 'undecodable image data for id=' || id END"""

ORACLES["unusable_payload"] = f"""
SELECT id, {_PAYLOAD_ERROR} AS error FROM ({_STAGE}) AS s WHERE image_format IS NULL"""

ORACLES["normalize_input"] = f"""
SELECT id, id AS file_name, file_path, md5(data) AS image_md5 FROM ({_PAYLOADS}) AS p"""

ORACLES["conform"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(NULL AS DOUBLE) AS score, CAST(n_chars AS INTEGER) AS n_chars, lang
FROM documents"""

ORACLES["build_request"] = f"""
SELECT CAST(d.doc_id AS VARCHAR) AS id, 'system,user' AS roles, 'You judge.' AS system_text,
  'image,text,text' || CASE WHEN lang = 'de' THEN '' ELSE ',text' END AS part_types,
  md5(CASE WHEN lang = 'de' THEN '' ELSE lang || '|' END || text || '|Keep it?') AS texts_md5,
  md5(data) AS image_md5
FROM documents AS d JOIN ({_PAYLOADS}) AS p ON d.doc_id = p.doc_id"""

# ---- files ----

_DOC_SHARDS = f"""
SELECT doc_id, text, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {ROWS_PER_SHARD}) + 1 AS BIGINT) AS shard
FROM documents"""

ORACLES["file_manifest"] = f"""
SELECT DISTINCT 'shard=' || lpad(CAST(shard AS VARCHAR), 5, '0') AS shard_dir, true AS has_bytes
FROM ({_DOC_SHARDS}) AS s"""

ORACLES["publish_manifest"] = f"SELECT DISTINCT shard FROM ({_DOC_SHARDS}) AS s WHERE shard <> 1"

ORACLES["shard_report"] = f"SELECT shard, count(*) AS rows FROM ({_DOC_SHARDS}) AS s GROUP BY shard"

ORACLES["merge_shards"] = "SELECT doc_id, md5(text) AS text_md5 FROM documents"
ORACLES["write_roundtrip"] = ORACLES["merge_shards"]

ORACLES["write_shards"] = f"""
SELECT doc_id, md5(text) AS text_md5, shard FROM ({_DOC_SHARDS}) AS s
UNION ALL
SELECT doc_id, md5(text), shard + (SELECT max(shard) FROM ({_DOC_SHARDS}) AS m) FROM ({_DOC_SHARDS}) AS s"""

ORACLES["select_files"] = f"""
SELECT substr(rel_path, length('data/en/') + 1) AS rel_path, length FROM ({X.FILE_NAMES}) AS f
WHERE rel_path LIKE 'data/en/%' AND rel_path NOT LIKE '%-1%.parquet' AND rel_path LIKE '%.parquet'"""

ORACLES["load_selected"] = f"SELECT doc_id, md5(text) AS text_md5, shard FROM ({_DOC_SHARDS}) AS s WHERE shard % 2 = 0"

ORACLES["append_table"] = """
SELECT doc_id, lang, CAST(NULL AS INTEGER) AS quality FROM documents
UNION ALL
SELECT doc_id, NULL, quality FROM labels"""

ORACLES["union_by_name"] = """
SELECT doc_id, lang FROM documents
UNION ALL BY NAME SELECT * FROM labels
UNION ALL BY NAME SELECT lang FROM documents"""

# ---- text and JSON ----

ORACLES["py_strip"] = f"""
SELECT doc_id, md5(trim(decode(unhex('C2A0E2808320091C1F0A')) || text || decode(unhex('C285E38080E280A80D')),
  {_UNICODE_WS})) AS stripped_md5
FROM documents"""

ORACLES["parse_verdict"] = f"""
SELECT id, starts_with(upper(trim(answer, {_WS})), 'YES') AS keep FROM ({X.VERDICT_ANSWERS}) AS v"""


# White space that a fence may have next to it (a regex's \\s), and the fence itself.
_FENCE_WS = "' ' || chr(9) || chr(10) || chr(12) || chr(13)"
_FENCE = "'```'"


def _parsed(answers: str) -> str:
    """Answers with the cleaned text, the embedded fragment and the JSON that counts.

    The fence and its tag come off by position (starts_with, ends_with, substr);
    the fragment runs from the first opening to the last closing brace, found
    with instr and with the text after the last closing brace.
    """
    opened = f"""CASE WHEN starts_with(t, {_FENCE}) THEN ltrim(CASE WHEN lower(substr(t, 4, 4)) = 'json'
        THEN substr(t, 8) ELSE substr(t, 4) END, {_FENCE_WS}) ELSE t END"""
    closed = f"CASE WHEN ends_with(o, {_FENCE}) THEN rtrim(substr(o, 1, length(o) - 3), {_FENCE_WS}) ELSE o END"
    return f"""
SELECT *, CASE WHEN json_valid(cleaned) THEN cleaned
    WHEN fragment <> '' AND json_valid(fragment) THEN fragment END AS data
FROM (SELECT * EXCLUDE (first_open, closes, last_close), CASE WHEN first_open > 0 AND closes > 1 AND last_close > first_open
        THEN substr(cleaned, first_open, last_close - first_open + 1) ELSE '' END AS fragment
  FROM (SELECT *, instr(cleaned, '{{') AS first_open, len(string_split(cleaned, '}}')) AS closes,
          length(cleaned) - length(string_split(cleaned, '}}')[-1]) AS last_close
    FROM (SELECT * EXCLUDE (t, o), trim({closed}, {_WS}) AS cleaned
      FROM (SELECT *, {opened} AS o
        FROM (SELECT *, trim(answer, {_WS}) AS t FROM ({answers}) AS a) AS a1) AS a2) AS b) AS b2) AS c"""


def _text(name: str) -> str:
    return f"CASE WHEN json_type(data) = 'OBJECT' THEN data::JSON ->> '{name}' END AS {name}"


def _flag(name: str) -> str:
    return f"""CASE WHEN json_type(data) = 'OBJECT' THEN CASE json_type(data, '$.{name}')
    WHEN 'BOOLEAN' THEN (data::JSON ->> '{name}') = 'true'
    WHEN 'VARCHAR' THEN lower(data::JSON ->> '{name}') IN ('true', 'yes', '1') END END AS {name}"""


_ERROR = """CASE WHEN data IS NOT NULL THEN NULL
    WHEN fragment = '' THEN 'No JSON object found: ' || left(answer, 200)
    ELSE 'JSONDecodeError: ' || left(answer, 200) END"""

_FIELDS = ", ".join(
    [_text(n) for n in ("category", "subcategory", "description", "landmark", "city", "mood")]
    + [_flag(n) for n in ("is_professional", "has_text_overlay")]
)


def _flat(answers: str) -> str:
    return f"""
SELECT *, {_FIELDS}, {_ERROR} AS error,
  CASE WHEN data IS NOT NULL THEN answer END AS label_json,
  data IS NOT NULL AND json_type(data) <> 'OBJECT' AS rejected
FROM ({_parsed(answers)}) AS d"""


_LABELS = _flat(X.LABEL_ANSWERS)

ORACLES["strip_fences"] = f"SELECT id, md5(cleaned) AS cleaned_md5 FROM ({_LABELS}) AS l"

ORACLES["strict_json"] = f"""
SELECT id, json_valid(cleaned) AS is_json,
  CASE WHEN json_valid(cleaned) AND json_type(cleaned) = 'OBJECT' THEN cleaned::JSON ->> 'category' END AS category
FROM ({_LABELS}) AS l"""

ORACLES["json_fallback"] = f"""
SELECT id, md5(fragment) AS fragment_md5, data IS NOT NULL AND NOT json_valid(cleaned) AS rescued
FROM ({_LABELS}) AS l"""

ORACLES["label_errors"] = f"SELECT id, error FROM ({_LABELS}) AS l WHERE error IS NOT NULL"

ORACLES["label_non_object"] = f"SELECT id, 'label_not_an_object' AS rejected FROM ({_LABELS}) AS l WHERE rejected"

ORACLES["flatten_label"] = f"""
SELECT id, category, subcategory, md5(description) AS description_md5, landmark, city, mood,
  is_professional, has_text_overlay, md5(answer) AS label_json_md5
FROM ({_LABELS}) AS l WHERE json_type(data) = 'OBJECT'"""

_CATEGORIES = "'scenic', 'food', 'hotel', 'people', 'itinerary', 'template', 'pricing', 'lifestyle', 'shopping', 'transport'"
_MOODS = "'warm', 'cool', 'vibrant', 'serene', 'adventurous', 'luxurious', 'casual', 'romantic'"
_KNOWN = f"coalesce(category IN ({_CATEGORIES}), false) AS category_known, coalesce(mood IN ({_MOODS}), false) AS mood_known"

ORACLES["vocab_flags"] = f"SELECT id, category, mood, {_KNOWN} FROM ({_LABELS}) AS l"

_LABEL_COLUMNS = """category, subcategory, description, landmark, city, mood, is_professional, has_text_overlay"""

ORACLES["label_output"] = f"""
SELECT id, file_name, file_path, {_KEPT_MD5} AS image_bytes, image_format, width, height, filter_result,
  md5(label_json) AS label_json, category, subcategory, md5(description) AS description, landmark, city, mood,
  is_professional, has_text_overlay, error
FROM ({_STAGE}) AS s JOIN (SELECT id, label_json, {_LABEL_COLUMNS}, error FROM ({_LABELS}) AS l WHERE NOT rejected) AS f
USING (id)"""

# ---- resume and positions ----

_PENDING = "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
_PENDING_POS = f"SELECT *, row_number() OVER (ORDER BY doc_id) AS pos FROM ({_PENDING}) AS p"

ORACLES["resume_anti_join"] = f"SELECT doc_id, md5(text) AS text_md5 FROM ({_PENDING}) AS p"

ORACLES["capped_intake"] = f"""
SELECT doc_id, md5(text) AS text_md5 FROM ({_PENDING_POS}) AS p WHERE pos <= {BATCH_SIZE * FIRST_RUN_BATCHES}"""

ORACLES["batch_index"] = f"""
SELECT doc_id, pos, CAST(ceil(pos / {BATCH_SIZE}) AS BIGINT) AS batch FROM ({_PENDING_POS}) AS p"""

ORACLES["scan_position"] = """
SELECT l_orderkey, l_linenumber, src_row, row_number() OVER (ORDER BY src_row) AS pos
FROM (SELECT *, row_number() OVER () - 1 AS src_row FROM lineitem) AS l WHERE l_quantity > 10"""

ORACLES["shard_assignment"] = f"""
SELECT doc_id, shard, 'shard-' || lpad(CAST(shard AS VARCHAR), 5, '0') AS shard_name
FROM (SELECT doc_id, CAST(5 + floor((pos - 1) / {ROWS_PER_SHARD}) AS BIGINT) AS shard FROM ({_PENDING_POS}) AS p) AS s"""

# ---- model ----

_ASKED = "CASE WHEN length(text) % 2 = 0 THEN 'YES' ELSE 'no' END"

ORACLES["infer_stub"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS id, {_ASKED} AS answer, CAST(NULL AS VARCHAR) AS model_error,
  CAST(1 AS INTEGER) AS attempts
FROM documents"""

ORACLES["infer_errors"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS id,
  CASE WHEN length(text) % 7 = 0 OR length(text) % 11 = 0 THEN NULL ELSE {_ASKED} END AS answer,
  CASE WHEN length(text) % 7 = 0 THEN 'cannot read ' || CAST(length(text) AS VARCHAR) || ' characters'
    WHEN length(text) % 11 = 0 THEN 'generation failed after 3 attempts' END AS model_error,
  CAST(CASE WHEN length(text) % 7 <> 0 AND length(text) % 11 = 0 THEN 3 ELSE 1 END AS INTEGER) AS attempts
FROM documents"""

# ---- jobs ----

# All rows with their outcome; usable rows have an image format.
_OUTCOMES = f"""
SELECT *, row_number() OVER (ORDER BY CAST(id AS BIGINT)) AS pos,
  CASE WHEN image_format IS NULL THEN 'error' WHEN filter_result = 'YES' THEN 'kept' ELSE 'skipped' END AS status
FROM ({_STAGE}) AS s"""

_FILTER_COLUMNS = f"""id, file_name, file_path, {_KEPT_MD5} AS image_md5, image_format, width, height, filter_result,
  CAST(NULL AS VARCHAR) AS error"""

ORACLES["job_incremental"] = f"SELECT {_FILTER_COLUMNS} FROM ({_STAGE}) AS s WHERE image_format IS NOT NULL"

ORACLES["job_filter"] = f"""
SELECT {_FILTER_COLUMNS},
  CAST(floor((row_number() OVER (ORDER BY CAST(id AS BIGINT)) - 1) / {ROWS_PER_SHARD}) + 1 AS BIGINT) AS shard
FROM ({_STAGE}) AS s WHERE image_format IS NOT NULL"""

_ASKED_LABELS = f"""
SELECT id, file_path, data AS image, image_format, filter_result, {X.LABEL_OF_DIGIT} AS answer
FROM (SELECT *, substr(md5(data), 2, 1) AS digit FROM ({_STAGE}) AS s) AS t WHERE image_format IS NOT NULL AND filter_result = 'YES'"""

_LABEL_ROWS = _flat(_ASKED_LABELS)

_JOB_LABEL = f"""
SELECT id, file_path, md5(image) AS image_md5, image_format, filter_result, label_json, {_LABEL_COLUMNS}, error"""

ORACLES["job_all_stages"] = f"{_JOB_LABEL} FROM ({_LABEL_ROWS}) AS l WHERE NOT rejected"

ORACLES["job_label"] = f"""{_JOB_LABEL},
  CAST(floor((row_number() OVER (ORDER BY CAST(id AS BIGINT)) - 1) / {ROWS_PER_SHARD}) + 1 AS BIGINT) AS shard
FROM ({_LABEL_ROWS}) AS l WHERE NOT rejected"""

_COUNTERS = """count(*) AS total, count(*) FILTER (status = 'kept') AS kept,
  count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'error') AS errors"""

ORACLES["run_stats_filter"] = f"SELECT {_COUNTERS} FROM ({_OUTCOMES}) AS o"

_LABEL_COUNTERS = """count(*) AS total, count(*) FILTER (NOT rejected) AS kept, CAST(0 AS BIGINT) AS skipped,
  count(*) FILTER (rejected) AS errors"""

ORACLES["run_stats_label"] = f"""
SELECT {_LABEL_COUNTERS}, count(*) FILTER (NOT rejected AND error IS NULL) AS labelled_ok FROM ({_LABEL_ROWS}) AS l"""

_RUN_OF_POS = f"CAST(CASE WHEN pos <= {BATCH_SIZE * FIRST_RUN_BATCHES} THEN 1 ELSE 2 END AS INTEGER)"

_RUNNING = ", ".join(
    f"CAST(sum({c}) OVER (PARTITION BY stage ORDER BY %s ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_{c}"
    for c in ("total", "kept", "skipped", "errors")
)

ORACLES["ledger_totals"] = f"""
SELECT stage, stage || '-' || lpad(CAST(run_seq AS VARCHAR), 6, '0') AS run_id, run_seq, total, kept, skipped, errors,
  {_RUNNING % (("run_seq",) * 4)}
FROM (
  SELECT 'filter' AS stage, {_RUN_OF_POS} AS run_seq, {_COUNTERS} FROM ({_OUTCOMES}) AS o GROUP BY ALL
  UNION ALL
  SELECT 'label', {_RUN_OF_POS}, {_LABEL_COUNTERS}
  FROM ({_LABEL_ROWS}) AS l JOIN (SELECT id, pos FROM ({_OUTCOMES}) AS o) AS p USING (id) GROUP BY ALL
) AS r"""

ORACLES["progress_by_batch"] = f"""
SELECT stage, run_seq, batch, total, kept, skipped, errors, {_RUNNING % (("run_seq, batch",) * 4)}
FROM (
  SELECT 'filter' AS stage, {_RUN_OF_POS} AS run_seq,
    CAST(ceil((CASE WHEN pos <= {BATCH_SIZE * FIRST_RUN_BATCHES} THEN pos
      ELSE pos - {BATCH_SIZE * FIRST_RUN_BATCHES} END) / {BATCH_SIZE}) AS BIGINT) AS batch,
    {_COUNTERS}
  FROM ({_OUTCOMES}) AS o GROUP BY ALL
) AS b"""

ORACLES["label_report"] = f"""
SELECT category, mood, count(*) AS rows, count(*) FILTER (NOT category_known) AS unknown_category,
  count(*) FILTER (NOT mood_known) AS unknown_mood, count(*) FILTER (error IS NOT NULL) AS errors,
  round(avg(CASE WHEN error IS NULL THEN 0 ELSE 1 END), 6) AS error_rate
FROM (SELECT *, {_KNOWN} FROM ({_LABEL_ROWS}) AS l WHERE NOT rejected) AS k GROUP BY category, mood"""

ORACLES["quarantine"] = f"""
SELECT id, 'filter' AS stage, {_PAYLOAD_ERROR} AS error FROM ({_STAGE}) AS s WHERE image_format IS NULL
UNION ALL
SELECT id, 'label', 'label_not_an_object' FROM ({_LABEL_ROWS}) AS l WHERE rejected"""
