"""The same queries stated in DuckDB SQL, as an independent oracle.

Each view rule in ``sifter/sources/adapters.py`` appears here once more, in
DuckDB's dialect. DuckDB string literals do not process backslashes, so
``'\\"'`` in the SQL text below is a backslash and a quote.
"""
from __future__ import annotations

import string as _string

from .oracle_values import (
    DELAY_KEYS,
    ERROR_TEXTS,
    HMS,
    JSON_PARSE,
    MODEL_UNAVAILABLE,
    PROC_INSTRUCTION,
    PROMPT_TEMPLATE,
    QUOTA,
    RETRIABLE,
    SECONDS_KEY,
    SECONDS_ONLY,
    TASKS,
    TIMEOUT,
)

# ------------------------------------------------------------- text builders


def qs(x: str) -> str:
    return f"""('"' || replace({x}, '"', '\\"') || '"')"""


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


INSTRUCTION = "Convert the tactical intent into a JSON scheduling document."


def _doc(tt: str | None = None, ag: str | None = None, pr: str | None = None) -> str:
    tt = tt or qs("event_type")
    ag = ag or (
        """('[{"role": "predator", "count": ' || CAST(user_id % 7 + 1 AS VARCHAR) """
        """|| ', "strategy": "包抄_' || event_type || '"}]')"""
    )
    pr = pr or "props"
    return f"""('{{"task_type": ' || {tt} || ', "agents_config": ' || {ag} || ', "rl_parameters": ' || {pr} || '}}')"""


def _rec(output: str, instruction: str | None = None, input_: str | None = None, extra: str | None = None) -> str:
    ins = instruction or qs(lit(INSTRUCTION))
    inp = input_ or qs("'Intent ' || event_type || ' from user ' || CAST(user_id AS VARCHAR)")
    tail = f" || ', ' || {extra}" if extra else ""
    return f"""('{{"instruction": ' || {ins} || ', "input": ' || {inp} || ', "output": ' || {output}{tail} || '}}')"""


D = _doc()

RAW_RECORDS = f"""
raw_records AS (
  SELECT event_id AS pos,
    CASE event_id % 20
      WHEN 0 THEN {qs('event_type')}
      WHEN 1 THEN '[' || props || ']'
      WHEN 2 THEN '{{"instruction": ' || {qs(lit(INSTRUCTION))} || ', "output": ' || {qs(D)} || '}}'
      WHEN 3 THEN {_rec(lit('" ' + chr(0x3000) + '\\t "'))}
      WHEN 4 THEN {_rec("'null'")}
      WHEN 5 THEN {_rec('props')}
      WHEN 6 THEN {_rec(qs("'{\"task_type\": \"' || event_type || '\"'"))}
      WHEN 7 THEN {_rec(qs(D + " || ' trailing'"))}
      WHEN 8 THEN {_rec(qs('props'))}
      WHEN 9 THEN {_rec(qs(_doc(tt='CAST(user_id AS VARCHAR)')))}
      WHEN 10 THEN {_rec(qs(_doc(ag='props')))}
      WHEN 11 THEN {_rec(qs(_doc(pr="'null'")))}
      WHEN 12 THEN {_rec(qs(D), instruction="'null'", input_="'null'")}
      WHEN 13 THEN {_rec(qs(D), extra="'\"meta\": ' || props")}
      WHEN 14 THEN {_rec(qs("substring(" + D + ", 1, length(" + D + ") - 1) || ', \"note\": \"额外\"}'"))}
      WHEN 15 THEN {_rec(qs("'[' || " + D + " || ']'"))}
      ELSE {_rec(qs(D))}
    END AS item
  FROM events
)"""

# Python str.strip() whitespace, same class as sifter.functions.jsonx.WS_CLASS
WS = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
NOT_WS = "[^" + WS[1:]
MINIFY = """'("(?:[^"\\\\]|\\\\.)*")|[ \\t\\n\\r]+', '\\1', 'g'"""

CLASSIFIED = f"""
c0 AS (
  SELECT pos, item, json_type(item) AS kind,
    (json_extract(item, '$.instruction') IS NULL OR json_extract(item, '$.input') IS NULL
      OR json_extract(item, '$.output') IS NULL) AS missing,
    CASE WHEN json_type(item) = 'OBJECT' AND json_type(item, '$.output') = 'VARCHAR'
      THEN item ->> '$.output' END AS o
  FROM raw_records
),
c1 AS (
  SELECT *, CASE WHEN o IS NOT NULL AND json_valid(o) THEN o END AS po FROM c0
),
c2 AS (
  SELECT *, CASE WHEN json_type(po) = 'OBJECT' THEN po END AS doc FROM c1
),
classified AS (
  SELECT pos, item, doc,
    CASE
      WHEN kind <> 'OBJECT' THEN 'invalid_item'
      WHEN missing THEN 'missing_keys'
      WHEN o IS NULL OR NOT regexp_matches(o, '{NOT_WS}') THEN 'output_json_error'
      WHEN doc IS NULL THEN 'output_json_error'
      WHEN json_extract(doc, '$.task_type') IS NULL OR json_extract(doc, '$.agents_config') IS NULL
        OR json_extract(doc, '$.rl_parameters') IS NULL THEN 'output_missing_keys'
      WHEN coalesce(json_type(doc, '$.task_type') <> 'VARCHAR', true)
        OR coalesce(json_type(doc, '$.agents_config') <> 'ARRAY', true)
        OR coalesce(json_type(doc, '$.rl_parameters') <> 'OBJECT', true) THEN 'output_invalid_types'
      ELSE 'valid'
    END AS label
  FROM c2
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["a1_validation_report"] = with_(RAW_RECORDS, CLASSIFIED) + """
SELECT count(*) AS total,
  CAST(count_if(label = 'valid') AS BIGINT) AS valid,
  CASE WHEN count(*) > 0 THEN round(count_if(label = 'valid') * 100.0::DOUBLE / count(*), 2) ELSE 0.0::DOUBLE END AS valid_pct,
  CAST(count_if(label = 'invalid_item') AS BIGINT) AS invalid_item,
  CAST(count_if(label = 'missing_keys') AS BIGINT) AS missing_keys,
  CAST(count_if(label = 'output_json_error') AS BIGINT) AS output_json_error,
  CAST(count_if(label = 'output_missing_keys') AS BIGINT) AS output_missing_keys,
  CAST(count_if(label = 'output_invalid_types') AS BIGINT) AS output_invalid_types
FROM classified"""

ORACLE["c7_classify"] = with_(RAW_RECORDS, CLASSIFIED) + "SELECT pos, label FROM classified"

ORACLE["c8_clean"] = with_(RAW_RECORDS, CLASSIFIED) + """
SELECT pos, item ->> '$.instruction' AS instruction, item ->> '$.input' AS input, item ->> '$.output' AS output
FROM classified WHERE label = 'valid'"""

ORACLE["c10_quarantine"] = with_(RAW_RECORDS, CLASSIFIED) + "SELECT pos, label FROM classified WHERE label <> 'valid'"

ORACLE["c9_minify"] = with_(RAW_RECORDS, CLASSIFIED) + f"""
SELECT pos, regexp_replace(item ->> '$.output', {MINIFY}) AS output
FROM classified WHERE label = 'valid'"""

ORACLE["c11_clean_job"] = with_(RAW_RECORDS, CLASSIFIED) + f"""
SELECT item ->> '$.instruction' AS instruction, item ->> '$.input' AS input,
  regexp_replace(item ->> '$.output', {MINIFY}) AS output,
  json_extract(item, '$.meta') IS NOT NULL AS has_extra
FROM classified WHERE label = 'valid'"""


# ------------------------------------------------------------------ responses


def jstr(x: str) -> str:
    return f"""('"' || replace(replace(replace({x}, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '"')"""


def _good(n: int) -> str:
    return (
        f"""('{{"instruction": ' || {jstr(lit(INSTRUCTION))} || ', "input": ' || """
        f"""{jstr("'Intent ' || event_type || ' #" + str(n) + " from user ' || CAST(user_id AS VARCHAR)")} """
        f"""|| ', "output": ' || od || '}}')"""
    )


_ARR = f"('[' || {_good(1)} || ', ' || {_good(2)} || ']')"
_WRITTEN = """('{"score": ' || CAST(user_id AS VARCHAR) || '.0, "props": ' || props || ', "ids": [1, 2.5, 12345678901234567890' || CAST(event_id AS VARCHAR) || ']}')"""

_CONTENT = f"""CASE event_id % 10
      WHEN 0 THEN {_ARR}
      WHEN 1 THEN '```json' || chr(10) || {_ARR} || chr(10) || '```'
      WHEN 2 THEN 'Here are the items:' || chr(10) || {_ARR} || chr(10) || 'Done.'
      WHEN 3 THEN {_good(1)}
      WHEN 4 THEN '[' || {_good(1)} || ', 3, {{"instruction": "x"}}]'
      WHEN 5 THEN '[{{"instruction": ' || {jstr(lit(INSTRUCTION))} || ', "input": "coerce ' || CAST(event_id AS VARCHAR) || '", "output": ' || {_WRITTEN} || '}}]'
      WHEN 6 THEN '[{{"instruction": "x", '
      ELSE CASE WHEN user_id % 2 = 0 THEN '42' ELSE 'Here: {{"a":[' || CAST(user_id AS VARCHAR) || ']}}' END
    END"""

RESPONSES = f"""
ev AS (SELECT event_id, user_id, event_type, props, {jstr(D)} AS od FROM events),
responses AS (
  SELECT user_id AS run_id, event_id AS request_id,
    CASE event_id % 10
      WHEN 8 THEN '{{"error": {{"message": "quota exceeded"}}}}'
      WHEN 9 THEN '{{"choices": [{{"message": {{"role": "assistant", "content": "  "}}}}]}}'
      ELSE '{{"choices": [{{"message": {{"role": "assistant", "content": ' || {jstr(_CONTENT)} || '}}}}]}}'
    END AS body
  FROM ev
)"""


def ustrip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


FENCED = f"""
env AS (
  SELECT run_id, request_id, body,
    CASE WHEN json_valid(body) THEN json_array_length(body, '$.choices') END AS nchoices,
    CASE WHEN json_valid(body) AND json_type(body, '$.choices[0].message.content') = 'VARCHAR'
      THEN body ->> '$.choices[0].message.content' END AS txt
  FROM responses
),
env2 AS (
  SELECT run_id, request_id,
    CASE WHEN coalesce(nchoices, 0) = 0 THEN 'choices'
         WHEN txt IS NULL OR NOT regexp_matches(txt, '{NOT_WS}') THEN 'message.content' END AS envelope_error,
    txt
  FROM env
),
content AS (
  SELECT run_id, request_id, envelope_error,
    CASE WHEN envelope_error IS NULL THEN txt END AS content,
    CASE WHEN envelope_error IS NULL THEN {ustrip_sql('txt')} END AS s0
  FROM env2
),
defenced AS (
  SELECT *, CASE WHEN starts_with(s0, '```')
    THEN {ustrip_sql("regexp_replace(regexp_replace(s0, '^```[a-zA-Z]*\\n?', ''), '\\n?```$', '')")}
    ELSE s0 END AS stripped
  FROM content
),
extracted AS (
  SELECT *, CASE
      WHEN json_valid(stripped) THEN stripped
      WHEN regexp_matches(stripped, '\\[[\\s\\S]*\\]') THEN regexp_extract(stripped, '\\[[\\s\\S]*\\]', 0)
      WHEN regexp_matches(stripped, '\\{{[\\s\\S]*\\}}') THEN regexp_extract(stripped, '\\{{[\\s\\S]*\\}}', 0)
      ELSE stripped END AS extracted
  FROM defenced
),
parsed AS (
  SELECT *, CASE WHEN json_valid(extracted) THEN
      CASE json_type(extracted) WHEN 'OBJECT' THEN '[' || extracted || ']' WHEN 'ARRAY' THEN extracted END
    END AS arr
  FROM extracted
),
items_all AS (
  SELECT run_id, request_id, i AS item_idx, json_extract(arr, '$[' || i || ']') AS it
  FROM parsed, range(0, CAST(coalesce(json_array_length(arr), 0) AS BIGINT)) t(i)
),
items_flag AS (
  SELECT *, coalesce(json_type(it) = 'OBJECT' AND json_extract(it, '$.instruction') IS NOT NULL
      AND json_extract(it, '$.input') IS NOT NULL AND json_extract(it, '$.output') IS NOT NULL, false) AS ok
  FROM items_all
)"""

_RESP = with_(RESPONSES, FENCED)

ORACLE["g1_response_content"] = _RESP + "SELECT run_id, request_id, envelope_error, content FROM content"

ORACLE["g3_extract_json_text"] = _RESP + "SELECT request_id, stripped, extracted FROM extracted"

# an output that is no text is kept as it was written, not as a JSON library would print it
ORACLE["g6_items"] = _RESP + f"""
SELECT run_id, request_id, CAST(item_idx AS BIGINT) AS item_idx, it ->> '$.instruction' AS instruction, it ->> '$.input' AS input,
  CASE WHEN json_type(it, '$.output') = 'VARCHAR' THEN it ->> '$.output' ELSE {_WRITTEN} END AS output
FROM items_flag JOIN events ON event_id = request_id WHERE ok"""

_STATS = """
stats AS (
  SELECT p.run_id, p.request_id,
    coalesce((SELECT count_if(ok) FROM items_flag f WHERE f.request_id = p.request_id), 0) AS n_items,
    coalesce((SELECT count_if(NOT ok) FROM items_flag f WHERE f.request_id = p.request_id), 0) AS n_dropped,
    p.envelope_error, p.arr
  FROM parsed p
)"""

ORACLE["g7_response_stats"] = with_(RESPONSES, FENCED, _STATS) + """
SELECT run_id, request_id, CAST(n_items AS BIGINT) AS n_items, CAST(n_dropped AS BIGINT) AS n_dropped,
  CASE WHEN envelope_error IS NOT NULL THEN envelope_error WHEN arr IS NULL THEN 'parse_error'
       WHEN n_items = 0 THEN 'no_valid_items' ELSE 'ok' END AS status
FROM stats"""

ORACLE["a2_dropped_per_run"] = with_(RESPONSES, FENCED, _STATS) + """
SELECT run_id, count(*) AS n_responses, CAST(sum(n_items) AS BIGINT) AS n_items, CAST(sum(n_dropped) AS BIGINT) AS n_dropped,
  CAST(count_if(envelope_error IS NOT NULL OR arr IS NULL OR n_items = 0) AS BIGINT) AS n_failed
FROM stats GROUP BY run_id"""


# ---------------------------------------------------------------- request_log

_ERR = "CASE event_id % 12 " + " ".join(
    f"WHEN {i} THEN {lit(t)}" for i, t in enumerate(ERROR_TEXTS) if t is not None
) + " END"

REQUEST_LOG = f"""
ev_err AS (SELECT event_id, ts, user_id, {_ERR} AS err FROM events),
request_log AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, ts,
    CAST(event_id % 5 AS INTEGER) AS attempt, CAST(event_id % 50 + 1 AS INTEGER) AS batch_size,
    CAST(CASE WHEN err IS NULL THEN event_id % 50 + 1 ELSE 0 END AS INTEGER) AS n_items, err AS error
  FROM ev_err
)"""


def markers_sql(x: str, markers) -> str:
    return "coalesce(" + " OR ".join(f"contains(lower({x}), {lit(m)})" for m in markers) + ", false)"


def dur_sql(t: str) -> str:
    s = ustrip_sql(t)
    hms = HMS

    def num(i):
        return f"TRY_CAST(nullif(regexp_extract({s}, '{hms}', {i}), '') AS DOUBLE)"

    total = f"(coalesce({num(1)} * 3600, 0) + coalesce({num(2)} * 60, 0) + coalesce({num(3)}, 0))"
    return (
        f"(CASE WHEN {s} = '' THEN NULL "
        f"WHEN regexp_matches({s}, '{SECONDS_ONLY}') THEN CAST(ceil(CAST(regexp_extract({s}, '{SECONDS_ONLY}', 1) AS DOUBLE)) AS BIGINT) "
        f"WHEN regexp_matches({s}, '{hms}') AND {total} > 0 THEN CAST(ceil({total}) AS BIGINT) END)"
    )


def delay_sql(e: str) -> str:
    tries = [dur_sql(f"""regexp_extract({e}, '"{k}"\\s*:\\s*"([^"]+)"', 1)""") for k in DELAY_KEYS]
    secs = f"""TRY_CAST(nullif(regexp_extract({e}, '"{SECONDS_KEY}"\\s*:\\s*(\\d+)', 1), '') AS BIGINT)"""
    return "coalesce(" + ", ".join(tries + [secs]) + ")"


_LOG = with_(REQUEST_LOG)

ORACLE["r5_error_markers"] = _LOG + f"""
SELECT run_id, seq, {markers_sql('error', RETRIABLE)} AS is_retriable,
  {markers_sql('error', QUOTA)} AS is_quota,
  {markers_sql('error', JSON_PARSE)} AS is_json_parse,
  {markers_sql('error', TIMEOUT)} AS is_timeout,
  {markers_sql('error', MODEL_UNAVAILABLE)} AS is_model_unavailable
FROM request_log"""

_DTEXT = """regexp_extract(error, '"(?:retryDelay|quotaResetDelay|reset_time|resetTime)"\\s*:\\s*"([^"]+)"', 1)"""

ORACLE["r6_durations"] = _LOG + f"""
SELECT run_id, seq, {_DTEXT} AS duration_text, {dur_sql(_DTEXT)} AS seconds
FROM request_log WHERE error IS NOT NULL"""

ORACLE["r7_retry_delay"] = _LOG + f"SELECT run_id, seq, {delay_sql('error')} AS delay_s FROM request_log"

_SHRUNK = "(CASE WHEN greatest(5, batch_size // 2) = batch_size THEN greatest(1, batch_size - 1) ELSE greatest(5, batch_size // 2) END)"
_CAN = f"(batch_size > 1 AND {_SHRUNK} < batch_size)"

_ACT = f"""
act AS (
  SELECT run_id, seq, attempt, batch_size, n_items, error, {delay_sql('error')} AS delay,
    CASE WHEN error IS NULL THEN 'success'
      WHEN {markers_sql('error', MODEL_UNAVAILABLE)} THEN 'stop'
      WHEN {markers_sql('error', JSON_PARSE)} AND {_CAN} THEN 'shrink'
      WHEN {markers_sql('error', TIMEOUT)} AND {_CAN} THEN 'shrink'
      WHEN {markers_sql('error', QUOTA)} THEN 'stop'
      WHEN {markers_sql('error', RETRIABLE)} AND attempt < 4 THEN 'backoff'
      ELSE 'skip' END AS action
  FROM request_log
)"""

ORACLE["r8_actions"] = with_(REQUEST_LOG, _ACT) + f"""
SELECT run_id, seq, action,
  CAST(CASE WHEN action = 'backoff' THEN coalesce(delay, (attempt + 1) * 5) END AS BIGINT) AS wait_s,
  CAST(CASE WHEN action = 'success' THEN (CASE WHEN batch_size < 50 THEN least(50, batch_size + 5) ELSE batch_size END)
       WHEN action = 'shrink' THEN {_SHRUNK} ELSE batch_size END AS INTEGER) AS next_batch_size
FROM act"""

# Walks each run in order: a success sets the streak to 0, a batch that ends
# without one adds 1, every other attempt leaves it as it is.
ORACLE["r11_failure_streaks"] = with_(REQUEST_LOG, _ACT, """
lost AS (
  SELECT run_id, seq, error IS NULL AS ok, action = 'skip' OR (action = 'shrink' AND attempt + 1 >= 5) AS given_up FROM act
),
spans AS (
  SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS span FROM lost
),
counted AS (
  SELECT *, CAST(sum(CASE WHEN given_up THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, span ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak
  FROM spans
)""") + "SELECT run_id, seq, given_up, streak, given_up AND streak >= 20 AS stop_flag FROM counted"

_PROG = with_(REQUEST_LOG, _ACT, """
prog AS (
  SELECT run_id, seq, action, error, CAST(CASE WHEN error IS NULL THEN n_items ELSE 0 END AS BIGINT) AS got,
    sum(CASE WHEN error IS NULL THEN n_items ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run
  FROM act
),
prog2 AS (
  SELECT run_id, seq, action, error, CAST(least(run, 2000) AS BIGINT) AS total, CAST(least(run - got, 2000) AS BIGINT) AS before FROM prog
)""")

ORACLE["r12_run_progress"] = _PROG + """
SELECT run_id, seq, total, total - before AS accepted, 2000 - total AS remaining FROM prog2"""

ORACLE["r13_checkpoint_marks"] = _PROG + """
SELECT run_id, seq, action, total FROM prog2 WHERE (error IS NULL AND total > before AND total % 100 = 0) OR action = 'stop'"""

ORACLE["r14_rate_gaps"] = _LOG + """
SELECT run_id, seq, gap_s, CASE WHEN gap_s < 1.0 THEN 1.0 - gap_s ELSE 0.0 END AS wait_s
FROM (SELECT run_id, seq, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY seq)) / 1e6 AS gap_s FROM request_log)"""


# ------------------------------------------------------------ conversations

SFT_RECORDS = """
conv_sys AS (
  SELECT conv_id, turn, role, text,
    last_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS)
      OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sys,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations
),
sft_records AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos, coalesce(sys, '') AS instruction, text AS input, next_text AS output
  FROM conv_sys WHERE role = 'user' AND next_role = 'assistant'
)"""

ORACLE["h5_transcript_records"] = with_(SFT_RECORDS) + "SELECT pos, instruction, input, output FROM sft_records"

SYSTEM_PROMPT = "You are a helpful assistant."
IM_S, IM_E, NL = "'<|im_start|>'", "'<|im_end|>'", "chr(10)"

SAMPLES = f"""
norm AS (
  SELECT pos, {ustrip_sql("coalesce(instruction, '')")} AS instruction, {ustrip_sql("coalesce(input, '')")} AS input,
    {ustrip_sql('output')} AS output
  FROM sft_records
),
merged AS (
  SELECT *, CASE WHEN instruction <> '' AND instruction <> {lit(SYSTEM_PROMPT)}
      THEN CASE WHEN input = '' THEN instruction ELSE instruction || chr(10) || chr(10) || input END
      ELSE input END AS user_text
  FROM norm
),
reasons AS (
  SELECT *, CASE WHEN output IS NULL THEN 'output_missing' WHEN output = '' THEN 'output_blank'
    WHEN user_text = '' THEN 'empty_prompt' END AS drop_reason
  FROM merged
),
rendered AS (
  SELECT pos, drop_reason,
    {IM_S} || 'system' || {NL} || {lit(SYSTEM_PROMPT)} || {IM_E} || {NL}
      || {IM_S} || 'user' || {NL} || user_text || {IM_E} || {NL} || {IM_S} || 'assistant' || {NL} AS prompt,
    output || {IM_E} AS answer
  FROM reasons
),
enc AS (
  SELECT pos, drop_reason, prompt, answer,
    list_transform(string_split(prompt, ''), lambda c: unicode(c)) AS p,
    list_transform(string_split(answer, ''), lambda c: unicode(c)) AS a
  FROM rendered WHERE drop_reason IS NULL
),
full_ AS (
  SELECT pos, p, a, list_concat(p, a) AS ids, list_concat(list_transform(p, lambda x: -100), a) AS lab FROM enc
),
samples AS (
  SELECT pos, len(p) AS n_prompt, len(a) AS n_answer,
    CASE WHEN len(ids) > 1024 THEN list_slice(ids, len(ids) - 1024 + 1, len(ids)) ELSE ids END AS input_ids,
    CASE WHEN len(lab) > 1024 THEN list_slice(lab, len(lab) - 1024 + 1, len(lab)) ELSE lab END AS labels
  FROM full_
)"""

_T = with_(SFT_RECORDS, SAMPLES)

ORACLE["t1_normalize"] = _T + """
SELECT pos, instruction, input, output,
  CASE WHEN output IS NULL THEN 'output_missing' WHEN output = '' THEN 'output_blank' END AS drop_reason
FROM norm"""

ORACLE["t4_render_prompt"] = _T + """
SELECT pos, md5(prompt) AS prompt_md5, CAST(length(prompt) AS INTEGER) AS prompt_chars, md5(answer) AS answer_md5 FROM rendered
WHERE drop_reason IS NULL"""

ORACLE["t10_samples"] = _T + """
SELECT pos, CAST(n_prompt AS INTEGER) AS n_prompt, CAST(n_answer AS INTEGER) AS n_answer,
  CAST(len(input_ids) AS INTEGER) AS n_tokens,
  CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS n_learn,
  md5(array_to_string(input_ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5
FROM samples WHERE len(list_filter(labels, lambda x: x <> -100)) > 0"""

_SPLIT = with_(SFT_RECORDS, SAMPLES, """
kept AS (SELECT * FROM samples WHERE len(list_filter(labels, lambda x: x <> -100)) > 0),
split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(pos AS VARCHAR)), pos)
      <= floor(count(*) OVER () * 0.02::DOUBLE) THEN 'eval' ELSE 'train' END AS split
  FROM kept
)""")

ORACLE["t11_split"] = _SPLIT + "SELECT pos, split FROM split"

ORACLE["a4_split_sizes"] = _SPLIT + "SELECT split, count(*) AS n FROM split GROUP BY split"

ORACLE["t13_padded_batches"] = _SPLIT + """,
batched AS (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY pos) - 1) / 8) AS BIGINT) AS batch_id FROM split
),
padded AS (
  SELECT *, max(len(input_ids)) OVER (PARTITION BY split, batch_id) AS width FROM batched
)
SELECT split, batch_id, pos, CAST(width AS INTEGER) AS width,
  md5(array_to_string(list_concat(input_ids, list_transform(range(width - len(input_ids)), lambda i: 0)), ',')) AS ids_md5,
  md5(array_to_string(list_concat(list_transform(input_ids, lambda i: 1), list_transform(range(width - len(input_ids)), lambda i: 0)), ',')) AS mask_md5,
  md5(array_to_string(list_concat(labels, list_transform(range(width - len(input_ids)), lambda i: -100)), ',')) AS labels_md5
FROM padded"""

TRANSCRIPT = f"""
transcript AS (
  SELECT conv_id, turn,
    CASE WHEN (conv_id % 5 = 0 AND turn = 2) OR (conv_id % 7 = 0 AND turn = 4) THEN 'user' ELSE role END AS role,
    CASE WHEN conv_id % 5 = 0 AND turn = 2 THEN '/reset' WHEN conv_id % 7 = 0 AND turn = 4 THEN '/exit' ELSE text END AS text
  FROM conversations
),
lines AS (
  SELECT *, CASE WHEN line IS NULL OR line = '' THEN 'blank'
      WHEN role = 'user' AND line IN ('/exit', 'exit', 'quit') THEN 'exit'
      WHEN role = 'user' AND line = '/reset' THEN 'reset'
      WHEN role = 'system' THEN 'system' ELSE 'message' END AS kind
  FROM (SELECT *, {ustrip_sql('text')} AS line FROM transcript)
),
lines2 AS (
  SELECT *, max(CASE WHEN kind = 'exit' THEN 1 ELSE 0 END) OVER w = 0 AS active,
    CAST(sum(CASE WHEN kind = 'reset' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS episode,
    last_value(CASE WHEN kind = 'system' THEN line END IGNORE NULLS) OVER w AS system_text
  FROM lines
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

ORACLE["h1_chat_lines"] = with_(TRANSCRIPT) + "SELECT conv_id, turn, kind, active FROM lines2"

ORACLE["h2_episodes"] = with_(TRANSCRIPT) + "SELECT conv_id, turn, episode, system_text FROM lines2"

ORACLE["h3_histories"] = with_(TRANSCRIPT) + """
SELECT conv_id, turn, episode, row_number() OVER w AS idx, role, line AS content, nullif(system_text, '') AS system_text,
  CAST(count(*) OVER w + CASE WHEN system_text <> '' THEN 1 ELSE 0 END AS INTEGER) AS n_messages
FROM lines2 WHERE active AND kind = 'message'
WINDOW w AS (PARTITION BY conv_id, episode ORDER BY turn ROWS UNBOUNDED PRECEDING)"""

ORACLE["h4_join_chunks"] = f"""
SELECT doc_id, CAST(greatest(ceil(length(text) / 100), 1) AS BIGINT) AS n_chunks, {ustrip_sql('text')} AS text FROM documents"""


# ------------------------------------------------------- generation, seeds


def fmt_sql(template: str, values: dict[str, str]) -> str:
    parts = []
    for literal, field, _, _ in _string.Formatter().parse(template):
        if literal:
            parts.append(lit(literal))
        if field is not None:
            parts.append(f"CAST({values[field]} AS VARCHAR)")
    return "(" + " || ".join(parts) + ")"


def draw_sql(key: str, slot) -> str:
    return f"('0x' || substr(md5('42:' || CAST({key} AS VARCHAR) || ':' || '{slot}'), 1, 15))::BIGINT"


def _proc(key: str) -> tuple[str, str, str]:
    t = f"({draw_sql(key, 0)} % {len(TASKS)})"
    tt, inp, out = [], [], []
    for i, spec in enumerate(TASKS):
        vals = {}
        for s, (name, kind, rng) in enumerate(spec["params"]):
            d = draw_sql(key, s + 1)
            if kind == "int":
                vals[name] = f"({rng[0]} + {d} % {rng[1] - rng[0] + 1})"
            else:
                vals[name] = "[" + ", ".join(lit(v) for v in rng) + f"][{d} % {len(rng)} + 1]"
        tt.append(f"WHEN {i} THEN {lit(spec['task_type'])}")
        inp.append(f"WHEN {i} THEN {fmt_sql(spec['input'], vals)}")
        out.append(f"WHEN {i} THEN {fmt_sql(spec['output'], vals)}")
    return (f"CASE {t} " + " ".join(x) + " END" for x in (tt, inp, out))


_TT, _INP, _OUT = _proc("event_id")

GENERATED = f"""
generated AS (
  SELECT event_id AS pos, {_TT} AS task_type, {lit(PROC_INSTRUCTION)} AS instruction, {_INP} AS input, {_OUT} AS output
  FROM events
)"""

SEEDS = """
seeds AS (
  SELECT item_id AS pos, 'Turn the benchmark passage into a scheduling document.' AS instruction, text AS input,
    '{"task_type": "bench_' || CAST(item_id AS VARCHAR) || '", "agents_config": [], "rl_parameters": {"item": '
      || CAST(item_id AS VARCHAR) || '}}' AS output
  FROM benchmark
)"""

ORACLE["p5_procedural"] = with_(GENERATED) + "SELECT pos AS id, task_type, instruction, input, output FROM generated"

ORACLE["s4_append_batch"] = with_(SEEDS, GENERATED) + """
SELECT pos, input, output FROM seeds
UNION ALL SELECT pos + (SELECT max(pos) + 1 FROM seeds), input, output FROM generated"""

_CKPT = with_(SEEDS, GENERATED, """
ckpt AS (
  SELECT pos, 'seed' AS source, input, output FROM seeds
  UNION ALL SELECT (SELECT count(*) FROM seeds) + row_number() OVER (ORDER BY pos) - 1, 'generated', input, output FROM generated
)""")

ORACLE["s4_append_once"] = ORACLE["s4_append_batch"]

ORACLE["s5_checkpoint"] = _CKPT + "SELECT pos, source, input, output FROM ckpt"

ORACLE["s6_resume"] = _CKPT + """
SELECT pos - (SELECT count(*) FROM seeds) AS pos, input, output FROM ckpt
WHERE pos >= (SELECT count(*) FROM seeds) AND (SELECT count(*) FROM ckpt) >= (SELECT count(*) FROM seeds)"""

ORACLE["s7_finalize"] = with_(SEEDS, GENERATED) + """
SELECT pos, 'seed' AS source, input, output FROM seeds
UNION ALL SELECT (SELECT count(*) FROM seeds) + r - 1, 'generated', input, output
FROM (SELECT *, row_number() OVER (ORDER BY pos) AS r FROM generated) WHERE r <= 2000"""

PICKS = with_(SEEDS, """
sidx AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS idx FROM seeds),
m AS (SELECT count(*) AS m FROM seeds),
pr AS (SELECT event_id AS prompt_id, CAST(event_id % 50 + 1 AS INTEGER) AS n_items FROM events),
d AS (
  SELECT prompt_id, n_items,
    """ + draw_sql("prompt_id", 0) + """ % m AS i0,
    """ + draw_sql("prompt_id", 1) + """ % (m - 1) AS r1,
    """ + draw_sql("prompt_id", 2) + """ % (m - 2) AS r2
  FROM pr, m
),
d2 AS (SELECT *, r1 + CAST(r1 >= i0 AS INTEGER) AS i1 FROM d),
d3 AS (SELECT *, r2 + CAST(r2 >= least(i0, i1) AS INTEGER) AS t2 FROM d2),
d4 AS (SELECT *, t2 + CAST(t2 >= greatest(i0, i1) AS INTEGER) AS i2 FROM d3),
picks AS (
  SELECT prompt_id, n_items, 1 AS rank, i0 AS idx FROM d4
  UNION ALL SELECT prompt_id, n_items, 2, i1 FROM d4
  UNION ALL SELECT prompt_id, n_items, 3, i2 FROM d4
),
sampled AS (SELECT p.prompt_id, p.n_items, p.rank, s.pos, s.input, s.output FROM picks p JOIN sidx s ON p.idx = s.idx)""")

ORACLE["p1_sample_seeds"] = PICKS + "SELECT prompt_id, CAST(rank AS INTEGER) AS rank, pos FROM sampled"

_EX = fmt_sql(PROMPT_TEMPLATE["example"], {"idx": "rank", "input": "input", "output": "output"})
_HEAD = fmt_sql(PROMPT_TEMPLATE["header"], {"n": "n_items"})
PROMPTS = PICKS[:-1] + f""",
prompts AS (
  SELECT prompt_id, n_items, {_HEAD} || string_agg({_EX}, '' ORDER BY rank) || {lit(PROMPT_TEMPLATE['footer'])} AS prompt
  FROM sampled GROUP BY prompt_id, n_items
)
"""

ORACLE["p2_build_prompts"] = PROMPTS + "SELECT prompt_id, n_items, md5(prompt) AS prompt_md5, CAST(length(prompt) AS INTEGER) AS prompt_chars FROM prompts"

ORACLE["p3_plan_requests"] = """
WITH t AS (SELECT user_id AS run_id, count(*) * 25 AS target FROM events GROUP BY user_id)
SELECT run_id, CAST(r AS BIGINT) AS request_no, CAST(r * 50 AS BIGINT) AS before, CAST(least(50, target - r * 50) AS BIGINT) AS batch_size
FROM t, range(0, CAST(ceil(target / 50) AS BIGINT)) AS g(r) WHERE target > 0"""

ORACLE["p4_generate_parse"] = PROMPTS + """
SELECT prompt_id, CAST(0 AS BIGINT) AS item_idx, 'echo' AS instruction, 'prompt ' || substr(md5(prompt), 1, 8) AS input,
  '{"task_type": "echo", "agents_config": [], "rl_parameters": {"chars": ' || CAST(length(prompt) AS VARCHAR) || '}}' AS output
FROM prompts"""

ORACLE["p4_resume_answers"] = PROMPTS + """
SELECT prompt_id, CAST(1 + length(prompt) % 2 AS INTEGER) AS attempt, CAST(0 AS BIGINT) AS item_idx, 'echo' AS instruction,
  'prompt ' || substr(md5(prompt), 1, 8) AS input,
  '{"task_type": "echo", "agents_config": [], "rl_parameters": {"chars": ' || CAST(length(prompt) AS VARCHAR) || '}}' AS output
FROM prompts"""

# ----------------------------------------------------------------- metrics

METRIC_LOG = """
metric_log AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, event_id, value FROM events
),
series AS (
  SELECT run_id, 'loss' AS name, step, value FROM metric_log WHERE event_id % 10 <> 0
  UNION ALL SELECT run_id, 'eval_loss', step, value FROM metric_log WHERE event_id % 10 = 0
)"""

ORACLE["a5_metric_series"] = with_(METRIC_LOG) + "SELECT run_id, name, step, value FROM series"

ORACLE["f4_smooth"] = with_(METRIC_LOG) + """
SELECT run_id, name, step, round(list_reduce(list(value) OVER (PARTITION BY run_id, name ORDER BY step
    ROWS UNBOUNDED PRECEDING), lambda acc, p: acc * 0.85::DOUBLE + p * (1 - 0.85::DOUBLE)), 9) AS smoothed
FROM series"""

ORACLE["t3_instruction_as_system"] = with_(SFT_RECORDS, SAMPLES) + f"""
SELECT pos, md5({IM_S} || 'system' || {NL} || instruction || {IM_E} || {NL} || {IM_S} || 'user' || {NL} || input || {IM_E} || {NL}
  || {IM_S} || 'assistant' || {NL}) AS prompt_md5
FROM norm WHERE instruction <> '' AND input <> '' AND output IS NOT NULL AND output <> ''"""


# ---------------------------------------------------------------- streaming

ORACLE["x1_stream_clean"] = with_(RAW_RECORDS, CLASSIFIED) + """
SELECT 'clean' AS output_of, pos, 'valid' AS label, item ->> '$.instruction' AS instruction, item ->> '$.input' AS input,
  item ->> '$.output' AS output, CAST(1 AS BIGINT) AS n
FROM classified WHERE label = 'valid'
UNION ALL SELECT 'quarantine', pos, label, NULL, NULL, NULL, 1 FROM classified WHERE label <> 'valid'
UNION ALL SELECT 'report', NULL, label, NULL, NULL, NULL, count(*) FROM classified GROUP BY label"""
ORACLE["x2_stream_report"] = with_(RAW_RECORDS, CLASSIFIED) + "SELECT label, count(*) AS n FROM classified GROUP BY label"
ORACLE["x3_stream_histories"] = ORACLE["h3_histories"]

ORACLE["s1_read_array_files"] = with_(RAW_RECORDS, CLASSIFIED) + """
SELECT pos // 1000 AS chunk, row_number() OVER (PARTITION BY pos // 1000 ORDER BY pos) - 1 AS pos, label, md5(item) AS text_md5
FROM classified"""
ORACLE["s1_read_large_array"] = with_(RAW_RECORDS, CLASSIFIED) + """
SELECT pos // 100000 AS chunk, row_number() OVER (PARTITION BY pos // 100000 ORDER BY pos) - 1 AS pos, label, md5(item) AS text_md5
FROM classified"""
ORACLE["s2_read_lines"] = with_(RAW_RECORDS, CLASSIFIED) + "SELECT label, md5(item) AS text_md5, count(*) AS n FROM classified GROUP BY ALL"


def _falsy_sql(t: str, path: str) -> str:
    v = f"(item ->> '{path}')"
    return (
        f"({t} IS NULL OR {t} = 'NULL' OR ({t} = 'VARCHAR' AND {v} = '') OR ({t} = 'BOOLEAN' AND {v} = 'false')"
        f" OR ({t} IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST({v} AS DOUBLE) = 0)"
        f" OR ({t} = 'ARRAY' AND json_array_length(item, '{path}') = 0)"
        f" OR ({t} = 'OBJECT' AND len(json_keys(item, '{path}')) = 0))"
    )


def _text_sql(t: str, path: str) -> str:
    return f"CASE WHEN {t} = 'VARCHAR' THEN item ->> '{path}' ELSE CAST(json_extract(item, '{path}') AS VARCHAR) END"


_ITEMS = f"""
it AS (
  SELECT pos, item, json_type(item) = 'OBJECT' AS obj, json_type(item, '$.instruction') AS ti,
    json_type(item, '$.input') AS tn, json_type(item, '$.output') AS tout
  FROM raw_records
),
txt AS (
  SELECT pos, obj,
    CASE WHEN {_falsy_sql('ti', '$.instruction')} THEN '' ELSE {_text_sql('ti', '$.instruction')} END AS instruction,
    CASE WHEN {_falsy_sql('tn', '$.input')} THEN '' ELSE {_text_sql('tn', '$.input')} END AS input,
    CASE WHEN tout IS NULL OR tout = 'NULL' THEN NULL ELSE {_text_sql('tout', '$.output')} END AS output
  FROM it
),
stripped AS (
  SELECT pos, obj, {ustrip_sql('instruction')} AS instruction, {ustrip_sql('input')} AS input, {ustrip_sql('output')} AS output FROM txt
)"""

ORACLE["t1_items_normalize"] = with_(RAW_RECORDS, _ITEMS) + """
SELECT pos, instruction, input, output,
  CASE WHEN NOT obj THEN 'invalid_item' WHEN output IS NULL THEN 'output_missing' WHEN output = '' THEN 'output_blank' END AS drop_reason
FROM stripped"""


ORACLE["a3_sample_drops"] = with_(RAW_RECORDS, _ITEMS) + f"""
SELECT drop_reason, count(*) AS n FROM (
  SELECT CASE WHEN NOT obj THEN 'invalid_item' WHEN output IS NULL THEN 'output_missing' WHEN output = '' THEN 'output_blank'
    WHEN (instruction = '' OR instruction = {lit(SYSTEM_PROMPT)}) AND input = '' THEN 'empty_prompt' END AS drop_reason
  FROM stripped
) WHERE drop_reason IS NOT NULL GROUP BY drop_reason"""
