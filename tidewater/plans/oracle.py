"""Independent SQL for each registered query, runnable by DuckDB on the same
tables (views ``lineitem``, ``supplier``, ``events``, ``documents`` ...).

Column names and types match the Spark side; timestamps are plain
(zone-less) TIMESTAMPs. Written for DuckDB 2.0 (``lambda x: ...`` syntax,
RE2 regular expressions, where ``$`` is the end of the text).
"""

from __future__ import annotations

from tidewater.functions.text import NEWER_WORD_RANGES

_FACT = """
fact AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_suppkey % 10 = 3 THEN l_suppkey + 1000000
              ELSE l_suppkey END AS AIRLINE,
         CASE WHEN l_returnflag = 'N' THEN NULL
              ELSE CAST(trunc(l_quantity) AS INTEGER) - 25 END AS ARRIVAL_DELAY
  FROM lineitem
)"""

_DIM = """
dim AS (
  SELECT s_suppkey AS IATA_CODE, s_name AS AIRLINE FROM supplier
  UNION ALL
  SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 10 = 5
)"""

_JOINED = f"""
WITH {_FACT}, {_DIM},
joined AS (
  SELECT f.l_orderkey, f.l_linenumber, f.AIRLINE, f.ARRIVAL_DELAY, d.AIRLINE AS AIRLINE_NAME
  FROM fact f LEFT JOIN dim d ON f.AIRLINE = d.IATA_CODE
)"""

_SUMMARY = _JOINED + """
SELECT AIRLINE_NAME,
       count(AIRLINE) AS FLIGHTS_COUNT,
       format('{:,.2f}', avg(ARRIVAL_DELAY)) AS AVG_ARRIVAL_DELAY_MINUTES
FROM joined GROUP BY AIRLINE_NAME
"""

# Stream records built from events, parsed with the consumer's fixed slice,
# split with Java's String.split(" ") rules.
_RECORDS = """
records AS (
  SELECT event_id, epoch_us(ts) AS us, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS key,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') ||
         CASE WHEN event_id % 50 = 7 THEN '   '
              WHEN event_id % 5 = 1 THEN ' ' || event_type || ' ' || props || '  '
              WHEN event_id % 5 = 2 THEN ' ' || event_type || '  ' || props
              ELSE ' ' || event_type || ' ' || props END AS value
  FROM events
)"""

_PARSED = _RECORDS + """,
parsed AS (
  SELECT strptime(substr(value, 1, 19), '%Y-%m-%dT%H:%M:%S') AS ts,
         substr(value, 27) AS message, us, event_id
  FROM records
),
words AS (
  SELECT ts, us, event_id,
         CASE WHEN message = '' THEN ['']
              WHEN regexp_full_match(message, ' +') THEN []::VARCHAR[]
              ELSE string_split(regexp_replace(message, ' +$', ''), ' ') END AS arr
  FROM parsed
),
word_rows AS (
  SELECT ts, us, event_id, unnest(arr) AS word FROM words
)"""

_COUNTS_OF = """
SELECT date_trunc('minute', ts) AS START_TIME,
       date_trunc('minute', ts) + INTERVAL 1 MINUTE AS END_TIME,
       word AS WORD, count(*) AS "COUNT"
FROM {src} GROUP BY ALL"""

_TUMBLING = "WITH " + _PARSED + _COUNTS_OF.format(src="word_rows")

_APPEND = (
    "WITH " + _PARSED + ", counts AS (" + _COUNTS_OF.format(src="word_rows") + ")\n"
    "SELECT * FROM counts\n"
    "WHERE END_TIME <= (SELECT max(ts) FROM parsed) - INTERVAL 1 MINUTE"
)

# Late rows: events split at the thirds of their time range; the first third
# arrives after the watermark has passed it and is dropped.
_LATE = (
    "WITH " + _PARSED + """,
bounds AS (SELECT min(us) AS lo, max(us) AS hi FROM records),
kept AS (
  SELECT ts, word FROM word_rows, bounds WHERE us >= lo + (hi - lo) // 3
),
counts AS (""" + _COUNTS_OF.format(src="kept") + """)
SELECT * FROM counts
WHERE END_TIME <= (SELECT max(ts) FROM parsed) - INTERVAL 1 MINUTE"""
)

# State left open: the first two thirds of the events, watermark three days behind.
_OPEN = (
    "WITH " + _PARSED + """,
bounds AS (SELECT min(us) AS lo, max(us) AS hi FROM records),
seen AS (
  SELECT ts, us, word FROM word_rows, bounds WHERE us < lo + 2 * ((hi - lo) // 3)
),
counts AS (""" + _COUNTS_OF.format(src="seen") + """)
SELECT * FROM counts WHERE END_TIME > (SELECT max(ts) FROM seen) - INTERVAL 3 DAY"""
)

# Corpus lines in (doc_id, line_no) order, tokenised on Unicode word runs.
_CORPUS = r"""
corpus AS (
  SELECT doc_id,
         CASE WHEN doc_id % 7 = 0 THEN text || chr(10) || ' --- ' || chr(10) || chr(10)
              ELSE text END AS text
  FROM documents
)"""

# Letters and numbers newer than the engine's tables, as on the Spark side.
_NEWER = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in NEWER_WORD_RANGES)

_LINES = _CORPUS + r""",
split AS (
  SELECT doc_id,
         regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') AS ls
  FROM corpus
),
lines AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line
  FROM split
),
tokens AS (
  SELECT doc_id, line_no,
         list_filter(regexp_split_to_array(line, '[^\p{L}\p{N}_""" + _NEWER + r"""]+'), lambda x: x <> '') AS toks
  FROM lines
),
token_text AS (
  SELECT doc_id, line_no, CAST(len(toks) AS INTEGER) AS n_tokens,
         array_to_string(toks, ' ') AS words
  FROM tokens
)"""

_MESSAGES = """
SELECT doc_id, line_no{extra},
       strftime(tk, '%Y-%m-%dT%H:%M:%S.%f') AS key,
       strftime(tk, '%Y-%m-%dT%H:%M:%S.%f') || ' ' || words AS value,
       CAST(octet_length(encode(strftime(tk, '%Y-%m-%dT%H:%M:%S.%f') || ' ' || words))
            AS INTEGER) AS n_bytes
FROM {src}"""

_BASE = "TIMESTAMP '2024-01-01 00:00:00'"
_CAP = 500
_FIRST_LINES = 20_000
_ITERATIONS = 3

_REPLAYED = f"""
iterations AS (
  SELECT *, unnest(range(1, {_ITERATIONS} + 1)) AS iteration FROM token_text WHERE n_tokens > 0
),
replayed AS (
  SELECT *, {_BASE} + (iteration - 1) * INTERVAL 60 SECOND AS tk FROM iterations
)"""

ORACLE_SQL: dict[str, str] = {
    "delay_summary": _SUMMARY,
    "delay_summary_preagg": _SUMMARY,
    "delay_summary_direct": _SUMMARY,
    "document_label_summary": """
SELECT l.quality AS quality, count(d.doc_id) AS documents,
       format('{:,.2f}', avg(d.n_chars)) AS avg_chars_text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY l.quality""",
    "json_sink_roundtrip": _SUMMARY,
    "sorted_single_file": _SUMMARY,
    "csv_infer_scan": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "o_orderpriority FROM orders"
    ),
    "text_line_scan": (
        "WITH " + _CORPUS
        + r" SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM corpus"
    ),
    "csv_reject_side": """
WITH lines AS (
  SELECT *, o_orderkey % 13 AS k, CAST(o_totalprice AS DECIMAL(15,2)) AS price,
         o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' AS head
  FROM orders
)
SELECT 'good' AS side, o_orderkey, o_custkey, o_orderstatus, price AS o_totalprice, o_orderpriority,
       CAST(NULL AS VARCHAR) AS line
FROM lines WHERE k NOT IN (4, 7, 9)
UNION ALL
SELECT 'reject', NULL, NULL, NULL, NULL, NULL,
       CASE k WHEN 4 THEN head || 'n/a,' || o_orderpriority WHEN 7 THEN head || price
              ELSE head || price || ',' || o_orderpriority || ',more' END
FROM lines WHERE k IN (4, 7, 9)""",
    "select_rename": f"WITH {_DIM} SELECT IATA_CODE, AIRLINE AS AIRLINE_NAME FROM dim",
    "left_outer_join": _JOINED + "\nSELECT * FROM joined",
    "salted_outer_join": _JOINED + "\nSELECT * FROM joined",
    "count_nonnull_by_key": _JOINED
    + "\nSELECT AIRLINE_NAME, count(AIRLINE) AS FLIGHTS_COUNT FROM joined GROUP BY AIRLINE_NAME",
    "avg_by_key": _JOINED
    + """
SELECT AIRLINE_NAME,
       CAST(sum(ARRIVAL_DELAY) AS DOUBLE) / nullif(count(ARRIVAL_DELAY), 0) AS AVG_ARRIVAL_DELAY
FROM joined GROUP BY AIRLINE_NAME""",
    "derive_then_drop": "WITH "
    + _FACT
    + """
SELECT AIRLINE, count(AIRLINE) AS FLIGHTS_COUNT,
       format('{:,.2f}', avg(ARRIVAL_DELAY)) AS AVG_ARRIVAL_DELAY_MINUTES
FROM fact GROUP BY AIRLINE""",
    "format_number_2dp": """
SELECT l_orderkey, l_linenumber,
       format('{:,.2f}', l_extendedprice) AS price_text,
       format('{:,.2f}', l_extendedprice * (1 - l_discount)) AS disc_price_text,
       format('{:,.2f}', CAST(CASE WHEN l_returnflag = 'N' THEN NULL
                              ELSE CAST(trunc(l_quantity) AS INTEGER) - 25 END AS DOUBLE))
         AS delay_text
FROM lineitem""",
    "preview_limit": _JOINED
    + "\nSELECT * FROM joined ORDER BY l_orderkey, l_linenumber LIMIT 20",
    "envelope_decode": "WITH " + _RECORDS + "\nSELECT key, value FROM records",
    "record_split": "WITH " + _PARSED + "\nSELECT ts AS timestamp, message FROM parsed",
    "java_split_words": "WITH "
    + _PARSED
    + """
SELECT ts AS timestamp, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos,
       unnest(arr) AS WORD
FROM words""",
    "record_word_counts": "WITH "
    + _PARSED
    + '\nSELECT word AS WORD, count(*) AS "COUNT" FROM word_rows GROUP BY word',
    "first_space_word_counts": "WITH " + _RECORDS + """,
msgs AS (SELECT substr(value, strpos(value, ' ') + 1) AS message FROM records),
words AS (
  SELECT unnest(CASE WHEN message = '' THEN ['']
                     WHEN regexp_full_match(message, ' +') THEN []::VARCHAR[]
                     ELSE string_split(regexp_replace(message, ' +$', ''), ' ') END) AS word
  FROM msgs
)
SELECT word AS WORD, count(*) AS "COUNT" FROM words GROUP BY word""",
    "tumbling_counts": _TUMBLING,
    "stream_counts_complete": _TUMBLING,
    "stream_counts_append": _APPEND,
    "stream_restart": _APPEND,
    "stream_one_partition": "SELECT *, 1 AS files FROM (" + _APPEND + ") t",
    "stream_counts_batches": _APPEND,
    "stream_counts_tiered": _TUMBLING,
    "stream_open_state": _OPEN,
    "stream_quarantine": "WITH " + _PARSED + """
SELECT 'word' AS side, word AS text, CAST(count(*) AS BIGINT) AS n
FROM word_rows WHERE event_id % 9 <> 4 GROUP BY word
UNION ALL
SELECT 'malformed', substr(value, 1, 12), count(*) FROM records WHERE event_id % 9 = 4
GROUP BY substr(value, 1, 12)""",
    "stream_late_rows": _LATE,
    "stream_late_rows_single": _LATE,
    "numbered_lines": "WITH " + _LINES + """
SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS number, line FROM lines""",
    "first_n_selected": f"""
SELECT l_returnflag, l_shipdate, l_linenumber, count(*) AS n FROM (
  SELECT * FROM lineitem ORDER BY l_returnflag, l_shipdate, l_linenumber LIMIT {_FIRST_LINES}
) t GROUP BY ALL""",
    "stream_late_side": "WITH " + _PARSED + """,
bounds AS (SELECT min(us) AS lo, max(us) AS hi FROM records),
sided AS (
  SELECT ts, word, CASE WHEN us >= lo + (hi - lo) // 3 THEN 'counted' ELSE 'late' END AS side FROM word_rows, bounds
)
SELECT side, date_trunc('minute', ts) AS START_TIME, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS END_TIME,
       word AS WORD, count(*) AS "COUNT"
FROM sided GROUP BY ALL""",
    "tokenize_lines": "WITH " + _LINES + "\nSELECT * FROM token_text",
    "drop_empty_lines": "WITH " + _LINES + "\nSELECT * FROM token_text WHERE n_tokens > 0",
    "first_n_messages": "WITH "
    + _LINES
    + f""",
capped AS (
  SELECT *, {_BASE} AS tk FROM token_text WHERE n_tokens > 0
  ORDER BY doc_id, line_no LIMIT {_CAP}
)"""
    + _MESSAGES.format(extra="", src="capped"),
    "build_messages": "WITH "
    + _LINES
    + f""",
msgs AS (SELECT *, {_BASE} AS tk FROM token_text WHERE n_tokens > 0)"""
    + _MESSAGES.format(extra="", src="msgs"),
    "message_frames": "WITH "
    + _LINES
    + f""",
msgs AS (
  SELECT doc_id, line_no, strftime({_BASE}, '%Y-%m-%dT%H:%M:%S.%f') AS key,
         strftime({_BASE}, '%Y-%m-%dT%H:%M:%S.%f') || ' ' || words AS value
  FROM token_text WHERE n_tokens > 0
)
SELECT *, md5(value) AS value_md5 FROM msgs""",
    "messages_delivered_once": "WITH "
    + _LINES
    + f"""
SELECT doc_id, line_no, strftime({_BASE}, '%Y-%m-%dT%H:%M:%S.%f') AS key,
       strftime({_BASE}, '%Y-%m-%dT%H:%M:%S.%f') || ' ' || words AS value
FROM token_text WHERE n_tokens > 0""",
    "timed_replay": "WITH "
    + _LINES
    + ","
    + _REPLAYED
    + _MESSAGES.format(extra=", CAST(iteration AS INTEGER) AS iteration", src="replayed"),
    "replay_counts": "WITH "
    + _LINES
    + ","
    + _REPLAYED
    + """
SELECT CAST(iteration AS INTEGER) AS iteration, tk AS time_key, count(*) AS lines_sent
FROM replayed GROUP BY ALL""",
}
