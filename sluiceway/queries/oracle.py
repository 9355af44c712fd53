"""DuckDB SQL for every registered query, written from the definitions alone."""

from sluiceway.queries.inputs import FIXED_TIME_TEXT

_NAMES = """
    SELECT concat_ws('-', conv_id, turn, place) AS message_id,
           word || CASE WHEN place % 7 = 0 THEN chr(128512) ELSE '' END AS name
    FROM (SELECT conv_id, turn, unnest(words) AS word, unnest(range(len(words))) AS place
          FROM (SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations))
    WHERE word <> ''
"""

# Whether a name is short: UTF-16 units, of which a character outside the BMP has two.
_SHORT = """
    length(name) + length(regexp_replace(name, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) < 5
"""

_USERS = """
    SELECT CAST(c_custkey AS VARCHAR) AS id,
           split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name
    FROM customer
"""

_DOCUMENT_USERS = """
    SELECT CAST(doc_id AS VARCHAR) AS id, lang AS first_name, text AS last_name
    FROM documents
"""

_DOCUMENT_WORDS = "SELECT doc_id, string_split(text, ' ')[2] AS word FROM documents"

_ROUTED = f"""
    SELECT message_id, name, left(name, 1) AS route
    FROM ({_NAMES})
    WHERE {_SHORT} AND (starts_with(name, 'A') OR starts_with(name, 'B'))
"""


def _time_text(column: str, fraction_digits: int) -> str:
    if fraction_digits == 0:
        return f"strftime({column}, '%Y-%m-%dT%H:%M:%SZ')"
    # Six digits, cut in groups of three while the last group is zero.
    text = f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f')"
    if fraction_digits == 3:
        text = f"left({text}, 23)"
    text = f"regexp_replace({text}, '(\\.\\d{{3}})000$', '\\1')"
    return f"regexp_replace({text}, '\\.000$', '') || 'Z'"


def _varint_hex(n: str) -> str:
    """Hexadecimal varint of a number below 2^28."""
    low = [f"format('{{:02X}}', ({n}) // {128**i} % 128 + 128)" for i in range(3)]
    last = [f"format('{{:02X}}', ({n}) // {128**i})" for i in range(4)]
    return f"""CASE WHEN ({n}) < {128} THEN {last[0]}
        WHEN ({n}) < {128**2} THEN {low[0]} || {last[1]}
        WHEN ({n}) < {128**3} THEN {low[0]} || {low[1]} || {last[2]}
        ELSE {low[0]} || {low[1]} || {low[2]} || {last[3]} END"""


def _avro_hex(users: str) -> str:
    fields = (
        f"({_varint_hex(f'2 * strlen({c})')}) || hex({c})" for c in ("id", "first_name", "last_name")
    )
    return f"SELECT id, {' || '.join(fields)} AS payload_hex FROM ({users})"


def _protobuf_hex(users: str) -> str:
    fields = (
        f"'{tag}' || ({_varint_hex(f'strlen({c})')}) || hex({c})"
        for tag, c in (("0A", "id"), ("12", "first_name"), ("1A", "last_name"))
    )
    return f"SELECT id, {' || '.join(fields)} AS payload_hex FROM ({users})"


_ORDER_LINES = """
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_linestatus = 'F' AS closed,
           CASE WHEN l_discount <> 0 THEN l_discount END AS discount, l_returnflag AS flag,
           l_partkey AS part_key, CASE WHEN l_suppkey % 3 <> 0 THEN -l_suppkey END AS supp_key,
           CASE WHEN l_discount = 0 THEN l_quantity ELSE l_tax END AS first_amount,
           CASE WHEN l_discount = 0 THEN l_extendedprice END AS second_amount,
           coalesce(array_to_string(range(-3, l_linenumber - 4), ','), '') AS numbers
"""

ORACLE_SQL: dict[str, str] = {
    "publish_greetings": f"""
        SELECT message_id, hex('Hello ' || name || '!') AS payload_hex, name AS first_name,
               '{FIXED_TIME_TEXT}' AS publish_time
        FROM ({_NAMES})""",
    "published_ids": f"SELECT count(*) AS ids, count(*) AS distinct_ids FROM ({_NAMES})",
    "read_subscription": f"""
        SELECT CAST(doc_id AS VARCHAR) AS message_id, md5(text) AS payload_md5, lang,
               '{FIXED_TIME_TEXT}' AS publish_time
        FROM documents""",
    "read_topic_from_now": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id, event_type,
               {_time_text('ts', 6)} AS publish_time
        FROM events WHERE ts >= TIMESTAMP '2024-01-15 03:04:05'""",
    "bytes_to_text": "SELECT conv_id, turn, text FROM conversations",
    "extract_names": _NAMES,
    "extract_names_documents": f"""
        SELECT CAST(doc_id AS VARCHAR) AS message_id,
               CASE WHEN word <> '' THEN left(word, length(word) - 1) END AS name,
               word IS NULL OR word = '' AS malformed
        FROM ({_DOCUMENT_WORDS})""",
    "short_names": f"SELECT message_id, name FROM ({_NAMES}) WHERE {_SHORT}",
    "short_names_documents": f"""
        SELECT message_id, name
        FROM (SELECT CAST(doc_id AS VARCHAR) AS message_id, left(word, length(word) - 1) AS name
              FROM ({_DOCUMENT_WORDS}) WHERE word <> '')
        WHERE {_SHORT}""",
    "route_a": f"SELECT message_id, name FROM ({_ROUTED}) WHERE route = 'A'",
    "route_b": f"SELECT message_id, name FROM ({_ROUTED}) WHERE route = 'B'",
    "route_counts": f"SELECT route, name, count(*) AS names FROM ({_ROUTED}) GROUP BY route, name",
    "name_rows": f"""
        SELECT message_id, route, name, '{FIXED_TIME_TEXT}' AS timestamp FROM ({_ROUTED})""",
    "stream_route_two_sinks": f"""
        SELECT name, '{FIXED_TIME_TEXT}' AS timestamp,
               CASE route WHEN 'A' THEN 'a_names' ELSE 'b_names' END AS sink
        FROM ({_ROUTED})""",
    "stream_route_to_folder": f"""
        SELECT name, '{FIXED_TIME_TEXT}' AS timestamp, route FROM ({_ROUTED})""",
    "stream_route_text_time": f"""
        SELECT name, '{FIXED_TIME_TEXT}' AS timestamp,
               CASE route WHEN 'A' THEN 'a_names' ELSE 'b_names' END AS sink
        FROM ({_ROUTED})""",
    "route_documents_quarantine": f"""
        SELECT CASE WHEN word IS NULL OR word = '' THEN 'malformed'
                    WHEN starts_with(name, 'A') THEN 'a_names' ELSE 'b_names' END AS sink,
               CASE WHEN word IS NULL OR word = '' THEN md5(text) ELSE name END AS value
        FROM (SELECT *, left(word, length(word) - 1) AS name
              FROM (SELECT text, string_split(text, ' ')[2] AS word FROM documents))
        WHERE word IS NULL OR word = ''
           OR ({_SHORT} AND (starts_with(name, 'A') OR starts_with(name, 'B')))""",
    "read_subscription_late_files": f"""
        SELECT CAST(doc_id AS VARCHAR) AS message_id, md5(text) AS payload_md5 FROM documents""",
    "ingest_avro_from_now": f"""
        SELECT *, '{FIXED_TIME_TEXT}' AS timestamp FROM ({_USERS})
        WHERE CAST(id AS BIGINT) % 2 <> 0""",
    "ingest_avro_quarantine": f"""
        SELECT id AS value, first_name, last_name, 'user_messages' AS sink FROM ({_USERS})
        WHERE CAST(id AS BIGINT) % 10 <> 0
        UNION ALL
        SELECT left(payload_hex, length(payload_hex) - 2), NULL, NULL, 'truncated payload'
        FROM ({_avro_hex(_USERS)}) WHERE CAST(id AS BIGINT) % 10 = 0""",
    "messages_from_columns": f"""
        SELECT CAST(doc_id AS VARCHAR) AS message_id, md5(text) AS payload_md5, lang,
               '{FIXED_TIME_TEXT}' AS publish_time
        FROM documents""",
    "avro_encode": _avro_hex(_USERS),
    "avro_encode_documents": _avro_hex(_DOCUMENT_USERS),
    "proto_encode": _protobuf_hex(_USERS),
    "proto_encode_documents": _protobuf_hex(_DOCUMENT_USERS),
    "avro_decode": _USERS,
    "avro_decode_documents": _DOCUMENT_USERS,
    "proto_decode": f"""
        SELECT id, first_name AS "firstName", last_name AS "lastName" FROM ({_USERS})""",
    "proto_decode_documents": f"""
        SELECT id, first_name AS "firstName", last_name AS "lastName" FROM ({_DOCUMENT_USERS})""",
    "ingest_avro": f"""
        SELECT *, '{FIXED_TIME_TEXT}' AS timestamp FROM ({_USERS})
        WHERE CAST(id AS BIGINT) % 2 <> 0""",
    "ingest_proto": f"SELECT *, '{FIXED_TIME_TEXT}' AS timestamp FROM ({_USERS})",
    "insert_and_select": f"SELECT name, '{FIXED_TIME_TEXT}' AS timestamp FROM ({_NAMES})",
    "insert_reports": f"""
        SELECT 'fits' AS insert, count(*) AS rows, false AS has_errors FROM ({_NAMES})
        UNION ALL SELECT 'missing column', count(*), false FROM ({_NAMES})
        UNION ALL SELECT unnest(['extra column', 'other type', 'too long', 'out of range']), 0, true
        UNION ALL SELECT 'some too long', count(*) FILTER (length(name) <= 3), true FROM ({_NAMES})""",
    "insert_refusals": f"""
        SELECT 'inserted' AS what, name FROM ({_NAMES}) WHERE length(name) <= 3 AND strlen(name) <= 2
        UNION ALL
        SELECT 'name: longer than varchar(3)', name FROM ({_NAMES}) WHERE length(name) > 3
        UNION ALL
        SELECT 'number: out of the range of int', name FROM ({_NAMES}) WHERE strlen(name) > 2""",
    "processing_time_text": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id, {_time_text('ts', 0)} AS to_second,
               {_time_text('ts', 3)} AS to_millisecond, {_time_text('ts', 6)} AS to_microsecond
        FROM events""",
    "user_ids": f"""
        SELECT id AS customer, first_name, last_name, true AS is_uuid FROM ({_USERS})""",
    "avro_records": f"""
        {_ORDER_LINES}, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS shipped FROM lineitem""",
    "proto_records": f"{_ORDER_LINES} FROM lineitem",
    "ingest_order_lines": f"""
        SELECT 'order_lines' AS sink, l_orderkey AS order_key, l_linenumber AS line_number,
               '{FIXED_TIME_TEXT}' AS time
        FROM lineitem WHERE l_orderkey % 7 <> 0
        UNION ALL
        SELECT 'bytes follow the Avro datum', count(*), NULL, NULL
        FROM lineitem WHERE l_orderkey % 7 = 0""",
    "ingest_proto_quarantine": f"""
        SELECT CASE WHEN CAST(id AS BIGINT) % 10 = 0 THEN 'truncated payload'
                    WHEN CAST(id AS BIGINT) % 11 = 0 THEN 'a Protobuf payload lacks a required field'
                    ELSE 'user_messages' END AS sink,
               CASE WHEN CAST(id AS BIGINT) % 10 = 0 THEN left(payload_hex, length(payload_hex) - 2)
                    WHEN CAST(id AS BIGINT) % 11 = 0
                    THEN left(payload_hex, length(payload_hex) - 2 * strlen(split_part(c_name, '#', 2)) - 4)
                    ELSE id END AS value
        FROM ({_protobuf_hex(_USERS)}) JOIN customer ON CAST(c_custkey AS VARCHAR) = id""",
    "read_log_from_now": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id, event_type,
               {_time_text('ts', 6)} AS publish_time
        FROM events WHERE event_id % 4 <> 0""",
    "ingest_log_from_now": f"""
        SELECT *, '{FIXED_TIME_TEXT}' AS timestamp FROM ({_USERS})
        WHERE CAST(id AS BIGINT) % 2 <> 0""",
    "route_accounting": f"""
        WITH words AS (
            SELECT name FROM ({_NAMES})
            UNION ALL
            SELECT CASE WHEN word <> '' THEN left(word, length(word) - 1) END FROM ({_DOCUMENT_WORDS})
        ), fates AS (
            SELECT CASE WHEN name IS NULL THEN 'malformed' WHEN NOT ({_SHORT}) THEN 'rejected'
                        WHEN starts_with(name, 'A') THEN 'a' WHEN starts_with(name, 'B') THEN 'b'
                        ELSE 'unrouted' END AS fate
            FROM words
        )
        SELECT what, n FROM (
            UNPIVOT (SELECT count(*) AS messages, count(*) FILTER (fate = 'a') AS a,
                            count(*) FILTER (fate = 'b') AS b,
                            count(*) FILTER (fate = 'rejected') AS rejected,
                            count(*) FILTER (fate = 'unrouted') AS unrouted,
                            count(*) FILTER (fate = 'malformed') AS malformed,
                            count(*) FILTER (fate = 'a') AS "stored a",
                            count(*) FILTER (fate = 'b') AS "stored b",
                            count(*) FILTER (fate = 'malformed') AS "stored malformed" FROM fates)
            ON COLUMNS(*) INTO NAME what VALUE n)""",
    "redelivered_once": "SELECT CAST(event_id AS VARCHAR) AS message_id, event_type FROM events",
    "element_times": """
        SELECT l_returnflag, count(*) AS rows, true AS many_times, true AS are_now
        FROM lineitem GROUP BY l_returnflag""",
    "route_replayed_once": f"""
        SELECT name, '{FIXED_TIME_TEXT}' AS timestamp,
               CASE route WHEN 'A' THEN 'a_names' ELSE 'b_names' END AS sink
        FROM ({_ROUTED})""",
    "published_stream": """
        SELECT event_type, count(*) AS messages, count(*) AS ids FROM events GROUP BY event_type""",
}
