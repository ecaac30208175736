"""DuckDB statements of the same results (views named after the test tables)."""

from __future__ import annotations

# Search log derived from lineitem (see ``inputs.search_log``).
SEARCHES = """
li AS (
  SELECT *, CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR) AS tier FROM lineitem
),
li2 AS (
  SELECT *,
    CASE WHEN l_quantity >= 48 THEN 'x'
         WHEN l_returnflag = 'R' THEN tier || '.0'
         ELSE tier END AS rank_text
  FROM li
),
searches AS (
  SELECT
    CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(day(l_shipdate) AS INTEGER) AS day,
    'S' || CAST(l_orderkey AS VARCHAR) AS res_sessionID,
    'H' || CAST(l_suppkey AS VARCHAR) AS hotel_id,
    'R' || CAST(l_partkey AS VARCHAR) AS id,
    CAST(CASE
      WHEN l_linenumber = 7 THEN [{'id': NULL::VARCHAR, 'type': 'NONE', 'value': l_linestatus}]
      WHEN l_linenumber = 6 THEN []
      WHEN l_linenumber = 3 AND l_linestatus = 'F' THEN NULL
      WHEN l_linenumber = 4 THEN [
        {'id': 'CLIENT_RATE_TYPE', 'type': 'OTHER', 'value': l_returnflag},
        {'id': 'CLIENT_RATE_SORTED_RANK', 'type': 'CLIENT_RATE_SORTED_RANK', 'value': rank_text}]
      WHEN l_linenumber = 5 THEN [
        {'id': 'CLIENT_RATE_TYPE', 'type': 'CLIENT_RATE_TYPE', 'value': NULL::VARCHAR},
        {'id': 'CLIENT_RATE_TYPE', 'type': 'CLIENT_RATE_TYPE', 'value': l_returnflag},
        {'id': 'PROMO', 'type': 'PROMO', 'value': 'x'},
        {'id': 'CLIENT_RATE_SORTED_RANK', 'type': 'CLIENT_RATE_SORTED_RANK', 'value': rank_text}]
      ELSE [
        {'id': 'CLIENT_RATE_TYPE', 'type': 'CLIENT_RATE_TYPE', 'value': l_returnflag},
        {'id': 'CLIENT_RATE_SORTED_RANK', 'type': 'CLIENT_RATE_SORTED_RANK', 'value': rank_text},
        {'id': 'CHANNEL', 'type': 'CHANNEL', 'value': l_linestatus}]
    END AS STRUCT(id VARCHAR, type VARCHAR, value VARCHAR)[]) AS labels
  FROM li2
),
rate_lookup AS (
  SELECT 'R' || CAST(p_partkey AS VARCHAR) AS rate_id,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END AS new_rate_bucket
  FROM part WHERE p_size <= 40
),
responses AS (
  SELECT DISTINCT s.year, s.month, s.day, s.res_sessionID, s.id AS rate_id, s.hotel_id,
         coalesce(r.new_rate_bucket, 'OTHER') AS new_rate_bucket, s.labels
  FROM searches s LEFT JOIN rate_lookup r ON s.id = r.rate_id
)"""

KEEP_LABELS = """((len(labels) = 1 AND labels[1].id IS NULL)
   OR len(list_filter(labels, lambda l: l.id = l.type AND l.id IN ('CLIENT_RATE_TYPE', 'CLIENT_RATE_SORTED_RANK'))) > 0)"""
RATE_TYPE_VALUE = "list_filter(labels, lambda l: l.id = 'CLIENT_RATE_TYPE' AND l.type = 'CLIENT_RATE_TYPE' AND l.value IS NOT NULL)[1].value"
RANK_VALUE = "list_filter(labels, lambda l: l.id = 'CLIENT_RATE_SORTED_RANK' AND l.type = 'CLIENT_RATE_SORTED_RANK' AND l.value IS NOT NULL)[1].value"
TOP3 = "CASE WHEN TRY_CAST(CLIENT_RATE_SORTED_RANK AS FLOAT) BETWEEN 1 AND 3 THEN 1 ELSE 0 END"

PIVOTED = f"""
pivoted AS (
  SELECT year, month, day, res_sessionID, rate_id, hotel_id, new_rate_bucket,
         {RATE_TYPE_VALUE} AS CLIENT_RATE_TYPE,
         {RANK_VALUE} AS CLIENT_RATE_SORTED_RANK
  FROM responses WHERE {KEEP_LABELS}
),
counts AS (
  SELECT year, month, day, res_sessionID AS res_sessionId, hotel_id, new_rate_bucket, CLIENT_RATE_TYPE,
         {TOP3} AS top3_rate_flag, count(*) AS responses
  FROM pivoted GROUP BY ALL
)"""

ORACLE: dict[str, str] = {
    "scan_pruned_schema": """
SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, l_shipdate FROM lineitem""",
    "lookup_left_default": f"""
WITH {SEARCHES}
SELECT s.year, s.month, s.day, s.res_sessionID, s.hotel_id, s.id AS rate_id,
       coalesce(r.new_rate_bucket, 'OTHER') AS new_rate_bucket
FROM searches s LEFT JOIN rate_lookup r ON s.id = r.rate_id""",
    "distinct_rows": f"""
WITH {SEARCHES}
SELECT year, month, day, res_sessionID, rate_id, hotel_id, new_rate_bucket,
       CASE WHEN labels IS NULL THEN NULL ELSE array_to_string(list_transform(labels,
         lambda l: concat_ws(':', coalesce(l.id, '~'), coalesce(l.type, '~'), coalesce(l.value, '~'))), '|') END AS labels_text
FROM responses""",
    "label_pivot": f"""
WITH {SEARCHES},
grp AS (SELECT DISTINCT year, month, day, res_sessionID, hotel_id, id, labels FROM searches WHERE {KEEP_LABELS})
SELECT year, month, day, res_sessionID, hotel_id, id AS rate_id,
       {RATE_TYPE_VALUE} AS CLIENT_RATE_TYPE, {RANK_VALUE} AS CLIENT_RATE_SORTED_RANK
FROM grp""",
    "label_pivot_sessions": f"""
WITH {SEARCHES},
e AS (
  SELECT res_sessionID, concat_ws('|', id, hotel_id, array_to_string(list_transform(labels,
           lambda l: concat_ws(':', coalesce(l.id, '~'), coalesce(l.type, '~'), coalesce(l.value, '~'))), '|')) AS place,
         unnest(labels) AS l, generate_subscripts(labels, 1) AS pos, len(labels) AS n
  FROM searches),
f AS (SELECT *, row_number() OVER (PARTITION BY res_sessionID, l.id ORDER BY l.value IS NULL, place, pos) AS rn FROM e
      WHERE (l.id IS NULL AND n = 1) OR (l.id = l.type AND l.id IN ('CLIENT_RATE_TYPE', 'CLIENT_RATE_SORTED_RANK')))
SELECT res_sessionID,
       max(l.value) FILTER (rn = 1 AND l.id = 'CLIENT_RATE_TYPE') AS CLIENT_RATE_TYPE,
       max(l.value) FILTER (rn = 1 AND l.id = 'CLIENT_RATE_SORTED_RANK') AS CLIENT_RATE_SORTED_RANK
FROM f GROUP BY res_sessionID""",
    "top_n_flag": f"""
WITH {SEARCHES}, {PIVOTED.strip().rstrip(',')}
SELECT year, month, day, res_sessionID, rate_id, hotel_id, new_rate_bucket, CLIENT_RATE_TYPE, CLIENT_RATE_SORTED_RANK,
       {TOP3} AS top3_rate_flag
FROM pivoted""",
    "rate_counts": f"""
WITH {SEARCHES}, {PIVOTED}
SELECT * FROM counts""",
    "rate_summary": f"""
WITH {SEARCHES}, {PIVOTED}
SELECT year, month, day, CLIENT_RATE_TYPE, top3_rate_flag, CAST(sum(responses) AS BIGINT) AS total_responses
FROM counts GROUP BY ALL""",
    "rate_summary_csv": f"""
WITH {SEARCHES}, {PIVOTED}
SELECT year, month, day, CLIENT_RATE_TYPE, top3_rate_flag, CAST(sum(responses) AS BIGINT) AS total_responses
FROM counts GROUP BY ALL""",
    "availability_job": f"""
WITH {SEARCHES}, {PIVOTED}
SELECT year, month, day, CLIENT_RATE_TYPE, top3_rate_flag, CAST(sum(responses) AS BIGINT) AS total_responses
FROM counts WHERE year BETWEEN 1996 AND 2000 GROUP BY ALL""",
    "partitioned_roundtrip": f"""
WITH {SEARCHES}, {PIVOTED}
SELECT * FROM counts WHERE year >= 1997 AND month <= 6 AND day BETWEEN 10 AND 20""",
}
