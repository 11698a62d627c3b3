"""Independent SQL for the registered queries, over the same tables."""

from __future__ import annotations

QUOTES = """
quotes AS (
  SELECT
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN user_id % 4 = 0 THEN ' eur '
         WHEN user_id % 4 = 1 THEN 'Brl' ELSE 'usd' END AS moneda,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'view' THEN ' Oficial'
         WHEN event_type = 'click' THEN 'BLUE' WHEN event_type = 'purchase' THEN 'bolsa'
         WHEN event_type = 'signup' THEN 'Cripto' ELSE 'tarjeta ' END AS casa,
    CASE WHEN event_id % 103 = 0 THEN NULL ELSE concat('casa ', event_type) END AS nombre,
    CASE WHEN event_id % 89 = 0 THEN 'n/d' WHEN event_id % 79 = 0 THEN NULL
         ELSE CAST(floor(value * 4) / 4 AS VARCHAR) END AS compra,
    CAST(floor(value * 5) / 4 - (event_id % 7) AS VARCHAR) AS venta,
    CASE WHEN event_id % 83 = 0 THEN 'garbage' WHEN event_id % 73 = 0 THEN NULL
         ELSE concat(replace(CAST(date_trunc('hour', ts) AS VARCHAR), ' ', 'T'), '.000Z')
         END AS "fechaActualizacion",
    props AS raw_json,
    concat(replace(CAST(ts AS VARCHAR), ' ', 'T'), '+00:00') AS fecha_ingesta,
    CASE WHEN event_id % 3 = 0 THEN 'dolares' ELSE 'cotizaciones' END AS origen_datos,
    CASE WHEN event_id % 3 = 0 THEN '/v1/dolares' ELSE '/v1/cotizaciones' END AS endpoint,
    'full' AS modo_extraccion,
    'b0' AS batch_id
  FROM events
)"""

TEXTS = 'moneda, casa, nombre, compra, venta, "fechaActualizacion"'
BRONZE = f"{TEXTS}, raw_json, fecha_ingesta, origen_datos, endpoint, modo_extraccion, batch_id"
KEYS = 'origen_datos, casa, moneda, "fechaActualizacion"'
QUOTED_AT = 'TRY_CAST("fechaActualizacion" AS TIMESTAMP)'


def _cleaned(bronze: str) -> str:
    """CTEs from Bronze-shaped rows to flagged and to deduplicated quotes."""
    return f"""
typed AS (
  SELECT origen_datos AS source, endpoint, modo_extraccion AS ingest_mode, batch_id,
    coalesce(upper(trim(moneda, ' ')), 'N/A') AS currency,
    coalesce(lower(trim(casa, ' ')), 'desconocida') AS venue,
    coalesce(array_to_string(list_transform(string_split(lower(trim(nombre, ' ')), ' '),
             lambda w: upper(w[1]) || w[2:]), ' '), 'N/A') AS venue_label,
    TRY_CAST(compra AS DOUBLE) AS bid, TRY_CAST(venta AS DOUBLE) AS ask,
    coalesce({QUOTED_AT}, TIMESTAMP '1900-01-01 00:00:00') AS quoted_at,
    TRY_CAST(fecha_ingesta AS TIMESTAMP) AS ingested_at,
    raw_json
  FROM {bronze}
),
flagged AS (
  SELECT concat_ws('|', source, venue, currency, CAST(quoted_at AS VARCHAR)) AS quote_key,
    source, endpoint, ingest_mode, batch_id, currency, venue, venue_label, bid, ask,
    ask - bid AS spread, (ask + bid) / 2.0 AS mid,
    CASE WHEN bid > 0 THEN (ask - bid) / bid * 100.0 END AS spread_pct,
    CASE venue WHEN 'oficial' THEN 'regulado,banco,bcra' WHEN 'blue' THEN 'paralelo,informal'
      WHEN 'bolsa' THEN 'financiero,merval,mep'
      WHEN 'contadoconliqui' THEN 'financiero,ccl,bursatil'
      WHEN 'mayorista' THEN 'regulado,interbancario' WHEN 'cripto' THEN 'digital,crypto'
      WHEN 'tarjeta' THEN 'regulado,impuesto,turismo' ELSE 'otro' END AS market_tags,
    quoted_at, ingested_at,
    NOT (bid IS NULL OR ask IS NULL OR bid < 0 OR ask < 0 OR ask < bid
         OR quoted_at = TIMESTAMP '1900-01-01 00:00:00') AS quality_ok,
    CAST(year(quoted_at) AS INTEGER) AS year, CAST(month(quoted_at) AS INTEGER) AS month,
    CAST(day(quoted_at) AS INTEGER) AS day, raw_json
  FROM typed
),
silver AS (
  SELECT * FROM flagged
  QUALIFY row_number() OVER (PARTITION BY quote_key ORDER BY ingested_at DESC NULLS LAST,
    batch_id DESC NULLS LAST, raw_json DESC NULLS LAST) = 1
)"""


def _latest(quotes: str) -> str:
    return f"""
latest AS (
  SELECT * FROM {quotes}
  WHERE quality_ok AND ((currency = 'USD' AND source = 'dolares') OR currency <> 'USD')
  QUALIFY row_number() OVER (PARTITION BY venue, currency ORDER BY quoted_at DESC,
    ingested_at DESC NULLS LAST, quote_key DESC) = 1
)"""


GAP = """
SELECT l.venue, l.venue_label, l.currency, l.ask, o.ask AS official_ask,
  CASE WHEN l.currency = 'USD' AND o.ask > 0 THEN (l.ask - o.ask) / o.ask * 100.0 END
    AS official_gap_pct,
  l.spread, l.spread_pct, l.quoted_at
FROM latest l JOIN (SELECT ask FROM latest WHERE venue = 'oficial' AND currency = 'USD') o ON true
"""

DAILY = """
SELECT *, max_ask - min_ask AS ask_range FROM (
  SELECT year, month, day, venue, currency, source, count(*) AS quotes, avg(bid) AS avg_bid,
    min(ask) AS min_ask, max(ask) AS max_ask, avg(ask) AS avg_ask, avg(spread) AS avg_spread
  FROM silver WHERE quality_ok GROUP BY ALL)
"""

CLEAN = f"WITH {QUOTES}, {_cleaned('quotes')}"

_NEWEST = f"""QUALIFY row_number() OVER (PARTITION BY {KEYS}
  ORDER BY fecha_ingesta DESC, raw_json DESC) = 1"""
BATCHES = f"""{QUOTES},
first_batch AS (
  SELECT * FROM quotes WHERE fecha_ingesta < '2024-01-21' {_NEWEST}
),
second_batch AS (
  SELECT * REPLACE ('b1' AS batch_id) FROM quotes WHERE fecha_ingesta >= '2024-01-11' {_NEWEST}
)"""
_SAME_KEY = " AND ".join(
    f't.{key} IS NOT DISTINCT FROM s.{key}'
    for key in ("origen_datos", "casa", "moneda", '"fechaActualizacion"')
)
MERGED = f"""
merged AS (
  SELECT * FROM second_batch UNION ALL
  SELECT * FROM first_batch t
  WHERE NOT EXISTS (SELECT 1 FROM second_batch s WHERE {_SAME_KEY})
)"""

_PAIRS = ", ".join(
    f"'{name}', " + ('"fechaActualizacion"' if name == "fechaActualizacion" else name)
    for name in ("moneda", "casa", "nombre", "compra", "venta", "fechaActualizacion")
)

# The landed lines, as Bronze rows of the load that brought them.
LANDED = f"""{QUOTES},
lines AS (
  SELECT * REPLACE (
    CAST(json_object({_PAIRS}, 'props', raw_json, 'seen', fecha_ingesta) AS VARCHAR) AS raw_json),
    fecha_ingesta AS seen
  FROM quotes
)"""

PAYLOADS = """
rendered AS (
  SELECT event_id, event_id % 12 AS shape,
    CASE WHEN event_id % 3 = 0 THEN 'dolares' ELSE 'cotizaciones' END AS source,
    event_type AS casa, concat('n', user_id) AS nombre,
    CASE WHEN event_id % 12 = 7 THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
      AS compra,
    CAST(event_id AS VARCHAR) AS venta,
    concat(strftime(ts, '%Y-%m-%d'), 'T00:00:00.000Z') AS seen
  FROM events
),
good AS (
  SELECT event_id, source, shape,
    concat('{"moneda":"USD","casa":"', casa, '","nombre":"', nombre, '","compra":',
      coalesce(compra, 'null'), ',"venta":', venta, ',"fechaActualizacion":"', seen, '"}') AS raw,
    'USD' AS moneda, casa, nombre, compra, venta, seen AS "fechaActualizacion"
  FROM rendered WHERE shape IN (0, 1, 2, 3, 7, 8)
),
bad AS (
  SELECT event_id, source, raw, reject_reason, missing
  FROM rendered JOIN (VALUES
    (2, '1', 'not_object', NULL),
    (2, NULL, 'not_object', NULL),
    (3, '{"casa":"x","moneda":"USD"}', 'missing_fields',
        'nombre,compra,venta,fechaActualizacion'),
    (4, NULL, 'empty_payload', NULL),
    (5, 'null', 'null_payload', NULL),
    (6, 'oops{', 'not_json', NULL),
    (9, NULL, 'empty_payload', NULL),
    (10, 'null' || chr(10), 'null_payload', NULL),
    (11, '1,"after":2} junk', 'not_json', NULL)
  ) AS odd(shape, raw, reject_reason, missing) USING (shape)
)"""

RESPONSES = """
responses AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'dolares' ELSE 'cotizaciones' END AS source,
    CASE WHEN event_id % 11 = 0 THEN 503 ELSE 200 END AS status,
    CASE WHEN event_id % 7 = 0 THEN 'text/html' WHEN event_id % 7 = 1 THEN ''
      ELSE 'application/json; charset=utf-8' END AS content_type,
    CASE WHEN event_id % 5 = 0 THEN substr(props, 2)
      WHEN event_id % 13 = 0 THEN chr(10) || chr(9) || props
      WHEN event_id % 13 = 1 THEN '1,"after":2} junk'
      WHEN event_id % 13 = 2 THEN props || chr(13) || chr(10)
      WHEN event_id % 13 = 3 THEN '1],[2' ELSE props END AS body
  FROM events
),
judged AS (
  SELECT *,
    CASE WHEN status <> 200 THEN concat('HTTP ', status, ': ', left(body, 200))
      WHEN NOT json_valid(body) THEN 'not_json' END AS reject_reason,
    CASE WHEN status = 200 AND json_valid(body) AND content_type = 'text/html'
      THEN 'content type text/html' END AS warning
  FROM responses
)"""

# The load in full, and an increment on top of one.
FULL = f"""{LANDED},
bronze AS (
  SELECT * REPLACE ('2024-02-01T00:00:00+00:00' AS fecha_ingesta, 'r0' AS batch_id) FROM lines
),
{_cleaned('bronze')}, {_latest('silver')}"""
INCREMENT = f"""{LANDED},
first_load AS (
  SELECT * REPLACE ('2024-02-01T00:00:00+00:00' AS fecha_ingesta, 'r0' AS batch_id)
  FROM lines WHERE seen < '2024-01-21'
),
second_load AS (
  SELECT * REPLACE ('2024-02-02T00:00:00+00:00' AS fecha_ingesta, 'r1' AS batch_id,
    'incremental' AS modo_extraccion)
  FROM lines
  WHERE seen >= '2024-01-11' AND {QUOTED_AT} > (SELECT max({QUOTED_AT}) FROM first_load)
),
bronze AS (SELECT * FROM first_load UNION ALL SELECT * FROM second_load),
{_cleaned('bronze')}, {_latest('silver')}"""

ORACLES: dict[str, str] = {
    "bronze_projection": f"""WITH {QUOTES}
SELECT {TEXTS}, CAST(json_object({_PAIRS}) AS VARCHAR) AS raw_json,
  '2024-02-01T00:00:00+00:00' AS fecha_ingesta, origen_datos, endpoint,
  'full' AS modo_extraccion, 'r0' AS batch_id
FROM quotes""",
    "typed_text": f"{CLEAN} SELECT source, currency, venue, venue_label, raw_json FROM flagged",
    "typed_numbers_times": f"{CLEAN} SELECT bid, ask, quoted_at, ingested_at FROM flagged",
    "quote_measures": f"""{CLEAN}
SELECT bid, ask, spread, mid, spread_pct, market_tags, year, month, day FROM flagged""",
    "quote_key": f"{CLEAN} SELECT quote_key, raw_json FROM flagged",
    "quality_summary": f"{CLEAN} SELECT quality_ok, count(*) AS n FROM flagged GROUP BY 1",
    "quality_rules": f"""{CLEAN}
SELECT concat_ws(',', CASE WHEN bid IS NULL THEN 'no_bid' END,
  CASE WHEN ask IS NULL THEN 'no_ask' END, CASE WHEN bid < 0 THEN 'negative_bid' END,
  CASE WHEN ask < 0 THEN 'negative_ask' END, CASE WHEN ask < bid THEN 'ask_below_bid' END,
  CASE WHEN quoted_at = TIMESTAMP '1900-01-01 00:00:00' THEN 'no_quote_time' END,
  CASE WHEN isnan(bid) THEN 'nan_bid' END, CASE WHEN isnan(ask) THEN 'nan_ask' END) AS broken,
  count(*) AS n
FROM flagged GROUP BY 1""",
    "tags_from_table": f"""{CLEAN}
SELECT quote_key, venue, CASE venue WHEN 'blue' THEN 'of click' WHEN 'bolsa' THEN 'of purchase'
  WHEN 'cripto' THEN 'of signup' ELSE 'otro' END AS market_tags, raw_json
FROM flagged""",
    "silver": f"{CLEAN} SELECT * FROM silver",
    "latest_quotes": f"{CLEAN}, {_latest('silver')} SELECT * FROM latest",
    "source_union": f"""{CLEAN}
SELECT currency, source, count(*) AS n, sum(ask) AS sum_ask FROM (
  SELECT * FROM flagged WHERE currency = 'USD' AND source = 'dolares'
  UNION ALL SELECT * FROM flagged WHERE currency <> 'USD')
GROUP BY 1, 2""",
    "daily_metrics": f"{CLEAN} {DAILY}",
    "nan_prices": f"""WITH {QUOTES},
odd AS (
  SELECT * REPLACE (CASE WHEN compra LIKE '%.5' THEN 'NaN' ELSE venta END AS venta) FROM quotes
),
{_cleaned('odd')},
counted AS (
  SELECT * REPLACE (quality_ok AND NOT coalesce(isnan(bid) OR isnan(ask), false) AS quality_ok)
  FROM silver
)
{DAILY.replace("FROM silver", "FROM counted")}""",
    "official_gap": f"{CLEAN}, {_latest('silver')} {GAP}",
    "official_gap_no_reference": f"""{CLEAN},
others AS (SELECT * FROM silver WHERE venue <> 'oficial'), {_latest('others')}
SELECT count(*) AS n FROM ({GAP})""",
    "newer_than": f"""WITH {QUOTES}
SELECT {BRONZE} FROM quotes WHERE {QUOTED_AT} > TIMESTAMP '2024-01-15 00:00:00'""",
    "high_water": f"""WITH {QUOTES}
SELECT coalesce(max({QUOTED_AT}), TIMESTAMP '2024-01-15 00:00:00') AS high_water,
  count(*) AS records
FROM quotes WHERE {QUOTED_AT} > TIMESTAMP '2024-01-15 00:00:00'""",
    "newer_than_with_ties": f"""WITH {QUOTES},
earlier AS (SELECT * FROM quotes WHERE fecha_ingesta < '2024-01-16T10:30'),
mark AS (SELECT max({QUOTED_AT}) AS at FROM earlier)
SELECT {BRONZE} FROM quotes s, mark
WHERE {QUOTED_AT} > mark."at" OR ({QUOTED_AT} = mark."at" AND NOT EXISTS (
  SELECT 1 FROM earlier t WHERE {_SAME_KEY}))""",
    "state_round_trip": f"""WITH {QUOTES}
SELECT concat(replace(CAST(max({QUOTED_AT}) AS VARCHAR), ' ', 'T'), '+00:00') AS watermark,
  'fechaActualizacion' AS watermark_field, '2024-02-01T00:00:00+00:00' AS last_run_at,
  'incremental' AS last_mode, count(*) FILTER ({QUOTED_AT} IS NULL) AS last_records
FROM quotes""",
    "upsert_quotes": f"WITH {BATCHES}, {MERGED} SELECT {BRONZE} FROM merged",
    "upsert_duplicate_matches": f"""WITH {QUOTES}
SELECT {KEYS}, count(*) AS source_rows FROM quotes s
WHERE fecha_ingesta >= '2024-01-11' AND EXISTS (
  SELECT 1 FROM quotes t WHERE t.fecha_ingesta < '2024-01-21' AND {_SAME_KEY})
GROUP BY ALL HAVING count(*) > 1""",
    "overwrite_then_merge": f"WITH {BATCHES}, {MERGED} SELECT {BRONZE} FROM merged",
    "bucketed_merge": f"WITH {BATCHES}, {MERGED} SELECT {BRONZE} FROM merged",
    "merge_changed_only": """
WITH rows AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderkey % 997 = 0 AS new
  FROM orders
)
SELECT year, month, count(*) AS orders,
  CAST(sum(cents + CASE WHEN new THEN 1 ELSE 0 END) AS BIGINT) AS cents,
  count(*) FILTER (new) AS changed, bool_or(new) AS rewritten
FROM rows GROUP BY 1, 2""",
    "evolving_merge": """
WITH rows AS (
  SELECT event_id, user_id, event_type, value, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
  FROM events
),
marked AS (
  SELECT *, event_id % 3 <> 0 AS old,
    day >= 15 AND (event_id % 3 = 0 OR event_id % 2 = 0) AS new
  FROM rows
)
SELECT event_id, CASE WHEN old THEN user_id END AS user_id,
  CASE WHEN new THEN upper(event_type) ELSE event_type END AS event_type,
  CASE WHEN new THEN value END AS value, year, month, day
FROM marked WHERE old OR new""",
    "partitioned_round_trip": f"{CLEAN} SELECT * FROM silver",
    "partition_rebuild": """
SELECT event_id, CASE WHEN day(ts) = 7 THEN value * 2 ELSE value END AS value,
  CAST(day(ts) AS INTEGER) AS day
FROM events""",
    "many_months_rebuild": """
WITH rows AS (
  SELECT event_id, event_type, value, CAST(2024 - (event_id % 720) // 12 AS INTEGER) AS year,
    CAST(12 - (event_id % 720) % 12 AS INTEGER) AS month
  FROM events
)
SELECT event_id, event_type, year, month,
  CASE WHEN bool_or(event_type = 'purchase') OVER (PARTITION BY year, month)
    THEN value * 2 ELSE value END AS value
FROM rows""",
    "partition_files": f"""{CLEAN}
SELECT year, month, venue, 1::BIGINT AS files, count(*) AS n FROM silver GROUP BY ALL""",
    "split_and_validate": f"""WITH {PAYLOADS},
outcomes AS (
  SELECT source, NULL AS reject_reason FROM good UNION ALL SELECT source, reject_reason FROM bad
)
SELECT source,
  count(*) FILTER (reject_reason IN ('null_payload', 'empty_payload', 'not_json')) AS bad_payloads,
  count(*) FILTER (reject_reason IS NULL OR reject_reason IN ('not_object', 'missing_fields'))
    AS received,
  count(*) FILTER (reject_reason IS NULL) AS valid,
  count(*) FILTER (reject_reason IN ('not_object', 'missing_fields')) AS discarded
FROM outcomes GROUP BY 1""",
    "valid_records": f"WITH {PAYLOADS} SELECT event_id, source, raw, {TEXTS} FROM good",
    "rejected_records": f"""WITH {PAYLOADS}
SELECT event_id, source, raw, reject_reason, missing FROM bad""",
    "response_envelopes": f"""WITH {RESPONSES}
SELECT event_id, reject_reason, warning FROM judged""",
    "responses_from_files": f"""WITH {RESPONSES}
SELECT source, CAST(status AS INTEGER) AS status, content_type, body, reject_reason, warning
FROM judged""",
    "landed_bodies": f"WITH {QUOTES} SELECT origen_datos AS source, {TEXTS} FROM quotes",
    "full_refresh": f"WITH {FULL} {GAP}",
    "run_counts": f"""WITH {FULL}
SELECT 'extracted' AS name, count(*) AS rows FROM lines
UNION ALL SELECT 'bronze_written', count(*) FROM lines
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold_latest', count(*) FROM latest
UNION ALL SELECT 'gold_daily_metrics', count(*) FROM ({DAILY})
UNION ALL SELECT 'gold_official_gap', count(*) FROM ({GAP})""",
    "empty_increment": f"""WITH {QUOTES}
SELECT concat(replace(CAST(max({QUOTED_AT}) AS VARCHAR), ' ', 'T'), '+00:00') AS watermark,
  'fechaActualizacion' AS watermark_field, '2024-02-02T00:00:00+00:00' AS last_run_at,
  'incremental' AS last_mode, 0::BIGINT AS last_records
FROM quotes""",
    "quarantined_records": f"""WITH {PAYLOADS}
SELECT source, replace(raw, chr(10), ' ') AS raw, reject_reason, missing, count(*) AS times,
  'r0' AS batch_id
FROM bad GROUP BY ALL""",
    "incremental_refresh": f"WITH {INCREMENT} {DAILY}",
    "incremental_silver": f"WITH {INCREMENT} SELECT * FROM silver",
    "incremental_latest": f"WITH {INCREMENT} SELECT * FROM latest",
    "incremental_gap": f"WITH {INCREMENT} {GAP}",
    "incremental_new_files": f"""WITH {LANDED}
SELECT origen_datos AS source, endpoint, raw_json AS body FROM lines WHERE seen >= '2024-01-21'""",
    "marks_per_source": f"""WITH {LANDED},
first_load AS (
  SELECT * REPLACE ('2024-02-01T00:00:00+00:00' AS fecha_ingesta, 'r0' AS batch_id) FROM lines
  WHERE seen < CASE WHEN origen_datos = 'dolares' THEN '2024-01-21' ELSE '2024-01-11' END
),
marks AS (SELECT origen_datos AS source, max({QUOTED_AT}) AS reached FROM first_load GROUP BY 1),
second_load AS (
  SELECT * EXCLUDE (source, reached) REPLACE ('2024-02-02T00:00:00+00:00' AS fecha_ingesta,
    'r1' AS batch_id, 'incremental' AS modo_extraccion)
  FROM lines JOIN marks ON source = origen_datos AND {QUOTED_AT} > reached
  WHERE seen >= '2024-01-11'
),
bronze AS (SELECT * FROM first_load UNION ALL SELECT * FROM second_load),
{_cleaned('bronze')} SELECT * FROM silver""",
    "stream_repeated_snapshots": f"""WITH {QUOTES},
polls AS (
  SELECT * FROM (VALUES (0, '2024-01-01', '2024-01-15'), (1, '2024-01-08', '2024-01-22'),
    (2, '2024-01-16', '2025')) AS p(poll, since, until)
),
snapshots AS (
  SELECT quotes.*, poll FROM quotes JOIN polls ON fecha_ingesta >= since AND fecha_ingesta < until
  QUALIFY row_number() OVER (PARTITION BY poll, {KEYS}
    ORDER BY fecha_ingesta DESC, raw_json DESC) = 1
),
kept AS (
  SELECT * FROM snapshots
  QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY poll DESC) = 1
)
SELECT {TEXTS}, CAST(json_object({_PAIRS}) AS VARCHAR) AS raw_json, origen_datos, endpoint,
  'incremental' AS modo_extraccion
FROM kept""",
    "stream_unchanged_poll": f"""WITH {QUOTES},
first_poll AS (
  SELECT * FROM quotes WHERE fecha_ingesta BETWEEN '2024-01-01' AND '2024-01-15' {_NEWEST}
),
second_poll AS (
  SELECT * FROM quotes WHERE fecha_ingesta BETWEEN '2024-01-08' AND '2024-01-22' {_NEWEST}
),
taken AS (
  SELECT (SELECT count(*) FROM first_poll) AS first, (SELECT count(*) FROM second_poll s
    WHERE NOT EXISTS (SELECT 1 FROM first_poll t WHERE {_SAME_KEY}
      AND t.nombre IS NOT DISTINCT FROM s.nombre AND t.compra IS NOT DISTINCT FROM s.compra
      AND t.venta IS NOT DISTINCT FROM s.venta)) AS second
)
SELECT 0::INTEGER AS poll, first AS extracted, first AS bronze_written FROM taken
UNION ALL SELECT 1, second, second FROM taken UNION ALL SELECT 2, 0, 0""",
    "stream_available_now": f"""WITH {BATCHES}, {MERGED}
SELECT {TEXTS}, CAST(json_object({_PAIRS}) AS VARCHAR) AS raw_json, origen_datos, endpoint,
  'incremental' AS modo_extraccion
FROM merged""",
    "latest_order_per_customer": """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""",
    "order_upsert": """
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
  coalesce(lower(s.o_orderstatus), t.o_orderstatus) AS o_orderstatus, t.o_totalprice,
  s.o_orderpriority
FROM (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) t
FULL JOIN (SELECT * FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0) s ON t.o_orderkey = s.o_orderkey""",
    "merge_duplicate_keys": """
SELECT n.event_id, t.user_id, t.event_type, n.value + 1000 AS value
FROM events t JOIN (
  SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1) n
  ON t.user_id = n.user_id AND t.event_type = n.event_type
UNION ALL SELECT event_id, user_id, event_type || ' late', value FROM events""",
    "monthly_lineitem_metrics": """
SELECT *, max_cents - min_cents AS range_cents FROM (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
    l_returnflag, count(*) AS n, avg(l_quantity) AS avg_quantity,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
    min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS min_cents,
    max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS max_cents
  FROM lineitem GROUP BY 1, 2, 3)""",
    "supplier_gap": """
SELECT s.s_suppkey, n.n_name, s.s_acctbal, r.s_acctbal AS reference_balance,
  CASE WHEN n.n_regionkey = 1 AND r.s_acctbal > 0
    THEN (s.s_acctbal - r.s_acctbal) / r.s_acctbal * 100.0 END AS gap_pct
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN supplier r ON r.s_suppkey = 1""",
}
