"""DuckDB form of the fixture and pipeline, the shared head of every oracle query.

``PIPELINE_CTES`` defines, over the ``events`` view:
``raw`` (text trips), ``typed``, ``sent`` (accepted trips), ``b`` (with
``batch_no`` and parsed time), ``f`` (features before cleaning) and ``g``
(cleaned features). The batch size is derived from the data (8 % of the raw
rows, so there are always 12 batches, the last one short).
"""

from __future__ import annotations

# Batch size rule shared with the Spark side (operators.batching.fixture_batch_size).
BATCH_SIZE_SQL = "(SELECT greatest(CAST(count(*) * 8 // 100 AS BIGINT), 1) FROM events)"

_FIX6 = ("CAST(CAST(floor({v}/1000000.0) AS BIGINT) AS VARCHAR)||'.'||"
         "lpad(CAST({v}%1000000 AS VARCHAR),6,'0')")

PIPELINE_CTES = f"""
WITH RECURSIVE m AS (
 SELECT event_id, ts, user_id, value,
  73850000 + (event_id*37) % 200000 AS plon,
  40600000 + (event_id*53) % 250000 AS plat,
  73850000 + (event_id*71) % 200000 AS dlon0,
  40600000 + (event_id*91) % 250000 AS dlat0
 FROM events),
n AS (SELECT *,
  CASE WHEN event_id%61=0 THEN 0 WHEN event_id%59=0 THEN plon ELSE dlon0 END AS dlon,
  CASE WHEN event_id%61=0 THEN 0 WHEN event_id%59=0 THEN plat ELSE dlat0 END AS dlat FROM m),
c AS (SELECT *, 250 + CAST(floor((abs(dlon0-plon)+abs(dlat0-plat))/200.0) AS BIGINT)
  + CAST(round(value*10) AS BIGINT) AS cents FROM n),
raw AS (SELECT event_id AS row_no,
  CASE WHEN event_id%11=0 THEN NULL ELSE 'k'||CAST(event_id AS VARCHAR) END AS key,
  CASE WHEN event_id%97=0 THEN '' WHEN event_id%101=0 THEN 'n/a' WHEN event_id%53=0 THEN '-2.50'
       WHEN event_id%47=0 THEN '600.00'
       ELSE CAST(CAST(floor(cents/100.0) AS BIGINT) AS VARCHAR)||'.'||lpad(CAST(cents%100 AS VARCHAR),2,'0')
  END AS fare_amount,
  CASE WHEN event_id%79=0 THEN 'garbage' ELSE strftime(ts,'%Y-%m-%d %H:%M:%S')||' UTC' END AS pickup_datetime,
  CASE WHEN event_id%83=0 THEN '' ELSE '-'||{_FIX6.format(v='plon')} END AS pickup_longitude,
  {_FIX6.format(v='plat')} AS pickup_latitude,
  CASE WHEN dlon=0 THEN '' ELSE '-' END||{_FIX6.format(v='dlon')} AS dropoff_longitude,
  {_FIX6.format(v='dlat')} AS dropoff_latitude,
  CASE WHEN event_id%89=0 THEN '1.5' ELSE CAST(user_id%9 AS VARCHAR) END AS passenger_count
 FROM c),
typed AS (SELECT row_no, coalesce(key,'row_'||CAST(row_no AS VARCHAR)) AS key,
  try_cast(fare_amount AS DOUBLE) AS fare_amount, nullif(pickup_datetime,'') AS pickup_datetime,
  try_cast(pickup_longitude AS DOUBLE) AS pickup_longitude, try_cast(pickup_latitude AS DOUBLE) AS pickup_latitude,
  try_cast(dropoff_longitude AS DOUBLE) AS dropoff_longitude, try_cast(dropoff_latitude AS DOUBLE) AS dropoff_latitude,
  CASE WHEN regexp_full_match(passenger_count,'[+-]?[0-9]+') THEN try_cast(passenger_count AS INTEGER) END
    AS passenger_count,
  CASE WHEN coalesce(fare_amount,'')='' OR coalesce(pickup_datetime,'')='' OR coalesce(pickup_longitude,'')=''
         OR coalesce(pickup_latitude,'')='' OR coalesce(dropoff_longitude,'')='' OR coalesce(dropoff_latitude,'')=''
         OR coalesce(passenger_count,'')='' THEN 'missing_field' END AS blank_reason
 FROM raw),
typed2 AS (SELECT *, coalesce(blank_reason,
  CASE WHEN fare_amount IS NULL OR pickup_datetime IS NULL OR pickup_longitude IS NULL OR pickup_latitude IS NULL
         OR dropoff_longitude IS NULL OR dropoff_latitude IS NULL OR passenger_count IS NULL THEN 'bad_value' END)
  AS reject_reason FROM typed),
sent AS (SELECT row_no, key, fare_amount, pickup_datetime, pickup_longitude, pickup_latitude,
  dropoff_longitude, dropoff_latitude, passenger_count FROM typed2 WHERE reject_reason IS NULL),
b AS (SELECT *, CAST((row_number() OVER (ORDER BY row_no) - 1) // {BATCH_SIZE_SQL} + 1 AS INTEGER) AS batch_no,
  try_strptime(pickup_datetime,'%Y-%m-%d %H:%M:%S UTC') AS pts,
  pow(sin((radians(dropoff_latitude)-radians(pickup_latitude))/2),2)
   + cos(radians(pickup_latitude))*cos(radians(dropoff_latitude))
   * pow(sin((radians(dropoff_longitude)-radians(pickup_longitude))/2),2) AS a FROM sent),
d AS (SELECT *, 2*6371*atan2(sqrt(least(a,1.0)),sqrt(1-least(a,1.0))) AS d0 FROM b),
f AS (SELECT *, CASE WHEN d0<200 THEN d0 END AS distance_km, CAST(hour(pts) AS INTEGER) AS hour,
  CAST(dayofweek(pts)+1 AS INTEGER) AS day_of_week, CAST(month(pts) AS INTEGER) AS month FROM d),
g AS (SELECT * FROM f WHERE fare_amount>0 AND fare_amount<500
  AND pickup_longitude BETWEEN -75 AND -73 AND pickup_latitude BETWEEN 40 AND 42
  AND dropoff_longitude BETWEEN -75 AND -73 AND dropoff_latitude BETWEEN 40 AND 42
  AND passenger_count>0 AND passenger_count<7 AND distance_km>0 AND distance_km<100
  AND hour IS NOT NULL AND day_of_week IS NOT NULL AND month IS NOT NULL)
"""


def with_pipeline(select_sql: str, extra_ctes: str = "") -> str:
    """Oracle text: the shared CTEs, optional extra CTEs, then the final SELECT."""
    extra = f",\n{extra_ctes.strip().rstrip(',')}\n" if extra_ctes.strip() else "\n"
    return PIPELINE_CTES.rstrip() + extra + select_sql.strip()
