"""The given tables as listings: one SQL text each, valid for Spark and for DuckDB, so that both read the same input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(1998, 6, 1, 6)
AS_OF_SQL = "TIMESTAMP '1998-06-01 06:00:00'"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "registry": (("supplier", "nation"), """
SELECT concat('s', CAST(s_suppkey AS STRING)) AS id, s_name AS name,
  concat('https://', CASE WHEN s_suppkey % 7 = 0 THEN 'www.' ELSE '' END, 'site', CAST(s_suppkey % 60 AS STRING), '.example.org/') AS url, '' AS events_url,
  CASE s_suppkey % 7 WHEN 0 THEN 'gov' WHEN 1 THEN 'chamber' WHEN 2 THEN 'tourism' WHEN 3 THEN 'venue' WHEN 4 THEN 'news' WHEN 5 THEN 'social' ELSE 'aggregator' END AS category,
  CASE s_nationkey % 3 WHEN 0 THEN 'MN' WHEN 1 THEN 'WI' ELSE 'MI' END AS state,
  CASE WHEN s_nationkey % 5 = 0 THEN concat(n_name, ' County') ELSE n_name END AS area,
  CASE s_suppkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' ELSE '' END AS trust,
  CASE s_suppkey % 6 WHEN 0 THEN 'potential' WHEN 1 THEN 'source' ELSE '' END AS tier,
  CASE WHEN s_suppkey % 9 = 0 THEN 'local' ELSE '' END AS refresh, CASE WHEN s_suppkey % 4 = 0 THEN 'yes' ELSE '' END AS autopromote,
  CASE WHEN s_suppkey % 20 = 19 THEN 'todo' ELSE 'active' END AS status
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""),
    "listings": (("lineitem", "part", "supplier", "nation"), """
SELECT concat('s', CAST(l_suppkey AS STRING)) AS source_id,
  ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + (extract(YEAR FROM l_shipdate) - 1990) * 400 + extract(DOY FROM l_shipdate) AS ord,
  concat(CASE WHEN l_orderkey % 97 = 0 THEN 'CANCELLED: ' ELSE '' END, p_name, ' ',
    CASE p_type WHEN 'STANDARD' THEN 'Festival' WHEN 'ECONOMY' THEN 'Concert' WHEN 'MEDIUM' THEN 'Workshop' WHEN 'PROMO' THEN 'Board Meeting' WHEN 'LARGE' THEN 'Fish Fry' ELSE '12th Annual Parade' END,
    CASE WHEN l_linenumber = 7 THEN ' closed' WHEN l_partkey % 13 = 0 THEN ' 1998' ELSE '' END) AS title,
  CASE WHEN l_partkey % 3 = 0 THEN '' ELSE p_brand END AS venue, CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE n_name END AS city,
  '' AS state, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE n_name END AS area, '' AS address,
  CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE concat('https://site', CAST(l_suppkey % 60 AS STRING), '.example.org/e/', CAST(l_orderkey AS STRING)) END AS url,
  CASE l_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN 'Join us weekly at the library' WHEN 2 THEN 'A%20night%20of%20music' WHEN 3 THEN '<b>Doors</b> open &amp; more' WHEN 4 THEN 'a b;color x' WHEN 5 THEN '.x {{a: b; c: d;}} story' WHEN 6 THEN 'Live music and dinner' ELSE p_brand END AS description,
  CASE WHEN l_quantity > 25 THEN '$5' ELSE '' END AS price, '' AS image,
  CASE l_orderkey % 4 WHEN 0 THEN 'other' WHEN 1 THEN 'community' WHEN 2 THEN 'music' ELSE 'arts' END AS category,
  l_shipdate + INTERVAL '1' HOUR * CASE WHEN l_orderkey % 5 = 0 THEN 0 WHEN l_orderkey % 41 = 0 THEN 3 ELSE 8 + (l_partkey % 12) END AS start_at,
  CASE WHEN l_linenumber = 2 THEN l_shipdate + INTERVAL '1' DAY * (1 + l_partkey % 10) END AS end_at,
  l_orderkey % 10 = 5 AS all_day, l_orderkey % 11 = 0 AS inferred
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey"""),
    "corrections": (("orders",), """
SELECT concat('r', CAST(o_orderkey AS STRING), ':', CASE o_orderkey % 4 WHEN 3 THEN 'when' ELSE 'category' END) AS key, o_orderkey AS ord,
  CASE o_orderkey % 5 WHEN 0 THEN 'ignore' WHEN 1 THEN 'reject' ELSE 'apply' END AS decision, concat('e', CAST(o_custkey AS STRING)) AS event,
  CASE o_orderkey % 4 WHEN 3 THEN 'when' ELSE 'category' END AS field,
  CASE o_orderkey % 4 WHEN 3 THEN '2026-10-14T10:00/2026-10-14T11:00' ELSE CASE o_custkey % 3 WHEN 0 THEN 'music' WHEN 1 THEN 'arts' ELSE 'community' END END AS value,
  CASE o_orderkey % 3 WHEN 0 THEN 'other' WHEN 1 THEN 'community' ELSE '' END AS was,
  concat(CASE o_custkey % 6 WHEN 0 THEN 'Jazz' WHEN 1 THEN 'Painting' WHEN 2 THEN 'Market' WHEN 3 THEN 'Choir' WHEN 4 THEN 'Sculpture' ELSE 'Town' END, ' ', o_orderpriority) AS title,
  '' AS date, concat('s', CAST(o_custkey % 40 AS STRING)) AS source, 'category' AS kind, CAST(o_orderdate AS STRING) AS decided_at
FROM {orders}"""),
    "reports": (("events",), """
SELECT CAST(event_id AS STRING) AS id, ts AS at, concat('u', CAST(user_id AS STRING)) AS visitor, concat('e', CAST(event_id % 300 AS STRING)) AS event,
  CASE event_type WHEN 'signup' THEN 'date' WHEN 'error' THEN 'category' WHEN 'click' THEN 'location' WHEN 'view' THEN 'title' ELSE 'spam' END AS kind,
  CASE WHEN event_id % 17 = 0 THEN 'x' ELSE '' END AS website, CAST(value * 1000 AS BIGINT) AS elapsed_ms
FROM {events}"""),
    "published_keys": (("customer",), "SELECT concat('e', CAST(c_custkey AS STRING)) AS fingerprint FROM {customer} WHERE c_custkey % 3 <> 0"),
    "runs": (("orders",), """
SELECT concat('s', CAST(o_custkey % 100 AS STRING)) AS source_id, substr(CAST(o_orderdate AS STRING), 1, 10) AS date,
  CAST(sum(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS events, CAST(count(*) AS BIGINT) AS queued, max(o_orderkey) % 6 = 0 AS carried
FROM {orders} GROUP BY 1, 2"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, text = VIEWS[name]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})

