"""The queries once more as SQL for DuckDB, over views named like the tables."""

from __future__ import annotations

# Shared views, in order of use. Text is trimmed and cast the way the operators do it; sums of
# whole numbers are cast because DuckDB widens them.
_RAW = """
shipped AS (
  SELECT rpad('SER' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), 17, ' ') AS series_id,
         CASE WHEN l_linenumber = 5 AND l_quantity = 50 THEN '    '
              ELSE CAST(year(l_shipdate) AS VARCHAR) END AS year,
         CASE WHEN l_linenumber = 6 THEN 'A01'
              ELSE 'Q0' || CAST(quarter(l_shipdate) AS VARCHAR) END AS period,
         CASE WHEN l_linenumber = 7 THEN lpad('-', 12, ' ')
              ELSE lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 12, ' ') END AS value,
         CASE WHEN l_returnflag = 'R' THEN '  R ' END AS footnote_codes,
         l_linestatus AS note,
         CASE WHEN year(l_shipdate) < 1999 THEN 1 ELSE 2 END AS batch
  FROM lineitem),
raw AS (SELECT series_id, year, period, value, footnote_codes FROM shipped)"""

_SILVER = (
    _RAW
    + """,
typed AS (
  SELECT trim(series_id) AS series_id, TRY_CAST(trim(year) AS SMALLINT) AS year,
         trim(period) AS period, TRY_CAST(trim(value) AS DOUBLE) AS value,
         trim(footnote_codes) AS footnote_codes
  FROM raw),
silver AS (SELECT * FROM typed WHERE year IS NOT NULL AND value IS NOT NULL)"""
)

_SUMS = (
    _SILVER
    + """,
sums AS (
  SELECT series_id, year, sum(value) AS total_value FROM silver
  WHERE period LIKE 'Q%' GROUP BY series_id, year),
best AS (
  SELECT series_id, year, total_value AS value FROM (
    SELECT *, max(total_value) OVER (PARTITION BY series_id) AS max_value FROM sums)
  WHERE total_value = max_value)"""
)

_YEARLY = """
yearly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(count(*) * 1000 AS BIGINT) AS population
  FROM orders GROUP BY 1),
known AS (SELECT * FROM yearly WHERE year BETWEEN 1996 AND 1999)"""

_RECORDS = """
records AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS nation_id,
         'Customer ' || CAST(o_custkey AS VARCHAR) AS nation,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
              ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN NULL
              ELSE CAST(floor(o_totalprice) AS BIGINT) END AS population
  FROM orders)"""

_ORDERS_PER_YEAR = """
per_year AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders
  FROM orders GROUP BY 1, 2)"""

_LINKS = """
links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, 'href="/([^"]+)"', 1)) AS name
  FROM pages),
source AS (
  SELECT name, regexp_matches(name, '^[a-z]+$') AS fetched, count(*) AS listed
  FROM links WHERE url LIKE 'https:%' GROUP BY 1, 2),
target AS (SELECT DISTINCT name FROM links WHERE url NOT LIKE 'https:%')"""

_KEYED = "'landing/' || name AS key"

_ACTIONS = """
SELECT {name}, CASE WHEN fetched THEN 'uploaded' ELSE 'error' END AS action, listed AS entries
FROM source
UNION ALL
SELECT {name}, 'deleted', 1 FROM target WHERE name NOT IN (SELECT name FROM source)"""

_POPULATION_SERIES = """
SELECT s.series_id, s.year, s.period, s.value, p.population
FROM silver s LEFT JOIN {population} p ON s.year = p.year
WHERE s.series_id = 'SER00000003' AND s.period = 'Q01'"""

_STATS = """
SELECT round(avg(population), 4) AS mean_population,
       round(stddev_samp(population), 4) AS stddev_population,
       min(year) AS start_year, max(year) AS end_year, count(*) AS year_count
FROM {rows} WHERE year BETWEEN 1996 AND 1999"""

_REPORT = """
SELECT '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS passed,
       count(*) - count(*) FILTER (WHERE {test}) AS dropped FROM {rows}"""


def _report(rows: str, rules: dict[str, str], extra: str = "") -> str:
    parts = [
        _REPORT.format(rule=rule, test=test, rows=rows).replace("SELECT", f"SELECT {extra}", 1)
        for rule, test in rules.items()
    ]
    return " UNION ALL ".join(parts)


_SILVER_RULES = {"valid_year": "year IS NOT NULL", "valid_value": "value IS NOT NULL"}
_RECORD_RULES = {"valid_year": "year IS NOT NULL", "valid_population": "population > 0"}

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _dataset(name: str, quality: str, description: str, rows: str) -> str:
    return (
        f"SELECT '{name}' AS dataset, '{quality}' AS quality, '{description}' AS description, "
        f"count(*) AS row_count FROM {rows}"
    )


def oracle_sql() -> dict[str, str]:
    raw, silver, sums = f"WITH {_RAW}", f"WITH {_SILVER}", f"WITH {_SUMS}"
    both = f"{silver}, {_YEARLY}"
    everything = f"{sums}, {_YEARLY}"
    links = f"WITH {_LINKS}"
    raw_columns = "series_id, year, period, value, footnote_codes"
    batch_1 = "count(*) FILTER (WHERE batch = 1)"
    batch_2 = "count(*) FILTER (WHERE batch = 2)"
    return {
        "silver_observations": f"{silver} SELECT * FROM silver",
        "dq_report": f"{silver} {_report('typed', _SILVER_RULES)}",
        "dq_stream": f"{silver} {_report('typed', _SILVER_RULES)}",
        "dq_population": f"WITH {_RECORDS} {_report('records', _RECORD_RULES)}",
        "dq_audit": f"{silver}, {_RECORDS} "
        + _report("typed", _SILVER_RULES, "'run-1' AS run_id, 'silver_observations' AS dataset, ")
        + " UNION ALL "
        + _report("records", _RECORD_RULES, "'run-1' AS run_id, 'silver_population' AS dataset, "),
        "population_stats": f"WITH {_YEARLY} {_STATS.format(rows='yearly')}",
        "order_value_stats": f"WITH {_RECORDS} "
        + _STATS.format(rows="records")
        + " AND population > 0",
        "yearly_sums": f"{sums} SELECT * FROM sums",
        "series_max_attached": f"{sums} SELECT *, max(total_value) OVER (PARTITION BY series_id) "
        "AS max_value FROM sums",
        "best_year": f"{sums} SELECT * FROM best ORDER BY series_id, year",
        "best_year_raw": f"{raw}, "
        """
sums AS (
  SELECT trim(series_id) AS series_id, TRY_CAST(trim(year) AS INTEGER) AS year,
         sum(TRY_CAST(trim(value) AS DOUBLE)) AS total_value
  FROM raw WHERE trim(period) LIKE 'Q%'
  GROUP BY trim(series_id), TRY_CAST(trim(year) AS INTEGER)),
ranked AS (SELECT *, max(total_value) OVER (PARTITION BY series_id) AS max_value FROM sums)
SELECT series_id, year, total_value AS value FROM ranked
WHERE total_value = max_value ORDER BY series_id, year""",
        "best_year_single": f"{sums} "
        """
SELECT series_id, year, total_value AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY total_value DESC, year) AS n
  FROM sums)
WHERE n = 1 ORDER BY series_id""",
        "best_year_top10": f"{sums} SELECT * FROM best ORDER BY value DESC, series_id, year LIMIT 10",
        "best_year_ties": f"WITH {_ORDERS_PER_YEAR} "
        """
SELECT o_custkey, year, orders FROM (
  SELECT *, max(orders) OVER (PARTITION BY o_custkey) AS most FROM per_year)
WHERE orders = most""",
        "best_year_of_ties": f"WITH {_ORDERS_PER_YEAR} "
        """
SELECT o_custkey, year, orders FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY orders DESC, year) AS n
  FROM per_year)
WHERE n = 1""",
        "best_day_per_user": """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1, 2)
SELECT user_id, CAST(day AS VARCHAR) AS day, events FROM (
  SELECT *, max(events) OVER (PARTITION BY user_id) AS most FROM daily)
WHERE events = most""",
        "series_population_left": f"{both} {_POPULATION_SERIES.format(population='known')} "
        "ORDER BY s.year, s.value",
        "series_population_desc": f"{both} {_POPULATION_SERIES.format(population='known')} "
        "ORDER BY s.year DESC, s.value",
        "series_population_inner": f"{raw}, {_YEARLY} "
        """
SELECT b.series_id, b.year, b.period, b.value, p.population
FROM raw b JOIN known p ON TRY_CAST(trim(b.year) AS INTEGER) = p.year
WHERE trim(b.series_id) = 'SER00000003' AND trim(b.period) = 'Q01'""",
        "observations_population_left": f"{both} "
        """
SELECT s.series_id, s.year, s.period, s.value, p.population
FROM silver s LEFT JOIN known p ON s.year = p.year""",
        "observations_population_inner": f"{both} "
        """
SELECT s.series_id, s.year, s.period, s.value, p.population
FROM silver s JOIN known p ON s.year = p.year""",
        "payload_record_count": """
SELECT event_type, count(*) AS record_count FROM events GROUP BY event_type""",
        "payload_keys": """
SELECT event_id, array_to_string(json_keys(props), ',') AS keys FROM events""",
        "payload_flatten": """
SELECT event_id, user_id, event_type, value AS event_value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k
FROM events""",
        **dict.fromkeys(
            ("population_silver", "population_silver_split"),
            f"WITH {_RECORDS} "
            """
SELECT nation_id, nation, year, CAST(population AS BIGINT) AS population,
       'census_20250102_000000.json' AS _source_file
FROM records WHERE year IS NOT NULL AND population > 0""",
        ),
        "population_silver_numbers": f"WITH {_RECORDS} "
        """
SELECT nation_id, nation, year, CAST(population AS BIGINT) AS population,
       'census_20250102_000000.json' AS _source_file
FROM records WHERE year IS NOT NULL AND population > 0""",
        "population_record_counts": """
SELECT 'census_20250102_000000.json' AS snapshot, count(*) AS stated, count(*) AS found
FROM orders
UNION ALL
SELECT 'census_20250101_000000.json', count(*), count(*)
FROM orders WHERE o_orderstatus = 'F'""",
        "envelope_roundtrip": """
SELECT TRUE AS count_matches, event_id, user_id, event_type, value AS event_value,
       strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS fetched,
       'events_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS snapshot
FROM events""",
        "latest_snapshot": """
WITH named AS (
  SELECT o_orderkey, o_orderstatus,
         'orders_' || strftime(o_orderdate, '%Y%m%d_%H%M%S')
         || CASE WHEN o_orderstatus = 'O' THEN '.txt' ELSE '.json' END AS snapshot
  FROM orders)
SELECT * FROM named
WHERE snapshot = (SELECT max(snapshot) FROM named WHERE snapshot LIKE '%.json')""",
        "ingest_batch": f"{raw} SELECT {raw_columns}, batch FROM shipped",
        "header_trim": f"{raw} SELECT {raw_columns} FROM raw",
        "lineage_columns": f"{raw} SELECT series_id, value, 'batch=' || CAST(batch AS VARCHAR) "
        "AS source, TRUE AS has_time FROM shipped",
        "ingest_stream": f"{raw} SELECT {raw_columns} FROM raw",
        **{
            name: f"{raw} SELECT {raw_columns}, CASE WHEN period = 'Q01' THEN note END AS note, "
            "CASE period WHEN 'Q01' THEN 1 WHEN 'Q02' THEN 2 ELSE 3 END AS batch FROM shipped"
            for name in ("ingest_layouts", "ingest_layouts_stream")
        },
        "refresh_evolving": f"{raw} "
        f"SELECT {raw_columns}, CASE WHEN batch = 2 THEN note END AS note, batch FROM shipped",
        "refresh_audit_retry": f"{both}, typed_batch AS (SELECT batch, TRY_CAST(trim(year) AS SMALLINT) AS year, "
        "TRY_CAST(trim(value) AS DOUBLE) AS value FROM shipped) "
        + " UNION ALL ".join(
            part
            for batch in (1, 2)
            for part in (
                _report(
                    f"(SELECT * FROM typed_batch WHERE batch = {batch})",
                    _SILVER_RULES,
                    f"'run-{batch}' AS run_id, 'silver_observations' AS dataset, ",
                ),
                _report("yearly", _RECORD_RULES, f"'run-{batch}' AS run_id, 'silver_population' AS dataset, "),
            )
        ),
        "ingest_stream_rerun": f"{raw} "
        f"""
SELECT 1 AS run, {batch_1} AS rows_added, {batch_1} AS rows_stored FROM shipped
UNION ALL SELECT 2, 0, {batch_1} FROM shipped
UNION ALL SELECT 3, {batch_2}, count(*) FROM shipped""",
        "schema_evolution": f"{raw} "
        f"SELECT {raw_columns}, CASE WHEN batch = 2 THEN note END AS note, batch FROM shipped",
        "layouts_by_load": f"{raw}, counts AS (SELECT count(*) FILTER (period = 'Q01') AS a, "
        "count(*) FILTER (period = 'Q02') AS b, count(*) FILTER (period NOT IN ('Q01', 'Q02')) AS c FROM shipped) "
        """
SELECT 1 AS load, a AS rows_added, 1 AS layouts, CAST(0 AS BIGINT) AS noted FROM counts
UNION ALL SELECT 2, b, 2, b FROM counts
UNION ALL SELECT 3, 0, 2, b FROM counts
UNION ALL SELECT 4, c, 3, b FROM counts""",
        "silver_stream": f"{silver} SELECT * FROM silver",
        "file_inventory": """
SELECT 'year=' || CAST(year(l_shipdate) AS VARCHAR) AS folder,
       CAST(sum(1 + strlen(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                                     l_returnflag, l_linestatus))) AS BIGINT) AS bytes,
       format('{:,}', CAST(sum(1 + strlen(concat_ws('|', l_orderkey, l_partkey, l_suppkey,
                                     l_linenumber, l_returnflag, l_linestatus))) AS BIGINT))
         AS size_label
FROM lineitem GROUP BY 1""",
        "extract_links": f"{links} SELECT page_id, name FROM links",
        "extract_links_first5": f"{links} SELECT DISTINCT name FROM links ORDER BY name LIMIT 5",
        "sync_actions": f"{links} {_ACTIONS.format(name=_KEYED)}",
        "sync_landing": f"{links} {_ACTIONS.format(name='name AS name')}",
        "sync_orphans": f"{links} SELECT name, 'old:' || name AS content FROM target "
        "WHERE name NOT IN (SELECT name FROM source)",
        "sync_orphan_names": f"{links} SELECT name FROM target EXCEPT SELECT name FROM source",
        "sync_next_state": f"{links} "
        """
SELECT name, 'new:' || name AS content FROM source WHERE fetched
UNION ALL
SELECT name, 'old:' || name FROM target
WHERE name IN (SELECT name FROM source WHERE NOT fetched)""",
        "sync_stats": f"{links} "
        """
SELECT CAST((SELECT sum(listed) FROM source WHERE fetched) AS BIGINT) AS uploaded,
       (SELECT count(*) FROM target WHERE name NOT IN (SELECT name FROM source)) AS deleted,
       CAST((SELECT sum(listed) FROM source WHERE NOT fetched) AS BIGINT) AS errors""",
        "sync_delete_outcomes": f"{links} "
        """
SELECT name, CASE WHEN fetched THEN 'uploaded' ELSE 'error' END AS action, listed AS entries FROM source
UNION ALL
SELECT name, CASE WHEN length(name) % 3 = 0 THEN 'deleted' ELSE 'error' END, 1
FROM target WHERE name NOT IN (SELECT name FROM source)""",
        "sync_delete_state": f"{links} "
        """
SELECT name, 'new:' || name AS content FROM source WHERE fetched
UNION ALL
SELECT name, 'old:' || name FROM target
WHERE name IN (SELECT name FROM source WHERE NOT fetched)
   OR name NOT IN (SELECT name FROM source) AND length(name) % 3 <> 0""",
        "sync_delete_stats": f"{links}, left_over AS (SELECT name FROM target WHERE name NOT IN (SELECT name FROM source)) "
        """
SELECT CAST((SELECT sum(listed) FROM source WHERE fetched) AS BIGINT) AS uploaded,
       (SELECT count(*) FROM left_over WHERE length(name) % 3 = 0) AS deleted,
       CAST((SELECT sum(listed) FROM source WHERE NOT fetched) AS BIGINT)
         + (SELECT count(*) FROM left_over WHERE length(name) % 3 <> 0) AS errors""",
        "materialize_roundtrip": f"{silver} SELECT * FROM silver",
        "dataset_properties": f"{everything} "
        + " UNION ALL ".join(
            [
                _dataset(
                    "bronze_observations", "bronze", "Raw observation text with lineage", "raw"
                ),
                _dataset(
                    "bronze_population", "bronze", "Latest population snapshot as delivered", "yearly"
                ),
                _dataset(
                    "silver_population", "silver", "Population by year, trimmed and typed", "yearly"
                ),
                _dataset(
                    "silver_observations", "silver", "Observations, trimmed and typed", "silver"
                ),
                _dataset(
                    "gold_population_mean_stddev",
                    "gold",
                    "Mean and deviation of the population",
                    "(SELECT avg(population) FROM known)",
                ),
                _dataset(
                    "gold_best_year", "gold", "Best year of each series by quarterly sum", "best"
                ),
                _dataset(
                    "gold_population_series",
                    "gold",
                    "One series and quarter with population",
                    f"({_POPULATION_SERIES.format(population='yearly')})",
                ),
            ]
        ),
        "gold_best_year": f"{sums} SELECT * FROM best ORDER BY series_id, year",
        "gold_population_mean_stddev": f"WITH {_YEARLY} {_STATS.format(rows='yearly')}",
        "gold_population_series": f"{both} {_POPULATION_SERIES.format(population='yearly')} "
        "ORDER BY s.year, s.value",
        "refresh_audit": f"{silver}, {_YEARLY} "
        + _report("typed", _SILVER_RULES, "'run-1' AS run_id, 'silver_observations' AS dataset, ")
        + " UNION ALL "
        + _report("yearly", _RECORD_RULES, "'run-1' AS run_id, 'silver_population' AS dataset, "),
        "sql_population_stats": f"WITH {_YEARLY} {_STATS.format(rows='yearly')}",
        "sql_best_year": f"{sums} SELECT * FROM best ORDER BY series_id, year",
        "sql_series_population": f"{both} {_POPULATION_SERIES.format(population='yearly')} "
        "ORDER BY s.year DESC",
        "table_row_count": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in _TABLES
        ),
        "preview_100": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 100""",
    }
