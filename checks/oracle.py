"""The SQL that each query must agree with, for DuckDB over the same tables."""

from sitewright.schema import COUNTRY_BOXES, GOLD_SCHEMAS, KNOWN_TYPES, LISTING_COLUMNS, REPORT_COLUMNS

RUN_AT = "2026-01-21T06:30:00"

# ---- common tables ----------------------------------------------------------

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, list(needs))


def with_ctes(sql: str, *needs: str) -> str:
    """The statement with the common tables it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in CTES[name][1]:
            add(need)
        if name not in order:
            order.append(name)

    for need in needs:
        add(need)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + sql


cte(
    "sites",
    """SELECT CAST(c_custkey - (CASE WHEN c_custkey % 97 = 96 THEN 1 ELSE 0 END) AS VARCHAR) AS id,
  CASE WHEN c_custkey % 10 = 0 THEN concat('  ', c_name, '  ') ELSE c_name END AS name,
  CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN 'Brew Pub' ELSE c_mktsegment END AS brewery_type,
  CASE WHEN c_custkey % 9 = 0 THEN '' ELSE concat(CAST(c_custkey AS VARCHAR), ' Main St') END AS address_1,
  CAST(NULL AS VARCHAR) AS address_2,
  CAST(NULL AS VARCHAR) AS address_3,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE concat('City_', CAST(c_custkey % 37 AS VARCHAR)) END AS city,
  CAST(NULL AS VARCHAR) AS state_province,
  CASE WHEN c_custkey % 13 = 0 THEN '   ' ELSE n_name END AS state,
  CAST(10000 + c_custkey % 500 AS VARCHAR) AS postal_code,
  CASE n_nationkey % 8 WHEN 0 THEN 'USA' WHEN 1 THEN 'US' WHEN 2 THEN 'United States' WHEN 3 THEN 'England'
       WHEN 4 THEN 'Brazil' WHEN 5 THEN 'Scotland' WHEN 6 THEN 'Portugal' ELSE ' Canada ' END AS country,
  CASE WHEN c_custkey % 4 = 3 THEN NULL WHEN c_custkey % 50 = 1 THEN CAST(0 AS DOUBLE)
       ELSE CAST((c_custkey * 11) % 361 - 180 AS DOUBLE) + 0.5 END AS longitude,
  CASE WHEN c_custkey % 4 = 3 THEN NULL WHEN c_custkey % 50 = 1 THEN CAST(0 AS DOUBLE)
       WHEN c_custkey % 61 = 0 THEN CAST(999 AS DOUBLE)
       ELSE CAST((c_custkey * 7) % 181 - 90 AS DOUBLE) + 0.25 END AS latitude,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE concat('+', CAST(c_custkey AS VARCHAR)) END AS phone,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('http://', lower(c_mktsegment), '.example') END AS website_url,
  CASE WHEN c_custkey % 9 = 0 THEN '' ELSE concat(CAST(c_custkey AS VARCHAR), ' Main St') END AS street
 FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)

_TEXTS = [c for c in LISTING_COLUMNS if c not in ("longitude", "latitude")]
_tidy = ", ".join(f"nullif(trim({c}), '') AS {c}" for c in _TEXTS)
_slug = "lower(regexp_replace({}, '[^a-zA-Z0-9]', '_', 'g'))"

cte("tidied", f"SELECT {_tidy}, longitude, latitude FROM sites", "sites")
cte(
    "flagged",
    f"""SELECT *,
  CASE WHEN country IN ('United States', 'USA', 'US') THEN 'United States'
       WHEN country = 'England' THEN 'United Kingdom' ELSE country END AS country_normalized,
  {_slug.format('brewery_type')} AS brewery_type_normalized,
  concat_ws(', ', address_1, city, state, postal_code, country) AS full_address,
  concat_ws('_', {_slug.format("coalesce(country, 'unknown')")},
                 {_slug.format("coalesce(state, 'unknown')")}) AS location_key,
  latitude IS NOT NULL AND longitude IS NOT NULL AS has_coordinates,
  phone IS NOT NULL OR website_url IS NOT NULL AS has_contact,
  latitude IS NOT NULL AND longitude IS NOT NULL AND (phone IS NOT NULL OR website_url IS NOT NULL)
    AND city IS NOT NULL AND state IS NOT NULL AS is_complete
 FROM tidied""",
    "tidied",
)
cte(
    "cleaned",
    f"""SELECT *, '{RUN_AT}' AS silver_processed_at, DATE '2026-01-21' AS processing_date,
  2026 AS processing_year, 1 AS processing_month FROM flagged""",
    "flagged",
)

_BOXES = ", ".join(
    f"('{country}', {', '.join(str(edge) for edge in box)})" for country, box in COUNTRY_BOXES.items()
)


def _checks(name: str, source: str) -> None:
    """{name}_checked: the three checks; {name}: the rows with coordinates_valid."""
    cte(
        f"{name}_checked",
        f"""SELECT s.*,
  coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false) AS coords_in_range,
  CASE WHEN abs(latitude) < 0.1 AND abs(longitude) < 0.1 THEN false ELSE true END AS not_null_island,
  CASE WHEN lat_min IS NULL THEN true ELSE latitude BETWEEN lat_min AND lat_max
       AND longitude BETWEEN lon_min AND lon_max END AS coords_match_country
 FROM {source} s LEFT JOIN (VALUES {_BOXES}) AS b(box_country, lat_min, lat_max, lon_min, lon_max)
   ON country_normalized = box_country""",
        source,
    )
    cte(
        name,
        f"""SELECT * EXCLUDE (coords_in_range, not_null_island, coords_match_country),
  coalesce(latitude IS NOT NULL AND longitude IS NOT NULL AND coords_in_range AND not_null_island
           AND coords_match_country, false) AS coordinates_valid
 FROM {name}_checked""",
        f"{name}_checked",
    )


_checks("silver", "cleaned")

# ---- lookup -----------------------------------------------------------------

_ADDRESS = (
    "nullif(concat_ws(', ', nullif(street, ''), nullif(city, ''), nullif(state, ''),"
    " nullif(country_normalized, ''), nullif(postal_code, '')), '')"
)
_KNOWN = " + ".join(
    f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)"
    for c in ("street", "city", "state", "country_normalized", "postal_code")
)
cte(
    "by_address",
    f"""SELECT {_ADDRESS} AS key, min(CAST((n * 5) % 120 - 60 AS DOUBLE) + 0.5) AS lat,
  min(CAST((n * 3) % 240 - 120 AS DOUBLE) + 0.5) AS lon
 FROM (SELECT *, CAST(regexp_extract(name, '(\\d+)$', 1) AS BIGINT) AS n FROM cleaned
       WHERE latitude IS NULL OR longitude IS NULL)
 WHERE phone IS NOT NULL AND {_ADDRESS} IS NOT NULL GROUP BY 1""",
    "cleaned",
)
cte(
    "by_city",
    """SELECT concat_ws(', ', city, country_normalized) AS key, min(latitude) AS lat, min(longitude) AS lon
 FROM cleaned WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND city IS NOT NULL
   AND country_normalized IS NOT NULL GROUP BY 1""",
    "cleaned",
)
cte(
    "wanted",
    f"""SELECT id, {_ADDRESS} AS address_key,
  CASE WHEN {_KNOWN} > 2 AND city IS NOT NULL AND country_normalized IS NOT NULL
       THEN concat_ws(', ', city, country_normalized) END AS city_key
 FROM cleaned WHERE latitude IS NULL OR longitude IS NULL""",
    "cleaned",
)


def _found(name: str, wanted: str) -> None:
    cte(
        name,
        f"""SELECT w.id, copies, coalesce(a.lat, c.lat) AS found_latitude, coalesce(a.lon, c.lon) AS found_longitude,
  CASE WHEN a.lat IS NOT NULL THEN 'address' WHEN c.lat IS NOT NULL THEN 'city' END AS found_level
 FROM (SELECT id, address_key, city_key, count(*) AS copies FROM {wanted} GROUP BY ALL) w
 LEFT JOIN by_address a ON address_key = a.key LEFT JOIN by_city c ON city_key = c.key""",
        wanted,
        "by_address",
        "by_city",
    )
    cte(
        f"{name}_hits",
        f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id
   ORDER BY found_level, found_latitude, found_longitude) AS rn FROM {name}
   WHERE found_level IS NOT NULL) WHERE rn = 1""",
        name,
    )


_found("found", "wanted")
cte(
    "filled",
    """SELECT c.* EXCLUDE (latitude, longitude, has_coordinates),
  CASE WHEN h.id IS NOT NULL THEN found_latitude ELSE latitude END AS latitude,
  CASE WHEN h.id IS NOT NULL THEN found_longitude ELSE longitude END AS longitude,
  h.id IS NOT NULL OR has_coordinates AS has_coordinates, found_level AS geocoded_source
 FROM cleaned c LEFT JOIN found_hits h ON c.id = h.id""",
    "cleaned",
    "found_hits",
)
_checks("located", "filled")
cte(
    "wanted_100",
    f"""SELECT id, {_ADDRESS} AS address_key,
  CASE WHEN {_KNOWN} > 2 AND city IS NOT NULL AND country_normalized IS NOT NULL
       THEN concat_ws(', ', city, country_normalized) END AS city_key
 FROM (SELECT * FROM cleaned WHERE latitude IS NULL OR longitude IS NULL ORDER BY id, name LIMIT 100)""",
    "cleaned",
)
_found("found_100", "wanted_100")

# ---- reporting tables -------------------------------------------------------


def _sum(flag: str) -> str:
    return f"CAST(sum(CASE WHEN {flag} THEN 1 ELSE 0 END) AS BIGINT)"


_FLAGS = f"{_sum('has_coordinates')} AS with_coordinates, {_sum('has_contact')} AS with_contact"
_COMPLETE = f"{_sum('is_complete')} AS complete_records"
_HEAD = "count(*) AS brewery_count, count(DISTINCT id) AS unique_breweries"
_AT = f"'{RUN_AT}' AS aggregation_timestamp"

cte(
    "breweries_by_type",
    f"""SELECT brewery_type_normalized, {_HEAD}, {_FLAGS}, {_COMPLETE},
  round(CAST({_sum('is_complete')} AS DOUBLE) / count(*) * 100, 2) AS completeness_rate, {_AT}
 FROM silver GROUP BY 1""",
    "silver",
)
cte(
    "breweries_by_country",
    f"""SELECT country_normalized, {_HEAD}, count(DISTINCT brewery_type_normalized) AS distinct_types, {_FLAGS},
  {_AT} FROM silver GROUP BY 1""",
    "silver",
)
cte(
    "breweries_by_state",
    f"""SELECT country_normalized, state, {_HEAD}, count(DISTINCT brewery_type_normalized) AS distinct_types,
  count(DISTINCT city) AS distinct_cities, {_AT} FROM silver WHERE state IS NOT NULL GROUP BY 1, 2""",
    "silver",
)
cte(
    "breweries_by_type_and_country",
    f"""SELECT brewery_type_normalized, country_normalized, {_HEAD}, {_AT} FROM silver GROUP BY 1, 2""",
    "silver",
)
cte(
    "breweries_by_type_and_state",
    f"""SELECT brewery_type_normalized, country_normalized, state, {_HEAD}, {_AT}
 FROM silver WHERE state IS NOT NULL GROUP BY 1, 2, 3""",
    "silver",
)
cte(
    "brewery_summary_statistics",
    f"""SELECT count(*) AS total_breweries, count(DISTINCT id) AS unique_breweries,
  count(DISTINCT brewery_type_normalized) AS distinct_types,
  count(DISTINCT country_normalized) AS distinct_countries,
  count(DISTINCT state) AS distinct_states, count(DISTINCT city) AS distinct_cities,
  {_FLAGS}, {_COMPLETE}, {_AT} FROM silver""",
    "silver",
)
cte(
    "breweries",
    f"SELECT {', '.join(REPORT_COLUMNS)} FROM silver",
    "silver",
)
cte("map_rows", "SELECT * FROM silver WHERE coordinates_valid", "silver")

# ---- runs -------------------------------------------------------------------

cte("runs", "SELECT CAST(o_orderdate AS DATE) AS run_date, count(*) AS records FROM orders GROUP BY 1")
cte(
    "run_rows",
    """SELECT concat(CAST(run_date AS VARCHAR), 'T06:30:00') AS execution_timestamp,
  CAST(run_date AS VARCHAR) AS execution_date,
  concat('scheduled__', CAST(run_date AS VARCHAR), 'T06:30:00+00:00') AS dag_run_id,
  n % 11 <> 0 AS silver_ok, n % 13 <> 0 AS gold_ok, records AS bronze_records,
  CASE WHEN n % 11 = 0 THEN 0 ELSE records - (CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END) END AS silver_records,
  CASE WHEN n % 13 = 0 THEN 0 ELSE 7 END AS gold_tables,
  CAST(ceil(records / 2.0) AS DOUBLE) / 2 AS bronze_time,
  CAST(CASE WHEN n % 11 = 0 THEN 0 ELSE records * 0.25 END AS DOUBLE) AS silver_time,
  CAST(CASE WHEN n % 13 = 0 THEN 0 ELSE records * 0.5 END AS DOUBLE) AS gold_time,
  8 - n % 3 AS bronze_passed, n % 3 AS bronze_failed,
  CASE WHEN n % 11 = 0 THEN 0 ELSE 5 END AS silver_rules,
  CASE WHEN n % 11 = 0 THEN 0 ELSE 5 - n % 2 END AS silver_passed,
  CASE WHEN n % 11 = 0 THEN 0 ELSE n % 2 END AS silver_failed
 FROM (SELECT *, dayofyear(run_date) AS n FROM runs)""",
    "runs",
)
cte(
    "run_flat",
    """SELECT *, CASE WHEN silver_ok AND gold_ok THEN 'success' ELSE 'failed' END AS status,
  CAST(bronze_records - silver_records AS DOUBLE) / bronze_records * 100 AS loss,
  bronze_time + silver_time + gold_time AS total_time FROM run_rows""",
    "run_rows",
)

ORACLE: dict[str, str] = {}


def check(name: str, sql: str, *needs: str) -> None:
    ORACLE[name] = with_ctes(sql, *needs)


# ---- sources and sinks ------------------------------------------------------

_LANDED = "CAST(CAST(id AS BIGINT) % 28 + 1 AS INTEGER)"
check(
    "land_bronze",
    f"""SELECT 2026 AS year, 1 AS month, {_LANDED} AS day, count(*) AS records,
  count(latitude) AS with_latitude FROM sites GROUP BY {_LANDED}""",
    "sites",
)

def _as_text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)" if c in ("latitude", "longitude") else c


_cells = ", ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(CAST(length({_as_text(c)}) AS VARCHAR), ':', {_as_text(c)}) END"
    for c in sorted(LISTING_COLUMNS)
)
check(
    "batch_fingerprint",
    f"""SELECT printf('%08x', CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {_cells})), 1, 8) AS BIGINT))
    % 4294967296 AS BIGINT)) AS fingerprint, count(*) AS total_records FROM sites""",
    "sites",
)
check(
    "ingestion_manifest",
    f"""SELECT md5('{RUN_AT}bronze/year=2026/month=01/day=21') AS ingestion_id,
  '{RUN_AT}' AS ingestion_timestamp, 'listings' AS source, count(*) AS total_records,
  'bronze/year=2026/month=01/day=21' AS file_path, CAST(0 AS BIGINT) AS file_size_bytes, 'success' AS status,
  CAST(ceil(count(*) / 200.0) AS BIGINT) AS pages_processed, 2026 AS year, 1 AS month, 21 AS day FROM sites""",
    "sites",
)
cte(
    "manifest",
    """SELECT md5(concat(CAST(run_date AS VARCHAR), 'T06:30:00bronze/day=', CAST(run_date AS VARCHAR))) AS ingestion_id,
  concat(CAST(run_date AS VARCHAR), 'T06:30:00') AS ingestion_timestamp, 'orders' AS source,
  records AS total_records, concat('bronze/day=', CAST(run_date AS VARCHAR)) AS file_path,
  records * 640 AS file_size_bytes, 'success' AS status, CAST(ceil(records / 200.0) AS BIGINT) AS pages_processed,
  CAST(year(run_date) AS INTEGER) AS year, CAST(month(run_date) AS INTEGER) AS month,
  CAST(day(run_date) AS INTEGER) AS day FROM runs""",
    "runs",
)
check("list_ingestions", "SELECT * FROM manifest", "manifest")
check("latest_ingestion", "SELECT * FROM manifest ORDER BY ingestion_timestamp DESC LIMIT 1", "manifest")
_dated = f"SELECT *, 2026 AS year, 1 AS month, {_LANDED} AS day FROM sites"
check("read_bronze", _dated, "sites")
check("read_ingestion", "SELECT *, CASE WHEN latitude IS NULL THEN 2 ELSE 1 END AS ingestion FROM sites", "sites")
check("read_bronze_by_date", f"SELECT * FROM ({_dated}) WHERE day = 7", "sites")
check("incremental_silver", "SELECT * FROM silver", "silver")
check("incremental_retry", "SELECT * FROM silver", "silver")
check("silver_roundtrip", "SELECT * FROM silver", "silver")
check(
    "read_silver_filtered",
    "SELECT * FROM silver WHERE country_normalized = 'United States' AND state = 'NATION_8'",
    "silver",
)
check("gold_roundtrip", "SELECT * FROM breweries_by_type_and_state", "breweries_by_type_and_state")
check(
    "read_gold_filtered",
    "SELECT * FROM breweries_by_type_and_country WHERE brewery_type_normalized = 'brew_pub'",
    "breweries_by_type_and_country",
)
check(
    "list_gold",
    "SELECT table_name FROM (VALUES "
    + ", ".join(f"('{name}')" for name in GOLD_SCHEMAS)
    + ") AS t(table_name)",
)
ORACLE["list_gold"] = ORACLE["list_gold"].replace("WITH \n", "")
check(
    "load_gold_or_empty",
    """SELECT 'by_country' AS table_name, count(*) AS row_count FROM breweries_by_country
 UNION ALL SELECT 'by_type', count(*) FROM breweries_by_type
 UNION ALL SELECT 'by_state', count(*) FROM breweries_by_state
 UNION ALL SELECT 'summary', 0
 UNION ALL SELECT 'breweries', count(*) FROM silver""",
    "breweries_by_country",
    "breweries_by_type",
    "breweries_by_state",
)
check(
    "export_filtered_csv",
    f"SELECT {', '.join(REPORT_COLUMNS)} FROM map_rows WHERE country_normalized = 'Brazil'",
    "map_rows",
)

# ---- run history ------------------------------------------------------------

_BRIEF = "execution_timestamp, dag_run_id, status, bronze_records AS records_ingested"
for _name, _limit in (("run_history_retained", 100), ("latest_run", 1), ("last_n_runs", 20)):
    check(
        _name,
        f"SELECT {_BRIEF} FROM run_flat ORDER BY execution_timestamp DESC LIMIT {_limit}",
        "run_flat",
    )
check(
    "run_history_window",
    """SELECT CAST(execution_timestamp AS TIMESTAMP) AS execution_timestamp, dag_run_id, status,
  bronze_records AS records_ingested FROM run_flat
 WHERE CAST(execution_timestamp AS TIMESTAMP) >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 30 DAY""",
    "run_flat",
)
_rate = "coalesce(CAST({0}_passed AS DOUBLE) / nullif({0}_rules, 0) * 100, CAST(0 AS DOUBLE))"
check(
    "run_report",
    f"""SELECT execution_date, status, true AS bronze_ok, silver_ok, gold_ok,
  bronze_records AS records_ingested, CAST(silver_records AS BIGINT) AS records_transformed,
  CAST(gold_tables AS BIGINT) AS aggregations_created, loss AS data_loss_rate,
  bronze_time AS bronze_ingestion_time, silver_time AS silver_transformation_time,
  gold_time AS gold_aggregation_time, total_time AS total_pipeline_time,
  bronze_failed = 0 AS bronze_success, silver_rules > 0 AND silver_failed = 0 AS silver_success,
  gold_ok AS gold_success, CAST(bronze_passed AS DOUBLE) / 8 * 100 AS bronze_success_rate,
  {_rate.format('silver')} AS silver_success_rate, CAST(CASE WHEN gold_ok THEN 100 ELSE 0 END AS DOUBLE) AS gold_success_rate
 FROM run_flat""",
    "run_flat",
)
check(
    "run_validation_table",
    f"""SELECT execution_date, 'bronze' AS layer, bronze_failed = 0 AS success,
  CAST(bronze_passed AS DOUBLE) / 8 * 100 AS success_rate, CAST(bronze_passed AS BIGINT) AS passed,
  CAST(bronze_failed AS BIGINT) AS failed, CAST(8 AS BIGINT) AS total FROM run_flat
 UNION ALL SELECT execution_date, 'silver', silver_rules > 0 AND silver_failed = 0, {_rate.format('silver')},
  silver_passed, silver_failed, silver_rules FROM run_flat
 UNION ALL SELECT execution_date, 'gold', gold_ok, CAST(CASE WHEN gold_ok THEN 100 ELSE 0 END AS DOUBLE),
  gold_tables, 0, gold_tables FROM run_flat""",
    "run_flat",
)
check(
    "run_history_flat",
    """SELECT execution_date, status, bronze_records AS records, total_time, bronze_time, silver_time, gold_time
 FROM run_flat""",
    "run_flat",
)
check(
    "latest_run_card",
    """SELECT execution_date, upper(status) AS status, substr(split_part(dag_run_id, '__', 2), 1, 15) AS run_id,
  bronze_time, silver_time, gold_time, total_time, bronze_records AS records_ingested,
  CAST(silver_records AS BIGINT) AS records_transformed, CAST(gold_tables AS BIGINT) AS aggregations,
  loss AS data_loss_rate FROM run_flat ORDER BY execution_timestamp DESC LIMIT 1""",
    "run_flat",
)
check(
    "stage_gates",
    """SELECT execution_timestamp, true AS may_curate, silver_ok AND silver_records > 0 AS may_aggregate,
  gold_ok AND gold_tables > 0 AS may_report, bronze_records > 0 AS check_bronze,
  CASE WHEN NOT silver_ok THEN 'silver layer did not succeed'
       WHEN silver_records = 0 THEN 'no rows in silver layer'
       WHEN NOT gold_ok THEN 'gold layer did not succeed'
       WHEN gold_tables = 0 THEN 'no tables in gold layer' ELSE 'success' END AS verdict
 FROM run_flat""",
    "run_flat",
)
_RATES = {
    "coordinate_coverage": "has_coordinates",
    "valid_coordinates_rate": "coordinates_valid",
    "geocoded_rate": "geocoded_source IS NOT NULL",
    "country_normalized_rate": "country_normalized IS NOT NULL",
}
check(
    "enrichment_rates",
    "SELECT "
    + ", ".join(f"CAST({_sum(c)} AS DOUBLE) / count(*) AS {name}" for name, c in _RATES.items())
    + " FROM located",
    "located",
)
check(
    "enrichment_card",
    "SELECT "
    + ", ".join(f"CAST({_sum(c)} AS DOUBLE) / count(*) * 100 AS {name}" for name, c in _RATES.items())
    + " FROM located",
    "located",
)

# ---- cleaning ---------------------------------------------------------------

check("clean_sites", "SELECT * FROM flagged", "flagged")
for _name, _columns in {
    "normalize_country": "country_normalized",
    "normalize_type": "brewery_type_normalized",
    "full_address": "full_address",
    "location_key": "location_key",
    "quality_flags": "has_coordinates, has_contact, is_complete",
}.items():
    check(_name, f"SELECT id, name, {_columns} FROM flagged", "flagged")
check(
    "add_processing_metadata",
    f"""SELECT id, name, '{RUN_AT}' AS silver_processed_at, DATE '2026-01-21' AS processing_date,
  2026 AS processing_year, 1 AS processing_month FROM sites""",
    "sites",
)
check(
    "enforce_schema",
    """SELECT * EXCLUDE (latitude), CASE WHEN latitude = 999 THEN NULL ELSE latitude END AS latitude FROM sites""",
    "sites",
)
_POINT = "id, name, country_normalized, latitude, longitude"
check(
    "coordinate_checks",
    f"SELECT {_POINT}, coords_in_range, not_null_island, coords_match_country FROM silver_checked",
    "silver_checked",
)
check("coordinates_valid", f"SELECT {_POINT}, coordinates_valid FROM silver", "silver")
check(
    "coordinate_breakdown",
    """SELECT count(*) FILTER (WHERE has_coordinates) AS with_coordinates,
  count(*) FILTER (WHERE has_coordinates AND coords_in_range AND not_null_island AND coords_match_country) AS valid,
  count(*) FILTER (WHERE NOT not_null_island) AS null_island, count(*) FILTER (WHERE NOT coords_in_range) AS out_of_range,
  count(*) FILTER (WHERE has_coordinates AND NOT coords_in_range) AS points_out_of_range,
  count(*) FILTER (WHERE has_coordinates AND NOT coords_match_country) AS wrong_country,
  count(*) FILTER (WHERE has_coordinates) - count(*) FILTER (WHERE has_coordinates AND coords_in_range AND not_null_island
                                       AND coords_match_country) AS invalid
 FROM silver_checked""",
    "silver_checked",
)
check(
    "dedup_by_id",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
   ORDER BY (CASE WHEN is_complete THEN 0 ELSE 1 END), name) AS rn FROM cleaned) WHERE rn = 1 OR id IS NULL""",
    "cleaned",
)
check("missing_coordinates", "SELECT * FROM cleaned WHERE latitude IS NULL OR longitude IS NULL", "cleaned")
check("filter_by_type", "SELECT * FROM cleaned WHERE brewery_type = 'Brew Pub'", "cleaned")
check(
    "search_sites",
    """SELECT * FROM cleaned WHERE contains(lower(coalesce(name, '')), 'nation_1')
   OR contains(lower(coalesce(city, '')), 'nation_1') OR contains(lower(coalesce(state, '')), 'nation_1')
 ORDER BY id, name LIMIT 50""",
    "cleaned",
)
check("lookup_by_id", "SELECT * FROM cleaned WHERE id = '95'", "cleaned")
check("page_slice", "SELECT id, name FROM cleaned ORDER BY id, name LIMIT 50 OFFSET 100", "cleaned")
check(
    "lookup_capped",
    "SELECT id, name FROM cleaned WHERE latitude IS NULL OR longitude IS NULL ORDER BY id, name LIMIT 100",
    "cleaned",
)
check("distinct_ids", "SELECT DISTINCT id FROM cleaned", "cleaned")

# ---- listings and metrics ---------------------------------------------------

check("gold_entity_table", "SELECT * FROM breweries", "breweries")
check("map_rows_valid", f"SELECT {_POINT} FROM map_rows", "map_rows")
check(
    "map_rows_suspicious",
    f"SELECT {_POINT} FROM silver WHERE has_coordinates AND NOT coordinates_valid",
    "silver",
)
check(
    "map_rows_selected",
    f"""SELECT {_POINT} FROM map_rows
 WHERE country_normalized = 'Canada' AND brewery_type_normalized = 'brew_pub'""",
    "map_rows",
)


def _pct(part: str, whole: str = "count(*)", digits: int | None = 2) -> str:
    value = f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100"
    return value if digits is None else f"round({value}, {digits})"


check(
    "silver_quality_metrics",
    f"""SELECT count(*) AS total_records, count(DISTINCT id) AS unique_ids,
  count(*) FILTER (WHERE name IS NULL) AS null_names, count(*) FILTER (WHERE brewery_type IS NULL) AS null_types,
  count(*) FILTER (WHERE country IS NULL) AS null_countries, count(*) FILTER (WHERE state IS NULL) AS null_states,
  count(*) FILTER (WHERE has_coordinates) AS with_coordinates, count(*) FILTER (WHERE has_contact) AS with_contact,
  count(*) FILTER (WHERE is_complete) AS complete_records, {_pct('count(*) FILTER (WHERE is_complete)')} AS completeness_rate,
  {_pct('count(*) FILTER (WHERE has_coordinates)')} AS coordinate_coverage,
  {_pct('count(*) FILTER (WHERE has_contact)')} AS contact_coverage FROM silver""",
    "silver",
)
check(
    "silver_counts_by_dim",
    """SELECT 'by_type' AS dimension, brewery_type_normalized AS value, count(*) AS count FROM silver GROUP BY 2
 UNION ALL SELECT 'by_country', country_normalized, count(*) FROM silver GROUP BY 2""",
    "silver",
)
_SILVER_COLUMNS = [
    *LISTING_COLUMNS, "country_normalized", "brewery_type_normalized", "full_address", "location_key",
    "has_coordinates", "has_contact", "is_complete", "silver_processed_at", "processing_date",
    "processing_year", "processing_month", "coordinates_valid",
]
check(
    "profile_table",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count,"
        f" CAST({len(_SILVER_COLUMNS)} AS BIGINT) AS column_count,"
        " count(*) - count(DISTINCT id) AS duplicate_count FROM silver"
        for c in _SILVER_COLUMNS
    )
    + ") WHERE null_count > 0",
    "silver",
)
check(
    "silver_statistics",
    """SELECT 'total_records' AS dimension, CAST(NULL AS VARCHAR) AS value, count(*) AS count FROM silver
 UNION ALL SELECT 'columns', c, NULL FROM (VALUES """
    + ", ".join(f"('{c}')" for c in _SILVER_COLUMNS)
    + """) AS t(c)
 UNION ALL SELECT 'partitions', c, NULL FROM (VALUES ('country_normalized'), ('state')) AS t(c)
 UNION ALL SELECT * FROM (SELECT 'by_country', country_normalized, count(*) FROM silver GROUP BY 2
                          ORDER BY 3 DESC, 2 NULLS FIRST LIMIT 10)
 UNION ALL SELECT * FROM (SELECT 'by_state', state, count(*) FROM silver WHERE state IS NOT NULL GROUP BY 2
                          ORDER BY 3 DESC, 2 LIMIT 10)
 UNION ALL SELECT 'by_type', brewery_type_normalized, count(*) FROM silver GROUP BY 2""",
    "silver",
)
check(
    "state_coverage",
    """SELECT country_normalized, state, count(*) AS brewery_count,
  CAST(count(*) FILTER (WHERE coordinates_valid) AS DOUBLE) / count(*) AS valid_share,
  CAST(count(*) FILTER (WHERE is_complete) AS DOUBLE) / count(*) AS complete_share
 FROM silver WHERE state IS NOT NULL GROUP BY 1, 2""",
    "silver",
)

# ---- lookup -----------------------------------------------------------------

check("lookup_coordinates", "SELECT * FROM found", "found")
check(
    "apply_lookup",
    "SELECT id, name, latitude, longitude, has_coordinates, is_complete, geocoded_source FROM filled",
    "filled",
)
check(
    "apply_lookup_capped",
    """SELECT c.id, name, CASE WHEN h.id IS NOT NULL THEN found_latitude ELSE latitude END AS latitude,
  CASE WHEN h.id IS NOT NULL THEN found_longitude ELSE longitude END AS longitude,
  h.id IS NOT NULL OR has_coordinates AS has_coordinates,
  (h.id IS NOT NULL OR has_coordinates) AND has_contact AND city IS NOT NULL AND state IS NOT NULL AS is_complete
 FROM cleaned c LEFT JOIN found_100_hits h ON c.id = h.id""",
    "cleaned",
    "found_100_hits",
)
check(
    "lookup_coverage",
    f"""SELECT total_records, before_with, before_missing,
  {_pct('before_with', 'total_records')} AS before_percent, after_with,
  total_records - after_with AS after_missing, {_pct('after_with', 'total_records')} AS after_percent,
  after_with - before_with AS new_coordinates,
  {_pct('(after_with - before_with)', 'before_missing')} AS improvement_percent, attempted, successful,
  attempted - successful AS failed, {_pct('successful', 'before_missing')} AS success_rate,
  {_pct('successful', 'attempted')} AS success_rate_attempted
 FROM (SELECT (SELECT count(*) FROM cleaned) AS total_records,
   (SELECT count(*) FROM cleaned WHERE has_coordinates) AS before_with,
   (SELECT count(*) FROM cleaned WHERE NOT has_coordinates) AS before_missing,
   (SELECT count(*) FROM filled WHERE has_coordinates) AS after_with,
   (SELECT CAST(sum(copies) AS BIGINT) FROM found) AS attempted,
   (SELECT CAST(sum(copies) AS BIGINT) FROM found WHERE found_level IS NOT NULL) AS successful)""",
    "cleaned",
    "filled",
    "found",
)
check(
    "layer_reconciliation",
    """SELECT b AS records_ingested, s AS records_transformed, CAST(b - s AS DOUBLE) / b * 100 AS data_loss_rate,
  CAST(s AS DOUBLE) / b * 100 AS retention_rate, CAST(b - s AS DOUBLE) / b * 100 > 5 AS loss_warning
 FROM (SELECT count(*) AS b, count(DISTINCT id) AS s FROM sites)""",
    "sites",
)
check("union_batches", "SELECT * FROM sites", "sites")

# ---- reporting tables -------------------------------------------------------

for _name, _table in {
    "gold_by_type": "breweries_by_type",
    "gold_by_country": "breweries_by_country",
    "gold_by_state": "breweries_by_state",
    "gold_by_type_and_country": "breweries_by_type_and_country",
    "gold_by_type_and_state": "breweries_by_type_and_state",
    "gold_summary": "brewery_summary_statistics",
}.items():
    check(_name, f"SELECT * FROM {_table}", _table)
for _name in ("gold_by_state", "gold_summary"):
    ORACLE[f"incremental_{_name}"] = ORACLE[_name]
check(
    "gold_build_report",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}" for t in GOLD_SCHEMAS),
    *GOLD_SCHEMAS,
)

# ---- report queries ---------------------------------------------------------

cte(
    "cells",
    """SELECT round_even(latitude, 1) AS lat_rounded, round_even(longitude, 1) AS lon_rounded, count(id) AS count,
  first(city ORDER BY city NULLS LAST, state NULLS LAST, country_normalized NULLS LAST) AS city,
  first(state ORDER BY city NULLS LAST, state NULLS LAST, country_normalized NULLS LAST) AS state,
  first(country_normalized ORDER BY city NULLS LAST, state NULLS LAST, country_normalized NULLS LAST)
    AS country_normalized
 FROM map_rows GROUP BY 1, 2""",
    "map_rows",
)
check("density_grid", "SELECT * FROM cells", "cells")
check(
    "top_density_cells",
    """SELECT lat_rounded, lon_rounded, count,
  concat_ws(', ', coalesce(city, 'N/A'), nullif(state, '')) AS location
 FROM cells ORDER BY count DESC, lat_rounded, lon_rounded LIMIT 10""",
    "cells",
)
check(
    "top_cities",
    """SELECT city, state, country_normalized, count(*) AS count FROM map_rows
 WHERE city IS NOT NULL AND state IS NOT NULL AND country_normalized IS NOT NULL GROUP BY 1, 2, 3
 ORDER BY 4 DESC, 1, 2, 3 LIMIT 10""",
    "map_rows",
)
check(
    "country_centroids",
    """SELECT country_normalized, count(name) AS total, avg(latitude) AS mean_latitude,
  avg(longitude) AS mean_longitude FROM map_rows WHERE country_normalized IS NOT NULL GROUP BY 1""",
    "map_rows",
)
check(
    "selection_metrics",
    """SELECT count(*) AS row_count, count(DISTINCT country_normalized) AS countries,
  count(DISTINCT brewery_type_normalized) AS types FROM map_rows""",
    "map_rows",
)
check(
    "selector_domains",
    """SELECT DISTINCT 'country' AS selector, country_normalized AS value FROM map_rows
  WHERE country_normalized IS NOT NULL
 UNION ALL SELECT DISTINCT 'type', brewery_type_normalized FROM map_rows
  WHERE brewery_type_normalized IS NOT NULL""",
    "map_rows",
)
check(
    "top_countries",
    """SELECT country_normalized, brewery_count FROM breweries_by_country
 ORDER BY brewery_count DESC, country_normalized NULLS FIRST LIMIT 20""",
    "breweries_by_country",
)
check(
    "top_countries_excluding",
    """SELECT country_normalized, brewery_count FROM breweries_by_country
 WHERE country_normalized IS DISTINCT FROM 'United States'
 ORDER BY brewery_count DESC, country_normalized NULLS FIRST LIMIT 19""",
    "breweries_by_country",
)
cte(
    "top_states",
    """SELECT * EXCLUDE (aggregation_timestamp) FROM breweries_by_state
 ORDER BY brewery_count DESC, country_normalized NULLS FIRST, state LIMIT 20""",
    "breweries_by_state",
)
check("top_states", "SELECT * FROM top_states", "top_states")
check(
    "country_state_rollup",
    """SELECT country_normalized, state, CAST(grouping(country_normalized) + grouping(state) AS INTEGER) AS level,
  CAST(sum(brewery_count) AS BIGINT) AS brewery_count
 FROM top_states GROUP BY ROLLUP (country_normalized, state)""",
    "top_states",
)
check(
    "type_share",
    """SELECT brewery_type_normalized, brewery_count,
  CAST(brewery_count AS DOUBLE) / CAST(sum(brewery_count) OVER () AS DOUBLE) * 100 AS share_percent,
  row_number() OVER (ORDER BY brewery_count DESC, brewery_type_normalized NULLS FIRST) = 1 AS most_common
 FROM breweries_by_type""",
    "breweries_by_type",
)
check(
    "type_mix_by_state",
    """SELECT country_normalized, state, brewery_type_normalized, brewery_count, CAST(brewery_count AS DOUBLE)
  / CAST(sum(brewery_count) OVER (PARTITION BY country_normalized, state) AS DOUBLE) AS type_share
 FROM breweries_by_type_and_state""",
    "breweries_by_type_and_state",
)
check(
    "type_mix_by_country",
    """SELECT country_normalized, brewery_type_normalized, brewery_count, CAST(brewery_count AS DOUBLE)
  / CAST(sum(brewery_count) OVER (PARTITION BY country_normalized) AS DOUBLE) AS type_share
 FROM breweries_by_type_and_country""",
    "breweries_by_type_and_country",
)
_COORD = _pct("with_coordinates", "total_breweries", None)
_CONTACT = _pct("with_contact", "total_breweries", None)
check(
    "quality_scorecard",
    f"""SELECT {_COORD} AS coordinate_percent, {_CONTACT} AS contact_percent, with_coordinates, with_contact,
  total_breweries - with_coordinates AS without_coordinates, complete_records,
  {_pct('complete_records', 'total_breweries', None)} AS complete_percent,
  ({_COORD} + {_CONTACT}) / 2 AS overall_quality FROM brewery_summary_statistics""",
    "brewery_summary_statistics",
)
check(
    "header_metrics",
    f"""SELECT total_breweries, distinct_countries AS total_countries, distinct_types AS total_types,
  {_COORD} AS coordinate_coverage FROM brewery_summary_statistics""",
    "brewery_summary_statistics",
)
check(
    "country_share",
    f"""SELECT 'United States' AS country, brewery_count,
  {_pct('brewery_count', '(SELECT total_breweries FROM brewery_summary_statistics)', None)} AS share_percent
 FROM breweries_by_country WHERE country_normalized = 'United States'""",
    "breweries_by_country",
    "brewery_summary_statistics",
)

# ---- rules ------------------------------------------------------------------


def _rule(suite, rule, column, considered, unexpected, observed, threshold, success, source) -> str:
    column = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT '{suite}' AS suite, '{rule}' AS rule, {column} AS \"column\","
        f" CAST({considered} AS BIGINT) AS considered, CAST({unexpected} AS BIGINT) AS unexpected,"
        f" CAST({observed} AS DOUBLE) AS observed, '{threshold}' AS threshold, {success} AS success FROM {source}"
    )


def _mostly(suite, rule, column, mostly, considered, holds, source) -> str:
    n, good = f"count(*) FILTER (WHERE {considered})", f"count(*) FILTER (WHERE ({considered}) AND ({holds}))"
    share = f"CAST({good} AS DOUBLE) / nullif({n}, 0)"
    return _rule(
        suite, rule, column, n, f"{n} - {good}", share, f"{mostly:g}", f"coalesce({share} >= {mostly}, true)", source
    )


def _not_null(suite, column, mostly, source):
    return _mostly(suite, "not_null", column, mostly, "true", f"{column} IS NOT NULL", source)


def _in_set(suite, column, values, mostly, source):
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return _mostly(suite, "in_set", column, mostly, f"{column} IS NOT NULL", f"{column} IN ({listed})", source)


def _between(suite, column, low, high, mostly, source):
    return _mostly(
        suite, "between", column, mostly, f"{column} IS NOT NULL", f"{column} BETWEEN {low} AND {high}", source
    )


def _rows(suite, low, high, source):
    return _rule(
        suite, "row_count", None, "count(*)", "NULL", "count(*)", f"{low}..{high}",
        f"count(*) BETWEEN {low} AND {high}", source,
    )


def _unique(suite, source):
    return _mostly(
        suite, "unique", "id", 1, "id IS NOT NULL", "copies = 1",
        f"(SELECT id, count(*) OVER (PARTITION BY id) AS copies FROM {source})",
    )


def _contains(suite, column, value, source):
    hits = f"count(*) FILTER (WHERE {column} = '{value}')"
    return _rule(suite, "contains", column, f"count({column})", "NULL", hits, value, f"{hits} > 0", source)


def _top(suite, column, value, k, source):
    hits = f"count(*) FILTER (WHERE {column} = '{value}')"
    top = f"(SELECT * FROM {source} ORDER BY brewery_count DESC, {column} NULLS FIRST LIMIT {k})"
    return _rule(
        suite, "top_entity", column, "count(*)", "NULL", hits, f"{value} in top {k}", f"{hits} > 0", top
    )


def _sums(suite, expected, source):
    shown = f"' || CAST({expected} AS VARCHAR) || '"
    return _rule(
        suite, "sum_matches", "brewery_count", "count(*)", "NULL", "sum(brewery_count)", shown,
        f"sum(brewery_count) = {expected}", source,
    )


def _union(*selects: str) -> str:
    return "\nUNION ALL ".join(selects)


check("rule_unique", _unique("check", "sites"), "sites")
check(
    "rule_not_null",
    _union(*[_not_null("check", c, m, "sites") for c, m in (("id", 1), ("name", 0.99), ("brewery_type", 0.95))]),
    "sites",
)
check("rule_row_count", _rows("check", 5000, 50000, "sites"), "sites")
check(
    "rule_in_set",
    _union(
        _in_set("check", "brewery_type", ["Brew Pub", "BUILDING", "MACHINERY"], 0.95, "sites"),
        _in_set("check", "brewery_type", ["Brew Pub"], 0.1, "sites"),
    ),
    "sites",
)
check(
    "rule_between",
    _union(
        _between("check", "latitude", -90, 90, 0.5, "sites"), _between("check", "longitude", -180, 180, 1, "sites")
    ),
    "sites",
)
check(
    "rule_columns",
    # The listings have their declared columns, so none is wrong.
    _rule("check", "columns", None, "16", "0", "16", "16", "true", "(SELECT count(*) FROM sites)"),
    "sites",
)
_BRONZE = "bronze_quality_suite"
_bronze = _union(
    _unique(_BRONZE, "sites"),
    _not_null(_BRONZE, "id", 1, "sites"),
    _not_null(_BRONZE, "name", 0.99, "sites"),
    _not_null(_BRONZE, "brewery_type", 0.95, "sites"),
    _rows(_BRONZE, 5000, 50000, "sites"),
    _in_set(_BRONZE, "brewery_type", KNOWN_TYPES, 0.95, "sites"),
    _between(_BRONZE, "latitude", -90, 90, 0.5, "sites"),
    _between(_BRONZE, "longitude", -180, 180, 0.5, "sites"),
)
check("validate_bronze", _bronze, "sites")


def _pair(suite):
    return _mostly(
        suite, "pair_present", "latitude", 0.85, "true", "latitude IS NOT NULL AND longitude IS NOT NULL", "silver"
    )


def _width(suite):
    n = len(_SILVER_COLUMNS)
    return _rule(
        suite, "column_count", None, n, "NULL", n, "20..30", f"{n} BETWEEN 20 AND 30", "(SELECT count(*) FROM silver)"
    )


check("rule_pair_coverage", _pair("check"), "silver")
check("rule_column_count", _width("check"), "silver")
check("rule_valid_share", _in_set("check", "coordinates_valid", [True], 0.85, "silver"), "silver")
check(
    "rule_no_null_island",
    _mostly(
        "check", "no_null_island", "latitude", 1, "true",
        "NOT coalesce(abs(latitude) < 0.1 AND abs(longitude) < 0.1, false)", "silver",
    ),
    "silver",
)
check("rule_group_counts", _between("check", "brewery_count", 1, 50000, 1, "breweries_by_type"), "breweries_by_type")
check(
    "rule_top_entity",
    _union(
        _top("check", "brewery_type_normalized", "brew_pub", 1, "breweries_by_type"),
        _top("check", "brewery_type_normalized", "micro", 3, "breweries_by_type"),
    ),
    "breweries_by_type",
)
check(
    "rule_contains",
    _union(
        _contains("check", "country_normalized", "United States", "breweries_by_country"),
        _contains("check", "country_normalized", "Peru", "breweries_by_country"),
    ),
    "breweries_by_country",
)
_IN_STATE, _TOTAL = "(SELECT count(state) FROM silver)", "(SELECT count(*) FROM silver)"
check(
    "rule_sum_matches",
    _union(_sums("check", _IN_STATE, "breweries_by_state"), _sums("check", _TOTAL, "breweries_by_state")),
    "breweries_by_state",
)
_SILVER = "silver_quality_suite"
_silver = _union(
    _rows(_SILVER, 5000, 50000, "silver"),
    _not_null(_SILVER, "country_normalized", 1, "silver"),
    _pair(_SILVER),
    _in_set(_SILVER, "coordinates_valid", [True, False], 1, "silver"),
    _width(_SILVER),
)


def _gold_suite(table: str) -> list[str]:
    suite = f"gold_{table}_suite"
    if table == "breweries":
        return [_rows(suite, 1, 2**63 - 1, table)]
    found = [_rows(suite, 1, 10000, table)]
    if table != "brewery_summary_statistics":
        found.append(_between(suite, "brewery_count", 1, 50000, 1, table))
        found.append(_sums(suite, _IN_STATE if table.endswith("state") else _TOTAL, table))
    if table == "breweries_by_country":
        found.append(_contains(suite, "country_normalized", "United States", table))
        found.append(_top(suite, "country_normalized", "United States", 3, table))
    if table == "breweries_by_type":
        found.append(_contains(suite, "brewery_type_normalized", "micro", table))
        found.append(_top(suite, "brewery_type_normalized", "micro", 1, table))
    return found


_TABLES = list(GOLD_SCHEMAS)
_gold = _union(*[rule for table in _TABLES for rule in _gold_suite(table)])
_SUMMARY = (
    "SELECT suite, count(*) AS total_expectations, count(*) FILTER (WHERE success) AS passed_expectations,"
    " count(*) FILTER (WHERE NOT success) AS failed_expectations_count, bool_and(success) AS success,"
    f" {_pct('count(*) FILTER (WHERE success)')} AS success_rate FROM (\n{{}}\n) GROUP BY suite"
)
check("validate_silver", _SUMMARY.format(_silver), "silver")
check("validate_gold", _SUMMARY.format(_gold), "silver", *_TABLES)
_layers = _union(
    f"SELECT 'bronze' AS layer, success FROM (\n{_bronze})",
    f"SELECT 'silver' AS layer, success FROM (\n{_silver})",
    f"SELECT 'gold' AS layer, success FROM (\n{_gold})",
)
check(
    "validation_summary",
    f"""SELECT coalesce(layer, 'overall') AS layer, count(*) AS total_expectations,
  count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed, {_pct('count(*) FILTER (WHERE success)')} AS success_rate,
  bool_and(success) AS success FROM ({_layers}) GROUP BY ROLLUP (layer)""",
    "sites",
    "silver",
    *_TABLES,
)
check(
    "volume_anomaly",
    """SELECT run_date, current_count, previous_count, variance, coalesce(variance > 0.20, false) AS anomaly
 FROM (SELECT *, CAST(abs(current_count - previous_count) AS DOUBLE) / nullif(previous_count, 0) AS variance
       FROM (SELECT run_date, records AS current_count, lag(records) OVER (ORDER BY run_date) AS previous_count
             FROM runs))""",
    "runs",
)
