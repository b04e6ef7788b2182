"""The same results in DuckDB SQL, written against the driver tables."""

from __future__ import annotations

# Columns of the feature table that the full linear models read.
WIDE = ("year", "quarter", "month", "median_list_price", "homes_sold", "inventory", "lat", "lng", "zipcode_freq", "city_full_encoded")


def linear_fit(name: str, rows: str, alpha: float, width: int = len(WIDE)) -> str:
    """Steps that fit ``price`` to the list ``x`` of ``rows``: missing values take the
    mean, columns are scaled by their population deviation, the Gram matrix has
    ``alpha`` on its diagonal and is eliminated column by column. ``{name}`` is one
    row of lists: weight, mean and deviation by column, and the mean price."""
    steps = [
        f"""{name}_mean AS MATERIALIZED (SELECT i, avg(x[i]) AS m FROM {rows}, range(1, {width + 1}) r(i) GROUP BY i),
{name}_dev AS MATERIALIZED (
  SELECT i, any_value(m) AS m, stddev_pop(coalesce(x[i], m)) AS d FROM {rows} CROSS JOIN {name}_mean GROUP BY i),
{name}_scale AS MATERIALIZED (SELECT list(m ORDER BY i) AS m, list(d ORDER BY i) AS d, (SELECT avg(price) FROM {rows}) AS y FROM {name}_dev),
{name}_rows AS MATERIALIZED (
  SELECT list_transform(range(1, {width + 1}), lambda i: (coalesce(x[i], m[i]) - m[i]) / d[i]) || [price - y] AS z FROM {rows}, {name}_scale),
{name}_0 AS MATERIALIZED (
  SELECT i, j, sum(z[i] * z[j]) + CASE WHEN i = j THEN {alpha} ELSE 0 END AS v
  FROM {name}_rows, range(1, {width + 1}) r(i), range(1, {width + 2}) c(j) GROUP BY i, j)"""
    ]
    for k in range(1, width + 1):
        old = f"{name}_{k - 1}"
        steps.append(
            f"""{name}_{k} AS MATERIALIZED (
  SELECT g.i, g.j, CASE WHEN g.i = {k} THEN g.v / p.v ELSE g.v - h.v * t.v / p.v END AS v
  FROM {old} g JOIN {old} t ON t.i = {k} AND t.j = g.j JOIN {old} h ON h.i = g.i AND h.j = {k}
  CROSS JOIN (SELECT v FROM {old} WHERE i = {k} AND j = {k}) p)"""
        )
    steps.append(f"{name} AS MATERIALIZED (SELECT (SELECT list(v ORDER BY i) FROM {name}_{width} WHERE j = {width + 1}) AS w, m, d, y FROM {name}_scale)")
    return ",\n".join(steps)


def linear_value(x: str, width: int = len(WIDE)) -> str:
    """The prediction for a list of values by the lists of a fit."""
    return f"y + list_sum(list_transform(range(1, {width + 1}), lambda i: w[i] * (coalesce(({x})[i], m[i]) - m[i]) / d[i]))"


def wide_list(**given: str) -> str:
    """The features as a list of doubles, some of them spelled out."""
    return "[" + ", ".join(f"CAST({given.get(c, c)} AS DOUBLE)" for c in WIDE) + "]"


# Named steps that the queries below build on.
_STEPS = """
WITH RECURSIVE order_lines AS (
  SELECT l_orderkey,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS price,
         max(l_extendedprice) AS median_list_price,
         min(l_extendedprice) AS median_sale_price,
         sum(l_quantity) AS homes_sold,
         CAST(count(*) AS DOUBLE) AS inventory
  FROM lineitem GROUP BY l_orderkey
),
listing AS (
  SELECT o_orderkey * 2 + copy AS row_id,
         o_orderdate + to_days(CAST(31 * copy AS INTEGER)) AS date,
         CAST(year(o_orderdate + to_days(CAST(31 * copy AS INTEGER))) AS INTEGER) AS year,
         o_custkey AS zipcode,
         c_mktsegment AS city,
         '  ' || n_name || '—' || r_name || ' ' AS city_full,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN median_list_price END AS median_list_price,
         median_sale_price, homes_sold, inventory, price
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN order_lines ON o_orderkey = l_orderkey
  JOIN (VALUES (0), (1)) AS copies(copy) ON copy = 0 OR o_orderstatus = 'P'
),
tagged AS (
  SELECT *, CASE WHEN date < TIMESTAMP '1999-01-01' THEN 'train'
                 WHEN date < TIMESTAMP '2001-01-01' THEN 'eval' ELSE 'holdout' END AS split
  FROM listing WHERE date IS NOT NULL
),
metro AS (
  SELECT s_suppkey AS row_id, n_name || '–' || r_name || ', XX' AS metro_full,
         s_acctbal / 100 AS lat, CAST(s_suppkey AS DOUBLE) AS lng
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'ASIA'
),
metro_named AS (
  SELECT row_id, lat, lng,
         split_part(trim(regexp_replace(replace(replace(lower(metro_full), '–', '-'), '—', '-'), '\\s+', ' ', 'g')), ',', 1) AS metro_full
  FROM metro
),
lookup AS (
  SELECT metro_full, lat, lng FROM (
    SELECT *, row_number() OVER (PARTITION BY metro_full ORDER BY row_id) AS rn FROM metro_named) WHERE rn = 1
),
plain AS (
  SELECT * REPLACE ({PLAIN_CITY} AS city_full) FROM tagged
),
named AS (
  SELECT * REPLACE ({MAPPED_CITY} AS city_full) FROM plain
),
placed AS (
  SELECT named.*, lat, lng FROM named LEFT JOIN lookup ON city_full IS NOT DISTINCT FROM metro_full
),
unique_rows AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY split, zipcode, city, city_full, median_list_price, median_sale_price, homes_sold, inventory, price, lat, lng
      ORDER BY date NULLS LAST, row_id) AS rn
    FROM placed) WHERE rn = 1
),
cleaned AS (
  SELECT * FROM unique_rows WHERE median_list_price IS NULL OR median_list_price <= 100000
),
freq AS (
  SELECT zipcode, count(*) AS zipcode_freq FROM cleaned WHERE split = 'train' GROUP BY zipcode
),
prior AS (SELECT avg(price) AS prior FROM cleaned WHERE split = 'train'),
city_means AS (
  SELECT city_full, count(price) AS n, avg(price) AS mean FROM cleaned
  WHERE split = 'train' AND price IS NOT NULL GROUP BY city_full
),
city_codes AS (
  SELECT city_full, n, mean,
         prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0))) + mean * (1 / (1 + exp(-(n - 20) / 10.0))) AS city_full_encoded
  FROM city_means, prior
),
encoded AS (
  SELECT cleaned.*, coalesce(zipcode_freq, 0) AS zipcode_freq, coalesce(city_full_encoded, prior) AS city_full_encoded, prior
  FROM cleaned
  LEFT JOIN freq ON cleaned.zipcode IS NOT DISTINCT FROM freq.zipcode
  LEFT JOIN city_codes ON cleaned.city_full IS NOT DISTINCT FROM city_codes.city_full
  CROSS JOIN prior
),
labelled AS (SELECT * FROM encoded WHERE price IS NOT NULL),
wide AS MATERIALIZED (
  SELECT row_id, split, price, {WIDE_ROW} AS x FROM encoded
),
wide_train AS MATERIALIZED (SELECT x, price FROM wide WHERE split = 'train' AND price IS NOT NULL),
{OLS},
fit AS (
  SELECT regr_slope(price, homes_sold) AS slope, regr_intercept(price, homes_sold) AS intercept,
         avg(homes_sold) AS mean_x, stddev_pop(homes_sold) AS dev_x, avg(price) AS mean_y,
         regr_sxy(price, homes_sold) AS sxy, regr_sxx(price, homes_sold) AS sxx, count(*) AS n
  FROM labelled WHERE split = 'train'
),
model_predictions AS (
  SELECT split, price, 'dummy' AS model, prior AS predicted FROM labelled
  UNION ALL SELECT split, price, 'city', city_full_encoded FROM labelled
),
model_wide AS (
  SELECT model, split, avg(abs(predicted - price)) AS mae, sqrt(avg((predicted - price) ** 2)) AS rmse,
         1 - sum((predicted - price) ** 2) / (var_pop(price) * count(*)) AS r2
  FROM model_predictions GROUP BY model, split
),
model_long AS (
  SELECT model, split, unnest(['mae', 'rmse', 'r2']) AS metric, unnest([mae, rmse, r2]) AS value FROM model_wide
),
model_gap AS (
  SELECT model, split, metric, value FROM model_long WHERE split IN ('train', 'eval')
  UNION ALL
  SELECT model, 'gap', metric, max(value) FILTER (WHERE split = 'eval') - max(value) FILTER (WHERE split = 'train')
  FROM model_long GROUP BY model, metric
),
winner AS (
  SELECT model, 'rmse' AS metric, value FROM model_gap WHERE split = 'eval' AND metric = 'rmse'
  ORDER BY value, CASE model WHEN 'dummy' THEN 1 ELSE 2 END LIMIT 1
),
loads AS (
  SELECT 'listings_' || split AS name, split, CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month, count(*) AS n_rows
  FROM tagged GROUP BY ALL
),
versions AS (
  SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY month) AS INTEGER) AS version,
         'splits/split=' || split || '/month=' || month AS path, n_rows
  FROM loads
),
batches AS (
  SELECT CAST(row_id // 3000 AS VARCHAR) || CASE WHEN row_id // 2 % 1500 < 1100 THEN '-first' ELSE '-rest' END AS batch_id, *
  FROM listing
),
batch_counts AS (
  SELECT batch_id, count(*) AS n_records, count(*) BETWEEN 1 AND 1000 AS accepted FROM batches GROUP BY batch_id
),
holdout_unique AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY zipcode, city, city_full, median_list_price, median_sale_price, homes_sold, inventory, price
      ORDER BY row_id) AS rn
    FROM named WHERE split = 'holdout') WHERE rn = 1
),
file_scored AS (
  SELECT * EXCLUDE (price, w, m, d, y), {WIDE_VALUE} AS predicted_price, price AS actual_price, {WIDE_VALUE} - price AS prediction_error
  FROM (
    SELECT row_id, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
           median_list_price, homes_sold, inventory, lat, lng, coalesce(zipcode_freq, 0) AS zipcode_freq,
           coalesce(city_full_encoded, prior) AS city_full_encoded, price
    FROM holdout_unique AS h
    LEFT JOIN lookup ON h.city_full IS NOT DISTINCT FROM metro_full
    LEFT JOIN freq ON h.zipcode IS NOT DISTINCT FROM freq.zipcode
    LEFT JOIN city_codes ON h.city_full IS NOT DISTINCT FROM city_codes.city_full
    CROSS JOIN prior
    WHERE median_list_price IS NULL OR median_list_price <= 100000) CROSS JOIN ols
),
request_rows AS (
    SELECT l.* EXCLUDE (year), CAST(year(date) AS INTEGER) AS year, quarter(date) AS quarter, month(date) AS month, lat, lng,
           coalesce(zipcode_freq, 0) AS zipcode_freq, coalesce(city_full_encoded, prior) AS city_full_encoded
    FROM ({NAMED_LISTING}) AS l
    LEFT JOIN lookup ON l.city_full IS NOT DISTINCT FROM metro_full
    LEFT JOIN freq ON l.zipcode IS NOT DISTINCT FROM freq.zipcode
    LEFT JOIN city_codes ON l.city_full IS NOT DISTINCT FROM city_codes.city_full
    CROSS JOIN prior
),
request_scored AS (
  SELECT row_id AS request_id, price,
         CASE WHEN median_list_price IS NULL OR median_list_price <= 100000
              THEN {REQUEST_VALUE} END AS predicted_price,
         list_filter([
           CASE WHEN median_sale_price IS NULL THEN 'median_sale_price' END,
           CASE WHEN median_list_price IS NULL THEN 'median_list_price' END,
           'median_ppsf', 'median_list_ppsf',
           CASE WHEN homes_sold IS NULL THEN 'homes_sold' END,
           'pending_sales', 'new_listings',
           CASE WHEN inventory IS NULL THEN 'inventory' END,
           'median_dom', 'avg_sale_to_list', 'sold_above_list', 'off_market_in_two_weeks',
           'bank', 'bus', 'hospital', 'mall', 'park', 'restaurant', 'school', 'station', 'supermarket',
           'total_population', 'median_age', 'per_capita_income', 'total_families_below_poverty',
           'total_housing_units', 'median_rent', 'median_home_value', 'total_labor_force',
           'unemployed_population', 'total_school_age_population', 'total_school_enrollment', 'median_commute_time'
         ], lambda x: x IS NOT NULL) AS missing,
         CASE WHEN median_list_price > 100000 THEN 'price_above_limit' END AS reject_reason
  FROM request_rows CROSS JOIN ols
),
requests_shown AS (
  SELECT request_id, price, round(predicted_price) AS predicted_price,
         array_to_string(missing, ',') AS missing_features, CAST(len(missing) AS INTEGER) AS missing_optional_count,
         reject_reason
  FROM request_scored
),
bodies AS (
  SELECT 'listing-' || CAST(row_id AS VARCHAR) AS request_id,
         '{"date": "' || strftime(date, '%Y-%m-%d') || '", "city_full": "' || trim(city_full)
         || CASE WHEN city = 'MACHINERY' THEN '"' ELSE '", "city": "' || city || '"' END
         || ', "zipcode": ' || CASE WHEN homes_sold > 100 THEN '"' || CAST(zipcode AS VARCHAR) || '"' ELSE CAST(zipcode AS VARCHAR) END
         || ', "median_list_price": '
         || CASE WHEN median_list_price IS NULL AND inventory IS NOT NULL THEN '"not specified"'
                 ELSE coalesce(CAST(CAST(median_list_price AS DECIMAL(12,2)) AS VARCHAR), 'null') END
         || '}' AS body
  FROM listing
  UNION ALL
  SELECT 'event-' || CAST(event_id AS VARCHAR), props FROM events
),
body_fields AS (
  SELECT request_id, body, json_keys(body) AS keys,
         json_type(body, '$.median_list_price') AS price_type
  FROM bodies
),
body_reasons AS (
  SELECT request_id, body, list_sort(
    list_transform(list_filter(['date', 'city_full', 'city', 'zipcode'], lambda f: NOT list_contains(keys, f)), lambda f: 'missing:' || f)
    || list_transform(list_filter(keys, lambda f: NOT list_contains(['date', 'city_full', 'city', 'zipcode', 'median_list_price'], f)), lambda f: 'unknown:' || f)
    || CASE WHEN price_type = 'VARCHAR' AND TRY_CAST(json_extract_string(body, '$.median_list_price') AS DOUBLE) IS NULL
            THEN ['type:median_list_price'] ELSE [] END) AS reasons
  FROM body_fields
),
body_values AS (
  SELECT row_id, 'listing-' || CAST(row_id AS VARCHAR) AS request_id, median_list_price > 100000 AS above,
         CASE WHEN median_list_price IS NULL OR median_list_price <= 100000 THEN {BODY_VALUE} END AS predicted_price
  FROM request_rows CROSS JOIN ols
),
nested AS (
  SELECT row_id, row_id // 3200 AS run, 'listing-' || CAST(row_id AS VARCHAR) AS request_id,
         CASE WHEN row_id // 2 % 1600 < 1100 THEN 'large' WHEN row_id // 2 % 1600 < 1300 THEN 'clean'
              WHEN row_id // 2 % 1600 < 1500 THEN 'mixed' ELSE 'noted' END AS kind
  FROM listing
),
nested_records AS (
  SELECT n.kind || '-' || CAST(run AS VARCHAR) AS batch_id, n.kind, reasons, predicted_price,
         row_number() OVER (PARTITION BY run, n.kind ORDER BY n.row_id) - 1 AS place
  FROM nested n JOIN body_reasons b USING (request_id) JOIN body_values v USING (request_id)
),
nested_sizes AS (
  SELECT batch_id, any_value(kind) AS kind, count(*) AS n_records, count(predicted_price) AS rows_predicted,
         round(sum(predicted_price), -2) AS predicted_sum,
         string_agg(array_to_string(list_transform(reasons, lambda r: 'records[' || CAST(place AS VARCHAR) || '].' || r), ','), ',' ORDER BY place)
           FILTER (WHERE kind IN ('mixed', 'large') AND len(reasons) > 0) AS bad
  FROM nested_records GROUP BY batch_id
),
nested_told AS (
  SELECT *, concat_ws(',', CASE WHEN kind = 'noted' THEN 'unknown:note' END, CASE WHEN n_records > 1000 THEN 'too_many' ELSE bad END) AS reject_reasons
  FROM nested_sizes
)
"""

_PRICE_TEXT = """(
  SELECT row_id, CASE WHEN inventory IS NULL THEN NULL
         ELSE coalesce(CAST(CAST(median_list_price AS DECIMAL(12,2)) AS VARCHAR), 'not specified') END AS median_list_price
  FROM listing)"""

_BODIES: dict[str, str] = {
    "temporal_split": "SELECT * FROM tagged",
    "eval_rows": """
        SELECT * RENAME (o_orderdate AS date), 'eval' AS split FROM orders
        WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'""",
    "profile_of_splits": """
        SELECT split, count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns,
               min(date) AS first_date, max(date) AS last_date FROM tagged GROUP BY split""",
    "normalize_city_names": "SELECT row_id, city_full FROM plain",
    "normalize_metro_names": "SELECT row_id, metro_full FROM metro_named",
    "city_mapping": "SELECT row_id, city_full FROM named",
    "lenient_numbers": f"""
        SELECT row_id, median_list_price, TRY_CAST(median_list_price AS DOUBLE) AS value FROM {_PRICE_TEXT}""",
    "null_when_nan": "SELECT row_id, median_list_price, median_list_price IS NULL AS is_null, false AS is_nan FROM listing",
    "parsed_dates": """
        SELECT row_id, CAST(date AS DATE) AS date, split, CAST(year(date) AS INTEGER) AS year,
               CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month FROM tagged""",
    "lookup_keep_first": "SELECT * FROM lookup",
    "lookup_from_file": "SELECT * FROM lookup",
    "location_join": "SELECT row_id, city_full, lat, lng FROM placed",
    "unmatched_cities": "SELECT DISTINCT city_full FROM placed WHERE lat IS NULL",
    "dedup_keep_first": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY split, zipcode, city, city_full, median_list_price, median_sale_price, homes_sold, inventory, price
            ORDER BY date NULLS LAST, row_id) AS rn FROM tagged) WHERE rn = 1""",
    "outlier_filter": f"""
        SELECT * FROM {_PRICE_TEXT}
        WHERE TRY_CAST(median_list_price AS DOUBLE) IS NULL OR TRY_CAST(median_list_price AS DOUBLE) <= 100000""",
    "cleaning_audit": """
        SELECT t.split, step, CAST(CASE step WHEN 'duplicates' THEN a ELSE b END AS BIGINT) AS rows_before,
               CAST(CASE step WHEN 'duplicates' THEN b ELSE c END AS BIGINT) AS rows_after,
               CAST(CASE step WHEN 'duplicates' THEN a - b ELSE b - c END AS BIGINT) AS rows_removed
        FROM (SELECT split, count(*) AS a FROM tagged GROUP BY split) t
        JOIN (SELECT split, count(*) AS b FROM unique_rows GROUP BY split) u ON t.split = u.split
        JOIN (SELECT split, count(*) AS c FROM cleaned GROUP BY split) v ON t.split = v.split
        CROSS JOIN (VALUES ('duplicates'), ('price_outliers')) AS steps(step)""",
    "clean_listings": "SELECT * FROM cleaned",
    "date_features": """
        SELECT row_id, date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, * EXCLUDE (row_id, date, year) FROM listing""",
    "freq_fit": "SELECT * FROM freq",
    "freq_apply": "SELECT row_id, split, zipcode, zipcode_freq FROM encoded",
    "target_fit": "SELECT city_full, n, round(mean, 2) AS mean, round(city_full_encoded, 2) AS city_full_encoded FROM city_codes",
    "target_apply": "SELECT row_id, split, city_full, round(city_full_encoded, 2) AS city_full_encoded FROM encoded",
    "drop_unused_columns": "SELECT row_id, year, median_list_price, homes_sold, inventory, price FROM listing",
    "feature_frame": """
        SELECT row_id, split, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, median_list_price, homes_sold, inventory, price, lat, lng,
               zipcode_freq, round(city_full_encoded, 2) AS city_full_encoded FROM encoded""",
    "schema_align": "SELECT row_id, inventory, 0 AS park, median_list_price, homes_sold FROM listing",
    "missing_policy_record": """
        SELECT row_id, coalesce(inventory, 0) AS inventory, 0 AS park,
               coalesce(median_list_price, 0) AS median_list_price, coalesce(homes_sold, 0) AS homes_sold FROM listing""",
    "missing_fields": "SELECT request_id, missing_features, missing_optional_count FROM requests_shown",
    "raw_names": 'SELECT row_id AS request_id, homes_sold AS "Total Population" FROM listing',
    "request_contract": """
        SELECT request_id, array_to_string(reasons, ',') AS reject_reasons,
               CASE WHEN len(reasons) = 0 THEN CAST(json_extract_string(body, '$.zipcode') AS BIGINT) END AS zipcode,
               CASE WHEN len(reasons) = 0 THEN CAST(json_extract_string(body, '$.median_list_price') AS DOUBLE) END AS median_list_price
        FROM body_reasons""",
    "batch_limit": "SELECT * FROM batch_counts",
    "preview_rows": "SELECT * FROM listing ORDER BY date, row_id LIMIT 20",
    "mean_impute": """
        SELECT row_id, split,
               round(coalesce(median_list_price, (SELECT avg(median_list_price) FROM cleaned WHERE split = 'train')), 2) AS median_list_price,
               round(coalesce(homes_sold, (SELECT avg(homes_sold) FROM cleaned WHERE split = 'train')), 2) AS homes_sold
        FROM cleaned""",
    "standard_scale": """
        SELECT row_id, split, round((median_list_price - m1) / d1, 6) AS median_list_price, round((inventory - m2) / d2, 6) AS inventory
        FROM cleaned CROSS JOIN (
          SELECT avg(median_list_price) AS m1, stddev_pop(median_list_price) AS d1, avg(inventory) AS m2, stddev_pop(inventory) AS d2
          FROM cleaned WHERE split = 'train')""",
    "dummy_model": "SELECT row_id, split, round(prior, 2) AS predicted_price FROM encoded",
    "ols_one_feature": """
        SELECT row_id, split, round(intercept + slope * coalesce(homes_sold, mean_x), 2) AS predicted_price
        FROM cleaned CROSS JOIN fit""",
    "ridge_one_feature": """
        SELECT row_id, split,
               round(mean_y + (sxy / dev_x) / (sxx / (dev_x * dev_x) + 1) * (coalesce(homes_sold, mean_x) - mean_x) / dev_x, 2) AS predicted_price
        FROM cleaned CROSS JOIN fit""",
    "ols_full": f"SELECT row_id, split, round({linear_value('x')}) AS predicted_price FROM wide CROSS JOIN ols",
    "ridge_full": f""", {linear_fit("ridge", "wide_train", 1)}
        SELECT row_id, split, round({linear_value('x')}) AS predicted_price FROM wide CROSS JOIN ridge""",
    "regression_metrics": """
        SELECT split, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(r2, 8) AS r2 FROM model_wide WHERE model = 'city'""",
    "metric_gap": "SELECT model, split, metric, round(value, 3) AS value FROM model_gap",
    "best_model": "SELECT model, metric, round(value, 2) AS value FROM winner",
    "exact_sample": """
        SELECT row_id, date, zipcode FROM (
          SELECT row_id, date, zipcode, row_number() OVER (ORDER BY md5('42|' || CAST(row_id AS VARCHAR)), row_id) AS rn,
                 round_even(0.3 * count(*) OVER (), 0) AS wanted
          FROM tagged WHERE split = 'train') WHERE rn <= wanted""",
    "prediction_output": """
        SELECT row_id, round(city_full_encoded, 2) AS predicted_price, price AS actual_price,
               round(city_full_encoded - price, 2) AS prediction_error FROM labelled""",
    "scored_rows": """
        SELECT row_id, price, round(city_full_encoded, 2) AS predicted_price,
               round(abs(city_full_encoded - price), 2) AS absolute_error FROM labelled""",
    "scored_error": """
        SELECT count(*) AS n_rows, round(avg(abs(city_full_encoded - price)), 2) AS mae,
               round(sqrt(avg((city_full_encoded - price) ** 2)), 2) AS rmse FROM labelled""",
    "file_scoring": """
        SELECT * REPLACE (round(city_full_encoded, 2) AS city_full_encoded, round(predicted_price) AS predicted_price,
                          round(prediction_error) AS prediction_error) FROM file_scored""",
    "file_scoring_metrics": """
        SELECT round(avg(abs(prediction_error)), 2) AS mae, round(sqrt(avg(prediction_error ** 2)), 2) AS rmse,
               round(1 - sum(prediction_error ** 2) / (var_pop(actual_price) * count(*)), 8) AS r2
        FROM file_scored WHERE actual_price IS NOT NULL""",
    "request_scoring": "SELECT * FROM requests_shown",
    "batch_scoring": """
        SELECT batch_id, count(predicted_price) AS rows_predicted
        FROM batches JOIN requests_shown ON row_id = request_id
        WHERE batch_id IN (SELECT batch_id FROM batch_counts WHERE accepted) GROUP BY batch_id""",
    "stream_score": "SELECT * FROM requests_shown",
    "nested_batches": """
        SELECT batch_id, n_records, reject_reasons, CASE WHEN reject_reasons = '' THEN rows_predicted END AS rows_predicted,
               CASE WHEN reject_reasons = '' THEN predicted_sum END AS predicted_sum FROM nested_told
        UNION ALL
        SELECT 'event-' || CAST(event_id AS VARCHAR), NULL, array_to_string(['missing:records'] || list_transform(list_sort(json_keys(props)), lambda k: 'unknown:' || k), ','), NULL, NULL
        FROM events""",
    "stream_requests": """
        SELECT r.request_id, CASE WHEN len(reasons) = 0 THEN round(predicted_price) END AS predicted_price,
               CASE WHEN len(reasons) > 0 THEN array_to_string(reasons, ',') WHEN above THEN 'price_above_limit' END AS reasons
        FROM body_reasons r LEFT JOIN body_values v USING (request_id)""",
    "csv_round_trip": """
        SELECT row_id AS request_id, strftime(date, '%Y-%m-%d') AS date, city_full, city, zipcode,
               median_sale_price, median_list_price, homes_sold, inventory, price FROM listing""",
    "upload_requests": """
        SELECT zipcode, count(*) AS n_rows, max(median_list_price) AS highest FROM listing GROUP BY zipcode""",
    "split_files": "SELECT row_id, date, price, split FROM tagged WHERE split IN ('train', 'eval')",
    "rerun_splits": "SELECT row_id, date, price, split FROM tagged WHERE split IN ('train', 'eval')",
    "encoder_files": """
        SELECT city_full, n, round(city_full_encoded, 2) AS city_full_encoded, round(prior, 2) AS prior
        FROM city_codes CROSS JOIN prior""",
    "registry_latest": """
        SELECT name, version, path, n_rows FROM versions
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
    "preferred_artifact": """
        SELECT name, version, path, n_rows FROM versions WHERE name = 'listings_eval' ORDER BY version DESC LIMIT 1""",
    "registry_lineage": """
        SELECT a.name, a.version, b.name || ':v' || CAST(b.version AS VARCHAR) AS input, 'dataset' AS input_type, b.path AS input_path
        FROM versions a JOIN versions b ON a.name = b.name AND a.version = b.version + 1""",
    "registry_ancestors": """, direct AS (
          SELECT name || ':v' || CAST(version AS VARCHAR) AS node, name || ':v' || CAST(version - 1 AS VARCHAR) AS ancestor FROM versions WHERE version > 1
          UNION SELECT name || ':v' || CAST(version AS VARCHAR), 'listings_train:v1' FROM versions WHERE version % 3 = 0),
        up(node, ancestor, steps) AS (
          SELECT node, ancestor, 1 FROM direct
          UNION SELECT up.node, direct.ancestor, steps + 1 FROM up JOIN direct ON direct.node = up.ancestor)
        SELECT node, ancestor, CAST(min(steps) AS INTEGER) AS steps FROM up GROUP BY node, ancestor""",
    "registry_append": """
        SELECT 'listings_' || split AS name, CAST(v AS INTEGER) AS version, count(*) AS n_rows, 'latest' AS aliases
        FROM tagged CROSS JOIN (VALUES (1), (2)) AS t(v) WHERE v = 1 OR split <> 'train' GROUP BY ALL""",
    "run_log": """
        SELECT 'split' AS step, 'finished' AS status, (SELECT count(*) FROM tagged) AS n_rows, NULL AS error
        UNION ALL SELECT 'clean', 'finished', (SELECT count(*) FROM cleaned), NULL
        UNION ALL SELECT 'scoring', 'failed', NULL, 'FileNotFoundError: Input not found: none.csv'""",
    "metric_log": "SELECT model || '/' || split || '/' || metric AS key, round(value, 3) AS value FROM model_gap",
    "model_labels": """
        SELECT 'Lowest error of the compared regressors: ' || model || ' (' || metric || '=' || format('{:.4f}', round(value, 2))
               || '). Saved with the errors of all that took part.' AS description,
               'model,best-model,regression,housing-price-prediction,baseline-comparison,selected-' || model || ',metric-' || metric AS tags,
               'latest,best,' || model || ',best-' || metric AS aliases
        FROM winner""",
    "baseline_report": "SELECT model, split, metric, round(value, 3) AS value FROM model_long",
}

_PLAIN = r"trim(regexp_replace(replace(replace(lower(city_full), '–', '-'), '—', '-'), '\s+', ' ', 'g'))"
_MAPPED = """CASE city_full WHEN 'nation_3-europe' THEN 'nation_8-europe'
                                   WHEN 'nation_5-africa' THEN 'nation_0-africa' ELSE city_full END"""
# What the steps are completed with.
_PARTS = {
    "PLAIN_CITY": _PLAIN,
    "MAPPED_CITY": _MAPPED,
    "NAMED_LISTING": f"SELECT * REPLACE ({_MAPPED} AS city_full) FROM (SELECT * REPLACE ({_PLAIN} AS city_full) FROM listing)",
    "WIDE_ROW": wide_list(year="year(date)", quarter="quarter(date)", month="month(date)"),
    "OLS": linear_fit("ols", "wide_train", 0),
    "WIDE_VALUE": linear_value(wide_list()),
    # an optional field without a value is 0; a place that is not found stays missing
    "BODY_VALUE": linear_value(wide_list(median_list_price="coalesce(median_list_price, 0)", homes_sold="0", inventory="0")),
    "REQUEST_VALUE": linear_value(wide_list(**{c: f"coalesce({c}, 0)" for c in ("median_list_price", "homes_sold", "inventory")})),
}
_COMPLETE = _STEPS
for _name, _part in _PARTS.items():
    _COMPLETE = _COMPLETE.replace(f"{{{_name}}}", _part)

ORACLE: dict[str, str] = {name: f"{_COMPLETE}{body}" for name, body in _BODIES.items()}
