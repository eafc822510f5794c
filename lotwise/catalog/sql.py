"""The same definitions as SQL text, for checking the Spark results elsewhere."""

from __future__ import annotations

LISTINGS = """
listings AS MATERIALIZED (
SELECT
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
            CAST(round(l_extendedprice * 100) AS BIGINT))              AS id,
  concat('/listing/', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
            CAST(round(l_extendedprice * 100) AS BIGINT)))             AS link,
  (l_orderkey * 7 + l_linenumber) * 1000003 + l_partkey * 1009
    + l_suppkey + CAST(round(l_extendedprice * 100) AS BIGINT) * 31    AS id_num,
  p_brand                                                              AS make,
  p_type                                                               AS model,
  concat('T', CAST(p_size % 3 AS VARCHAR))                             AS trim,
  4 + 2 * (p_size % 2)                                                 AS cylinder,
  l_returnflag                                                         AS gear_type,
  l_linestatus                                                         AS personal,
  CAST(year(l_shipdate) AS INT)                                        AS year,
  (l_orderkey * 7 + l_linenumber) % 23                                 AS likes,
  CASE WHEN l_linenumber = 7 AND l_orderkey % 50 = 0 THEN 'call'
       ELSE format('{:,}', CAST(floor(l_extendedprice * 4) AS BIGINT))
  END                                                                  AS price_raw,
  CASE WHEN l_quantity = 50 THEN NULL
       WHEN l_quantity = 49 THEN '0 Km'
       ELSE format('{:,}', (2002 - year(l_shipdate)) * 12000
                           + CAST(l_quantity AS BIGINT) * 997) || ' Km'
  END                                                                  AS mileage_raw,
  CASE l_linenumber % 4
       WHEN 0 THEN strftime(l_shipdate, '%d/%m/%Y')
       WHEN 1 THEN CAST(l_orderkey % 23 + 1 AS VARCHAR) || ' hours ago'
       WHEN 2 THEN CAST(l_orderkey % 59 + 1 AS VARCHAR) || ' minutes ago'
       ELSE 'yesterday' END                                            AS time
FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CLEANED = """
typed AS (
SELECT *,
  TRY_CAST(replace(replace(mileage_raw, ' Km', ''), ',', '') AS DOUBLE) AS mileage,
  TRY_CAST(replace(price_raw, ',', '') AS DOUBLE) AS price,
  CASE WHEN contains(time, '/')
       THEN strftime(try_strptime(time, '%d/%m/%Y'), '%d-%b-%Y') ELSE '' END AS date_sold,
  CASE WHEN contains(time, 'minute')
       THEN TRY_CAST(replace(time, ' minutes ago', '') AS DOUBLE) / 60
       WHEN contains(time, 'hour')
       THEN TRY_CAST(replace(time, ' hours ago', '') AS DOUBLE) END AS posted_time
FROM listings),
cleaned AS MATERIALIZED (
SELECT *,
  CASE WHEN mileage = 0 THEN CAST(0 AS DOUBLE)
       WHEN mileage > 0 THEN CAST(ceil(mileage / 10000) * 10000 AS DOUBLE) END AS mileage_range,
  concat_ws('-', coalesce(make, 'NA'), coalesce(model, 'NA')) AS model_key,
  concat_ws('-', coalesce(make, 'NA'), coalesce(make, 'NA'), coalesce(model, 'NA'),
    coalesce(trim, 'NA'), coalesce(CAST(cylinder AS VARCHAR), 'NA'), coalesce(gear_type, 'NA')) AS trim_key
FROM typed)"""

KEPT = """
kept AS MATERIALIZED (
SELECT *,
  concat_ws('-', trim_key, CAST(year AS VARCHAR)) AS year_key,
  concat_ws('-', trim_key, coalesce(CAST(CAST(mileage_range AS BIGINT) AS VARCHAR), 'NA')) AS mileage_key
FROM cleaned WHERE price < 365000 AND year > 1995 AND price IS NOT NULL)"""

# listings posted within hours are the fresh scrape, the others the known data
FRESH = """
known AS MATERIALIZED (SELECT * FROM kept WHERE posted_time IS NULL),
fresh AS MATERIALIZED (SELECT * FROM kept WHERE posted_time IS NOT NULL)"""


def _round(source: str, i: int, share: float) -> str:
    """One hold-out round: price quartiles, order by key, repair of uncovered rows."""
    covered = " AND ".join(
        f"{k} IN (SELECT {k} FROM train_{i})"
        for k in ("make", "model_key", "trim_key", "year_key", "gear_type", "cylinder", "mileage_key", "personal")
    )
    return f"""
breaks_{i} AS MATERIALIZED (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2,
  quantile_cont(price, 0.75) AS q3 FROM {source}),
strata_{i} AS (SELECT s.*, CAST(price > q1 AS INT) + CAST(price > q2 AS INT)
  + CAST(price > q3 AS INT) AS stratum FROM {source} s, breaks_{i}),
held_{i} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY stratum
    ORDER BY (id_num * 7919 + 123) % 10007, id)
  <= ceil(count(*) OVER (PARTITION BY stratum) * CAST({share} AS DOUBLE)) AS picked FROM strata_{i}),
train_{i} AS MATERIALIZED (SELECT * FROM held_{i} WHERE NOT picked),
round_{i} AS MATERIALIZED (SELECT * EXCLUDE (stratum, picked), stratum AS stratum_{i}, picked AS picked_{i},
  picked AND {covered} AS out_{i} FROM held_{i})"""


def split_of(source: str) -> str:
    """``split``: the rows of ``source`` with their set."""
    return (
        _round(source, 1, 0.1)
        + f""",
rest AS (SELECT * FROM round_1 WHERE NOT out_1),"""
        + _round("rest", 2, 0.2)
        + """,
split AS MATERIALIZED (
SELECT * EXCLUDE (stratum_2, picked_2, out_2), CASE WHEN out_2 THEN 'test' ELSE 'train' END AS split FROM round_2
UNION ALL BY NAME SELECT *, 'validation' AS split FROM round_1 WHERE out_1)"""
    )


def effects_of(full: str) -> str:
    """Effects fitted on ``split``, group means on ``full``."""
    return f"""
fit_rows AS MATERIALIZED (SELECT * FROM split WHERE split = 'train'),
mu AS MATERIALIZED (SELECT avg(price) AS mu FROM fit_rows),
make_e AS MATERIALIZED (SELECT make, avg(price - mu) AS b_make FROM fit_rows, mu GROUP BY make),
model_e AS MATERIALIZED (SELECT model_key, avg(price - mu - b_make) AS b_model
  FROM fit_rows JOIN make_e USING (make), mu GROUP BY model_key),
trim_e AS MATERIALIZED (SELECT trim_key, avg(price - mu - b_make - b_model) AS b_trim
  FROM fit_rows JOIN make_e USING (make) JOIN model_e USING (model_key), mu GROUP BY trim_key),
year_e AS MATERIALIZED (SELECT trim_key, year, avg(price - mu - b_make - b_model - b_trim) AS b_year
  FROM fit_rows JOIN make_e USING (make) JOIN model_e USING (model_key) JOIN trim_e USING (trim_key), mu
  GROUP BY trim_key, year),
year_l AS MATERIALIZED (SELECT trim_key,
  CASE WHEN count(*) = 1 THEN max(b_year) ELSE regr_intercept(b_year, year) END AS a,
  CASE WHEN count(*) = 1 OR abs(regr_slope(b_year, year)) < 1e-9 THEN 0
       ELSE regr_slope(b_year, year) END AS b FROM year_e GROUP BY trim_key),
tier_e AS MATERIALIZED (SELECT trim_key, year,
  CASE WHEN count(mileage_range) = count(*) THEN avg(mileage_range) END AS avg_mileage_range
  FROM {full} GROUP BY trim_key, year),
tier_l AS MATERIALIZED (SELECT trim_key,
  CASE WHEN count(*) = 1 THEN max(avg_mileage_range)
       WHEN count(avg_mileage_range) = count(*) THEN regr_intercept(avg_mileage_range, year) END AS aa,
  CASE WHEN count(*) = 1 THEN 0
       WHEN count(avg_mileage_range) = count(*) THEN regr_slope(avg_mileage_range, year) END AS bb
  FROM tier_e GROUP BY trim_key),
trim_s AS MATERIALIZED (SELECT trim_key, avg(price) AS price_pmmt, avg(year) AS avg_ymmt,
  count(*) AS listing_count FROM {full} GROUP BY trim_key)"""


def scored_of(rows: str, name: str = "scored") -> str:
    """``rows`` with every prediction stage, gap and explanation."""
    floor = "CASE WHEN {0} >= 0.2 * price_pmmt THEN {0} WHEN {0} < 0.2 * price_pmmt THEN 0.2 * price_pmmt END"
    return f"""
{name}_1 AS (SELECT r.*, mu, b_make, b_model, b_trim, a, b, aa, bb, price_pmmt, avg_ymmt, listing_count,
  mu + b_make AS stage_make, mu + b_make + b_model AS raw_model, mu + b_make + b_model + b_trim AS raw_trim,
  CASE WHEN b = 0 THEN price_pmmt * 0.1 * (year - avg_ymmt) WHEN b <> 0 THEN 0 END AS price_year_value,
  CASE WHEN aa + bb * year > 0 THEN aa + bb * year WHEN aa + bb * year <= 0 THEN 0 END AS avg_mileage_range_lr
  FROM {rows} r CROSS JOIN mu LEFT JOIN make_e USING (make) LEFT JOIN model_e USING (model_key)
  LEFT JOIN trim_e USING (trim_key) LEFT JOIN year_l USING (trim_key) LEFT JOIN tier_l USING (trim_key)
  LEFT JOIN trim_s USING (trim_key)),
{name}_2 AS (SELECT *, raw_trim + a + b * year + price_year_value AS pred1 FROM {name}_1),
{name}_3 AS (SELECT *, pred1 + 0.16 * pred1 * (avg_mileage_range_lr - CASE WHEN mileage = 0 THEN 0
  WHEN mileage > 0 THEN ceil(mileage / 10000) * 10000 END) / 100000 AS pred2 FROM {name}_2),
{name}_4 AS (SELECT *, {floor.format("raw_model")} AS stage_model, {floor.format("raw_trim")} AS stage_trim,
  {floor.format("pred1")} AS stage_year, {floor.format("pred2")} AS pred3,
  pred1 - price_pmmt AS year_effect, pred2 - pred1 AS mileage_effect FROM {name}_3),
{name} AS MATERIALIZED (SELECT *, pred3 - price AS price_difference, abs(pred3 - price) AS absolute_difference,
  CASE WHEN (pred3 - price) / price * 100 BETWEEN -0.01 AND 0.01 THEN 0
       ELSE (pred3 - price) / price * 100 END AS l_gap FROM {name}_4)"""


def chain(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


RAW = chain(LISTINGS)
CLEAN = chain(LISTINGS, CLEANED)
KEEP = chain(LISTINGS, CLEANED, KEPT)
KNOWN = chain(LISTINGS, CLEANED, KEPT, FRESH)
SPLIT = chain(LISTINGS, CLEANED, KEPT, split_of("kept"))
MODEL = chain(LISTINGS, CLEANED, KEPT, split_of("kept"), effects_of("kept"))
SCORED = chain(
    LISTINGS, CLEANED, KEPT, split_of("kept"), effects_of("kept"), scored_of("split")
)
RECENT = chain(
    LISTINGS, CLEANED, KEPT, FRESH, split_of("known"), effects_of("known"), scored_of("fresh")
)
