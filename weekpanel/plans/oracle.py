"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Fragments are plain CTE text composed per key. Doubles are rounded to 6
places on both sides so the comparison is about values, not summation order.
"""

from __future__ import annotations


def norm(x: str) -> str:
    """Text folding in DuckDB terms."""
    # Python/Java upper-case sharp s as "SS"; DuckDB keeps one letter
    return f"regexp_replace(strip_accents(upper(replace(trim({x}), 'ß', 'ss'))), '\\s+', ' ', 'g')"


# cleaned cases of the supplier adapter (lineitem as a case list)
CASES = f"""
raw_cases AS (
  SELECT lpad(CAST(l.l_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(l.l_suppkey AS VARCHAR))) AS INTEGER), '0') AS unit_id,
         {norm('r.r_name')} AS region, {norm('n.n_name')} AS province, {norm('s.s_name')} AS district,
         CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST((dayofyear(l.l_shipdate) - 1) // 7 + 1 AS INTEGER) AS week,
         l.l_quantity AS age_num,
         CASE l.l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'M' ELSE 'D' END AS age_unit,
         l.l_returnflag AS flag, l.l_linestatus AS status
  FROM lineitem l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
aged AS (
  SELECT *, CASE age_unit WHEN 'M' THEN age_num / 12.0 WHEN 'D' THEN age_num / 365.0 ELSE age_num END AS age_raw
  FROM raw_cases
),
cases AS (
  SELECT unit_id, region, province, district, year, week,
         CASE WHEN age_raw < 0 OR age_raw > 120 THEN NULL ELSE age_raw END AS age_years,
         CAST(coalesce(flag IN ('A', 'R'), false) AS INTEGER) AS warn_or_severe,
         CAST(coalesce(flag = 'R', false) AS INTEGER) AS severe,
         CAST(coalesce(status = 'F', false) AS INTEGER) AS female
  FROM aged
  WHERE week BETWEEN 1 AND 53 AND year BETWEEN 1990 AND 2100
)"""

CALENDAR = """
wmax AS (SELECT year, max(week) AS wmax FROM cases GROUP BY year),
cal0 AS (SELECT year, CAST(unnest(generate_series(1, wmax)) AS INTEGER) AS week FROM wmax),
cal AS (
  SELECT year, week, CAST(row_number() OVER (ORDER BY year, week) - 1 AS BIGINT) AS week_id,
         CAST(make_date(year, 1, 1) + CAST(7 * (week - 1) AS INTEGER) AS DATE) AS week_start
  FROM cal0
)"""

AGG = """
agg AS (
  SELECT c.unit_id, c.year, c.week, k.week_id, k.week_start, CAST(count(*) AS BIGINT) AS cases,
         avg(age_years) AS age_mean, avg(warn_or_severe) AS warn_share, avg(severe) AS severe_share,
         avg(female) AS female_share
  FROM cases c JOIN cal k ON c.year = k.year AND c.week = k.week
  GROUP BY c.unit_id, c.year, c.week, k.week_id, k.week_start
)"""

GEO = """
geo_counts AS (
  SELECT unit_id, 'region' AS k, region AS v, count(*) AS cnt FROM cases WHERE region IS NOT NULL GROUP BY 1, 2, 3
  UNION ALL
  SELECT unit_id, 'province', province, count(*) FROM cases WHERE province IS NOT NULL GROUP BY 1, 2, 3
  UNION ALL
  SELECT unit_id, 'district', district, count(*) FROM cases WHERE district IS NOT NULL GROUP BY 1, 2, 3
),
geo_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY unit_id, k ORDER BY cnt DESC, v ASC) AS rk FROM geo_counts
),
geo AS (
  SELECT u.unit_id,
         max(CASE WHEN g.k = 'region' THEN g.v END) AS region,
         max(CASE WHEN g.k = 'province' THEN g.v END) AS province,
         max(CASE WHEN g.k = 'district' THEN g.v END) AS district
  FROM (SELECT DISTINCT unit_id FROM cases) u LEFT JOIN geo_ranked g ON u.unit_id = g.unit_id AND g.rk = 1
  GROUP BY u.unit_id
)"""

DENSE = """
span AS (SELECT unit_id, min(week_id) AS lo, max(week_id) AS hi FROM agg GROUP BY unit_id),
dense AS (
  SELECT s.unit_id, k.year, k.week, k.week_start, k.week_id,
         CAST(coalesce(a.cases, 0) AS BIGINT) AS cases,
         a.age_mean, a.warn_share, a.severe_share, a.female_share
  FROM span s JOIN cal k ON k.week_id BETWEEN s.lo AND s.hi
  LEFT JOIN agg a ON a.unit_id = s.unit_id AND a.week_id = k.week_id
),
dense_geo AS (SELECT d.*, g.region, g.province, g.district FROM dense d LEFT JOIN geo g ON d.unit_id = g.unit_id)"""


def hist(n: int = 30) -> str:
    return f"""
hist AS (
  SELECT * EXCLUDE (nrows) FROM (SELECT *, count(*) OVER (PARTITION BY unit_id) AS nrows FROM dense_geo)
  WHERE nrows >= {n}
)"""


FEATURES = """
feat AS (
  SELECT *,
    CAST(lag(cases, 1) OVER w AS DOUBLE) AS cases_lag_1,
    CAST(lag(cases, 2) OVER w AS DOUBLE) AS cases_lag_2,
    CAST(lag(cases, 4) OVER w AS DOUBLE) AS cases_lag_4,
    CASE WHEN count(cases) OVER w4 = 4 THEN avg(cases) OVER w4 END AS roll_mean_4,
    CASE WHEN count(cases) OVER w8 = 8 THEN avg(cases) OVER w8 END AS roll_mean_8,
    CASE WHEN count(cases) OVER w4 = 4 THEN stddev_samp(cases) OVER w4 END AS roll_std_4,
    (cases - lag(cases, 1) OVER w) / (lag(cases, 1) OVER w + 1.0) AS growth,
    sin(2 * pi() * week / 52.0) AS week_sin,
    cos(2 * pi() * week / 52.0) AS week_cos,
    'real' AS origin
  FROM hist
  WINDOW w AS (PARTITION BY unit_id ORDER BY week_id),
         w4 AS (PARTITION BY unit_id ORDER BY week_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
         w8 AS (PARTITION BY unit_id ORDER BY week_id ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)
)"""

LABEL = """
yrs AS (SELECT year, dense_rank() OVER (ORDER BY year DESC) AS r FROM (SELECT DISTINCT year FROM feat)),
split_t AS (SELECT year, CASE WHEN r <= 1 THEN 'test' WHEN r <= 2 THEN 'val' ELSE 'train' END AS split FROM yrs),
with_split AS (SELECT f.*, s.split FROM feat f LEFT JOIN split_t s ON f.year = s.year),
thr AS (SELECT unit_id, quantile_cont(cases, 0.75) AS threshold FROM with_split WHERE split = 'train' GROUP BY unit_id),
master AS (
  SELECT w.*, t.threshold,
         CAST(lead(cases, 1) OVER (PARTITION BY w.unit_id ORDER BY week_id) > t.threshold AS INTEGER) AS target
  FROM with_split w LEFT JOIN thr t ON w.unit_id = t.unit_id
)"""

MASTER_COLS = (
    "unit_id, region, province, district, year, week, week_start, week_id, cases, age_mean, warn_share, "
    "severe_share, female_share, cases_lag_1, cases_lag_2, cases_lag_4, roll_mean_4, roll_mean_8, roll_std_4, "
    "growth, week_sin, week_cos, threshold, split, target, origin"
)


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


def master_ctes(n: int = 30) -> str:
    return with_ctes(CASES, CALENDAR, AGG, GEO, DENSE, hist(n), FEATURES, LABEL)


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, 6) AS {alias or col}"


# cleaned cases of the sparse customer adapter (orders as a case list)
CUSTOMER_CASES = f"""
raw_cases AS (
  SELECT lpad(CAST(o.o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o.o_custkey AS VARCHAR))) AS INTEGER), '0') AS unit_id,
         {norm('r.r_name')} AS region, {norm('n.n_name')} AS province, {norm('c.c_name')} AS district,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST((dayofyear(o.o_orderdate) - 1) // 7 + 1 AS INTEGER) AS week,
         o.o_orderstatus AS flag
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
cases AS (
  SELECT unit_id, region, province, district, year, week, CAST(NULL AS DOUBLE) AS age_years,
         CAST(coalesce(flag IN ('P', 'F'), false) AS INTEGER) AS warn_or_severe,
         CAST(coalesce(flag = 'F', false) AS INTEGER) AS severe, 0 AS female
  FROM raw_cases
  WHERE week BETWEEN 1 AND 53 AND year BETWEEN 1990 AND 2100
)"""
