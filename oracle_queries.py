"""Independent DuckDB SQL for every registered query.

The correctness gate runs each ``queries()`` entry in Spark and the SQL text
of the same name here in DuckDB over the same Parquet tables, then compares
row counts, schemas and values. Nothing in this file is used by the engine.
"""

from __future__ import annotations

# Market rows from the benchmark tables (see kpiloom/sources/testdata.py).
MARKET_RAW = """
SELECT CAST(l_shipdate AS date) AS obs_date,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE p_type END AS platform,
       CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE p_brand END AS genre,
       CAST(floor((CAST(round(p_retailprice*100) AS bigint)
            * (100 - CAST(round(l_discount*100) AS bigint)) + 50) / 100) AS double) / 100 AS current_price_usd,
       CAST(round(l_discount*100) AS double) AS discount_pc,
       CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS is_on_sale,
       CAST(l_quantity * p_size * 100 AS int) AS concurrent_players,
       CAST(round(l_tax*100) AS double) AS hype_score,
       CASE WHEN l_partkey % 50 = 0 THEN -1.0 ELSE 1.0 END
         * CAST(floor((CAST(l_quantity*p_size*100 AS bigint) * CAST(round(p_retailprice*100) AS bigint)
             * (100 - CAST(round(l_discount*100) AS bigint)) * (5 + 3*l_linenumber) + 5000) / 10000) / 100 AS double)
         AS estimated_revenue_usd,
       CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_early_access,
       CASE WHEN month(l_shipdate) IN (11, 12) THEN 1 ELSE 0 END AS holiday_sale
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

MARKET_CLEAN = """
SELECT *, strftime(obs_date, '%Y-%m') AS year_month
FROM market_raw
WHERE estimated_revenue_usd > 0 AND NOT isnan(estimated_revenue_usd)
  AND platform IS NOT NULL AND genre IS NOT NULL
"""

EVENT_ROWS = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
       event_type AS platform,
       concat('G', CAST(user_id % 8 AS varchar)) AS genre,
       CAST(floor(value*2000) AS int) AS concurrent_players,
       CAST(floor(value) % 11 AS double) AS hype_score,
       value AS current_price_usd,
       CAST(event_id % 2 AS int) AS is_on_sale,
       CASE WHEN floor(value*2000) > 300000 THEN 1 ELSE 0 END AS hype_spike
FROM events
"""


def money_sum(c: str) -> str:
    return f"CAST(round(sum(CAST({c} AS DECIMAL(28,8))), 2) AS DOUBLE)"


def exact_avg(c: str, digits: int) -> str:
    return f"round(CAST(sum(CAST({c} AS DECIMAL(28,8))) AS DOUBLE) / count({c}), {digits})"


def with_market(body: str) -> str:
    return (f"WITH market_raw AS ({MARKET_RAW}),\n"
            f"market_clean AS ({MARKET_CLEAN})\n{body}")


REV = "estimated_revenue_usd"

KPI_BODIES = {
    "kpi1_revenue_platform": f"""
SELECT platform, {money_sum(REV)} AS total_revenue_usd
FROM market_clean GROUP BY platform""",
    "kpi2_revenue_genre": f"""
SELECT genre, {money_sum(REV)} AS total_revenue_usd
FROM market_clean GROUP BY genre""",
    "kpi3_top_genres_ccu": f"""
SELECT genre, {exact_avg('concurrent_players', 0)} AS avg_concurrent_players
FROM market_clean GROUP BY genre
ORDER BY avg_concurrent_players DESC NULLS LAST, genre ASC LIMIT 10""",
    "kpi4_avg_ccu_platform": f"""
SELECT platform, {exact_avg('concurrent_players', 0)} AS avg_concurrent_players
FROM market_clean GROUP BY platform""",
    "kpi5_avg_price_platform": f"""
SELECT platform, {exact_avg('current_price_usd', 2)} AS avg_price_usd
FROM market_clean GROUP BY platform""",
    "kpi6_discount_rate": f"""
SELECT platform, {exact_avg('discount_pc', 2)} AS avg_discount_pct
FROM market_clean WHERE is_on_sale = 1 GROUP BY platform""",
    "kpi7_early_vs_full": f"""
SELECT is_early_access, {exact_avg(REV, 2)} AS avg_revenue_usd,
       {money_sum(REV)} AS total_revenue_usd, count(*) AS num_records
FROM market_clean GROUP BY is_early_access""",
    "kpi8_monthly_trend": f"""
SELECT year_month, {money_sum(REV)} AS monthly_revenue_usd
FROM market_clean GROUP BY year_month""",
}


SQL_KPI_BODIES = {
    "sql_kpi1_revenue_platform": f"""
SELECT platform, {money_sum(REV)} AS total_revenue_usd, count(*) AS num_registros
FROM market_clean GROUP BY platform""",
    "sql_kpi2_revenue_genre": f"""
SELECT genre, {money_sum(REV)} AS total_revenue_usd, count(*) AS num_registros
FROM market_clean GROUP BY genre""",
    "sql_kpi3_top_genres_ccu": KPI_BODIES["kpi3_top_genres_ccu"],
    "sql_kpi4_avg_ccu_platform": f"""
SELECT platform, {exact_avg('concurrent_players', 0)} AS avg_concurrent_players,
       max(concurrent_players) AS peak_concurrent_players
FROM market_clean GROUP BY platform""",
    "sql_kpi5_avg_price_platform": f"""
SELECT platform, {exact_avg('current_price_usd', 2)} AS avg_price_usd,
       round(min(current_price_usd), 2) AS min_price_usd,
       round(max(current_price_usd), 2) AS max_price_usd
FROM market_clean GROUP BY platform""",
    "sql_kpi6_discount_rate": f"""
SELECT platform, {exact_avg('discount_pc', 2)} AS avg_discount_pct, count(*) AS juegos_en_oferta,
       {money_sum(REV)} AS revenue_en_oferta
FROM market_clean WHERE is_on_sale = 1 GROUP BY platform""",
    "sql_kpi7_early_vs_full": f"""
SELECT CASE WHEN is_early_access = 1 THEN 'Early Access' ELSE 'Full Release' END AS release_type,
       {exact_avg(REV, 2)} AS avg_revenue_usd, {money_sum(REV)} AS total_revenue_usd,
       count(*) AS num_registros
FROM market_clean GROUP BY is_early_access""",
    "sql_kpi8_monthly_trend": f"""
SELECT strftime(obs_date, '%Y-%m') AS year_month, {money_sum(REV)} AS monthly_revenue_usd,
       count(*) AS num_registros, {exact_avg('concurrent_players', 0)} AS avg_ccu
FROM market_clean GROUP BY strftime(obs_date, '%Y-%m')""",
}


def kpi_ctes() -> str:
    return ",\n".join(f"{name} AS ({body})" for name, body in {**KPI_BODIES, **SQL_KPI_BODIES}.items())


def with_kpis(body: str) -> str:
    return (
        f"WITH market_raw AS ({MARKET_RAW}),\n"
        f"market_clean AS ({MARKET_CLEAN}),\n{kpi_ctes()}\n{body}")


def text2(c: str) -> str:
    """Fractional number as two-decimal text."""
    return f"CAST(CAST({c} AS DECIMAL(20,2)) AS VARCHAR) AS {c}"


def text_int(c: str) -> str:
    return f"CAST({c} AS VARCHAR) AS {c}"


EXPORT_COLUMNS = {
    "kpi1_revenue_platform": ["platform", text2("total_revenue_usd")],
    "kpi2_revenue_genre": ["genre", text2("total_revenue_usd")],
    "kpi3_top_genres_ccu": ["genre", text2("avg_concurrent_players")],
    "kpi4_avg_ccu_platform": ["platform", text2("avg_concurrent_players")],
    "kpi5_avg_price_platform": ["platform", text2("avg_price_usd")],
    "kpi6_discount_rate": ["platform", text2("avg_discount_pct")],
    "kpi7_early_vs_full": [text_int("is_early_access"), text2("avg_revenue_usd"),
                           text2("total_revenue_usd"), text_int("num_records")],
    "kpi8_monthly_trend": ["year_month", text2("monthly_revenue_usd")],
}

EXPORT_BODY = "\nUNION ALL BY NAME\n".join(
    f"SELECT {', '.join(cols)}, '{name}' AS kpi_name FROM {name}" for name, cols in EXPORT_COLUMNS.items())

SQL_EXPORT_COLUMNS = {
    "sql_kpi1_revenue_platform": ["platform", text2("total_revenue_usd"), text_int("num_registros")],
    "sql_kpi2_revenue_genre": ["genre", text2("total_revenue_usd"), text_int("num_registros")],
    "sql_kpi3_top_genres_ccu": ["genre", text2("avg_concurrent_players")],
    "sql_kpi4_avg_ccu_platform": ["platform", text2("avg_concurrent_players"), text_int("peak_concurrent_players")],
    "sql_kpi5_avg_price_platform": ["platform", text2("avg_price_usd"), text2("min_price_usd"),
                                    text2("max_price_usd")],
    "sql_kpi6_discount_rate": ["platform", text2("avg_discount_pct"), text_int("juegos_en_oferta"),
                               text2("revenue_en_oferta")],
    "sql_kpi7_early_vs_full": ["release_type", text2("avg_revenue_usd"), text2("total_revenue_usd"),
                               text_int("num_registros")],
    "sql_kpi8_monthly_trend": ["year_month", text2("monthly_revenue_usd"), text_int("num_registros"),
                               text2("avg_ccu")],
}

SQL_EXPORT_BODY = "\nUNION ALL BY NAME\n".join(
    f"SELECT {', '.join(cols)}, '{name}' AS kpi_name FROM {name}" for name, cols in SQL_EXPORT_COLUMNS.items())

SUMMARY_BODY = f"""
SELECT s.*,
       '$' || CAST(round(CAST(total_revenue_usd / 1000000 AS DECIMAL(38,6)), 1) AS VARCHAR) || 'M'
         AS total_revenue_text,
       CAST(round(CAST(avg_discount_pct AS DECIMAL(38,6)), 1) AS VARCHAR) || '%' AS avg_discount_text
FROM (SELECT (SELECT {money_sum('total_revenue_usd')} FROM kpi1_revenue_platform) AS total_revenue_usd,
             (SELECT platform FROM kpi1_revenue_platform ORDER BY total_revenue_usd DESC, platform LIMIT 1) AS top_platform,
             (SELECT genre FROM kpi2_revenue_genre ORDER BY total_revenue_usd DESC, genre LIMIT 1) AS top_genre,
             (SELECT {exact_avg('avg_discount_pct', 2)} FROM kpi6_discount_rate) AS avg_discount_pct) s"""

SHARE_BODY = """
SELECT genre, total_revenue_usd,
       round(total_revenue_usd / (SELECT CAST(sum(CAST(total_revenue_usd AS DECIMAL(28,8))) AS DOUBLE)
                                  FROM kpi2_revenue_genre) * 100, 2) AS revenue_share_pct,
       '$' || format('{:,.2f}', round(CAST(total_revenue_usd AS DECIMAL(38,6)), 2)) AS total_revenue_usd_text
FROM kpi2_revenue_genre"""


CHARTS_BODY = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS chart, CAST(row_number() OVER (ORDER BY {by}, {label}) AS INT) AS position, CAST({label} AS VARCHAR) AS label, CAST({value} AS DOUBLE) AS value FROM {name}"
    for name, by, label, value in (
        ("kpi1_revenue_platform", "total_revenue_usd", "platform", "total_revenue_usd"),
        ("kpi3_top_genres_ccu", "avg_concurrent_players DESC", "genre", "avg_concurrent_players"),
        ("kpi4_avg_ccu_platform", "avg_concurrent_players DESC", "platform", "avg_concurrent_players"),
        ("kpi5_avg_price_platform", "avg_price_usd DESC", "platform", "avg_price_usd"),
        ("kpi6_discount_rate", "avg_discount_pct DESC", "platform", "avg_discount_pct"),
        ("kpi8_monthly_trend", "year_month", "year_month", "monthly_revenue_usd")))


# The key of each KPI table, and the measure that it is ordered by (descending) or none.
ORDERED_BY = {
    "kpi1_revenue_platform": ("platform", "total_revenue_usd"), "kpi2_revenue_genre": ("genre", "total_revenue_usd"),
    "kpi3_top_genres_ccu": ("genre", "avg_concurrent_players"), "kpi4_avg_ccu_platform": ("platform", "avg_concurrent_players"),
    "kpi5_avg_price_platform": ("platform", "avg_price_usd"), "kpi6_discount_rate": ("platform", "avg_discount_pct"),
    "kpi7_early_vs_full": ("is_early_access", None), "kpi8_monthly_trend": ("year_month", None),
    "sql_kpi1_revenue_platform": ("platform", "total_revenue_usd"), "sql_kpi2_revenue_genre": ("genre", "total_revenue_usd"),
    "sql_kpi3_top_genres_ccu": ("genre", "avg_concurrent_players"), "sql_kpi4_avg_ccu_platform": ("platform", "avg_concurrent_players"),
    "sql_kpi5_avg_price_platform": ("platform", "avg_price_usd"), "sql_kpi6_discount_rate": ("platform", "avg_discount_pct"),
    "sql_kpi7_early_vs_full": ("release_type", "total_revenue_usd"), "sql_kpi8_monthly_trend": ("year_month", None),
}

POSITIONS_BODY = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS kpi_name, row_number() OVER (ORDER BY {f'{by} DESC NULLS LAST, ' if by else ''}{key} NULLS FIRST) AS position, CAST({key} AS VARCHAR) AS label, CAST({by or 'NULL'} AS DOUBLE) AS value FROM {name}"
    for name, (key, by) in ORDERED_BY.items())

INFERRED_TYPES = ("obs_date date, platform string, genre string, current_price_usd double, discount_pc double, is_on_sale int, "
                  "concurrent_players int, hype_score double, estimated_revenue_usd double, is_early_access int, holiday_sale int")


EVENTS_PARSED = f"""
SELECT e.*, CAST(ts AS TIMESTAMP) AS event_time
FROM ({EVENT_ROWS.replace('FROM events', ', ts FROM events')}) e"""

EVENT_COLS = ("timestamp, platform, genre, concurrent_players, hype_score, current_price_usd, "
              "is_on_sale, hype_spike, event_time")


DERIVED = """
WITH l AS (
  SELECT l_orderkey, l_linenumber, p_retailprice AS base,
         CAST(round(l_discount*100) AS DOUBLE) AS disc,
         CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS on_sale,
         CAST(l_quantity * p_size * 100 AS INT) AS players
  FROM lineitem JOIN part ON l_partkey = p_partkey),
p AS (
  SELECT *, CASE WHEN on_sale = 1
                 THEN CAST(round(CAST(base AS DECIMAL(18,8)) * (100 - CAST(disc AS DECIMAL(11,8))) / 100, 2) AS DOUBLE)
                 ELSE base END AS price
  FROM l),
e AS (
  SELECT *, CAST(round(CAST(players AS DECIMAL(10,0)) * CAST(price AS DECIMAL(16,6)) * CAST(0.15 AS DECIMAL(3,2)), 2) AS DOUBLE)
              AS est
  FROM p)
SELECT l_orderkey, l_linenumber, CAST(price AS DOUBLE) AS current_price_usd,
       CASE WHEN est <= 0 THEN 100.0 ELSE est END AS estimated_revenue_usd,
       CASE WHEN players > 300000 THEN 1 ELSE 0 END AS hype_spike
FROM e"""


ML_ROWS = """
SELECT concurrent_players, hype_score, discount_pc, estimated_revenue_usd
FROM market_clean
WHERE estimated_revenue_usd > 0
  AND concurrent_players IS NOT NULL
  AND hype_score IS NOT NULL AND NOT isnan(hype_score)
  AND discount_pc IS NOT NULL AND NOT isnan(discount_pc)"""

ML_SPLIT = f"""
SELECT concurrent_players, hype_score, discount_pc, estimated_revenue_usd,
       CAST(CAST('0x' || substr(digits, 9, 8) AS BIGINT) % 3 AS INT) AS fold,
       CASE WHEN CAST('0x' || substr(digits, 1, 8) AS BIGINT) % 1000 < 800 THEN 'train' ELSE 'test' END AS side
FROM (SELECT *, md5(concat_ws('|', {', '.join(f"CAST(CAST(round(CAST({c} AS DOUBLE) * 1000) AS HUGEINT) AS VARCHAR)"
                                              for c in ('concurrent_players', 'hype_score', 'discount_pc', 'estimated_revenue_usd'))})) AS digits
      FROM ({ML_ROWS}))"""

# The normal equations of three standardised features, by Cramer's rule.
ML_LEAST_SQUARES = f"""
, ml AS ({ML_SPLIT}),
s AS (SELECT avg(concurrent_players) AS m1, avg(hype_score) AS m2, avg(discount_pc) AS m3, avg(estimated_revenue_usd) AS my,
             stddev_samp(concurrent_players) AS d1, stddev_samp(hype_score) AS d2, stddev_samp(discount_pc) AS d3,
             corr(concurrent_players, hype_score) AS a, corr(concurrent_players, discount_pc) AS b, corr(hype_score, discount_pc) AS c,
             covar_samp(concurrent_players, estimated_revenue_usd) / stddev_samp(concurrent_players) AS y1,
             covar_samp(hype_score, estimated_revenue_usd) / stddev_samp(hype_score) AS y2,
             covar_samp(discount_pc, estimated_revenue_usd) / stddev_samp(discount_pc) AS y3
      FROM ml WHERE side = 'train'),
d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM s),
w AS (SELECT *, (y1 * (1 - c * c) + y2 * (b * c - a) + y3 * (a * c - b)) / det AS w1,
             (y1 * (b * c - a) + y2 * (1 - b * b) + y3 * (a * b - c)) / det AS w2,
             (y1 * (a * c - b) + y2 * (a * b - c) + y3 * (1 - a * a)) / det AS w3 FROM d),
t AS (SELECT estimated_revenue_usd AS y, my + w1 * (concurrent_players - m1) / d1 + w2 * (hype_score - m2) / d2 + w3 * (discount_pc - m3) / d3 AS p
      FROM ml, w WHERE side = 'test'),
e AS (SELECT sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM t)
SELECT term, printf('%.5e', value) AS value FROM (
  SELECT 'concurrent_players' AS term, w1 AS value FROM w UNION ALL SELECT 'hype_score', w2 FROM w UNION ALL SELECT 'discount_pc', w3 FROM w
  UNION ALL SELECT 'intercept', my FROM w UNION ALL SELECT 'rmse', rmse FROM e UNION ALL SELECT 'r2', r2 FROM e)"""


def elastic_net(penalties: str = "(0.01, 0.0), (0.01, 0.5), (0.1, 0.0), (0.1, 0.5)", folds: int = 3) -> str:
    """The tuned regression as CTEs, up to ``best`` (the chosen combination) and ``scored`` (its test rows).

    Each model m < folds is fitted without the rows of fold m, the model m = folds on all training rows. In
    units of standard deviations, with the correlations R of the features and r of features and label, the
    elastic net minimises b'Rb/2 - r'b + l1 * sum(abs(b)) + l2 * b'b/2. Its solution has some signs: for each
    of the 27 sign patterns, zeros included, the linear system of the features that are not zero is solved by
    Cramer's rule, and the pattern that meets the conditions of an optimum is the solution.
    """
    features = ("concurrent_players", "hype_score", "discount_pc")
    y = "estimated_revenue_usd"
    of = lambda k, c: f"avg({c}) AS m{k}, stddev_pop({c}) AS d{k}, stddev_samp({c}) AS s{k}, corr({c}, {y}) AS r{k}"
    x1, x2, x3 = features
    predicted = f"my + dy * (b1 * ({x1} - m1) / d1 + b2 * ({x2} - m2) / d2 + b3 * ({x3} - m3) / d3)"
    return f"""
, ml AS ({ML_SPLIT}),
given AS (SELECT m, ml.* FROM ml, range({folds + 1}) t(m) WHERE side = 'train' AND fold <> m),
moments AS (SELECT m, {', '.join(of(k, c) for k, c in enumerate(features, 1))}, avg({y}) AS my, stddev_pop({y}) AS dy,
                   corr({x1}, {x2}) AS a, corr({x1}, {x3}) AS b, corr({x2}, {x3}) AS c FROM given GROUP BY m),
grid(reg_param, elastic_net_param) AS (VALUES {penalties}),
problem AS (SELECT *, reg_param * elastic_net_param / dy AS l1, reg_param * (1 - elastic_net_param) / dy AS l2
            FROM moments, (SELECT CAST(reg_param AS DOUBLE) AS reg_param, CAST(elastic_net_param AS DOUBLE) AS elastic_net_param FROM grid)),
signed AS (SELECT *, CASE WHEN g1 <> 0 THEN 1 + l2 ELSE 1 END AS p11, CASE WHEN g2 <> 0 THEN 1 + l2 ELSE 1 END AS p22, CASE WHEN g3 <> 0 THEN 1 + l2 ELSE 1 END AS p33,
                  a * abs(g1 * g2) AS p12, b * abs(g1 * g3) AS p13, c * abs(g2 * g3) AS p23,
                  abs(g1) * (r1 - l1 * g1) AS h1, abs(g2) * (r2 - l1 * g2) AS h2, abs(g3) * (r3 - l1 * g3) AS h3
           FROM problem, range(-1, 2) t1(g1), range(-1, 2) t2(g2), range(-1, 2) t3(g3)),
solved AS (SELECT *, p11 * (p22 * p33 - p23 * p23) - p12 * (p12 * p33 - p23 * p13) + p13 * (p12 * p23 - p22 * p13) AS det,
                  (h1 * (p22 * p33 - p23 * p23) - p12 * (h2 * p33 - p23 * h3) + p13 * (h2 * p23 - p22 * h3)) / det AS b1,
                  (p11 * (h2 * p33 - p23 * h3) - h1 * (p12 * p33 - p23 * p13) + p13 * (p12 * h3 - h2 * p13)) / det AS b2,
                  (p11 * (p22 * h3 - h2 * p23) - p12 * (p12 * h3 - h2 * p13) + h1 * (p12 * p23 - p22 * p13)) / det AS b3 FROM signed),
fitted AS (SELECT * FROM solved
           WHERE CASE WHEN g1 <> 0 THEN g1 * b1 > 0 ELSE abs(r1 - a * b2 - b * b3) <= l1 END
             AND CASE WHEN g2 <> 0 THEN g2 * b2 > 0 ELSE abs(r2 - a * b1 - c * b3) <= l1 END
             AND CASE WHEN g3 <> 0 THEN g3 * b3 > 0 ELSE abs(r3 - b * b1 - c * b2) <= l1 END),
tried AS (SELECT m, reg_param, elastic_net_param, sqrt(avg(({y} - p) * ({y} - p))) AS rmse
          FROM (SELECT fitted.m, reg_param, elastic_net_param, {y}, {predicted} AS p FROM ml JOIN fitted ON fold = m WHERE side = 'train') GROUP BY ALL),
searched AS (SELECT reg_param, elastic_net_param, avg(rmse) AS avg_rmse FROM tried GROUP BY ALL),
best AS (SELECT fitted.* FROM fitted JOIN searched USING (reg_param, elastic_net_param) WHERE m = {folds} ORDER BY avg_rmse, reg_param, elastic_net_param LIMIT 1),
scored AS (SELECT {y} AS y, {predicted} AS p FROM ml, best WHERE side = 'test')"""


def six_digits(c: str) -> str:
    return f"CAST(printf('%.5e', {c}) AS DOUBLE)"


ML_TERMS = (("concurrent_players", "b1 * dy * s1 / d1"), ("hype_score", "b2 * dy * s2 / d2"), ("discount_pc", "b3 * dy * s3 / d3"), ("intercept", "my"))
ML_PREDICTIONS = f"{elastic_net()}\nSELECT y AS estimated_revenue_usd, {six_digits('p')} AS predicted_revenue FROM scored"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {
        "market_raw": f"{MARKET_RAW}",
        "market_clean": with_market("SELECT * FROM market_clean"),
    }
    for name, body in KPI_BODIES.items():
        out[name] = with_market(body)
    for name, body in SQL_KPI_BODIES.items():
        out[name] = with_market(body)
    out.update({
        "revenue_share_genre": with_kpis(SHARE_BODY),
        "serving_summary": with_kpis(SUMMARY_BODY),
        "kpi_export_unified": with_kpis(EXPORT_BODY),
        "kpi_export_sql_unified": with_kpis(SQL_EXPORT_BODY),
        "chart_tables": with_kpis(CHARTS_BODY),
        "kpi_positions": with_kpis(POSITIONS_BODY),
        "curated_roundtrip": out["market_clean"],
        "market_csv_variants": out["market_clean"],
        "market_csv_inferred": f"SELECT *, '{INFERRED_TYPES}' AS types FROM ({MARKET_RAW})",
        "market_csv_roundtrip": out["market_clean"],
        "curated_view_kpi": out["sql_kpi6_discount_rate"],
        "kpi_export_from_store": with_kpis(EXPORT_BODY),
        "event_json_roundtrip": f"SELECT {EVENT_COLS} FROM ({EVENTS_PARSED})",
        "hype_alerts_batch": f"SELECT {EVENT_COLS} FROM ({EVENTS_PARSED}) WHERE hype_spike = 1",
        "hype_alerts_stream": f"SELECT {EVENT_COLS} FROM ({EVENTS_PARSED}) WHERE hype_spike = 1",
        "hype_alerts_restart": f"SELECT {EVENT_COLS} FROM ({EVENTS_PARSED}) WHERE hype_spike = 1",
        "hype_alerts_two_sinks": f"SELECT {EVENT_COLS}, unnest(['parquet', 'json']) AS sink FROM ({EVENTS_PARSED}) WHERE hype_spike = 1",
        "hype_alerts_from_position": f"SELECT {EVENT_COLS}, unnest(CASE is_on_sale WHEN 0 THEN ['earliest'] ELSE ['earliest', 'after the first part'] END) AS start FROM ({EVENTS_PARSED}) WHERE hype_spike = 1",
        "hype_alerts_timed": f"SELECT {EVENT_COLS}, is_on_sale + 1 AS arrival FROM ({EVENTS_PARSED}) WHERE hype_spike = 1",
        "derived_price_revenue": DERIVED,
        "ml_training_set": with_market(ML_ROWS),
        "ml_split": with_market(ML_SPLIT),
        "ml_least_squares": with_market(ML_LEAST_SQUARES),
        "ml_training": with_market(f"{elastic_net()}\nSELECT reg_param, elastic_net_param, {six_digits('avg_rmse')} AS avg_rmse FROM searched"),
        "ml_coefficients": with_market(elastic_net() + "\n" + " UNION ALL ".join(f"SELECT '{t}' AS term, {six_digits(v)} AS value, reg_param, elastic_net_param FROM best" for t, v in ML_TERMS)),
        "ml_metrics": with_market(f"{elastic_net()}\nSELECT {six_digits('sqrt(avg((y - p) * (y - p)))')} AS rmse, {six_digits('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2 FROM scored"),
        "ml_predictions": with_market(ML_PREDICTIONS),
        "ml_model_roundtrip": with_market(ML_PREDICTIONS),
    })
    return out
