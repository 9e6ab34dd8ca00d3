"""The registered queries as SQL, written from the definitions and run on the driver's tables."""

from __future__ import annotations

import re

# Money is summed as a decimal in both engines; see roomlens.functions.numbers.
_BASE = {
    "raw_events": """
        SELECT CASE WHEN event_id % 101 = 0 THEN 'no time'
                    ELSE strftime(CASE WHEN event_id % 59 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END,
                                  '%Y-%m-%d %H:%M:%S.%f') || '+00:00' END AS event_time,
               CASE WHEN event_id % 89 = 0 THEN NULL
                    WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'cart'
                    WHEN event_type = 'click' THEN 'remove_from_cart'
                    WHEN event_type = 'purchase' AND event_id % 2 = 0 AND k % 20 <> 3
                         AND (k % 25 <> 7 OR event_id % 20 = 0) AND (k % 6 <> 5 OR event_id % 4 = 0)
                         AND (k < 88 OR event_id % 4 = 0)
                         AND (day(ts) NOT IN (12, 24) OR event_id % 16 = 0)
                         AND (day(ts) <> 18 OR event_id % 4 = 0) THEN 'purchase'
                    ELSE 'view' END AS event_type,
               CAST(17200000 + k + 100 * CASE WHEN event_id % 7 = 0 OR event_id % 3 = 0 THEN 0
                    ELSE 1 + event_id // 2500 END AS BIGINT) AS product_id,
               CAST(2053013559000000000 + k % 6 AS BIGINT) AS category_id,
               CASE WHEN k >= 96 THEN 'electronics.smartphone'
                    WHEN k % 6 = 0 THEN 'furniture.living_room.sofa'
                    WHEN k % 6 = 1 THEN 'furniture.living_room.cabinet'
                    WHEN k % 6 = 2 THEN 'furniture.bedroom.bed'
                    WHEN k % 6 = 3 THEN 'furniture.kitchen.chair'
                    WHEN k % 6 = 4 THEN 'furniture.kitchen.table'
                    ELSE 'furniture.bathroom.bath' END AS category_code,
               CASE WHEN event_id % 113 = 0 THEN '' WHEN k % 5 <> 0 THEN 'brand_' || (k % 12) END
                   AS brand,
               CASE WHEN event_id % 97 = 0 THEN '0.00' WHEN event_id % 103 = 0 THEN 'abc'
                    WHEN event_id % 107 = 0 THEN 'nan' WHEN event_id % 109 = 0 THEN NULL
                    ELSE CAST(CAST(k * 8 + 0.99 AS DECIMAL(10,2)) AS VARCHAR) END AS price,
               user_id,
               user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS user_session
        FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN 10
                             ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
              FROM events)""",
    "furniture": "SELECT * FROM raw_events WHERE category_code LIKE 'furniture%'",
    "stg_events": "SELECT * FROM furniture",
    "parsed_events": """
        SELECT * REPLACE (CAST(try_cast(event_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP)
                              AS event_time,
                          CASE WHEN isfinite(try_cast(price AS DOUBLE)) THEN CAST(price AS DOUBLE)
                               ELSE 0.0::DOUBLE END AS price)
        FROM stg_events""",
    "clean": """
        SELECT event_time, CAST(event_time AS DATE) AS event_date, event_type, product_id,
               category_id, category_code,
               replace(category_code, 'furniture.', '') AS furniture_type,
               string_split(category_code, '.')[2] AS room_type,
               string_split(category_code, '.')[3] AS item_type,
               coalesce(brand, 'Unknown') AS brand, price,
               CASE WHEN price = 0 THEN 'Unknown' WHEN price < 100 THEN 'Budget'
                    WHEN price < 300 THEN 'Mid-Range' WHEN price < 700 THEN 'Premium'
                    ELSE 'Luxury' END AS price_segment,
               CAST(price = 0 AS INTEGER) AS is_zero_price, user_id, user_session,
               CAST(hour(event_time) AS INTEGER) AS event_hour,
               dayname(event_time) AS day_of_week,
               CASE WHEN isodow(event_time) >= 6 THEN 'Weekend'
                    WHEN event_time IS NOT NULL THEN 'Weekday' END AS day_type,
               CAST(weekofyear(event_time) AS INTEGER) AS week_number,
               CAST(month(event_time) AS INTEGER) AS month, monthname(event_time) AS month_name,
               CAST(year(event_time) AS INTEGER) AS year
        FROM parsed_events""",
    "fact": """
        SELECT user_id, user_session, product_id, event_type, event_time, event_date, event_hour,
               category_code, room_type, item_type, brand, price, price_segment,
               CASE WHEN event_type = 'purchase' AND is_zero_price = 0 THEN price ELSE 0.0 END
                   AS revenue,
               CAST(coalesce(event_type = 'view', false) AS INTEGER) AS is_view,
               CAST(coalesce(event_type = 'cart', false) AS INTEGER) AS is_cart,
               CAST(coalesce(event_type = 'purchase', false) AS INTEGER) AS is_purchase,
               is_zero_price, year, month, month_name, week_number, day_of_week, day_type
        FROM clean""",
    "raw_products": """
        SELECT 'B' || lpad(CAST(n AS VARCHAR), 9, '0') AS asin, p_name AS title,
               CASE WHEN n % 11 <> 0 THEN p_brand || ' Store' END AS brand,
               CASE WHEN n % 7 = 0 OR (p_type = 'SMALL' AND n % 3 = 0) THEN NULL
                    WHEN n % 13 = 0 THEN '$1,049.99' WHEN n % 19 = 0 THEN 'n/a'
                    ELSE '$' || (p_size * 4) || '.50' END AS price,
               CASE n % 8 WHEN 1 THEN 'In Stock' WHEN 2 THEN 'Only 3 left in stock - order soon.'
                    WHEN 3 THEN 'Temporarily out of stock.' WHEN 4 THEN 'Currently unavailable.'
                    WHEN 5 THEN 'Temporarily on hold' WHEN 6 THEN 'Usually ships within 1-2 days'
                    WHEN 7 THEN 'Preorder' END AS availability,
               CASE WHEN n % 17 = 0 THEN 'garbage'
                    WHEN n % 31 = 0 THEN ['[''A'', ''Furniture'', ''Sofas'',]', '[''A'', None, ''x'']',
                        '(''A'', ''Furniture'')', '''B'' ''C''', '[''A'', ''Furniture'', ''S''] junk',
                        '[''A'', 5, ''x'']', '[''A'', ''Furniture'', ''x\\xa0'']'][n // 31 % 7 + 1]
                    WHEN n % 9 = 0 THEN '[''Home & Kitchen'', ''Bedding'', ''' || p_type || ''']'
                    WHEN n % 23 = 0 THEN '[''Home & Kitchen'', ''Furniture'']'
                    ELSE '[''Home & Kitchen'', ''Furniture'', ''' || p_type || ''']' END
                   AS categories,
               CASE WHEN n % 10 <> 3 THEN lower(p_type) END AS material,
               ['Brown', 'Grey', ''][n % 4 + 1] AS color,
               CASE WHEN n % 6 = 1 THEN 'Modern' END AS style,
               CASE WHEN n % 5 = 2 THEN 'Denmark' END AS country_of_origin,
               CASE n % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN 'November 3, 2019'
                    WHEN 2 THEN 'Nov 3, 2019' WHEN 3 THEN '11/03/2019' WHEN 4 THEN '3 November 2019'
                    WHEN 5 THEN NULL ELSE '2020-0' || (n % 9 + 1) || '-15' END
                   AS date_first_available,
               CASE WHEN n % 3 = 0 THEN '20 x 30 x 40 inches' END AS package_dimensions,
               CASE WHEN n % 4 = 3 THEN 'Maker ' || (n % 9) END AS manufacturer
        FROM (SELECT *, p_partkey AS n FROM part)""",
    # The categories that are no JSON are few and known: form by form, what they hold.
    "parsed_products": """
        SELECT * EXCLUDE (c, form),
               CASE WHEN form IN (1, 3) THEN 'Furniture' WHEN form = 7 THEN 'Furniture' WHEN form = 4 THEN 'C'
                    ELSE json_extract_string(c, '$[1]') END AS main_category,
               CASE form WHEN 1 THEN 'Sofas' WHEN 2 THEN 'x' WHEN 6 THEN 'x' WHEN 7 THEN 'x'
                    ELSE json_extract_string(c, '$[2]') END AS sub_category,
               CASE form WHEN 6 THEN '5' ELSE main_category END AS preview_main,
               CASE form WHEN 7 THEN 'x' || chr(160) ELSE sub_category END AS preview_sub,
               try_cast(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS amount
        FROM (SELECT *, CASE WHEN n % 31 = 0 AND n % 17 <> 0 THEN n // 31 % 7 + 1 END AS form,
                     CASE WHEN n % 31 <> 0 THEN try_cast(replace(categories, chr(39), '"') AS JSON) END AS c
              FROM (SELECT *, CAST(substr(asin, 2) AS BIGINT) AS n FROM raw_products))""",
    "furniture_products": "SELECT * FROM parsed_products WHERE main_category = 'Furniture'",
    "imputed": """
        SELECT p.* EXCLUDE (price),
               coalesce(p.amount, CASE WHEN p.sub_category IS NULL
                   THEN (SELECT quantile_cont(amount, 0.5) FROM furniture_products)
                   ELSE m.med END) AS price
        FROM furniture_products p LEFT JOIN (
            SELECT sub_category, quantile_cont(amount, 0.5) AS med FROM furniture_products
            GROUP BY sub_category) m ON p.sub_category = m.sub_category""",
    "clean_products": """
        SELECT asin, title, trim(replace(coalesce(brand, 'None'), ' Store', '')) AS brand, price,
               CASE WHEN price IS NULL OR price = 0 THEN 'Unknown' WHEN price < 30 THEN 'Budget'
                    WHEN price < 80 THEN 'Mid-Range' WHEN price < 150 THEN 'Premium'
                    ELSE 'Luxury' END AS price_segment,
               main_category, sub_category,
               CASE WHEN availability IS NULL THEN 'Unknown'
                    WHEN contains(lower(availability), 'in stock') THEN 'In Stock'
                    WHEN contains(lower(availability), 'out of stock')
                      OR contains(lower(availability), 'unavailable') THEN 'Out of Stock'
                    WHEN contains(lower(availability), 'temporarily') THEN 'Temporarily Unavailable'
                    WHEN contains(lower(availability), '1-2 days')
                      OR contains(lower(availability), 'ship') THEN 'Ships Soon'
                    ELSE 'Other' END AS availability,
               upper(substr(coalesce(material, 'None'), 1, 1))
                   || lower(substr(coalesce(material, 'None'), 2)) AS material,
               color, style, country_of_origin,
               CAST(try_strptime(date_first_available,
                   ['%Y-%m-%d', '%B %d, %Y', '%b %d, %Y', '%m/%d/%Y', '%d %B %Y']) AS DATE)
                   AS date_first_available, manufacturer
        FROM imputed""",
    "dim_date": """
        SELECT DISTINCT event_date, year, month, month_name, week_number, day_of_week, day_type,
               CAST(quarter(event_date) AS INTEGER) AS quarter,
               'Q' || quarter(event_date) AS quarter_name,
               CAST(day(event_date) = 1 AS INTEGER) AS is_month_start,
               CAST(event_date = last_day(event_date) AS INTEGER) AS is_month_end
        FROM clean""",
    "dim_products": """
        SELECT row_number() OVER (ORDER BY asin) AS product_key, asin, title, brand, price,
               price_segment, main_category, sub_category, availability,
               CAST(availability = 'In Stock' AS INTEGER) AS in_stock_flag,
               CASE WHEN material IS NULL OR material = 'None' THEN 'Unknown' ELSE material END
                   AS material,
               color, style, country_of_origin, date_first_available, manufacturer
        FROM clean_products""",
}

_STAGES = """count(*) FILTER (event_type = 'view') AS views,
               count(*) FILTER (event_type = 'cart') AS cart_adds,
               count(*) FILTER (event_type = 'purchase') AS purchases"""
_MONEY = "DECIMAL(30,6)"
_REVENUE = f"coalesce(sum(CAST(revenue AS {_MONEY})), 0)"
_RATE = """round(count(*) FILTER (event_type = 'purchase') * 100.0::DOUBLE
                   / nullif(count(*) FILTER (event_type = 'view'), 0), 2)"""


def _even(expr: str, digits: int) -> str:
    """Half-to-even rounding by scaling."""
    scale = 10**digits
    return f"(round_even(({expr}) * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE + 0.0)"


def _pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100.0::DOUBLE)"


_CVR = _even(_pct("purchases", "views"), 4)

def _integral(density: str, low: str, high: str) -> str:
    """Simpson's rule over 20,000 steps; ``density`` is written in ``t``."""
    step = f"(({high}) - ({low})) / 20000.0::DOUBLE"
    return f"""(SELECT sum(w * ({density})) * {step} / 3.0::DOUBLE
               FROM (SELECT ({low}) + i * {step} AS t,
                            CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
                     FROM range(20001) AS steps(i)))"""


def _chi2_tail(x: str, df: str) -> str:
    """Upper tail of the chi-square distribution, with t = sqrt(x) to keep the density smooth."""
    density = f"2 * exp(({df} - 1) * ln(t) - t * t / 2 - {df} / 2 * ln(2) - lgamma({df} / 2))"
    return _integral(density, f"sqrt({x})", f"sqrt({x}) + 40")


def _f_tail(f: str, df1: str, df2: str) -> str:
    """Upper tail of the F distribution as an incomplete beta integral."""
    density = f"""CASE WHEN t <= 0 THEN 0 ELSE exp(
        lgamma(({df1} + {df2}) / 2) - lgamma({df1} / 2) - lgamma({df2} / 2)
        + ({df2} / 2 - 1) * ln(t) + ({df1} / 2 - 1) * ln(1 - t)) END"""
    return _integral(density, "0.0::DOUBLE", f"{df2} / ({df2} + {df1} * {f})")


_VIEWS = {
    "vw_conversion_funnel": """
        SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
               count(DISTINCT user_session) AS unique_sessions,
               round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct_of_total
        FROM fact GROUP BY event_type""",
    "vw_room_performance": f"""
        SELECT room_type, item_type, {_STAGES},
               CAST(round({_REVENUE}, 2) AS DOUBLE) AS total_revenue, {_RATE} AS conversion_rate_pct
        FROM fact GROUP BY room_type, item_type""",
    "vw_price_segment_analysis": f"""
        SELECT price_segment, {_STAGES},
               CAST(round({_REVENUE}, 2) AS DOUBLE) AS total_revenue, {_RATE} AS conversion_rate_pct,
               round(avg(price) FILTER (event_type = 'purchase'), 2) AS avg_purchase_price
        FROM fact WHERE is_zero_price = 0 GROUP BY price_segment""",
    "vw_brand_performance": f"""
        SELECT brand, {_STAGES},
               CAST(round({_REVENUE}, 2) AS DOUBLE) AS total_revenue, {_RATE} AS conversion_rate_pct
        FROM fact WHERE brand <> 'Unknown' AND is_zero_price = 0
        GROUP BY brand HAVING views > 100""",
    "vw_daily_trend": f"""
        SELECT event_date, year, month, month_name, week_number, day_of_week, day_type, {_STAGES},
               CAST(round({_REVENUE}, 2) AS DOUBLE) AS daily_revenue,
               count(DISTINCT user_id) AS active_users, count(DISTINCT user_session) AS sessions
        FROM fact
        GROUP BY event_date, year, month, month_name, week_number, day_of_week, day_type""",
    "vw_hourly_behavior": f"""
        SELECT event_hour, day_type, {_STAGES}, CAST(round({_REVENUE}, 2) AS DOUBLE) AS revenue
        FROM fact GROUP BY event_hour, day_type""",
    "vw_high_view_no_purchase": f"""
        SELECT product_id, brand, room_type, item_type, price_segment, {_STAGES},
               round(avg(price), 2) AS avg_price
        FROM fact GROUP BY product_id, brand, room_type, item_type, price_segment
        HAVING views > 15 AND purchases = 0
        ORDER BY views DESC, product_id, brand, room_type, item_type, price_segment LIMIT 30""",
}

_METRICS = {
    "products": f"""
        SELECT product_id, {_STAGES}, count(*) AS events,
               sum(CAST(revenue AS {_MONEY})) AS revenue,
               coalesce(sum(CAST(price AS {_MONEY})) FILTER (event_type = 'purchase'), 0)
                   AS order_price,
               coalesce(sum(CAST(revenue AS {_MONEY}))
                   FILTER (event_type = 'purchase' AND revenue > 0), 0) AS paid_revenue,
               count(*) FILTER (event_type = 'purchase' AND revenue > 0) AS paid_orders,
               max(price) AS price, max(brand) AS brand, max(room_type) AS room_type,
               max(price_segment) AS price_segment
        FROM fact GROUP BY product_id""",
    "funnel_raw": f"""
        SELECT *, (purchases - 0.02 * views) ^ 2 / (0.02 * views)
                  + (views - purchases - 0.98 * views) ^ 2 / (0.98 * views) AS chi2
        FROM (SELECT CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS views,
                     count(*) FILTER (event_type = 'cart') AS carts,
                     count(*) FILTER (event_type = 'purchase') AS purchases FROM fact)""",
    "funnel": f"""
        SELECT views, carts, purchases, {_even(_pct('carts', 'views'), 2)} AS view_to_cart_pct,
               {_even(_pct('purchases', 'carts'), 2)} AS cart_to_purchase_pct,
               {_CVR} AS overall_cvr_pct, {_even(_pct('views - purchases', 'views'), 2)} AS drop_off_pct,
               {_even(_pct('purchases', 'views') + ' - 2.0::DOUBLE', 2)} AS vs_industry_pct,
               {_even('chi2', 2)} AS chi2_statistic
        FROM funnel_raw""",
    "paid": "SELECT price_segment, revenue FROM fact WHERE event_type = 'purchase' AND revenue > 0",
    "segments": f"""
        SELECT price_segment, {_STAGES}, sum(CAST(revenue AS {_MONEY})) AS revenue
        FROM fact GROUP BY price_segment""",
    "rooms": f"""
        SELECT room_type, {_STAGES}, sum(CAST(revenue AS {_MONEY})) AS revenue
        FROM fact GROUP BY room_type""",
    "hours": f"""
        SELECT hour, purchases, views, {_CVR} AS cvr_pct
        FROM (SELECT event_hour AS hour, {_STAGES} FROM fact GROUP BY event_hour)""",
    "hour_interval": f"""
        SELECT n AS hours, {_even('m', 1)} AS mean_per_hour,
               {_even('m - t * sd / sqrt(n)', 1)} AS ci_95_low,
               {_even('m + t * sd / sqrt(n)', 1)} AS ci_95_high
        FROM (SELECT count(*) AS n, avg(purchases) AS m, stddev_samp(purchases) AS sd,
                     CASE count(*) WHEN 24 THEN 2.0686576104190406 WHEN 25 THEN 2.0638985616280205 END
                         AS t
              FROM hours)""",
    "hour_extremes": """
        SELECT first(hour ORDER BY purchases DESC, hour) AS peak_hour, max(purchases) AS peak_count,
               first(hour ORDER BY purchases, hour) AS trough_hour, min(purchases) AS trough_count
        FROM hours WHERE hour IS NOT NULL""",
    "ranked_rooms": f"""
        SELECT room_type, purchases, views, {_CVR} AS cvr_pct FROM rooms WHERE views > 100""",
    "wilson": f"""
        SELECT room_type, purchases, views, cvr_pct,
               {_even('(centre - margin) * 100.0::DOUBLE', 4)} AS ci_low,
               {_even('(centre + margin) * 100.0::DOUBLE', 4)} AS ci_high
        FROM (SELECT *, (p + z * z / (2 * n)) / (1 + z * z / n) AS centre,
                     z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n) AS margin
              FROM (SELECT *, 1.96::DOUBLE AS z, CAST(views AS DOUBLE) AS n,
                           purchases / CAST(views AS DOUBLE) AS p FROM ranked_rooms))""",
    "anova": """
        SELECT CAST(k AS DOUBLE) AS k, CAST(n AS DOUBLE) AS n, ssb, sst,
               (ssb / (k - 1)) / ((sst - ssb) / (n - k)) AS f
        FROM (SELECT count(*) AS k, sum(size) AS n, sum(size * (mean - grand) ^ 2) AS ssb,
                     any_value(sst) AS sst
              FROM (SELECT price_segment, count(*) AS size, avg(revenue) AS mean FROM paid
                    GROUP BY price_segment),
                   (SELECT avg(revenue) AS grand, var_pop(revenue) * count(*) AS sst FROM paid))""",
    "kruskal_samples": """
        SELECT event_hour AS hour, count(*) AS cnt FROM fact
        WHERE event_type = 'purchase' AND event_hour IS NOT NULL GROUP BY event_date, event_hour""",
    "kruskal": """
        SELECT k AS hours, CAST(n AS BIGINT) AS samples,
               (12 * q / (n * (n + 1)) - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h
        FROM (SELECT count(*) AS k, CAST(sum(size) AS DOUBLE) AS n, sum(rs * rs / size) AS q
              FROM (SELECT hour, sum(r) AS rs, count(*) AS size
                    FROM (SELECT hour, rank() OVER (ORDER BY cnt)
                                 + (count(*) OVER (PARTITION BY cnt) - 1) / 2.0::DOUBLE AS r
                          FROM kruskal_samples)
                    GROUP BY hour)),
             (SELECT sum(CAST(t AS DOUBLE) ^ 3 - t) AS ties
              FROM (SELECT count(*) AS t FROM kruskal_samples GROUP BY cnt))""",
    "room_raw": """
        SELECT top.room_type AS top_room, top.cvr_pct AS top_cvr,
               (top.purchases - top.views * rate) ^ 2 / (top.views * rate)
                   + (top.views - top.purchases - top.views * (1 - rate)) ^ 2
                     / (top.views * (1 - rate)) AS chi2
        FROM (SELECT * FROM ranked_rooms
              ORDER BY purchases / CAST(views AS DOUBLE) DESC, room_type LIMIT 1) top,
             (SELECT sum(purchases) / CAST(sum(views) AS DOUBLE) AS rate
              FROM (SELECT * FROM ranked_rooms
                    ORDER BY purchases / CAST(views AS DOUBLE) DESC, room_type OFFSET 1))""",
    "gap_population": f"""
        SELECT product_id, views, purchases, CAST(revenue AS DOUBLE) AS revenue, {_CVR} AS cvr_pct
        FROM products WHERE views >= 15""",
    "gaps": f"""
        SELECT product_id, views, purchases, revenue, cvr_pct, z_score,
               coalesce(z_score < -0.6, false) OR purchases = 0 AS anomaly,
               {_even('greatest(0.0::DOUBLE, (m / 100.0::DOUBLE * views - purchases) * 220.35::DOUBLE)', 0)}
                   AS revenue_lost
        FROM (SELECT *, {_even('(cvr_pct - m) / nullif(sd, 0)', 3)} AS z_score
              FROM gap_population, (SELECT avg(cvr_pct) AS m, stddev_samp(cvr_pct) AS sd
                                    FROM gap_population))""",
    "gap_totals": f"""
        SELECT count(*) AS total_products, count(*) FILTER (anomaly) AS anomaly_count,
               {_even('avg(cvr_pct)', 4)} AS mean_cvr, {_even('stddev_samp(cvr_pct)', 4)} AS std_cvr,
               coalesce(sum(revenue_lost) FILTER (anomaly), 0.0::DOUBLE) AS total_rev_lost
        FROM gaps""",
    "zero": f"""
        SELECT product_id, views, cart_adds, purchases, price, brand, room_type, price_segment,
               {_even('''views * 0.005::DOUBLE * (SELECT CAST(sum(order_price) AS DOUBLE)
                   / CAST(sum(purchases) AS DOUBLE) FROM products)''', 0)} AS est_revenue_lost,
               CASE WHEN views >= 23 THEN 'CRITICAL' WHEN views >= 20 THEN 'HIGH' ELSE 'MEDIUM' END
                   AS severity,
               'ZERO_PURCHASE' AS alert_type, '2024-02-01' AS run_date
        FROM products WHERE purchases = 0 AND views >= 15""",
    "cvr_population": f"""
        SELECT *, {_CVR} AS cvr_pct FROM products WHERE views >= 15 AND purchases > 0""",
    "anomalies": f"""
        SELECT product_id, views, cart_adds, purchases, price, brand, room_type, price_segment,
               cvr_pct, z_score, expected_purchases,
               expected_purchases - purchases AS purchase_gap,
               {_even('''(expected_purchases - purchases) * (SELECT CAST(sum(paid_revenue) AS DOUBLE)
                   / CAST(sum(paid_orders) AS DOUBLE) FROM products)''', 0)} AS est_revenue_lost,
               CASE WHEN z_score < -1.2 THEN 'CRITICAL' WHEN z_score < -1.1 THEN 'HIGH'
                    ELSE 'MEDIUM' END AS severity,
               {_even('m', 4)} AS mean_cvr_pct, 'CVR_ANOMALY' AS alert_type,
               '2024-02-01' AS run_date
        FROM (SELECT *, {_even('(cvr_pct - m) / nullif(sd, 0)', 3)} AS z_score,
                     {_even('views * m / 100.0::DOUBLE', 0)} AS expected_purchases
              FROM cvr_population, (SELECT avg(cvr_pct) AS m, stddev_samp(cvr_pct) AS sd
                                    FROM cvr_population))
        WHERE z_score < -1.0""",
    "trend": f"""
        SELECT event_date, views, purchases, CAST(revenue AS DOUBLE) AS revenue, cvr_pct,
               rolling_avg, {_even('(cvr_pct - rolling_avg) / nullif(rolling_avg, 0) * 100.0::DOUBLE', 2)}
                   AS cvr_vs_avg,
               rev_rolling, {_even('''(CAST(revenue AS DOUBLE) - rev_rolling) / nullif(rev_rolling, 0)
                   * 100.0::DOUBLE''', 2)} AS rev_vs_avg
        FROM (SELECT *, CASE WHEN count(cvr_pct) OVER w >= 3
                     THEN CAST(sum(CAST(cvr_pct AS DECIMAL(18,4))) OVER w AS DOUBLE)
                          / count(cvr_pct) OVER w END AS rolling_avg,
                     CASE WHEN count(revenue) OVER w >= 3
                     THEN CAST(sum(revenue) OVER w AS DOUBLE) / count(revenue) OVER w END
                         AS rev_rolling
              FROM (SELECT event_date, views, purchases, revenue, {_CVR} AS cvr_pct
                    FROM (SELECT event_date, {_STAGES}, {_REVENUE} AS revenue
                          FROM fact WHERE event_date IS NOT NULL GROUP BY event_date))
              WINDOW w AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
    "drops": """
        SELECT *, CASE WHEN cvr_vs_avg < -40 THEN 'CRITICAL' WHEN cvr_vs_avg < -30 THEN 'HIGH'
                       ELSE 'MEDIUM' END AS severity,
               'DAILY_CVR_DROP' AS alert_type, '2024-02-01' AS run_date
        FROM trend WHERE cvr_vs_avg < -20""",
    "room_monitor": f"""
        SELECT room_type, views, purchases, revenue, cvr_pct, vs_avg_pct,
               coalesce(vs_avg_pct < -20, false) AS alert, '2024-02-01' AS run_date
        FROM (SELECT *, {_even('(cvr_pct - pool) / nullif(pool, 0) * 100.0::DOUBLE', 2)} AS vs_avg_pct
              FROM (SELECT room_type, views, purchases, CAST(revenue AS DOUBLE) AS revenue,
                           {_CVR} AS cvr_pct,
                           {_pct('sum(purchases) OVER ()', 'sum(views) OVER ()')} AS pool FROM rooms))""",
    "segment_monitor": f"""
        SELECT price_segment, views, purchases, revenue, cvr_pct, vs_avg_pct,
               coalesce(vs_avg_pct < -20, false) AS alert, '2024-02-01' AS run_date
        FROM (SELECT *, {_even('(cvr_pct - pool) / nullif(pool, 0) * 100.0::DOUBLE', 2)} AS vs_avg_pct
              FROM (SELECT price_segment, views, purchases, CAST(revenue AS DOUBLE) AS revenue,
                           {_CVR} AS cvr_pct,
                           {_pct('sum(purchases) OVER ()', 'sum(views) OVER ()')} AS pool
                    FROM segments))""",
    "log": f"""
        SELECT alert_type, severity, CAST(product_id AS VARCHAR) AS product_id, views,
               CAST(0 AS BIGINT) AS purchases, est_revenue_lost AS est_rev_lost,
               coalesce(room_type, 'None') AS room_type,
               CAST(NULL AS DOUBLE) AS cvr_pct, CAST(NULL AS DOUBLE) AS z_score,
               CAST(NULL AS VARCHAR) AS date, CAST(NULL AS DOUBLE) AS vs_avg_pct,
               CAST(NULL AS VARCHAR) AS segment,
               'Product ' || product_id || ' has ' || views || ' views and 0 purchases' AS message
        FROM zero
        UNION ALL BY NAME
        SELECT alert_type, severity, CAST(product_id AS VARCHAR) AS product_id, cvr_pct, z_score,
               est_revenue_lost AS est_rev_lost,
               printf('Product %s CVR %.4f%% is %.2f std devs below mean',
                      CAST(product_id AS VARCHAR), cvr_pct, {_even('z_score', 2)}) AS message
        FROM anomalies
        UNION ALL BY NAME
        SELECT alert_type, severity, CAST(event_date AS VARCHAR) AS date, cvr_pct,
               cvr_vs_avg AS vs_avg_pct,
               printf('CVR dropped %.1f%% vs 7-day rolling avg on %s', {_even('cvr_vs_avg', 1)},
                      CAST(event_date AS VARCHAR)) AS message
        FROM drops
        UNION ALL BY NAME
        SELECT 'ROOM_UNDERPERFORM' AS alert_type, 'MEDIUM' AS severity,
               coalesce(room_type, 'None') AS segment, cvr_pct, vs_avg_pct,
               printf('Room ''%s'' CVR is %.1f%% below overall avg', coalesce(room_type, 'None'),
                      {_even('vs_avg_pct', 1)}) AS message
        FROM room_monitor WHERE alert
        UNION ALL BY NAME
        SELECT 'SEGMENT_UNDERPERFORM' AS alert_type, 'MEDIUM' AS severity,
               coalesce(price_segment, 'None') AS segment, cvr_pct, vs_avg_pct,
               printf('Segment ''%s'' CVR is %.1f%% below overall avg',
                      coalesce(price_segment, 'None'), {_even('vs_avg_pct', 1)}) AS message
        FROM segment_monitor WHERE alert""",
}

_NAMED = {**_BASE, **_VIEWS, **_METRICS}


def _counts(table: str, column: str, top: int | None = None) -> str:
    limit = "" if top is None else f" ORDER BY row_count DESC, value LIMIT {top}"
    return (
        f"SELECT {column} AS value, count(*) AS row_count FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column}{limit}"
    )


def _nulls(table: str, columns: tuple[str, ...], only_with_nulls: bool = False) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"{_pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct FROM {table}"
        for c in columns
    )
    return f"SELECT * FROM ({parts}) WHERE null_count > 0" if only_with_nulls else parts


def _describe(source: str, column: str) -> str:
    stats = {
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})",
        "q25": f"quantile_cont({column}, 0.25)",
        "q50": f"quantile_cont({column}, 0.5)",
        "q75": f"quantile_cont({column}, 0.75)",
        "max": f"max({column})",
    }
    columns = ", ".join(f"{_even(expr, 6)} AS {name}" for name, expr in stats.items())
    return f"SELECT count({column}) AS count, {columns} FROM {source}"


def _row_counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


def _shape(table: str, names: tuple[str, ...]) -> str:
    return (
        f"SELECT count(*) AS row_count, CAST({len(names)} AS INTEGER) AS column_count, "
        f"'{', '.join(names)}' AS column_names FROM {table}"
    )


_EVENT_COLUMNS = (
    "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price",
    "user_id", "user_session",
)
_PRODUCT_COLUMNS = (
    "asin", "title", "brand", "price", "availability", "categories", "material", "color", "style",
    "country_of_origin", "date_first_available", "package_dimensions", "manufacturer",
)

_PREVIEW = """
    SELECT asin, title, brand, amount AS price_clean,
           preview_main AS main_category, preview_sub AS sub_category, availability, material, color, style, country_of_origin,
           date_first_available
    FROM parsed_products"""

_KPIS = f"""
    SELECT total_revenue, total_events, total_purchases, total_views, total_cart_adds, unique_users,
           avg_order_value,
           coalesce({_even(_pct('total_purchases', 'total_views'), 2)}, 0.0) AS conversion_rate,
           coalesce({_even(_pct('total_cart_adds - total_purchases', 'total_cart_adds'), 2)}, 0.0)
               AS cart_abandonment_rate
    FROM (SELECT CAST(sum(CAST(revenue AS {_MONEY})) AS DOUBLE) AS total_revenue,
                 count(*) AS total_events,
                 nullif(count(*) FILTER (event_type = 'purchase'), 0) AS total_purchases,
                 nullif(count(*) FILTER (event_type = 'view'), 0) AS total_views,
                 nullif(count(*) FILTER (event_type = 'cart'), 0) AS total_cart_adds,
                 count(DISTINCT user_id) AS unique_users,
                 CAST(sum(CAST(revenue AS {_MONEY})) FILTER (event_type = 'purchase') AS DOUBLE)
                     / nullif(count(*) FILTER (event_type = 'purchase'), 0) AS avg_order_value
          FROM fact)"""

def _p_value(tail: str, source: str) -> str:
    return f"(SELECT CAST({_even(tail, 6)} AS VARCHAR) FROM {source})"


_FINDINGS_TEXTS = {
    "Funnel drop-off": (
        "funnel",
        "drop_off_pct || '% of views do not end in a purchase'",
        f"""'Overall CVR ' || overall_cvr_pct || '%, '
            || printf('%+.2f', {_even('overall_cvr_pct - 2.0::DOUBLE', 2)})
            || ' points against the benchmark'""",
        f"""'Chi-square ' || chi2_statistic || ', p = '
            || {_p_value(_chi2_tail('chi2', '1.0::DOUBLE'), 'funnel_raw')}""",
    ),
    "Price segments": (
        "anova",
        f"""'Order revenue by segment: F = ' || {_even('f', 2)} || ', p = '
            || {_p_value(_f_tail('f', '(k - 1)', '(n - k)'), 'anova')}""",
        f"""'Effect size eta squared ' || {_even('ssb / sst', 4)} || ' ('
            || CASE WHEN {_even('ssb / sst', 4)} > 0.14 THEN 'large'
                    WHEN {_even('ssb / sst', 4)} > 0.06 THEN 'medium' ELSE 'small' END || ')'""",
    ),
    "Hours": (
        "hour_extremes, hour_interval, kruskal",
        "'Peak hour ' || peak_hour || ':00 with ' || peak_count || ' purchases'",
        """'Mean per hour ' || mean_per_hour || ', 95% interval ' || ci_95_low || ' to '
            || ci_95_high""",
        f"""'Business hours bring ' || (SELECT {_even(_pct(
            'sum(purchases) FILTER (hour BETWEEN 9 AND 18)', 'sum(purchases)'), 1)} FROM hours)
            || '% of purchases'""",
        f"""'Kruskal-Wallis H = ' || {_even('h', 2)} || ', p = '
            || {_p_value(_chi2_tail('h', '(hours - 1)::DOUBLE'), 'kruskal')}""",
    ),
    "Rooms": (
        "room_raw",
        "'Best room ' || top_room || ' with ' || top_cvr || '% CVR'",
        f"""'Against all other rooms: chi-square ' || {_even('chi2', 2)} || ', p = '
            || {_p_value(_chi2_tail('chi2', '1.0::DOUBLE'), 'room_raw')}""",
    ),
    "Product gaps": (
        "gap_totals",
        "anomaly_count || ' products with abnormally low CVR'",
        "'Estimated lost revenue $' || format('{:,.0f}', total_rev_lost)",
    ),
}

_FINDINGS = " UNION ALL ".join(
    f"SELECT '{section}' AS section, CAST({line} AS INTEGER) AS line, {text} AS text FROM {source}"
    for section, (source, *texts) in _FINDINGS_TEXTS.items()
    for line, text in enumerate(texts, 1)
)

_BODIES = {
    "stg_events": "SELECT * FROM stg_events",
    "stg_products": "SELECT * FROM raw_products",
    "table_counts": _row_counts(
        {
            "stg_user_events": "stg_events", "stg_products": "raw_products",
            "clean_user_events": "clean", "clean_products": "clean_products",
            "dim_products": "dim_products", "dim_date": "dim_date", "fact_user_events": "fact",
        }
    ),
    "product_preview": _PREVIEW,
    "report_row_counts": _row_counts({name: name for name in _VIEWS}),
    "profile_shape": _shape("raw_events", _EVENT_COLUMNS),
    "profile_shape_products": _shape("raw_products", _PRODUCT_COLUMNS),
    "profile_nulls": _nulls("raw_events", _EVENT_COLUMNS),
    "profile_nulls_products": _nulls("raw_products", _PRODUCT_COLUMNS, only_with_nulls=True),
    "profile_key_nulls": _nulls(
        "furniture", ("user_id", "product_id", "category_code", "price", "brand")
    ),
    "event_type_counts": _counts("raw_events", "event_type"),
    "top_values_category": _counts("raw_events", "category_code", 20),
    "top_values_user": _counts("raw_events", "user_id", 10),
    "top_values_product": _counts("raw_events", "product_id", 15),
    "furniture_event_types": _counts("furniture", "event_type"),
    "furniture_categories": _counts("furniture", "category_code"),
    "top_values_brand": _counts("furniture", "brand", 10),
    "top_values_product_brand": _counts("raw_products", "brand", 10),
    "top_values_availability": _counts("raw_products", "availability", 8),
    "top_values_material": _counts("raw_products", "material", 10),
    "top_main_categories": _counts(f"({_PREVIEW})", "main_category", 10),
    "top_sub_categories": _counts(f"({_PREVIEW})", "sub_category", 15),
    "room_counts": _counts("clean", "room_type"),
    "price_segment_counts": _counts("clean", "price_segment"),
    "clean_event_type_counts": _counts("clean", "event_type"),
    "day_type_counts": _counts("dim_date", "day_type"),
    "product_sub_category_counts": _counts("clean_products", "sub_category"),
    "product_price_segment_counts": _counts("clean_products", "price_segment"),
    "price_describe": _describe(
        "(SELECT CASE WHEN isfinite(try_cast(price AS DOUBLE)) THEN CAST(price AS DOUBLE) END AS price"
        " FROM furniture)", "price"
    ),
    "product_price_describe": _describe("parsed_products", "amount"),
    "clean_price_describe": _describe("clean_products", "price"),
    "unique_brands": "SELECT count(DISTINCT brand) AS distinct_count FROM raw_products",
    "date_range": "SELECT min(event_time) AS range_from, max(event_time) AS range_to FROM furniture",
    "dim_date_range": "SELECT min(event_date) AS range_from, max(event_date) AS range_to FROM dim_date",
    "furniture_share": f"""
        SELECT total_rows, kept_rows, {_pct('kept_rows', 'total_rows')} AS kept_pct
        FROM (SELECT count(*) AS total_rows,
                     count(*) FILTER (category_code LIKE 'furniture%') AS kept_rows FROM raw_events)""",
    "dq_event_types": "SELECT event_type, count(*) AS cnt FROM stg_events GROUP BY event_type",
    "dq_null_brands": """
        SELECT count(*) FILTER (brand IS NULL OR brand = '') AS null_brands FROM stg_events""",
    "dq_zero_price": """
        SELECT count(*) FILTER (price IS NOT NULL
                   AND coalesce(try_cast(price AS DECIMAL(10,2)), 0) = 0) AS zero_price_events
        FROM stg_events""",
    "dq_null_prices": """
        SELECT count(*) FILTER (price IS NULL OR price = 'nan') AS null_prices FROM raw_products""",
    "dq_main_categories": """
        SELECT main_cat, count(*) AS cnt FROM (
            SELECT trim(list_last(list_slice(string_split(
                       replace(replace(categories, '[', ''), ']', ''), ','), 1, 2))) AS main_cat
            FROM raw_products)
        GROUP BY main_cat ORDER BY cnt DESC, main_cat LIMIT 8""",
    "clean_summary": """
        SELECT count(*) AS total_rows, count(*) FILTER (is_zero_price = 1) AS zero_price_rows,
               count(*) FILTER (event_time IS NULL) AS null_event_time_rows FROM clean""",
    "product_filter_counts": f"""
        SELECT total_rows, kept_rows, {_pct('kept_rows', 'total_rows')} AS kept_pct
        FROM (SELECT count(*) AS total_rows,
                     count(*) FILTER (main_category = 'Furniture') AS kept_rows
              FROM parsed_products)""",
    "price_null_counts": """
        SELECT count(*) FILTER (price IS NULL) AS raw_nulls,
               count(*) FILTER (amount IS NULL) AS clean_nulls FROM parsed_products""",
    "furniture_events": "SELECT * FROM furniture",
    "clean_events": "SELECT * FROM clean",
    "clean_products": "SELECT * FROM clean_products",
    "price_imputed": "SELECT asin, sub_category, price FROM imputed",
    "availability_clean": _counts("clean_products", "availability"),
    "material_counts": _counts("clean_products", "material", 10),
    "dim_products": "SELECT * FROM dim_products",
    "in_stock_counts": _counts("dim_products", "in_stock_flag"),
    "dim_date": "SELECT * FROM dim_date",
    "fact_events": "SELECT * FROM fact",
    **{name: f"SELECT * FROM {name}" for name in _VIEWS},
    "q_funnel": "SELECT * FROM vw_conversion_funnel",
    "q_best_rooms": f"""
        SELECT room_type, CAST(sum(views) AS BIGINT) AS views,
               CAST(sum(purchases) AS BIGINT) AS purchases,
               round(sum(purchases) * 100.0::DOUBLE / nullif(sum(views), 0), 2) AS cvr_pct,
               CAST(round(sum(CAST(total_revenue AS {_MONEY})), 2) AS DOUBLE) AS revenue
        FROM vw_room_performance GROUP BY room_type""",
    "q_price_segments": """
        SELECT price_segment, views, purchases, conversion_rate_pct, total_revenue
        FROM vw_price_segment_analysis""",
    "q_top_brands": """
        SELECT brand, views, purchases, total_revenue, conversion_rate_pct
        FROM vw_brand_performance ORDER BY total_revenue DESC, brand LIMIT 10""",
    "q_peak_hours": f"""
        SELECT event_hour, CAST(sum(views) AS BIGINT) AS views,
               CAST(sum(purchases) AS BIGINT) AS purchases,
               CAST(round(sum(CAST(revenue AS {_MONEY})), 2) AS DOUBLE) AS revenue
        FROM vw_hourly_behavior GROUP BY event_hour ORDER BY purchases DESC, event_hour LIMIT 8""",
    "q_gap_top10": """
        SELECT product_id, brand, room_type, item_type, price_segment, views, cart_adds, purchases
        FROM vw_high_view_no_purchase
        ORDER BY views DESC, product_id, brand, room_type, item_type, price_segment LIMIT 10""",
    "kpi_summary": _KPIS,
    "visits_conversion_funnel": "SELECT * FROM vw_conversion_funnel",
    "visits_daily_trend": "SELECT * FROM vw_daily_trend",
    "visits_kpi_summary": _KPIS,
    "kpi_sheet": f"""
        SELECT CAST(line AS INTEGER) AS line, metric, value FROM (
            SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS line,
                   unnest(['Total Revenue', 'Total Views', 'Total Purchases', 'Total Cart Adds',
                           'Unique Users', 'Conversion Rate', 'Cart Abandonment Rate',
                           'Avg Order Value']) AS metric,
                   unnest([format('${{:,.0f}}', round_even(total_revenue, 0)::DOUBLE),
                           format('{{:,}}', total_views), format('{{:,}}', total_purchases),
                           format('{{:,}}', total_cart_adds), format('{{:,}}', unique_users),
                           CAST(conversion_rate AS VARCHAR) || '%',
                           CAST(cart_abandonment_rate AS VARCHAR) || '%',
                           format('${{:,.2f}}', avg_order_value)]) AS value
            FROM ({_KPIS}))""",
    "report_funnel": """
        SELECT upper(event_type[1]) || event_type[2:] AS stage, event_count
        FROM vw_conversion_funnel""",
    "report_room_top8": """
        SELECT room_type, CAST(sum(CAST(conversion_rate_pct AS DECIMAL(18,2))) AS DOUBLE)
                   / count(conversion_rate_pct) AS conversion_rate_pct
        FROM vw_room_performance WHERE room_type IS NOT NULL
        GROUP BY room_type ORDER BY conversion_rate_pct DESC, room_type LIMIT 8""",
    "report_price_segment": """
        SELECT price_segment, total_revenue, conversion_rate_pct FROM vw_price_segment_analysis""",
    "report_hourly": "SELECT event_hour, day_type, purchases FROM vw_hourly_behavior",
    "report_hourly_peak": """
        SELECT event_hour, day_type, purchases FROM vw_hourly_behavior
        ORDER BY purchases DESC, event_hour, day_type LIMIT 1""",
    "report_daily_revenue": "SELECT event_date, daily_revenue FROM vw_daily_trend",
    "report_gap": "SELECT *, views > 20 AS highlight FROM vw_high_view_no_purchase",
    "funnel_stats": "SELECT * EXCLUDE (vs_industry_pct, chi2_statistic) FROM funnel",
    "funnel_chi2": "SELECT views, purchases, chi2_statistic, vs_industry_pct FROM funnel",
    "funnel_chi2_p": f"""
        SELECT views, purchases, {_even('chi2', 2)} AS chi2_statistic, {_even('p', 6)} AS p_value,
               p < 0.05 AS significant
        FROM (SELECT *, {_chi2_tail('chi2', '1.0::DOUBLE')} AS p FROM funnel_raw)""",
    "anova_segments_p": f"""
        SELECT CAST(k - 1 AS BIGINT) AS df_between, CAST(n - k AS BIGINT) AS df_within,
               {_even('f', 2)} AS f_statistic, {_even('p', 6)} AS p_value, p < 0.05 AS significant
        FROM (SELECT *, {_f_tail('f', '(k - 1)', '(n - k)')} AS p FROM anova)""",
    "kruskal_hours_p": f"""
        SELECT hours, samples, {_even('h', 2)} AS kw_statistic, {_even('p', 6)} AS p_value,
               p < 0.05 AS significant
        FROM (SELECT *, {_chi2_tail('h', '(hours - 1)::DOUBLE')} AS p FROM kruskal)""",
    "room_chi2_p": f"""
        SELECT top_room, top_cvr, {_even('chi2', 2)} AS chi2, {_even('p', 6)} AS p_value,
               p < 0.05 AS significant
        FROM (SELECT *, {_chi2_tail('chi2', '1.0::DOUBLE')} AS p FROM room_raw)""",
    "anova_segments": f"""
        SELECT CAST(k - 1 AS BIGINT) AS df_between, CAST(n - k AS BIGINT) AS df_within,
               {_even('(ssb / (k - 1)) / ((sst - ssb) / (n - k))', 2)} AS f_statistic,
               {_even('ssb / sst', 4)} AS eta_squared,
               CASE WHEN {_even('ssb / sst', 4)} > 0.14 THEN 'large'
                    WHEN {_even('ssb / sst', 4)} > 0.06 THEN 'medium' ELSE 'small' END AS effect
        FROM anova""",
    "segment_descriptive": f"""
        SELECT price_segment, count(*) AS count, {_even('avg(revenue)', 2)} AS mean,
               {_even('quantile_cont(revenue, 0.5)', 2)} AS median,
               {_even('stddev_samp(revenue)', 2)} AS std
        FROM paid GROUP BY price_segment""",
    "segment_cvr": f"SELECT price_segment, purchases, views, {_CVR} AS cvr_pct FROM segments",
    "hourly_behavior": "SELECT * FROM hours",
    "hourly_ci": "SELECT * FROM hour_interval",
    "hourly_peak_trough": "SELECT * FROM hour_extremes",
    "business_hours_share": f"""
        SELECT {_even(_pct('sum(purchases) FILTER (hour BETWEEN 9 AND 18)', 'sum(purchases)'), 1)}
                   AS biz_hours_pct FROM hours""",
    "kruskal_hours": f"""
        SELECT hours, samples, {_even('h', 2)} AS kw_statistic FROM kruskal""",
    "room_ranking": "SELECT * FROM ranked_rooms",
    "room_wilson_ci": "SELECT * FROM wilson",
    "room_chi2": f"SELECT top_room, top_cvr, {_even('chi2', 2)} AS chi2 FROM room_raw",
    "gap_scores": "SELECT * FROM gaps",
    "gap_anomalies": "SELECT * FROM gaps WHERE anomaly",
    "gap_summary": "SELECT * FROM gap_totals",
    "gap_top10": """
        SELECT product_id, views, purchases, cvr_pct, z_score, revenue_lost FROM gaps
        WHERE anomaly ORDER BY views DESC, product_id LIMIT 10""",
    "gap_top15": """
        SELECT product_id, views, z_score, revenue_lost, coalesce(z_score < -1.0, false) AS severe
        FROM gaps WHERE anomaly ORDER BY views DESC, product_id LIMIT 15""",
    "insight_kpi_summary": """
        SELECT 'Overall CVR %' AS metric, overall_cvr_pct AS value FROM funnel
        UNION ALL SELECT 'Drop-off %', drop_off_pct FROM funnel
        UNION ALL SELECT 'vs Industry (2%) %', vs_industry_pct FROM funnel
        UNION ALL SELECT 'Peak Purchase Hour', CAST(peak_hour AS DOUBLE) FROM hour_extremes
        UNION ALL SELECT 'Anomaly Products', CAST(anomaly_count AS DOUBLE) FROM gap_totals
        UNION ALL SELECT 'Est Revenue Lost ($)', total_rev_lost FROM gap_totals""",
    "findings": _FINDINGS,
    "product_metrics": """
        SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue,
                          CAST(order_price AS DOUBLE) AS order_price,
                          CAST(paid_revenue AS DOUBLE) AS paid_revenue) FROM products""",
    "detect_zero_purchase": "SELECT * FROM zero",
    "detect_cvr_anomalies": "SELECT * FROM anomalies",
    "daily_cvr_trend": "SELECT * FROM trend",
    "detect_daily_drops": "SELECT * FROM drops",
    "worst_daily_drop": """
        SELECT cvr_vs_avg AS worst_drop_pct, event_date FROM drops
        ORDER BY cvr_vs_avg, event_date LIMIT 1""",
    "monitor_rooms": "SELECT * FROM room_monitor",
    "monitor_segments": "SELECT * FROM segment_monitor",
    "severity_counts": """
        SELECT alert_type, severity, count(*) AS alerts
        FROM (SELECT alert_type, severity FROM zero
              UNION ALL SELECT alert_type, severity FROM anomalies)
        GROUP BY alert_type, severity""",
    "zero_purchase_top5": """
        SELECT product_id, views, cart_adds, price, room_type, severity FROM zero
        ORDER BY views DESC, product_id LIMIT 5""",
    "cvr_anomaly_top5": """
        SELECT product_id, views, purchases, cvr_pct, z_score, est_revenue_lost, severity
        FROM anomalies ORDER BY est_revenue_lost DESC, product_id LIMIT 5""",
    "detector_summary": f"""
        SELECT 'CVR_ANOMALY' AS detector, count(*) AS analyzed, {_even('avg(cvr_pct)', 4)} AS mean_cvr,
               {_even('stddev_samp(cvr_pct)', 4)} AS std_cvr,
               (SELECT count(*) FROM anomalies) AS flagged,
               (SELECT coalesce(sum(est_revenue_lost), 0) FROM anomalies) AS est_revenue_lost,
               CAST(NULL AS BIGINT) AS undated_events
        FROM cvr_population
        UNION ALL
        SELECT 'ZERO_PURCHASE', NULL, NULL, NULL, count(*), coalesce(sum(est_revenue_lost), 0), NULL
        FROM zero
        UNION ALL
        SELECT 'DAILY_CVR_DROP', count(*), NULL, NULL, count(*) FILTER (cvr_vs_avg < -20), NULL,
               (SELECT count(*) FILTER (event_date IS NULL) FROM fact)
        FROM trend""",
    "alert_log": "SELECT * FROM log",
    "alert_records": """
        SELECT sha256(concat_ws('|', '2024-02-01', alert_type, coalesce(product_id, date, segment))) AS alert_id, *
        FROM log""",
    "late_event_trend": "SELECT * FROM trend",
    "watchlist": """
        SELECT product_id, views, cart_adds, purchases, price, brand, room_type, price_segment,
               est_revenue_lost, severity, alert_type, run_date,
               CAST(NULL AS DOUBLE) AS cvr_pct, CAST(NULL AS DOUBLE) AS z_score
        FROM zero
        UNION ALL BY NAME
        SELECT product_id, views, cart_adds, purchases, cvr_pct, z_score, est_revenue_lost,
               severity, alert_type, run_date
        FROM anomalies""",
    "alert_summary": """
        SELECT count(*) AS total_alerts, count(*) FILTER (severity = 'CRITICAL') AS critical,
               count(*) FILTER (severity = 'HIGH') AS high,
               count(*) FILTER (severity = 'MEDIUM') AS medium,
               count(*) FILTER (alert_type = 'ZERO_PURCHASE') AS zero_purchase,
               count(*) FILTER (alert_type = 'CVR_ANOMALY') AS cvr_anomalies,
               count(*) FILTER (alert_type = 'DAILY_CVR_DROP') AS daily_drops,
               count(*) FILTER (alert_type = 'ROOM_UNDERPERFORM') AS room_alerts,
               count(*) FILTER (alert_type = 'SEGMENT_UNDERPERFORM') AS segment_alerts,
               coalesce(sum(est_rev_lost), 0) AS revenue_at_risk
        FROM log""",
    "zero_purchase_top10": "SELECT product_id, views FROM zero ORDER BY views DESC, product_id LIMIT 10",
    "z_histogram": """
        WITH ends AS (SELECT min(z_score) AS a, max(z_score) AS b FROM anomalies),
        span AS (
            SELECT low, high, (high - low) / 20.0::DOUBLE AS width
            FROM (SELECT CASE WHEN a = b THEN a - 0.5 ELSE a END AS low,
                         CASE WHEN a = b THEN b + 0.5 ELSE b END AS high FROM ends)),
        placed AS (
            SELECT least(len(list_filter(range(20), lambda i: low + i * width <= z_score)) - 1, 19)
                       AS bin
            FROM anomalies, span)
        SELECT CAST(r.bin AS INTEGER) AS bin, low + r.bin * width AS bin_from,
               CASE WHEN r.bin = 19 THEN high ELSE low + (r.bin + 1) * width END AS bin_to,
               (SELECT count(*) FROM placed p WHERE p.bin = r.bin) AS row_count
        FROM span, (SELECT unnest(range(20)) AS bin) r WHERE low IS NOT NULL""",
    "daily_cvr_chart": """
        SELECT event_date, cvr_pct, rolling_avg, coalesce(cvr_vs_avg < -20, false) AS alert
        FROM trend""",
    "funnel_chart": """
        SELECT 'Views' AS stage, views AS events FROM funnel
        UNION ALL SELECT 'Carts', carts FROM funnel
        UNION ALL SELECT 'Purchases', purchases FROM funnel""",
    "cvr_vs_benchmark": """
        SELECT 'Overall CVR' AS label, overall_cvr_pct AS cvr_pct FROM funnel
        UNION ALL SELECT 'Industry Benchmark', 2.0::DOUBLE""",
    "hourly_with_ci": """
        SELECT hour, purchases, ci_95_low, ci_95_high,
               coalesce(hour = (SELECT peak_hour FROM hour_extremes), false) AS is_peak
        FROM hours, hour_interval""",
    "segment_cvr_chart": f"SELECT price_segment, {_CVR} AS cvr_pct FROM segments",
    "room_ci_error_bars": f"""
        SELECT room_type, cvr_pct, {_even('cvr_pct - ci_low', 4)} AS err_low,
               {_even('ci_high - cvr_pct', 4)} AS err_high FROM wilson""",
}


def _needed(sql: str) -> list[str]:
    """Named tables that ``sql`` uses, in the order they must be defined."""
    used: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"(?:FROM|JOIN|,)\s+\(?(\w+)", pending.pop()))
        for name in words & _NAMED.keys() - used:
            used.add(name)
            pending.append(_NAMED[name])
    return [name for name in _NAMED if name in used]


def _full(body: str) -> str:
    body = body.strip()
    names = _needed(body)
    parts = [f"{name} AS ({_NAMED[name].strip()})" for name in names]
    if body.startswith("WITH "):
        parts.append(body[len("WITH "):])
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def oracle_sql() -> dict[str, str]:
    return {name: _full(body) for name, body in _BODIES.items()}
