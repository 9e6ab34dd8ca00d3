"""Anomaly detectors over product, daily, room and price-band measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roomlens.functions.numbers import half_even, ratio_pct
from roomlens.functions.segments import severity
from roomlens.functions.text import literal
from roomlens.operators.metrics import aggregates
from roomlens.operators.statistics import CVR, Z_SCORE, cvr_moments
from roomlens.thresholds import DEFAULTS, Thresholds

PRODUCT_COLUMNS = (
    "product_id", "views", "cart_adds", "purchases", "price", "brand", "room_type", "price_segment",
)


def _mean_of(df: DataFrame, total: str, count: str) -> Column:
    """Sum of ``total`` over sum of ``count`` as a one-row subquery value."""
    return df.agg(F.expr(f"try_divide(DOUBLE(sum({total})), DOUBLE(sum({count})))")).scalar()


def _stamp(alert_type: str, run_date: str) -> tuple[str, str]:
    return f"'{alert_type}' AS alert_type", f"{literal(run_date)} AS run_date"


def zero_purchase(products: DataFrame, run_date: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Much viewed products without a purchase, with the revenue a usual rate would bring.

    The price used is the mean price of all purchases, zero prices included. ``products`` should
    be a stored table: it is read for that mean and for the alerts.
    """
    tier = severity(
        "views", ">=", limits.zero_purchase_critical_views, limits.zero_purchase_high_views
    )
    return (
        products.where(f"purchases = 0 AND views >= {limits.zero_purchase_min_views}")
        .withColumn("usual_price", _mean_of(products, "order_price", "purchases"))
        .selectExpr(
            *PRODUCT_COLUMNS,
            f"{half_even(f'views * {limits.lost_sale_rate}D * usual_price', 0)} AS est_revenue_lost",
            f"{tier} AS severity",
            *_stamp("ZERO_PURCHASE", run_date),
        )
        .orderBy(F.desc("views"), "product_id")
    )


def cvr_population(products: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Products with enough views and at least one purchase, with their conversion."""
    return products.where(
        f"views >= {limits.min_views_for_analysis} AND purchases > 0"
    ).selectExpr(*PRODUCT_COLUMNS, f"{CVR} AS cvr_pct")


def cvr_anomalies(products: DataFrame, run_date: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Products whose conversion lies far below the mean of their peers.

    A deviation of zero or a single product gives no score, hence no alert. ``products`` should
    be a stored table: it is read for the moments, the order value and the alerts.
    """
    population = cvr_population(products, limits)
    tier = severity("z_score", "<", limits.cvr_z_critical, limits.cvr_z_high)
    return (
        population.withColumns(
            {
                "m": cvr_moments(population),
                "order_value": _mean_of(products, "paid_revenue", "paid_orders"),
            }
        )
        .selectExpr(
            "*", f"{Z_SCORE} AS z_score",
            f"{half_even('views * m.mean / 100D', 0)} AS expected_purchases",
        )
        .where(f"z_score < {limits.cvr_z_alert}")
        .selectExpr("*", f"{half_even('expected_purchases - purchases', 0)} AS purchase_gap")
        .selectExpr(
            *PRODUCT_COLUMNS, "cvr_pct", "z_score", "expected_purchases", "purchase_gap",
            f"{half_even('purchase_gap * order_value', 0)} AS est_revenue_lost",
            f"{tier} AS severity",
            f"{half_even('m.mean', 4)} AS mean_cvr_pct",
            *_stamp("CVR_ANOMALY", run_date),
        )
    )


def daily_trend(days: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Conversion and revenue of each day against their rolling means.

    The mean covers the last seven rows present, today included, and needs three values. Events
    without a date are in no day; the summary counts them. Sums are decimal, so the result does not depend on the order of addition.
    """
    # One row per date.
    recent = f"(ORDER BY event_date ROWS {limits.rolling_days - 1} PRECEDING)"

    def rolling(value: str) -> str:
        mean = f"DOUBLE(sum({value}) OVER {recent}) / count({value}) OVER {recent}"
        return f"if(count({value}) OVER {recent} >= {limits.rolling_min_days}, {mean}, NULL)"

    def against(value: str, mean: str) -> str:
        return half_even(f"try_divide({value} - {mean}, {mean}) * 100D", 2)

    return (
        days.where("event_date IS NOT NULL").selectExpr("event_date", "views", "purchases", "revenue", f"{CVR} AS cvr_pct")
        .selectExpr(
            "event_date", "views", "purchases", "DOUBLE(revenue) AS revenue", "cvr_pct",
            f"{rolling('CAST(cvr_pct AS decimal(18,4))')} AS rolling_avg",
            f"{rolling('revenue')} AS rev_rolling",
        )
        .selectExpr(
            "event_date", "views", "purchases", "revenue", "cvr_pct", "rolling_avg",
            f"{against('cvr_pct', 'rolling_avg')} AS cvr_vs_avg",
            "rev_rolling",
            f"{against('revenue', 'rev_rolling')} AS rev_vs_avg",
        )
        .orderBy("event_date")
    )


def _is_drop(limits: Thresholds) -> str:
    return f"coalesce(cvr_vs_avg < {-limits.cvr_drop_pct}, false)"


def daily_drops(trend: DataFrame, run_date: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    tier = severity("cvr_vs_avg", "<", limits.drop_critical_pct, limits.drop_high_pct)
    return trend.where(_is_drop(limits)).selectExpr(
        "*", f"{tier} AS severity", *_stamp("DAILY_CVR_DROP", run_date)
    )


def daily_chart(trend: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Daily series with a mark on alert days."""
    return trend.selectExpr("event_date", "cvr_pct", "rolling_avg", f"{_is_drop(limits)} AS alert")


def worst_drop(drops: DataFrame) -> DataFrame:
    """Largest drop and its date, the first one on ties; no row when nothing dropped."""
    return drops.agg(
        F.expr("min(cvr_vs_avg) AS worst_drop_pct"),
        F.expr("min_by(event_date, struct(cvr_vs_avg, event_date)) AS event_date"),
    ).where("event_date IS NOT NULL")


def monitor(
    groups: DataFrame, key: str, run_date: str, limits: Thresholds = DEFAULTS
) -> DataFrame:
    """Conversion of each group against the pooled conversion of all, with an alert flag.

    ``groups`` holds one row of measures per ``key``, a room or price band: a few rows, so the
    pool is a window over them and the events are read once.
    """
    pool = ratio_pct("sum(purchases) OVER ()", "sum(views) OVER ()")
    return (
        groups.selectExpr(
            key, "views", "purchases", "DOUBLE(revenue) AS revenue", f"{CVR} AS cvr_pct",
            f"{pool} AS pool",
        )
        .selectExpr(
            "* EXCEPT (pool)",
            f"{half_even('try_divide(cvr_pct - pool, pool) * 100D', 2)} AS vs_avg_pct",
        )
        .selectExpr(
            "*",
            f"coalesce(vs_avg_pct < {limits.underperform_pct}, false) AS alert",
            f"{literal(run_date)} AS run_date",
        )
        .orderBy("vs_avg_pct", key)
    )


def top_zero_purchase(zero: DataFrame, top: int = 5) -> DataFrame:
    columns = ("product_id", "views", "cart_adds", "price", "room_type", "severity")
    return zero.orderBy(F.desc("views"), "product_id").select(*columns).limit(top)


def top_cvr_anomalies(anomalies: DataFrame, top: int = 5) -> DataFrame:
    columns = (
        "product_id", "views", "purchases", "cvr_pct", "z_score", "est_revenue_lost", "severity",
    )
    return anomalies.orderBy(F.desc("est_revenue_lost"), "product_id").select(*columns).limit(top)


def severity_counts(*alerts: DataFrame) -> DataFrame:
    """Alerts per detector and severity."""
    whole = alerts[0].select("alert_type", "severity")
    for frame in alerts[1:]:
        whole = whole.unionByName(frame.select("alert_type", "severity"))
    return whole.groupBy("alert_type", "severity").agg(F.expr("count(*) AS alerts"))


def detector_summary(
    products: DataFrame,
    zero: DataFrame,
    anomalies: DataFrame,
    trend: DataFrame,
    days: DataFrame,
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """One row per detector: what it analysed, what it flagged, what that may cost, and the events
    that belong to no day of the daily measures ``days``."""
    flagged = "count(*) AS flagged"
    cost = "coalesce(sum(est_revenue_lost), 0D) AS est_revenue_lost"
    population = cvr_population(products, limits).agg(
        *aggregates(
            {
                "analyzed": "count(*)",
                "mean_cvr": half_even("avg(cvr_pct)", 4),
                "std_cvr": half_even("stddev_samp(cvr_pct)", 4),
            }
        )
    )
    low = anomalies.agg(F.expr(f"struct({flagged}, {cost})")).scalar()
    cvr = population.withColumn("low", low).selectExpr(
        "'CVR_ANOMALY' AS detector", "* EXCEPT (low)", "low.*"
    )
    zeros = zero.agg(F.expr(flagged), F.expr(cost)).selectExpr("'ZERO_PURCHASE' AS detector", "*")
    undated = days.agg(F.expr("coalesce(sum(if(event_date IS NULL, events, 0L)), 0L)")).scalar()
    daily = (
        trend.agg(
            F.expr("count(*) AS analyzed"), F.expr(f"count(if({_is_drop(limits)}, 1, NULL)) AS flagged")
        )
        .withColumn("undated_events", undated)
        .selectExpr("'DAILY_CVR_DROP' AS detector", "*")
    )
    return cvr.unionByName(zeros, allowMissingColumns=True).unionByName(
        daily, allowMissingColumns=True
    )
