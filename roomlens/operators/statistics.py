"""Statistical analyses: tests, intervals and gap scores.

Statistics are Spark expressions over small aggregates. A p-value is one more column, added by a
function of its own, since it needs a Python worker for its single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roomlens.functions.numbers import half_even, ratio_pct
from roomlens.functions.tails import chi2_p, f_p, t_quantiles
from roomlens.operators.metrics import aggregates, roll_up
from roomlens.operators.quantiles import frequencies, moments, quantiles
from roomlens.operators.report import metric_rows
from roomlens.thresholds import DEFAULTS, Thresholds

# Fixed value: normal quantile of the Wilson interval.
WILSON_Z = 1.96
# Hours of a day, and one group for events without a time.
MOST_HOURS = 25

CVR = half_even(ratio_pct("purchases", "views"), 4)


def goodness_of_fit(hits: str, trials: str, rate: str) -> str:
    """Chi-square of (hits, misses) against a given hit rate; one degree of freedom."""
    expected = f"(DOUBLE({trials}) * {rate})"
    missed, expected_missed = f"({trials} - {hits})", f"({trials} - {expected})"
    return (
        f"(try_divide(pow({hits} - {expected}, 2), {expected})"
        f" + try_divide(pow({missed} - {expected_missed}, 2), {expected_missed}))"
    )


def with_p_value(df: DataFrame, statistic: str, p: Column, significance: float) -> DataFrame:
    """Add the p-value and its verdict, and round the statistic for display."""
    shown = [
        f"{half_even(name, 2)} AS {name}" if name == statistic else name for name in df.columns
    ]
    return df.withColumn("p", F.nanvl(p, F.lit(None).cast("double"))).selectExpr(
        *shown,
        f"{half_even('p', 6)} AS p_value",
        f"coalesce(p < {significance}, false) AS significant",
    )


# Funnel


def funnel_stats(totals: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Stage totals, drop-off rates and the chi-square of the purchases against the benchmark
    rate; ``totals`` is one row of measures."""
    cvr = ratio_pct("purchases", "views")
    chi2 = goodness_of_fit("purchases", "views", f"{limits.benchmark_rate}D")
    rates = {
        "view_to_cart_pct": half_even(ratio_pct("carts", "views"), 2),
        "cart_to_purchase_pct": half_even(ratio_pct("purchases", "carts"), 2),
        "overall_cvr_pct": half_even(cvr, 4),
        "drop_off_pct": half_even(ratio_pct("views - purchases", "views"), 2),
        "vs_industry_pct": half_even(f"{cvr} - {limits.benchmark_rate * 100}D", 2),
        "chi2_statistic": half_even(chi2, 2),
    }
    return totals.selectExpr(
        "coalesce(views, 0L) AS views",
        "coalesce(cart_adds, 0L) AS carts",
        "coalesce(purchases, 0L) AS purchases",
    ).selectExpr("*", *[f"{sql} AS {name}" for name, sql in rates.items()])


def funnel_p(totals: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    chi2 = goodness_of_fit("purchases", "views", f"{limits.benchmark_rate}D")
    base = totals.selectExpr("views", "purchases", f"{chi2} AS chi2_statistic")
    p = chi2_p("chi2_statistic", F.lit(1.0))
    return with_p_value(base, "chi2_statistic", p, limits.significance)


# Price segments


def paid_orders(fact: DataFrame) -> DataFrame:
    """Paid orders as (price_segment, value, n): how often each amount occurs in each band."""
    return frequencies(
        fact.where("event_type = 'purchase' AND revenue > 0"), "revenue", ["price_segment"]
    )


def _variance_parts(orders: DataFrame) -> DataFrame:
    """One row: groups, rows and the between, within and total sums of squares.

    Deviations are taken around the means in a second pass over the stored amounts.
    """
    means = orders.groupBy("price_segment").agg(
        F.expr("sum(n * value) / sum(n) AS mean")
    ).withColumnRenamed("price_segment", "band")
    groups = (
        orders.join(means, F.col("price_segment").eqNullSafe(F.col("band")))
        .groupBy("price_segment")
        .agg(
            F.expr("DOUBLE(sum(n)) AS n"),
            F.expr("first(mean) AS mean"),
            F.expr("sum(n * pow(value - mean, 2)) AS inside"),
        )
    )
    # Price bands are a handful of rows, so both windows are small. Orders without a band count
    # towards the grand mean and the total, but are no group of the test.
    spread = groups.selectExpr(
        "*",
        "price_segment IS NOT NULL AS named",
        "n * pow(mean - sum(n * mean) OVER () / sum(n) OVER (), 2) AS to_grand",
        """n * pow(mean - sum(n * mean) OVER (PARTITION BY price_segment IS NOT NULL)
                   / sum(n) OVER (PARTITION BY price_segment IS NOT NULL), 2) AS to_pooled""",
    )
    return spread.agg(
        *aggregates(
            {
                "k": "count(if(named, 1, NULL))",
                "n": "sum(if(named, n, NULL))",
                "between_groups": "sum(if(named, to_pooled, NULL))",
                "within_groups": "sum(if(named, inside, NULL))",
                "explained": "sum(if(named, to_grand, NULL))",
                "total": "sum(inside) + sum(to_grand)",
            }
        )
    ).selectExpr(
        "k - 1 AS df_between",
        "BIGINT(n - k) AS df_within",
        "try_divide(try_divide(between_groups, k - 1), try_divide(within_groups, n - k)) AS f",
        f"{half_even('if(total > 0, explained / total, 0D)', 4)} AS eta_squared",
    )


def segment_anova(orders: DataFrame, with_raw: bool = False) -> DataFrame:
    """One-way analysis of variance of order revenue over price segments, with effect size.

    ``orders`` are stored amounts and how often they occur; ``with_raw`` adds the statistic as it is.
    """
    return _variance_parts(orders).selectExpr(
        *["f"] * with_raw, "df_between", "df_within",
        f"{half_even('f', 2)} AS f_statistic",
        "eta_squared",
        """CASE WHEN eta_squared > 0.14 THEN 'large' WHEN eta_squared > 0.06 THEN 'medium'
                ELSE 'small' END AS effect""",
    )


def segment_anova_p(orders: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    base = _variance_parts(orders).selectExpr("df_between", "df_within", "f AS f_statistic")
    p = f_p("f_statistic", F.expr("DOUBLE(df_between)"), F.expr("DOUBLE(df_within)"))
    return with_p_value(base, "f_statistic", p, limits.significance)


def segment_descriptive(orders: DataFrame) -> DataFrame:
    """Count, mean, exact median and sample deviation of order revenue per segment, from stored
    amounts."""
    keys = ["price_segment"]
    frequency = orders.where("price_segment IS NOT NULL")
    medians = quantiles(frequency, {"median": 0.5}, keys)
    return moments(frequency, keys).join(medians, keys).selectExpr(
        *keys, "count",
        *[f"{half_even(name, 2)} AS {name}" for name in ("mean", "median", "std")],
    )


def group_cvr(groups: DataFrame, key: str) -> DataFrame:
    """Purchases, views and conversion per group; ``groups`` holds one row per ``key``."""
    return groups.selectExpr(key, "purchases", "views", f"{CVR} AS cvr_pct")


# Hours


def hourly_counts(cells: DataFrame) -> DataFrame:
    """Purchases, views and conversion per hour, from (date, hour) cells."""
    hours = roll_up(cells, "event_hour").withColumnRenamed("event_hour", "hour")
    return group_cvr(hours, "hour").orderBy("hour")


def hourly_interval(hours: DataFrame) -> DataFrame:
    """Mean purchases per hour with its 95 % t-interval."""
    stats = hours.agg(
        *aggregates(
            {"hours": "count(*)", "mean": "avg(purchases)", "sd": "stddev_samp(purchases)"}
        )
    )
    # At most a few dozen hours: the quantiles are a literal array, no Python worker is needed.
    quantile = ", ".join(f"{q!r}D" for q in t_quantiles(0.975, MOST_HOURS - 1))
    margin = f"get(array({quantile}), INT(hours) - 2) * sd / sqrt(hours)"
    return stats.selectExpr(
        "hours",
        f"{half_even('mean', 1)} AS mean_per_hour",
        f"{half_even(f'mean - {margin}', 1)} AS ci_95_low",
        f"{half_even(f'mean + {margin}', 1)} AS ci_95_high",
    )


def hourly_extremes(hours: DataFrame) -> DataFrame:
    """Peak and trough hour; the earliest hour wins a tie. Events without a time are in no hour."""
    return hours.where("hour IS NOT NULL").agg(
        *aggregates(
            {
                "peak_hour": "max_by(hour, struct(purchases, -hour))",
                "peak_count": "max(purchases)",
                "trough_hour": "min_by(hour, struct(purchases, hour))",
                "trough_count": "min(purchases)",
            }
        )
    )


def business_hours(hours: DataFrame, first: int = 9, last: int = 18) -> DataFrame:
    """Share of purchases made between the two hours, both included."""
    inside = f"sum(if(hour BETWEEN {first} AND {last}, purchases, 0))"
    share = half_even(ratio_pct(inside, "sum(purchases)"), 1)
    return hours.agg(F.expr(f"{share} AS biz_hours_pct"))


def hourly_rank_test(cells: DataFrame) -> DataFrame:
    """Kruskal-Wallis H of purchases per (date, hour) cell across hours, corrected for ties.

    Cells without a purchase are no samples. Ranks come from the frequencies of the distinct
    counts, so the windows run over at most one row per hour and distinct count.
    """
    frequency = (
        cells.where("purchases > 0 AND event_hour IS NOT NULL")
        .groupBy("event_hour", "purchases")
        .agg(F.expr("count(*) AS n"))
    )
    ranked = frequency.selectExpr(
        "*",
        "DOUBLE(sum(n) OVER (PARTITION BY purchases)) AS tied",
        "sum(n) OVER (ORDER BY purchases RANGE UNBOUNDED PRECEDING) AS upto",
    )
    # n rows of a tie of t members carry n * (t^2 - 1) of its t^3 - t.
    hours = ranked.groupBy("event_hour").agg(
        *aggregates(
            {
                "rank_sum": "sum(n * (upto - (tied - 1) / 2))",
                "size": "DOUBLE(sum(n))",
                "ties": "sum(n * (tied * tied - 1))",
            }
        )
    )
    sums = hours.agg(
        *aggregates(
            {
                "hours": "count(*)",
                "n": "sum(size)",
                "squares": "sum(rank_sum * rank_sum / size)",
                "ties": "sum(ties)",
            }
        )
    )
    raw = "try_divide(squares * 12D, n * (n + 1)) - (n + 1) * 3D"
    correction = "1D - try_divide(ties, n * n * n - n)"
    return sums.selectExpr(
        "hours", "BIGINT(n) AS samples", f"try_divide({raw}, {correction}) AS kw_statistic"
    )


def hourly_rank_summary(test: DataFrame) -> DataFrame:
    return test.selectExpr("hours", "samples", f"{half_even('kw_statistic', 2)} AS kw_statistic")


def hourly_rank_p(test: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    p = chi2_p("kw_statistic", F.expr("DOUBLE(hours - 1)"))
    return with_p_value(test, "kw_statistic", p, limits.significance)


def hourly_results(hours: DataFrame, rank_test: DataFrame) -> DataFrame:
    """Extremes, interval, business share and rank statistic of the hours in one row; the statistic
    also as it is, with its degrees of freedom."""
    interval = hourly_interval(hours).select(F.struct("mean_per_hour", "ci_95_low", "ci_95_high"))
    return (
        hourly_extremes(hours)
        .withColumns(
            {
                "interval": interval.scalar(),
                "biz_hours_pct": business_hours(hours).scalar(),
                "test": rank_test.select(F.struct("kw_statistic", "hours")).scalar(),
            }
        )
        .selectExpr(
            "* EXCEPT (interval, test)", "interval.*", f"{half_even('test.kw_statistic', 2)} AS kw_statistic",
            "test.kw_statistic AS kw_raw", "test.hours - 1 AS kw_df",
        )
    )


# Rooms


def room_ranking(rooms: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Rooms with enough views, best conversion first; ``rooms`` holds one row per room."""
    seen = rooms.where(f"views > {limits.room_min_views}")
    best = F.desc(F.expr("try_divide(DOUBLE(purchases), DOUBLE(views))"))
    return group_cvr(seen, "room_type").orderBy(best, "room_type")


def wilson_interval(ranked: DataFrame, z: float = WILSON_Z) -> DataFrame:
    """Add the Wilson score interval of the conversion, in percent."""
    z2 = f"{z**2!r}D"
    return (
        ranked.selectExpr("*", "DOUBLE(views) AS n", "purchases / DOUBLE(views) AS p")
        .selectExpr(
            "*",
            f"(p + {z2} / (n * 2D)) / (1D + {z2} / n) AS centre",
            f"""{z}D * sqrt(p * (1D - p) / n + {z2} / (n * n * 4D)) / (1D + {z2} / n)
                AS margin""",
        )
        .selectExpr(
            *ranked.columns,
            f"{half_even('(centre - margin) * 100D', 4)} AS ci_low",
            f"{half_even('(centre + margin) * 100D', 4)} AS ci_high",
        )
    )


def _top_room(ranked: DataFrame) -> DataFrame:
    ratio = "try_divide(DOUBLE(purchases), DOUBLE(views))"
    totals = ranked.agg(
        *aggregates(
            {
                "top": f"""min_by(struct(room_type, purchases, views, cvr_pct),
                                  struct(-{ratio}, room_type))""",
                "all_purchases": "sum(purchases)",
                "all_views": "sum(views)",
            }
        )
    )
    rest = "try_divide(DOUBLE(all_purchases - top.purchases), DOUBLE(all_views - top.views))"
    return totals.selectExpr(
        "top.room_type AS top_room",
        "top.cvr_pct AS top_cvr",
        f"{goodness_of_fit('top.purchases', 'top.views', rest)} AS chi2",
    )


def room_test(ranked: DataFrame, with_raw: bool = False) -> DataFrame:
    """Chi-square of the best room against the pooled rate of all others; ``with_raw`` adds it as it
    is."""
    return _top_room(ranked).selectExpr(
        "top_room", "top_cvr", f"{half_even('chi2', 2)} AS chi2", *["chi2 AS raw"] * with_raw
    )


def room_test_p(ranked: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    p = chi2_p("chi2", F.lit(1.0))
    return with_p_value(_top_room(ranked), "chi2", p, limits.significance)


# Product gaps


def cvr_moments(scored: DataFrame) -> Column:
    """Mean and deviation of ``cvr_pct`` over all rows, as a one-row subquery value."""
    moments = F.expr("struct(avg(cvr_pct) AS mean, stddev_samp(cvr_pct) AS sd)")
    return scored.agg(moments).scalar()


Z_SCORE = half_even("try_divide(cvr_pct - m.mean, m.sd)", 3)


def gap_scores(products: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Conversion z-score, anomaly flag and lost revenue of every product seen often enough.

    ``products`` should be a stored table: it is read for the moments and for the scores.
    """
    population = products.where(f"views >= {limits.gap_min_views}").selectExpr(
        "product_id", "views", "purchases", "DOUBLE(revenue) AS revenue", f"{CVR} AS cvr_pct"
    )
    missed = f"(m.mean / 100D * views - purchases) * {limits.gap_order_value}D"
    return (
        population.withColumn("m", cvr_moments(population))
        .selectExpr("*", f"{Z_SCORE} AS z_score")
        .selectExpr(
            *population.columns, "z_score",
            f"coalesce(z_score < {limits.gap_z}, false) OR purchases = 0 AS anomaly",
            f"{half_even(f'greatest(0D, {missed})', 0)} AS revenue_lost",
        )
    )


def gap_anomalies(scores: DataFrame) -> DataFrame:
    return scores.where("anomaly").orderBy(F.desc("views"), "product_id")


def gap_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(
        *aggregates(
            {
                "total_products": "count(*)",
                "anomaly_count": "count(if(anomaly, 1, NULL))",
                "mean_cvr": half_even("avg(cvr_pct)", 4),
                "std_cvr": half_even("stddev_samp(cvr_pct)", 4),
                "total_rev_lost": "coalesce(sum(if(anomaly, revenue_lost, NULL)), 0D)",
            }
        )
    )


def gap_listing(scores: DataFrame, top: int = 10) -> DataFrame:
    return (
        gap_anomalies(scores)
        .select("product_id", "views", "purchases", "cvr_pct", "z_score", "revenue_lost")
        .limit(top)
    )


def gap_chart(scores: DataFrame, top: int = 15, limits: Thresholds = DEFAULTS) -> DataFrame:
    """The most viewed anomalies, ordered by lost revenue, the severe ones marked."""
    return (
        gap_anomalies(scores)
        .limit(top)
        .selectExpr(
            "product_id", "views", "z_score", "revenue_lost",
            f"coalesce(z_score < {limits.gap_severe_z}, false) AS severe",
        )
        .orderBy(F.desc("revenue_lost"), "product_id")
    )


# Summary


def insight_summary(funnel: DataFrame, extremes: DataFrame, gaps: DataFrame) -> DataFrame:
    """Six (metric, value) lines over the funnel, the hours and the gaps."""
    one_row = funnel.withColumns(
        {
            "peak": extremes.select("peak_hour").scalar(),
            "gap": gaps.select(F.struct("anomaly_count", "total_rev_lost")).scalar(),
        }
    )
    # Names of the lines.
    return metric_rows(
        one_row,
        {
            "Overall CVR %": "overall_cvr_pct",
            "Drop-off %": "drop_off_pct",
            "vs Industry (2%) %": "vs_industry_pct",
            "Peak Purchase Hour": "DOUBLE(peak)",
            "Anomaly Products": "DOUBLE(gap.anomaly_count)",
            "Est Revenue Lost ($)": "gap.total_rev_lost",
        },
    ).select("metric", "value")
