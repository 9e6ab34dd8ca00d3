"""Alert log, watchlist, summaries and the datasets behind the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.numbers import half_even
from roomlens.functions.tails import tail_p
from roomlens.functions.text import literal
from roomlens.operators.metrics import aggregates
from roomlens.operators.report import metric_rows
from roomlens.operators.statistics import goodness_of_fit


def _fixed(value: str, digits: int) -> str:
    """Number with a fixed count of decimals, rounded half to even beforehand."""
    return f"format_string('%.{digits}f', {half_even(value, digits)})"


def alert_log(
    zero: DataFrame,
    anomalies: DataFrame,
    drops: DataFrame,
    rooms: DataFrame,
    segments: DataFrame,
    run_ts: str,
) -> DataFrame:
    """All alerts of a run as sparse records: five shapes united by column name."""
    # Alert types and the wording of the messages.
    parts = [
        zero.selectExpr(
            "alert_type", "severity", "STRING(product_id) AS product_id", "views",
            "0L AS purchases", "est_revenue_lost AS est_rev_lost",
            "coalesce(room_type, 'None') AS room_type",
            """concat('Product ', product_id, ' has ', views, ' views and 0 purchases')
               AS message""",
        ),
        anomalies.selectExpr(
            "alert_type", "severity", "STRING(product_id) AS product_id", "cvr_pct", "z_score",
            "est_revenue_lost AS est_rev_lost",
            f"""concat('Product ', product_id, ' CVR ', {_fixed('cvr_pct', 4)}, '% is ',
                       {_fixed('z_score', 2)}, ' std devs below mean') AS message""",
        ),
        drops.selectExpr(
            "alert_type", "severity", "STRING(event_date) AS date", "cvr_pct",
            "cvr_vs_avg AS vs_avg_pct",
            f"""concat('CVR dropped ', {_fixed('cvr_vs_avg', 1)},
                       '% vs 7-day rolling avg on ', event_date) AS message""",
        ),
        _monitor_alerts(rooms, "room_type", "ROOM_UNDERPERFORM", "Room"),
        _monitor_alerts(segments, "price_segment", "SEGMENT_UNDERPERFORM", "Segment"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.selectExpr(f"{literal(run_ts)} AS timestamp", "*")


def alert_records(log: DataFrame, run_date: str) -> DataFrame:
    """The log's rows with an id that a rerun gives again: the digest of run date, type and subject.

    An alert is about a product, a date, a room or a price band; a run has one of a type for each.
    """
    subject = "coalesce(product_id, date, segment)"
    return log.selectExpr(f"sha2(concat_ws('|', {literal(run_date)}, alert_type, {subject}), 256) AS alert_id", "*")


def _monitor_alerts(groups: DataFrame, key: str, alert_type: str, label: str) -> DataFrame:
    return groups.where("alert").selectExpr(
        f"'{alert_type}' AS alert_type",
        "'MEDIUM' AS severity",
        f"coalesce({key}, 'None') AS segment",
        "cvr_pct",
        "vs_avg_pct",
        rf"""concat('{label} \'', coalesce({key}, 'None'), '\' CVR is ',
                    {_fixed('vs_avg_pct', 1)}, '% below overall avg') AS message""",
    )


def watchlist(zero: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Products to look at: both product detectors, most severe and costly first.

    Conversion alerts carry no price, brand, room or band; zero-purchase alerts carry no score.
    """
    counts = ("product_id", "views", "cart_adds", "purchases")
    alert = ("est_revenue_lost", "severity", "alert_type", "run_date")
    rows = zero.select(*counts, "price", "brand", "room_type", "price_segment", *alert)
    scored = anomalies.select(*counts, "cvr_pct", "z_score", *alert)
    return rows.unionByName(scored, allowMissingColumns=True).orderBy(
        "severity", F.desc("est_revenue_lost"), "product_id"
    )


def alert_summary(log: DataFrame) -> DataFrame:
    """Alerts in total, per severity and per detector, and the revenue at risk."""

    def of(column: str, value: str) -> str:
        return f"count(if({column} = '{value}', 1, NULL))"

    return log.agg(
        *aggregates(
            {
                "total_alerts": "count(*)",
                "critical": of("severity", "CRITICAL"),
                "high": of("severity", "HIGH"),
                "medium": of("severity", "MEDIUM"),
                "zero_purchase": of("alert_type", "ZERO_PURCHASE"),
                "cvr_anomalies": of("alert_type", "CVR_ANOMALY"),
                "daily_drops": of("alert_type", "DAILY_CVR_DROP"),
                "room_alerts": of("alert_type", "ROOM_UNDERPERFORM"),
                "segment_alerts": of("alert_type", "SEGMENT_UNDERPERFORM"),
                "revenue_at_risk": "coalesce(sum(est_rev_lost), 0D)",
            }
        )
    )


# Dashboard datasets


def zero_purchase_chart(zero: DataFrame, top: int = 10) -> DataFrame:
    return zero.orderBy(F.desc("views"), "product_id").select("product_id", "views").limit(top)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins are listed.

    A single value gets a range of half a unit to each side. A value belongs to the bin whose
    printed edges hold it, so the quotient is corrected by one where rounding says otherwise.
    """
    values = df.selectExpr(f"DOUBLE({column}) AS value").where("value IS NOT NULL")
    span = (
        values.agg(F.expr("min(value) AS a"), F.expr("max(value) AS b"))
        .selectExpr("if(a = b, a - 0.5D, a) AS low", "if(a = b, b + 0.5D, b) AS high")
        .selectExpr("low", "high", f"(high - low) / {bins}D AS width")
    )
    counts = (
        values.withColumn("s", span.select(F.struct("low", "high", "width")).scalar())
        .selectExpr("value", "s", "INT(floor((value - s.low) / s.width)) AS guess")
        .selectExpr(
            f"""least({bins - 1},
                      CASE WHEN value < s.low + guess * s.width THEN guess - 1
                           WHEN value >= s.low + (guess + 1) * s.width THEN guess + 1
                           ELSE guess END) AS bin"""
        )
        .groupBy("bin")
        .agg(F.expr("count(*) AS row_count"))
    )
    every = span.where("low IS NOT NULL").selectExpr("*", f"explode(sequence(0, {bins - 1})) AS bin")
    return every.join(counts, "bin", "left").selectExpr(
        "bin",
        "low + bin * width AS bin_from",
        f"if(bin = {bins - 1}, high, low + (bin + 1) * width) AS bin_to",
        "coalesce(row_count, 0L) AS row_count",
    )


def funnel_chart(funnel: DataFrame) -> DataFrame:
    """Funnel totals as (stage, events) rows."""
    rows = metric_rows(funnel, {"Views": "views", "Carts": "carts", "Purchases": "purchases"})
    return rows.selectExpr("metric AS stage", "value AS events")


def benchmark_chart(funnel: DataFrame, benchmark_pct: float = 2.0) -> DataFrame:
    """Own conversion next to the industry benchmark."""
    rows = metric_rows(
        funnel, {"Overall CVR": "overall_cvr_pct", "Industry Benchmark": f"{benchmark_pct}D"}
    )
    return rows.selectExpr("metric AS label", "value AS cvr_pct")


def hourly_chart(hours: DataFrame, interval: DataFrame) -> DataFrame:
    """Purchases per hour with the interval of the mean and a mark on the peak."""
    band = interval.select(F.struct("ci_95_low", "ci_95_high")).scalar()
    peak = hours.agg(F.expr("max_by(hour, struct(purchases, -hour))")).scalar()
    return (
        hours.select("hour", "purchases")
        .withColumns({"band": band, "peak": peak})
        .selectExpr(
            "hour", "purchases", "band.ci_95_low", "band.ci_95_high",
            "coalesce(hour = peak, false) AS is_peak",
        )
        .orderBy("hour")
    )


def segment_chart(segments: DataFrame) -> DataFrame:
    return segments.select("price_segment", "cvr_pct").orderBy("cvr_pct", "price_segment")


def room_error_bars(rooms: DataFrame) -> DataFrame:
    """Distance of the Wilson bounds from each room's conversion."""
    return rooms.selectExpr(
        "room_type", "cvr_pct",
        f"{half_even('cvr_pct - ci_low', 4)} AS err_low",
        f"{half_even('ci_high - cvr_pct', 4)} AS err_high",
    ).orderBy("cvr_pct", "room_type")


# Findings


def _section(name: str, one_row: DataFrame, texts: list[str], test: tuple[int, str, str, str, str] | None = None) -> DataFrame:
    """Lines of a section; ``test`` is the line that a p-value ends, and the test's kind, statistic
    and degrees of freedom."""
    at, *tested = test or (0,)
    lines = ", ".join(
        f"{line}, {text}, " + (", ".join(tested) if line == at else "STRING(NULL), DOUBLE(NULL), DOUBLE(NULL), DOUBLE(NULL)")
        for line, text in enumerate(texts, 1)
    )
    return one_row.selectExpr(
        f"{literal(name)} AS section", f"stack({len(texts)}, {lines}) AS (line, text, kind, x, df1, df2)"
    )


def findings(
    funnel: DataFrame, anova: DataFrame, hours: DataFrame, room: DataFrame, gaps: DataFrame, benchmark_rate: float = 0.02
) -> DataFrame:
    """Plain-language findings as (section, line, text) rows; every input has one row.

    Each statistic is worked out once; one Python stage turns the lines' statistics into p-values.
    ``anova`` and ``room`` come with their raw statistics.
    """
    over = half_even(f"overall_cvr_pct - {benchmark_rate * 100}D", 2)
    chi2 = goodness_of_fit("purchases", "views", f"{benchmark_rate}D")
    parts = [
        _section(
            "Funnel drop-off",
            funnel,
            [
                "concat(drop_off_pct, '% of views do not end in a purchase')",
                f"""concat('Overall CVR ', overall_cvr_pct, '%, ',
                           format_string('%+.2f', {over}), ' points against the benchmark')""",
                "concat('Chi-square ', chi2_statistic, ', p = ')",
            ],
            (3, "'chi2'", chi2, "1D", "DOUBLE(NULL)"),
        ),
        _section(
            "Price segments",
            anova,
            [
                "concat('Order revenue by segment: F = ', f_statistic, ', p = ')",
                "concat('Effect size eta squared ', eta_squared, ' (', effect, ')')",
            ],
            (1, "'f'", "f", "DOUBLE(df_between)", "DOUBLE(df_within)"),
        ),
        _section(
            "Hours",
            hours,
            [
                "concat('Peak hour ', peak_hour, ':00 with ', peak_count, ' purchases')",
                """concat('Mean per hour ', mean_per_hour, ', 95% interval ', ci_95_low, ' to ',
                          ci_95_high)""",
                "concat('Business hours bring ', biz_hours_pct, '% of purchases')",
                "concat('Kruskal-Wallis H = ', kw_statistic, ', p = ')",
            ],
            (4, "'chi2'", "kw_raw", "DOUBLE(kw_df)", "DOUBLE(NULL)"),
        ),
        _section(
            "Rooms",
            room,
            [
                "concat('Best room ', top_room, ' with ', top_cvr, '% CVR')",
                "concat('Against all other rooms: chi-square ', chi2, ', p = ')",
            ],
            (2, "'chi2'", "raw", "1D", "DOUBLE(NULL)"),
        ),
        _section(
            "Product gaps",
            gaps,
            [
                "concat(anomaly_count, ' products with abnormally low CVR')",
                "concat('Estimated lost revenue $', format_number(total_rev_lost, 0))",
            ],
        ),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    p = half_even("if(isnan(p), NULL, p)", 6)
    return whole.withColumn("p", tail_p("kind", "x", "df1", "df2")).selectExpr(
        "section", "line", f"if(kind IS NULL, text, concat(text, {p})) AS text"
    )
