"""Exact quantiles without gathering a group in one task.

The built-in exact percentile holds every distinct value of a group in one buffer. Here a group
is first collapsed to (value, frequency) rows. As long as a range of values has more rows than a task
should rank, it is cut at splitters from a mergeable quantile summary of its own values, and only the
parts that hold a wanted rank are kept. What is left is ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from roomlens.functions.numbers import half_even
from roomlens.operators.metrics import aggregates
from roomlens.sources.scratch import shared_table

# A task ranks this many distinct values of a group at most; a longer range is cut into SPLITS + 1 parts
# of about as many values each, however close together or far apart these are.
RANGE_ROWS = 1 << 18
SPLITS = 64


def frequencies(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct non-null number, as (keys, value, n)."""
    return (
        df.selectExpr(*by, f"DOUBLE({value}) AS value")
        .where("value IS NOT NULL")
        .groupBy(*by, "value")
        .agg(F.expr("count(*) AS n"))
    )


def quantiles(
    frequency: DataFrame, named: Mapping[str, float], by: Sequence[str] = (), stored: bool = False, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Linear-interpolation quantiles of each group, one column per entry of ``named``.

    ``frequency`` is the result of ``frequencies``; ``stored`` tells that it is a written table by the
    same keys, else its values are gathered by group and written first. Groups with a null key are left
    out. Without ``by`` the result has one row, or none when there is no value at all.
    """
    present = " AND ".join([f"{key} IS NOT NULL" for key in by] or ["true"])
    values = frequency.where(present)
    if not stored:
        values = shared_table(values.groupBy(*by, "value").agg(F.expr("sum(n) AS n")), "quantile-values")
    ranks = [f"{side}((total - 1) * {q}D)" for q in named.values() for side in ("floor", "ceil")]
    whole = values.groupBy(*by).agg(F.expr("sum(n) AS total"), F.expr("count(*) AS size"))
    keys = [*by, "part"]
    if (whole.agg(F.max("size")).first()[0] or 0) <= range_rows:
        total = f"sum(n) OVER (PARTITION BY {', '.join([*by, '1'])})"
        state = values.selectExpr(*by, "value", "n", "0L AS part", "0L AS before", f"{total} AS total")
    else:
        start = "0L AS part", "0L AS before", "total", "size"
        state = values.join(whole, [*by]) if by else values.crossJoin(F.broadcast(whole))  # one row
        state = _narrowed(state.selectExpr(*by, "value", "n", *start), by, ranks, range_rows)
    ranked = state.selectExpr(
        *by, "value", "n", "total",
        f"""before + sum(n) OVER (PARTITION BY {", ".join(keys)} ORDER BY value
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto""",
    )
    picks = [
        F.expr(f"max(if({rank} >= upto - n AND {rank} < upto, value, NULL)) AS pick_{i}")
        for i, rank in enumerate(ranks)
    ]
    found = ranked.groupBy(*by, "total").agg(*picks)
    return found.selectExpr(
        *by,
        *[
            f"pick_{2 * i} + (pick_{2 * i + 1} - pick_{2 * i})"
            f" * ((total - 1) * {q}D - floor((total - 1) * {q}D)) AS {name}"
            for i, (name, q) in enumerate(named.items())
        ],
    )


def _narrowed(state: DataFrame, by: Sequence[str], ranks: Sequence[str], range_rows: int) -> DataFrame:
    """Values in ranges of ``range_rows`` rows at most that hold a wanted rank, with the rows before each range.

    ``state`` has the keys, value, n, part, before, total and size, the rows of its part. A range of
    distinct values always splits, as a splitter is one of its values, and the least of them is below
    the greatest; so each round shortens every long range.
    """
    shares = ", ".join(f"{i / (SPLITS + 1)}D" for i in range(1, SPLITS + 1))
    keys, longest = [*by, "part"], None
    while longest is None or longest > range_rows:
        long_ = state.where(f"size > {range_rows}").groupBy(*keys).agg(
            F.expr(f"percentile_approx(value, array({shares}), {100 * SPLITS}) AS splitters")
        )
        placed = state.join(long_, keys, "left").withColumnRenamed("part", "outer").selectExpr(
            *by, "outer", "value", "n", "before", "total",
            f"outer * {SPLITS + 1} + if(splitters IS NULL, 0, size(filter(splitters, s -> s < value))) AS part",
        )
        outer = ", ".join([*by, "outer"])
        sizes = {"rows": "sum(n)", "size": "count(*)", "base": "first(before)", "total": "first(total)"}
        # The window runs over the parts of one range, which are few.
        parts = placed.groupBy(*by, "outer", "part").agg(*aggregates(sizes)).selectExpr(
            *by, "part", "size", "rows", "total",
            f"""base + coalesce(sum(rows) OVER (PARTITION BY {outer} ORDER BY part
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before""",
        )
        wanted = parts.where(" OR ".join(f"{rank} >= before AND {rank} < before + rows" for rank in ranks)).drop("rows", "total")
        state = shared_table(placed.drop("before", "outer").join(wanted, keys), "quantile-ranges")
        longest = state.agg(F.max("size")).first()[0] or 0
    return state


def moments(frequency: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation and extremes of each group, from stored frequencies.

    The deviation is taken around the mean in a second pass, as it would be over the rows. A
    group of one row has none.
    """
    first = frequency.groupBy(*by).agg(
        *aggregates(
            {
                "count": "sum(n)",
                "mean": "sum(n * value) / sum(n)",
                "min": "min(value)",
                "max": "max(value)",
            }
        )
    )
    squares = {"squares": "sum(n * pow(value - mean, 2))"}
    if by:
        means = first.select(*by, "mean")
        around = frequency.join(means, [*by]).groupBy(*by).agg(*aggregates(squares))
        both = first.join(around, [*by])
    else:
        mean = first.select("mean").scalar()
        around = frequency.withColumn("mean", mean).agg(*aggregates(squares))
        both = first.withColumn("squares", around.scalar())
    std = "if(count > 1, sqrt(squares / (count - 1)), NULL)"
    return both.selectExpr(*by, "count", "mean", f"{std} AS std", "min", "max")


def describe(df: DataFrame, value: str, digits: int = 6) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of a numeric column, one row.

    The rows are read once, into a stored frequency table.
    """
    frequency = shared_table(frequencies(df, value), "frequencies")
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quartiles = quantiles(frequency, shares, stored=True).agg(F.expr("first(struct(q25, q50, q75))"))
    columns = {
        "mean": "mean", "std": "std", "min": "min", "q25": "q.q25", "q50": "q.q50", "q75": "q.q75",
        "max": "max",
    }
    return moments(frequency).withColumn("q", quartiles.scalar()).selectExpr(
        "coalesce(count, 0L) AS count",
        *[f"{half_even(source, digits)} AS {name}" for name, source in columns.items()],
    )
