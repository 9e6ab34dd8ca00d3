from __future__ import annotations

import math

import numpy as np
import pytest

from roomlens.functions import literals, numbers, segments, tails, text
from roomlens.operators import profiling


def evaluate(spark, sql, column, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, {column} {kind}")
    return [r[0] for r in df.orderBy("i").selectExpr(f"{sql} AS out").collect()]


def test_text_to_double(spark):
    texts = ["", "abc", "nan", "1d", "0", "-5", " 99.99 ", "1e2", ".5", "5.", "inf", "1e999", None]
    expected = [None, None, None, None, 0.0, -5.0, 99.99, 100.0, 0.5, 5.0, None, None, None]
    assert evaluate(spark, numbers.text_to_double("t"), "t", texts, "STRING") == expected


def test_half_even_equals_array_rounding(spark):
    values = [0.78125, 0.5, 1.5, 2.5, -0.5, -0.3, 2.675, 12.345, 1 / 3 * 100, 100 / 128]
    for digits in (0, 2, 4):
        found = evaluate(spark, numbers.half_even("v", digits), "v", values, "DOUBLE")
        assert found == [float(x) + 0.0 for x in np.round(np.array(values), digits)]
        assert not any(math.copysign(1, x) < 0 for x in found if x == 0)


def test_rates_round_half_up_and_survive_zero(spark):
    df = spark.createDataFrame([(1, 128), (1, 0), (None, 5)], "p INT, v INT")
    found = df.selectExpr(
        f"{numbers.rate_pct('p', 'v')} AS a",
        f"{numbers.half_even(numbers.ratio_pct('p', 'v'), 4)} AS b",
    ).collect()
    assert [tuple(r) for r in found] == [(0.78, 0.7812), (None, None), (None, None)]


# Text, then main and sub category as cleaned, then both as shown.
LITERALS = [
    ("['Home & Kitchen', 'Furniture', 'X']", ("Furniture", "X", "Furniture", "X")),
    ('["a", "Men\'s", " \'c\' "]', ("Men's", "c", "Men's", " 'c' ")),
    (r"['a', 'Women\'s']", ("Women's", None, "Women's", None)),
    ("['A','Furniture','Sofas',]", ("Furniture", "Sofas", "Furniture", "Sofas")),
    ("['A', None, 'x']", (None, "x", None, "x")),
    ("('A','Furniture')", ("Furniture", None, "Furniture", None)),
    ("'B' 'C'", ("C", None, "C", None)),
    ("['A','Furniture','S'] junk", (None, None, None, None)),
    ("['A', 5, 'x']", (None, "x", "5", "x")),
    (r"['A', 'Furniture', 'x\xa0']", ("Furniture", "x", "Furniture", "x\xa0")),
    ("garbage", (None,) * 4), ("['only']", (None, None, "only", None)), ("[]", (None,) * 4), (None, (None,) * 4),
    ("{1: 'a', 2: 'b', 3: 'c'}", ("a", "b", "a", "b")), ("{'a', 'b'}", (None,) * 4), ("7", (None,) * 4),
]


def test_category_entries(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LITERALS)], "i INT, t STRING")
    found = df.select("i", literals.category_entries("t").alias("e")).orderBy("i").select("e.*").collect()
    assert [tuple(r) for r in found] == [expected for _, expected in LITERALS]


def test_quoted_values_and_names(spark):
    odd = "it's a \\ `name`"
    df = spark.createDataFrame([(1,)], ["a`b c"])
    row = df.selectExpr(f"{text.literal(odd)} AS v", f"{text.name('a`b c')} AS n").first()
    assert (row.v, row.n) == (odd, 1)
    assert profiling.value_counts(df, "a`b c").first().value == 1
    assert profiling.null_profile(df).first().column_name == "a`b c"


@pytest.mark.parametrize("word", ["men's engineered-wood", "MDF", "a1b c", "o'neill é-è", "x"])
def test_title_case_matches_python(spark, word):
    assert evaluate(spark, text.title_case("t"), "t", [word], "STRING") == [word.title()]


def test_price_bands(spark):
    prices = [None, 0.0, -5.0, 99.99, 100.0, 299.0, 300.0, 699.0, 700.0]
    assert evaluate(spark, segments.price_band("p", segments.EVENT_BANDS), "p", prices, "DOUBLE") == [
        "Unknown", "Unknown", "Budget", "Budget", "Mid-Range", "Mid-Range", "Premium", "Premium",
        "Luxury",
    ]
    catalogue = evaluate(
        spark, segments.price_band("p", segments.CATALOGUE_BANDS), "p", [29.0, 30.0, 80.0, 150.0], "DOUBLE"
    )
    assert catalogue == ["Budget", "Mid-Range", "Premium", "Luxury"]


def test_tails_against_known_values():
    assert tails.chi2_tail(5.1020408163, 1) == pytest.approx(0.0238977107, abs=1e-9)
    assert tails.chi2_tail(30, 23) == pytest.approx(0.1494016477, abs=1e-9)
    assert tails.f_tail(2.5, 3, 100) == pytest.approx(0.0638329600, abs=1e-9)
    assert tails.t_quantile(0.975, 23) == pytest.approx(2.0686576104, abs=1e-9)


@pytest.mark.parametrize("x", [0.01, 0.5, 1, 3.84, 10, 50, 200, 3000])
def test_chi2_tail_of_one_degree_is_erfc(x):
    assert tails.chi2_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9, abs=1e-300)


def test_chi2_tail_of_two_degrees_is_exponential():
    for x in (0.1, 1, 2, 5, 40):
        assert tails.chi2_tail(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)


def test_f_and_t_agree():
    t = tails.t_quantile(0.975, 7)
    assert tails.f_tail(t * t, 1, 7) == pytest.approx(0.05, abs=1e-12)
    assert math.isnan(tails.f_tail(math.nan, 1, 2))
    assert tails.chi2_tail(-1, 3) == 1.0
