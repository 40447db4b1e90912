"""Quantiles by narrowing histograms, against sorted lists."""

import math

import pytest

from tessellate.operators.quantiles import quantiles

PROBS = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)


def plain(values):
    values = sorted(values)
    out = []
    for p in PROBS:
        place = p * (len(values) - 1)
        low, high = values[math.floor(place)], values[math.ceil(place)]
        out.append(low if low == high else low + (high - low) * (place - math.floor(place)))
    return out


GROUPS = {
    "one": [3.5], "two": [1.0, -1.0], "ties": [2.0] * 50 + [1.0] * 3 + [7.0] * 40, "whole": [float(i % 97) for i in range(500)],
    "wide": [10.0 ** i * s for i in range(-300, 300, 7) for s in (1, -1)], "infinite": [-math.inf, 1.0, 2.0, 3.0, math.inf, math.inf],
    "huge": [-1.7e308, 1.7e308, 1.0, 5e-324, 0.0, -0.0], None: [4.0, 9.0, 5.0],
}


@pytest.mark.parametrize("cells", [2, 1024])
def test_quantiles_equal_those_of_sorted_lists(spark, cells):
    rows = [(g, v) for g, values in GROUPS.items() for v in values]
    rows += [("one", None), ("two", math.nan), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: list(r)[1:] for r in quantiles(df, ["g"], "v", PROBS, cells).collect()}
    assert got.keys() == GROUPS.keys()
    for g, values in GROUPS.items():
        want = plain(values)
        assert all(a == b or math.isclose(a, b, rel_tol=1e-12) or (math.isnan(a) and math.isnan(b)) for a, b in zip(got[g], want)), (g, got[g], want)


def test_two_keys_no_keys_and_no_rows(spark):
    df = spark.range(1000).selectExpr("id % 3 AS a", "cast(null AS int) AS b", "cast(id AS int) AS v")
    got = {r.a: (r.b, r.q0, r.q2, r.q4) for r in quantiles(df, ["a", "b"], "v").collect()}
    assert got == {0: (None, 0.0, 499.5, 999.0), 1: (None, 1.0, 499.0, 997.0), 2: (None, 2.0, 500.0, 998.0)}
    assert [tuple(r) for r in quantiles(df, [], "v").collect()] == [(0.0, 249.75, 499.5, 749.25, 999.0)]
    assert quantiles(df.limit(0), ["a"], "v").count() == 0
