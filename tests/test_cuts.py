import numpy as np
import pytest

from usagelens.operators.cuts import borders


def _plain(x, w, bins):
    """MLlib's rule for the borders of a feature, over all rows."""
    values = np.unique(x + 0.0)
    n = [w[x == v].sum() for v in values]
    if len(values) <= bins:
        return [(a + b) / 2 for a, b in zip(values, values[1:])]
    out, so_far, goal = [], n[0], sum(n) / bins
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + n[i]
        if abs(before - goal) < abs(so_far - goal) and len(out) < bins - 1:
            out.append((values[i - 1] + values[i]) / 2)
            goal += sum(n) / bins
    return out


def test_borders_are_those_of_all_rows(spark):
    r = np.random.default_rng(5)
    n = 6_000
    columns = {
        "even": r.normal(size=n),
        "mostly_zero": np.where(r.random(n) < 0.6, 0.0, r.integers(0, 400, n) / 8),
        "few": r.integers(-2, 5, n).astype(float),
        "one_rare": np.where(np.arange(n) == 77, 3.0, 1.0),
        "same": np.full(n, 2.5),
        "wide": np.exp(r.normal(size=n) * 40) * r.choice([-1, 1], n),
        "whole": r.integers(0, 40, n).astype(float),
    }
    for w in (np.ones(n), r.integers(1, 4, n).astype(float)):
        rows = [tuple(float(c[i]) for c in columns.values()) + (float(w[i]),) for i in range(n)]
        data = spark.createDataFrame(rows, [*columns, "w"])
        got = borders(data.repartition(5), list(columns), "w", 32)
        for name, cuts in zip(columns, got, strict=True):
            assert cuts == pytest.approx(_plain(columns[name], w, 32), rel=1e-12), name
        assert got == borders(data.coalesce(1), list(columns), "w", 32)
    assert got[3] == [2.0] and got[4] == []
    assert borders(data.limit(0), list(columns), "w", 32) == [[]] * len(columns)


def test_a_border_lies_above_the_value_below_it(spark):
    """Between neighbouring doubles there is no middle."""
    low = 1.0
    high = float(np.nextafter(low, 2.0))
    data = spark.createDataFrame([(low, 1.0), (high, 1.0), (-0.0, 1.0), (0.0, 1.0)], "x double, w double")
    (cuts,) = borders(data, ["x"], "w", 32)
    assert cuts == [0.5, high]
