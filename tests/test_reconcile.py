from usagelens.columns import key_first_sorted
from usagelens.operators import reconcile

A = [("u1", 1, 10.0, "x"), ("u2", 2, 20.0, "y"), ("u3", 3, 30.0, "z"), ("u4", None, 40.0, "w")]
B = [("u1", 1, 10.0, 5), ("u2", 9, 20.0, 6), ("u3", 4, 31.0, 7), ("u4", 4, 40.0, 8), ("u5", 5, 50.0, 9)]


def _frames(spark):
    a = spark.createDataFrame(A, "user_id string, n long, v double, Segment string")
    b = spark.createDataFrame(B, "user_id string, n long, v double, days int")
    return a, b


def test_equal_tables_have_no_discrepancy(spark):
    a, _ = _frames(spark)
    assert reconcile.discrepancies(a, a).count() == 0
    assert not reconcile.any_discrepancy(a, a)


def test_discrepancy_rows(spark):
    a, b = _frames(spark)
    d = reconcile.discrepancies(a, b)
    assert d.columns == ["user_id", "n_file1", "n_file2", "v_file1", "v_file2"]
    got = {r.user_id: tuple(r)[1:] for r in d.collect()}
    # u1 equal; u4 null on one side is not a difference; u5 only on one side
    assert got == {"u2": (2, 9, None, None), "u3": (3, 4, 30.0, 31.0)}


def test_summary(spark):
    a, b = _frames(spark)
    got = {r.column_name: tuple(r)[1:] for r in reconcile.discrepancy_summary(a, b).collect()}
    assert got == {"n": (2, 0, 1), "v": (1, 0, 1)}


def test_merge_coalesces_and_orders(spark):
    a, b = _frames(spark)
    m = reconcile.merge_tables(a, b)
    assert m.columns == ["user_id", "Segment", "days", "n", "v"]
    got = {r.user_id: r.asDict() for r in m.collect()}
    assert got["u2"]["n"] == 2  # side 1 wins
    assert got["u4"]["n"] == 4  # falls back to side 2
    assert got["u5"]["Segment"] is None and got["u5"]["n"] == 5
    assert key_first_sorted(m, "user_id").columns == m.columns


def test_conditional_sink(spark, tmp_dir):
    import os

    from usagelens.sources.files import write_if_any

    a, b = _frames(spark)
    same = os.path.join(tmp_dir, "none")
    diff = os.path.join(tmp_dir, "some")
    assert write_if_any(reconcile.discrepancies(a, a), same) is False and not os.path.exists(same)
    assert write_if_any(reconcile.discrepancies(a, b), diff) is True
    assert spark.read.option("header", True).csv(diff).count() == 2


def test_tolerance_for_numeric_columns(spark):
    a = spark.createDataFrame([("u1", 10.0, "x"), ("u2", 20.0, "y")], "user_id string, v double, s string")
    b = spark.createDataFrame([("u1", 10.0000001, "x"), ("u2", 21.0, "z")], "user_id string, v double, s string")
    exact = {r.user_id for r in reconcile.discrepancies(a, b).collect()}
    assert exact == {"u1", "u2"}
    loose = {r.user_id: (r.v_file1, r.s_file1) for r in reconcile.discrepancies(a, b, tolerance=1e-3).collect()}
    assert loose == {"u2": (20.0, "y")}
