import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.sources import ledger, storage

TABLE = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def put(folder, name, lines, later=0):
    os.makedirs(os.path.join(folder, os.path.dirname(name)), exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("name,n\n" + "".join(f"{x}\n" for x in lines))
    when = time.time() + later
    os.utime(path, (when, when))
    return path


def names(df):
    return {os.path.basename(r.file): (r.rows, r.bad_rows, r.reasons, r.status) for r in df.collect()}


def rows(spark, table, **options):
    return sorted(tuple(r) for r in ledger.read_table(spark, table, TABLE, **options).collect())


@pytest.fixture
def src(tmp_dir):
    return f"{tmp_dir}/src", f"{tmp_dir}/table"


def test_only_a_loaded_version_is_skipped(spark, src):
    files, table = src
    put(files, "a.csv", ["f1,1"])
    put(files, "day=1/bad.csv", ["f2,x", "f3,3"])
    put(files, "empty.csv", [])
    assert names(ledger.load_new(spark, files, table, TABLE)) == {
        "a.csv": (1, 0, "", "loaded"), "bad.csv": (2, 1, "n:type", "skipped"), "empty.csv": (0, 0, "", "loaded")
    }
    assert set(names(ledger.load_new(spark, files, table, TABLE))) == {"bad.csv"}  # rejected ones are looked at again
    put(files, "day=1/bad.csv", ["f2,2", "f3,3"], later=5)  # repaired under its name
    put(files, "b.csv", ["f4,4"])
    assert names(ledger.load_new(spark, files, table, TABLE)) == {"bad.csv": (2, 0, "", "loaded"), "b.csv": (1, 0, "", "loaded")}
    assert rows(spark, table) == [("f1", 1), ("f2", 2), ("f3", 3), ("f4", 4)]
    assert ledger.load_new(spark, files, table, TABLE).count() == 0
    assert sorted(r.load_no for r in ledger.commits(spark, table).collect()) == [1, 2, 3]


def test_a_changed_file_takes_the_place_of_its_rows(spark, src):
    files, table = src
    path = put(files, "a.csv", ["f1,1", "f2,2"])
    put(files, "b.csv", ["g,9"])
    ledger.load_new(spark, files, table, TABLE)
    put(files, "a.csv", ["f1,10"], later=5)
    assert set(names(ledger.load_new(spark, files, table, TABLE))) == {"a.csv"}
    assert rows(spark, table) == [("f1", 10), ("g", 9)]
    assert rows(spark, table, versions="all") == [("f1", 1), ("f1", 10), ("f2", 2), ("g", 9)]
    put(files, "a.csv", ["f1,x"], later=9)  # a changed version that is rejected leaves the loaded one
    assert names(ledger.load_new(spark, files, table, TABLE))["a.csv"][3] == "skipped"
    assert rows(spark, table) == [("f1", 10), ("g", 9)]
    os.remove(path)  # a file that goes away leaves its rows
    assert ledger.load_new(spark, files, table, TABLE).count() == 0
    assert rows(spark, table) == [("f1", 10), ("g", 9)]


def test_content_identity(spark, src):
    files, table = src
    put(files, "a.csv", ["f1,1", "f2,2"])
    load = lambda: names(ledger.load_new(spark, files, table, TABLE, identity="content"))
    assert set(load()) == {"a.csv"}
    put(files, "a.csv", ["f1,1", "f2,2"], later=60)  # touched, not changed
    assert load() == {}
    put(files, "a.csv", ["f1,1", "f2,3"], later=60)  # changed, same size and time
    assert set(load()) == {"a.csv"} and rows(spark, table) == [("f1", 1), ("f2", 3)]
    put(files, "a.csv", ["f1,1", "f2,2"], later=90)  # an earlier version comes back: the newest loaded one counts
    assert set(load()) == {"a.csv"} and rows(spark, table) == [("f1", 1), ("f2", 2)]


def test_skip_row_policy(spark, src):
    files, table = src
    put(files, "a.csv", ["f1,1", "f2,x"])
    assert names(ledger.load_new(spark, files, table, TABLE, policy="skip_row")) == {"a.csv": (2, 1, "n:type", "partly loaded")}
    assert rows(spark, table) == [("f1", 1)]
    assert ledger.load_new(spark, files, table, TABLE, policy="skip_row").count() == 0


def test_a_load_that_fails_leaves_nothing_and_is_cleaned_up(spark, src, monkeypatch):
    files, table = src
    put(files, "a.csv", ["f1,1"])
    ledger.load_new(spark, files, table, TABLE)
    put(files, "b.csv", ["f2,2"])
    with monkeypatch.context() as m:
        m.setattr(ledger, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            ledger.load_new(spark, files, table, TABLE)
    assert rows(spark, table) == [("f1", 1)] and ledger.history(spark, table).count() == 1
    gone = ledger.vacuum(spark, table)
    assert sorted(x.split("/")[0] for x in gone) == ["ledger", "rows"] and ledger.vacuum(spark, table) == []
    assert len(storage.children(spark, f"{table}/rows")) == 1
    assert set(names(ledger.load_new(spark, files, table, TABLE))) == {"b.csv"}
    assert rows(spark, table) == [("f1", 1), ("f2", 2)]


def test_superseded_rows_can_go(spark, src):
    files, table = src
    for i in range(3):
        put(files, "a.csv", [f"f,{i}"], later=5 * i)
        ledger.load_new(spark, files, table, TABLE)
    assert len(ledger.vacuum(spark, table, superseded=True)) == 2
    assert rows(spark, table) == [("f", 2)] and ledger.history(spark, table).count() == 3
    assert ledger.load_new(spark, files, table, TABLE).count() == 0


def test_odd_file_names(spark, src):
    files, table = src
    for i, name in enumerate(("a[1].csv", "b {x}.csv", "c%20d.csv", "é*.csv", "day=2/e,f.csv")):
        put(files, name, [f"f{i},{i}"])
    assert ledger.load_new(spark, files, table, TABLE).count() == 5
    assert rows(spark, table) == [(f"f{i}", i) for i in range(5)]
    assert ledger.load_new(spark, files, table, TABLE).count() == 0


def test_table_before_its_first_load(spark, src):
    assert rows(spark, src[1]) == [] and ledger.history(spark, src[1]).count() == 0 and ledger.vacuum(spark, src[1]) == []


def test_listing_reads_no_contents(spark, src):
    files, _ = src
    put(files, "a.csv", ["f1,1"])
    plan = ledger.file_versions(spark, files)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_one_file_at_a_path(spark, tmp_dir):
    target = f"{tmp_dir}/out/day=1/x.csv"
    for n in (3, 2):
        storage.write_csv_file(spark.range(n).select(F.concat(F.lit("f"), "id").alias("name"), F.col("id").alias("n")), target)
        assert [x for x in os.listdir(os.path.dirname(target)) if not x.startswith(".")] == ["x.csv"]
        assert sum(1 for _ in open(target)) == n + 1
