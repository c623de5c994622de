import json
import os

from pyspark.sql import functions as F

from usagelens.operators.normalize import events_normalized
from usagelens.sources import catalog, files


def test_json_array_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "logs.json")
    recs = [
        {"user_id": "u1", "timestamp": "2024-01-01T10:00:00.123456", "category_used": "c", "feature_used": "f",
         "session_length": 30, "platform": "web"},
        {"user_id": "u2", "timestamp": "not a time", "category_used": "c", "feature_used": "g",
         "session_length": 40, "platform": "mobile_ios"},
    ]
    with open(path, "w") as fh:
        json.dump(recs, fh, indent=4)  # one pretty-printed array, as the logs were written
    df = events_normalized(files.read_json_events(spark, path, multiline=True))
    rows = {r.user_id: r for r in df.collect()}
    assert set(rows) == {"u1", "u2"}
    assert rows["u1"].week == 1 and rows["u1"].year == 2024 and rows["u2"].timestamp is None


def test_nested_catalog_explode_and_missing_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "catalog.json")
    doc = {
        "features": [
            {"category": "Banking", "description": "d", "sub_features": ["view_balance", "transfer"]},
            {"category": "Empty", "description": "no list"},
            {"category": "Help", "description": "d", "sub_features": ["chat"]},
        ]
    }
    with open(path, "w") as fh:
        json.dump(doc, fh, indent=2)
    flat = catalog.explode_catalog(catalog.read_feature_catalog(spark, path))
    assert sorted(tuple(r) for r in flat.collect()) == [("Banking", "transfer"), ("Banking", "view_balance"), ("Help", "chat")]
    empty = os.path.join(tmp_dir, "empty.json")
    with open(empty, "w") as fh:
        fh.write("{}")
    assert catalog.explode_catalog(catalog.read_feature_catalog(spark, empty)).count() == 0
    # round trip through the nested form
    nested = catalog.nest_catalog(flat)
    assert sorted(tuple(r) for r in catalog.explode_catalog(nested).collect()) == sorted(tuple(r) for r in flat.collect())


def test_enrich_unknown_default(spark):
    cat = spark.createDataFrame([("Banking", "transfer")], "category string, feature_name string")
    ev = spark.createDataFrame([("u1", "transfer"), ("u2", "mystery"), ("u3", None)], "user_id string, feature_used string")
    got = {r.user_id: r.category_used for r in catalog.enrich_category(ev, cat).collect()}
    assert got == {"u1": "Banking", "u2": "Unknown", "u3": "Unknown"}


def test_enrich_duplicate_entries_last_wins(spark, tmp_dir):
    path = os.path.join(tmp_dir, "twice.json")
    doc = {"features": [{"category": "Z", "sub_features": ["a", "b"]}, {"category": "A", "sub_features": ["b", "c"]}]}
    with open(path, "w") as fh:
        json.dump(doc, fh)
    cat = catalog.explode_catalog(catalog.read_feature_catalog(spark, path), position=True)
    ev = spark.createDataFrame([("a",), ("b",), ("c",)], "feature_used string")
    assert {r.feature_used: r.category_used for r in catalog.enrich_category(ev, cat).collect()} == {"a": "Z", "b": "A", "c": "A"}


def test_corrupt_records_are_counted_and_left_out(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log.json")
    with open(path, "w") as fh:
        fh.write('{"user_id": "u", "session_length": 5}\n{"user_id": "v", "session_length": \n\n{"user_id": "w", "session_length": "x"}\n')
    assert [r.user_id for r in files.read_json_events(spark, path).collect()] == ["u"]
    assert tuple(files.count_corrupt_json(spark, path).first()) == (3, 2)


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, tmp_dir):
    texts = [" lead", "trail ", 'he said ""hi, you""', 'a "quoted" word', "two\nlines", "plain"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int")
    files.write_csv(df, os.path.join(tmp_dir, "t"))
    got = files.read_csv(spark, os.path.join(tmp_dir, "t"), df.schema, multiLine=True).collect()
    assert {r.i: r.t for r in got} == dict(enumerate(texts))


def test_json_array_round_trip_and_missing_file(spark, tmp_dir):
    df = spark.range(50, numPartitions=3).select(F.concat(F.lit("u"), "id").alias("user_id"), F.col("id").alias("session_length"))
    files.write_json_array(df, os.path.join(tmp_dir, "arrays"))
    got = files.read_json_events(spark, os.path.join(tmp_dir, "arrays"), multiline=True)
    assert sorted((r.session_length, r.user_id) for r in got.collect()) == [(i, f"u{i}") for i in range(50)]
    assert files.read_json_events(spark, os.path.join(tmp_dir, "nowhere")).count() == 0


def test_logs_can_be_counted_and_read_by_column(spark, tmp_dir):
    lines, array = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "array")
    os.makedirs(lines), os.makedirs(array)
    recs = [{"user_id": f"u{i}", "session_length": i} for i in range(7)]
    with open(os.path.join(lines, "a.json"), "w") as fh:
        fh.write("".join(json.dumps(r) + "\n" for r in recs) + '{"user_id": "bad", "session_length": "x"}\n')
    with open(os.path.join(array, "a.json"), "w") as fh:
        json.dump([*recs, {"user_id": "bad", "session_length": "x"}], fh)
    for path, multiline in ((lines, False), (array, True)):
        df = files.read_json_events(spark, path, multiline=multiline)
        assert df.count() == 7 and not df.isEmpty()
        # a column that the fault is not in leaves the record out all the same
        assert {r.user_id for r in df.select("user_id").collect()} == {r["user_id"] for r in recs}
        assert tuple(files.count_corrupt_json(spark, path, multiline=multiline).first()) == (8, 1)
        rejected = files.json_records(spark, path, multiline).rejected.collect()
        assert [(os.path.basename(r.file), json.loads(r.record)["user_id"]) for r in rejected] == [("a.json", "bad")]


ODD = ["plain", "}", "{", "a } b { c", '"', '\\"', "\\", "x\\\\", "[1, 2]", "],[{", "é😀 }", "tab\tnew\nline", "", "}}}}", '{"user_id": "fake"}', "ends with \\}"]


def test_array_logs_are_cut_at_record_ends(spark, tmp_dir):
    """Braces, quotes and escapes inside texts, any layout, several byte ranges to a file."""
    recs = [{"user_id": f"u{i}", "feature_used": ODD[i % len(ODD)], "session_length": i} for i in range(400)]
    for name, layout in (("compact", {}), ("pretty", {"indent": 4}), ("tight", {"separators": (",", ":")}), ("plain", {"ensure_ascii": False})):
        with open(os.path.join(tmp_dir, f"{name}.json"), "w") as fh:
            json.dump(recs, fh, **layout)
    for name, text in (("empty", ""), ("none", "[]"), ("blank", " [\n ] \n"), ("one", '{"user_id": "single", "session_length": 1}')):
        with open(os.path.join(tmp_dir, f"{name}.json"), "w") as fh:
            fh.write(text)
    for limit in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            texts = files.array_records(spark, tmp_dir)
            blocks = spark.read.option("lineSep", "}").text(os.path.join(tmp_dir, "pretty.json")).select("_metadata.file_block_start").distinct().count()
            assert (blocks > 1) == (limit == "1k")
            got = {}
            for r in texts.collect():
                got.setdefault(os.path.basename(r.file), []).append(json.loads(r.record))
            key = lambda r: r["session_length"]
            assert {k: sorted(v, key=key) for k, v in got.items()} == {f"{n}.json": recs for n in ("compact", "pretty", "tight", "plain")} | {"one.json": [{"user_id": "single", "session_length": 1}]}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cut_off_and_broken_array_records_are_rejected(spark, tmp_dir):
    whole = json.dumps([{"user_id": f"u{i}", "session_length": i} for i in range(5)])
    cuts = {"mid_record.json": whole[: whole.index("u4") + 20], "after_value.json": whole[:-2], "in_string.json": whole[: whole.index("u3") + 1], "after_comma.json": whole[: whole.index('{"user_id": "u4"')]}
    for name, text in cuts.items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(text)
    seen = {}
    for name in cuts:
        r = files.json_records(spark, os.path.join(tmp_dir, name), multiline=True)
        seen[name] = (r.good.count(), r.rejected.count(), tuple(r.counts().first()))
    assert seen == {"mid_record.json": (4, 1, (5, 1)), "after_value.json": (4, 1, (5, 1)), "in_string.json": (3, 1, (4, 1)), "after_comma.json": (4, 0, (4, 0))}


def test_csv_rows_that_do_not_parse_are_kept_aside(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rows")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as fh:
        fh.write("name,n\na,1\nb,x\nc,3,4\nd\n,5\n")
    got = files.csv_records(spark, path, spark.createDataFrame([], "name string, n int").schema)
    assert sorted((r.name or "", r.n) for r in got.good.collect()) == [("", 5), ("a", 1)]
    assert sorted(r.record for r in got.rejected.collect()) == ["b,x", "c,3,4", "d"]
    assert tuple(got.counts().first()) == (5, 3) and got.good.count() == 2 and got.good.columns == ["name", "n"]
