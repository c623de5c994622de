import datetime as dt
import json
import os

from usagelens.streaming import daily_user_activity, ingest_logs, read_log_stream


def _log(path, rows):
    with open(path, "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def _rec(u, ts, f="f"):
    return {"user_id": u, "timestamp": ts, "category_used": "c", "feature_used": f, "session_length": 10, "platform": "web"}


def test_ingest_is_exactly_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs")
    os.makedirs(src)
    _log(os.path.join(src, "a.json"), [_rec("u1", "2024-01-01T10:00:00"), _rec("u2", "2024-01-01T11:00:00")])
    table, ckpt = os.path.join(tmp_dir, "facts"), os.path.join(tmp_dir, "ckpt")
    ingest_logs(spark, src, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    # a new file arrives; a rerun picks up only the new file
    _log(os.path.join(src, "b.json"), [_rec("u1", "2024-01-02T09:00:00"), _rec("u3", "bad time")])
    ingest_logs(spark, src, table, ckpt).awaitTermination()
    facts = spark.read.parquet(table)
    assert facts.count() == 4
    assert facts.where("timestamp IS NULL").count() == 1  # bad timestamp kept as NULL
    ingest_logs(spark, src, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 4


def test_daily_activity_emits_closed_days(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs2")
    os.makedirs(src)
    _log(
        os.path.join(src, "a.json"),
        [_rec("u1", "2024-01-01T10:00:00"), _rec("u1", "2024-01-01T12:00:00"), _rec("u2", "2024-01-01T13:00:00"),
         _rec("u1", "2024-01-05T10:00:00")],  # moves the watermark past 2024-01-01
    )
    from usagelens.operators.normalize import events_normalized

    stream = daily_user_activity(events_normalized(read_log_stream(spark, src)))
    q = (stream.writeStream.format("memory").queryName("daily_act").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.date, r.user_id): r.events for r in spark.table("daily_act").collect()}
    assert got[(dt.date(2024, 1, 1), "u1")] == 2 and got[(dt.date(2024, 1, 1), "u2")] == 1


def test_daily_activity_days_independent_of_session_zone(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs3")
    os.makedirs(src)
    _log(os.path.join(src, "a.json"), [_rec("u1", "2024-01-01T23:30:00"), _rec("u1", "2024-01-09T10:00:00")])
    from usagelens.operators.normalize import events_normalized

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = daily_user_activity(events_normalized(read_log_stream(spark, src)))
        q = (stream.writeStream.format("memory").queryName("daily_act_ny").outputMode("append")
             .option("checkpointLocation", os.path.join(tmp_dir, "ck3")).trigger(availableNow=True).start())
        q.awaitTermination()
        got = {(r.date, r.user_id) for r in spark.table("daily_act_ny").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (dt.date(2024, 1, 1), "u1") in got


def test_ingest_in_several_micro_batches(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs4")
    os.makedirs(src)
    for i in range(4):
        _log(os.path.join(src, f"day{i}.json"), [_rec(f"u{j}", f"2024-01-0{i + 1}T10:00:00") for j in range(i + 1)])
    table, ckpt = os.path.join(tmp_dir, "facts4"), os.path.join(tmp_dir, "ckpt4")
    q = ingest_logs(spark, src, table, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4  # one file per batch
    dau = {r.date: r["count"] for r in spark.read.parquet(table).groupBy("date").count().collect()}
    assert dau == {dt.date(2024, 1, d): d for d in range(1, 5)}
