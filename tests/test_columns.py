from usagelens.columns import common_and_unique, key_first_sorted, matching


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, "a")], "platform_web_count int, total_events int, "
                               "platform_mobile_ios_count int, Segment_x int, user_id string")
    assert matching(df, r"^platform_.*_count$") == ["platform_web_count", "platform_mobile_ios_count"]
    assert key_first_sorted(df, "user_id").columns == [
        "user_id", "Segment_x", "platform_mobile_ios_count", "platform_web_count", "total_events"]
    assert common_and_unique(["a", "b", "c"], ["c", "b", "d"]) == (["b", "c"], ["a"], ["d"])
