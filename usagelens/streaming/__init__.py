from usagelens.streaming.ingest import daily_user_activity, ingest_logs, read_log_stream  # noqa: F401
