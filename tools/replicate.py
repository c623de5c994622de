"""Build an N-times replica of the events and orders tables (disjoint user ids)
for scaling runs:  python tools/replicate.py SRC_DIR DST_DIR N"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from usagelens.session import local_session  # noqa: E402


def main(src: str, dst: str, n: int) -> None:
    spark = local_session()
    r = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("r")
    ev = spark.read.parquet(f"{src}/events.parquet").select("*", r)
    ev = ev.withColumns(
        {"user_id": F.col("user_id") + F.col("r") * 1_000_000, "event_id": F.col("event_id") * n + F.col("r")}
    ).drop("r")
    ev.repartition(64).write.mode("overwrite").parquet(f"{dst}/events.parquet")
    o = spark.read.parquet(f"{src}/orders.parquet").select("*", r)
    o = o.withColumns(
        {"o_custkey": F.col("o_custkey") + F.col("r") * 10_000_000, "o_orderkey": F.col("o_orderkey") * n + F.col("r")}
    ).drop("r")
    o.repartition(64).write.mode("overwrite").parquet(f"{dst}/orders.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
