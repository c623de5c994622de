"""How far k-NN prunes as the points grow:  python tools/knn_scale.py SF_DIR N [N ...]

For each N: the minority training rows of the churn features, each N times with
its features moved a little (plain copies would be their own neighbours), how many
rows ``exact_knn`` sends to leaves, and the seconds it takes."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from usagelens.operators import knn  # noqa: E402
from usagelens.plans import q_churn  # noqa: E402
from usagelens.session import local_session, stored  # noqa: E402


def main(sf_dir: str, factors: list[int]) -> None:
    spark = local_session()
    rows, cols = q_churn.scaled_train(spark, sf_dir)
    points = stored(rows.where("churn_status = 1").select("user_id", *cols), "minority")
    for n in factors:
        many = points.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        moved = lambda c: F.col(c) + 0.1 * (F.pmod(F.xxhash64("user_id", "r", F.lit(c)), F.lit(1 << 20)) / (1 << 20) - 0.5)  # noqa: E731, B023
        many = many.select(F.concat_ws("#", "user_id", "r").alias("user_id"), *[F.when(F.col("r") > 0, moved(c)).otherwise(F.col(c)).alias(c) for c in cols])
        many = stored(many.repartition(8), "points")
        seen = knn.visits(many, "user_id", cols, 5).first()
        t = time.perf_counter()
        knn.exact_knn(many, "user_id", cols, 5).write.format("noop").mode("overwrite").save()
        print(f"x{n}: {seen.points} points, {seen.leaves} leaves, {seen.sent_rows / seen.points:.1f} rows sent a point, {time.perf_counter() - t:.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], [int(x) for x in sys.argv[2:]])
