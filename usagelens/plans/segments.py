"""User segmentation: standardise six usage features, k-means with restarts,
profile each cluster and name it.

All restarts, and all values of k of the elbow, advance together: one pass over the
stored users a round (``operators.kmeans``).  Only centroids, costs and the four
profile rows reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import kmeans
from usagelens.plans.churn import fit_scaler
from usagelens.session import stored

FEATURES = schemas.USER_FEATURE_BASE
SCALED = [f"{c}_scaled" for c in FEATURES]


def _prepared(users: DataFrame) -> DataFrame:
    return stored(fit_scaler(users, FEATURES).transform(users), "scaled-users")


@dataclass
class Segmentation:
    assignments: DataFrame  # users + cluster
    profiles: DataFrame  # cluster, Segment, rounded feature means, users
    cost: float
    seed: int
    scaled: DataFrame  # users with their scaled features
    starts: list[kmeans.Start]


def best_start(starts: list[kmeans.Start]) -> kmeans.Start:
    """The start of lowest cost (the first of equal ones)."""
    return min(starts, key=lambda s: s.cost)


def name_clusters(profile_rows: list, names: list[str] = schemas.SEGMENT_NAMES) -> dict[int, str]:
    """Greedy naming from cluster profiles (ties go to the lower cluster id):
    most events -> Power Users; of the rest, fewest active days -> At-Risk Users;
    of the rest, most distinct features -> Feature Explorers; the rest -> Regular Users.
    With more than four clusters the extra ones are 'Segment <id>'."""
    power, regular, at_risk, explorers = names
    left = sorted(profile_rows, key=lambda r: r["cluster"])
    out: dict[int, str] = {}

    def take(key, label, reverse):
        nonlocal left
        if not left:
            return
        pick = sorted(left, key=lambda r: ((-r[key]) if reverse else r[key], r["cluster"]))[0]
        out[pick["cluster"]] = label
        left = [r for r in left if r["cluster"] != pick["cluster"]]

    take("total_events", power, True)
    take("login_frequency", at_risk, False)
    take("unique_features_used", explorers, True)
    if left:
        out[left[0]["cluster"]] = regular
        for r in left[1:]:
            out[r["cluster"]] = f"Segment {r['cluster']}"
    return out


def segment_users(
    users: DataFrame,
    k: int = schemas.N_CLUSTERS,
    n_init: int = schemas.N_INIT,
    seed: int = schemas.RANDOM_STATE,
) -> Segmentation:
    spark = users.sparkSession
    scaled = _prepared(users)
    starts = kmeans.fit(scaled, SCALED, "user_id", [(k, s) for s in range(seed, seed + n_init)])
    best = best_start(starts)
    assigned = scaled.withColumn("cluster", kmeans.nearest(SCALED, best.centroids))
    raw_profiles = assigned.groupBy("cluster").agg(
        *[F.round(F.avg(c), 2).alias(c) for c in FEATURES], F.count(F.lit(1)).alias("users")
    )
    rows = raw_profiles.collect()  # k rows
    names = name_clusters([r.asDict() for r in rows])
    profiles = spark.createDataFrame([(*r, names[r["cluster"]]) for r in rows], raw_profiles.schema.add("Segment", "string"))
    name_df = profiles.select("cluster", "Segment")
    out = assigned.join(F.broadcast(name_df), "cluster").select(*users.columns, "cluster", "Segment")
    return Segmentation(out, profiles, best.cost, best.seed, scaled, starts)


def knee(ks: list[int], costs: list[float]) -> int:
    """The k whose point lies farthest below the chord from the first to the last (k, cost), both axes scaled to 1."""
    x, y = np.array(ks, float), np.array(costs, float)
    if len(x) < 3 or y[0] == y[-1]:
        return ks[0]
    below = (1 - (x - x[0]) / (x[-1] - x[0])) - (y - y[-1]) / (y[0] - y[-1])
    return ks[int(below.argmax())]


def elbow_fits(users: DataFrame, ks=range(2, 11), seed: int = schemas.RANDOM_STATE) -> tuple[DataFrame, list[kmeans.Start]]:
    """The scaled users, and one fit for each k."""
    scaled = _prepared(users)
    return scaled, kmeans.fit(scaled, SCALED, "user_id", [(int(k), seed) for k in ks])


def elbow(users: DataFrame, ks=range(2, 11), seed: int = schemas.RANDOM_STATE) -> DataFrame:
    """Training cost (within-cluster sum of squares) for each k, and which k the knee is."""
    starts = elbow_fits(users, ks, seed)[1]
    at = knee([s.k for s in starts], [s.cost for s in starts])
    return users.sparkSession.createDataFrame([(s.k, s.cost, s.k == at) for s in starts], "k int, training_cost double, is_knee boolean")
