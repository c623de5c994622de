"""Registered queries: k-means segments, profiles, elbow costs (rows-only checks:
cluster ids and costs depend on the optimiser, not on SQL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelens.operators import kmeans, users
from usagelens.plans import segments
from usagelens.plans.q_etl import facts
from usagelens.plans.registry import register
from usagelens.sources import adapters

PLATS = adapters.ORDERS_PLATFORMS


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.user_features(facts(spark, sf_dir, "orders"), PLATS)


@register("user_segments")
def q_user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User features + Segment name (the cluster id column is dropped, as before)."""
    return segments.segment_users(user_table(spark, sf_dir)).assignments.drop("cluster")


@register("segment_profiles")
def q_segment_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_users(user_table(spark, sf_dir)).profiles


def recomputed_costs(scaled: DataFrame, starts: list[kmeans.Start]) -> DataFrame:
    """(start, k, cost, again): the cost of each start as reported, and summed anew from every user's nearest centroid."""
    again = scaled.agg(*[F.sum(F.array_min(kmeans.squared_distances(segments.SCALED, s.centroids))).alias(str(i)) for i, s in enumerate(starts)])
    reported = scaled.sparkSession.createDataFrame([(i, s.k, s.cost) for i, s in enumerate(starts)], "start int, k int, cost double")
    return again.unpivot([], again.columns, "start", "again").withColumn("start", F.col("start").cast("int")).join(reported, "start")


def _wrong() -> Column:
    return F.abs(F.col("cost") - F.col("again")) > 1e-9 * F.abs(F.col("again")) + 1e-9


@register(
    "segments_check",
    """SELECT what, CAST(CASE WHEN value = -1 THEN (SELECT count(DISTINCT o_custkey) FROM orders) ELSE value END AS BIGINT) AS value
FROM (VALUES ('users', -1), ('distinct_users', -1), ('segments', 4), ('wrong_profiles', 0), ('wrong_sizes', 0),
             ('starts', 10), ('wrong_costs', 0), ('cheaper_than_kept', 0), ('not_nearest', 0)) t(what, value)""",
)
def q_segments_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold whatever the optimiser finds: every user once, four segments, profiles equal to the means and
    sizes of their members, every start's cost equal to the one summed anew from its centroids, no start cheaper
    than the one that was kept, and every user in the cluster whose members' mean it is nearest to (up to the
    optimiser's tolerance)."""
    found = segments.segment_users(user_table(spark, sf_dir))
    again = found.assignments.groupBy("cluster").agg(
        *[F.round(F.avg(c), 2).alias(f"{c}_again") for c in segments.FEATURES], F.count(F.lit(1)).alias("users_again")
    )
    both = found.profiles.join(again, "cluster", "full")
    same = reduce(lambda a, b: a & b, [F.abs(F.col(c) - F.col(f"{c}_again")) < 0.011 for c in segments.FEATURES])
    profiles = both.agg(
        F.count_if(~F.coalesce(same, F.lit(False))).alias("wrong_profiles"), F.count_if(~F.col("users").eqNullSafe(F.col("users_again"))).alias("wrong_sizes")
    )
    rows = found.assignments.agg(
        F.count(F.lit(1)).alias("users"), F.countDistinct("user_id").alias("distinct_users"), F.countDistinct("Segment").alias("segments")
    )
    costs = recomputed_costs(found.scaled, found.starts).agg(
        F.count(F.lit(1)).alias("starts"), F.count_if(_wrong()).alias("wrong_costs"), F.count_if(F.col("again") < found.cost * (1 - 1e-9)).alias("cheaper_than_kept")
    )
    members = found.scaled.join(found.assignments.select("user_id", "cluster"), "user_id")
    means = members.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in segments.SCALED]).orderBy("cluster").collect()  # one row a cluster
    centres = [[r[c] for c in segments.SCALED] for r in means]
    d = kmeans.squared_distances(segments.SCALED, centres)
    place = F.array_position(F.array(*[F.lit(r["cluster"]) for r in means]), F.col("cluster")).cast("int")
    far = members.agg(F.count_if(F.sqrt(F.get(d, place - 1)) > F.sqrt(F.array_min(d)) + 0.05).alias("not_nearest"))
    return reduce(DataFrame.unionByName, [x.unpivot([], x.columns, "what", "value") for x in (rows, profiles, costs, far)])


@register("kmeans_elbow")
def q_kmeans_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.elbow(user_table(spark, sf_dir))


@register(
    "elbow_check",
    """SELECT what, CAST(value AS BIGINT) AS value
FROM (VALUES ('fits', 9), ('wrong_costs', 0), ('wrong_knees', 0), ('above_one_cluster', 0), ('far_above_fewer', 0)) t(what, value)""",
)
def q_elbow_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of the elbow summed anew from the centroids, all below the cost of a single cluster (the sum of squares of
    scaled features) and none more than half again above that of a smaller k; and the knee found again by SQL: farthest below the chord."""
    table = user_table(spark, sf_dir)
    scaled, starts = segments.elbow_fits(table)
    costs = recomputed_costs(scaled, starts)
    one = scaled.agg(F.sum(F.array_min(kmeans.squared_distances(segments.SCALED, [[0.0] * len(segments.SCALED)])))).first()[0]
    every = Window.partitionBy()  # nine rows
    fewer = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    first, last = F.max_by("again", -F.col("k")).over(every), F.max_by("again", "k").over(every)
    chord = first + (last - first) * (F.col("k") - F.min("k").over(every)) / (F.max("k").over(every) - F.min("k").over(every))
    rows = costs.withColumns({"below": chord - F.col("again"), "least": F.min("again").over(fewer)})
    at = segments.knee([s.k for s in starts], [s.cost for s in starts])
    seen = rows.agg(
        F.count(F.lit(1)).alias("fits"),
        F.count_if(_wrong()).alias("wrong_costs"),
        (F.max_by("k", "below") != at).cast("long").alias("wrong_knees"),
        F.count_if(F.col("again") >= one).alias("above_one_cluster"),
        F.count_if(F.col("again") > 1.5 * F.col("least")).alias("far_above_fewer"),
    )
    return seen.unpivot([], seen.columns, "what", "value")
