"""Feature catalog: nested JSON (category -> sub_features) to flat rows, and lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas


def read_feature_catalog(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read nested catalog documents ``{"features": [{category, description, sub_features}]}``:
    one pretty-printed document a file, or (``multiline=False``) one a line."""
    return spark.read.schema(schemas.FEATURE_CATALOG).option("multiLine", multiline).json(path)


def explode_catalog(nested: DataFrame, position: bool = False) -> DataFrame:
    """Nested catalog -> one (category, feature_name) row per sub-feature.

    A missing ``features`` or ``sub_features`` yields no rows (like an empty list).
    With ``position``, rows also carry their place (entry, sub-feature) in the document.
    """
    entries = nested.select(F.posexplode("features").alias("e", "entry"))
    rows = entries.select("e", F.col("entry.category").alias("category"), F.posexplode("entry.sub_features").alias("f", "feature_name"))
    return rows.select("category", "feature_name", *([F.struct("e", "f").alias("position")] if position else []))


def nest_catalog(flat: DataFrame, description: str | None = None) -> DataFrame:
    """Flat (category, feature_name) rows -> catalog documents, one per category.

    Sub-feature lists are sorted so the documents are deterministic; a list is
    bounded by one category's features, and no task gathers the whole catalog.
    """
    per_category = flat.groupBy("category").agg(F.array_sort(F.collect_set("feature_name")).alias("sub_features"))
    entry = F.struct("category", F.lit(description).cast("string").alias("description"), "sub_features")
    return per_category.select(F.array(entry).alias("features"))


def catalog_from_events(activity: DataFrame, unknown: str = schemas.UNKNOWN_CATEGORY) -> DataFrame:
    """Distinct (category, feature_name) pairs observed in activity rows."""
    return (
        activity.where(F.col("feature_used").isNotNull() & F.col("category_used").isNotNull())
        .where(F.col("category_used") != unknown)
        .select(F.col("category_used").alias("category"), F.col("feature_used").alias("feature_name"))
        .distinct()
    )


def enrich_category(
    events: DataFrame,
    catalog: DataFrame,
    feature_col: str = "feature_used",
    out_col: str = "category_used",
    default: str = schemas.UNKNOWN_CATEGORY,
) -> DataFrame:
    """Look up each event's category by feature name; unmapped -> ``default``.

    A feature listed more than once takes its last entry (by ``position`` if the
    catalog has it, else the greatest category).  The catalog is a dimension; Spark
    broadcasts it when its measured size allows, else it is shuffled.
    """
    order = F.struct("position", "category") if "position" in catalog.columns else F.struct("category")
    lookup = catalog.groupBy(F.col("feature_name").alias("__feature")).agg(F.max_by("category", order).alias("__category"))
    joined = events.join(lookup, events[feature_col] == lookup["__feature"], "left")
    return joined.withColumn(out_col, F.coalesce(F.col("__category"), F.lit(default))).drop(
        "__feature", "__category"
    )
