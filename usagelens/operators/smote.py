"""SMOTE oversampling (Chawla et al., 2002) as Spark jobs.

Synthetic minority rows are placed on the segment between a minority row and
one of its ``k`` nearest minority neighbours: ``x + u * (neighbour - x)``.

* neighbours: exact k-NN (``knn.exact_knn``), no pair table;
* balance is exact: ``N = majority - minority`` new rows, spread as
  ``floor(N / m)`` per minority row plus one more for the first ``N mod m`` rows
  in hash order (picked with a hash histogram, no sort, no single-task window);
* randomness comes from md5(id, j, seed), so a rerun (or a retried task)
  produces the same rows, and so does SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.operators.select import flag_first_n
from usagelens.operators.knn import exact_knn

def _digits(n: int, *parts) -> F.Column:
    """The first ``n`` hex digits (13 at most) of the md5 of the parts, joined by colons, as a whole number."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, n), 16, 10).cast("bigint")


def smote(
    rows: DataFrame,
    id_col: str,
    feature_cols: list[str],
    label_col: str,
    minority_label: int = 1,
    k: int = 5,
    seed: int = 42,
    block_rows: int = 2048,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Training rows plus synthetic minority rows so both classes are equal.

    Returns ``id_col`` (synthetic ids are ``<id>#s<j>``), the features, the label
    and ``is_synthetic``.
    """
    counts = rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    by_label = {r[label_col]: r["n"] for r in counts}
    m = by_label.get(minority_label, 0)
    majority = max((n for lab, n in by_label.items() if lab != minority_label), default=0)
    base = rows.select(id_col, *feature_cols, label_col).withColumn("is_synthetic", F.lit(False))
    need = majority - m
    if need <= 0:
        return base
    if m <= k:
        raise ValueError(f"SMOTE with {k} neighbours needs more than {k} minority rows, got {m}")
    minority = rows.where(F.col(label_col) == minority_label).select(id_col, *feature_cols)
    per_row, extra = divmod(need, m)

    neigh = exact_knn(minority, id_col, feature_cols, k, block_rows)
    # At most k neighbours per row: a bounded list.
    neigh_lists = neigh.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("neighbor_rank", "neighbor_vec"))).alias("nbrs")
    )
    # The first ``extra`` rows in md5(id || seed) order get one more new row.
    ranked = flag_first_n(
        minority.withColumn("__g", F.lit(1)),
        "__g",
        F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed)))),
        F.lit(extra),
        "__extra",
        id_col,
    )
    n_new = F.lit(per_row) + F.when(F.col("__extra"), 1).otherwise(0)
    seeds = ranked.join(neigh_lists, id_col).withColumn("__n_new", n_new).where(F.col("__n_new") > 0)
    # A row may need very many copies (tiny minority, huge majority): cut its
    # quota into chunks and spread the chunks over tasks before generating.
    n_chunks = F.ceil(F.col("__n_new") / F.lit(chunk_rows)).cast("int")
    chunked = seeds.select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("__chunk"))
    chunked = chunked.repartition(F.col(id_col), F.col("__chunk"))
    lo = F.col("__chunk") * F.lit(chunk_rows)
    hi = F.least(lo + F.lit(chunk_rows), F.col("__n_new")) - 1
    exploded = chunked.select("*", F.explode(F.sequence(lo, hi)).alias("__j"))
    draw = (F.col(id_col), F.col("__j"), F.lit(seed))
    pick = _digits(8, *draw, F.lit("neighbour")) % F.size("nbrs")
    gap = _digits(13, *draw, F.lit("gap")).cast("double") / F.lit(float(16**13))
    chosen = exploded.withColumn("__nvec", F.element_at("nbrs", (pick + 1).cast("int")).getField("neighbor_vec"))
    synth = chosen.select(
        F.concat(F.col(id_col).cast("string"), F.lit("#s"), F.col("__j").cast("string")).alias(id_col),
        *[
            (F.col(c) + gap * (F.element_at("__nvec", i + 1) - F.col(c))).alias(c)
            for i, c in enumerate(feature_cols)
        ],
        F.lit(minority_label).cast(rows.schema[label_col].dataType).alias(label_col),
        F.lit(True).alias("is_synthetic"),
    )
    return base.withColumn(id_col, F.col(id_col).cast("string")).unionByName(synth)
