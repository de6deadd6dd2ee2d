"""Rows in ascending order of an id, in contiguous ranges that tasks stream through."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a range, about, and ranges at most.
RANGE_ROWS, RANGES = 4000, 20_000


def with_range(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``df`` with ``range``: ascending with the id, equal for equal ids; null ids are in the last range."""
    n = df.count()
    wanted = min(RANGES, n // RANGE_ROWS)
    splits = []
    if wanted > 1:
        fractions = [i / wanted for i in range(1, wanted)]
        splits = df.agg(F.percentile_approx(F.col(id_col).cast("double"), fractions, max(10_000, 10 * wanted)).alias("x")).first()["x"] or []
    splits = sorted(set(splits))
    if not splits:
        return df.withColumn("range", F.lit(0))
    cut = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="__id", outputCol="__range", handleInvalid="keep")
    return cut.transform(df.withColumn("__id", F.col(id_col).cast("double"))).withColumn("range", F.least(F.col("__range").cast("int"), F.lit(len(splits)))).drop("__id", "__range")
