"""Are two frames the same?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, as (columns..., a_mais): left minus right.

    One grouping over both sides: copies collapse before the shuffle.
    """
    tagged = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return tagged.groupBy(*left.columns).agg(F.sum("_side").alias("a_mais")).filter("a_mais <> 0")


def contents_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: same columns in the same order, and number of differing rows."""
    same_columns = left.columns == right.columns
    if not same_columns:
        return left.limit(1).agg(F.lit(False).alias("mesmas_colunas"), F.lit(None).cast("bigint").alias("linhas_diferentes"))
    return difference(left, right).agg(
        F.lit(True).alias("mesmas_colunas"),
        F.coalesce(F.sum(F.abs("a_mais")), F.lit(0)).cast("bigint").alias("linhas_diferentes"),
    )
