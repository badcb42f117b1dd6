"""Regression scores over several outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16


def regression_metrics(
    df: DataFrame, y: str, p: str, output_col: str = "horizon", keys: Sequence[str] = ()
) -> DataFrame:
    """``mae``, ``r2``, ``rmse``, ``mape``: per output first, then the plain mean of the outputs.

    RMSE is the root of the averaged squared error. R2 of a constant output is 1 if predicted
    exactly, else 0. MAPE is a fraction.
    """
    error = F.col(y) - F.col(p)
    per_output = df.groupBy(*keys, output_col).agg(
        F.avg(F.abs(error)).alias("_mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(y).alias("_var"),
        F.avg(F.abs(error) / F.greatest(F.abs(F.col(y)), F.lit(EPSILON))).alias("_mape"),
    )
    r2 = (
        F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var"))
        .when(F.col("_mse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return per_output.groupBy(*keys).agg(
        F.avg("_mae").alias("mae"),
        F.avg(r2).alias("r2"),
        F.sqrt(F.avg("_mse")).alias("rmse"),
        F.avg("_mape").alias("mape"),
    )
