"""Small helpers of the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import rounded


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, as the oracle texts do."""
    return df.select(*[rounded(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])
