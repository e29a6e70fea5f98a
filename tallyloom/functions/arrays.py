"""Array expressions for event sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column


def pad_left(values: Column | str, length: int, fill: int = 0) -> Column:
    """Fixed length: keep the last `length` items, fill on the left."""
    values = as_column(values)
    kept = F.slice(values, F.greatest(F.size(values) - length + 1, F.lit(1)), F.lit(length))
    missing = F.greatest(F.lit(length) - F.size(values), F.lit(0))
    return F.concat(F.array_repeat(F.lit(fill).cast("long"), missing), F.transform(kept, lambda x: x.cast("long")))


def last_n(values: Column | str, n: int) -> Column:
    values = as_column(values)
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), F.lit(n))


def field(values: Column | str, name: str) -> Column:
    """One field of an array of structs, as its own array."""
    return F.transform(as_column(values), lambda x: x[name])
