"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column

# Letters with accents and the plain letters they are compared as.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"


def casefold_plain(text: Column | str) -> Column:
    """Lower-case text without accents, for names typed in different ways."""
    return F.translate(F.lower(as_column(text)), ACCENTED, PLAIN)


def max_number(text: Column | str) -> Column:
    """Largest number of a text that writes 1.234,5 for 1234.5."""
    plain = F.replace(F.replace(as_column(text), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    numbers = F.regexp_extract_all(plain, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    return F.array_max(F.transform(numbers, lambda x: x.try_cast("double")))


def squeeze(text: Column | str) -> Column:
    """Collapse runs of blanks and trim."""
    return F.trim(F.regexp_replace(as_column(text), r"\s+", " "))


def human_number(value: Column | str) -> Column:
    """1.2K, 3.4M: one digit, by steps of a thousand."""
    v = as_column(value).cast("double")

    def one_digit(x: Column) -> Column:
        return F.call_function("format_number", x, F.lit("0.0"))

    out = one_digit(v)
    for power, unit in [(1, "K"), (2, "M"), (3, "G"), (4, "T"), (5, "P")]:
        out = F.when(F.abs(v) >= 1000.0**power, F.concat(one_digit(v / 1000.0**power), F.lit(unit))).otherwise(out)
    return out
