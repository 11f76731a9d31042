"""Column functions of plain numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column | str, digits: int) -> Column:
    """A double to so many decimals, as the queries' SQL rounds: the double product with a power of ten, halves away from zero.

    Spark's own takes the decimals that a double is printed with. 5243 / 640 prints as 8.1921875 and would be 8.192188,
    while its product is 8192187.499999999.
    """
    unit = F.lit(10.0**digits)
    return F.round((F.col(x) if isinstance(x, str) else x) * unit) / unit
