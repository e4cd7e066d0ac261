"""Numeric helpers shared by operators.

``rnd`` rounds half-up with plain IEEE arithmetic (``floor(x*10^k + 0.5) / 10^k``).
Spark's ``round`` goes through the shortest decimal string of the double
while other engines scale in binary, so the two disagree on values such as
1.15; the arithmetic form gives the same bits everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(c: Column | str, k: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** k)
    return (F.floor(col * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def sql_rnd(expr: str, k: int = 6) -> str:
    scale = f"CAST(1e{k} AS DOUBLE)"
    return f"(CAST(floor(({expr}) * {scale} + 0.5) AS DOUBLE) / {scale})"
