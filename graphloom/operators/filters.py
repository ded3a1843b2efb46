"""Root filters and cell filters.

Box predicates are plain ``between`` on stored columns, so Catalyst pushes them to the
Parquet scan (``PushedFilters``) and prunes row groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.geometry import within_box


@dataclass(frozen=True)
class Area:
    """an inclusive box in metres; an unset bound takes the default extent."""

    x0: float | None = None
    y0: float | None = None
    x1: float | None = None
    y1: float | None = None

    # Default extent of the national grid, metres.
    X_MIN = -7000.0
    Y_MIN = 289000.0
    X_MAX = 300000.0
    Y_MAX = 629000.0

    def bounds(self) -> tuple[float, float, float, float]:
        pick = lambda v, d: d if v is None or v == float("inf") else float(v)
        return (pick(self.x0, self.X_MIN), pick(self.y0, self.Y_MIN), pick(self.x1, self.X_MAX), pick(self.y1, self.Y_MAX))


def _between(df: DataFrame, c: str, lo: float, hi: float) -> Column:
    """Inclusive range test typed like the column, so the scan can take it (an integral
    column gets integral bounds instead of being cast to double)."""
    import math

    if isinstance(df.schema[c].dataType, T.IntegralType):
        return F.col(c).between(F.lit(math.ceil(lo)), F.lit(math.floor(hi)))
    return F.col(c).between(lo, hi)


def in_box(df: DataFrame, x: str, y: str, area: Area, unit: float = 1000.0) -> DataFrame:
    """rows whose (x, y) lie in the inclusive box; columns hold ``metres / unit``."""
    x0, y0, x1, y1 = area.bounds()
    return df.where(_between(df, x, x0 / unit, x1 / unit) & _between(df, y, y0 / unit, y1 / unit))


def comma_decimal(c: Column, scale: int = 0) -> Column:
    """Decimal-comma text -> DECIMAL(18, scale); with scale 0 the value rounds to an integer."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast(T.DecimalType(18, scale))


def in_box_text(df: DataFrame, x: str, y: str, area: Area, context_col: str | None = None,
                context=None, scale: int = 0) -> DataFrame:
    """context equals a constant AND decimal-comma text coordinates lie in the box."""
    x0, y0, x1, y1 = area.bounds()
    cx, cy = comma_decimal(F.col(x), scale), comma_decimal(F.col(y), scale)
    cond = (cx >= x0) & (cx <= x1) & (cy >= y0) & (cy <= y1)
    if context_col is not None:
        cond = (F.col(context_col) == F.lit(context)) & cond
    return df.where(cond)


def within(df: DataFrame, wkt: str, area: Area) -> DataFrame:
    """geometry (a point, else its centroid) inside the box; null geometry is outside."""
    x0, y0, x1, y1 = area.bounds()
    return df.where(within_box(wkt, x0, y0, x1, y1))


# Sentinel cell values meaning "no data" (numbers, their text, two phrases).
SENTINEL_NUMBERS = [-111 * i for i in range(1, 10)]
SENTINEL_TEXTS = [str(v) for v in SENTINEL_NUMBERS] + ["Niet van toepassing", "Geen informatie"]


def not_sentinel(c: Column, dtype: T.DataType) -> Column:
    """F6 for one cell: true when the value is not a sentinel (numeric compare for numbers)."""
    if isinstance(dtype, T.NumericType):
        return ~c.isin(SENTINEL_NUMBERS)
    if isinstance(dtype, T.StringType):
        return ~c.isin(SENTINEL_TEXTS)
    return F.lit(True)


def drop_sentinels(df: DataFrame, cols: list[str]) -> DataFrame:
    """F6 as a column transform: sentinel cells become null (and are then skipped, F5)."""
    out = []
    for f in df.schema.fields:
        if f.name in cols:
            out.append(F.when(not_sentinel(F.col(f.name), f.dataType), F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def non_empty(c: Column) -> Column:
    """value present and not the empty string."""
    return c.isNotNull() & (c != "")
