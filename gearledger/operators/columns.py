"""Added table columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearledger.functions.money import MONEY


def add_price_columns(rows: DataFrame, provinces: Iterable[str]) -> DataFrame:
    """Zero ``<province>_oem_price`` and ``<province>_afm_price`` columns, replacing columns of
    the same name."""
    names = [f"{p}_{kind}_price" for p in provinces for kind in ("oem", "afm")]
    kept = [c for c in rows.columns if c not in names]
    return rows.select(*kept, *[F.lit(0).cast(MONEY).alias(n) for n in names])
