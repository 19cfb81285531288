"""One row per element of a computed array.

Spark filters on the array's size before an ordinary explode, and pushes that
filter towards the scan, where it computes the array a second time. The outer
forms have no such filter; the row they give for an empty array is removed
afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def exploded(df: DataFrame, keep: list, array: Column, out: str, pos: str = "_pos") -> DataFrame:
    """``keep`` columns, the 0-based ``pos`` (unless left as is) and ``out``."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, out)).where(F.col(pos).isNotNull())
    return rows.drop("_pos")


def inlined(df: DataFrame, keep: list, array: Column, fields: list[str]) -> DataFrame:
    """``keep`` columns and the struct ``fields`` of each element."""
    rows = exploded(df, keep, array, "_item")
    return rows.select(*[k for k in keep if isinstance(k, str)], *[F.col(f"_item.{f}").alias(f) for f in fields])
