"""Work per product: one job for all products of a list, instead of a job for each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from partyfold.operators.joins import Spread, matched_rows


def keep_products(
    df: DataFrame, products: DataFrame, product: str, spread: Spread | None = None
) -> DataFrame:
    """Rows of the listed products. A product that is listed twice counts once."""
    return matched_rows(df, products, [product], products.columns, spread)
