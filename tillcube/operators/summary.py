"""Additive measures and the daily sales summary (the serving layer).

Every KPI of the reference except the product ranking groups sales by
calendar fields, category and festival tag.  So the load also writes one
row per (day, category, festival tag) with *additive* measures: order
count, quantity, money as long cents, discount cents and their count,
and the sum and count of the per-sale margin ratios.  Its size is bounded by
calendar days x categories, whatever the number of sales, and summing the
measures of its rows gives exactly what summing the sales would (integers),
so KPI and OLAP queries read it instead of the fact table.

``measures(df)`` turns row-level sales into the same measure columns (one
row per sale), so each KPI operator is written once and accepts either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import cents, ratio_percent

DIMENSIONS = ["year", "month", "sale_date", "category_name", "is_festival_month", "festival_name"]
PRODUCT_DIMENSIONS = ["product_name", "category_name"]
MEASURES = ["n_orders", "n_quantity", "c_sales", "c_profit", "c_festival_sales", "c_discount",
            "n_discount", "r_margin", "n_margin"]


def is_measures(df: DataFrame) -> bool:
    return "n_orders" in df.columns


def as_measures(sales: DataFrame) -> DataFrame:
    """Row-level sales as measure rows (one per sale)."""
    ratio = ratio_percent("profit", "sale_amount")
    dims = [c for c in DIMENSIONS + ["product_name"] if c in sales.columns]
    return sales.select(
        *dims,
        F.lit(1).cast("long").alias("n_orders"),
        F.col("quantity").cast("long").alias("n_quantity"),
        cents("sale_amount").alias("c_sales"),
        cents("profit").alias("c_profit"),
        F.when(F.col("is_festival_month"), cents("sale_amount")).otherwise(F.lit(0).cast("long"))
        .alias("c_festival_sales"),
        cents("discount_percent").alias("c_discount"),
        F.col("discount_percent").isNotNull().cast("long").alias("n_discount"),
        ratio.alias("r_margin"),
        ratio.isNotNull().cast("long").alias("n_margin"),
    )


def measures(df: DataFrame) -> DataFrame:
    """``df`` as measure rows: unchanged if it already is a summary."""
    return df if is_measures(df) else as_measures(df)


def daily_summary(sales: DataFrame) -> DataFrame:
    """One row per (day, category, festival tag) with the summed measures."""
    return as_measures(sales).groupBy(*DIMENSIONS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def product_summary(sales: DataFrame) -> DataFrame:
    """One row per (product name, category) with the summed measures.

    The product ranking reads this: its size is the number of products, not
    the number of sales.
    """
    return as_measures(sales).groupBy(*PRODUCT_DIMENSIONS).agg(*[F.sum(m).alias(m) for m in MEASURES])


# ---- aggregate expressions over measure rows (identical for both inputs)
def orders() -> Column:
    return F.coalesce(F.sum("n_orders"), F.lit(0).cast("long"))


def quantity() -> Column:
    return F.sum("n_quantity")


def money(measure: str) -> Column:
    """Exact sum of a cents measure as double currency units."""
    return F.sum(measure).cast("double") / F.lit(100.0)


def mean_money(measure: str, count: str) -> Column:
    """``double(exact sum) / count`` (NULL over no rows)."""
    return F.try_divide(money(measure), F.sum(count).cast("double"))


def mean_margin() -> Column:
    """Mean of the per-sale margin ratios (rows with a zero amount skipped)."""
    return F.try_divide(F.sum("r_margin"), F.sum("n_margin").cast("double"))
