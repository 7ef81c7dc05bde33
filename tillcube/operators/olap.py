"""OLAP views over the sales facts.

The reference's roll-up is a plain GROUP BY year; drill-down, slice and dice
fix one or two dimensions.  A year filter on the written sales table is a
partition filter, so a slice reads one year's files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import summary as S


def rollup_year(sales: DataFrame) -> DataFrame:
    """Month -> year (row-level sales or the daily summary)."""
    return S.measures(sales).groupBy("year").agg(
        S.money("c_sales").alias("yearly_sales"),
        S.money("c_profit").alias("yearly_profit"),
    ).orderBy("year")


def drilldown_year(sales: DataFrame, year: int) -> DataFrame:
    """One year -> its months."""
    return (S.measures(sales).filter(F.col("year") == F.lit(year)).groupBy("month").agg(
        S.money("c_sales").alias("monthly_sales"),
        S.money("c_profit").alias("monthly_profit"),
        S.orders().alias("orders"),
    ).orderBy("month"))


def slice_year(sales: DataFrame, year: int) -> DataFrame:
    """Fix the year; categories by sales descending."""
    return (S.measures(sales).filter(F.col("year") == F.lit(year)).groupBy("category_name").agg(
        S.orders().alias("orders"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
    ).orderBy(F.desc("total_sales"), "category_name"))


def dice_year_category(sales: DataFrame, year: int, category: str) -> DataFrame:
    """Fix the year and the category; months ascending."""
    cond = (F.col("year") == F.lit(year)) & (F.col("category_name") == F.lit(category))
    return (S.measures(sales).filter(cond).groupBy("month").agg(
        S.orders().alias("orders"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_discount", "n_discount").alias("avg_discount"),
    ).orderBy("month"))


def pivot_month_category(sales: DataFrame, categories: list[str], rows: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """Months as rows (of each year, or with ``rows=("month",)`` over all
    years), one column of SUM(sale_amount) per category.

    The value list is passed in (taken from the category dimension), so
    Spark needs no extra job to find the pivot values.
    """
    p = S.measures(sales).groupBy(*rows).pivot("category_name", categories).agg(F.sum("c_sales"))
    return p.select(*rows, *[(F.col(f"`{c}`").cast("double") / F.lit(100.0)).alias(c)
                                       for c in categories]).orderBy(*rows)


def category_names(categories: DataFrame) -> list[str]:
    """Pivot values from the category dimension (a small, bounded list)."""
    rows = categories.select("category_name").orderBy("category_name").collect()
    return [r[0] for r in rows]
