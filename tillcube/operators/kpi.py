"""Sales KPIs (D1-D9, D15, D17) and the sorted / top-k reports (L1-L4).

Every operator takes the ``sales`` DataFrame (and dimensions where needed)
and returns a DataFrame; all aggregates are algebraic, so Spark runs them as
partial + final hash aggregation and a hot group is combined map-side
before the shuffle.  Category names are carried on each sale at load time,
so grouping by category needs no join with the category table.  The
calendar/category KPIs are sums of additive measures (``summary``), so
they run on row-level sales or on the much smaller daily summary alike.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_avg, money_sum
from . import summary as S

TOP_K_DEFAULT = 10


def overview_totals(sales: DataFrame) -> DataFrame:
    """One row even for an empty input (count 0, the rest NULL).

    Like every KPI below except the product ranking, it takes row-level
    sales or the daily summary (``summary.daily_summary``) alike.
    """
    return S.measures(sales).agg(
        S.orders().alias("total_orders"),
        S.money("c_sales").alias("total_revenue"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_sales", "n_orders").alias("avg_order_value"),
        S.quantity().alias("total_items_sold"),
    )


def monthly_sales_summary(sales: DataFrame) -> DataFrame:
    """Per (year, month), ascending."""
    return (S.measures(sales).groupBy("year", "month").agg(
        S.orders().alias("total_orders"),
        S.quantity().alias("total_quantity"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_discount", "n_discount").alias("avg_discount"),
        S.money("c_festival_sales").alias("festival_sales"),
    ).orderBy("year", "month"))


def category_performance(sales: DataFrame) -> DataFrame:
    """D3: per category; the margin is the mean of per-sale ratios (not a ratio of sums)."""
    return (S.measures(sales).groupBy("category_name").agg(
        S.orders().alias("total_orders"),
        S.quantity().alias("total_quantity"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_discount", "n_discount").alias("avg_discount"),
        F.round(S.mean_margin(), 2).alias("profit_margin_percent"),
    ).orderBy(F.desc("total_sales"), "category_name"))


def top_products(sales: DataFrame, limit: int | None = TOP_K_DEFAULT) -> DataFrame:
    """By (product name, category name), revenue descending, top ``limit``.

    Grouping is by *names* as in the reference; ties at the cut are broken by
    the names so the result is deterministic.  ``limit`` < 0 or None means
    no limit (SQLite's ``LIMIT -1``).  Takes row-level sales or the product
    summary (``summary.product_summary``).
    """
    agg = S.measures(sales).groupBy("product_name", "category_name").agg(
        S.orders().alias("times_sold"),
        S.quantity().alias("total_quantity_sold"),
        S.money("c_sales").alias("total_revenue"),
        S.money("c_profit").alias("total_profit"),
    )
    ordered = agg.orderBy(F.desc("total_revenue"), "product_name", "category_name")
    if limit is None or limit < 0:
        return ordered
    return ordered.limit(limit)


def festival_comparison(sales: DataFrame) -> DataFrame:
    """Per (flag, festival name); NULL name is one group."""
    return (S.measures(sales).groupBy("is_festival_month", "festival_name").agg(
        S.orders().alias("total_orders"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_sales", "n_orders").alias("avg_order_value"),
    ).orderBy(F.desc("total_sales"), "festival_name"))


def festival_split(sales: DataFrame) -> DataFrame:
    """Festival days against other days."""
    return S.measures(sales).groupBy("is_festival_month").agg(
        S.orders().alias("orders"),
        S.money("c_sales").alias("sales"),
        S.money("c_profit").alias("profit"),
    ).orderBy("is_festival_month")


def _five_kpis() -> list[F.Column]:
    return [
        S.orders().alias("total_orders"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_sales", "n_orders").alias("avg_order_value"),
        S.mean_money("c_discount", "n_discount").alias("avg_discount"),
    ]


def festival_sales(sales: DataFrame) -> DataFrame:
    """Festival days by festival name, sales descending."""
    return (S.measures(sales).filter(F.col("is_festival_month")).groupBy("festival_name").agg(*_five_kpis())
            .orderBy(F.desc("total_sales"), "festival_name"))


def non_festival_sales(sales: DataFrame) -> DataFrame:
    """The same KPIs over all non-festival days (one row)."""
    return S.measures(sales).filter(~F.col("is_festival_month")).agg(*_five_kpis())


def category_monthly(sales: DataFrame, category: str) -> DataFrame:
    """One category by (year, month)."""
    return (S.measures(sales).filter(F.col("category_name") == F.lit(category)).groupBy("year", "month").agg(
        S.orders().alias("total_orders"),
        S.money("c_sales").alias("total_sales"),
        S.money("c_profit").alias("total_profit"),
        S.mean_money("c_discount", "n_discount").alias("avg_discount"),
    ).orderBy("year", "month"))


def sales_in_range(sales: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """``sale_date BETWEEN start AND end``, closed at both ends.

    On the written sales table the year bounds prune partitions and the date
    bounds are pushed into the Parquet scan.
    """
    c = F.col("sale_date")
    years = F.col("year").between(start.year, end.year)
    return sales.filter(years & (c >= F.lit(start)) & (c <= F.lit(end)))


def sales_summary_range(sales: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """D15 (``get_sales_summary``): the D1 columns over a date range."""
    return overview_totals(sales_in_range(sales, start, end))


def category_list(categories: DataFrame) -> DataFrame:
    """L1: category names ascending."""
    return categories.select("category_name").orderBy("category_name")


def latest_months(monthly: DataFrame, n: int | None = 24) -> DataFrame:
    """L4: the latest ``n`` months of the monthly summary (``n`` < 0 or None: all)."""
    ordered = (monthly.select("year", "month", "total_sales", "total_profit")
               .orderBy(F.desc("year"), F.desc("month")))
    return ordered if n is None or n < 0 else ordered.limit(n)


def category_avg_price(products: DataFrame) -> DataFrame:
    """Average cost and selling price per category (all at once)."""
    return products.groupBy("category_id").agg(
        exact_avg("cost_price").alias("c"),
        exact_avg("selling_price").alias("s"),
    )


def historical_averages(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean sale amount per category and per month (all years together)."""
    m = S.measures(sales)
    cat = m.groupBy("category_name").agg(S.mean_money("c_sales", "n_orders").alias("category_avg_sale"))
    mon = m.groupBy("month").agg(S.mean_money("c_sales", "n_orders").alias("month_avg_sale"))
    return cat, mon


def with_category_names(sales: DataFrame, categories: DataFrame) -> DataFrame:
    """Attach ``category_name`` to sales that carry only ``category_id``.

    The load already denormalises the name into ``sales``; this join is for
    facts from elsewhere.
    """
    cats = categories.select("category_id", "category_name")
    return sales.drop("category_name").join(cats, "category_id")


def star_join(sales: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Sales with their product and with the category that the *sale*
    names (not the product's), as three tables.  The products' own category is
    left out; both joins are equi joins without a hint."""
    p = products.select("product_id", "product_name", "cost_price", "selling_price")
    c = categories.select("category_id", "category_name", "description")
    return sales.drop("product_name", "category_name", "cost_price", "selling_price", "description").join(p, "product_id").join(c, "category_id")
